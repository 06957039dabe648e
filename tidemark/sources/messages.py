"""Bar rows as JSON messages: encode for publishing, decode with the
consumer's field rules.

Decoding rules (per field, e.g. ``open`` / ``Open``):

* the lower-case key wins when it is *present*, even with an explicit null
  (then the field counts as missing); otherwise the capitalised key is read;
* which key is present is decided on a ``map<string,string>`` decode (keeps
  both case variants, where a struct decode would fold them together);
* the *value* is read from a variant parse, which keeps the token kind:
  ``int()`` semantics for volume (``"100"`` -> 100, ``100.9`` -> 100,
  ``"100.0"`` -> NULL), ``float()`` semantics for prices;
* a JSON ``NaN`` token makes the variant parse fail while the map decode
  still works: such values are ``bad_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import MESSAGE_FIELDS

_MAP = "_m"
_VAR = "_v"


def encode(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One JSON object per row, original column names, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(value_col))


def parse(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Add the two decodes of each message next to its columns."""
    return (messages
            .withColumn(_MAP, F.from_json(F.col(value_col), "map<string,string>"))
            .withColumn(_VAR, F.try_parse_json(F.col(value_col))))


def _key(lower: str, upper: str) -> Column:
    """The key the consumer reads: lower-case when present, else capitalised."""
    return F.when(F.map_contains_key(F.col(_MAP), F.lit(lower)), F.lit(lower)).otherwise(F.lit(upper))


def field_present(lower: str, upper: str) -> Column:
    """The chosen key exists and its value is not JSON null."""
    return F.element_at(F.col(_MAP), _key(lower, upper)).isNotNull()


def field_value(lower: str, upper: str, type_: str) -> Column:
    """The chosen key's value read from the variant with cast semantics."""
    lv = F.try_variant_get(F.col(_VAR), f"$.{lower}", type_)
    uv = F.try_variant_get(F.col(_VAR), f"$.{upper}", type_)
    return F.when(F.map_contains_key(F.col(_MAP), F.lit(lower)), lv).otherwise(uv)


def field_text(lower: str, upper: str) -> Column:
    return F.element_at(F.col(_MAP), _key(lower, upper))


FIELD_TYPES = {"open": "double", "high": "double", "low": "double", "close": "double", "volume": "bigint"}


def decode_fields(parsed: DataFrame) -> DataFrame:
    """Typed fields plus per-field presence flags (``_p_<f>``)."""
    cols = []
    for lower, upper in MESSAGE_FIELDS:
        if lower in FIELD_TYPES:
            cols.append(field_value(lower, upper, FIELD_TYPES[lower]).alias(lower))
        else:
            cols.append(field_text(lower, upper).alias(lower))
        cols.append(field_present(lower, upper).alias(f"_p_{lower}"))
    return parsed.select("*", *cols)
