"""Message decoding and reject routing (FIXTURES F3)."""

import pytest

from tidemark.operators.validate import validate_split

BASE = {"Date": "2024-01-02", "Open": "10", "High": "12", "Low": "9", "Close": "11", "Volume": "100",
        "symbol": "AAA"}


def _msg(**over):
    import json
    d = dict(BASE)
    for k, v in over.items():
        if v is _DROP:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()

CASES = [
    ("valid strings", _msg(), None),
    ("ticker row", _msg(Open="AAA", High="AAA", Low="AAA", Close="AAA", Volume="AAA"), "bad_number"),
    ("zero open", _msg(Open=0), "zero_open"),
    ("close missing", _msg(Close=_DROP), "missing_field"),
    ("explicit null lower wins", '{"open":null,"Open":71.5,"High":1,"Low":1,"Close":1,"Volume":1,'
                                 '"Date":"2024-01-02","symbol":"AAA"}', "missing_field"),
    ("volume as decimal text", _msg(Volume="100.0"), "bad_number"),
    ("NaN token", _msg().replace('"Close": "11"', '"Close": NaN'), "bad_number"),
    ("date missing", _msg(Date=_DROP), "missing_date"),
    ("symbol missing", _msg(symbol=_DROP), "missing_symbol"),
    ("not json", "{not json", "bad_json"),
]


@pytest.fixture(scope="module")
def split(spark):
    msgs = spark.createDataFrame([(i, m) for i, (_, m, _) in enumerate(CASES)], "seq long, value string")
    valid, rejects = validate_split(msgs)
    return {r.seq: r for r in valid.collect()}, {r.seq: r.reason for r in rejects.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_reject_table(split, i):
    valid, rejects = split
    name, _, reason = CASES[i]
    if reason is None:
        assert i in valid and i not in rejects, name
    else:
        assert rejects.get(i) == reason, name
        assert i not in valid


def test_lower_case_key_present_wins(spark):
    m = ('{"open":70,"Open":71.5,"High":80,"Low":60,"Close":75,"Volume":100.9,"Date":"2024-01-02",'
         '"symbol":"AAA","extra":1}')
    valid, rejects = validate_split(spark.createDataFrame([(1, m)], "seq long, value string"))
    (r,) = valid.collect()
    assert rejects.count() == 0
    assert (r.open, r.high, r.close, r.volume) == (70.0, 80.0, 75.0, 100)  # int() truncates 100.9
    assert set(valid.columns) == {"symbol", "date", "open", "high", "low", "close", "volume", "seq"}
