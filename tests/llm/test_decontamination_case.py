"""Only A-Z are lower-cased: letters whose lower case depends on what stands around them match as they are."""

import pytest

from tidemark.llm import decontaminate

ACRONYM = "Ο.Α.Σ. ΟΔΟΣ' a one two three Four five six seven"  # capital sigma before a stop and before an apostrophe


@pytest.mark.parametrize("text", [ACRONYM, ACRONYM.replace("Four", "FOUR")])
def test_capital_sigma(spark, documents, text):
    items = spark.createDataFrame([(1, ACRONYM)], "item_id long, text string")
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.report(documents([(1, "x " + text), (2, text.lower())]), items).collect()}
    assert got == {1: True, 2: False}
