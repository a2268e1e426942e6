"""Columns of the user's that are named as the operators' own are kept with their values."""

from collections import Counter

import pytest
from cases import frame, odd_rows
from pyspark.sql import functions as F

from marketlens.llm import exact_dedup, mixing, pii, simhash

NAMES = "__digest __text __TEXT_ __copy __id __sig __sha __found __taken __size __key __source".split()


@pytest.mark.parametrize("run", [exact_dedup.keep_one, simhash.keep_representatives, mixing.mixed, pii.sanitize])
def test_names_of_the_operators(spark, run):
    docs = frame(spark, odd_rows())
    named = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES})
    out = run(named)
    assert out.columns == named.columns
    got = out.collect()
    assert got and all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got for n in NAMES)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in run(docs).collect())
