"""Places of many matches in one text (op 2)."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from medallion.llm import secrets


def test_running_sums_over_stretches(spark):
    sizes = (1, 2, secrets.STRETCH - 1, secrets.STRETCH, secrets.STRETCH + 1, 2 * secrets.STRETCH, 3000)
    df = spark.createDataFrame([([(i * 7919) % 13 for i in range(n)],) for n in sizes], "a array<int>")
    for r in df.select("a", secrets.running_sums(F.col("a")).alias("s")).collect():
        assert r.s == list(itertools.accumulate(r.a))


@pytest.mark.parametrize("n", [0, 1, 600, 50_000])
def test_spans_of_a_text_with_many_matches(spark, n):
    text = "é token: 'abcdefghijkl' \U0001f600 passwd=short " * n + "end"
    rule = secrets.RULES[0]
    got = spark.createDataFrame([(text,)], "t string").select(secrets.findings(F.col("t"), rule).alias("f")).first().f
    want = [m.span() for m in re.finditer(rule[2], text) if len(m[1]) >= rule[4]]
    assert [(x.start, x.end) for x in got] == want and len(want) == n
