"""A stored step of the operators leaves its rows on disk, not the shuffles that made them."""

import glob

from pyspark.sql import functions as F

from medallion.llm import _blocks, _repeats, suffixes
from medallion.llm._blocks import written
from tests.llm.test_operators import text

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_a_stored_step_drops_its_shuffles(spark):
    spark.conf.set(CLEANUP, "false")
    before = shuffles(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stored = written(rows.join(spark.range(5).withColumnRenamed("id", "k").hint("merge"), "k"), "few")
    assert {(r.k, r.n) for r in stored.collect()} == {(k, 143) for k in range(5)}
    assert not shuffles(spark) - before
    assert spark.conf.get(CLEANUP) == "false"


def test_super_windows_travel_without_derived_columns(spark, monkeypatch):
    seen = {}

    def kept(df, column, size, make, schema, plain=_blocks.map_blocks):
        seen.setdefault("schema", schema)
        return plain(df, column, size, make, schema)

    monkeypatch.setattr(_repeats, "map_blocks", kept)
    docs = spark.createDataFrame([(1, text(0, 80)), (2, text(0, 80) + " b")], "doc_id long, text string")
    assert all(r.n_removed for r in suffixes.remove_repeats(docs, ["doc_id"]).collect())
    assert "place" not in seen["schema"]
