"""Landed lines take little disk, and what a batch has stored leaves no shuffles behind (r04 F1);
compaction copies each event type as it lies (r04 F2)."""

import glob
import os
from pathlib import Path

from medallion.operators import bronze
from medallion.session import CLEANUP, shuffles_dropped
from medallion.sources.fixtures import logical_file, write_landing
from medallion.sources.ndjson import read_lines
from medallion.streaming import upkeep_batch
from medallion.streaming.silver_stream import read_silver

from conftest import env, lines_df


def shuffles(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def order(i):
    return env(f"e{i}", "order_created", "2026-05-02T12:00:10Z",
               {"order_id": f"o{i}", "customer_id": "c", "amount": 1.5, "currency": "BRL", "item_count": 1})


def test_landed_files_are_compressed_one_a_logical_file(spark, tmp):
    rows = [(order(i), f"events/{i % 3}.ndjson") for i in range(3000)] + [("{broken", "events/0.ndjson")]
    before = shuffles(spark)
    write_landing(lines_df(spark, rows), tmp)
    assert not shuffles(spark) - before
    files = [p for p in Path(tmp).rglob("part-*")]
    assert len(files) == 3
    assert sum(p.stat().st_size for p in files) < sum(len(v) + 1 for v, _ in rows) / 5
    read = read_lines(spark, tmp).select("value", logical_file("_source_file").alias("_source_file"))
    assert sorted(map(tuple, read.collect())) == sorted(rows)


def test_a_batch_leaves_no_shuffles(spark, tmp):
    path, silver_root = os.path.join(tmp, "bronze"), os.path.join(tmp, "silver")
    spark.conf.set(CLEANUP, "false")
    for batch in range(2):
        before = shuffles(spark)
        rows = lines_df(spark, [(order(i), "f") for i in range(batch * 5, batch * 5 + 20)]).repartition(3)
        bronze.load_and_write(rows, path, f"d{batch}", "2026-01-01 00:00:00")
        left = shuffles(spark) - before
        upkeep_batch(bronze.read_load(spark, path, f"d{batch}"), batch, silver_root, ["orders_created"])
        # the second batch keeps what the lookups of its persisted ids may be asked for again
        assert batch or not shuffles(spark) - before - left
        assert spark.conf.get(CLEANUP) == "false"
    assert read_silver(spark, silver_root, "orders_created").count() == 25


def test_shuffles_dropped_may_be_nested(spark):
    spark.conf.set(CLEANUP, "false")
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == "false"


def _bronze_rows(spark, path, **kinds):
    line = lambda kind, i: env(f"{kind}-{i}", kind, "2026-05-02T12:00:10Z", {"order_id": f"o{i}"})
    for n, (kind, count) in enumerate(kinds.items()):
        rows = [(line(kind, i), "f") for i in range(count)] + [(line("order_created", 100 + n), "f"), ("{broken", "bad")]
        bronze.load_and_write(lines_df(spark, rows).repartition(2), path, f"d{n}", "2026-01-01 00:00:00")


def _counts(spark, path):
    return dict(bronze.read(spark, path).groupBy("_event_type").count().collect())


def test_bronze_is_compacted_without_sorting_by_type(spark, tmp, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from medallion import jobs

    written, plain = [], DataFrameWriter.parquet

    def watched(self, path, *args, **kwargs):
        written.append(path)
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    path = os.path.join(tmp, "bronze")
    _bronze_rows(spark, path, click=12, order_created=5, customer_updated=7)
    want = {"_other": 12, "order_created": 8, "customer_updated": 7}
    assert _counts(spark, path) == want
    written.clear()
    assert jobs.compact_bronze(spark, path, "c", keep_recent=1) == ["d0", "d1"]
    # a job for each type: none sorts rows to deal them to folders
    assert sorted(p.rsplit("/", 1)[1] for p in written) == ["_event_type=_other", "_event_type=order_created"]
    assert _counts(spark, path) == want
    assert jobs.compact_bronze(spark, path, "c", keep_recent=0)
    assert _counts(spark, path) == want


def test_compacting_loads_without_rows(spark, tmp):
    from medallion import jobs

    path = os.path.join(tmp, "bronze")
    for n in range(2):
        bronze.load_and_write(lines_df(spark, [("{broken", "bad")]), path, f"d{n}", "2026-01-01 00:00:00")
    assert jobs.compact_bronze(spark, path, "c", keep_recent=0) == ["d0", "d1"]
    assert bronze.read(spark, path).count() == 0
