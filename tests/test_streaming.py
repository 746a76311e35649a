import os

from pyspark.sql import functions as F

from medallion.operators import bronze, silver
from medallion.sources.fixtures import write_landing
from medallion.streaming import run_available_now, start_bronze_stream, start_silver_stream, upkeep_batch
from medallion.streaming.silver_stream import read_silver

from conftest import env, lines_df


def oc(eid):
    return env(eid, "order_created", "2026-05-02T12:00:10Z",
               {"order_id": "o" + eid, "customer_id": "c", "amount": 1.5, "currency": "BRL", "item_count": 1})


def test_stream_matches_batch_with_redelivery_and_bad_file(spark, tmp):
    landing, bpath, sroot = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver"))
    first = [(oc(f"e{i}"), "events/a.ndjson") for i in range(10)]
    first += [(oc(f"e{i}") if i < 7 else "{broken", "events/bad.ndjson") for i in range(10, 20)]
    second = [(oc("e1"), "events/retry.ndjson"), (oc("e2"), "events/retry.ndjson"), (oc("e99"), "events/retry.ndjson")]
    for rows in (first, second):
        write_landing(lines_df(spark, rows), landing)
        run_available_now(lambda t: start_bronze_stream(spark, landing, bpath, os.path.join(tmp, "c1"), trigger=t))
        run_available_now(lambda t: start_silver_stream(spark, bpath, sroot, os.path.join(tmp, "c2"), trigger=t,
                                                        names=["orders_created"]))
    # each file loaded once: 10 good lines of a.ndjson, bad.ndjson skipped whole,
    # 3 lines of the redelivery file (the second run saw only the new file)
    assert bronze.read(spark, bpath).count() == 13
    got = sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect())
    assert got == sorted([f"e{i}" for i in range(10)] + ["e99"])  # bad file (30 %) skipped whole
    # the batch full refresh over the same Bronze gives the same ids
    batch = silver.build(bronze.read(spark, bpath), "orders_created")
    assert sorted(r.event_id for r in batch.collect()) == got


def test_replayed_batch_is_idempotent(spark, tmp):
    sroot = os.path.join(tmp, "silver")
    b1 = bronze.load(lines_df(spark, [(oc("e1"), "f1"), (oc("e2"), "f1")]), "2026-01-01 00:00:00")
    b2 = bronze.load(lines_df(spark, [(oc("e2"), "f2"), (oc("e3"), "f2")]), "2026-01-01 01:00:00")
    upkeep_batch(b1, 1, sroot, ["orders_created"])
    upkeep_batch(b2, 2, sroot, ["orders_created"])
    upkeep_batch(b2, 2, sroot, ["orders_created"])  # replay
    rows = read_silver(spark, sroot, "orders_created").collect()
    assert sorted(r.event_id for r in rows) == ["e1", "e2", "e3"]
    e2 = [r for r in rows if r.event_id == "e2"][0]
    assert e2._source_file == "f1"
    # bounded probe: horizon in days over the ingest-date partitions
    upkeep_batch(b2, 3, sroot, ["orders_created"], horizon_days=7)
    assert read_silver(spark, sroot, "orders_created").count() == 3
    assert F


def test_bounded_keep_first_equals_the_refresh_within_its_horizon(spark, tmp):
    from medallion import snapshots
    from medallion.streaming.silver_stream import start_silver_stream_within_watermark

    bpath, sroot = os.path.join(tmp, "bronze"), os.path.join(tmp, "silver")
    loads = [
        ("2026-01-01", [("e1", "f1"), ("e2", "f1")]),
        # two loads reach the stream in one batch: copies of e3 in both, and twice in one of them
        ("2026-01-03", [("e3", "f3"), ("e3", "f2"), ("e2", "f2")]),
        ("2026-01-02", [("e3", "f9"), ("e4", "f9"), ("e4", "f8")]),
        ("2026-01-07", [("e1", "f5"), ("e5", "f5")]),
    ]
    for i, (day, rows) in enumerate(loads):
        bronze.write_load(bronze.load(lines_df(spark, [(oc(e), f) for e, f in rows]), f"{day} 00:00:00"), bpath, f"l{i}")
        if i != 1:
            run_available_now(lambda t: start_silver_stream_within_watermark(spark, bpath, sroot, os.path.join(tmp, "ck"), "orders_created", trigger=t))
    kept = sorted((r.event_id, r._source_file) for r in read_silver(spark, sroot, "orders_created").collect())
    want = silver.build(bronze.read(spark, bpath), "orders_created")
    assert kept == sorted((r.event_id, r._source_file) for r in want.collect())
    assert kept == [("e1", "f1"), ("e2", "f1"), ("e3", "f9"), ("e4", "f8"), ("e5", "f5")]
    # beyond the horizon the ids go, and a copy comes in again
    bronze.write_load(bronze.load(lines_df(spark, [(oc("e1"), "f6"), (oc("e5"), "f6")]), "2026-01-13 00:00:00"), bpath, "late")
    run_available_now(lambda t: start_silver_stream_within_watermark(spark, bpath, sroot, os.path.join(tmp, "ck"), "orders_created", trigger=t))
    assert sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect()) == ["e1", "e1", "e2", "e3", "e4", "e5"]
    segments = snapshots.current(spark, os.path.join(sroot, "dt_orders_created")).of("ids")
    assert len(segments) == 2 and all(e.info["until"] >= "2026-01-06" for e in segments)


def test_processing_time_trigger_keeps_running(spark, tmp):
    from medallion.streaming import start_ingest_stream

    landing, sroot = os.path.join(tmp, "landing"), os.path.join(tmp, "silver")
    os.makedirs(landing)
    q = start_ingest_stream(spark, landing, os.path.join(tmp, "bronze"), sroot, os.path.join(tmp, "ck"), trigger={"processingTime": "1 second"})
    try:
        for k in range(2):
            write_landing(lines_df(spark, [(oc(f"e{k}"), f"events/{k}.ndjson"), (oc("e0"), f"events/{k}.ndjson")]), landing)
            q.processAllAvailable()
            assert sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect()) == [f"e{i}" for i in range(k + 1)]
    finally:
        q.stop()


def test_chained_ingest_stream_with_archive(spark, tmp):
    from medallion.streaming import start_ingest_stream

    landing, bpath, sroot, arch = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver", "archive"))
    first = [(oc(f"e{i}"), "events/a.ndjson") for i in range(5)]
    second = [(oc("e1"), "events/retry.ndjson"), (oc("e7"), "events/retry.ndjson")]
    for rows in (first, second):
        write_landing(lines_df(spark, rows), landing)
        run_available_now(lambda t: start_ingest_stream(
            spark, landing, bpath, sroot, os.path.join(tmp, "ck"), trigger=t,
            clean_source="archive", archive_dir=arch))
    got = sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect())
    assert got == ["e0", "e1", "e2", "e3", "e4", "e7"]
    assert bronze.read(spark, bpath).count() == 7
