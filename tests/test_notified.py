import json
import os
import re

import pytest

from medallion import snapshots
from medallion.operators import bronze
from medallion.sources.ndjson import publish_events
from medallion.streaming import run_available_now, start_notified_stream
from medallion.streaming.silver_stream import read_silver

from conftest import env


def oc(eid):
    return env(eid, "order_created", "2026-05-02T12:00:10Z", {"order_id": "o" + eid, "customer_id": "c", "amount": 1.5, "currency": "BRL", "item_count": 1})


def published(spark, tmp, ids, parts=1, notify=True):
    rows = spark.createDataFrame([(oc(i),) for i in ids], "value string").repartition(parts)
    return publish_events(rows, tmp + "/landing", notify=tmp + "/notes" if notify else None)


def test_names_content_and_empty_input(spark, tmp):
    paths = published(spark, tmp, [f"e{i}" for i in range(20)], parts=3, notify=False)
    assert len(paths) == 3
    for p in paths:
        assert re.fullmatch(r"events-\d{8}-\d{6}-[0-9a-f]{8}\.ndjson", os.path.basename(p)) and "/landing/events/" in p
    lines = [x for p in paths for x in open(p).read().splitlines()]
    assert sorted(json.loads(x)["event_id"] for x in lines) == sorted(f"e{i}" for i in range(20))
    assert all(": " not in x and ", " not in x for x in lines)
    with pytest.raises(ValueError):
        published(spark, tmp, [], notify=False)
    assert sorted(f for f in os.listdir(tmp + "/landing") if not f.startswith(".")) == ["events"]
    assert not os.path.exists(tmp + "/notes")


def test_a_failed_job_publishes_nothing(spark, tmp):
    from pyspark.sql import functions as F

    rows = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("{}")).cast("string").alias("value"))
    with pytest.raises(Exception):
        publish_events(rows, tmp + "/landing")
    assert not os.path.exists(tmp + "/landing/events")


def test_round_trip_through_load_new(spark, tmp):
    from medallion import jobs

    published(spark, tmp, ["a", "b"], notify=False)
    jobs.load_new(spark, tmp + "/landing/events", tmp + "/b")
    published(spark, tmp, ["c"], notify=False)
    jobs.load_new(spark, tmp + "/landing/events", tmp + "/b")
    jobs.load_new(spark, tmp + "/landing/events", tmp + "/b")
    assert bronze.read(spark, tmp + "/b").count() == 3


def run(spark, tmp, checkpoint="ck"):
    run_available_now(lambda t: start_notified_stream(
        spark, tmp + "/notes", tmp + "/landing", tmp + "/b", f"{tmp}/{checkpoint}", silver_root=tmp + "/s", trigger=t))


def test_a_notified_batch_reads_only_the_files_it_names(spark, tmp, monkeypatch):
    published(spark, tmp, [f"old{i}" for i in range(50)], parts=50, notify=False)  # files without a notification
    published(spark, tmp, ["a", "b"])
    from medallion.streaming import bronze_stream

    read, asked = bronze_stream.read_files, []
    monkeypatch.setattr(bronze_stream, "read_files", lambda s, paths: asked.append(paths) or read(s, paths))
    run(spark, tmp)
    assert [len(p) for p in asked] == [1]
    assert sorted(r.event_id for r in read_silver(spark, tmp + "/s", "orders_created").collect()) == ["a", "b"]
    assert bronze.read(spark, tmp + "/b").count() == 2


def test_a_file_that_is_notified_again_is_loaded_once(spark, tmp):
    published(spark, tmp, ["a", "b"])
    note = next(f for f in os.listdir(tmp + "/notes") if f.endswith(".json") and not f.startswith("."))
    text = open(f"{tmp}/notes/{note}").read()
    snapshots.create_text(spark, tmp + "/notes/again.json", text)
    other = json.loads(text)
    noise = [other | {"eventType": "OBJECT_DELETE", "name": "events/gone.ndjson"}, other | {"name": "elsewhere/x.ndjson"}]
    snapshots.create_text(spark, tmp + "/notes/noise.json", "\n".join(map(json.dumps, noise)) + "\nnot json")
    run(spark, tmp)
    snapshots.create_text(spark, tmp + "/notes/later.json", text)
    published(spark, tmp, ["b", "c"])
    run(spark, tmp)
    run(spark, tmp, "fresh")  # another stream with a fresh checkpoint gets all notifications once more
    assert bronze.read(spark, tmp + "/b").count() == 4
    assert sorted(r.event_id for r in read_silver(spark, tmp + "/s", "orders_created").collect()) == ["a", "b", "c"]
