import os
import threading

import pytest

from medallion import snapshots
from medallion.operators import bronze, ledger, silver
from medallion.sources.fixtures import write_landing
from medallion.streaming import run_available_now, start_bronze_stream, start_ingest_stream, start_silver_stream, upkeep_batch
from medallion.streaming import silver_stream
from medallion.streaming.silver_stream import read_silver

from conftest import env, lines_df

NAME = "orders_created"


def oc(eid):
    return env(eid, "order_created", "2026-05-02T12:00:10Z", {"order_id": "o" + eid, "customer_id": "c", "amount": 1.5, "currency": "BRL", "item_count": 1})


def landed(spark, folder, ids, file="events/a.ndjson"):
    write_landing(lines_df(spark, [(oc(i), file) for i in ids]), folder)


def ids_of(spark, sroot):
    return sorted(r.event_id for r in read_silver(spark, sroot, NAME).collect())


def rows_of(spark, path):
    return spark.createDataFrame([(x,) for x in path], "event_id string")


def test_two_streams_on_one_root_keep_all_rows(spark, tmp):
    b, s = os.path.join(tmp, "b"), os.path.join(tmp, "s")
    for k, ids in (("1", ["e1", "e2"]), ("2", ["e2", "e3"])):
        landed(spark, os.path.join(tmp, "l" + k), ids, f"events/{k}.ndjson")
        run_available_now(lambda t: start_ingest_stream(spark, os.path.join(tmp, "l" + k), b, s, os.path.join(tmp, "ck" + k), trigger=t))
    assert bronze.read(spark, b).count() == 4
    assert ids_of(spark, s) == ["e1", "e2", "e3"]


def test_a_fresh_checkpoint_erases_nothing(spark, tmp):
    l, b, s, arch = (os.path.join(tmp, x) for x in ("l", "b", "s", "arch"))
    for k, ids in ((1, ["e1"]), (2, ["e2"]), (3, ["e1", "e3"])):
        landed(spark, l, ids, f"events/{k}.ndjson")
        run_available_now(lambda t: start_ingest_stream(spark, l, b, s, os.path.join(tmp, f"ck{k}"), trigger=t, clean_source="archive", archive_dir=arch))
    assert {"e1", "e2", "e3"} == set(ids_of(spark, s)) and len(ids_of(spark, s)) == 3
    # the same checkpoint goes on under its own id
    assert snapshots.stream_id(spark, os.path.join(tmp, "ck1")) == snapshots.stream_id(spark, os.path.join(tmp, "ck1") + "/")
    assert snapshots.stream_id(spark, os.path.join(tmp, "ck1")) != snapshots.stream_id(spark, os.path.join(tmp, "ck2"))


def test_bronze_streams_with_one_prefix_and_silver_from_versions(spark, tmp):
    b, s = os.path.join(tmp, "b"), os.path.join(tmp, "s")
    for k in "12":
        landed(spark, os.path.join(tmp, "l" + k), ["x", "y" + k], f"events/{k}.ndjson")
        run_available_now(lambda t: start_bronze_stream(spark, os.path.join(tmp, "l" + k), b, os.path.join(tmp, "ck" + k), trigger=t))
        run_available_now(lambda t: start_silver_stream(spark, b, s, os.path.join(tmp, "cks"), trigger=t, names=[NAME]))
    assert ids_of(spark, s) == ["x", "y1", "y2"]
    table = os.path.join(s, "dt_orders_created")
    stream = snapshots.stream_id(spark, os.path.join(tmp, "cks"))
    assert snapshots.current(spark, table).progress[stream]["to"] == snapshots.current(spark, b).version == 3
    # a second Silver stream, with a table that the first one hasn't kept, starts from the beginning
    run_available_now(lambda t: start_silver_stream(spark, b, s, os.path.join(tmp, "cks2"), trigger=t, names=[NAME, "customers_registered"]))
    assert ids_of(spark, s) == ["x", "y1", "y2"]
    # compacted loads that were read aren't read again; unread ones are, from the compaction
    now = snapshots.Snapshot(b, 9, (snapshots.Entry("c", info={"covers": 2}, version=8), snapshots.Entry("n", version=9)))
    assert [e.folder for e in silver_stream.unread_loads(now, 2)] == ["n"]
    assert [e.folder for e in silver_stream.unread_loads(now, 1)] == ["c", "n"]


def test_a_load_id_of_another_stream_is_refused(spark, tmp):
    b = bronze.load(lines_df(spark, [(oc("e1"), "f")]), "2026-01-01 00:00:00")
    bronze.write_load(b, tmp + "/b", "l1", stream="one")
    with pytest.raises(ValueError):
        bronze.write_load(b, tmp + "/b", "l1", stream="two")
    bronze.write_load(b, tmp + "/b", "l1", stream="one")
    assert bronze.read(spark, tmp + "/b").count() == 1


def test_staged_load_parses_once_and_leaves_no_stage(spark, tmp):
    good, bad = [(oc(f"e{i}"), "f1") for i in range(9)], [("{", "f2"), (oc("z"), "f2"), ("{", "f1")]
    bronze.load_and_write(lines_df(spark, good + bad), tmp + "/b", "l0", "2026-01-01 00:00:00")  # f2 is rejected: copied
    bronze.load_and_write(lines_df(spark, good + bad[2:]), tmp + "/b", "l1", "2026-01-01 00:00:00")  # none is: moved
    back = bronze.read(spark, tmp + "/b")
    assert sorted((r["_load"], r["count"]) for r in back.groupBy("_load").count().collect()) == [("l0", 9), ("l1", 9)]
    assert back.where("_event_type = '_bad' or raw_data is null").count() == 0
    assert os.listdir(tmp + "/b/_staged") == []
    with pytest.raises(FileNotFoundError):
        bronze.read(spark, tmp + "/none")


def test_versions_are_never_overwritten_and_changes_are_repeated(spark, tmp):
    assert snapshots.create_text(spark, tmp + "/t/a", "1") and not snapshots.create_text(spark, tmp + "/t/a", "2")
    assert snapshots.read_text(spark, tmp + "/t/a") == "1"

    def add(k):
        snapshots.publish(spark, tmp + "/r", lambda now: snapshots.replacing(now, k, k, [snapshots.Entry(f"f={k}", stream=k, batch=k)]))

    threads = [threading.Thread(target=add, args=(f"w{i}",)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    now = snapshots.current(spark, tmp + "/r")
    assert now.version == 13 and {e.batch for e in now.of()} == {f"w{i}" for i in range(12)}
    assert sorted(e.version for e in now.of()) == list(range(2, 14))
    with pytest.raises(snapshots.Overtaken):
        snapshots.publish(spark, tmp + "/r", lambda v: snapshots.swapping(v, [snapshots.Entry("gone")], []))
    assert snapshots.at_version(spark, tmp + "/r", 3).version == 3
    assert snapshots.expire(spark, tmp + "/r", 2) == [] and snapshots.current(spark, tmp + "/r") == now


def test_a_folder_that_is_being_written_is_no_older_table(spark, tmp):
    from medallion import jobs

    snapshots.begin(spark, tmp + "/r")
    os.makedirs(tmp + "/r/_batch=mine/_try=0")
    assert snapshots.current(spark, tmp + "/r").entries == ()
    bronze.load_and_write(lines_df(spark, [(oc("e1"), "f")]), tmp + "/b", "l0", "2026-01-01 00:00:00")
    jobs.refresh_silver(spark, tmp + "/b", tmp + "/s")
    assert ids_of(spark, tmp + "/s") == ["e1"]
    assert [e.kind for e in snapshots.current(spark, tmp + "/s/dt_orders_created").entries] == ["rows", "ids"]


def test_a_batch_that_is_overtaken_looks_again(spark, tmp, monkeypatch):
    def b(ids, at):
        return bronze.load(lines_df(spark, [(oc(i), "f" + at) for i in ids]), at)

    upkeep_batch(b(["e1"], "2026-01-01 00:00:00"), 0, tmp, [NAME], stream="a")
    whole = silver_stream.id_segment
    raced = []

    def while_writing(*args, **kw):
        out = whole(*args, **kw)
        if not raced:
            raced.append(1)
            upkeep_batch(b(["e2", "e3"], "2026-01-01 01:00:00"), 0, tmp, [NAME], stream="b")
        return out

    monkeypatch.setattr(silver_stream, "id_segment", while_writing)
    upkeep_batch(b(["e1", "e2", "e4"], "2026-01-01 02:00:00"), 1, tmp, [NAME], stream="a")
    assert ids_of(spark, tmp) == ["e1", "e2", "e3", "e4"]


def test_a_reader_during_refresh_build_and_upkeep_has_one_version(spark, tmp, monkeypatch):
    from medallion import jobs, materialize

    b, s, g = (os.path.join(tmp, x) for x in "bsg")
    bronze.load_and_write(lines_df(spark, [(oc("e1"), "f")]), b, "l0", "2026-01-01 00:00:00")
    jobs.refresh_silver(spark, b, s)
    jobs.build(spark, s, g)
    bronze.load_and_write(lines_df(spark, [(oc("e2"), "f")]), b, "l1", "2026-01-02 00:00:00")
    publish, seen = snapshots.publish, []

    def reading_before(spark_, root, change):
        if "dt_orders_created" in root:
            seen.append(("silver", ids_of(spark, s)))
        if root == g:
            seen.append(("gold", materialize.read_gold(spark, g, "fct_orders").count(), materialize.read_gold(spark, g, "mart_order_funnel").first().orders_count))
        return publish(spark_, root, change)

    monkeypatch.setattr(snapshots, "publish", reading_before)
    jobs.refresh_silver(spark, b, s)
    jobs.build(spark, s, g)
    assert seen == [("silver", ["e1"]), ("gold", 1, 1)]
    assert ids_of(spark, s) == ["e1", "e2"] and materialize.read_gold(spark, g, "fct_orders").count() == 2
    # a build that fails its tests isn't published when they are required: 2026 is outside this calendar
    report = jobs.build(spark, s, g, calendar=("1995-01-01", "1995-12-31"), require_pass=True)
    assert report.where("failures > 0").count() > 0
    assert materialize.read_gold(spark, g, "dim_date").count() > 366
    with pytest.raises(KeyError):
        materialize.read_gold(spark, g, "no_table")


def test_refresh_starts_over_when_a_batch_comes_in(spark, tmp, monkeypatch):
    from medallion import jobs

    b, s = os.path.join(tmp, "b"), os.path.join(tmp, "s")
    bronze.load_and_write(lines_df(spark, [(oc("e1"), "f")]), b, "l0", "2026-01-01 00:00:00")
    build, raced = silver.build, []

    def racing(rows, name, strict=True):
        out = build(rows, name, strict)
        if name == NAME and not raced:
            raced.append(1)
            bronze.load_and_write(lines_df(spark, [(oc("e2"), "f")]), b, "l1", "2026-01-02 00:00:00")
            upkeep_batch(bronze.read_load(spark, b, "l1"), 0, s, [NAME], stream="a")
        return out

    monkeypatch.setattr(silver, "build", racing)
    jobs.refresh_silver(spark, b, s)
    assert ids_of(spark, s) == ["e1", "e2"]


def test_tables_without_versions_are_adopted(spark, tmp):
    old = silver.build(bronze.load(lines_df(spark, [(oc("e1"), "f"), (oc("e2"), "f")]), "2026-01-01 00:00:00"), NAME)
    old.write.parquet(f"{tmp}/dt_orders_created/_batch=000000000000")
    assert ids_of(spark, tmp) == ["e1", "e2"]
    upkeep_batch(bronze.load(lines_df(spark, [(oc("e2"), "g"), (oc("e3"), "g")]), "2026-01-02 00:00:00"), 7, tmp, [NAME], stream="a")
    assert ids_of(spark, tmp) == ["e1", "e2", "e3"]
    plain = f"{tmp}/plain/dt_orders_created"
    old.write.parquet(plain)
    assert ids_of(spark, f"{tmp}/plain") == ["e1", "e2"]


def test_ledger_against_sets(spark, tmp, monkeypatch):
    monkeypatch.setattr(ledger, "IDS_PER_BUCKET", 50)
    monkeypatch.setattr(ledger, "UNFILTERED", 1)
    history = [[f"id-{k}-{i}" for i in range(n)] for k, n in enumerate((400, 30, 1, 0))] + [[None, "x"]]
    segments = []
    for k, ids in enumerate(history):
        segments.append((f"{tmp}/{k}", ledger.write_segment(rows_of(spark, ids), f"{tmp}/{k}")))
    assert [x["buckets"] for _, x in segments] == [8, 1, 1, 1, 1]
    asked = ["id-0-3", "id-0-399", "id-1-0", "new-1", "new-2", None, "id-2-0", "id-0-400"]
    for limit in (10**6, 0):  # broadcast, and shuffled
        monkeypatch.setattr(ledger, "BROADCAST_IDS", limit)
        found, passed = ledger.known(rows_of(spark, asked), segments)
        assert {r[0] for r in found.collect()} == {"id-0-3", "id-0-399", "id-1-0", None, "id-2-0"}
        passed.unpersist()
    one = (f"{tmp}/m", ledger.merged(spark, segments, f"{tmp}/m"))
    assert one[1]["ids"] == 433
    assert ledger.merged(spark, [segments[3]] * 3, f"{tmp}/none")["ids"] == 0
    found, _ = ledger.known(rows_of(spark, [x for ids in history for x in ids]), [one])
    assert found.count() == 433
    assert ledger.known(rows_of(spark, ["a"]), []) == (None, None)
    assert ledger.known(rows_of(spark, []), [one])[0] is None
    monkeypatch.setattr(ledger, "UNFILTERED", 500)  # without a filter: the same answer
    plain = (f"{tmp}/p", ledger.merged(spark, segments, f"{tmp}/p"))
    assert plain[1] == {"ids": 433, "buckets": 1, "blocks": 0, "empty": []}
    found, passed = ledger.known(rows_of(spark, asked), [plain, segments[1]])
    assert {r[0] for r in found.collect()} == {"id-0-3", "id-0-399", "id-1-0", None, "id-2-0"}
    assert ledger.due([1] * 8 + [70, 5]) == [list(range(8)) + [9]] and ledger.due([1] * 7) == []


def test_few_new_ids_pass_the_bloom_filter(spark, tmp):
    segment = (f"{tmp}/s", ledger.write_segment(spark.range(20_000).selectExpr("cast(id as string) as event_id"), f"{tmp}/s"))
    _, passed = ledger.known(spark.range(20_000, 40_000).selectExpr("cast(id as string) as event_id"), [segment])
    assert passed.count() < 800


def test_a_batch_reads_only_the_buckets_it_can_hit(spark, tmp, monkeypatch):
    monkeypatch.setattr(ledger, "IDS_PER_BUCKET", 100)
    segment = (f"{tmp}/s", ledger.write_segment(spark.range(5_000).selectExpr("cast(id as string) as event_id"), f"{tmp}/s"))
    found, _ = ledger.known(rows_of(spark, ["17", "4711"]), [segment])
    files = {f for f in found.inputFiles()}
    assert found.count() == 2 and 1 <= len(files) <= 2 * 2


def test_merged_segments_keep_replays_exact(spark, tmp, monkeypatch):
    monkeypatch.setattr(ledger, "FANOUT", 3)
    for i in range(7):
        upkeep_batch(bronze.load(lines_df(spark, [(oc(f"e{i}"), "f"), (oc(f"e{i - 1}"), "f")]), f"2026-01-0{i + 1} 00:00:00"), i, tmp, [NAME], stream="a")
    now = snapshots.current(spark, f"{tmp}/dt_orders_created")
    assert len(now.of()) == 7 and len(now.of("ids")) < 7
    before = ids_of(spark, tmp)
    assert before == sorted(f"e{i}" for i in range(-1, 7))
    for i in (6, 2):  # the last batch, and one whose ids are part of a merged segment
        upkeep_batch(bronze.load(lines_df(spark, [(oc(f"e{i}"), "f"), (oc(f"e{i - 1}"), "f")]), f"2026-01-0{i + 1} 00:00:00"), i, tmp, [NAME], stream="a")
        assert ids_of(spark, tmp) == before
