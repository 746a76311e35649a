import gzip
import os

from pyspark.sql import functions as F

from medallion.operators import bronze
from medallion.sources.ndjson import read_lines

from conftest import lines_df

GOOD = '{"event_id":"e%d","event_type":"x","payload":{}}'


def _file(name, n_bad, n=10):
    return [(("{bad" if i < n_bad else GOOD % i), name) for i in range(n)]


def test_skip_file_ratio(spark):
    rows = _file("f0", 0) + _file("f10", 1) + _file("f20", 2)
    out = bronze.load(lines_df(spark, rows), "2026-01-01 00:00:00")
    counts = {r["_source_file"]: r["count"] for r in out.groupBy("_source_file").count().collect()}
    assert counts == {"f0": 10, "f10": 9}


def test_one_value_per_line(spark):
    rows = [
        ('{"a":1} junk', "f"),
        ('{"a":1}{"b":2}', "f"),
        ('{"a":1}] junk', "f"),
        ('{"a":1}][', "f"),
        ('{"a":1}]{"b":2}', "f"),
        ('{"a":1,"a":2}', "f"),
        ("[1,2,3]", "f"),
        ('{"a":1}', "f"),
        ("   ", "f"),
    ]
    parsed = bronze.parse_lines(lines_df(spark, rows))
    bad = [r["_bad"] for r in parsed.collect()]
    assert len(bad) == 8  # blank line dropped before the gate
    assert bad == [True] * 6 + [False] * 2


def test_invalid_utf8_and_gzip(spark, tmp):
    d = os.path.join(tmp, "events")
    os.makedirs(d)
    with open(os.path.join(d, "a.ndjson"), "wb") as f:
        f.write(b'{"event_id":"u1","v":"\xff\xfe"}\n' + (GOOD % 1).encode())
    with gzip.open(os.path.join(d, "b.ndjson.gz"), "wb") as f:
        f.write("\n".join(GOOD % i for i in range(3)).encode())
    lines = read_lines(spark, d)
    rep = {os.path.basename(r["_source_file"]): r for r in bronze.file_report(bronze.parse_lines(lines)).collect()}
    assert rep["a.ndjson"]["bad_lines"] == 1 and rep["a.ndjson"]["loaded"] is False
    assert rep["b.ndjson.gz"]["total_lines"] == 3 and rep["b.ndjson.gz"]["loaded"] is True


def test_bronze_columns_and_write(spark, tmp):
    out = bronze.load(lines_df(spark, _file("f", 0, 4)), "2026-01-01 00:00:00")
    assert out.columns == ["raw_data", "_source_file", "_ingested_at"]
    path = os.path.join(tmp, "bronze")
    bronze.write_load(out, path, "l1")
    bronze.write_load(out, path, "l1")  # replay of the same load: no duplicates
    back = bronze.read(spark, path)
    assert back.count() == 4
    # unknown event types share one bounded directory
    assert back.where(F.col("_event_type") == "_other").count() == 4


def test_gate_never_shuffles_lines(spark):
    """The file statistics are partially aggregated; with a known file count
    the accepted list is broadcast and the lines stay where they were read."""
    rows = _file("big", 1, 300) + _file("small", 0, 5)
    out = bronze.load(lines_df(spark, rows), "2026-01-01 00:00:00", max_files=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "partial_count" in plan
    assert out.count() == 299 + 5


def test_duplicate_keys_stay_bad_even_if_session_allows_them(spark):
    from medallion.session import apply_conf

    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        apply_conf(spark)  # the library's session defaults pin the semantics
        bad = bronze.parse_lines(lines_df(spark, [('{"a":1,"a":2}', "f")])).collect()[0]["_bad"]
    finally:
        apply_conf(spark)
    assert bad is True


def test_a_load_run_again_replaces_all_its_event_types(spark, tmp):
    path = os.path.join(tmp, "again")
    kinds = ['{"event_id":"1","event_type":"%s"}' % t for t in bronze.KNOWN_EVENT_TYPES[:2]]
    for lines in (kinds, kinds[:1]):
        bronze.write_load(bronze.load(lines_df(spark, [(x, "f") for x in lines]), "2026-01-01 00:00:00"), path, "a")
    assert bronze.read(spark, path).count() == 1


def test_compacting_twice_into_one_id_keeps_all_rows(spark, tmp):
    from medallion import jobs

    path = os.path.join(tmp, "compact")
    for k in range(5):
        bronze.write_load(bronze.load(lines_df(spark, [('{"event_id":"%d"}' % k, "f")]), "2026-01-01 00:00:00"), path, f"l{k}")
        if k > 1:
            jobs.compact_bronze(spark, path, "c", keep_recent=1)
    assert bronze.read(spark, path).count() == 5


def test_silver_replay_refresh_and_null_ids(spark, tmp):
    from medallion import jobs
    from medallion.streaming.silver_stream import read_silver, upkeep_batch

    path, silver = os.path.join(tmp, "b"), os.path.join(tmp, "s")
    lines = [('{"event_id":%s,"event_type":"%s"}' % (i, bronze.KNOWN_EVENT_TYPES[0]), "f") for i in ('"1"', '"2"', "null")]
    name = list(bronze.SILVER_SPECS)[0]
    for day in ("2026-01-01", "2026-01-02"):  # the attempt after midnight has another load time
        bronze.write_load(bronze.load(lines_df(spark, lines), f"{day} 00:00:00"), path, "a")
        upkeep_batch(bronze.read(spark, path), 0, silver, [name])
    n = read_silver(spark, silver, name).count()
    assert n == 3
    upkeep_batch(bronze.read(spark, path), 1, silver, [name])  # redelivered, the null id too
    assert read_silver(spark, silver, name).count() == n
    jobs.refresh_silver(spark, path, silver)
    upkeep_batch(bronze.read(spark, path), 2, silver, [name])
    assert read_silver(spark, silver, name).count() == n


def test_a_load_is_read_from_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for load_id in ("a", "b"):
        lines = spark.createDataFrame([(f'{{"event_id":"{load_id}","event_type":"order_created"}}', "f")], "value string, _source_file string")
        bronze.load_and_write(lines, path, load_id)
    one = bronze.read_load(spark, path, "b")
    assert all("/_load=b/" in f for f in one.inputFiles())
    assert [(r._load, r._event_type) for r in one.select("_load", "_event_type").collect()] == [("b", "order_created")]
