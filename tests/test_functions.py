import datetime as dt

from pyspark.sql import functions as F

from medallion.functions import (
    date_key,
    day_boundaries,
    day_of_week_sunday0,
    hour_boundaries,
    padded_name,
    strict_greatest,
    surrogate_key,
)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_boundaries_not_elapsed(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 23:59:00"), ts("2024-01-02 00:01:00")),
         (ts("2024-01-01 10:59:00"), ts("2024-01-01 11:01:00")),
         (ts("2024-01-01 10:00:00"), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    r = df.select(day_boundaries("a", "b").alias("d"), hour_boundaries("a", "b").alias("h")).collect()
    assert (r[0].d, r[0].h) == (1, 1)
    assert (r[1].d, r[1].h) == (0, 1)
    assert (r[2].d, r[2].h) == (None, None)


def test_date_key_and_calendar_traps(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 7),), (dt.date(2024, 12, 30),), (dt.date(2024, 2, 29),), (None,)], "d date"
    )
    r = df.select(
        date_key("d").alias("k"),
        day_of_week_sunday0("d").alias("dow"),
        F.weekofyear("d").alias("w"),
        (F.col("d") == F.last_day("d")).alias("last"),
        padded_name("d", "EEEE").alias("day"),
        padded_name("d", "MMMM").alias("mon"),
    ).collect()
    assert r[0].k == 20240107 and r[0].dow == 0 and r[0].day == "Sunday   "
    assert r[1].w == 1
    assert r[2].last is True and r[2].mon == "February "
    assert r[3].k is None


def test_strict_greatest_is_null_when_any_null(spark):
    df = spark.createDataFrame([(1, 2, 3), (None, 5, 6)], "a int, b int, c int")
    r = df.select(strict_greatest(F.col("a"), F.col("b"), F.col("c")).alias("g")).collect()
    assert [x.g for x in r] == [3, None]


def test_surrogate_key_md5(spark):
    df = spark.createDataFrame([("abc",), (None,)], "k string")
    r = df.select(surrogate_key("k").alias("sk")).collect()
    assert r[0].sk == "900150983cd24fb0d6963f7d28e17f72"
    assert r[1].sk is None


def test_sizing_scales_with_input():
    from medallion.session import sizing

    small = sizing(10 * 1024**3, 64)
    big = sizing(100 * 1024**4, 8000)  # 100 TB on 1000 executors x 8 cores
    assert int(small["spark.sql.shuffle.partitions"]) == 64  # one wave
    parts = int(big["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100_000 <= parts <= 200_000
    assert big["spark.sql.files.maxPartitionBytes"] == "512m"


def test_boundaries_do_not_depend_on_session_time_zone(spark):
    df = spark.createDataFrame(
        [(ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00"), ts("2024-03-09 23:59:00"))],
        "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz",
    )
    q = df.select(hour_boundaries("a", "b").alias("h"), date_key("c").alias("k"),
                  day_boundaries("c", "a").alias("d"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST starts 2024-03-10 02:00
        r1 = q.collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    r2 = q.collect()[0]
    assert tuple(r1) == tuple(r2) == (2, 20240309, 1)
