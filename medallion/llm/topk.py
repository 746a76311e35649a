"""Exact top-k search over binary codes (op 5) by incremental multi-index hashing.

A vector's code has one bit for each dimension, its sign. The code is cut into
m segments of nearly equal width, and the index has a row for each segment of each
distinct code. The radius grows segment by segment: step (r, s) looks up, for each
query that is still open, the values at distance r from its own in segment s, and
verifies the Hamming distance of what it meets. After it every code not met differs
from the query by more than r in the segments up to s and by r or more in the
others, so by m r + s + 1 or more (s from 0): a query is closed once its k-th verified
distance is below that. Ties go to the lesser id. While the values at a radius are
few (``AT_ONCE``), its segments are looked up in one step.

Segments have log2(rows / ``BUCKET``) bits, so that a bucket of random codes holds
``BUCKET`` rows at any size. A probe is shuffled, a row that it meets isn't, hence more
than one row a bucket.

A pair that meets in several segments is taken where the segments differ least, at the
first such segment, and so comes out once over all steps without a distinct. A query
that has k verified neighbours takes no farther ones from then on.
Probes are many more than the queries they are made of, which Spark's estimate can't
know: the lookup is a merge join, never a broadcast.

Equal codes are one index row with the k + 1 least ids, equal query codes one
query, so a vector that a third of the rows share costs one row. All work is joins
and grouped limits; only counts of rows and of open queries reach the driver.

A row without id or vector, or a vector without values, is no query and no
neighbour. A query's own id is no neighbour of it. Missing or null values count
as not positive. Repeated rows are one row. With fewer than k other ids all of
them are returned.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm._blocks import written

SEGMENT = 16
WIDEST = 24  # bits of a segment
BUCKET = 4
AT_ONCE = 64
K = 10


def fitting(rows: int) -> int:
    """Bits of a segment for an index of so many rows."""
    return min(WIDEST, max(1, round(math.log2(max(2, rows / BUCKET)))))


def _bounds(bits: int, width: int) -> list[int]:
    m = max(round(bits / width), -(-bits // WIDEST))
    return [bits * i // m for i in range(m + 1)]


def _steps(m: int, widest: int):
    """(radius, first segment, last segment) of each step."""
    for radius in range(widest + 1):
        if math.comb(widest, radius) <= AT_ONCE:
            yield radius, 0, m - 1
        else:
            yield from ((radius, s, s) for s in range(m))


def codes(vectors: DataFrame, id_col: str, vector: str, bits: int, width: int = SEGMENT) -> DataFrame:
    """(id, code): the code as an array of segments of about ``width`` bits."""
    sign = lambda i, at: F.when(F.coalesce(F.try_element_at("v", F.lit(i + 1)), F.lit(0.0)) > 0, 1 << (i - at)).otherwise(0)
    segments, bounds = [], _bounds(bits, width)
    for at, to in zip(bounds[:-1], bounds[1:]):
        total = sign(at, at)
        for i in range(at + 1, to):
            total = total + sign(i, at)
        segments.append(total)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"))
    return rows.where(F.col("id").isNotNull() & (F.size("v") > 0)).select("id", F.array(*segments).alias("code")).distinct()


def flipped(rows: DataFrame, width: int, radius: int) -> DataFrame:
    """Each row with each mask that has ``radius`` of ``width`` bits set: a bit at a time, in rising order,
    so that the plan grows with the radius and no list of masks is written down."""
    rows = rows.withColumn("mask", F.lit(0)).withColumn("_next", F.lit(0))
    for left in range(radius, 0, -1):
        rows = rows.withColumn("_bit", F.explode(F.sequence(F.col("_next"), F.lit(width - left))))
        rows = rows.withColumn("mask", F.expr("mask | shiftleft(1, _bit)")).withColumn("_next", F.col("_bit") + 1).drop("_bit")
    return rows.drop("_next")


def search(index: DataFrame, queries: DataFrame, k: int, bits: int, width: int = SEGMENT) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) of the ``queries`` (id, code) among ``index`` (id, code)."""
    spark = index.sparkSession
    by_code = Window.partitionBy("code").orderBy("id")
    few = index.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k + 1)
    held = written(few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")  # k + 1 ids at most
    index = held.select("code", "ids", F.posexplode("code").alias("segment", "value"))
    asked = written(queries.select("code").distinct().withColumnRenamed("code", "asked"), "asked")
    bounds = _bounds(bits, width)
    m, widest = len(bounds) - 1, max(b - a for a, b in zip(bounds[:-1], bounds[1:]))
    want = min(k + 1, held.select(F.sum(F.size("ids"))).first()[0] or 0)
    # a few queries make many probes: all tasks take part
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    apart = [F.bit_count(F.col("asked")[i].bitwiseXOR(F.col("code")[i])).cast("int") for i in range(m)]
    distance = reduce(add, apart)
    order = Window.partitionBy("asked").orderBy("distance", "id")
    best, open_ = None, asked.withColumn("limit", F.lit(bits))
    for radius, first, last in _steps(m, widest):
        here = F.col("segment").between(first, last)
        probes = open_.repartition(tasks).select("asked", "limit", F.posexplode("asked").alias("segment", "own")).where(here)
        probes = flipped(probes, widest, radius)
        probes = probes.select("asked", "limit", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        met = probes.hint("merge").join(index.where(here), ["segment", "value"]).where(distance <= F.col("limit"))
        for i, part in enumerate(apart):
            met = met.where((part > radius) | ((part == radius) & (F.col("segment") <= i)))
        met = met.select("asked", distance.alias("distance"), F.explode("ids").alias("id"))
        met = met if best is None else met.unionByName(best)
        best = written(met.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"), "best")
        state = best.groupBy("asked").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        full = F.coalesce(F.col("n") >= want, F.lit(False))
        open_ = open_.join(state, "asked", "left").where(~(full & (F.col("far") < m * radius + last + 1)))
        open_ = written(open_.select("asked", F.when(full, F.col("far")).otherwise(F.col("limit")).alias("limit")), "open")
        if open_.isEmpty():
            break
    found = queries.select(F.col("id").alias("query_id"), F.col("code").alias("asked")).join(best, "asked").where("query_id <> id")
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest codes of every row whose id is divisible by 100, among all rows of ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    bits, rows = vectors.select(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    bits, width = max(bits or 1, 1), fitting(rows)
    found = written(codes(vectors, "vec_id", "embedding", bits, width), "vector-codes")
    return search(found, found.where(F.col("id") % 100 == 0), K, bits, width)
