"""Ids that a table has taken in, for exact keep-first at a cost per batch.

A segment holds the ids of one batch, or of several merged ones, in as many hash
buckets as its size asks for (``IDS_PER_BUCKET``), sorted by id, and a Bloom filter of
each bucket in blocks of 512 bits. A new batch is looked up in three steps.

Segments of at most ``UNFILTERED`` ids have no filter and are read whole. In others:

1. its ids meet the Bloom blocks of the buckets they fall in, about 1.4 bytes for each
   stored id of those buckets; ids without all their bits are new;
2. the buckets that are left, and no others, are read (one column, sorted files);
3. the ids are compared themselves, so what comes out is exact for any delay.

``merge`` joins segments of about equal size, so their number grows with the logarithm
of the history and each id is rewritten as often. A null id is an id like others. Everything is
a join or a grouped aggregate on hashes, so hot ids are combined before they move, and the
driver sees only which buckets of which segments were hit.
"""

from __future__ import annotations

from math import ceil

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids of a bucket, and bits of a Bloom block and of it for each id (1 % false hits at about 11).
IDS_PER_BUCKET = 500_000
BLOCK_BITS = 512
BITS_PER_ID = 11
WORDS = BLOCK_BITS // 64
PROBES = 6
# A segment of so few ids is read as it is, without a filter.
UNFILTERED = 4096
# Segments of about equal size that are merged into one.
FANOUT = 8
# Largest batch, in rows and in bytes of ids, that is broadcast to what it is compared with.
BROADCAST_IDS = 1_000_000
BROADCAST_ID_BYTES = 32 << 20


def _hash(event_id: Column) -> Column:
    return F.xxhash64(event_id, F.lit(7))


def _bucket(h: Column, buckets: Column) -> Column:
    return F.pmod(h, buckets).cast("int")


def _block(h: Column, blocks: Column) -> Column:
    # other bits than the bucket's
    return F.pmod(F.shiftrightunsigned(h, 20), blocks).cast("int")


def _bits_sql() -> str:
    """One long for each 64 bits of a block: the bits that an id sets there, at the places
    that ``_placed`` adds. As text: one call to the JVM instead of one for each of some hundred nodes."""
    word = lambda w: " | ".join(f"CASE WHEN shiftright(_p{i}, 6) = {w} THEN shiftleft(1L, _p{i} & 63) ELSE 0L END" for i in range(PROBES))
    return "struct(" + ", ".join(f"{word(w)} AS w{w}" for w in range(WORDS)) + ")"


BITS = _bits_sql()


def _placed(ids: DataFrame) -> DataFrame:
    """``ids`` with the places of each id's bits in its block. They are columns, as an id is hashed
    once then; hashed again in each branch of ``BITS``, the code is too long for the JVM to compile."""
    hashed = ids.withColumn("_g", F.expr("xxhash64(event_id, 8)"))
    return hashed.select(*ids.columns, *(F.expr(f"CAST(shiftrightunsigned(_g, {9 * i}) & {BLOCK_BITS - 1} AS INT) AS _p{i}") for i in range(PROBES)))


def shape(ids: int) -> tuple[int, int]:
    """Buckets of a segment and Bloom blocks of a bucket."""
    buckets = 1 if ids <= UNFILTERED else max(1, ceil(ids / IDS_PER_BUCKET))
    return buckets, max(1, ceil(ids / buckets * BITS_PER_ID / BLOCK_BITS))


def write_segment(ids: DataFrame, path: str, count: int | None = None) -> dict:
    """Write the distinct ``event_id`` of ``ids`` as a segment; returns what a lookup must know of it."""
    count = ids.count() if count is None else count
    if not count:
        return {"ids": 0, "buckets": 1, "blocks": 1, "empty": [0]}
    buckets, blocks = shape(count)
    h = _hash(F.col("event_id"))
    dealt = ids.select("event_id", _bucket(h, F.lit(buckets)).alias("_bucket"))
    # one file for each bucket, sorted
    dealt = dealt.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "event_id")
    dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/ids")
    if count <= UNFILTERED:
        return {"ids": count, "buckets": 1, "blocks": 0, "empty": []}
    bloom = (
        _placed(ids.select("event_id", _bucket(h, F.lit(buckets)).alias("_bucket"), _block(h, F.lit(blocks)).alias("block")))
        .select("_bucket", "block", F.expr(BITS).alias("bits"))
        .groupBy("_bucket", "block")
        .agg(*(F.bit_or(f"bits.w{w}").alias(f"w{w}") for w in range(WORDS)))
    )
    bloom = bloom.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "block")
    bloom.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/bloom")
    there = {0} if buckets == 1 else {r[0] for r in ids.sparkSession.read.schema("_bucket int").parquet(f"{path}/bloom").distinct().collect()}
    return {"ids": count, "buckets": buckets, "blocks": blocks, "empty": sorted(set(range(buckets)) - there)}


def _read(spark: SparkSession, segments: list[tuple[str, dict]], hit: dict[int, list[int]], part: str, schema: str) -> DataFrame | None:
    """Files of the buckets that were hit, in one scan; only their folders are listed."""
    paths = [f"{segments[s][0]}/{part}/_bucket={b}" for s, buckets in sorted(hit.items()) for b in sorted(set(buckets) - set(segments[s][1]["empty"]))]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def _touched(pairs: DataFrame) -> dict[int, list[int]]:
    """Buckets by segment: at most as many pairs as the ledger has buckets."""
    out: dict[int, list[int]] = {}
    for r in pairs.select("_segment", "_bucket").distinct().collect():
        out.setdefault(r[0], []).append(r[1])
    return out


def _small(ids: DataFrame) -> bool:
    rows, size = ids.agg(F.count(F.lit(1)), F.sum(F.octet_length("event_id"))).first()
    return rows <= BROADCAST_IDS and (size or 0) <= BROADCAST_ID_BYTES


def known(ids: DataFrame, segments: list[tuple[str, dict]]) -> tuple[DataFrame | None, DataFrame | None]:
    """The distinct ``event_id`` of ``ids`` that the segments (folder, what
    ``write_segment`` returned) hold, as ``_known``; None where no bucket can hold any.
    Also the ids that passed the Bloom filters, persisted: the caller's to release."""
    spark = ids.sparkSession
    segments = [s for s in segments if s[1]["ids"]]
    if not segments:
        return None, None
    small = _small(ids)
    found, maybe = [], None
    same = F.col("event_id").eqNullSafe(F.col("_known"))

    def holding(hit: dict[int, list[int]], candidates: DataFrame) -> None:
        stored = _read(spark, segments, hit, "ids", "event_id string")
        if stored is not None:
            stored = stored.select(F.col("event_id").alias("_known"))
            found.append(stored.join(F.broadcast(candidates) if small else candidates, same, "left_semi"))

    holding({i: [0] for i, (_, x) in enumerate(segments) if not x["blocks"]}, ids.select("event_id"))
    filtered = {i: x for i, (_, x) in enumerate(segments) if x["blocks"]}
    if filtered:
        sizes = F.array(*(F.struct(F.lit(i).alias("s"), F.lit(x["buckets"]).alias("n"), F.lit(x["blocks"]).alias("k")) for i, x in filtered.items()))
        places = (
            ids.select("event_id", _hash(F.col("event_id")).alias("_h"), F.explode(sizes).alias("_s"))
            .select("event_id", F.col("_s.s").alias("_segment"), _bucket(F.col("_h"), F.col("_s.n")).alias("_bucket"), _block(F.col("_h"), F.col("_s.k")).alias("block"))
        )
        single = {i: [0] for i, x in filtered.items() if x["buckets"] == 1}
        asked = single if len(single) == len(filtered) else single | _touched(places.where(~F.col("_segment").isin(*single)) if single else places)
        blooms = _read(spark, segments, asked, "bloom", "block int, " + ", ".join(f"w{w} long" for w in range(WORDS)))
        if blooms is not None:
            # a file's path says which bucket of which segment it is
            place = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/bloom/_bucket=[0-9]+/", 1)
            number = F.create_map(*(x for i in asked for x in (F.lit(segments[i][0].rsplit("/", 1)[1]), F.lit(i))))
            bucket = F.regexp_extract(F.col("_metadata.file_path"), "/bloom/_bucket=([0-9]+)/", 1).cast("int")
            blooms = blooms.withColumns({"_segment": F.element_at(number, place), "_bucket": bucket})
            probes = _placed(places).withColumn("_bits", F.expr(BITS)).drop(*(f"_p{i}" for i in range(PROBES)))
            maybe = blooms.join(F.broadcast(probes) if small else probes, ["_segment", "_bucket", "block"])
            maybe = maybe.where(" AND ".join(f"(_bits.w{w} & w{w}) = _bits.w{w}" for w in range(WORDS)))
            maybe = maybe.select("event_id", "_segment", "_bucket").persist(StorageLevel.MEMORY_AND_DISK)
            holding(_touched(maybe), maybe.select("event_id").distinct())
    if not found:
        return None, maybe
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct(), maybe


def due(sizes: list[int]) -> list[list[int]]:
    """Positions of segments to merge: ``FANOUT`` or more of one size class (powers of ``FANOUT``)."""
    classes: dict[int, list[int]] = {}
    for i, n in enumerate(sizes):
        k, size = 0, max(1, n)
        while size >= FANOUT:
            size //= FANOUT
            k += 1
        classes.setdefault(k, []).append(i)
    return [c for c in classes.values() if len(c) >= FANOUT]


def merged(spark: SparkSession, segments: list[tuple[str, dict]], path: str) -> dict:
    """Write the union of the segments' ids as one segment."""
    parts = [spark.read.schema("event_id string, _bucket int").parquet(f"{p}/ids").select("event_id") for p, x in segments if x["ids"]]
    ids = parts[0] if parts else spark.createDataFrame([], "event_id string")
    for p in parts[1:]:
        ids = ids.unionByName(p)
    return write_segment(ids.distinct(), path)
