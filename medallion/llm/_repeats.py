"""Windows that repeat anywhere in a corpus, found by super-window partitioning.

A sequence's units are bytes or words. Of each window of ``length`` units the
``gram``-unit run with the least hash (the leftmost among equals) is the anchor; equal
windows have equal anchors. Consecutive windows with the same anchor form one
super-window, a row of (anchor hash, hash of its content, place).

1. Anchors are counted (map-side combined); those met once end here, which is
   nearly all of a corpus.
2. Super-windows with equal content hashes are a candidate class with a head. The
   strings of all members travel, packed, and each is compared with its head's: a plain
   join on the class, whose counted side is stored, so Spark splits a hot class. In a
   class that agrees all windows repeat, and its head alone goes on: copies and passages
   by the thousand cost the buckets one string. Of a class that doesn't agree (its hash
   collided) every member goes on by itself.
3. Where an anchor has several contents, their strings go to the anchor's bucket, where
   ``bucket`` (the operator's own sort) tells which windows are equal. An anchor with
   over ``HOT`` contents isn't put into one bucket: its windows travel one by one and
   are counted by 64-bit hash, map-side combined, without comparing text.

Rows are told apart by 128 bits of key columns and text; hashes of grams and contents
only say what meets. A text of any length is cut in stretches of ``STRETCH`` units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm import _hashing as H
from medallion.llm._blocks import configure, map_blocks, written

BLOCK_BYTES = 1 << 19
#: Contents of an anchor that one bucket takes; with more, its windows are counted one by one.
HOT = 4096
#: Units of a text whose anchors are chosen at once; a place in a stretch and its windows has 28 bits.
STRETCH = 1 << 27
_SHIFT, _PLACE = np.uint64(28), np.uint64((1 << 28) - 1)
#: A row's two key halves.
ROW = ["_row", "_also"]


@dataclass(frozen=True)
class Unit:
    """How a text is cut: words, or bytes; window length and gram width in units; bits of a content's hash."""

    words: bool
    length: int
    gram: int
    bits: int = 64


def _cut(texts: list[bytes], unit: Unit):
    """Unit starts and ends in the buffer (None: the bytes themselves), first unit of
    each text, hashes of grams, and the prefix sums."""
    buffer, begin = H.joined(texts)
    if unit.words:
        starts, ends, word, first = H.words(buffer, begin, lower=False)
        return first[:-1], first[1:], H.word_grams(word, unit.gram), word
    sums = H.prefix_sums(buffer)
    return begin[:-1], begin[1:] - 1, H.gram_hashes(sums, unit.gram), sums


def _runs_of(first: np.ndarray, last: np.ndarray, grams: np.ndarray, unit: Unit):
    """Super-windows: text number, first window, number of windows, anchor's place in units of the block."""
    width = unit.length - unit.gram + 1
    n = len(grams)
    long_ = last - first >= unit.length
    if n < width or not long_.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    least = []
    for s in range(0, n - width + 1, STRETCH):
        part = grams[s : s + STRETCH + width - 1]
        m = len(part)
        v = ((part >> _SHIFT) << _SHIFT) | np.arange(m, dtype=np.uint64)
        tiles = np.concatenate([v, np.full(-m % width, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(tiles, axis=1).ravel()
        back = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        least.append((np.minimum(back[: m - width + 1], ahead[width - 1 : m]) & _PLACE).astype(np.int64) + s)
    mark = np.zeros(n + 2, np.int32)
    np.add.at(mark, first[long_], 1)
    np.add.at(mark, np.minimum(last[long_] - unit.length + 1, n + 1), -1)
    window = np.flatnonzero(np.cumsum(mark[: n - width + 1]) > 0)
    anchor = np.concatenate(least)[window]
    cut = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(cut, append=len(window))
    text = np.searchsorted(first, window[cut], side="right") - 1
    # empty texts share their first unit with the next one: the last text that begins there holds it
    return text, window[cut], count, anchor[cut]


def _super_windows(unit: Unit):
    def each(block):
        first, last, grams, base = _cut([(t or "").encode() for t in block.column("_text").to_pylist()], unit)
        text, window, count, anchor = _runs_of(first, last, grams, unit)
        row, also = (block.column(c).to_numpy(zero_copy_only=False) for c in ROW)
        if unit.words:
            # the words' hashes as a sequence, by prefix sums over mixed positions
            up, down = H._power(len(base) + 1)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(H.mix(base) * up[: len(base)])]).astype(np.uint64)
        else:
            sums = base
        content = H.run_hashes(sums, window, window + unit.length + count - 1) >> np.uint64(64 - unit.bits)
        start = window - first[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (grams[anchor].view(np.int64), content.view(np.int64), row[text], also[text], start.astype(np.int32), count.astype(np.int32), (anchor - window).astype(np.int32))],
            ["anchor", "content", *ROW, "start", "n", "lead"],
        )

    return each


def _pack(unit: Unit):
    """Strings of the super-windows that travel, and window hashes of the heads of hot anchors.
    Rows of one key have one text and lie together: the first that a task meets stands for them."""
    seen: set[tuple[int, int]] = set()
    passed = ("anchor", "content", "start", "n", "lead", "members", "head", "mixed")

    def each(block):
        out = {k: [] for k in (*passed, *ROW, "packed", "windows")}
        for row, also, text, todo in zip(*(block.column(c).to_pylist() for c in (*ROW, "_text", "todo"))):
            if (row, also) in seen:
                continue
            seen.add((row, also))
            data = text.encode()
            parts = data.split() if unit.words else None
            if any(x["hot"] and x["head"] for x in todo):
                first, last, _, base = _cut([data], unit)
                whole = H.word_grams(base, unit.length) if unit.words else H.gram_hashes(base, unit.length)
            for x in todo:
                a, b = x["start"], x["start"] + x["n"] + unit.length - 1
                for k in passed:
                    out[k].append(x[k])
                out["_row"].append(row)
                out["_also"].append(also)
                out["packed"].append(b" ".join(parts[a:b]) if unit.words else data[a:b])
                out["windows"].append(whole[a : a + x["n"]].view(np.int64) if x["hot"] and x["head"] else None)
        kinds = {"n": pa.int32(), "start": pa.int32(), "lead": pa.int32(), "head": pa.bool_(), "mixed": pa.bool_(), "packed": pa.binary(), "windows": pa.list_(pa.int64())}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))

    return each


def _buckets(bucket: Callable, unit: Unit, members: int = 20_000):
    """Whole groups of equal anchors, some thousand members at a time, through ``bucket``."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        count = 0

        def out(table):
            anchor = table.column("anchor").to_numpy()
            group = np.cumsum(np.diff(anchor, prepend=anchor[:1]) != 0)
            packed = table.column("packed").to_pylist()
            found = bucket(group, packed, table.column("lead").to_numpy(), table.column("n").to_numpy(), unit)  # a mask of windows each
            row, also, start, single = (table.column(c).to_numpy(zero_copy_only=False) for c in (*ROW, "start", "single"))
            rows, a, b = [], [], []  # rows: numbers in the table
            for i, mask in found:
                if single[i]:
                    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                    rows += [i] * (len(edge) // 2)
                    a.append(start[i] + edge[::2])
                    b.append(start[i] + edge[1::2] - 1 + unit.length)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[rows]), pa.array(also[rows]), pa.array(np.concatenate(a), pa.int32()), pa.array(np.concatenate(b), pa.int32())], [*ROW, "from", "to"]
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= members:
                table = pa.Table.from_batches(held)
                anchor = table.column("anchor").to_numpy()
                whole = int(np.flatnonzero(anchor == anchor[-1])[0])  # sorted: the last group may go on
                if whole:
                    yield from out(table.slice(0, whole))
                    held = table.slice(whole).combine_chunks().to_batches()
                    count = table.num_rows - whole
        if count:
            yield from out(pa.Table.from_batches(held))

    return run


def repeats(docs: DataFrame, keep: list[str], unit: Unit, bucket: Callable, text: str = "text") -> DataFrame:
    """``keep`` columns, _text (never null) and runs, the [from, to) unit ranges
    that repeating windows cover (unsorted, overlapping), null if none."""
    configure(docs.sparkSession)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_row", F.xxhash64(*keep, "_text")).withColumn("_also", F.xxhash64(F.lit("also"), "_text", *keep))
    windows = map_blocks(
        rows.select(*ROW, "_text"), "_text", BLOCK_BYTES, lambda: _super_windows(unit),
        "anchor long, content long, _row long, _also long, start int, n int, lead int",
    )
    # a join whose other side is an aggregate can't split a hot anchor: what is counted is stored first
    met = written(windows.groupBy("anchor").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("anchor"), "met-anchors")
    again = written(windows.join(met, "anchor"), "repeated-anchors").withColumn("place", F.xxhash64(*ROW, "start"))
    classes = written(again.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("members"), F.min("place").alias("first")), "classes")
    contents = written(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")), "contents")
    known = again.join(written(classes.join(contents, "anchor"), "anchor-classes"), ["anchor", "content"])
    known = known.where("members > 1 or contents > 1").withColumn("head", F.expr("place = first"))

    todo = F.struct("anchor", "content", "start", "n", "lead", "members", "head", F.expr("contents > 1").alias("mixed"), (F.col("contents") > HOT).alias("hot"))
    travel = known.groupBy(*ROW).agg(F.collect_set(todo).alias("todo"))  # a text's own, once for all rows of its key
    packed = map_blocks(
        rows.select(*ROW, "_text").join(travel.hint("shuffle_hash"), ROW), "_text", BLOCK_BYTES, lambda: _pack(unit),
        "anchor long, content long, start int, n int, lead int, members long, head boolean, mixed boolean, _row long, _also long, packed binary, windows array<long>",
    )
    packed = written(packed, "packed-windows")

    several = packed.where("members > 1")
    heads = several.where("head").select("anchor", "content", F.col("packed").alias("own"))
    place = [*ROW, "anchor", "content", "start", "n"]
    checked = written(several.join(heads, ["anchor", "content"]).select(*place, F.expr("packed = own").alias("equal")), "compared-classes")
    apart = written(checked.where("not equal").select("anchor", "content").distinct(), "collided-classes")
    agreed = checked.join(apart, ["anchor", "content"], "left_anti")
    same = agreed.select(*ROW, F.struct(F.col("start").alias("from"), (F.col("start") + F.col("n") + unit.length - 1).alias("to")).alias("run"))

    single = F.expr("members = 1").alias("single")
    string = [*ROW, "anchor", "start", "n", "lead", "packed"]
    one_each = packed.where("head and mixed and windows is null").join(apart, ["anchor", "content"], "left_anti").select(*string, single)
    by_itself = several.join(apart, ["anchor", "content"], "left_semi").select(*string, F.lit(True).alias("single"))
    dealt = one_each.unionByName(by_itself).repartition("anchor").sortWithinPartitions("anchor", *ROW, "start")
    sorted_ = dealt.mapInArrow(_buckets(bucket, unit), "_row long, _also long, `from` int, `to` int")
    hot = packed.where("windows is not null").select(*ROW, "start", single, F.posexplode("windows").alias("at", "window"))
    twice = hot.groupBy("window").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counted = hot.where("single").join(twice, "window")
    one = F.struct((F.col("start") + F.col("at")).alias("from"), (F.col("start") + F.col("at") + unit.length).alias("to"))
    runs = same.unionByName(sorted_.select(*ROW, F.struct("from", "to").alias("run"))).unionByName(counted.select(*ROW, one.alias("run")))
    by_row = runs.groupBy(*ROW).agg(F.collect_set("run").alias("runs"))  # a text's own, once for all rows of its key
    return rows.join(by_row.hint("shuffle_hash"), ROW, "left").drop(*ROW)


def merged(runs) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["from"], r["to"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def gaps(runs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """What the runs leave of [0, n)."""
    return [(a, b) for a, b in zip([0, *(y for _, y in runs)], [*(x for x, _ in runs), n]) if a < b]
