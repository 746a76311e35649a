"""Periodic runs of words (op 12) by the branching-tandem test on enhanced suffix arrays.

A run is a maximal stretch of consecutive words with smallest period q and at least
``exponent`` periods and ``least`` words. The texts of a bounded block share one
enhanced suffix array (order, inverse ISA, LCP); the text's number leads each
suffix's key, so suffixes of two texts never share a prefix.

1. Prefix doubling orders the suffixes; only groups that still agree are sorted again.
   The ranks of each doubling give the exact LCP of neighbours.
2. Each position with LCP >= 1 cuts an LCP interval. Its ends are the nearest smaller
   values on both sides, found on range minima. Cuts with equal ends are
   the children of one interval; no tree nodes are made.
3. The suffixes i of all children but the largest check whether ISA[i + depth] or
   ISA[i - depth] is in the interval. Where the word after the square differs from the
   one a period before, the square is branching. Each run ends with one.
4. The square is rotated left as long as the word before fits. Of squares with one end,
   those inside a run of a smaller period are powers and fall to that run.

Null text has no words, as has a text of separators only: no runs, empty collapsed
text. Words are compared as bytes, letters' case counts. A whole text is one unit: its
memory grows with its own length (some 8 bytes a word for each doubling that its longest
repeat needs), not with other rows; texts longer than a block go alone. Repeated
rows are judged one by one and get equal results; empty tables give empty ones.
Kept columns travel in a struct of their own, so no name can clash inside; a kept column
named like a result column gives way to it. Other columns are left alone.
"""

from __future__ import annotations

from itertools import count
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm._blocks import map_blocks

BLOCK_BYTES = 1 << 19
LEAST = 24
EXPONENT = 3
RESULTS = ("n_words", "runs", "collapsed")
_RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def suffix_array(word: np.ndarray, text: np.ndarray, end: np.ndarray):
    """Order, ISA and LCP (n + 1 entries, 0 at both ends) of the suffixes of all texts
    of a block; ``text`` and ``end`` are the text's number and end at each word."""
    n = len(word)
    key = text * (int(word.max()) + 1) + word
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], np.diff(key[order]) != 0])
    head = np.flatnonzero(fresh)
    size = np.diff(head, append=n)
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.repeat(head, size)
    active = order[np.repeat(size, size) > 1]
    levels, step = [], 1
    while len(active):
        levels.append(rank.astype(np.int32))
        ahead = active + step
        key = rank[active] * (n + 1) + np.where(ahead < end[active], rank[np.minimum(ahead, n)] + 1, 0)
        by_key = np.argsort(key, kind="stable")
        active, key = active[by_key], key[by_key]
        place = np.arange(len(active))
        old = rank[active]
        group = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(old) != 0]), place, 0))
        fresh = np.concatenate([[True], np.diff(key) != 0])
        part = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active] = old + part - group
        size = np.diff(np.flatnonzero(fresh), append=len(active))
        active = active[np.repeat(size, size) > 1]
        step *= 2
    isa = rank[:n]
    order = np.empty(n, np.int64)
    order[isa] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    if levels:
        near = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]]) + 1
        a, b = order[near - 1], order[near]
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            lcp[near] += same.astype(np.int64) << k
            a, b = a + (same.astype(np.int64) << k), b + (same.astype(np.int64) << k)
    return order, isa, lcp


def nearest_smaller(value: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest places left and right of each of ``at`` with a smaller value; both ends of ``value`` hold the least."""
    inside = np.flatnonzero(np.diff(value > 0, prepend=False, append=False))
    longest = int((inside[1::2] - inside[::2]).max())  # a search never leaves a stretch above 0
    minima = [value.astype(np.int32)]
    while 2 << (len(minima) - 1) <= longest:
        half = 1 << (len(minima) - 1)
        minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
    v = value[at]
    left, right = at.copy(), at.copy()
    for k in range(len(minima) - 1, -1, -1):
        low, width = minima[k], 1 << k
        fits = (right + width < len(value)) & (low[np.minimum(right + 1, len(low) - 1)] >= v)
        right += np.where(fits, width, 0)
        fits = (left >= width) & (low[np.maximum(left - width, 0)] >= v)
        left -= np.where(fits, width, 0)
    return left - 1, right + 1


def branching_squares(word: np.ndarray, begin: np.ndarray, end: np.ndarray, order: np.ndarray, isa: np.ndarray, lcp: np.ndarray):
    """Starts and periods of the branching tandem repeats; a square may come twice."""
    cut = np.flatnonzero(lcp)
    if not len(cut):
        return cut, cut
    n = len(word)
    low, high = nearest_smaller(lcp, cut)
    by_interval = np.lexsort((cut, high, low))
    cut, low, high = cut[by_interval], low[by_interval], high[by_interval]
    head = np.concatenate([[True], (np.diff(low) != 0) | (np.diff(high) != 0)])
    interval = np.cumsum(head) - 1
    until = np.where(np.append(head[1:], True), high, np.append(cut[1:], 0))
    # children: one from each cut to the next, and one before the interval's first cut
    child = np.concatenate([cut, low[head]])
    size = np.concatenate([until, cut[head]]) - child
    owner = np.concatenate([interval, np.arange(interval[-1] + 1)])
    by_size = np.lexsort((size, owner))
    small = by_size[np.concatenate([np.diff(owner[by_size]) == 0, [False]])]  # all but the largest of each
    child, size, owner = child[small], size[small], owner[small]
    first = np.flatnonzero(head)[owner]
    suffix = order[np.repeat(child - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    depth, low, high = (np.repeat(x, size) for x in (lcp[cut[first]], low[first], high[first]))
    found = []
    for start, other in ((suffix, suffix + depth), (suffix - depth, suffix - depth)):
        rank = isa[np.clip(other, 0, n - 1)]
        hit = np.flatnonzero((other >= begin[suffix]) & (other < end[suffix]) & (rank >= low) & (rank < high))
        start, period = start[hit], depth[hit]
        last = start + 2 * period
        bound = end[start]
        branch = (last == bound) | (word[np.minimum(last, n - 1)] != word[start + period])
        found.append((start[branch], period[branch]))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _rotations(word: np.ndarray, start: int, period: int, floor: int) -> int:
    """Start of the run whose last square begins at ``start``."""
    at, step = start, 64
    while at > floor:
        low = max(floor, at - step)
        differ = np.flatnonzero(word[low:at] != word[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, 2 * step
    return floor


def runs_of(word: np.ndarray, first: np.ndarray, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) in words of the block, by start and period; ``first``
    is the place of each text's first word, and one past the last."""
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    begin, end = first[text], first[text + 1]
    start, period = branching_squares(word, begin, end, *suffix_array(word, text, end))
    # the run that a square ends must go on so far to the left
    need = np.maximum(np.maximum(least, exponent * period) - 2 * period, 0)
    far = start - need
    alive = far >= begin[start]
    start, period, far = start[alive], period[alive], far[alive]
    fits = word[far] == word[far + period]
    start, period = start[fits], period[fits]
    out = []
    known: list[tuple[int, int]] = []
    last = (-1, -1)
    for i in np.lexsort((period, start + 2 * period)).tolist():
        at, q = int(start[i]), int(period[i])
        if (at + 2 * q, q) == last:
            continue
        if at + 2 * q != last[0]:
            known = []
        last = (at + 2 * q, q)
        if any(q % p == 0 and s <= at for p, s in known):
            continue
        left = _rotations(word, at, q, int(begin[at]))
        if last[0] - left >= max(least, exponent * q):
            known.append((q, left))
            out.append((left, last[0] - left, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _block(least: int, exponent: int):
    def each(block):
        texts = [(t or "").encode().split() for t in block.column("_text").to_pylist()]
        first = np.cumsum([0, *map(len, texts)])
        number = defaultdict(count().__next__)
        word = np.fromiter((number[w] for t in texts for w in t), np.int64, first[-1])
        spans: list[list] = [[] for _ in texts]
        if first[-1]:
            runs = runs_of(word, first, least, exponent)
            for r, t in zip(runs, (np.searchsorted(first, [r[0] for r in runs], side="right") - 1).tolist()):
                spans[t].append({"start": r[0] - int(first[t]), "length": r[1], "period": r[2]})
        rest = []
        for words, own in zip(texts, spans):
            if own:
                stays = np.ones(len(words), bool)
                for r in own:
                    stays[r["start"] + r["period"] : r["start"] + r["length"]] = False
                words = [words[i] for i in np.flatnonzero(stays).tolist()]
            rest.append(b" ".join(words).decode())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [block.column("_keep"), pa.array(np.diff(first), pa.int64()), pa.array(spans, kind), pa.array(rest, pa.string())], ["_keep", *RESULTS]
        )

    return each


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``keep`` columns, n_words, runs (start, length, period in words, by start and
    period) and collapsed: the words left when each run keeps its first period, one space between."""
    if exponent < 2:
        raise ValueError("a run has two periods or more")
    keep = [k for k in keep if k not in RESULTS]
    rows = docs.select(F.struct(*keep).alias("_keep"), F.col(text).alias("_text"))
    schema = T.StructType([T.StructField("_keep", rows.schema["_keep"].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", _RUN), T.StructField("collapsed", T.StringType())])
    found = map_blocks(rows, "_text", BLOCK_BYTES, lambda: _block(least, exponent), schema)
    return found.select("_keep.*", *RESULTS)


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the query: where crc32(doc_id) is a multiple of 10, words from
    a = g % n on repeat the p = 1 + floor((n - a) / (3 + g % 8)) words at a, with g = floor(crc32 / 10)."""
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p)))

    # the one-element array names the words, so they are split once
    whole = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.concat_ws(" ", repeated(w)))), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(whole, text)).otherwise(text)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Periodic runs of words over every whole text of ``documents``, a tenth of them
    made periodic by the query's own rule."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")), ["doc_id"])
    none = F.lit(None).cast(_RUN.elementType)
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    best = F.reduce("runs", none, better)
    found = found.select("*", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
