"""Benchmark decontamination (op 9): one Aho-Corasick automaton over the
normalised test texts, each document scanned once, hits mapped to the original.

Normalising keeps the byte positions: A-Z become a-z and each non-word byte a
space, so a word's place in the normalised bytes is its place in the UTF-8
text. The automaton holds the first ``SEED`` words of each item's windows of 13
words (a shorter item is one window), between spaces; where they occur, the words
that follow are compared as a whole window. It reaches the tasks as a broadcast of at
most ``MAX_WINDOWS`` windows and ``MAX_BYTES`` of their text, and each Python worker
builds it once, not each task. A larger benchmark is dealt into as many automata as
needed, the documents scanned once with each, and their hits united by document.

Null text has no words, in documents and items alike. An item without id marks
words but isn't counted. Equal items each count. Repeated documents come out
as often as they come in. A text of any length is scanned whole, in one task. Empty
tables give no rows, an empty benchmark no hits. Only the ``keep`` columns come along;
they can't be named like the results.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import map_blocks, written

WINDOW = 13
BLOCK_BYTES = 4 << 20
SEED = 4
MAX_WINDOWS = 200_000
MAX_BYTES = 32 << 20

_WORD = lambda b: b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
#: By byte: lower case of a word's byte, else a space.
NORMAL = bytes(x if _WORD(x) else 0x20 for x in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, item_ids): normalised windows between spaces, one row each."""
    words = F.filter(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))).alias("at"))
        .select("item", F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("at"), F.lit(width)), " "), F.lit(" ")).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("item_ids"))
    )


def automaton(found: dict[bytes, list[str]]):
    """Of the windows' first words; the value of a key is its number of words and the lengths of its windows."""
    import ahocorasick

    lengths: dict[bytes, set[int]] = {}
    for window in found:
        words = window.split()
        lengths.setdefault(b" %s " % b" ".join(words[:SEED]), set()).add(len(words))
    a = ahocorasick.Automaton()
    for seed, of in lengths.items():
        a.add_word(seed.decode("latin-1"), (seed.count(b" ") - 1, *sorted(of)))
    if lengths:
        a.make_automaton()
    return a


_built: dict[str, object] = {}


def _automaton_of(name: str, found):
    """The worker's automaton of that name, built when it first asks."""
    if name not in _built:
        _built.clear()
        _built[name] = automaton(found.value)
    return _built[name]


RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan(name: str, found, last: bool):
    """A block's hits united with those of earlier automata; the last pass lets go of the text."""

    def make():
        a, windows_ = _automaton_of(name, found), found.value

        def each(block):
            n_words, items, runs, spans = [], [], [], []
            for text, named, hits in zip(*(block.column(c).to_pylist() for c in ("_text", "item_ids", "word_runs"))):
                data = (text or "").encode().translate(NORMAL)
                words = data.split()
                n_words.append(len(words))
                named, hits = set(named or ()), [(r["start"], r["end"]) for r in hits or ()]
                if len(a) and words:
                    normal = b" %s " % b" ".join(words)
                    space = None
                    for end, (n, *lengths) in a.iter(normal.decode("latin-1")):
                        if space is None:
                            space = np.flatnonzero(np.frombuffer(normal, np.uint8) == 0x20)
                        at = int(np.searchsorted(space, end)) - n  # words before the seed
                        for to in (at + k for k in lengths if at + k <= len(words)):
                            ids = windows_.get(normal[space[at] : space[to] + 1])
                            if ids is not None:
                                hits.append((at, to))
                                named.update(ids)
                items.append(sorted(named))
                if not hits:
                    runs.append([])
                    spans.append([])
                    continue
                mark = np.zeros(len(words) + 1, np.int64)
                np.add.at(mark, [x for x, _ in hits], 1)
                np.add.at(mark, [y for _, y in hits], -1)
                edge = np.flatnonzero(np.diff(np.cumsum(mark[:-1]) > 0, prepend=False, append=False))
                pairs = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
                runs.append([{"start": x, "end": y} for x, y in pairs])
                place = np.flatnonzero(np.diff(np.frombuffer(data, np.uint8) != 0x20, prepend=False, append=False))
                point = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
                spans.append([{"start": int(point[place[2 * x]]) - 1, "end": int(point[place[2 * y - 1] - 1])} for x, y in pairs])
            names = [c for c in block.schema.names if c not in ("_text", "item_ids", "word_runs")]
            out = {c: block.column(c) for c in names} | ({} if last else {"_text": block.column("_text")})
            out |= {"item_ids": pa.array(items, pa.list_(pa.string())), "word_runs": pa.array(runs, RUNS)}
            if last:
                out |= {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, RUNS)}
            yield pa.RecordBatch.from_pydict(out)

        return each

    return make


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", width: int = WINDOW) -> DataFrame:
    """``keep`` columns, item_ids (sorted as strings), word_runs (hit words, end
    exclusive), n_words, spans (the runs in code points of the text), n_hit and contaminated."""
    spark = docs.sparkSession
    dealt = written(windows(benchmark, width), "benchmark-windows")
    n, size = dealt.select(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    shards = max(1, -(-n // MAX_WINDOWS), -(-size // MAX_BYTES))
    runs = "array<struct<start:int,end:int>>"
    out = docs.select(
        *keep, F.col(text).alias("_text"), F.lit(None).cast("array<string>").alias("item_ids"), F.lit(None).cast(runs).alias("word_runs")
    )
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in out.schema if f.name in keep)
    for shard in range(shards):
        own = dealt.where(F.pmod(F.xxhash64("window"), F.lit(shards)) == shard).toArrow()  # about MAX_WINDOWS rows at most
        found = dict(zip((w.encode() for w in own.column("window").to_pylist()), own.column("item_ids").to_pylist()))
        last = shard == shards - 1
        schema = kept + ("" if last else "_text string, ") + f"item_ids array<string>, word_runs {runs}" + (f", n_words long, spans {runs}" if last else "")
        out = map_blocks(out, "_text", BLOCK_BYTES, _scan(uuid.uuid4().hex, spark.sparkContext.broadcast(found), last), schema)
    n_hit = F.aggregate("word_runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows in every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )
