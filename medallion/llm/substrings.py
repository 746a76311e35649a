"""Substring dedup over words (op 10) by super-k-mer partitioning.

Consecutive windows of 35 words that share a minimiser travel as one packed
string to the minimiser's bucket, where sorting counts the windows exactly.
``_repeats`` partitions; here are the bucket's sort and what is done with the
result. Every word that a repeating window covers goes.

Null text has no words. Texts under 35 words are left alone; repeated rows are
copies of each other and lose all their windows. Very frequent windows are
counted without meeting in one task. Other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medallion.llm._blocks import map_blocks
from medallion.llm._repeats import BLOCK_BYTES, Unit, gaps, merged, repeats

WINDOW = 35
GRAM = 10


def count_windows(group, packed, lead, n, unit):
    """Of each group's packed strings, the windows that occur twice or more."""
    cut = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(group)]):
        if b - a < 2:
            continue
        windows = []
        for i in range(a, b):
            s = packed[i]
            space = np.flatnonzero(np.frombuffer(s, np.uint8) == 0x20).tolist()
            begin, end = [0, *(x + 1 for x in space)], [*space, len(s)]
            windows += [(s[begin[k] : end[k + unit.length - 1]], i, k) for k in range(n[i])]
        windows.sort()
        masks: dict[int, np.ndarray] = {}
        for x, y in zip(windows, windows[1:]):
            if x[0] == y[0]:
                for _, i, k in (x, y):
                    masks.setdefault(i, np.zeros(n[i], bool))[k] = True
        yield from masks.items()


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", width: int = WINDOW, gram: int = GRAM, kept: bool = True) -> DataFrame:
    """``keep`` columns, n_words, n_removed, kept_sha256, removed (word runs) and
    kept (the remaining words, one space between; null unless asked for)."""
    found = repeats(docs, keep, Unit(True, width, gram), count_windows, text)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in found.schema if f.name in keep)

    def each(block):
        n, gone, sha, runs, rest = [], [], [], [], []
        for t, r in zip(block.column("_text").to_pylist(), block.column("runs").to_pylist()):
            words = t.encode().split()
            own = merged(r)
            left = b" ".join(w for a, b in gaps(own, len(words)) for w in words[a:b])
            n.append(len(words))
            gone.append(sum(b - a for a, b in own))
            sha.append(hashlib.sha256(left).hexdigest())
            runs.append([{"from": a, "to": b} for a, b in own])
            rest.append(left.decode() if kept else None)
        span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(runs, span), pa.array(rest, pa.string())],
            [*keep, "n_words", "n_removed", "kept_sha256", "removed", "kept"],
        )

    return map_blocks(
        found.select(*keep, "_text", "runs"), "_text", BLOCK_BYTES, lambda: each,
        schema + "n_words long, n_removed long, kept_sha256 string, removed array<struct<`from`:int,`to`:int>>, kept string",
    )


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeating windows of 35 words over every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, ["doc_id"], kept=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
