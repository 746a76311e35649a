"""Suffix-array dedup over bytes (op 3): repeated strings of 200 bytes.

The corpus-wide suffix order isn't built; ``_repeats`` partitions the windows
by anchor, and only suffixes that can share 200 bytes meet in a bucket. There they
are put in order by deep-shallow sorting: a multikey quicksort over eight-byte
keys to a shallow depth, then blind tries for the groups that still agree. The
order gives the longest common prefixes of neighbours. A window is its part
before the anchor and its part after it, so suffixes are sorted both ways from
the anchor; two windows with the same offset are equal if both parts are.

Null text is empty. Bytes are those of the UTF-8 text, whole documents, matches
don't cross documents; a string that overlaps its own copy counts. Texts under 200
bytes are left alone; repeated rows lose all from 200 bytes on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medallion.llm._blocks import map_blocks
from medallion.llm._repeats import BLOCK_BYTES, Unit, gaps, merged, repeats

LENGTH = 200
GRAM = 32
#: Keys of eight bytes that the quicksort looks at before the tries take over.
SHALLOW = 4


def common_prefix(s: bytes, t: bytes) -> int:
    n = min(len(s), len(t))
    if s[:n] == t[:n]:
        return n
    differ = int.from_bytes(s[:n], "big") ^ int.from_bytes(t[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Strings in order; inner nodes know a depth and the bytes that branch there.

    Going down looks at the branching bytes only; one comparison with the leaf
    found tells where the new string really leaves its path.
    """

    def __init__(self):
        self.root: list | None = None  # inner: [depth, {byte: node}], leaf: [-1, string, numbers]

    def add(self, s: bytes, number: int) -> None:
        if self.root is None:
            self.root = [-1, s, [number]]
            return
        node = self.root
        while node[0] >= 0:
            depth, below = node
            node = below.get(s[depth] if depth < len(s) else -1) or next(iter(below.values()))
        same = common_prefix(s, node[1])
        if same == len(s) == len(node[1]):
            node[2].append(number)
            return
        other = node[1]
        at, parent, edge = self.root, None, None
        while 0 <= at[0] < same:
            parent, edge = at, s[at[0]]
            at = at[1][edge]
        mine = s[same] if same < len(s) else -1
        if at[0] == same:
            at[1][mine] = [-1, s, [number]]
            return
        split = [same, {other[same] if same < len(other) else -1: at, mine: [-1, s, [number]]}]
        if parent is None:
            self.root = split
        else:
            parent[1][edge] = split

    def numbers(self):
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] < 0:
                yield from node[2]
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def multikey_quicksort(group: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Order by group and the first ``SHALLOW`` keys, and the (begin, size) of parts that agree in all of them.

    Each part takes its middle key as pivot and falls into three; the equal one goes on with
    the next key. All open parts take a step at once; a part of one string is done.
    """
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.diff(group[order], prepend=-1))
    size = np.diff(begin, append=len(order))
    depth = np.zeros(len(begin), np.int64)
    deep: list[tuple[int, int]] = []
    while True:
        open_ = size > 1
        begin, size, depth = begin[open_], size[open_], depth[open_]
        done = depth == SHALLOW
        deep += zip(begin[done].tolist(), size[done].tolist())
        begin, size, depth = begin[~done], size[~done], depth[~done]
        if not len(begin):
            return order, deep
        first = np.cumsum(size) - size
        part = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(part)) + (begin - first)[part]
        number = order[at]
        key = keys[number, depth[part]]
        pivot = key[first + size // 2][part]
        third = 3 * part + (key >= pivot) + (key > pivot)
        order[at] = number[np.argsort(third, kind="stable")]
        size = np.bincount(third, minlength=3 * len(begin))
        depth = np.repeat(depth, 3) + np.tile([0, 1, 0], len(begin))
        begin = np.repeat(begin - first, 3) + np.cumsum(size) - size


def deep_shallow(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their groups, and the common prefix of each with the one before (-1 where a group begins)."""
    n = len(strings)
    lengths = np.array([len(s) for s in strings])
    width = -(-max(int(lengths.max()), SHALLOW * 8) // 8) * 8
    matrix = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(n, width)
    keys = matrix.view(">u8")
    order, deep = multikey_quicksort(group, keys)
    for a, m in deep:
        trie = BlindTrie()
        for i in order[a : a + m].tolist():
            trie.add(strings[i], i)
        order[a : a + m] = list(trie.numbers())
    lcp = np.full(n, -1)
    for a in range(1, n, 1 << 14):
        at = np.arange(a, min(n, a + (1 << 14)))
        x, y = order[at - 1], order[at]
        differ = matrix[x] != matrix[y]
        first = np.where(differ.any(1), differ.argmax(1), width)
        lcp[at] = np.where(group[x] == group[y], np.minimum(first, np.minimum(lengths[x], lengths[y])), -1)
    return order, lcp


def equal_windows(group, packed, lead, n, unit):
    """Of each group's strings, the windows that equal one of another string.

    ``lead`` is the anchor's place in the string; the window at i has its
    anchor ``lead - i`` bytes on.
    """
    total = len(packed)
    right, right_lcp = deep_shallow(group, [s[a:] for s, a in zip(packed, lead.tolist())])
    left, left_lcp = deep_shallow(group, [s[:a][::-1] for s, a in zip(packed, lead.tolist())])
    masks: dict[int, np.ndarray] = {}
    after, before = np.empty(total, np.int64), np.empty(total, np.int64)
    for offset in range(unit.length - unit.gram + 1):
        alive = np.flatnonzero((offset <= lead) & (offset > lead - n))
        if len(alive) < 2:
            continue
        after[right] = np.cumsum(right_lcp < unit.length - offset)
        before[left] = np.cumsum(left_lcp < offset)
        key = after[alive] * (total + 1) + before[alive]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        for i in alive[order[twice]].tolist():
            if i not in masks:
                masks[i] = np.zeros(n[i], bool)
            masks[i][lead[i] - offset] = True
    yield from masks.items()


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", length: int = LENGTH, gram: int = GRAM, kept: bool = True) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256, removed (byte
    runs) and kept (the remaining bytes; null unless asked for)."""
    found = repeats(docs, keep, Unit(False, length, gram), equal_windows, text)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in found.schema if f.name in keep)

    def each(block):
        n, gone, sha, runs, rest = [], [], [], [], []
        for t, r in zip(block.column("_text").to_pylist(), block.column("runs").to_pylist()):
            data = t.encode()
            own = merged(r)
            left = b"".join(data[a:b] for a, b in gaps(own, len(data)))
            n.append(len(data))
            gone.append(sum(b - a for a, b in own))
            sha.append(hashlib.sha256(left).hexdigest())
            runs.append([{"from": a, "to": b} for a, b in own])
            rest.append(left if kept else None)
        span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(r) for r in runs], pa.int64()), pa.array(sha, pa.string()), pa.array(runs, span), pa.array(rest, pa.binary())],
            [*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"],
        )

    return map_blocks(
        found.select(*keep, "_text", "runs"), "_text", BLOCK_BYTES, lambda: each,
        schema + "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<`from`:int,`to`:int>>, kept binary",
    )


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes over every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, ["doc_id"], kept=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
