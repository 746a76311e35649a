"""Byte-level BPE encoding and decoding (op 8) by prefix-sharing trie traversal.

The last token of a prefix's encoding determines the rest: cut it off, and
what precedes is itself the encoding of a shorter prefix. So a trie node needs
one value, its last token: the token t ending there for which t and the last
token before t stay apart when their bytes are encoded together. Each task
puts the distinct words of a block in sorted order, which is the trie's
depth-first order; the stack holds the last tokens along the current path, and
a prefix that words share is worked out once. Words' encodings are kept
between blocks, about twice ``CACHE_WORDS`` at most. No shuffle; a row needs its own text only.

Null text is encoded as empty: no ids. Text that holds a special token's
string gets the special id, as the tokenizers library does. Repeated rows come
out as often as they come in.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import map_blocks

BLOCK_BYTES = 4 << 20
#: Encodings that a task keeps in each of two turns, and pair decisions; the rest is worked out again.
CACHE_WORDS = 300_000
CACHE_PAIRS = 400_000

# Fixed value: the byte-level pre-tokenizer's pattern.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

# The same for texts in ASCII, whose classes the faster matcher has.
ASCII_WORDS = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)


def words_of(text: str) -> list[str]:
    return (ASCII_WORDS if text.isascii() else WORDS).findall(text)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Vocabulary, merges and the caches of one task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(map(letters.__getitem__, s))
        self.vocab = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes_of = {v: k for k, v in self.vocab.items()} | {v: k.encode() for k, v in self.special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.longest = max(map(len, self.vocab))
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.pairs: dict[tuple, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE: the lowest rank first, the leftmost among equals."""
        ids = [self.vocab[data[i : i + 1]] for i in range(len(data))]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        queue = [(self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= len(ids):
                continue
            found = self.merges.get((ids[i], ids[j]))
            if not found or found[0] != rank:
                continue
            ids[i], ids[j], after[i] = found[1], -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(ids) and (p := self.merges.get((ids[k], ids[after[k]]))):
                    heapq.heappush(queue, (p[0], k))
        return [x for x in ids if x >= 0]

    def apart(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens side by side."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = (a, b) not in self.merges and self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.pairs[a, b] = known
        return known

    def learn(self, texts: set[str]) -> None:
        """Encodings of the words, along their trie."""
        get, longest, pairs = self.vocab.get, self.longest, self.pairs
        last: list[int] = [-1]  # by prefix length, along the path
        size: list[int] = [0]
        previous = b""
        for word, text in sorted((t.encode(), t) for t in texts):
            n, top = len(word), min(len(word), len(previous))
            if previous[:top] == word[:top]:
                shared = top
            else:
                shared = next(i for i in range(top) if word[i] != previous[i])
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for at in range(max(0, end - longest), end):
                    token = get(word[at:end])
                    if token is not None:
                        before = last[at]
                        known = True if before < 0 else pairs.get((before, token))
                        if known or known is None and self.apart(before, token):
                            last.append(token)
                            size.append(end - at)
                            break
            ids, end = [], n
            while end:
                ids.append(last[end])
                end -= size[end]
            self.words[text] = tuple(reversed(ids))
            previous = word

    def pieces(self, text: str) -> list[str]:
        if self.split is None or not self.split.search(text):
            return words_of(text)
        out: list[str] = []
        at = 0
        for m in self.split.finditer(text):
            out += words_of(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + words_of(text[at:])

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.pieces(t) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}  # words that come again move over, others go with the next turn
        self.words.update((k, (v,)) for k, v in self.special.items())
        new = set(chain.from_iterable(split)).difference(self.words)
        again = {w: self.older[w] for w in new if w in self.older}
        self.words.update(again)
        self.learn(new.difference(again))
        return [list(chain.from_iterable(map(self.words.__getitem__, p))) for p in split]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text", ids: bool = True) -> DataFrame:
    """``keep`` columns, n_tokens, ids (null unless asked for), ids_sha256 and
    decoded_sha256 of each row. ``path``: the tokenizer file, at the same place on every executor."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")

    def make():
        e = encoder(path)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()

        def each(block):
            n, kept_ids, id_sha, text_sha = [], [], [], []
            for out in e.encode([t or "" for t in block.column("_text").to_pylist()]):
                n.append(len(out))
                kept_ids.append(out if ids else None)
                id_sha.append(digest(",".join(map(e.text_of.__getitem__, out))))
                text_sha.append(digest(e.decode(out)))
            names = [c for c in block.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in names), pa.array(n, pa.int64()), pa.array(kept_ids, pa.list_(pa.int32())), pa.array(id_sha, pa.string()), pa.array(text_sha, pa.string())],
                [*names, "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

        return each

    return map_blocks(rows, "_text", BLOCK_BYTES, make, f"{kept}n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` columns and the text of the ids; null ids give the empty text."""
    rows = encoded.select(*keep, F.col(ids).alias("_ids"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_ids")

    def run(batches):
        e = encoder(path)
        for b in batches:
            names = [c for c in b.schema.names if c != "_ids"]
            texts = pa.array([e.decode(x or []) for x in b.column("_ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), texts], [*names, "text"])

    return rows.mapInArrow(run, f"{kept}text string")


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every whole text of ``documents``."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], ids=False).drop("ids")
