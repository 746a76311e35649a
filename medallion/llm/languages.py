"""Language identification (op 7).

Script ranges narrow the candidate languages of each word, character-trigram
log likelihoods score the word under each candidate, and Viterbi with a
switching penalty labels the words, so mixed-language text becomes spans.

* ``train``: trigram and script counts per language over all labelled rows.
  Each task counts into a table of fixed size (languages x 65,536 hashed
  trigrams), so what is shuffled and what reaches the driver is bounded by
  the number of languages, not by the corpus.
* ``identify``: one pass over the texts, no shuffle.

Null or letterless text: ``und``, score 0, no spans. A row with null lang isn't
learned from. Ties go to the language with the higher total likelihood, then
to the first by name. With no labelled row every text is ``und``. Rows come
out once per input row, repeated rows too; other columns are left alone.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import map_blocks

UNDETERMINED = "und"
BUCKETS = 1 << 16
SCRIPTS = 32
#: Text bytes that a task holds as code points at once.
BLOCK_BYTES = 4 << 20
#: A language uses a script when at least this share of its letters are of it.
SCRIPT_SHARE = 1e-3

# Unicode block ranges by script (0 is none, 31 any other letter).
SCRIPT_RANGES = [
    (1, [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)]),
    (2, [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    (3, [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    (4, [(0x530, 0x58F)]),
    (5, [(0x590, 0x5FF), (0xFB1D, 0xFB4F)]),
    (6, [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    (7, [(0x900, 0x97F)]),
    (8, [(0x980, 0x9FF)]),
    (9, [(0xB80, 0xBFF)]),
    (10, [(0xE00, 0xE7F)]),
    (11, [(0x10A0, 0x10FF)]),
    (12, [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    (13, [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    (14, [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)]),
    (15, [(0x1200, 0x137F)]),
]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: in a word, its lower case, its script's bit (letters only)."""
    size = 0x110000
    script = np.full(size, 31, np.uint8)
    for number, ranges in SCRIPT_RANGES:
        for a, b in ranges:
            script[a : b + 1] = number
    kind = np.fromiter((ord(unicodedata.category(chr(c))[0]) for c in range(size)), np.uint8, size)
    letter = kind == ord("L")
    in_word = letter | (kind == ord("M"))
    lower = np.arange(size, dtype=np.uint32)
    for c in np.flatnonzero(letter):
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    lower[~in_word] = 0
    bit = np.where(letter, np.uint32(1) << script.astype(np.uint32), 0).astype(np.uint32)
    return in_word, lower, bit


def _words(texts: list[str]):
    """Words of the texts: starts and ends in code points of the joined texts,
    the texts' own starts, and by word character its trigram bucket and script bit."""
    in_word, lower, bit = _tables()
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    inside = in_word[points]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    low = np.concatenate([[0], lower[points], [0]]).astype(np.uint32)
    at = np.flatnonzero(inside)
    h = low[at] * np.uint32(0x9E3779B1) ^ low[at + 1] * np.uint32(0x85EBCA6B) ^ low[at + 2] * np.uint32(0xC2B2AE35)
    h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    return begin, starts, ends, h, bit[points[at]]


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray  # BUCKETS x languages
    scripts: np.ndarray  # by language, the bits of its scripts


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over every row with text and lang; smoothed log likelihoods."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )

    def count(batches):
        from medallion.llm._blocks import blocks

        langs: dict[str, int] = {}
        table = np.zeros((0, BUCKETS + SCRIPTS), np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            begin, starts, ends, h, bits = _words(block.column("text").to_pylist())
            own = np.array([langs.setdefault(x, len(langs)) for x in block.column("lang").to_pylist()])
            if len(langs) > len(table):
                table = np.vstack([table, np.zeros((len(langs) - len(table), BUCKETS + SCRIPTS), np.int64)])
            word_lang = own[np.searchsorted(begin, starts, side="right") - 1]
            by_char = np.repeat(word_lang, ends - starts)
            script = np.log2(np.maximum(bits, 1)).astype(np.int64)
            for k in np.unique(word_lang):
                mine = by_char == k
                table[k, :BUCKETS] += np.bincount(h[mine], minlength=BUCKETS)
                table[k, BUCKETS:] += np.bincount(script[mine], minlength=SCRIPTS)
        for name, k in langs.items():
            full = np.flatnonzero(table[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full)), pa.array(full, pa.int32()), pa.array(table[k][full])], ["lang", "bucket", "n"]
            )

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    order = {x: i for i, x in enumerate(langs)}
    table = np.zeros((len(langs), BUCKETS + SCRIPTS))
    if langs:
        table[[order[x] for x in got.column("lang").to_pylist()], got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
    log_p = np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32)
    scripts[:, 0] = 0  # marks have no script
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    used &= scripts > 0
    bits = (used * (np.uint32(1) << np.arange(SCRIPTS, dtype=np.uint32))).sum(1).astype(np.uint32)
    return Model(langs, np.ascontiguousarray(log_p), bits)


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; text d has ``count[d]`` words from ``first[d]``.

    All texts of a block advance together, a word at a time, the longest first.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    longest = int(count[0]) if len(count) else 0
    alive = np.searchsorted(-count, -np.arange(longest), side="left") if longest else []
    k = scores.shape[1]
    best_value = np.zeros((len(count), k), np.float32)
    stayed = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    for t in range(longest):
        n = alive[t]
        value, at = best_value[:n], first[:n] + t
        if t:
            came[at] = value.argmax(1)
            moved = value.max(1, keepdims=True) - np.float32(penalty)
            stayed[at] = value >= moved
            np.maximum(value, moved, out=value)
        value += scores[at]
    label = np.zeros(len(scores), np.int16)
    state = best_value.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        label[at] = state[:n]
        if t:
            state[:n] = np.where(stayed[at, state[:n]], state[:n], came[at])
    return label


def _label(model: Model, penalty: float):
    def each(block):
        texts = [x or "" for x in block.column("_text").to_pylist()]
        begin, starts, ends, h, bits = _words(texts)
        n = len(texts)
        langs, score, spans = [UNDETERMINED] * n, np.zeros(n), [[] for _ in range(n)]
        if len(starts) and model.langs:
            lengths = ends - starts
            char0 = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            word_score = np.add.reduceat(model.log_p[h], char0, axis=0)
            seen = np.bitwise_or.reduceat(bits, char0)
            allowed = (seen[:, None] & model.scripts[None, :]) == seen[:, None]
            narrowed = allowed.any(1)
            word_score = np.where(allowed | ~narrowed[:, None], word_score, np.float32(-1e4))
            word_score[~narrowed] = 0  # a script that no language uses says nothing
            doc = np.searchsorted(begin, starts, side="right") - 1
            count = np.bincount(doc, minlength=n)
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
            label = viterbi(word_score, first, count, penalty)
            letters = np.add.reduceat((bits > 0).astype(np.int64), char0)
            k = len(model.langs)
            share = np.bincount(doc * k + label, weights=letters * narrowed, minlength=n * k).reshape(n, k)
            whole = np.bincount(doc, weights=letters, minlength=n)
            total = np.zeros((n, k))
            np.add.at(total, doc, word_score)
            rank = share + 1e-6 / (1 + np.exp(np.clip(total.max(1, keepdims=True) - total, 0, 50)))
            best = rank.argmax(1)
            for d in np.flatnonzero(whole > 0):
                langs[d], score[d] = model.langs[best[d]], share[d, best[d]] / whole[d]
            cut = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
            last = np.concatenate([cut[1:], [len(doc)]]) - 1
            for a, b in zip(cut, last):
                d = doc[a]
                spans[d].append({"start": int(starts[a] - begin[d]), "end": int(ends[b] - begin[d]), "lang": model.langs[label[a]]})
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in block.schema.names if c != "_text"), pa.array(langs), pa.array(score), pa.array(spans, span)],
            [*(c for c in block.schema.names if c != "_text"), "lang_pred", "score", "lang_spans"],
        )

    return each


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text", penalty: float = 8.0) -> DataFrame:
    """``keep`` columns, lang_pred, score (share of the letters in its spans) and
    lang_spans (start and end in code points, lang) of each row."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    return map_blocks(
        rows, "_text", BLOCK_BYTES, lambda: _label(model, penalty),
        f"{kept}lang_pred string, score double, lang_spans array<struct<start:int,end:int,lang:string>>",
    )


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``; learned from the folds other than 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "text", "lang", (fold(F.col("doc_id")) == 2).alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return identify(docs, model, ["doc_id", "held_out"])
