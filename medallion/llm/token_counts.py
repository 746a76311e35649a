"""Offset-mapped token counts (op 4).

A document is encoded once, as a whole; each token's span follows from the
lengths of the tokens before it. An interval join of token spans with the
sections of the text (by binary search in the sorted section starts)
attributes the tokens, and a token that crosses a boundary goes by the rule:

* ``first``: to the section of its first byte,
* ``last``: to the section of its last byte,
* ``split``: to each section by the share of its bytes.

Sections are the lines of the text, each with its newline, or the (start, end)
code-point intervals of a column, sorted and not overlapping; what lies between
them counts as ``outside``. Null or empty text: no tokens; one empty section
(0, 0) by lines. Null sections: none. Repeated rows come out as often as they come in; an empty table gives an
empty one. Very long texts are encoded whole: where white space runs on for ``LONG_SPACE`` characters, which the
encoder's own pattern matcher can't take, the same pattern cuts the text by another matcher and
the pieces are encoded one by one. No shuffle.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import map_blocks

BLOCK_BYTES = 4 << 20
RULES = ("first", "last", "split")
#: White space on end from which a text is cut before it is encoded.
LONG_SPACE = 50_000
_LONG_SPACE = regex.compile(r"\s{%d}" % LONG_SPACE)


@lru_cache(1)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        length[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), length


def encode(encoding, pattern: str, text: str) -> list[int]:
    """Ids of the whole text."""
    if len(text) < LONG_SPACE or not _LONG_SPACE.search(text):
        return encoding.encode_ordinary(text)
    return [i for piece in regex.finditer(pattern, text) for i in encoding._encode_single_piece(piece[0].encode())]


def _attribute(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str):
    """Tokens by section, tokens that begin in a section and end beyond it, tokens outside all sections.

    ``ends``: byte ends of the tokens; ``starts``, ``stops``: byte ranges of the sections.
    """
    n = len(starts)
    begin = np.concatenate([[0], ends[:-1]])
    crossing = np.zeros(n, np.int64)

    def at(byte):
        k = np.searchsorted(starts, byte, side="right") - 1
        return np.where((k >= 0) & (byte < stops[np.maximum(k, 0)]), k, -1) if n else np.full(len(byte), -1)

    head, tail = at(begin), at(ends - 1)
    cross = (head >= 0) & (tail != head)
    np.add.at(crossing, head[cross], 1)
    if rule == "split":
        # bytes of token t before byte x, summed over t: piecewise linear in x
        whole = np.concatenate([[0], ends]).astype(float)
        upto = lambda x: np.interp(x, whole, np.arange(len(whole)))
        tokens = upto(stops) - upto(starts)
    else:
        owner = head if rule == "first" else tail
        tokens = np.bincount(owner[owner >= 0], minlength=n).astype(float)
    return tokens, crossing, len(ends) - float(tokens.sum())


def attribute_tokens(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", sections: str | None = None, rule: str = "first") -> DataFrame:
    """``keep`` columns, n_tokens, n_crossing, outside and sections (start and end in
    code points, tokens, crossing) of each row."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(*keep, F.col(text).alias("_text"), *([F.col(sections).alias("_sections")] if sections else []))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name in keep)

    def make():
        encoding, length = _encoding(path, pattern)

        def each(block):
            n, crossing, outside, out = [], [], [], []
            given = block.column("_sections").to_pylist() if sections else [None] * block.num_rows
            for text, own in zip(block.column("_text").to_pylist(), given):
                text = text or ""
                data = text.encode()
                ends = np.cumsum(length[np.array(encode(encoding, pattern, text), np.int64)])
                raw = np.frombuffer(data, np.uint8)
                point = np.flatnonzero((raw & 0xC0) != 0x80)  # byte of each code point
                if sections:
                    place = np.append(point, len(data))
                    pairs = [(min(s["start"], len(point)), min(s["end"], len(point))) for s in own or ()]
                    starts, stops = (place[[p[k] for p in pairs]] if pairs else np.zeros(0, np.int64) for k in (0, 1))
                    shown = pairs
                else:
                    cut = np.flatnonzero(raw == 10) + 1
                    starts = np.unique(np.concatenate([[0], cut[cut < len(data)]])).astype(np.int64)
                    stops = np.append(starts[1:], len(data))
                    shown = list(zip(np.searchsorted(point, starts).tolist(), np.searchsorted(point, stops).tolist()))
                tokens, over, rest = _attribute(ends, starts, stops, rule)
                n.append(len(ends))
                crossing.append(int(over.sum()))
                outside.append(rest)
                out.append([{"start": a, "end": b, "tokens": t, "crossing": c} for (a, b), t, c in zip(shown, tokens.tolist(), over.tolist())])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("tokens", pa.float64()), ("crossing", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(crossing, pa.int64()), pa.array(outside, pa.float64()), pa.array(out, kind)],
                [*keep, "n_tokens", "n_crossing", "outside", "sections"],
            )

        return each

    return map_blocks(
        rows, "_text", BLOCK_BYTES, make,
        kept + "n_tokens long, n_crossing long, outside double, sections array<struct<start:int,`end`:int,tokens:double,crossing:int>>",
    )


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every whole text of ``documents``; a crossing token counts where it begins."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return attribute_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])
