"""Offset-mapped token counts against plain Python, with the ids of another library."""

import json

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from medallion.llm import token_counts
from medallion.llm.bpe import byte_letters

TEXTS = [
    "one two\nthree  four\n\nfive", "", None, "\n\n\n", "no newline", "café 你好\n\U0001f600\U0001f600 x\n", "a" * 3000 + "\n" + " " * 3000 + "b",
    "it's\n'll we\n ll", "tabs\t\tand\r\nlines x", "one two\nthree  four\n\nfive",
]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    letters = byte_letters()
    vocab = json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))["model"]["vocab"]
    size = {v: len(k) for k, v in vocab.items() if all(c in letters for c in k)}
    return lambda text: [size[i] for i in own.encode(text, add_special_tokens=False).ids]


def by_hand(sizes, text, sections, rule):
    """Tokens and crossing of each section (code points), tokens outside, byte by byte."""
    at = [0]
    for c in text:
        at.append(at[-1] + len(c.encode()))
    spans = [(at[min(a, len(text))], at[min(b, len(text))]) for a, b in sections]
    owner = lambda byte: next((k for k, (a, b) in enumerate(spans) if a <= byte < b), None)
    tokens, crossing, outside, begin = [0.0] * len(spans), [0] * len(spans), 0.0, 0
    for size in sizes:
        owners = [owner(b) for b in range(begin, begin + size)]
        if owners[0] is not None and owners[-1] != owners[0]:
            crossing[owners[0]] += 1
        for k in {"first": owners[:1], "last": owners[-1:], "split": owners}[rule]:
            share = 1 / size if rule == "split" else 1
            if k is None:
                outside += share
            else:
                tokens[k] += share
        begin += size
    return tokens, crossing, outside


def lines_of(text):
    cut = [0, *(i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)), len(text)]
    return list(zip(cut, cut[1:])) if text else [(0, 0)]


@pytest.mark.parametrize("rule", token_counts.RULES)
@pytest.mark.parametrize("given", [False, True])
def test_attribution_by_every_rule(spark, library, rule, given):
    own = [[(0, 3), (5, 6), (6, 9), (9, 2000)], [(2, 4), (400, 500)], [], None]
    rows = [(i, t, own[i % 4] and [{"start": a, "end": b} for a, b in own[i % 4]], 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, parts array<struct<start:int,`end`:int>>, n_tokens int")
    got = token_counts.attribute_tokens(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, ["doc_id"], sections="parts" if given else None, rule=rule).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(TEXTS)))
    for r in got:
        text = TEXTS[r.doc_id] or ""
        sections = (own[r.doc_id % 4] or []) if given else lines_of(text)
        sections = [(min(a, len(text)), min(b, len(text))) for a, b in sections]
        sizes = library(text)
        tokens, crossing, outside = by_hand(sizes, text, sections, rule)
        assert r.n_tokens == len(sizes) and r.n_crossing == sum(crossing)
        assert [(s.start, s.end) for s in r.sections] == sections
        assert [s.tokens for s in r.sections] == pytest.approx(tokens, abs=1e-6)
        assert [s.crossing for s in r.sections] == crossing
        assert r.outside == pytest.approx(outside, abs=1e-6)


def test_very_long_runs(spark):
    million = 1_000_000
    texts = [" " * million, "\n" * million, "a" * million, "x" + " " * million + "b c", "x\n" + "\t" * million]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in token_counts.attribute_tokens(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, ["doc_id"]).collect()}
    assert [len(got[i].sections) for i in range(5)] == [1, million, 1, 1, 2]
    for r in got.values():
        assert sum(s.tokens for s in r.sections) == r.n_tokens > 0


def test_cutting_changes_no_token():
    encoding, _ = token_counts._encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for text in ("  a b\n\n c" * 50, " " * 60_000 + "word", "w" + "\n" * 60_000, " \t" * 30_000 + "é x  ", "a  " + " " * 55_000 + "  b " + "\r\n" * 30_000):
        long_ = token_counts._LONG_SPACE.search(text) is not None
        assert long_ == (len(text) > 10_000)
        assert token_counts.encode(encoding, P.PATTERN, text) == encoding.encode_ordinary(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert token_counts.attribute_tokens(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, ["doc_id"]).collect() == []
