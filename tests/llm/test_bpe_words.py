"""Words of ASCII texts by both matchers, and the cache's turns (op 8)."""

import itertools

import public_tokenizers as P
from tokenizers import Tokenizer

from medallion.llm import bpe


def test_both_matchers_cut_ascii_alike():
    every = "".join(map(chr, range(128)))
    for pair in itertools.product(every, repeat=2):
        s = "".join(pair)
        assert bpe.words_of(s) == bpe.WORDS.findall(s)
    for four in itertools.product("a1 \t\n\x0b\x0c\r\x1c\x1f!'stred\x00_", repeat=4):
        s = "".join(four)
        assert bpe.words_of(s) == bpe.WORDS.findall(s)


def test_turns_of_the_cache_change_no_ids(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 40)
    mine, library = bpe.Encoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for i in range(30):
        texts = [f"word{i * k} it's thwordé{k} again and again  {i}\n" for k in range(12)]
        assert mine.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert mine.older and len(mine.words) < 200
