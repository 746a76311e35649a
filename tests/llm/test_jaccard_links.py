"""Op 1 against brute force where step 2 has trees and several blocks, and each document's number of links."""

import random
from collections import Counter

from medallion.llm import jaccard


def corpus():
    """Families of near copies that share a passage, a chain, exact copies, repeated rows, wordless texts."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for family in range(3):
        own = [f"f{family}_{i}" for i in range(60)]
        for _ in range(70):
            words = passage + own
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    line = [f"c{i}" for i in range(200)]
    rows += [" ".join(line[k : k + 100]) for k in range(0, 100, 10)]
    rows += [rows[0]] * 3 + [rows[-1], None, "", "a b", "A  b", "a b c"]
    return [(i, t) for i, t in enumerate(rows)] + [(5, rows[5]), (None, rows[5]), (None, rows[5])]


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root, n = list(range(len(rows))), [0] * len(rows)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and 100 * len(x & y) >= 75 * len(x | y):
                n[a] += 1
                n[b] += 1
                old, new = root[a], root[b]
                if old != new:
                    root = [new if r == old else r for r in root]
    ids = {}
    for (i, _), r in zip(rows, root):
        ids.setdefault(r, []).append(i)
    least = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return Counter((i, len(s), least[r], k) for (i, _), s, r, k in zip(rows, sets, root, n))


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard.near_duplicates(docs, links=True).select("doc_id", "n_shingles", "component_id", "n_links")
    return Counter(map(tuple, out.collect()))


def test_number_of_links(spark):
    rows = corpus()
    assert found(spark, rows) == brute(rows)


def test_number_of_links_by_many_blocks(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    assert found(spark, rows) == brute(rows)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 300)
    assert found(spark, rows) == brute(rows)


def test_links_of_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(docs, links=True).count() == 0
