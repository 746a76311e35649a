"""URL filters, periodic runs and whitening against plain Python: nulls, empty and long inputs, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import periodic_runs, url_filters, whitening

# --- op 11

URLS = [
    "http://Blog.Example.ORG/es/1?x=/en/1", "https://example.org/en/19", "https://example.org/en/2", "http://example.org", "http://example.org?/es/",
    "http://notexample.org/es/1", "http://a.com/fr/", "http://a.com/fr", "http://COM/de/x#y", "http://x.net/", "ftp://u@org:80/", "no scheme", "", None,
    "://org/", "http:///path", "http://a.org/x://y", "http://org./", "http://" + "a." * 20_000 + "org/" + "p" * 50_000, "http://example.org/es/1\n2",
]


def fitting(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([len(path), *(path.index(c) for c in "?#" if c in path)])]
    fits = [
        (len(h + p), len(h), h + p, v == "block", v) for h, p, v in rules
        if h and "/" not in h and (not p or p[0] == "/") and (host == h or host.endswith("." + h)) and path.startswith(p) and host
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[4] if best else default


def judged(spark, urls, rules, **how):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return url_filters.filter_urls(pages, table, ["page_id", "host"], **how)


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_filters_against_plain_python(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filters, "BROADCAST_RULES", 0)
    random.seed(3)
    urls = URLS + [f"http://{'.'.join(random.choices('ab', k=random.randint(1, 4)))}/{'/'.join(random.choices('xy', k=random.randint(0, 3)))}" for _ in range(200)] + ["http://a.b/x"] * 40
    rules = url_filters.RULES + [("a", "/", "block"), ("b", "/x", "allow"), ("a.b", "/x", "block"), ("a.b", "/x", "allow"), ("b", "", "block"), ("b.a", "/x/y", "allow")]
    rules += [("", "/", "block"), ("a/b", "", "block"), ("a", "x", "block")]
    got = judged(spark, urls, [*rules, (None, "/", "block")]).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == fitting(urls[r.page_id], rules), urls[r.page_id]


def test_url_filters_without_rules_or_pages(spark):
    assert {(r.rule, r.verdict) for r in judged(spark, URLS, [], default="review").collect()} == {(None, "review")}
    assert judged(spark, [], url_filters.RULES).collect() == []


# --- op 12


def runs_by_hand(w, least=24, exponent=3):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if len(s) >= max(least, exponent * q) and not any(all(s[k] == s[k + p] for k in range(len(s) - p)) for p in range(1, q)):
                out.append((i, len(s), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_texts_against_every_period():
    random.seed(1)
    for _ in range(1500):
        texts = []
        for _ in range(random.randint(1, 5)):
            t = [random.randrange(random.choice([1, 2, 3, 30])) for _ in range(random.randint(0, 60))]
            if random.random() < 0.5 and len(t) > 5:
                p, a = random.randint(1, 8), random.randrange(len(t))
                t = [t[i] if i < a else t[min(len(t) - 1, a + (i - a) % p)] for i in range(len(t))]
            texts.append(t)
        least, exponent = random.choice([1, 4, 24]), random.choice([2, 3])
        first = np.cumsum([0, *map(len, texts)])
        if first[-1]:
            want = sorted(((a + int(f), b, c) for t, f in zip(texts, first) for a, b, c in runs_by_hand(t, least, exponent)), key=lambda r: (r[0], r[2]))
            assert periodic_runs.runs_of(np.array(sum(texts, []), np.int64), first, least, exponent) == want


def test_fibonacci_words_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    for w in (b, [0] * 500, ([0, 1] * 20 + [2]) * 6):
        assert periodic_runs.runs_of(np.array(w, np.int64), np.array([0, len(w)]), 24, 3) == runs_by_hand(w)


PERIODIC = [
    (1, "a b c " * 10, 1), (1, "a b c " * 10, 1), (2, None, 1), (3, "", 1), (4, " \t\n ", 1), (5, "x " * 23, 1), (6, "x " * 24, 1), (None, "A a " * 30 + "end", 1),
    (7, "\u00e4 \u00a0 " * 20, 1), (8, "w " * 100_000, 1), (9, " ".join(map(str, range(50_000))), 1), (10, "p q " * 12 + "z " + "p q " * 12, 1),
]


def test_find_runs_of_a_table(spark):
    docs = spark.createDataFrame(PERIODIC, "doc_id long, text string, runs int")
    got = periodic_runs.find_runs(docs, ["doc_id", "runs"]).collect()
    assert got[0].asDict().keys() == {"doc_id", "n_words", "runs", "collapsed"}
    want = []
    for i, t, _ in PERIODIC:
        w = (t or "").encode().split()
        runs = runs_by_hand(w) if len(w) < 5000 else [(0, 100_000, 1)] if i == 8 else []
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        want.append((i, len(w), runs, b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs.find_runs(docs.limit(0), ["doc_id"]).collect() == []


def test_op12_query_against_plain_python(spark, tmp):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate([None, "", "a b " * 30, "x y z"] * 30)], docs.schema))
    docs.write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: r for r in periodic_runs.op12_periodic_runs(spark, tmp).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    seen = 0
    for r in rows:
        w = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        x = got[r.doc_id]
        # all periods of a long text by hand would take minutes: the others are covered by the tests above
        if n > 1500:
            continue
        runs = runs_by_hand(w)
        best = min(runs, key=lambda t: (-t[1] / t[2], t[0], t[2]), default=None)
        seen += bool(runs)
        gone = {k for a, m, q in runs for k in range(a + q, a + m)}
        assert x.n_runs == len(runs)
        assert (x.start, x.length, x.period) == (best or (None,) * 3)
        assert x.exponent_milli == (best and 1000 * best[1] // best[2])
        assert x.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(b" ".join(v for k, v in enumerate(w) if k not in gone)).hexdigest()
    assert seen > 20


# --- op 13


def whitened_by_hand(vectors, scale=256):
    x = [tuple(math.floor(scale * c) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), object)
    n, sums = len(fit), fit.sum(0)
    u = n * fit - sums
    cross = u.T @ u
    e, v = np.linalg.eigh(np.array([[float(c) / n**3 for c in row] for row in cross]))
    return x, n, sums, e[::-1], v[:, ::-1].T, float(sum(cross[k][k] for k in range(len(cross)))) / n**3


def check_whitening(got, vectors, dim):
    x, n, sums, e, axes, trace = whitened_by_hand(vectors)
    assert Counter(r.component for r in got) == {k + 1: len(vectors) for k in range(min(4, dim))}
    sign = {}
    for r in got:
        u = [n * a - int(s) for a, s in zip(x[r.vec_id], sums)]
        k = r.component - 1
        assert r.n == n and int(r.deviation) == sum(v * v for v in u)
        y = float(np.dot([float(v) / n for v in u], axes[k])) / math.sqrt(e[k])
        if abs(y) > 1e-6:
            sign.setdefault(k, 1 if y * r.whitened > 0 else -1)
        assert r.whitened == pytest.approx(sign.get(k, 1) * y, rel=1e-6, abs=1e-6)
        assert r.explained == pytest.approx(e[k] / trace, rel=1e-6)
        assert 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("size", [1.0, 1e10])
def test_whitening_against_numpy(spark, size):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 6)) * [5, 4, 3, 2, 1, 0.5] * size).tolist()
    vectors += [vectors[0]] * 50
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    check_whitening(whitening.whiten(table, ["vec_id"]).collect(), vectors, 6)


def test_op13_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    check_whitening(whitening.op13_whitening(spark, sf).collect(), [r.embedding for r in rows], 64)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [3.0, -1.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1e300, 0.0], 1), (7, [1.0], 1), (8, [], 1), (1, [3.0, -1.0], 1), (None, [-0.0, 0.5], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got = whitening.whiten(table, ["vec_id", "n"]).collect()
    assert Counter(r.vec_id for r in got) == {0: 2, 1: 4, None: 2}
    assert {r.n for r in got} == {3}
    flat = whitening.whiten(table.where("vec_id = 1"), ["vec_id"]).collect()
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in flat} == {(1, 0, None, None, None)} and len(flat) == 4
    line = spark.createDataFrame([(i, [float(i), float(-i)]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(line, ["vec_id"]).collect()
    assert {r.component: (r.whitened is None, r.explained) for r in got} == {1: (False, pytest.approx(1.0)), 2: (True, None)}
    for none in (table.limit(0), table.where("vec_id = 8"), table.where("vec_id = 2")):
        assert whitening.whiten(none, ["vec_id"]).collect() == []
    wide = spark.createDataFrame([(i, [math.ldexp(1 + i, 50), 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert [int(r.deviation) for r in whitening.whiten(wide, ["vec_id"]).where("component = 1").orderBy("vec_id").collect()] == [(4 * (i + 1) - 10) ** 2 << 116 for i in range(4)]


def test_limbs_carry_any_integer():
    for v in (0, -1, 1 << 61, -(1 << 61), 1 << 200, -(3**150), (1 << 62) - 1, -(1 << 62), 12345678901234567890):
        b = whitening._limbs([v], 7)
        assert sum(p << 48 * k for p, k in zip(b.column("part").to_pylist(), b.column("limb").to_pylist())) == v
        assert set(b.column("place").to_pylist()) == {7}
    assert F
