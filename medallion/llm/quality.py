"""Quality classifier by hierarchical empirical Bayes (op 6).

1. Up to ``FIT_ROWS`` labelled ids (those with the least hash) are the sample to fit to.
   On one half of it words and neighbouring pairs of words, hashed to ``BUCKETS``, get
   log odds of good against bad, smoothed toward the bucket's overall share. Each text
   then gives the mean log odds of what it holds, and a few numbers of its surface (shares
   of letters, capitals, digits, marks and repeated words, word length, size). A logistic
   regression on those, fitted to the other half, so that words aren't judged by the
   labels that taught them, gives the document's own evidence as log odds against the
   global rate.
2. All documents vote for their host and path with what is known of them: the
   label, or the classifier's probability. Grouped sums give each host's and
   path's rate, shrunk: the host toward the global rate, the path toward its host,
   by a strength estimated from the spread between hosts, and between paths in hosts
   (moments). A site with few documents stays near its prior.
3. A document's posterior log odds are the path's prior plus its evidence.

The sums are map-side combined; the way back salts the documents, so a host of a
third of all rows is no hot key. Null or empty text has all-zero numbers; null host
or path is a site of its own. Documents labelled more than once count with the
mean; null labels don't count. With labels of one class only, or none, the
evidence is 0 and the rates decide. Repeated rows vote as often as they occur. Ties at
the cut of the sample fall to the hash; equal texts have equal evidence. Whole texts of
any length count, in blocks. An empty table gives no rows. ``keep`` columns can't be
named like the results.

Host and path are columns of the documents: for crawled pages the registered host and the
first path segment of the url; ``documents`` has no url, so its query takes source and lang.
``held_out`` measures the posterior against its two parts on labels that nothing was fitted to.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm import _hashing as H
from medallion.llm._blocks import blocks, configure, map_blocks, written

FIT_ROWS = 20_000
BLOCK_BYTES = 4 << 20
SALTS = 16
#: Buckets of hashed words and pairs; rows of the smoothing.
BUCKETS = 1 << 16
SMOOTH = 2000.0
#: Steps of the probabilities that ``held_out`` ranks by.
STEPS = 10_000
NUMBERS = ("letters", "capitals", "digits", "marks", "doubled_marks", "bars", "distinct_words", "top_word", "repeated_neighbours", "word_length", "distinct_lines", "log_words", "word_odds")
_KIND = np.zeros(256, np.uint8)  # by byte: 1 lower or beyond ASCII, 2 capital, 3 digit, 4 mark
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[b for b in range(33, 127) if not _KIND[b]]] = 4


def surface(text: str) -> list[float]:
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * (len(NUMBERS) - 1)
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    of = np.bincount(kind, minlength=5)
    solid = max(1, len(raw) - of[0])
    mark = kind == 4
    doubled = int((mark[1:] & (raw[1:] == raw[:-1])).sum())
    count = Counter(words)
    lines = data.split(b"\n")
    same = sum(a == b for a, b in zip(words, words[1:]))
    n = len(words)
    return [
        (of[1] + of[2]) / solid, of[2] / solid, of[3] / solid, of[4] / solid, doubled / solid, count[b"|"] / n,
        len(count) / n, max(count.values()) / n, same / n, solid / n / 10, len(set(lines)) / len(lines), float(np.log1p(n)) / 10,
    ]


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and bucket of each word and each pair of neighbouring words, in small letters."""
    buffer, begin = H.joined(texts)
    _, _, word, first = H.words(buffer, begin, lower=True)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    inside = of[1:] == of[:-1]
    both = np.concatenate([word, H.word_grams(word, 2)[inside]])
    return np.concatenate([of, of[:-1][inside]]), (both >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _counted(batches):
    """Good and bad occurrences of each bucket, one row a task and bucket."""
    good, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for block in blocks(batches, "_t", BLOCK_BYTES):
        of, bucket = grams([(t or "").encode() for t in block.column("_t").to_pylist()])
        y = block.column("_y").to_numpy(zero_copy_only=False)[of]
        good += np.bincount(bucket, y, BUCKETS)
        bad += np.bincount(bucket, 1 - y, BUCKETS)
    met = np.flatnonzero(good + bad)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(good[met]), pa.array(bad[met])], ["bucket", "good", "bad"])


def word_odds(labelled: DataFrame) -> np.ndarray:
    """Log odds of each bucket from (_t, _y) rows; zeros without rows of both kinds. The driver gets ``BUCKETS`` rows at most."""
    rows = labelled.select("_t", "_y").mapInArrow(_counted, "bucket long, good double, bad double")
    found = rows.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    good, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = found.column("bucket").to_numpy()
    good[at], bad[at] = found.column("good").to_numpy(), found.column("bad").to_numpy()
    if not good.sum() or not bad.sum():
        return np.zeros(BUCKETS, np.float32)
    share = SMOOTH * (good + bad + 1) / (good + bad + 1).sum()
    return (np.log((good + share) / (good.sum() + SMOOTH)) - np.log((bad + share) / (bad.sum() + SMOOTH))).astype(np.float32)


def measured(docs: DataFrame, keep: list[str], odds: np.ndarray, text: str = "text") -> DataFrame:
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")

    def each(block):
        names = [c for c in block.schema.names if c != "_text"]
        texts = [t or "" for t in block.column("_text").to_pylist()]
        of, bucket = grams([t.encode() for t in texts])
        total = np.bincount(of, odds[bucket], len(texts)) / np.maximum(np.bincount(of, minlength=len(texts)), 1)
        out = pa.array([[*surface(t), float(x)] for t, x in zip(texts, total)], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names), out], [*names, "_numbers"])

    return map_blocks(rows, "_text", BLOCK_BYTES, lambda: each, kept + "_numbers array<double>")


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps: intercept first; zeros if y has one value."""
    w = np.zeros(x.shape[1] + 1)
    if len(y) == 0 or y.min() == y.max():
        return w
    x = np.hstack([np.ones((len(x), 1)), x])
    keep = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-9 * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, prior: str) -> float:
    """Beta prior strength by moments, from (votes, good) and the prior rate of each group.

    Spread between groups beyond the binomial part, over all groups; 1 to 1e6.
    """
    r = F.col("good") / F.col("votes")
    got = groups.agg(
        F.sum(F.col("votes") * (r - F.col(prior)) ** 2).alias("spread"),
        F.sum(F.col(prior) * (1 - F.col(prior))).alias("noise"),
        F.sum(F.col("votes") * F.col(prior) * (1 - F.col(prior))).alias("scale"),
        F.count(F.lit(1)).alias("groups"), F.sum("votes").alias("votes"),
    ).first()
    if not got["groups"] or not got["scale"] or got["votes"] <= got["groups"]:
        return 1.0
    share = (got["spread"] - got["noise"]) / max(got["scale"] - got["noise"], 1e-12)  # the groups' intraclass correlation
    return float(np.clip(1 / share - 1, 1, 1e6)) if share > 1e-6 else 1e6


def classify(docs: DataFrame, labels: DataFrame, keep: list[str], id_col: str = "doc_id", host: str = "source", path: str = "lang", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``keep`` columns, evidence, classifier (the probability that evidence and the sample's rate
    give, without sites), host_rate, path_rate, posterior (0 to 1) and good."""
    rows = docs.select(*keep, F.col(id_col).alias("_id"), F.col(host).cast("string").alias("_host"), F.col(path).cast("string").alias("_path"), F.col(text).alias("_t"))
    rows = rows.withColumn("_host", F.coalesce(F.concat(F.lit("h"), "_host"), F.lit(""))).withColumn("_path", F.coalesce(F.concat(F.lit("p"), "_path"), F.lit("")))
    own = [*keep, "_id", "_host", "_path"]
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y")).where("_id is not null and _y is not null").groupBy("_id").agg(F.avg("_y").alias("_y"))
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows).withColumn("_half", F.pmod(F.xxhash64(F.lit("half"), "_id"), F.lit(2)))
    drawn = written(drawn, "fit-sample")  # fit_rows short rows at most: fit for a broadcast
    configure(docs.sparkSession)
    odds = word_odds(rows.select("_id", "_t").join(F.broadcast(drawn.where("_half = 0").select("_id", (F.col("_y") >= 0.5).cast("double").alias("_y"))), "_id"))
    table = written(measured(rows, own, odds, "_t").join(known, "_id", "left"), "quality-numbers")

    sample = table.join(F.broadcast(drawn.where("_half = 1").select("_id")), "_id", "left_semi")
    sample = sample.orderBy(F.xxhash64("_id", "_numbers")).limit(fit_rows).select("_numbers", "_y").toArrow()
    x = np.array(sample.column("_numbers").to_pylist(), float).reshape(-1, len(NUMBERS))
    y = np.array(sample.column("_y").to_pylist(), float)
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(len(NUMBERS)), np.ones(len(NUMBERS)))
    w = fit((x - mean) / scale, (y >= 0.5).astype(float))
    weights, shift = w[1:] / scale, float(w[0] - (w[1:] * mean / scale).sum())
    own_odds = F.lit(shift)
    for k, v in enumerate(weights.tolist()):
        own_odds = own_odds + F.col("_numbers")[k] * v
    rate = float(np.clip((y >= 0.5).mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    evidence = (own_odds - base) if np.any(w) else F.lit(0.0)
    table = table.withColumn("evidence", F.greatest(F.lit(-20.0), F.least(F.lit(20.0), evidence)))
    table = table.withColumn("classifier", 1 / (1 + F.exp(-(F.col("evidence") + base))))
    vote = F.coalesce("_y", "classifier")

    paths = written(table.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("votes"), F.sum(vote).alias("good")), "path-votes")
    hosts = paths.groupBy("_host").agg(F.sum("votes").alias("votes"), F.sum("good").alias("good"))
    all_ = hosts.agg(F.sum("votes").alias("votes"), F.sum("good").alias("good")).first()
    world = float(np.clip(all_["good"] / all_["votes"], 1e-3, 1 - 1e-3)) if all_["votes"] else 0.5
    hosts = hosts.withColumn("prior", F.lit(world))
    a = _strength(hosts, "prior")
    hosts = hosts.select("_host", ((F.col("good") + a * world) / (F.col("votes") + a)).alias("host_rate"))
    paths = written(paths.join(hosts, "_host"), "path-priors")
    b = _strength(paths, "host_rate")
    rates = paths.select("_host", "_path", "host_rate", ((F.col("good") + b * F.col("host_rate")) / (F.col("votes") + b)).alias("path_rate"))

    salted = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = table.drop("_numbers").withColumn("_salt", F.pmod(F.xxhash64("_id", "evidence"), F.lit(SALTS)).cast("int"))
    out = out.join(salted, ["_host", "_path", "_salt"], "left")
    posterior = 1 / (1 + F.exp(-(_logit(F.col("path_rate")) + F.col("evidence"))))
    return out.select(*keep, "evidence", "classifier", "host_rate", "path_rate", posterior.alias("posterior"), (posterior >= 0.5).alias("good"))


def held_out(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", **columns) -> dict[str, tuple[float, float]]:
    """(AUC, log-loss) of classifier, path_rate and posterior on the labelled ids whose crc32 mod 4 is 2, learned from the others.

    AUC counts ties half, by probabilities rounded to one in ``STEPS``: that many grouped rows reach the driver.
    """
    out = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2
    truth = labels.where(out & F.col(label).isNotNull()).select(F.col(id_col).alias("_asked"), (F.col(label) >= 0.5).alias("_true"))
    found = classify(docs, labels.where(~out), [id_col], id_col, label=label, **columns)
    found = written(found.join(truth, F.col(id_col) == F.col("_asked")), "held-out")
    scores = {}
    for c in ("classifier", "path_rate", "posterior"):
        p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col(c)))
        loss = -F.log(F.when(F.col("_true"), p).otherwise(1 - p))
        got = found.groupBy(F.floor(F.col(c) * STEPS).alias("step")).agg(F.count_if("_true").alias("good"), F.count_if(~F.col("_true")).alias("bad"), F.sum(loss).alias("loss")).orderBy("step").toArrow()
        good, bad, loss = (got.column(k).to_numpy().astype(float) for k in ("good", "bad", "loss"))
        pairs = good.sum() * bad.sum()
        below = np.cumsum(bad) - bad
        auc = float((good * (below + bad / 2)).sum() / pairs) if pairs else float("nan")
        scores[c] = (auc, float(loss.sum() / max(good.sum() + bad.sum(), 1)))
    return scores


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``; its host is the source, its path the language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ["doc_id"]).drop("classifier")
