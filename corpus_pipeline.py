"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. ``language_id``: documents without letters go, and those so largely in scripts
   that no learned language uses that no language has a quarter of the letters.
   Mixed or unclear texts in known scripts stay: of the four languages that
   ``documents`` has, the largest share is a quarter at least.
2. ``ngram_jaccard``: of each group of near duplicates one document stays.
3. ``decontaminate``: documents contaminated by ``benchmark`` go.
4. ``secret_scan``: each secret gives way to [kind]; n_chars follows.
5. ``bpe``: ids of every text that is left, with digests of ids and decoded text.

All but the last return the columns they get. Columns travel under
names of their own, so extra columns can't clash with an operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import bpe, decontaminate, jaccard, languages, secrets
from medallion.llm._blocks import written

#: Least share of a text's letters that its language must have. With four languages or
#: fewer only letters of unknown scripts can bring the largest share below it.
LEAST_SCORE = 0.25
#: SQL can't express BPE, Viterbi or the components; run() is tested against plain Python (tests/llm/test_brute_force.py).
ORACLE_SQL = None


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, dict(zip(docs.columns, names))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are ``und`` or largely in unknown scripts, not mixed ones; learns from the labelled rows of the same folds as op 7."""
    model = languages.train(docs.where(languages.fold(F.col("doc_id")) != 2))
    rows, names, at = _plain(docs)
    found = languages.identify(rows, model, names, at["text"])
    kept = found.where((F.col("lang_pred") != languages.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*names).toDF(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each component."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    rows, names, at = _plain(docs)
    found = decontaminate.scan(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names, at["text"])
    return found.where(~F.col("contaminated")).select(*names).toDF(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in the texts; a null text stays null."""
    rows, names, at = _plain(docs)
    found = secrets.scan(rows, names, secrets.new_ledger(spark), at["text"])
    text = secrets.redact(F.col(at["text"]), F.col("findings"))
    out = {c: F.col(n) for c, n in at.items()} | {"text": text}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.size("findings") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return found.select(*(v.alias(c) for c, v in out.items()))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every text."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontamination),
    ("secret_scan", secret_scan),
    ("bpe", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
