"""Secret scans over an incremental blob ledger (op 2), DataFrame functions only.

Every version of a path is content-addressed (SHA-256 of its text). The ledger
is a Parquet folder with one row per blob and rule version that was scanned
and what was found. ``scan`` takes the versions' distinct blobs, subtracts
the (blob, rule version) pairs in the ledger, scans one copy of each unseen
blob with the rules it hasn't met, appends those rows, and joins the findings
back to all paths. Blobs are addressed and counted with map-side combining, so a text
that a third of all rows share reaches the shuffle once per task; the way
back salts the paths, and only blobs with findings travel there.

Null text is the empty blob. A path or version that is null or repeats stays as
many rows. Offsets are code points, end exclusive. Overlapping findings of
different kinds are all kept.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import written
from medallion.session import checkpoint_root

# Kind, version, pattern, the group that the least length applies to, that
# length, and words (in small letters) without any of which the pattern can't match.
_ASSIGN = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
RULES = [
    ("assign", "v1", _ASSIGN + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, ["password", "passwd", "secret", "token", "apikey", "api_key"]),
    ("access", "v1", "AKIA[A-Z0-9]+", 1, 18, ["akia"]),
    ("hex", "v1", "[0-9a-f]{16,}", 1, 16, []),
    ("github", "v1", "gh[pousr]_[A-Za-z0-9]{36,}", 1, 40, ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"]),
    ("private_key", "v1", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 1, ["-----begin "]),
]
BASE = ("assign", "access", "hex")
KINDS = [r[0] for r in RULES]
SALTS = 8
#: Matches whose places are summed up in one fold.
STRETCH = 512
FOUND = "array<struct<kind:string,start:int,end:int>>"


def running_sums(lengths: Column) -> Column:
    """Of an array that isn't empty, in stretches: a fold that appends to an array copies it at each step, so
    one over all entries would be quadratic. Stretches cost ``STRETCH`` copies an entry, whatever their number."""

    def append(a: Column, x: Column) -> Column:
        return F.concat(a, F.array((F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x).cast("int")))

    none = F.array().cast("array<int>")
    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STRETCH).cast("int")), lambda k: F.slice(lengths, k * STRETCH + 1, F.lit(STRETCH)))

    def placed(parts: Column) -> Column:  # the stretches, named once
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda t, x: t + x))
        before = F.get(F.transform(F.array(sums), lambda t: F.aggregate(t, none, append)), F.lit(0))
        both = F.arrays_zip(parts.alias("p"), before.alias("b"), sums.alias("t"))
        return F.flatten(F.transform(both, lambda z: F.transform(F.aggregate(z["p"], none, append), lambda e: (e + z["b"] - z["t"]).cast("int"))))

    return F.get(F.transform(F.array(stretches), placed), F.lit(0))


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches of the pattern whose group is long enough.

    Each match is taken together with the text between it and the one before;
    the running sum of both lengths gives its place. The rest of the text is the
    last step, with an empty match, so that it isn't tried from every character
    on. ``pattern``'s own group, if any, is group 2 here, the whole match group 1.
    """
    steps = "(?s).*?(?:(" + pattern + ")|\\z)"
    whole = F.regexp_extract_all(text, F.lit(steps), F.lit(0))
    match = F.regexp_extract_all(text, F.lit(steps), F.lit(1))
    measured = F.regexp_extract_all(text, F.lit(steps), F.lit(2)) if group == 2 else match
    ends = F.get(F.transform(F.array(F.transform(whole, F.length)), running_sums), F.lit(0))
    found = F.arrays_zip(ends.alias("e"), match.alias("m"), measured.alias("g"))
    return F.transform(
        F.filter(found, lambda x: F.length(x["g"]) >= least),
        lambda x: F.struct(F.lit(kind).alias("kind"), (x["e"] - F.length(x["m"])).cast("int").alias("start"), x["e"].cast("int").alias("end")),
    )


def signs(text: Column, rules: list[tuple]) -> Column:
    """A bit for each rule, 0 if the text lacks what every match of the rule holds."""
    def bits(small):  # the small letters once for all rules
        each = [reduce(or_, [small.contains(w) for w in r[5]]) if r[5] else text.rlike(r[2]) for r in rules]
        return reduce(add, [F.when(x, F.lit(1 << k)).otherwise(F.lit(0)) for k, x in enumerate(each)])

    return F.transform(F.array(F.lower(text)), bits)[0]


def findings(text: Column, rule: tuple) -> Column:
    """The rule's spans, worked out only where it matches at all."""
    _, _, pattern, group, least, _ = rule
    return F.when(text.rlike(pattern), spans_of(text, rule[0], pattern, group, least)).otherwise(F.array().cast(FOUND)).cast(FOUND)


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan(versions: DataFrame, keep: list[str], ledger: str, text: str = "text", rules: list[tuple] = RULES) -> DataFrame:
    """``keep`` columns, blob and findings (sorted by start, then rule order) of
    each version, having brought the ledger up to date with the rules."""
    spark = versions.sparkSession
    rows = versions.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("blob", blob(F.col("_text")))
    ids = [f"{r[0]}:{r[1]}" for r in rules]
    seen = None
    if _exists(spark, ledger):
        seen = spark.read.schema(f"blob string, rule string, found {FOUND}").parquet(ledger)
    # texts are read, addressed and looked over once: stored with signs and, where a rule may match, the text;
    # one copy of each blob goes on, by a key that only equal rows share
    rows = rows.withColumn("_signs", signs(F.col("_text"), rules)).withColumn("_copy", F.xxhash64("blob", *keep))
    signed_text = F.when(F.col("_signs") != 0, F.coalesce(F.col(text) if text in keep else F.col("_text"), F.lit("")))
    if text in keep:  # stored once
        rows = written(rows.drop("_text"), "addressed-texts").withColumn("_text", signed_text)
    else:
        rows = written(rows.withColumn("_text", signed_text), "addressed-texts")
    todo = rows.groupBy("blob").agg(F.min("_copy").alias("_copy"), F.max("_signs").alias("_signs"))
    todo = todo.withColumn("rules", F.array(*map(F.lit, ids)))
    if seen is not None:
        met = seen.where(F.col("rule").isin(ids)).groupBy("blob").agg(F.collect_set("rule").alias("met"))  # one per rule at most
        todo = todo.join(met, "blob", "left").withColumn("rules", F.array_except("rules", F.coalesce("met", F.array().cast("array<string>")))).drop("met")
        todo = todo.where(F.size("rules") > 0)
    # the addressing has read every text: rules whose signs it lacks are done, and only texts with signs travel
    signed = F.array_compact(F.array(*[F.when(F.col("_signs").bitwiseAND(1 << k) != 0, F.lit(i)) for k, i in enumerate(ids)]))
    clear = todo.select("blob", F.explode(F.array_except("rules", signed)).alias("rule"), F.array().cast(FOUND).alias("found"))
    due = todo.withColumn("rules", F.array_intersect("rules", signed)).where(F.size("rules") > 0).drop("_signs")
    unseen = rows.where("_signs <> 0").select("blob", "_copy", "_text").join(due.hint("shuffle_hash"), ["blob", "_copy"])
    fresh = F.array(
        *[F.struct(F.lit(i).alias("rule"), F.when(F.array_contains("rules", i), findings(F.col("_text"), r)).alias("found")) for i, r in zip(ids, rules)]
    )
    done = unseen.select("blob", F.explode(F.filter(fresh, lambda x: x["found"].isNotNull())).alias("x")).select("blob", "x.rule", "x.found")
    done = done.unionByName(clear)
    done.write.mode("append").parquet(ledger)
    ledgered = spark.read.schema(f"blob string, rule string, found {FOUND}").parquet(ledger)
    order = F.array(*map(F.lit, [r[0] for r in rules]))
    hits = (
        ledgered.where(F.col("rule").isin(ids) & (F.size("found") > 0))
        .groupBy("blob")
        .agg(F.flatten(F.collect_set("found")).alias("f"))  # a blob's rules
        .select(
            "blob",
            F.transform(
                F.array_sort(F.transform("f", lambda x: F.struct(x["start"], F.array_position(order, x["kind"]).alias("k"), x["end"], x["kind"]))),
                lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
            ).alias("findings"),
        )
    )
    salted = hits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = rows.drop("_text", "_signs", "_copy").withColumn("_salt", F.pmod(F.xxhash64(*keep), F.lit(SALTS)).cast("int"))
    return paths.join(salted, ["blob", "_salt"], "left").select(*keep, "blob", F.coalesce("findings", F.array().cast(FOUND)).alias("findings"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with each found stretch (overlaps united) replaced by [kind] of its first finding."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda s, x: F.when(
        x["start"] >= s["at"],
        F.struct(
            F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), x["kind"], F.lit("]")).alias("out"), x["end"].alias("at")
        ),
    ).otherwise(F.struct(s["out"].alias("out"), F.greatest(s["at"], x["end"]).alias("at")))
    return F.when(F.size(found) == 0, text).otherwise(
        F.aggregate(found, zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    )


def new_ledger(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/secret-ledger-{uuid.uuid4().hex}"


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``, each document a path with one version, into a new ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, ["doc_id"], new_ledger(spark))
    of = lambda *kinds: F.filter("findings", lambda x: x["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(*BASE)), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), "blob",
    )


def op2_secret_ledger(spark, sf_dir: str) -> DataFrame:
    """``documents`` scanned with the base rules, then with all rules onto the same ledger, where only
    the pairs of the new rules are unseen: each document's spans, and how often its blob met a rule."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = new_ledger(spark)
    scan(docs, ["doc_id"], ledger, rules=[r for r in RULES if r[0] in BASE])
    found = scan(docs, ["doc_id"], ledger)
    met = spark.read.schema(f"blob string, rule string, found {FOUND}").parquet(ledger)
    met = met.groupBy("blob").agg(F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("rule").alias("n_rules"))
    salted = written(met.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "pairs-of-blobs")
    found = written(found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")), "spans-of-paths")
    return found.join(salted, ["blob", "_salt"], "left").select("doc_id", joined(F.col("findings")).alias("spans"), "n_pairs", "n_rules")
