"""Data-quality checks as Spark jobs (Q01-Q05).

Failures are counted the way the declared tests define them:

* ``unique``          — number of non-NULL values that occur more than once;
* ``not_null``        — number of NULL rows;
* ``accepted_values`` — number of distinct non-NULL values outside the list;
* ``relationships``   — number of child rows whose non-NULL key is missing
  from the parent.

Cost per relation: ONE pass for all its ``not_null`` and
``accepted_values`` tests together that shuffles violations only, ONE partially aggregated exchange of
64-bit hashes for all its ``unique`` columns, and one
left-anti join per relationship. Values themselves are compared only where a hash repeats. Reports are DataFrames, so a suite over
many relations is a single union the caller can write or collect (it has
one row per test).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.session import scratch_path

# Most repeated hashes (longs) that are broadcast to the values they are looked up in.
BROADCAST_HASHES = 1_000_000
REPORT_SCHEMA = "relation string, column_name string, test string, failures bigint"


@dataclass(frozen=True)
class Check:
    relation: str
    column: str
    test: str  # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to: str | None = None  # parent relation for relationships
    field: str | None = None  # parent column for relationships


def _nn(rel: str, *cols: str) -> list[Check]:
    return [Check(rel, c, "not_null") for c in cols]


def _u(rel: str, *cols: str) -> list[Check]:
    return [Check(rel, c, "unique") for c in cols]


def _av(rel: str, col: str, values) -> Check:
    return Check(rel, col, "accepted_values", tuple(values))


def _rel(rel: str, col: str, to: str, field: str) -> Check:
    return Check(rel, col, "relationships", to=to, field=field)


BOOLS = (True, False)
STATUSES = tuple(C.ALL_STATUSES)

# The declared suite: 117 tests over Gold, staging and Silver.
SUITE: list[Check] = [
    # dim_customers
    *_u("dim_customers", "customer_sk", "customer_id"),
    *_nn("dim_customers", "customer_sk", "customer_id", "customer_name", "email", "state",
         "registered_at", "last_updated_at", "has_been_updated"),
    _av("dim_customers", "has_been_updated", BOOLS),
    # dim_date
    *_u("dim_date", "date_key", "full_date"),
    *_nn("dim_date", "date_key", "full_date", "year", "month", "quarter", "semester",
         "is_weekend", "is_weekday"),
    _av("dim_date", "month", range(1, 13)),
    _av("dim_date", "quarter", range(1, 5)),
    _av("dim_date", "semester", (1, 2)),
    _av("dim_date", "is_weekend", BOOLS),
    # fct_orders
    *_u("fct_orders", "order_sk", "order_id"),
    *_nn("fct_orders", "order_sk", "order_id", "customer_sk", "created_date_key",
         "current_status", "order_amount", "item_count", "is_delivered", "is_completed"),
    _rel("fct_orders", "customer_sk", "dim_customers", "customer_sk"),
    _rel("fct_orders", "created_date_key", "dim_date", "date_key"),
    _av("fct_orders", "current_status", STATUSES),
    # fct_order_lifecycle
    *_u("fct_order_lifecycle", "lifecycle_sk", "event_id"),
    *_nn("fct_order_lifecycle", "lifecycle_sk", "event_id", "order_id", "order_sk",
         "customer_sk", "changed_date_key", "old_status", "new_status", "order_amount"),
    _rel("fct_order_lifecycle", "order_sk", "fct_orders", "order_sk"),
    _rel("fct_order_lifecycle", "customer_sk", "dim_customers", "customer_sk"),
    _rel("fct_order_lifecycle", "changed_date_key", "dim_date", "date_key"),
    _av("fct_order_lifecycle", "old_status", STATUSES),
    _av("fct_order_lifecycle", "new_status", STATUSES),
    # mart_daily_revenue
    *_nn("mart_daily_revenue", "day_date_key", "customer_state", "orders_count",
         "gross_revenue", "avg_order_value", "completion_rate", "delivery_rate"),
    # mart_order_funnel
    *_u("mart_order_funnel", "funnel_step", "status_name"),
    *_nn("mart_order_funnel", "funnel_step", "status_name", "orders_count", "pct_of_total"),
    _av("mart_order_funnel", "status_name", STATUSES),
    # dim_products (seed)
    *_u("dim_products", "product_id"),
    *_nn("dim_products", "product_id", "product_name", "category", "unit_price", "is_active"),
    _av("dim_products", "category", C.PRODUCT_CATEGORIES),
    _av("dim_products", "is_active", BOOLS),
    # staging
    *_u("stg_orders_created", "event_id"),
    *_nn("stg_orders_created", "event_id", "order_id", "customer_id", "created_at", "amount",
         "item_count"),
    *_u("stg_orders_status_changed", "event_id"),
    *_nn("stg_orders_status_changed", "event_id", "order_id", "changed_at", "old_status",
         "new_status"),
    *_u("stg_customers_registered", "event_id", "customer_id"),
    *_nn("stg_customers_registered", "event_id", "customer_id", "registered_at",
         "customer_name", "email"),
    *_u("stg_customers_updated", "event_id"),
    *_nn("stg_customers_updated", "event_id", "customer_id", "field_changed"),
    _av("stg_customers_updated", "field_changed", C.UPDATABLE_FIELDS),
    # Silver sources
    *_u("dt_orders_created", "event_id"),
    *_nn("dt_orders_created", "event_id", "order_id", "customer_id", "amount"),
    *_u("dt_orders_status_changed", "event_id"),
    *_nn("dt_orders_status_changed", "event_id", "order_id"),
    *_u("dt_customers_registered", "event_id", "customer_id"),
    *_nn("dt_customers_registered", "event_id", "customer_id"),
    *_u("dt_customers_updated", "event_id"),
    *_nn("dt_customers_updated", "event_id", "customer_id"),
]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return _s(v)


# Expressions are passed as SQL text (``selectExpr``): one JVM call per
# expression instead of one per Column node, which keeps building a suite of
# a hundred checks cheap on the driver.


def _stack(wide: DataFrame, rel: str, meta: list[tuple[str, str, str]]) -> DataFrame:
    """One-row wide result -> one report row per (column, test)."""
    items = ", ".join(
        f"struct({_s(col)} AS column_name, {_s(test)} AS test, {alias} AS failures)"
        for col, test, alias in meta
    )
    return wide.selectExpr(f"{_s(rel)} AS relation", f"inline(array({items}))")


def unique(df: DataFrame, rel: str, col: str) -> DataFrame:
    return unique_many(df, rel, [col])


def _hash_of(i: int, col: str, bits: int) -> str:
    """64 bits of which the last ones are the column's number."""
    return f"(shiftleft(shiftright(xxhash64(CAST({_q(col)} AS STRING)), {bits}), {bits}) | {i}L)"


def repeated_hashes(df: DataFrame, rel: str, cols: list[str]) -> DataFrame:
    """(relation, column number, hash) of the hashes that more than one row has.

    A value is one long in the only exchange, counted map-side first, so a hot
    value is one row for each task. Equal values have equal hashes.
    """
    bits = max(1, (len(cols) - 1).bit_length())
    items = ", ".join(f"CASE WHEN {_q(c)} IS NOT NULL THEN {_hash_of(i, c, bits)} END" for i, c in enumerate(cols))
    counts = df.selectExpr(f"explode(array_compact(array({items}))) AS h").groupBy("h").count()
    return counts.where("`count` > 1").selectExpr(f"{_s(rel)} AS relation", f"CAST(h & {(1 << bits) - 1} AS INT) AS k", "h")


def unique_many(df: DataFrame, rel: str, cols: list[str], suspects: DataFrame | None = None, among: list[str] | None = None) -> DataFrame:
    """The ``unique`` checks of ``cols`` through ONE exchange of values.

    Each row is stacked into ``(column, value)`` pairs (values as their
    string form, which is injective within a column's type), the pairs are
    counted per key with map-side partial aggregation, and a global
    conditional count per column gives the failures (NULLs never fail).
    With ``suspects`` (``repeated_hashes`` of all columns ``among``) only pairs whose hash repeats are.
    """
    among = among or cols
    bits = max(1, (len(among) - 1).bit_length())
    number = {c: among.index(c) for c in cols}
    items = ", ".join(
        f"struct({_s(c)} AS k, CAST({_q(c)} AS STRING) AS v" + (f", {_hash_of(i, c, bits)} AS h" if suspects else "") + ")"
        for c, i in number.items()
    )
    pairs = df.selectExpr(f"inline(array({items}))")
    if suspects:
        pairs = pairs.where("v IS NOT NULL").join(suspects, "h", "left_semi")
    counts = pairs.groupBy("k", "v").count()
    wide = counts.selectExpr(*[
        f"CAST(count_if(v IS NOT NULL AND `count` > 1 AND k = {_s(c)}) AS BIGINT) AS u{i}"
        for i, c in enumerate(cols)
    ])
    return _stack(wide, rel, [(c, "unique", f"u{i}") for i, c in enumerate(cols)])


def unique_suite(relations: Callable[[str], DataFrame], columns: dict[str, list[str]]) -> list[DataFrame]:
    """The ``unique`` checks of all relations in two phases.

    First every value is counted by its hash, all relations in one job; the hashes that
    repeat are stored in the shared folder. A column without any has no failure and isn't read
    again. Of the others only the values with such a hash are compared as text.
    """
    spark = relations(next(iter(columns))).sparkSession
    path = scratch_path(spark, "dq-repeated")
    _union_all([repeated_hashes(relations(rel), rel, cols) for rel, cols in columns.items()]).write.parquet(path)
    stored = spark.read.parquet(path)
    suspects: dict[str, dict[int, int]] = defaultdict(dict)
    for r in stored.groupBy("relation", "k").count().collect():  # one row for each failing or colliding column
        suspects[r["relation"]][r["k"]] = r["count"]
    parts, clean = [], []
    for rel, cols in columns.items():
        hit = [c for i, c in enumerate(cols) if i in suspects[rel]]
        clean += [(rel, c, "unique", 0) for c in cols if c not in hit]
        if hit:
            hashes = stored.where(F.col("relation") == rel).select("h")
            if sum(suspects[rel].values()) <= BROADCAST_HASHES:
                hashes = F.broadcast(hashes)
            parts.append(unique_many(relations(rel), rel, hit, hashes, cols))
    if clean:
        parts.append(spark.createDataFrame(clean, REPORT_SCHEMA))
    return parts


def column_checks(df: DataFrame, rel: str, checks: list[Check]) -> DataFrame:
    """All not_null and accepted_values checks of one relation in one pass.

    Rows that violate nothing are filtered out first (a predicate the scan can
    take); the violations left are stacked as ``(check, value)`` pairs and
    counted per pair, so no row of the relation is multiplied by its checks.
    """
    bad, items, counts, meta = [], [], [], []
    for i, ch in enumerate(checks):
        c = _q(ch.column)
        if ch.test == "not_null":
            cond, value, count = f"{c} IS NULL", "CAST(NULL AS STRING)", "`count`"
        else:
            values = ", ".join(_sql_lit(v) for v in ch.values)
            cond, value, count = f"{c} IS NOT NULL AND NOT {c} IN ({values})", f"CAST({c} AS STRING)", "1L"
        bad.append(f"({cond})")
        items.append(f"CASE WHEN {cond} THEN struct({i} AS k, {value} AS v) END")
        counts.append(f"CAST(coalesce(sum(CASE WHEN k = {i} THEN {count} END), 0) AS BIGINT) AS c{i}")
        meta.append((ch.column, ch.test, f"c{i}"))
    violations = df.where(" OR ".join(bad)).selectExpr(f"inline(array_compact(array({', '.join(items)})))")
    return _stack(violations.groupBy("k", "v").count().selectExpr(*counts), rel, meta)


def relationships(child: DataFrame, rel: str, col: str, parent: DataFrame, field: str) -> DataFrame:
    keys = parent.selectExpr(f"{_q(field)} AS __k").where("__k IS NOT NULL").distinct()
    orphans = child.where(f"{_q(col)} IS NOT NULL").join(keys, F.col(col) == F.col("__k"), "left_anti")
    return _stack(orphans.selectExpr("count(1) AS r0"), rel, [(col, "relationships", "r0")])


def run(
    relations: dict[str, DataFrame] | Callable[[str], DataFrame],
    checks: Iterable[Check] = SUITE,
    tests: Iterable[str] | None = None,
) -> DataFrame:
    """Report ``(relation, column_name, test, failures)`` for ``checks`` (Q05)."""
    get = relations.__getitem__ if isinstance(relations, dict) else relations
    wanted = set(tests) if tests else None
    checks = [c for c in checks if wanted is None or c.test in wanted]
    by_rel: dict[str, list[Check]] = defaultdict(list)
    for c in checks:
        by_rel[c.relation].append(c)
    parts: list[DataFrame] = []
    keys = {rel: [c.column for c in cs if c.test == "unique"] for rel, cs in by_rel.items()}
    keys = {rel: cols for rel, cols in keys.items() if cols}
    if keys:
        parts += unique_suite(get, keys)
    for rel, cs in by_rel.items():
        df = get(rel)
        col_cs = [c for c in cs if c.test in ("not_null", "accepted_values")]
        if col_cs:
            parts.append(column_checks(df, rel, col_cs))
        for c in cs:
            if c.test == "relationships":
                parts.append(relationships(df, rel, c.column, get(c.to), c.field))
    if not parts:
        raise ValueError("no checks selected")
    return _union_all(parts)


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Balanced union tree: each step analyzes a plan of depth log(n), not n."""
    while len(parts) > 1:
        parts = [
            parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)
        ]
    return parts[0]


def failing(report: DataFrame) -> DataFrame:
    return report.where(F.col("failures") > 0)
