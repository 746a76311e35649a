from medallion.operators import quality
from medallion.operators.quality import Check


def test_each_check_type_reports_exactly_the_failing_row(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "y"), (3, None, "z"), (None, "c", "x")], "k int, name string, kind string"
    )
    checks = [
        Check("child", "k", "unique"),
        Check("child", "name", "not_null"),
        Check("child", "kind", "accepted_values", ("x", "y")),
        Check("child", "k", "relationships", to="parent", field="k"),
    ]
    rep = quality.run({"child": child, "parent": parent}, checks)
    got = {(r.column_name, r.test): r.failures for r in rep.collect()}
    assert got == {
        ("k", "unique"): 1,
        ("name", "not_null"): 1,
        ("kind", "accepted_values"): 1,
        ("k", "relationships"): 1,
    }


def test_suite_declares_117_tests():
    from collections import Counter

    c = Counter(x.test for x in quality.SUITE)
    assert len(quality.SUITE) == 117
    assert c == {"not_null": 79, "unique": 21, "accepted_values": 12, "relationships": 5}


def test_column_checks_multiply_no_rows_and_report_no_failure_as_zero(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, None, "z")], "k int, name string, kind string")
    checks = [Check("r", "k", "accepted_values", (1,)), Check("r", "name", "accepted_values", ("a", "b")),
              Check("r", "k", "not_null"), Check("r", "kind", "not_null")]
    rep = quality.column_checks(df, "r", checks)
    assert [r.failures for r in rep.collect()] == [1, 0, 0, 2]
    assert "Expand" not in rep._jdf.queryExecution().executedPlan().toString()
    none = quality.column_checks(df.where("false"), "r", checks)
    assert [r.failures for r in none.collect()] == [0, 0, 0, 0]


def test_unique_in_two_phases(spark, monkeypatch):
    rows = [(i, f"v{i % 40}", None if i % 3 else "x", 1.5 * (i % 7)) for i in range(50)] + [(None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "k int, name string, kind string, d double")
    checks = [Check("r", c, "unique") for c in ("k", "name", "kind", "d")]
    for limit in (10**6, 0):
        monkeypatch.setattr(quality, "BROADCAST_HASHES", limit)
        got = {r.column_name: r.failures for r in quality.run({"r": df}, checks).collect()}
        assert got == {"k": 0, "name": 10, "kind": 1, "d": 7}
    assert {r.column_name: r.failures for r in quality.run({"r": df.where("false")}, checks).collect()} == dict.fromkeys(got, 0)


def test_colliding_hashes_are_no_failure(spark, monkeypatch):
    monkeypatch.setattr(quality, "_hash_of", lambda i, col, bits: f"CAST({i} AS BIGINT)")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, name string")
    got = {r.column_name: r.failures for r in quality.run({"r": df}, [Check("r", "k", "unique"), Check("r", "name", "unique")]).collect()}
    assert got == {"k": 0, "name": 1}


def _shuffled_bytes(df):
    """Data size of all shuffles of a query that has run."""

    def size(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return size(node.executedPlan())
        if name.endswith("QueryStage"):
            return size(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        kids = node.children()
        return own + sum(size(kids.apply(i)) for i in range(kids.size()))

    df.collect()
    return size(df._jdf.queryExecution().executedPlan())


def test_hashes_move_less_than_half_the_bytes_of_values(spark):
    ids = spark.range(20_000).selectExpr("md5(cast(id as string)) AS order_sk", "concat('order-', uuid()) AS order_id")
    hashes = _shuffled_bytes(quality.repeated_hashes(ids, "r", ids.columns))
    values = _shuffled_bytes(quality.unique_many(ids, "r", ids.columns))
    assert 0 < hashes < values / 2
