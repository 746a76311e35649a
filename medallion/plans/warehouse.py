"""Model graph: Silver -> staging -> dimensions -> facts -> marts.

``Warehouse`` resolves each model once (a cached ``DataFrame``), mirroring
``ref()`` resolution. Building a model only builds a lazy plan; nothing runs
until a sink or action. Models reused downstream (``fct_orders`` feeds both
marts) should be materialized once by the caller (``jobs.build`` writes it and
points the graph at the stored table with ``Warehouse.use``) rather than
recomputed.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from medallion import contracts as C
from medallion.operators import silver as silver_ops
from medallion.operators.staging import stage
from medallion.plans import dimensions, facts, marts, questions

GOLD_MODELS = [
    "dim_customers",
    "dim_date",
    "fct_orders",
    "fct_order_lifecycle",
    "mart_daily_revenue",
    "mart_order_funnel",
]
STAGING_MODELS = [
    "stg_orders_created",
    "stg_orders_status_changed",
    "stg_customers_registered",
    "stg_customers_updated",
]


class StoredSilver(dict):
    """Silver tables, each written under ``root`` when first asked for and read
    back as Parquet, so a model reads only the tables and columns it needs."""

    def __init__(self, bronze: DataFrame, root: str):
        super().__init__()
        self.bronze, self.root = bronze, root.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        path = f"{self.root}/{C.SILVER_SPECS[name].table}"
        silver_ops.build(self.bronze, name).write.mode("overwrite").parquet(path)
        self[name] = self.bronze.sparkSession.read.parquet(path)
        return self[name]


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        silver: dict[str, DataFrame],
        calendar_start: str = C.CALENDAR_START,
        calendar_end: str = C.CALENDAR_END,
    ):
        self.spark = spark
        self.silver = silver
        self.calendar_start = calendar_start
        self.calendar_end = calendar_end

    @classmethod
    def from_bronze(
        cls, spark: SparkSession, bronze: DataFrame, store: str | None = None, **kw
    ) -> "Warehouse":
        """Silver built from ``bronze``; with a shared folder ``store`` each Silver
        table that a model asks for is written there once and read back."""
        silver = StoredSilver(bronze, store) if store else silver_ops.build_all(bronze)
        return cls(spark, silver, **kw)

    @classmethod
    def from_tables(cls, spark: SparkSession, silver_root: str, **kw) -> "Warehouse":
        """Silver read from stored tables (S10), e.g. kept up by the stream; each
        table in the version that is the newest now."""
        silver = {n: silver_ops.read_table(spark, silver_root, n) for n in C.SILVER_SPECS}
        return cls(spark, silver, **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, **kw) -> "Warehouse":
        """Silver read from catalog tables (keeps their bucketing)."""
        silver = {
            n: spark.table(f"{database}.{spec.table}").select(*spec.columns)
            for n, spec in C.SILVER_SPECS.items()
        }
        return cls(spark, silver, **kw)

    def register_views(self, gold: bool = False) -> list[str]:
        """Staging models (and with ``gold`` the Gold models and the product
        seed) as temp views (S12), queryable with ``spark.sql``."""
        names = list(STAGING_MODELS) + (GOLD_MODELS + ["dim_products"] if gold else [])
        for name in names:
            self.model(name).createOrReplaceTempView(name)
        return names

    # staging (views)
    @cached_property
    def stg_orders_created(self) -> DataFrame:
        return stage(self.silver["orders_created"], "orders_created")

    @cached_property
    def stg_orders_status_changed(self) -> DataFrame:
        return stage(self.silver["orders_status_changed"], "orders_status_changed")

    @cached_property
    def stg_customers_registered(self) -> DataFrame:
        return stage(self.silver["customers_registered"], "customers_registered")

    @cached_property
    def stg_customers_updated(self) -> DataFrame:
        return stage(self.silver["customers_updated"], "customers_updated")

    # dimensions
    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.stg_customers_registered, self.stg_customers_updated)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.calendar_start, self.calendar_end)

    @property
    def calendar_days(self) -> int:
        import datetime as dt

        s = dt.date.fromisoformat(self.calendar_start)
        e = dt.date.fromisoformat(self.calendar_end)
        return max((e - s).days + 1, 0)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.spark)

    # facts
    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(self.stg_orders_created, self.stg_orders_status_changed)

    @cached_property
    def fct_order_lifecycle(self) -> DataFrame:
        return facts.fct_order_lifecycle(self.stg_orders_status_changed, self.stg_orders_created)

    # marts
    @cached_property
    def mart_daily_revenue(self) -> DataFrame:
        return marts.mart_daily_revenue(
            self.fct_orders, self.dim_customers, self.dim_date, self.calendar_days
        )

    @cached_property
    def mart_order_funnel(self) -> DataFrame:
        return marts.mart_order_funnel(self.fct_orders)

    # questions
    def avg_days_to_delivery(self) -> DataFrame:
        return questions.avg_days_to_delivery(self.fct_orders)

    def aov_by_state(self) -> DataFrame:
        return questions.aov_by_state(self.fct_orders, self.dim_customers)

    def transition_gaps(self) -> DataFrame:
        return questions.transition_gaps(self.fct_order_lifecycle)

    def status_transitions(self) -> DataFrame:
        return questions.status_transitions(self.fct_order_lifecycle)

    def changes_over_time(self) -> DataFrame:
        return questions.changes_over_time(self.fct_order_lifecycle)

    def revenue_seasonality(self) -> DataFrame:
        return questions.revenue_seasonality(self.mart_daily_revenue)

    def revenue_by_month(self) -> DataFrame:
        return questions.revenue_by_month(self.mart_daily_revenue)

    def revenue_by_status(self) -> DataFrame:
        return questions.revenue_by_status(self.mart_order_funnel)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def use(self, name: str, df: DataFrame) -> None:
        """Make ``name`` resolve to ``df`` (e.g. the table a build just wrote),
        so models downstream read stored data instead of recomputing it."""
        if not hasattr(type(self), name):
            raise KeyError(name)
        self.__dict__[name] = df

    def models(self, names=None) -> dict[str, DataFrame]:
        return {n: self.model(n) for n in (names or STAGING_MODELS + GOLD_MODELS)}
