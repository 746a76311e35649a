"""Event contracts, domain values and Silver extraction specs.

Everything here is data, not logic: the Bronze/Silver/Gold code reads these
tables so that one function serves all four event types.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values (must equal the source system's contract) -----------------
# Event types and envelope version.
ORDER_CREATED = "order_created"
ORDER_STATUS_CHANGED = "order_status_changed"
CUSTOMER_REGISTERED = "customer_registered"
CUSTOMER_UPDATED = "customer_updated"
EVENT_VERSION = "1.0"

# Order status flow (happy path), plus the terminal status handled by Gold.
STATUS_FLOW = ["created", "paid", "shipped", "delivered"]
TERMINAL_STATUSES = ["delivered", "canceled"]
ALL_STATUSES = ["created", "paid", "shipped", "delivered", "canceled"]
# Funnel step per status; any other status gets UNKNOWN_FUNNEL_STEP.
FUNNEL_STEPS = {"created": 1, "paid": 2, "shipped": 3, "delivered": 4, "canceled": 5}
UNKNOWN_FUNNEL_STEP = 99

# Customer fields that a customer_updated event may change.
UPDATABLE_FIELDS = ["email", "state"]

# Product seed categories.
PRODUCT_CATEGORIES = ["ELETRONICOS", "INFORMATICA", "MODA", "CASA"]

# Default calendar range of dim_date.
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2027-12-31"

# Bronze load: a file is skipped when more than this share of its lines is bad.
MAX_BAD_RATIO = "0.10"

# Envelope timestamp format (ISO-8601 UTC, seconds).
EVENT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# --- end of fixed values -----------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One typed column extracted from the envelope."""

    name: str
    path: str
    type: str


@dataclass(frozen=True)
class SilverSpec:
    """How one Silver table is cut out of Bronze."""

    table: str
    event_type: str
    payload: tuple[Field, ...]

    @property
    def fields(self) -> tuple[Field, ...]:
        return ENVELOPE_FIELDS + self.payload

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields] + ["_source_file", "_ingested_at"]


ENVELOPE_FIELDS = (
    Field("event_id", "$.event_id", "string"),
    Field("event_timestamp", "$.event_timestamp", "timestamp_ntz"),
    Field("event_version", "$.event_version", "string"),
)

SILVER_SPECS: dict[str, SilverSpec] = {
    "orders_created": SilverSpec(
        "dt_orders_created",
        ORDER_CREATED,
        (
            Field("order_id", "$.payload.order_id", "string"),
            Field("customer_id", "$.payload.customer_id", "string"),
            Field("amount", "$.payload.amount", "decimal(10,2)"),
            Field("currency", "$.payload.currency", "string"),
            Field("item_count", "$.payload.item_count", "int"),
        ),
    ),
    "orders_status_changed": SilverSpec(
        "dt_orders_status_changed",
        ORDER_STATUS_CHANGED,
        (
            Field("order_id", "$.payload.order_id", "string"),
            Field("old_status", "$.payload.old_status", "string"),
            Field("new_status", "$.payload.new_status", "string"),
        ),
    ),
    "customers_registered": SilverSpec(
        "dt_customers_registered",
        CUSTOMER_REGISTERED,
        (
            Field("customer_id", "$.payload.customer_id", "string"),
            Field("customer_name", "$.payload.name", "string"),
            Field("email", "$.payload.email", "string"),
            Field("state", "$.payload.state", "string"),
        ),
    ),
    "customers_updated": SilverSpec(
        "dt_customers_updated",
        CUSTOMER_UPDATED,
        (
            Field("customer_id", "$.payload.customer_id", "string"),
            Field("field_changed", "$.payload.field_changed", "string"),
            Field("old_value", "$.payload.old_value", "string"),
            Field("new_value", "$.payload.new_value", "string"),
        ),
    ),
}

# Co-location key per Silver table: the key its Gold consumers group and join
# on (orders by order_id for fct_orders / fct_order_lifecycle, customers by
# customer_id for dim_customers).
BUCKET_KEYS = {
    "orders_created": "order_id",
    "orders_status_changed": "order_id",
    "customers_registered": "customer_id",
    "customers_updated": "customer_id",
}

# Staging views: Silver column -> staging column (order = output order).
STAGING_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "orders_created": [
        ("event_id", "event_id"),
        ("order_id", "order_id"),
        ("customer_id", "customer_id"),
        ("event_timestamp", "created_at"),
        ("amount", "amount"),
        ("currency", "currency"),
        ("item_count", "item_count"),
        ("_ingested_at", "ingested_at"),
    ],
    "orders_status_changed": [
        ("event_id", "event_id"),
        ("order_id", "order_id"),
        ("event_timestamp", "changed_at"),
        ("old_status", "old_status"),
        ("new_status", "new_status"),
        ("_ingested_at", "ingested_at"),
    ],
    "customers_registered": [
        ("event_id", "event_id"),
        ("customer_id", "customer_id"),
        ("event_timestamp", "registered_at"),
        ("customer_name", "customer_name"),
        ("email", "email"),
        ("state", "state"),
        ("_ingested_at", "ingested_at"),
    ],
    "customers_updated": [
        ("event_id", "event_id"),
        ("customer_id", "customer_id"),
        ("event_timestamp", "updated_at"),
        ("field_changed", "field_changed"),
        ("old_value", "old_value"),
        ("new_value", "new_value"),
        ("_ingested_at", "ingested_at"),
    ],
}

BRONZE_COLUMNS = ["raw_data", "_source_file", "_ingested_at"]

PRODUCT_SCHEMA = (
    "product_id string, product_name string, category string, "
    "unit_price decimal(10,2), is_active boolean"
)
