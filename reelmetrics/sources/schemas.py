"""The six tables: columns, types and declared rules.

Money, minutes and percentages are decimals, so their sums are exact and do not depend
on the order in which partitions are added. Keys of people and events are bigint.
"""

from __future__ import annotations

from typing import NamedTuple

from reelmetrics.operators.quality import TextLimit


class Col(NamedTuple):
    name: str
    type: str
    required: bool = False
    max_length: int | None = None
    #: What the length is counted in: bytes for VARCHAR(n), 16-bit units for NVARCHAR(n).
    unit: str = "bytes"


# The declared columns of each table, in file order.
TABLES: dict[str, tuple[Col, ...]] = {
    "movies": (
        Col("show_id", "string", True, 10),
        Col("type", "string", True, 10),
        Col("title", "string", True, 200, unit="utf16"),
        Col("director", "string", max_length=300, unit="utf16"),
        Col("cast_members", "string", max_length=1000, unit="utf16"),
        Col("primary_country", "string", max_length=50, unit="utf16"),
        Col("all_countries", "string", max_length=300, unit="utf16"),
        Col("date_added", "date"),
        Col("release_year", "int", True),
        Col("rating", "string", max_length=10),
        Col("duration_value", "int"),
        Col("duration_unit", "string", max_length=10),
        Col("primary_genre", "string", max_length=50, unit="utf16"),
        Col("all_genres", "string", max_length=200, unit="utf16"),
        Col("description", "string", max_length=500, unit="utf16"),
    ),
    "users": (
        Col("user_id", "bigint", True),
        Col("name", "string", True, 100, unit="utf16"),
        Col("email", "string", True, 150),
        Col("gender", "string", max_length=10),
        Col("age", "int"),
        Col("city", "string", max_length=50, unit="utf16"),
        Col("country", "string", max_length=50, unit="utf16"),
        Col("signup_date", "date", True),
    ),
    "plans": (
        Col("plan_id", "int", True),
        Col("plan_name", "string", True, 20),
        Col("monthly_price", "decimal(8,2)", True),
        Col("max_streams", "int"),
        Col("video_quality", "string", max_length=20),
    ),
    "subscriptions": (
        Col("subscription_id", "bigint", True),
        Col("user_id", "bigint", True),
        Col("plan_id", "int", True),
        Col("start_date", "date", True),
        Col("end_date", "date"),
        Col("status", "string", True, 20),
        Col("monthly_revenue", "decimal(8,2)", True),
    ),
    "watch": (
        Col("watch_id", "bigint", True),
        Col("user_id", "bigint", True),
        Col("show_id", "string", True, 10),
        Col("device", "string", True, 20),
        Col("watch_date", "date", True),
        Col("watch_duration_minutes", "decimal(8,1)", True),
        Col("completion_pct", "decimal(5,1)", True),
    ),
    "ratings": (
        Col("rating_id", "bigint", True),
        Col("user_id", "bigint", True),
        Col("show_id", "string", True, 10),
        Col("rating", "int", True),
        Col("rating_date", "date", True),
    ),
}

# File names, header names that differ, and files with line breaks in texts.
FILES = {
    "movies": "movies.csv",
    "users": "users.csv",
    "plans": "subscription_plans.csv",
    "subscriptions": "subscriptions.csv",
    "watch": "watch_history.csv",
    "ratings": "ratings.csv",
}
HEADER_NAMES = {"movies": {"cast_members": "cast"}}
MULTI_LINE = frozenset({"movies"})

# Declared rules.
PRIMARY_KEYS = {
    "movies": "show_id",
    "users": "user_id",
    "plans": "plan_id",
    "subscriptions": "subscription_id",
    "watch": "watch_id",
    "ratings": "rating_id",
}
FOREIGN_KEYS = (
    ("subscriptions", "user_id", "users"),
    ("subscriptions", "plan_id", "plans"),
    ("watch", "user_id", "users"),
    ("watch", "show_id", "movies"),
    ("ratings", "user_id", "users"),
    ("ratings", "show_id", "movies"),
)
CHECKS = {"ratings": "rating BETWEEN 1 AND 5"}
EXPECTED_ROWS = {
    "movies": 8807,
    "users": 6000,
    "plans": 3,
    "subscriptions": 8065,
    "watch": 120000,
    "ratings": 34970,
}

# Parents before children, so that tables can be created in this order and dropped in reverse.
LOAD_ORDER = ("movies", "plans", "users", "subscriptions", "watch", "ratings")

REQUIRED = {t: [c.name for c in cols if c.required] for t, cols in TABLES.items()}
MAX_LENGTHS = {t: {c.name: TextLimit(c.max_length, c.unit) for c in cols if c.max_length} for t, cols in TABLES.items()}
DECIMALS = {t: {c.name: c.type for c in cols if c.type.startswith("decimal")} for t, cols in TABLES.items()}


def read_schema(table: str) -> str:
    """Schema text for a reader, with the names that the file header has."""
    renamed = HEADER_NAMES.get(table, {})
    return ", ".join(f"`{renamed.get(c.name, c.name)}` {c.type}" for c in TABLES[table])


def table_columns(table: str) -> str:
    """Column list for ``CREATE TABLE``. Spark checks the VARCHAR lengths on insert."""

    def sql_type(c: Col) -> str:
        return f"varchar({c.max_length})" if c.max_length else c.type

    return ", ".join(f"`{c.name}` {sql_type(c)}" for c in TABLES[table])
