"""Declared schemas of the seven raw bank tables and the fixed values the
models depend on.  Nothing is ever guessed from values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# lineage literal written by every bronze model
RECORD_SOURCE = "kaggle_csv"
# text hashed in place of a NULL key part, and the key-part separator
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
# open end of the newest SCD2 version
OPEN_END = "9999-12-31 00:00:00"
# calendar spine bounds (end date excluded)
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2030-01-01"
# credit tiers, highest cut point first; below the last one (or NULL) -> very_poor
CREDIT_TIERS = [(750, "excellent"), (700, "good"), (650, "fair"), (600, "poor")]
CREDIT_TIER_ELSE = "very_poor"
# account types counted separately on dim_customer
CHECKING = "Checking"
SAVINGS = "Savings"
# stored width of business ids in hubs
ID_WIDTH = 20
TRANSACTION_ID_WIDTH = 50
# ---------------------------------------------------------------------------


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()
# measures in text files: exact, wider than any stored type; the satellites cast and round
NUM = T.DecimalType(38, 10)

#: Columns of every source, and the types that csv and json files are read with.  Business ids are
#: text ('007' is not '7').  Typed files (parquet, orc) and databases keep the types they declare.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(
        ("customer_id", S), ("first_name", S), ("last_name", S), ("email", S),
        ("city", S), ("credit_score", NUM), ("created_at", D)),
    "accounts": _schema(
        ("account_id", S), ("customer_id", S), ("account_type", S),
        ("balance_usd", NUM), ("open_date", D)),
    "cards": _schema(
        ("card_id", S), ("account_id", S), ("card_type", S), ("expiration_date", D)),
    "branches": _schema(
        ("branch_id", S), ("branch_name", S), ("city", S), ("country", S),
        ("manager_name", S)),
    "loans": _schema(
        ("loan_id", S), ("customer_id", S), ("loan_amount", NUM),
        ("interest_rate", NUM), ("start_date", D)),
    "merchants": _schema(
        ("merchant_id", S), ("merchant_name", S), ("city", S)),
    "transactions": _schema(
        ("transaction_id", S), ("account_id", S), ("merchant_id", S),
        ("amount_usd", NUM), ("transaction_date", TS)),
}

SOURCE_NAMES = list(SOURCE_SCHEMAS)
