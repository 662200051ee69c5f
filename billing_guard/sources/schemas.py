"""Explicit schemas for every input, and the required-column check (S7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(19, 2)
RATE = DecimalType(9, 6)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Pipeline A: structural invoice import (one row per imported invoice line).
INVOICE = _schema(
    ("invoice_id", StringType()),
    ("case_id", StringType()),
    ("client_id", IntegerType()),
    ("client_name", StringType()),
    ("amount", MONEY),
    ("import_date", DateType()),
    ("status", StringType()),
    ("source_system", StringType()),
    ("batch_id", StringType()),
)

#: Columns an invoice import must carry (client_name is optional).
REQUIRED_INVOICE_COLUMNS = (
    "invoice_id",
    "case_id",
    "client_id",
    "amount",
    "import_date",
    "status",
    "source_system",
    "batch_id",
)

# Pipeline B: invoice text rows.
INVOICE_TEXT = _schema(
    ("invoice_id", LongType()),
    ("case_id", LongType()),
    ("invoice_number", StringType()),
    ("description", StringType()),
    ("insert_date", TimestampNTZType()),
    ("insert_user", StringType()),
)

# Pipeline C: the eight settlement relations.
CASES = _schema(
    ("case_id", LongType()),
    ("ref_number", StringType()),
    ("client_ref_number", StringType()),
    ("case_statute_id", IntegerType()),
    ("debtor_id", LongType()),
    ("client_id", IntegerType()),
)
SETTLEMENT_INVOICE = _schema(
    ("case_id", LongType()),
    ("invoice_id", LongType()),
    ("invoice_number", StringType()),
    ("description", StringType()),
    ("update_date", TimestampNTZType()),
    ("original_capital", MONEY),
    ("actual_capital", MONEY),
)
CASE_ATTRIBUTE = _schema(
    ("case_id", LongType()),
    ("case_attribute_type_id", IntegerType()),
    ("case_attribute_value", StringType()),
)
DEBTOR = _schema(("debtor_id", LongType()), ("persons_id", LongType()))
PERSONS = _schema(("persons_id", LongType()), ("persons_born_number", StringType()))
PTP = _schema(
    ("client_id", IntegerType()),
    ("case_id", LongType()),
    ("promise_date", DateType()),
    ("promise_capital", MONEY),
    ("contact_date", DateType()),
)
COMMISSION_BANDS = _schema(
    ("client_id", IntegerType()),
    ("dpd_on_payment_day_from", IntegerType()),
    ("dpd_on_payment_day_to", IntegerType()),
    ("commission_rate", RATE),
    ("date_from", DateType()),
    ("date_to", DateType()),
)
PAYMENTS = _schema(
    ("case_id", LongType()),
    ("payment_id", LongType()),
    ("payment_date", DateType()),
    ("payed_capital", MONEY),
    ("payment_insert_date", DateType()),
    ("payment_insert_time", StringType()),
    ("pay_insert_filename", StringType()),
    ("payment_insert_user", StringType()),
)

def missing_columns(df: DataFrame, required=REQUIRED_INVOICE_COLUMNS) -> list[str]:
    """Required columns absent from ``df`` (schema-only: no Spark job)."""
    present = set(df.columns)
    return sorted(c for c in required if c not in present)


def validate_input(df: DataFrame, required=REQUIRED_INVOICE_COLUMNS) -> DataFrame:
    """One-row check result: row count, missing columns, verdict (S7, S8).

    The row count is a single distributed aggregation; only its one result row
    ever reaches the driver.
    """
    missing = missing_columns(df, required)
    missing_col: Column = F.lit(",".join(missing)).alias("missing_columns")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        missing_col,
        ((F.col("row_count") > 0) & F.lit(not missing)).alias("is_valid"),
    )


def require_columns(df: DataFrame, required=REQUIRED_INVOICE_COLUMNS) -> None:
    """Raise on missing columns (no Spark job)."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing columns in input: {missing}")


def require_rows(rows: int) -> int:
    """Raise on an empty input."""
    if rows == 0:
        raise ValueError("Input is empty")
    return rows


def require_valid(df: DataFrame, required=REQUIRED_INVOICE_COLUMNS) -> int:
    """Raise on missing columns or an empty input; return the row count.

    Counts with a job of its own; jobs that land their input take the count from there.
    """
    require_columns(df, required)
    return require_rows(df.count())
