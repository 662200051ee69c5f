"""Stand-ins that map the driver's TPC-H-like tables onto the billing inputs.

Every stand-in is a lazy projection (plus one join for the text invoices) over
the given parquet tables, so its size grows with the scale factor and Catalyst
prunes each scan to the columns used downstream.  The DuckDB restatement of each
mapping lives in :mod:`billing_guard.oracle`; the two must stay in step.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billing_guard.session import written
from billing_guard.sources.schemas import COMMISSION_BANDS, MONEY

# --- fixed values of the stand-ins -----------------------------------------
#: The tenant whose cases are settled: customers of this market segment.
TENANT_CLIENT_ID = 516
TENANT_SEGMENT = "BUILDING"
OTHER_CLIENT_ID = 1
#: Case attribute holding the live days-past-due, and a second, unrelated type.
LIVE_DPD_ATTRIBUTE = 560
OTHER_ATTRIBUTE = 561
#: Commission bands of the tenant: (from, to, rate), valid during 2024, plus
#: one expired row that the validity filter must drop.
BAND_RATES = [
    (1, 30, "0.06"),
    (31, 60, "0.11"),
    (61, 90, "0.13"),
    (91, 120, "0.15"),
    (121, 180, "0.18"),
    (181, 240, "0.20"),
    (241, 270, "0.21"),
    (271, 300, "0.22"),
    (301, 330, "0.24"),
    (331, 360, "0.28"),
    (361, 540, "0.30"),
    (541, 720, "0.35"),
    (721, 1440, "0.40"),
    (1441, 1800, "0.40"),
    (1801, 99999, "0.40"),
]
BAND_VALID_FROM = date(2024, 1, 1)
BAND_VALID_TO = date(2024, 12, 31)
EXPIRED_BAND = (0, 99999, "0.99", date(2023, 1, 1), date(2023, 12, 31))
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _text(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value.cast("string"))


# --------------------------------------------------------------------------
# Pipeline A input: structural invoice imports, one row per lineitem.
# --------------------------------------------------------------------------
def structural_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("invoice_id"),
        _text("CASE-", F.col("l_suppkey") % 3).alias("case_id"),
        F.lit(TENANT_CLIENT_ID).cast("int").alias("client_id"),
        _money(F.ceil(F.col("l_quantity") / 10) * 100).alias("amount"),
        F.col("l_shipdate").cast("date").alias("import_date"),
        F.when(F.col("l_linestatus") == "O", "IMPORTED").otherwise("PROCESSED").alias("status"),
        F.when(F.col("l_returnflag") == "R", "PARTNER").otherwise("ANT").alias("source_system"),
        F.concat(F.lit("BATCH-"), F.lpad((F.col("l_suppkey") % 1000).cast("string"), 4, "0"))
        .alias("batch_id"),
    )


# --------------------------------------------------------------------------
# Pipeline B input: invoice text rows, lineitem joined to its order.
# --------------------------------------------------------------------------
def _description() -> Column:
    """The multi-line description text of one lineitem (FIXTURES §2.2)."""
    venc = F.date_add(F.lit(date(2021, 1, 1)),
                      ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 1100).cast("int"))
    comp = F.when(F.col("l_suppkey") % 4 == 0, F.date_add(venc, 40)).otherwise(venc)
    title_no = F.col("l_partkey") % 50
    title = (
        F.when(F.col("l_linenumber") % 3 == 0, _text("NN: ", title_no))
        .when(F.col("l_linenumber") % 3 == 1, _text("Titulo: ", title_no))
    )
    due = (F.when(F.col("l_suppkey") % 5 == 0, F.date_format(venc, "MM.dd.yyyy"))
           .otherwise(F.date_format(venc, "dd.MM.yyyy")))
    dpd = F.when(F.col("l_partkey") % 11 != 0,
                 _text("DPD: ", (F.col("l_quantity") - 10).cast("int")))
    # concat_ws skips the NULL (missing) lines.
    return F.concat_ws(
        "\n",
        _text("Contrato ", F.col("l_orderkey")),
        title,
        _text("Competencia: ", F.date_format(comp, "dd.MM.yyyy")),
        _text("Vencimento: ", due),
        dpd,
    )


def _lineitem_orders(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (),
                     even: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
        *extra,
    )
    if even:
        # the given file has few row groups: even parts, sized by the data, for what follows
        li = li.hint("rebalance")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")


def _invoice_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _text_invoice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column the text-invoice stand-ins need, one row per lineitem."""
    rows = _lineitem_orders(spark, sf_dir, ("l_extendedprice", "l_discount", "l_returnflag"), even=True)
    price = _money(F.col("l_extendedprice"))
    net = F.round(price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2)
    actual = (F.when(F.col("l_returnflag") == "R", F.lit(0))
              .when(F.col("l_returnflag") == "A", net)
              .otherwise(price))
    return rows.select(
        _invoice_id().alias("invoice_id"),
        F.col("o_custkey").alias("case_id"),
        _text("N", _invoice_id()).alias("invoice_number"),
        _description().alias("description"),
        F.col("l_shipdate").alias("insert_date"),
        _text("user", F.col("l_suppkey") % 10).alias("insert_user"),
        F.date_add(F.lit(date(2023, 12, 1)), (F.col("l_partkey") % 62).cast("int"))
        .cast("timestamp_ntz").alias("update_date"),
        price.alias("original_capital"),
        _money(actual).alias("actual_capital"),
    )


def text_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text invoices, landed as a Parquet table.

    In the systems this engine serves, ``description`` is a stored column.
    Built on the fly, it would be a ten-expression string that Catalyst
    inlines into every filter on a parsed field; landing it under the shared work folder
    gives the pipelines the stored column they are meant to read.  Derived by Spark from lineitem ⋈ orders, so it grows
    with them.  Every call lands it anew.
    """
    return written(_text_invoice_rows(spark, sf_dir), "text_invoices")


def description_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``descv``: one text invoice per lineitem; the case is the order's customer."""
    return text_invoices(spark, sf_dir).select(
        "invoice_id", "case_id", "invoice_number", "description", "insert_date", "insert_user")


# --------------------------------------------------------------------------
# Pipeline C inputs.
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class SettlementInputs:
    cases: DataFrame
    invoices: DataFrame
    case_attributes: DataFrame
    debtors: DataFrame
    persons: DataFrame
    ptp: DataFrame
    bands: DataFrame
    payments: DataFrame


def settlement_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("case_id"),
        F.col("c_name").alias("ref_number"),
        _text("C", F.col("c_custkey")).alias("client_ref_number"),
        F.col("c_nationkey").cast("int").alias("case_statute_id"),
        F.col("c_custkey").alias("debtor_id"),
        F.when(F.col("c_mktsegment") == TENANT_SEGMENT, F.lit(TENANT_CLIENT_ID))
        .otherwise(F.lit(OTHER_CLIENT_ID)).cast("int").alias("client_id"),
    )


def settlement_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_invoices(spark, sf_dir).select(
        "case_id", "invoice_id", "invoice_number", "description", "update_date",
        "original_capital", "actual_capital")


def settlement_case_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    live = (F.when(F.col("c_custkey") % 9 == 0, F.lit("n/a"))
            .otherwise((F.col("c_acctbal") / 100).cast("int").cast("string")))
    dpd_rows = c.select(
        F.col("c_custkey").alias("case_id"),
        F.lit(LIVE_DPD_ATTRIBUTE).cast("int").alias("case_attribute_type_id"),
        live.alias("case_attribute_value"),
    )
    other_rows = c.select(
        F.col("c_custkey").alias("case_id"),
        F.lit(OTHER_ATTRIBUTE).cast("int").alias("case_attribute_type_id"),
        F.col("c_nationkey").cast("string").alias("case_attribute_value"),
    )
    return dpd_rows.unionByName(other_rows)


def settlement_debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("debtor_id"), F.col("c_custkey").alias("persons_id")
    )


def settlement_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd keys: an 11-digit personal number; even keys: a punctuated company number."""
    key = F.col("c_custkey").cast("string")
    d14 = F.lpad(key, 14, "0")
    company = F.concat(
        F.substring(d14, 1, 2), F.lit("."), F.substring(d14, 3, 3), F.lit("."),
        F.substring(d14, 6, 3), F.lit("/"), F.substring(d14, 9, 4), F.lit("-"),
        F.substring(d14, 13, 2),
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("persons_id"),
        F.when(F.col("c_custkey") % 2 == 1, F.lpad(key, 11, "0"))
        .otherwise(company).alias("persons_born_number"),
    )


def settlement_ptp(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lit(TENANT_CLIENT_ID).cast("int").alias("client_id"),
        F.col("o_custkey").alias("case_id"),
        F.col("o_orderdate").cast("date").alias("promise_date"),
        _money(F.col("o_totalprice")).alias("promise_capital"),
        F.col("o_orderdate").cast("date").alias("contact_date"),
    )


def commission_bands(spark: SparkSession) -> DataFrame:
    """The tenant's commission table (a configuration table of a few rows)."""
    from decimal import Decimal

    rows = [
        (TENANT_CLIENT_ID, lo, hi, Decimal(rate), BAND_VALID_FROM, BAND_VALID_TO)
        for lo, hi, rate in BAND_RATES
    ]
    lo, hi, rate, d_from, d_to = EXPIRED_BAND
    rows.append((TENANT_CLIENT_ID, lo, hi, Decimal(rate), d_from, d_to))
    return spark.createDataFrame(rows, COMMISSION_BANDS)


def settlement_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment per ``purchase`` event; events of other types are no payments (FIXTURES)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ev.select(
        F.col("user_id").alias("case_id"),
        F.col("event_id").alias("payment_id"),
        F.col("ts").cast("date").alias("payment_date"),
        _money(F.col("value")).alias("payed_capital"),
        F.col("ts").cast("date").alias("payment_insert_date"),
        F.date_format(F.col("ts"), "HH:mm:ss").alias("payment_insert_time"),
        F.concat(F.lit("pay_"), F.date_format(F.col("ts"), "yyyyMMdd"), F.lit(".csv"))
        .alias("pay_insert_filename"),
        F.lit("import").alias("payment_insert_user"),
    )


def settlement_inputs(spark: SparkSession, sf_dir: str) -> SettlementInputs:
    return SettlementInputs(
        cases=settlement_cases(spark, sf_dir),
        invoices=settlement_invoices(spark, sf_dir),
        case_attributes=settlement_case_attributes(spark, sf_dir),
        debtors=settlement_debtors(spark, sf_dir),
        persons=settlement_persons(spark, sf_dir),
        ptp=settlement_ptp(spark, sf_dir),
        bands=commission_bands(spark),
        payments=settlement_payments(spark, sf_dir),
    )
