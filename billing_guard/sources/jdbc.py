"""JDBC source for invoice text rows, with the filtering pushed to the database.

The database evaluates the tenant semi-join and the two label checks, so only
candidate rows cross the network.  Unlike a single-connection read, the scan
is split into ``num_partitions`` ranges of ``partition_column``; each range is
its own query with the same push-down.  Bounds that are not given are asked of the
database first, by one MIN/MAX query over the tenant's invoices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billing_guard.functions.text import COMPETENCE_LABEL, DUE_LABEL

TEXT_COLUMNS = ("invoice_id", "case_id", "invoice_number", "description", "insert_date",
                "insert_user")


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def invoice_text_query(client_id: int, invoice_table: str = "dbo.invoice",
                       case_table: str = "dbo.[case]",
                       labels: tuple[str, ...] = (COMPETENCE_LABEL, DUE_LABEL)) -> str:
    """Derived-table SQL selecting the tenant's invoices that carry every label."""
    wanted = [_of_tenant(client_id, case_table),
              *(f"CHARINDEX({_quote(label)}, src.description) > 0" for label in labels)]
    chosen = ", ".join(f"src.{name}" for name in TEXT_COLUMNS)
    return f"(SELECT {chosen} FROM {invoice_table} src WHERE {' AND '.join(wanted)}) tenant_texts"


def _of_tenant(client_id: int, case_table: str) -> str:
    if not isinstance(client_id, int):
        raise TypeError("client_id must be an int")
    return f"EXISTS (SELECT 1 FROM {case_table} t WHERE t.client_id = {client_id} AND t.case_id = src.case_id)"


def bounds_query(client_id: int, partition_column: str = "invoice_id",
                 invoice_table: str = "dbo.invoice", case_table: str = "dbo.[case]") -> str:
    """Derived-table SQL with the least and greatest ``partition_column`` of the tenant.

    The labels are not checked: an index on the ids answers it without reading a text.
    """
    if partition_column not in TEXT_COLUMNS:
        raise ValueError(f"unknown column {partition_column!r}")
    return (f"(SELECT MIN(src.{partition_column}) AS lower_bound, MAX(src.{partition_column}) AS upper_bound "
            f"FROM {invoice_table} src WHERE {_of_tenant(client_id, case_table)}) tenant_bounds")


def jdbc_options(url: str, user: str, password: str, client_id: int,
                 partition_column: str = "invoice_id", lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 1000,
                 driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver") -> dict[str, str]:
    """Reader options of a parallel read over ``partition_column``; ``num_partitions=1`` asks
    for a single connection."""
    options = {
        "url": url,
        "dbtable": invoice_text_query(client_id),
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if num_partitions != 1:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a parallel read needs lower_bound, upper_bound and num_partitions")
        options.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    return options


def read_invoice_text_jdbc(spark: SparkSession, num_partitions: int | None = None,
                           lower_bound: int | None = None, upper_bound: int | None = None,
                           **kwargs) -> DataFrame:
    """``spark.read.format("jdbc")`` with :func:`jdbc_options` (needs the driver jar).

    Without bounds, one pushed-down query finds them; ``num_partitions`` defaults to the
    session's parallelism, and 1 asks for a single connection.
    """
    parts = num_partitions or spark.sparkContext.defaultParallelism
    if parts != 1 and (lower_bound is None or upper_bound is None):
        single = jdbc_options(**kwargs, num_partitions=1)
        column = kwargs.get("partition_column", "invoice_id")
        found = spark.read.format("jdbc").options(
            **{**single, "dbtable": bounds_query(kwargs["client_id"], column)}).load().first()
        lower_bound, upper_bound, parts = with_bounds(found["lower_bound"], found["upper_bound"], parts)
    options = jdbc_options(**kwargs, num_partitions=parts, lower_bound=lower_bound, upper_bound=upper_bound)
    return spark.read.format("jdbc").options(**options).load()


def with_bounds(least: int | None, greatest: int | None, parts: int) -> tuple[int | None, int | None, int]:
    """Bounds and number of ranges for ids from ``least`` to ``greatest``.

    No more ranges than ids; the upper bound is exclusive for the width of the ranges.  A
    tenant without invoices is read by a single connection (which returns nothing).
    """
    if least is None or greatest is None:
        return None, None, 1
    parts = min(parts, int(greatest) - int(least) + 1)
    return (int(least), int(greatest) + 1, parts) if parts > 1 else (None, None, 1)
