"""What the plans read, shuffle and give to one task, from Spark's event log and plan text.

The input has one invoice, one pair and one key with very many rows, and hot NULL keys.
"""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from billing_guard.operators.skew import hot_shares, hot_split_join
from billing_guard.operators import structural as ops
from billing_guard.plans import settlement as settle
from billing_guard.plans import structural as plan
from billing_guard.session import written

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROWS, PARTITIONS = 60_000, 32

#: the invoice rows: a third in one invoice (half of it one key, a quarter one pair of many
#: amounts, the rest many cases), a tenth without an invoice, the others two to an invoice
HOT_ROWS = f"""
    spark.range({ROWS}, numPartitions=16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'HOT' WHEN id % 10 = 1 THEN NULL ELSE concat('I', id div 6) END AS invoice_id",
        "CASE WHEN id % 12 = 3 THEN concat('C', id) WHEN id % 3 = 0 THEN 'C0' ELSE 'C1' END AS case_id",
        "CAST(CASE WHEN id % 12 = 6 THEN id ELSE 5 END AS decimal(19,2)) AS amount",
        "CAST(id AS string) AS batch_id")
"""


def run_logged(tmp_path, body):
    """Runs ``body`` in a session of its own; (records read, shuffled, most read by a task, printed)."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from billing_guard.session import build_session
        from billing_guard.operators import structural as ops
        spark = build_session("scale", "local[4]", {PARTITIONS}, {{
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": {str(tmp_path)!r},
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1024"}})
        source = {str(tmp_path / 'rows')!r}
    """) + textwrap.dedent(body) + "\nspark.stop()\n"
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    read = shuffled = most = 0
    logs = [f for f in tmp_path.iterdir() if f.is_file() and not f.name.startswith(".")]
    for line in logs[-1].read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            metrics = event["Task Metrics"]
            read += metrics["Input Metrics"]["Records Read"]
            shuffled += metrics["Shuffle Write Metrics"]["Shuffle Records Written"]
            most = max(most, metrics["Shuffle Read Metrics"]["Total Records Read"])
    return read, shuffled, most, done.stdout


@pytest.fixture(scope="module")
def skewed_rows(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    run_logged(folder, f"({HOT_ROWS.strip()}).write.parquet(source)")
    return folder / "rows"


def logged_query(tmp_path, skewed_rows, call):
    (tmp_path / "rows").symlink_to(skewed_rows)
    body = f"df = spark.read.parquet(source)\n{call}.write.format('noop').mode('overwrite').save()"
    return run_logged(tmp_path, body)


def test_classification_reads_thrice_and_shuffles_once(tmp_path, skewed_rows):
    read, shuffled, most, _ = logged_query(tmp_path, skewed_rows, "ops.classify_structural(df)")
    assert read <= 3 * ROWS + 1_000
    assert shuffled <= 1.25 * ROWS + 5_000
    assert most <= 0.125 * ROWS  # the hot invoice alone holds a third


def test_summary_reads_thrice_and_shuffles_once(tmp_path, skewed_rows):
    read, shuffled, most, _ = logged_query(tmp_path, skewed_rows, "ops.class_summary(df)")
    assert read <= 3 * ROWS + 1_000
    assert shuffled <= 1.25 * ROWS + 8_000
    assert most <= 0.125 * ROWS


def test_hot_split_join_reads_twice(tmp_path, skewed_rows):
    read, shuffled, most, _ = logged_query(tmp_path, skewed_rows, """(lambda per_key: __import__(
        "billing_guard.operators.skew", fromlist=["x"]).hot_split_join(df, per_key, ["invoice_id"], "left",
        null_safe=True))(spark.range(20_000).selectExpr("concat('I', id) AS invoice_id", "id AS fact").hint("merge"))""")
    assert read <= 2 * ROWS + 21_000  # the other side has 20,000 rows
    assert most <= 0.125 * ROWS


def test_hot_and_plain_classes_agree(spark):
    df = written(eval(HOT_ROWS.strip().replace("60000", "6000")), "hot_rows")  # noqa: S307
    assert len(hot_shares(df, ops.KEYS)[0]) >= 2
    a, b = ops.classify_structural(df), ops.classify_structural(df, strategy="window")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 6_000
    for report in (plan.class_counts, plan.amount_exposure, plan.class_report):
        one, other = (sorted(map(str, report(s).collect()))
                      for s in (ops.class_summary(df), ops.key_classes(df, strategy="window")))
        assert one == other


def scans(df, path):
    """How often a plan reads the table at ``path``."""
    name = path.rstrip("/").rsplit("/", 1)[1]
    tree = df._jdf.queryExecution().executedPlan().toString()
    return sum(name in line for line in tree.splitlines() if "FileScan" in line)


def test_further_joins_do_not_multiply_the_scans(spark):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"),
        (F.col("id") % 40).alias("b"), F.col("id").alias("row"))
    big = written(rows, "scan_count")
    path = big.inputFiles()[0].rsplit("/", 1)[0]
    hot = hot_shares(big, ["a"], ["b"])
    assert hot[0]
    facts = spark.range(4_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = big
    for step in range(4):
        key, shares = (("a", hot[0]), ("b", hot[1]))[step % 2]
        joined = hot_split_join(joined, facts.toDF(key, f"v{step}"), [key], "left", hot=shares)
        assert scans(joined, path) == 1
    assert joined.count() == 4_000 and joined.where("v0 = 2 * a AND v1 = 2 * b AND v2 = v0").count() == 4_000


def test_settlement_report_reads_the_aggregate_a_fixed_number_of_times(spark):
    from billing_guard.sources import testdata as td

    steps = settle.settlement_steps(td.settlement_inputs(spark, "/root/testdata/sf0.001"), td.TENANT_CLIENT_ID)
    path = steps.aggregate.inputFiles()[0].rsplit("/", 1)[0]
    # the report's rows, the day totals, and the paid invoices: cold ones by window, hot ones apart
    assert scans(steps.report, path) <= 4
    assert scans(steps.base_raw, steps.inputs.invoices.inputFiles()[0].rsplit("/", 1)[0]) == 1


def test_shares_follow_the_size_of_a_key(spark):
    df = spark.range(8_000).select(F.when(F.col("id") % 2 == 0, F.lit("h")).when(F.col("id") % 8 == 1, F.lit(None))
                                   .otherwise(F.col("id").cast("string")).alias("k"))
    shares, = hot_shares(df, ["k"])
    by_name = {r["k"]: shares.get(r["h"]) for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert by_name["h"] == 4 * p and by_name[None] == p
    assert all(v is None for k, v in by_name.items() if k not in ("h", None))
    assert hot_shares(df.where("false"), ["k"]) == [{}]


def test_no_task_sorts_more_rows_as_the_input_grows(spark, monkeypatch):
    monkeypatch.setattr(ops, "TASK_ROWS", 1_000)
    df = spark.range(60_000).selectExpr("concat('I', id) AS invoice_id", "'C' AS case_id",
                                        "CAST(1 AS decimal(19,2)) AS amount")
    per_task = ops.classify_structural(df).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 1_250  # the session's eight partitions would hold 7,500 each


def test_summary_holds_nothing_for_each_invoice(spark):
    rows = [("I1", None, 5), ("I1", None, 7), ("I1", None, 7), ("I1", None, 8), ("I1", "C", 5), ("I1", "C", 6),
            ("I2", "C", 5), ("I2", "C", 5), ("I3", "C", 5), ("I3", "D", 5), (None, "C", 5), (None, "C", 5)]
    few = spark.createDataFrame(rows, "invoice_id string, case_id string, amount int")
    cold = spark.range(5_000).selectExpr("concat('J', id) AS invoice_id", "'C' AS case_id", "1 AS amount")
    summary = ops.class_summary(few.unionByName(cold).selectExpr("invoice_id", "case_id",
                                                                 "CAST(amount AS decimal(19,2)) AS amount"))
    got = {r["anomaly_type"]: (r["rows"], r["rows_with_invoice"], r["invoices"]) for r in summary.collect()}
    assert got == {"CLEAN": (5_002, 5_002, 5_001), "EXACT_DUPLICATE": (6, 4, 2),
                   "AMOUNT_MISMATCH": (2, 2, 1), "CASE_MISMATCH": (2, 2, 1)}
    plan_text = summary._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan_text.splitlines() if "HashAggregate(" in line]
    assert aggregates and not any("keys=[invoice_id" in line for line in aggregates)
