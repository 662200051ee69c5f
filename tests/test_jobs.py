"""Results replaced by commit, broken records, observed counts, whole reports, data checks."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from billing_guard.cli import SETTLEMENT_TABLES, main
from billing_guard.operators.sinks import read_partitioned, recover, replace_whole, write_partitioned
from billing_guard.plans import descriptions as desc
from billing_guard.plans import settlement as settle
from billing_guard.session import work_path, written_observed
from billing_guard.sources import jdbc
from billing_guard.sources import testdata as td
from billing_guard.sources.files import MALFORMED, RECORD, read_invoices_csv

SF = "/root/testdata/sf0.001"


# --- replace by commit ---------------------------------------------------------------------
def test_a_failed_write_leaves_the_old_result(spark):
    path = work_path(spark, "commit")
    old = spark.createDataFrame([(1, "A"), (2, "B")], "id int, cls string")
    write_partitioned(old, path, "cls")
    failing = spark.range(2_000, numPartitions=8).select(
        F.when(F.col("id") == 1_999, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit("A").alias("cls"))
    with pytest.raises(Exception, match="half-way"):
        write_partitioned(failing, path, "cls")
    assert sorted(tuple(r) for r in read_partitioned(spark, path).collect()) == [(1, "A"), (2, "B")]
    parent, name = os.path.split(path)
    assert [f for f in os.listdir(parent) if f.startswith(name)] == [name]  # nothing left beside it
    write_partitioned(old.where("id = 1"), path, "cls")
    assert [tuple(r) for r in read_partitioned(spark, path).collect()] == [(1, "A")]


def test_an_interrupted_swap_is_mended(spark):
    path = work_path(spark, "swap")
    spark.range(3).write.parquet(path + "._old")      # died between the two renames
    assert recover(spark, path) and spark.read.parquet(path).count() == 3
    spark.range(9).write.parquet(path + "._old")      # died before the clean-up
    assert not recover(spark, path) and spark.read.parquet(path).count() == 3
    assert not os.path.exists(path + "._old")
    replace_whole(spark, path, spark.range(5).write.parquet)
    assert spark.read.parquet(path).count() == 5


# --- counts of the writing job ---------------------------------------------------------------
def test_observed_counts_are_those_written(spark):
    landed, seen = written_observed(spark.range(1_000), "observed", rows=F.count(F.lit(1)),
                                    odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"rows": 1_000, "odd": 500} and landed.count() == 1_000
    found, path = Observation("sink"), work_path(spark, "observed_sink")
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("cls"))
    write_partitioned(rows, path, "cls", observation=found, observed=(F.count(F.lit(1)).alias("n"),))
    assert found.get == {"n": 100}


# --- broken records ----------------------------------------------------------------------------
CSV = """invoice_id,case_id,client_id,amount,import_date,status,source_system,batch_id
I1,C1,1,5.00,2024-01-01,IMPORTED,ANT,B1
I2,C1,1
I3,C1,1,5.00,2024-01-01,IMPORTED,ANT,B1,surplus,cells
I4,C1,1,"5.00,2024-01-01,IMPORTED,ANT,B1
I5,C1,1,5.00,2024-01-01,IMPORTED,ANT,"B1
I6,C1,1,five,2024-01-01,IMPORTED,ANT,B1
I7,C1,1,5.00,2024-01-01,IMPORTED,ANT,"B,1"
"""


@pytest.fixture
def broken_csv(spark):
    path = work_path(spark, "broken_csv")
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        f.write(CSV)
    return path


def test_broken_records_are_named_with_their_text(spark, broken_csv):
    rows = {r["invoice_id"]: r for r in read_invoices_csv(spark, broken_csv, mark_malformed=True).collect()}
    marks = {k: r[MALFORMED] for k, r in rows.items()}
    assert marks["I1"] == marks["I7"] == [] and marks["I6"] == ["amount"]
    assert all(RECORD in marks[k] for k in ("I2", "I3", "I4"))
    assert marks["I5"] == [] and rows["I5"]["batch_id"] == "B1"  # nothing is lost
    assert rows["I2"][RECORD] == "I2,C1,1" and rows["I3"][RECORD].endswith("surplus,cells")
    assert rows["I7"]["batch_id"] == "B,1" and rows["I1"][RECORD] is None


def test_broken_records_are_counted_and_kept_apart(spark, broken_csv, capsys):
    out = work_path(spark, "broken_out")
    main(["structural", "--input", broken_csv, "--output", out])
    printed = capsys.readouterr().out
    assert "Total records loaded: 3" in printed and "MALFORMED_ROWS=4" in printed and "BROKEN_RECORDS=3" in printed
    assert spark.read.parquet(out).count() == 3
    kept = spark.read.parquet(out + "_malformed")
    assert kept.count() == 4 and kept.where(F.col(RECORD) == "I2,C1,1").count() == 1


# --- the whole report -----------------------------------------------------------------------------
def test_report_document_holds_every_anomaly_in_order(spark):
    day = dt.datetime(2024, 1, 1)
    texts = [f"Competencia: 01.0{1 + i % 2}.2024\nVencimento: 05.01.2024\nDPD: {i - 3}" for i in range(8)]
    rows = [(i, 1, f"N|{i}", t, day + dt.timedelta(days=i), "u") for i, t in enumerate(texts)]
    classified = desc.analyse_descriptions(spark.createDataFrame(
        rows, "invoice_id long, case_id long, invoice_number string, description string, "
              "insert_date timestamp_ntz, insert_user string"))
    path = work_path(spark, "document")
    desc.write_document(desc.report_document(classified, "2024-01-31", 5), path)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    lines = [line.rstrip("\n") for p in parts for line in open(f"{path}/{p}")]
    at = lines.index("## Anomalous Invoice Detail")
    assert lines[at + 1].startswith("| invoice_id | case_id |")
    detail = [x for x in lines[at + 3:] if x.startswith("| ")]
    expected = desc.anomaly_detail(classified).collect()
    assert [x.split(" | ")[0] for x in detail] == [f"| {r['invoice_id']}" for r in expected] and expected
    assert "N\\|" in detail[0] and lines[0].startswith("# ") and lines[-1].startswith("- **AMBOS**")
    clean = desc.report_document(classified.where("false"), "2024-01-31", 5).collect()
    assert not [r for r in clean if r["line"].startswith("|")]


# --- bounds that the job finds itself ----------------------------------------------------------
def test_bounds_query_and_ranges():
    q = jdbc.bounds_query(516)
    assert q.startswith("(SELECT MIN(src.invoice_id) AS lower_bound, MAX(src.invoice_id) AS upper_bound FROM ")
    assert "client_id = 516" in q and "CHARINDEX" not in q
    with pytest.raises(TypeError):
        jdbc.bounds_query("1 OR 1=1")
    with pytest.raises(ValueError):
        jdbc.bounds_query(1, "1; DROP TABLE x")
    assert jdbc.with_bounds(10, 1009, 16) == (10, 1010, 16)
    assert jdbc.with_bounds(10, 12, 16) == (10, 13, 3)
    assert jdbc.with_bounds(None, None, 16) == jdbc.with_bounds(7, 7, 16) == (None, None, 1)


def test_reader_asks_for_bounds_that_are_not_given():
    asked = []

    class Reader:
        def format(self, kind):
            assert kind == "jdbc"
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return self

        def first(self):
            return {"lower_bound": 5, "upper_bound": 104}

    class Session:
        read = Reader()
        sparkContext = type("Context", (), {"defaultParallelism": 6})

    jdbc.read_invoice_text_jdbc(Session(), url="jdbc:x", user="u", password="p", client_id=3)
    assert asked[0]["dbtable"] == jdbc.bounds_query(3) and "partitionColumn" not in asked[0]
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("5", "105", "6")
    asked.clear()
    jdbc.read_invoice_text_jdbc(Session(), url="jdbc:x", user="u", password="p", client_id=3, num_partitions=1)
    assert len(asked) == 1 and "partitionColumn" not in asked[0]


# --- data checks of the settlement ------------------------------------------------------------
def test_wide_invoices_are_found_without_their_list(spark):
    rows = [(1, "r", "c", 7, "N7", f"T{i:03}") for i in range(50)] + [(1, "r", "c", 8, "N8", t) for t in ("b", None, "")]
    df = spark.createDataFrame(rows, "case_id long, ref_number string, client_ref_number string, "
                                     "invoice_id long, invoice_number string, codigo_titulo string")
    assert settle.wide_invoices(df).count() == 0
    wide, = settle.wide_invoices(df, limit=100).collect()
    assert (wide["invoice_id"], wide["titles"], wide["title_chars"]) == (7, 50, 250)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_overlapping_bands_stop_the_settlement(spark, capsys):
    root, out = work_path(spark, "overlap_tables"), work_path(spark, "overlap_out")
    i = td.settlement_inputs(spark, SF)
    extra = spark.createDataFrame([(516, 20, 40, Decimal("0.5"), dt.date(2024, 1, 1), dt.date(2024, 12, 31))],
                                  i.bands.schema)
    frames = [i.cases, i.invoices, i.case_attributes, i.debtors, i.persons, i.ptp, i.bands.unionByName(extra),
              i.payments]
    for name, df in zip(SETTLEMENT_TABLES, frames):
        df.write.parquet(f"{root}/{name}")
    args = ["settlement", "--tables-dir", root, "--client-id", "516", "--as-of", "2024-01-31", "--output", out]
    with pytest.raises(ValueError, match="overlapping"):
        main(args)
    assert not os.path.exists(out)
    main([*args, "--allow-overlaps"])
    printed = capsys.readouterr().out
    assert "OVERLAPPING_BANDS=2" in printed and "CASES_WITH_SEVERAL_LIVE_DPD=0" in printed
    assert spark.read.parquet(out).count() > 0
