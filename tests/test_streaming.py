"""Incremental description monitor (Structured Streaming)."""

import datetime as dt

from billing_guard.operators.sinks import read_partitioned
from billing_guard.session import work_path
from billing_guard.sources.schemas import INVOICE_TEXT
from billing_guard.streaming.descriptions import (
    description_stream,
    start_anomaly_sink,
    start_totals_sink,
)


def _land(spark, folder, start, texts):
    ts = dt.datetime(2024, 1, 1)
    rows = [(start + i, 1, f"N{start + i}", t, ts, "u") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, INVOICE_TEXT).write.mode("append").parquet(folder)


def test_stream_appends_only_new_anomalies_exactly_once(spark):
    source = work_path(spark, "stream_src")
    out, ck = work_path(spark, "stream_out"), work_path(spark, "stream_ck")
    _land(spark, source, 0, ["Competencia: 15.01.2024\nVencimento: 15.02.2024",
                             "Competencia: 15.01.2024\nVencimento: 15.01.2024"])
    start_anomaly_sink(description_stream(spark, source), out, ck).awaitTermination()
    assert read_partitioned(spark, out).count() == 1

    # a restart over the same checkpoint only processes the newly landed file
    _land(spark, source, 10, ["Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: -2"])
    start_anomaly_sink(description_stream(spark, source), out, ck).awaitTermination()
    got = sorted((r["invoice_id"], r["motivo_erro"]) for r in read_partitioned(spark, out).collect())
    assert got == [(0, "MES DIVERGENTE"), (10, "DPD NEGATIVO")]


def test_running_totals_in_state_store(spark):
    source = work_path(spark, "totals_src")
    _land(spark, source, 0, ["Competencia: 15.01.2024\nVencimento: 15.02.2024", "x", "y"])
    q = start_totals_sink(description_stream(spark, source), "reason_totals_test",
                          work_path(spark, "totals_ck"))
    q.awaitTermination()
    totals = {r["motivo_erro"]: r["record_count"]
              for r in spark.table("reason_totals_test").collect()}
    assert totals == {"MES DIVERGENTE": 1, "CLEAN": 2}
