"""Reusable operators: ranking, top-1 dedup, split join, band join, sinks."""

import random

import pytest
from pyspark.sql import functions as F

from billing_guard.operators.band_join import band_join
from billing_guard.operators.dedup import keep_first_per_group
from billing_guard.operators.ranking import row_number_in_groups
from billing_guard.operators.sinks import read_partitioned, write_partitioned
from billing_guard.operators.skew import hot_keys, hot_split_join, row_counts
from billing_guard.session import work_path


@pytest.fixture
def skewed(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.randint(0, 50), i) for i in range(500)]
    rows += [(f"g{i % 9}", rnd.randint(0, 50), 1000 + i) for i in range(90)]
    rows += [(None, 1, 5000), (None, 0, 5001)]
    return spark.createDataFrame(rows, "g string, k int, id int")


@pytest.mark.parametrize("partitions", [None, 6])
def test_distributed_row_numbers_equal_window(spark, skewed, partitions):
    order = [F.col("k").asc(), F.col("id").asc()]
    plain = row_number_in_groups(skewed, ["g"], order, "rn", strategy="window")
    other = row_number_in_groups(skewed, ["g"], order, "rn", partitions=partitions)
    key = lambda r: (r["g"] or "", r["id"])
    assert sorted((key(r), r["rn"]) for r in plain.collect()) == \
        sorted((key(r), r["rn"]) for r in other.collect())


def test_hot_group_is_ranked_across_partitions(spark, skewed):
    out = row_number_in_groups(skewed.where(F.col("g") == "hot"), ["g"],
                               [F.col("k"), F.col("id")], "rn", strategy="range", partitions=5)
    assert sorted(r["rn"] for r in out.collect()) == list(range(1, 501))


def test_keep_first_per_group_keeps_unkeyed_rows(spark, skewed):
    keyed = F.col("g").isNotNull() & (F.col("g") != "g0")
    out = keep_first_per_group(skewed, ["g"], keyed, [F.col("k").desc(), F.col("id")], "rn")
    rows = out.collect()
    assert sum(1 for r in rows if r["g"] is None) == 2
    assert sum(1 for r in rows if r["g"] == "g0") == 10
    hot = [r for r in rows if r["g"] == "hot"]
    assert len(hot) == 1
    best = skewed.where(F.col("g") == "hot").orderBy(F.col("k").desc(), "id").first()
    assert hot[0]["id"] == best["id"]


def test_top1_filter_is_planned_as_partial_group_limit(spark, skewed):
    keyed = F.col("g").isNotNull()
    out = keep_first_per_group(skewed, ["g"], keyed, [F.col("k").desc(), F.col("id")], "rn")
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_value", ["hot", None])
def test_split_join_equals_plain_join(spark, skewed, hot_value):
    if hot_value is None:  # a NULL key holds most rows
        skewed = skewed.withColumn("g", F.when(F.col("g") != "hot", F.col("g")))
    per_key = spark.createDataFrame([("hot", 1), ("g1", 2), ("g1", 7), ("g2", 3), (None, 4)], "g string, v int")
    hot = hot_keys(row_counts(skewed, ["g"]), ["g"], "_n", parts=5)
    assert [r["g"] for r in hot.collect()] == [hot_value]
    for how in ("left", "inner"):
        for null_safe in (False, True):
            cond = skewed["g"].eqNullSafe(per_key["g"]) if null_safe else skewed["g"] == per_key["g"]
            plain = skewed.join(per_key, cond, how).drop(per_key["g"])
            for listed in (hot, None):
                split = hot_split_join(skewed, per_key, ["g"], how, hot=listed, null_safe=null_safe)
                assert sorted(map(tuple, plain.collect()), key=str) == \
                    sorted(map(tuple, split.collect()), key=str), (how, null_safe)


def test_hot_keys_are_bounded_by_arithmetic(spark):
    counts = spark.createDataFrame([(k, 1 + k % 50) for k in range(3000)], "k int, n long")
    hot = hot_keys(counts, ["k"], "n", parts=2500)
    assert 0 < hot.count() <= 2500


def test_no_task_receives_a_hot_key(spark):
    """Neither a NULL nor a named key with a third of the rows meets in one shuffle task."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.col("id").cast("string")).alias("g"), "id")
    per_key = df.groupBy("g").agg(F.max("id").alias("top"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cold = hot_split_join(df, per_key, ["g"], "left", null_safe=True)
        # broadcast rows stay in their scan task: the largest task holds scan-sized parts
        sizes = cold.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 60_000
        assert max(r["count"] for r in sizes) <= 2 * 60_000 / spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_band_join(spark):
    values = spark.createDataFrame([(v,) for v in [None, -3, 0, 1, 30, 31, 500, 99999, 100000]],
                                   "d int")
    bands = spark.createDataFrame([(1, 30, "a"), (31, 60, "b"), (61, 99999, "c"), (50, 70, "x")],
                                  "lo int, hi int, label string")
    plain = values.join(bands, F.col("d").between(F.col("lo"), F.col("hi")), "left")
    as_set = lambda df: sorted((str(r["d"]), str(r["label"])) for r in df.collect())
    for width in (64, 7, 100_000):
        joined = band_join(values, bands, F.col("d"), "lo", "hi", width=width)
        assert as_set(joined) == as_set(plain)
        assert joined.columns == plain.columns
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
    assert len(joined.collect()) == 9          # unmatched values are kept once
    five_five = spark.createDataFrame([(55,)], "d int")
    assert sorted(r["label"] for r in band_join(five_five, bands, F.col("d"), "lo", "hi")
                  .collect()) == ["b", "x"]    # overlapping bands fan out


def test_partitioned_sink_round_trip_and_missing_path(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A")], "id int, cls string")
    path = work_path(spark, "sink_test")
    write_partitioned(df, path, "cls")
    back = read_partitioned(spark, path)
    assert sorted((r["id"], r["cls"]) for r in back.collect()) == [(1, "A"), (2, "B"), (3, "A")]
    with pytest.raises(ValueError):
        read_partitioned(spark, path + "-missing")


def test_dynamic_overwrite_replaces_only_written_classes(spark):
    path = work_path(spark, "sink_dynamic")
    write_partitioned(spark.createDataFrame([(1, "A"), (2, "B")], "id int, cls string"), path, "cls")
    update = spark.createDataFrame([(3, "A")], "id int, cls string")
    write_partitioned(update, path, "cls", dynamic_overwrite=True)
    assert sorted((r["id"], r["cls"]) for r in read_partitioned(spark, path).collect()) == \
        [(2, "B"), (3, "A")]
    write_partitioned(update, path, "cls")   # static: every class replaced
    assert [(r["id"], r["cls"]) for r in read_partitioned(spark, path).collect()] == [(3, "A")]
