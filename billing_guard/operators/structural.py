"""Structural anomaly flags and classification of invoice import rows.

A row is classified by three facts about its key ``(invoice_id, case_id, amount)``:

* EXACT_DUPLICATE — the same (invoice, case, amount) occurs more than once;
* AMOUNT_MISMATCH — the (invoice, case) pair carries more than one amount;
* CASE_MISMATCH   — the invoice is linked to more than one case;

with priority CASE > AMOUNT > EXACT > CLEAN.  NULLs follow the original
aggregate-and-join program: NULL amounts are not counted as a distinct amount,
the exact-duplicate count groups NULL keys together, but an amount flag is NULL
(treated as not set) when invoice or case is NULL and a case flag is NULL when
the invoice is NULL.

Strategies
----------
``aggregate`` (default, skew-safe)
    One exchange.  A pass over the key columns names the hot invoices, pairs and keys
    (``operators/skew.py``).  Rows of a cold invoice meet by invoice; those of a hot
    invoice by (invoice, case); of a hot pair by key; copies of a hot key are dealt over
    many tasks.  Windows in each of these groups give what the group can tell; what it
    cannot (a hot invoice's cases, a hot pair's amounts, a hot key's copies) comes from
    a broadcast table of at most a few rows per hot entry, aggregated in a second pass that
    only hot rows reach and that is left out when nothing is hot.  So the input is read at
    most three times and shuffled once, whatever the shares, into tasks of about
    ``TASK_ROWS`` rows.  Reports sum the classified rows per class, where they lie and as the
    windows pass them on in order: nothing is held for each invoice.
``window`` (on request)
    Three window aggregates sharing one exchange on ``invoice_id``.  Every invoice's rows
    meet in one task, so only for inputs known to have no hot invoice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billing_guard.operators.skew import in_tasks, is_hot, rows_and_hot_shares, share_of
from billing_guard.session import written

INVOICE, CASE, AMOUNT = "invoice_id", "case_id", "amount"
KEYS = [INVOICE, CASE, AMOUNT]
ROWS = "n_rows"

# --- fixed values: class labels ---------------------------------------------
CASE_MISMATCH = "CASE_MISMATCH"
AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
EXACT_DUPLICATE = "EXACT_DUPLICATE"
CLEAN = "CLEAN"
CLASSES = (AMOUNT_MISMATCH, CASE_MISMATCH, CLEAN, EXACT_DUPLICATE)
# ---------------------------------------------------------------------------

FLAGS = ("exact_duplicate_flag", "amount_mismatch_flag", "case_mismatch_flag")


def _differs(lo: Column, hi: Column) -> Column:
    """More than one distinct non-NULL value, given the group's min and max."""
    return F.coalesce(lo != hi, F.lit(False))


def _amount_flag(lo: Column, hi: Column) -> Column:
    return F.when(F.col(INVOICE).isNull() | F.col(CASE).isNull(), F.lit(None).cast("boolean")) \
        .otherwise(_differs(lo, hi))


def _case_flag(lo: Column, hi: Column) -> Column:
    return F.when(F.col(INVOICE).isNull(), F.lit(None).cast("boolean")) \
        .otherwise(_differs(lo, hi))


def anomaly_type(case_flag: Column, amount_flag: Column, exact_flag: Column) -> Column:
    """Priority CASE > AMOUNT > EXACT > CLEAN; a NULL flag counts as not set."""
    return (F.when(case_flag, F.lit(CASE_MISMATCH))
            .when(amount_flag, F.lit(AMOUNT_MISMATCH))
            .when(exact_flag, F.lit(EXACT_DUPLICATE))
            .otherwise(F.lit(CLEAN)))


def _use_windows(strategy: str) -> bool:
    if strategy not in ("window", "aggregate"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy == "window"


# --------------------------------------------------------------------------
# groups that no hot entry makes large
# --------------------------------------------------------------------------
#: what rows of one exchange group share besides the invoice: a hot invoice's case, a hot
#: pair's amount, a share of a hot key
_GROUP = [INVOICE, "_case", "_amount", "_share"]
#: rows that one task of the exchange sorts, about
TASK_ROWS = 2_000_000
_HOT_INVOICE, _HOT_PAIR, _HOT_KEY = "_hot_invoice", "_hot_pair", "_hot_key"
_EXACT, _AMOUNTS, _CASES = "_exact", "_amounts_differ", "_cases_differ"


def _hot_facts(df: DataFrame, hot: list[dict[int, int]], weight: Column) -> tuple[DataFrame, ...]:
    """Cases of hot invoices, amounts of hot pairs, rows of hot keys: a few rows each.

    The aggregation has one group per hot entry and one for the rest of each level, so
    its result is bounded by the lists; it is brought to the driver once, because three
    joins use it.
    """
    pair = is_hot([INVOICE, CASE], hot[1])
    key = pair & is_hot(KEYS, hot[2])
    rows = (df.where(is_hot([INVOICE], hot[0]))
            .withColumn(_HOT_PAIR, pair).withColumn(_HOT_KEY, key)
            .groupBy(INVOICE, _HOT_PAIR, F.when(pair, F.col(CASE)).alias("_case"),
                     _HOT_KEY, F.when(key, F.col(AMOUNT)).alias("_amount"))
            .agg(F.min(CASE).alias("_case_lo"), F.max(CASE).alias("_case_hi"),
                 F.min(AMOUNT).alias("_amount_lo"), F.max(AMOUNT).alias("_amount_hi"),
                 F.sum(weight).alias("_n")))
    invoices, pairs, keys = {}, {}, []
    for r in rows.collect():
        _widen(invoices, (r[INVOICE],), r["_case_lo"], r["_case_hi"])
        if r[_HOT_PAIR]:
            _widen(pairs, (r[INVOICE], r["_case"]), r["_amount_lo"], r["_amount_hi"])
        if r[_HOT_KEY]:
            keys.append((r[INVOICE], r["_case"], r["_amount"], r["_n"]))
    types = {k: df.schema[k].dataType.simpleString() for k in KEYS}

    def local(held: list, names: list[str], facts: str) -> DataFrame:
        return df.sparkSession.createDataFrame(held, ", ".join(f"{k} {types[k]}" for k in names) + ", " + facts)

    return (local([k + v for k, v in invoices.items()], [INVOICE],
                  f"_hot_case_lo {types[CASE]}, _hot_case_hi {types[CASE]}"),
            local([k + v for k, v in pairs.items()], [INVOICE, CASE],
                  f"_hot_amount_lo {types[AMOUNT]}, _hot_amount_hi {types[AMOUNT]}"),
            local(keys, KEYS, "_hot_n long"))


def _widen(held: dict, key: tuple, lo, hi) -> None:
    """Widen a key's (least, greatest) by another pair; None is no value."""
    before = held.get(key, (None, None))
    held[key] = tuple(pick((v for v in pair if v is not None), default=None)
                      for pick, pair in ((min, (before[0], lo)), (max, (before[1], hi))))


def _attach(df: DataFrame, facts: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """``df`` with a bounded table's facts and a column that marks the rows that have some."""
    right = facts.withColumnsRenamed({k: f"_f_{k}" for k in keys}).withColumn(mark, F.lit(True))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_f_{k}"))
    return df.join(F.broadcast(right), same, "left").drop(*[f"_f_{k}" for k in keys])


def flagged(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """The rows with three flags, the exchange group's columns and ``_hot_invoice``.

    ``weight`` is how many rows a row stands for (a key table's counts; 1 by default).
    """
    n = F.lit(1) if weight is None else weight
    columns = df.columns
    n_rows, hot = rows_and_hot_shares(df, [INVOICE], [INVOICE, CASE], KEYS)
    if hot[0]:
        invoices, pairs, keys = _hot_facts(df, hot, n)
        rows = _attach(df, invoices, [INVOICE], _HOT_INVOICE)
        rows = _attach(rows, pairs, [INVOICE, CASE], _HOT_PAIR)
        rows = _attach(rows, keys, KEYS, _HOT_KEY)
        shares = F.lit(max(hot[2].values(), default=1))
        rows = (rows.withColumn("_case", F.when(F.col(_HOT_INVOICE), F.col(CASE)))
                .withColumn("_amount", F.when(F.col(_HOT_PAIR), F.col(AMOUNT)))
                .withColumn("_share", F.when(F.col(_HOT_KEY), share_of(columns, shares))))
        group = _GROUP
    else:
        rows, group = df, [INVOICE]
    # clusters and orders all windows below: one exchange and one sort in total
    rows = in_tasks(rows, n_rows, TASK_ROWS, group).sortWithinPartitions(*group, CASE, AMOUNT)
    in_group, in_pair, in_key = (Window.partitionBy(*group, *more) for more in ([], [CASE], [CASE, AMOUNT]))
    case_lo, case_hi = F.min(CASE).over(in_group), F.max(CASE).over(in_group)
    amount_lo, amount_hi = F.min(AMOUNT).over(in_pair), F.max(AMOUNT).over(in_pair)
    copies = F.sum(n).over(in_key)
    if hot[0]:
        case_lo = F.when(F.col(_HOT_INVOICE), F.col("_hot_case_lo")).otherwise(case_lo)
        case_hi = F.when(F.col(_HOT_INVOICE), F.col("_hot_case_hi")).otherwise(case_hi)
        amount_lo = F.when(F.col(_HOT_PAIR), F.col("_hot_amount_lo")).otherwise(amount_lo)
        amount_hi = F.when(F.col(_HOT_PAIR), F.col("_hot_amount_hi")).otherwise(amount_hi)
        copies = F.when(F.col(_HOT_KEY), F.col("_hot_n")).otherwise(copies)
    hot_invoice = F.coalesce(F.col(_HOT_INVOICE), F.lit(False)) if hot[0] else F.lit(False)
    return rows.select(*columns, (copies > 1).alias(_EXACT), _amount_flag(amount_lo, amount_hi).alias(_AMOUNTS),
                       _case_flag(case_lo, case_hi).alias(_CASES), *group[1:], hot_invoice.alias(_HOT_INVOICE))


# --------------------------------------------------------------------------
# single flags (each adds one boolean column to the rows)
# --------------------------------------------------------------------------
def detect_exact_duplicates(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """``exact_duplicate_flag``: the row's (invoice, case, amount) occurs twice or more."""
    if _use_windows(strategy):
        return df.withColumn("exact_duplicate_flag",
                             F.count(F.lit(1)).over(Window.partitionBy(*KEYS)) > 1)
    return flagged(df).select(*df.columns, F.col(_EXACT).alias(FLAGS[0]))


def detect_amount_mismatch(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """``amount_mismatch_flag``: the row's (invoice, case) has more than one amount."""
    if _use_windows(strategy):
        w = Window.partitionBy(INVOICE, CASE)
        return df.withColumn("amount_mismatch_flag",
                             _amount_flag(F.min(AMOUNT).over(w), F.max(AMOUNT).over(w)))
    return flagged(df).select(*df.columns, F.col(_AMOUNTS).alias(FLAGS[1]))


def detect_case_mismatch(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """``case_mismatch_flag``: the row's invoice is linked to more than one case."""
    if _use_windows(strategy):
        w = Window.partitionBy(INVOICE)
        return df.withColumn("case_mismatch_flag",
                             _case_flag(F.min(CASE).over(w), F.max(CASE).over(w)))
    return flagged(df).select(*df.columns, F.col(_CASES).alias(FLAGS[2]))


def classify_anomaly(df: DataFrame) -> DataFrame:
    """Replace the three flag columns by ``anomaly_type``."""
    return df.withColumn(
        "anomaly_type",
        anomaly_type(F.col("case_mismatch_flag"), F.col("amount_mismatch_flag"),
                     F.col("exact_duplicate_flag")),
    ).drop(*FLAGS)


def _type_of_flags() -> Column:
    return anomaly_type(F.col(_CASES), F.col(_AMOUNTS), F.col(_EXACT)).alias("anomaly_type")


# --------------------------------------------------------------------------
# fused classification
# --------------------------------------------------------------------------
def key_classes(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """One row per distinct (invoice, case, amount): row count, flags and class.

    The rows are first collapsed per key by a map-side-combined count (all copies of a key,
    however many, become one row per map task); the keys are then flagged like rows.
    """
    per_key = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias(ROWS))
    if _use_windows(strategy):
        by_pair = Window.partitionBy(INVOICE, CASE)
        by_invoice = Window.partitionBy(INVOICE)
        rows = per_key.repartition(INVOICE).select(
            *KEYS, ROWS, (F.col(ROWS) > 1).alias(_EXACT),
            _amount_flag(F.min(AMOUNT).over(by_pair), F.max(AMOUNT).over(by_pair)).alias(_AMOUNTS),
            _case_flag(F.min(CASE).over(by_invoice), F.max(CASE).over(by_invoice)).alias(_CASES))
    else:
        rows = flagged(written(per_key, "invoice_keys"), F.col(ROWS))
    marks = [F.col(a).alias(b) for a, b in zip((_EXACT, _AMOUNTS, _CASES), FLAGS)]
    return rows.select(*KEYS, ROWS, *marks, _type_of_flags())


def classify_structural(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """Every input row with its ``anomaly_type`` appended (flags not kept)."""
    if _use_windows(strategy):
        return _classify_by_windows(df)
    return flagged(df).select(*df.columns, _type_of_flags())


def class_summary(df: DataFrame) -> DataFrame:
    """One row per class: rows, rows with an invoice, rows with an amount, distinct invoices
    and the sum of the amounts.

    Summed per class where the classified rows lie.  Of a cold invoice, whose rows lie together
    in order, the first row of each class stands for it, so distinct invoices need neither an
    exchange nor a table of them; hot invoices, of which there are few, are told apart by name.
    """
    rows = flagged(df.select(*KEYS))
    group = [c for c in _GROUP if c in rows.columns]
    earlier = (Window.partitionBy(*group).orderBy(CASE, AMOUNT)
               .rowsBetween(Window.unboundedPreceding, -1))
    bit = F.coalesce(*[F.when(F.col("anomaly_type") == c, F.lit(1 << i)) for i, c in enumerate(CLASSES)])
    seen = F.coalesce(F.bit_or("_bit").over(earlier), F.lit(0))
    rows = (rows.select(*rows.columns, _type_of_flags()).withColumn("_bit", bit)
            .withColumn("_first", seen.bitwiseAND(F.col("_bit")) == 0))
    named = F.col(INVOICE).isNotNull()
    cold = named & ~F.col(_HOT_INVOICE)
    per_invoice = (rows.groupBy("anomaly_type", F.when(F.col(_HOT_INVOICE), F.col(INVOICE)).alias("_name"))
                   .agg(F.count(F.lit(1)).alias("_rows"),
                        F.count(INVOICE).alias("_with_invoice"),
                        F.count(AMOUNT).alias("_with_amount"),
                        F.count_if(cold & F.col("_first")).alias("_cold"),
                        F.sum(AMOUNT).alias("_total")))
    return per_invoice.groupBy("anomaly_type").agg(
        F.sum("_rows").alias("rows"),
        F.sum("_with_invoice").alias("rows_with_invoice"),
        F.sum("_with_amount").alias("rows_with_amount"),
        F.sum(F.col("_cold") + F.col("_name").isNotNull().cast("int")).alias("invoices"),
        F.sum("_total").alias("total"))


def _classify_by_windows(df: DataFrame) -> DataFrame:
    by_key = Window.partitionBy(*KEYS)
    by_pair = Window.partitionBy(INVOICE, CASE)
    by_invoice = Window.partitionBy(INVOICE)
    exact = F.count(F.lit(1)).over(by_key) > 1
    amount = _amount_flag(F.min(AMOUNT).over(by_pair), F.max(AMOUNT).over(by_pair))
    case = _case_flag(F.min(CASE).over(by_invoice), F.max(CASE).over(by_invoice))
    # Hash on invoice_id clusters all three window specs: one exchange in total.
    return df.repartition(INVOICE).withColumn("anomaly_type", anomaly_type(case, amount, exact))
