"""Property tests: the positional parsers against a plain-Python statement of
the same character-position rules, on random label-laden texts."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billing_guard.functions import text

TOKENS = ["NN:", "Titulo:", "DPD:", "Competencia:", "Vencimento:", " ", "  ", "\n", "\r\n",
          "\r", "-", "--", "7", "12", "0", "99999999999", "31.12.2024", "01.2024", "x", "ab c",
          "9" * 30]
texts = st.lists(st.lists(st.sampled_from(TOKENS), max_size=12).map("".join), min_size=1,
                 max_size=40)


def window_model(d, label, width=50):
    start = d.find(label) + 1 + len(label)          # 1-based; a missing label gives len(label)
    window = d[start - 1:start - 1 + width]
    cut = re.match(r"[^\r\n]*", window).group(0)
    return cut.strip(" ")


def dpd_model(d, empty_as_zero=True):
    start = d.find("DPD:") + 1 + 4
    rest = d[start - 1:start - 1 + 20].lstrip(" ")
    digits = re.match(r"[0-9\-]*", rest).group(0)
    if empty_as_zero and digits in ("", "-"):
        return 0
    if not re.fullmatch(r"-?\d+", digits):
        return None
    value = int(digits)
    return value if -2**31 <= value < 2**31 else None


def title_model(d):
    for label in ("NN:", "Titulo:"):
        if label in d:
            rest = d[d.find(label) + len(label):]
            return rest.split("\n", 1)[0].strip(" ")
    return None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=texts)
def test_positional_parsers_follow_character_positions(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, d string")
    d = F.col("d")
    rows = df.select(
        "i", "d",
        text.label_window(d, text.COMPETENCE_LABEL).alias("comp"),
        text.label_window(d, text.DUE_LABEL).alias("due"),
        text.dpd_window(d).alias("dpd0"),
        text.dpd_window(d, empty_as_zero=False).alias("dpd"),
        text.title_code(d).alias("title"),
    ).collect()
    for r in rows:
        assert r["comp"] == window_model(r["d"], "Competencia:"), repr(r["d"])
        assert r["due"] == window_model(r["d"], "Vencimento:"), repr(r["d"])
        assert r["dpd0"] == dpd_model(r["d"]), repr(r["d"])
        assert r["dpd"] == dpd_model(r["d"], empty_as_zero=False), repr(r["d"])
        assert r["title"] == title_model(r["d"]), repr(r["d"])


def line_model(d, label):
    m = re.search(re.escape(label) + r"\s*([^\r\n]+)", d)
    return m.group(1).strip(" ") if m else ""


def dpd_line_model(d):
    m = re.search(r"DPD:\s*(-?\d+)", d)
    if not m:
        return None
    value = int(m.group(1))
    return value if -2**31 <= value < 2**31 else None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=texts)
def test_line_parsers_follow_the_line_rules(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, d string")
    d = F.col("d")
    rows = df.select(
        "d",
        text.label_line(d, text.COMPETENCE_LABEL).alias("comp"),
        text.label_line(d, text.DUE_LABEL).alias("due"),
        text.dpd_line(d).alias("dpd"),
    ).collect()
    for r in rows:
        assert r["comp"] == line_model(r["d"], "Competencia:"), repr(r["d"])
        assert r["due"] == line_model(r["d"], "Vencimento:"), repr(r["d"])
        assert r["dpd"] == dpd_line_model(r["d"]), repr(r["d"])


def _dmy_text():
    part = st.integers(min_value=0, max_value=35).flatmap(
        lambda v: st.sampled_from([str(v), f"{v:02d}"]))
    year = st.integers(min_value=1990, max_value=2030).map(str)
    good = st.tuples(part, part, year).map(".".join)
    return st.one_of(good, st.sampled_from(["", "x", "15/01/2024", "1.2.24", "01.2024"]))


def _parse_model(x):
    import datetime as dt
    m = re.fullmatch(r"(\d{1,2})\.(\d{1,2})\.(\d{4})", x)
    if not m:
        return None
    try:
        return dt.date(int(m.group(3)), int(m.group(2)), int(m.group(1)))
    except ValueError:
        return None


def _swap_model(x):
    return x[3:5] + "." + x[0:2] + "." + x[6:10]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(_dmy_text(), _dmy_text()), min_size=1, max_size=40))
def test_due_date_repair_follows_the_rule(spark, pairs):
    from billing_guard.functions import dates
    df = spark.createDataFrame(pairs, "due string, comp string")
    rows = df.select("due", "comp", dates.repaired_due_date(F.col("due"), F.col("comp"))
                     .alias("got")).collect()
    for r in rows:
        due, comp = r["due"], r["comp"]
        candidate = _swap_model(due) if due[3:5] != comp[3:5] else due
        expected = _parse_model(candidate) or _parse_model(_swap_model(comp))
        assert r["got"] == expected, (due, comp)
