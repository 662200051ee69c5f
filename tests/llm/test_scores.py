"""Document scores against plain loops; stages on tables with clashing columns and repeated rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from billing_guard.llm import jaccard, langid, toxicity
from billing_guard.llm.common import table
from tests.llm.conftest import by

SF = "/root/testdata/sf0.001"


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def net():
    rng = random.Random(2)
    sample = [(lang, words(rng, letters, 30).encode()) for lang, letters in
              (("aa", "abcde"), ("bb", "vwxyz"), ("cc", "éèàç")) for _ in range(12)]
    return langid.train(sample, langid.TrainingPlan())


def test_document_probabilities_are_pooled_position_by_position(net):
    rng = random.Random(3)
    texts = [words(rng, letters, n) for letters in ("abcde", "vwxyz", "éèàçabv") for n in (1, 3, 40, 400)]
    texts += [None, "", "12 34 -- !", "é", "a" * 64, "a" * 65, "x" * 1_000]
    got = langid._scored(net, texts)
    for text, row in zip(texts, got.itertuples()):
        data = (text or "").encode()
        total, votes = np.zeros(len(net.languages)), np.zeros(len(net.languages))
        for at in range(0, len(data), langid.WINDOW):  # one window at a time
            codes, mask = langid._matrix([data[at:at + langid.WINDOW]])
            sums, own = langid._window_sums(net, np.ascontiguousarray(codes), mask)
            total += sums[0]
            votes += own[0]
        if not any(c.isalpha() for c in text or ""):
            assert (row.lang_pred, row.score, row.share) == (langid.UNDETERMINED, 0.0, 0.0)
            continue
        assert abs(total.sum() - len(data)) < 1e-3 * len(data)  # one label for every position
        assert row.lang_pred == net.languages[int(total.argmax())]
        assert row.score == pytest.approx(total.max() / total.sum(), abs=1e-4)
        assert row.share == pytest.approx(votes[total.argmax()] / votes.sum(), abs=1e-4)


def test_thinning_takes_the_rows_of_least_hash(docs):
    plan = langid.TrainingPlan(per_language=20)
    rows = docs([(i, f"text number {i}", "en" if i % 9 else "fr") for i in range(3_000)])
    got = langid.training_sample(rows, F.lit(True), plan)
    ranked = rows.select("lang", "text", F.xxhash64("doc_id", "text", F.lit(plan.seed)).alias("h")).orderBy("h").collect()
    for lang in ("en", "fr"):
        expected = [r.text.encode() for r in ranked if r.lang == lang][:20]
        assert sorted(t for name, t in got if name == lang) == sorted(expected)


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as cp

    names = ["row", "score", "language", "found", "tie", "others", "kept_id", "root", "col1"]
    rows = table(spark, SF, "documents").select("*", *[F.lit(k).alias(k) for k in names])
    toxic = toxicity.fit(rows, table(spark, SF, "labels"))
    expected = {r.doc_id for r in toxicity.score_toxicity(rows, toxic).collect() if r.score < cp.TOXIC_FROM}
    for name, stage in cp.STAGES[:-1]:
        rows_out = stage(spark, rows, SF)
        assert rows_out.columns == rows.columns, name
        held = rows_out.collect()
        assert held and all(r[k] == k for r in held[:5] for k in names)
        if name == "toxicity":
            assert {r.doc_id for r in held} == expected
        elif name == "language_id":
            scored = by(langid.predict_languages(rows, langid.fit(rows)), "doc_id")
            assert {r.doc_id for r in held} == {
                i for i, (p, *_) in scored.items() if p.lang_pred != "und" and p.score >= cp.LANGUAGE_FROM}


def test_of_repeated_rows_the_first_by_its_other_columns_stays(docs):
    text = "one two three four five six seven eight nine ten"
    rows = docs([(1, text, "fr"), (1, text, "en"), (1, text, None), (2, text, "aa"), (None, "other words", "b"),
                 (None, "other words", "a"), (None, None, "z"), (None, None, "y")])
    kept = sorted(((r.doc_id, r.text, r.lang) for r in jaccard.keep_one_of_each_group(rows).collect()), key=str)
    assert kept == sorted([(1, text, None), (None, "other words", "a"), (None, None, "y")], key=str)
