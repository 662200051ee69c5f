"""The language sample with more labels than were once taken."""

from collections import Counter

from pyspark.sql import functions as F

from billing_guard.llm import langid


def test_every_language_is_sampled(docs):
    rows = docs([(i, f"text {i}", f"l{i % 70}") for i in range(210)])
    count = Counter(lang for lang, _ in langid.training_sample(rows, F.lit(True)))
    assert count == {f"l{k}": 3 for k in range(70)}
    few = langid.training_sample(rows, F.lit(True), langid.TrainingPlan(documents=140))
    assert Counter(lang for lang, _ in few) == {f"l{k}": 2 for k in range(70)}
