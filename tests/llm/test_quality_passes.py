"""op7's passes: what one of them shuffles, hot words, words of any length, ways to the trusted texts."""

import json
import random
import subprocess
import sys
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from billing_guard.llm import quality, wordmodel
from billing_guard.session import work_path
from tests.llm.conftest import by

random.seed(7)
LEXICON = ["".join(random.choices("abcdefghijklmnop", k=random.randint(2, 9))) for _ in range(1_000)]


def prose(words):
    return " ".join("the" if random.random() < 0.3 else random.choice(LEXICON) for _ in range(words))


@pytest.fixture(scope="module")
def given(spark, docs):
    rows = [(i, prose(400), ("en", "de", None)[i % 3]) for i in range(250)]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, rows[0][1], "en"), (None, "the end", "en")]
    labels = [(i, int(i % 3 > 0), 0) for i in range(250)] + [(None, 1, 0), (5000, 1, 0)]
    path = work_path(spark, "given")
    docs(rows).write.parquet(path)
    return spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_no_stage_shuffles_more_than_the_texts(given, tmp_path):
    given[0].write.parquet(str(tmp_path / "docs"))
    given[1].write.parquet(str(tmp_path / "labels"))
    (tmp_path / "events").mkdir()
    script = textwrap.dedent(f"""
        from billing_guard.llm import quality
        from billing_guard.llm.common import share_package
        from billing_guard.session import build_session
        spark = build_session("quality", "local[4]", shuffle_partitions=4, conf={{
            "spark.driver.host": "127.0.0.1", "spark.eventLog.enabled": "true",
            "spark.checkpoint.dir": {str(tmp_path / "work")!r}, "spark.eventLog.dir": {str(tmp_path / "events")!r},
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}})
        share_package(spark)
        docs, labels = (spark.read.parquet({str(tmp_path)!r} + "/" + k) for k in ("docs", "labels"))
        quality.classify_quality(docs, labels).write.parquet({str(tmp_path / "out")!r})
        spark.stop()
    """)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    written = Counter()
    for log in (tmp_path / "events").iterdir():
        for event in map(json.loads, log.read_text().splitlines() if not log.name.startswith(".") else ()):
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                written[event["Stage ID"]] += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    text = sum(len(r.text) for r in given[0].collect() if r.text)
    assert sum(written.values()) > text > max(written.values())  # the whole job, in parts


def test_every_row_is_scored(given):
    rows = by(quality.classify_quality(*given), "doc_id")
    assert len(rows) == 254 and rows[0][0].perplexity == pytest.approx(rows[1002][0].perplexity, rel=1e-12)
    assert rows[1000][0].perplexity is None and not rows[1001][0].keep and rows[None][0].perplexity > 1
    assert sum(rows[i][0].keep for i in range(250) if i % 3) >= 160
    assert not any(rows[i][0].keep for i in range(3, 250, 3))


def test_trusted_texts_by_either_way(given, monkeypatch):
    sent = {(r.doc_id, r.perplexity, r.threshold, r.keep) for r in quality.classify_quality(*given).collect()}
    monkeypatch.setattr(quality, "_IDS_SENT", -1)
    moved = {(r.doc_id, r.perplexity, r.threshold, r.keep) for r in quality.classify_quality(*given).collect()}
    assert len(sent) == 254 and sent == moved


def hashes(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    return wordmodel.hashed_words(data, np.cumsum([len(t) for t in texts]))


def test_hashes_depend_on_the_words_alone():
    words = [bytes(random.choices(b"ab\xc3\xa9xyz", k=n)) + b" " for n in range(200) for _ in range(3)]
    words += [b"\0 ", b"\0\0 ", b"\t", b"\n", b"\x1f ", b" "]
    at_once, found = hashes(words)
    assert np.array_equal(at_once, np.cumsum([len(w) for w in words]))
    assert len(set(found.tolist())) == len(set(words))
    for k, w in enumerate(words):
        moved = hashes([b"x" * (k % 11) + b" " + w + b"y"])[1]
        assert moved[1] == found[k]


def test_hashes_of_words_that_differ_in_any_byte():
    for size in (1, 2, 7, 8, 9, 15, 16, 17, 64, 65, 80):
        word, texts = b"abcdefghijklmnop" * 5, []
        for k in range(size):
            texts += [word[:k] + bytes([x]) + word[k + 1:size] for x in range(33, 256)]
        assert len(set(hashes(texts)[1].tolist())) == len(set(texts))


def test_rows_of_a_hot_word_are_dealt_over_buckets_once_each():
    for rows, data, stops in wordmodel.pieces(pa.array([prose(3000), None, "", "the", "the the the"])):
        assert rows.tolist() == [0, 3, 4]
        words, starts = wordmodel.middles(data, stops)
        names, n = np.unique(words, return_counts=True)
        deal = wordmodel.Deal.of(40, dict(zip(names.tolist(), n.tolist())), len(words))
        assert len(deal.hot) == 1 and deal.shares[0] > 4
        met, pairs, buckets = [], [], set()
        for low in range(0, 40, 8):
            at, bucket, pair, pair_bucket = deal.chosen(words, starts, low, low + 8)
            assert ((bucket >= low) & (bucket < low + 8)).all() and ((pair_bucket >= low) & (pair_bucket < low + 8)).all()
            met += at.tolist()
            pairs += pair.tolist()
            buckets |= set(bucket[words[at] == deal.hot[0]].tolist())
        assert sorted(met) == list(range(len(words))) and len(buckets) > 4
        assert sorted(pairs) == np.flatnonzero((words == deal.hot[0]) & ~starts[1:]).tolist()


def test_found_has_every_key_and_no_other():
    for n in (0, 1, 3, 5000):
        keys = np.unique(np.array([random.getrandbits(64) for _ in range(n)] + [0, 2 ** 64 - 2][:n], np.uint64))
        found = wordmodel.Found(keys, np.arange(len(keys)) + 1)
        assert found(keys)[0].tolist() == list(range(1, len(keys) + 1))
        others = keys + np.uint64(1)
        assert not found(others[~np.isin(others, keys)])[1].any()
        assert not found(np.array([wordmodel.END], np.uint64))[1].any()
