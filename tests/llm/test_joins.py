"""Similarity joins, decontamination and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from billing_guard.llm import decontaminate, embeddings, graph, jaccard
from billing_guard.llm.common import words
from tests.llm.conftest import by


def groups_of(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    want = groups_of({n for p in pairs if p[0] != p[1] for n in p}, pairs)
    assert {r.node: r.root for r in graph.components(edges).collect()} == want
    assert graph.components(edges.limit(0)).count() == 0


# --- vectors --------------------------------------------------------------------------
def test_error_bound_loses_nothing():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 1100))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * rng.uniform(0, 0.6, (40, 1))])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.93)) if i < j}
    got = {(i, j) for a, b in embeddings.linked_pairs(x, x, 0.93, True) for i, j in zip(a, b)}
    assert got == want and want


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] + rng.normal(size=8) * 0.1).tolist(), i % 2) for i in range(60)]
    rows += [(60 + i, base[0].tolist(), 0) for i in range(20)]               # a group of copies
    rows += [(100, None, 0), (101, [0.0] * 8, 0), (102, [1.0, None] + [0.0] * 6, 0), (103, [], 0),
             (104, [float("nan")] + [1.0] * 7, 0), (105, base[0].tolist(), None), (106, base[0][:4].tolist(), 0),
             (107, [float("inf")] * 8, 0), (108, [1e-40] * 8, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, key string, size int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, block=16).collect()}
    assert len(got) == len(rows)
    good = {i: np.array(v, np.float32).astype(float) for i, v, label in rows
            if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: k for i, _, k in rows}
    pairs = [(a, b) for a in good for b in good if a < b and label[a] == label[b] and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.93]
    links = Counter(n for p in pairs for n in p)
    component = groups_of(got, pairs)
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (links[i], component[i], component[i] == i), i
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_a_null_vector_id_is_linked(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (4, [1.0, 0.01], 1)],
                               "vec_id long, embedding array<float>, label int")
    assert sorted((r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()) == [(2, 4)] * 3


# --- shingles -------------------------------------------------------------------------
def sentence(rng, n):
    return " ".join(f"w{rng.randint(0, 4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    rows = []
    for g in range(15):
        text = sentence(rng, rng.choice([4, 30, 120])).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 99)}"
            rows.append(" ".join(copy))
    passage = sentence(rng, 60)
    rows += [passage + " " + sentence(rng, 80) for _ in range(10)]            # share a passage only
    rows += ["...", "...", "", None, " \n", "Two words", "two  WORDS!", rows[0], rows[0]]
    return list(enumerate(rows))


def brute_links(corpus):
    sets = {}
    for i, text in corpus:
        w = words(text)
        sets[i] = ({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w
                   else {text.strip()} if text and text.strip() else set())
    return [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
            and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]


@pytest.mark.parametrize("block", [1024, 3])
def test_shingle_join(docs, corpus, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    pairs = brute_links(corpus)
    links, group = Counter(n for p in pairs for n in p), groups_of([i for i, _ in corpus], pairs)
    got = {r.doc_id: r for r in jaccard.linked_documents(docs([(i, t, "en") for i, t in corpus])).collect()}
    for i, _ in corpus:
        assert (got[i].n_links, got[i].group_id, got[i].kept) == (links[i], group[i], group[i] == i), i


def test_one_of_each_group_stays(docs, corpus):
    group = groups_of([i for i, _ in corpus], brute_links(corpus))
    rows = [(i, t, "en") for i, t in corpus]
    df = docs(rows + rows[:20])  # repeated rows
    kept = jaccard.keep_one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))
    assert jaccard.keep_one_of_each_group(docs([])).count() == 0
    nulls = docs([(None, "a b c d e f g", "en"), (None, "a b c d e f g", "en"), (None, None, "en")])
    assert len(jaccard.keep_one_of_each_group(nulls).collect()) == 2


def test_chance_matches_chain_no_groups(docs):
    rng = random.Random(5)
    passage = sentence(rng, 100)
    texts = [passage + " " + sentence(rng, 45) for _ in range(60)]            # Jaccard about 0.5
    texts += [texts[0] + " end", texts[1][:-6]]                               # two near copies
    found = jaccard.features(docs([(i, t, "en") for i, t in enumerate(texts)])).cache()
    shared = found.selectExpr("explode(bands) AS band").groupBy("band").count().where("count > 1")
    assert shared.count() > 20
    key = {r.doc_id: r.key for r in found.collect()}
    groups = {r.node: r.root for r in jaccard.candidate_groups(found).collect()}
    assert set(groups) == {key[i] for i in (0, 1, 60, 61)}
    assert groups[key[0]] == groups[key[60]] != groups[key[1]] == groups[key[61]]


def test_buckets_in_tiles_and_batches(docs, corpus, spark, monkeypatch):
    """A tile that goes on over several batches loses no tie."""
    found = jaccard.features(docs([(i, t, "en") for i, t in corpus])).where("key IS NOT NULL")
    classes = found.dropDuplicates(["key"]).cache()
    want = sorted(map(tuple, jaccard.candidate_groups(classes).collect()))
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert sorted(map(tuple, jaccard.candidate_groups(classes).collect())) == want and want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pruning_keeps_what_reaches_the_threshold():
    least = jaccard.least_agreements(0.8, 1e-7, range(20, 201, 20))
    assert all(0 < least[n] < 0.8 * n for n in least)
    rng = random.Random(1)
    text = sentence(rng, 300).split()
    near = text[:280] + sentence(rng, 20).split()
    sigs = [jaccard.signature(jaccard.shingles(" ".join(t)))[None] for t in (text, near, sentence(rng, 300).split())]
    assert jaccard.surviving(sigs[0], sigs[1], 0.8, 1e-7).all()
    assert not jaccard.surviving(sigs[0], sigs[2], 0.8, 1e-7).any()


# --- decontamination ---------------------------------------------------------------------
def brute_overlap(text, item, least):
    d, t = words(text), words(item)
    best = 0
    for diagonal in range(-len(t) + 1, len(d)):
        lo, hi = max(diagonal, 0), min(diagonal + len(t), len(d))
        score, same = 0.0, 0
        for k in range(lo, hi):
            equal = d[k] == t[k - diagonal]
            score, same = score + (1 if equal else -1.5), same + equal
            if score <= 0:
                score, same = 0.0, 0
            best = max(best, same)
    return t != [] and best >= min(least, len(t))


def test_contaminated_pairs(spark, docs):
    rng = random.Random(9)
    items = [(k, sentence(rng, n)) for k, n in enumerate([40, 25, 15, 8, 1])]
    items += [(5, items[0][1]), (6, None), (7, ""), (8, "...")]
    rows = []
    for k, text in items[:5]:
        for every in (0, 9, 5):
            w = text.split()
            if every:
                w[every - 1::every] = ["other"] * len(w[every - 1::every])
            rows.append(sentence(rng, 50) + ". " + " ".join(w).upper() + " " + sentence(rng, 30))
    rows += [" ".join(items[0][1].split()[:20]), " ".join(items[0][1].split()[:9]), items[1][1] + " " + items[2][1],
             "", None, "...", sentence(rng, 5000)]
    rows += rows[:1]
    df = docs([(i, t, "en") for i, t in enumerate(rows)] + [(None, rows[0], "en")])
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    want = {(i, k) for i, t in enumerate(rows) for k, item in items if brute_overlap(t, item, 13)}
    for block_words in (500_000, 30):  # one block, and several
        got = decontaminate.contaminated_pairs(df, bench, block_words=block_words)
        assert {(r.doc_id, r.item_id) for r in got.collect() if r.doc_id is not None} == want
        assert len(by(got, "doc_id")[None]) == 2
    clean = decontaminate.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(rows))) - {i for i, _ in want})
    assert decontaminate.contaminated_pairs(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated_pairs(docs([]), bench).count() == 0


def test_documents_are_scanned_once_for_any_benchmark(spark, docs, monkeypatch):
    from billing_guard.session import written

    rng = random.Random(10)
    items = [(k, sentence(rng, 20)) for k in range(30)]
    rows = docs([(k, f"{sentence(rng, 30)} {items[k][1]}", "en") for k in range(30)])
    df = written(rows, "scanned_once")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated_pairs(df, bench, block_words=20)  # about a block an item
    tree = found._jdf.queryExecution().executedPlan().toString()
    assert tree.count("FileScan") == 1 and "Exchange" not in tree and "Broadcast" not in tree
    assert {(k, k) for k in range(30)} <= {(r.doc_id, r.item_id) for r in found.collect()}
    assert decontaminate.Blocks.write(bench, 20).count >= 25


def test_portions_hold_every_text(monkeypatch):
    monkeypatch.setattr(decontaminate, "_AT_ONCE", 5)
    texts = ["a b c", None, "", "d e f g h i j", "k", "l m"]
    held = list(decontaminate.portions(texts))
    assert [first for first, _ in held] == [0, 4] and [len(h) for _, part in held for h in part] == [3, 0, 0, 7, 1, 2]
    assert list(decontaminate.portions([])) == []
