"""Language, toxicity, quality and html operators; the pipeline; the registration."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from billing_guard.llm import decontaminate, htmltext, jaccard, langid, quality, queries, toxicity
from billing_guard.llm.common import table
from tests.llm.conftest import by
from tests.llm.test_joins import brute_overlap

SF = "/root/testdata/sf0.01"


# --- language ------------------------------------------------------------------------
def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = langid._initial(["a", "b"], 3, rng)
    codes, mask = langid._matrix([b"hello world", b"abc", b"x" * langid.WINDOW])
    labels = np.array([0, 1, 0])
    _, grads = langid._gradients(net, codes, mask, labels)
    for w, g in zip(net.parameters(), grads):
        k = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        held, eps = w[k].copy(), 1e-2
        w[k] = held + eps
        up, _ = langid._gradients(net, codes, mask, labels)
        w[k] = held - eps
        down, _ = langid._gradients(net, codes, mask, labels)
        w[k] = held
        # the training derivative of the tanh approximant is that of tanh itself
        assert (up - down) / (2 * eps) == pytest.approx(float(g[k]), rel=0.2, abs=2e-3)


def test_prediction_reads_as_training_does():
    net = langid._initial(["a", "b", "c"], 4, np.random.default_rng(0))
    codes, mask = langid._matrix([b"some text", b"a" * langid.WINDOW, b"\xc3\xa9"])
    both = np.concatenate([langid._read(net, s, codes, mask, False)[0] for s in (0, 1)], axis=2)
    p = np.exp(both @ net.out + net.bias)
    p = p / p.sum(axis=2, keepdims=True) * mask[:, :, None]
    sums, votes = langid._window_sums(net, np.ascontiguousarray(codes), mask)
    assert np.allclose(sums, p.sum(axis=0), atol=1e-3) and np.allclose(votes.sum(axis=1), mask.sum(axis=0))


def test_languages(spark, docs):
    given = table(spark, SF, "documents")
    net = langid.fit(given)
    scored = langid.predict_languages(given, net).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(scored) == given.count() and all(0 <= r.score <= 1 for r in scored)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 .. !", "en"), (4, "the and of that " * 20, None),
            (5, "x", "en"), (6, "the and of " * 40000, "en"), (6, "the and of " * 40000, "en"), (None, "a b", "en")]
    got = by(langid.predict_languages(docs(rows), net), "doc_id")
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 for i in (1, 2, 3))
    assert got[4][0].lang_pred == "en" and len(got[6]) == 2 and got[5][0].lang_pred != "und"
    assert langid.fit(docs([])) is None and langid.predict_languages(docs([]), None).count() == 0
    assert langid.predict_languages(docs(rows), None).select("lang_pred").distinct().collect()[0][0] == "und"
    assert langid.training_sample(docs(rows[:3] + [(9, "abc", "und"), (9, "abc", None)]), F.lit(True)) == [
        ("en", b"12 .. !")]


# --- toxicity -------------------------------------------------------------------------
def test_paths():
    def paths(symbols):
        return [p for _, p in toxicity.clause_matches(symbols)]
    assert paths("..I.") == ["plain"] and paths("G.I") == ["targeted"] and paths("I..G") == ["targeted"]
    assert paths("N.I") == ["negated"] and paths("N....I") == ["plain"] and paths("R..I") == ["reported"]
    assert paths("QIQ.I") == ["reported", "plain"] and paths("T.G") == ["threat"] and paths("NT.G") == []
    assert paths("T......G") == [] and paths("") == []


def test_toxicity(spark, docs):
    given, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    grammar = toxicity.fit(given, labels)
    rows = (toxicity.score_toxicity(given, grammar).join(labels, "doc_id")
            .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).collect())
    english = set(r.doc_id for r in given.where("lang = 'en'").collect())
    hit = Counter((r.toxic, r.score >= 0.3) for r in rows)
    assert hit[0, True] <= 0.03 * (hit[0, True] + hit[0, False])
    own = [r.score >= 0.3 for r in rows if r.toxic and r.doc_id in english]
    assert sum(own) >= 0.9 * len(own)
    cases = [(1, None, "en"), (2, "", "en"), (3, "idiot moron scum trash", "en"), (4, "calm words " * 50000, "en"),
             (4, "calm words " * 50000, "en"), (None, "loser idiot", "en")]
    got = by(toxicity.score_toxicity(docs(cases), grammar), "doc_id")
    assert got[1][0].score == got[2][0].score == got[4][0].score < 0.3 <= got[3][0].score
    assert len(got[4]) == 2 and got[None][0].score >= 0.3
    prior = toxicity.fit(docs([]), labels.limit(0))
    assert prior.score("you stupid idiot, worthless scum") >= 0.3 > prior.score("a fine day")
    assert toxicity.score_toxicity(docs([]), prior).count() == 0


# --- quality --------------------------------------------------------------------------
def test_kneser_ney_is_a_distribution(spark, docs):
    texts = docs([(i, t, "en") for i, t in enumerate(["the cat sat on the mat", "the hat", "", None, "ab"])])
    folder, shards = quality.write_shards(quality.train(texts.select("text")), shard_rows=20)
    assert shards > 1
    for context in (b"the", b" ca", b"zzz", b"\0\0\0", b"\0\0t", b"eab"):
        code = int.from_bytes(context, "big")
        grams = np.array([code << 8 | b for b in range(256)], np.uint32)
        p = np.exp(quality.log_probabilities(folder, shards, grams))
        assert p.sum() == pytest.approx(1.0, abs=1e-9) and (p > 0).all()


def test_quality(spark, docs):
    given, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.classify_quality(given, labels).join(labels, "doc_id").collect()
    kept = Counter((r.quality, r.keep) for r in rows)
    assert kept[1, True] >= 0.97 * (kept[1, True] + kept[1, False])
    assert kept[0, False] >= 0.8 * (kept[0, True] + kept[0, False])
    marks = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (9, None, 0), (None, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    cases = [(1, "the cat sat", "en"), (2, "the hat sat", None), (3, None, "en"), (4, "", "xx"), (5, "the cat", "xx"),
             (5, "the cat", "xx"), (6, "ZQ#%&" * 9000, "en"), (None, "the sat", "en")]
    got = by(quality.classify_quality(docs(cases), marks), "doc_id")
    assert [got[i][0].perplexity for i in (3, 4)] == [None, None] and not got[3][0].keep
    assert got[1][0].keep and got[2][0].keep and not got[6][0].keep and len(got[5]) == 2
    assert got[5][0].threshold == max(got[1][0].perplexity, got[2][0].perplexity)
    assert all(r.keep and r.perplexity == pytest.approx(256)
               for r in quality.classify_quality(docs(cases[:2]), marks.limit(0)).collect())
    assert quality.classify_quality(docs([]), marks).count() == 0


# --- html -----------------------------------------------------------------------------
@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b <i>c</i><br>d", "a\nb c d"),
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/x'>Home</a></nav>"
     "<div class='ad'>Buy, now!</div><article><h1>Title</h1><p>First,  long\n paragraph &lt;b&gt;.</p><p>Of.</p>"
     "<script>var a='</p>';</script><!-- <p>no</p> --><aside>side</aside><form><p>Name</p></form></article>"
     "<section id=comments><p>Great post, really. Thanks!</p></section><footer>&copy; x</footer></body></html>",
     "Title\nFirst, long paragraph <b>.\nOf."),
    ("<body><div class=post><h2>T</h2><p>Some text, and more of it. Yes.</p><p>End</p></div>"
     "<div class='comments'><p>I agree, really. Truly, madly, deeply agreed.</p></div>"
     "<div class='cookie notice'>We use cookies.</div>", "T\nSome text, and more of it. Yes.\nEnd"),
    ("<article><p>Cut &am", "Cut &am"), ("<article><p>x<", "x<"), ("<article></article><footer>f</footer>", ""),
    ("<article>" + "<p>word word.</p>" * 5000 + "</article>", "\n".join(["word word."] * 5000)),
])
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


def test_pages(spark):
    cases = [(1, "u", "<article><p>a é</p></article>"), (1, "u", "<article><p>a é</p></article>"), (None, None, None)]
    df = spark.createDataFrame([(*c, "x", 0) for c in cases], "page_id long, url string, html string, text string, n_chars int")
    got = by(htmltext.extract_pages(df), "page_id")
    assert [(r.text, r.n_chars) for r in got[1]] == [("a é", 3)] * 2
    assert (got[None][0].text, got[None][0].n_chars) == ("", 0)
    assert htmltext.extract_pages(df.limit(0)).count() == 0


# --- the whole -------------------------------------------------------------------------
def test_pipeline(spark):
    """Each stage against its brute-force version on the stage's own input."""
    import corpus_pipeline as cp

    docs = table(spark, SF, "documents")
    bench = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "language_id", "jaccard_join", "decontamination", "packing"]
    for name, stage in cp.STAGES[:-1]:
        rows = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema == docs.schema
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept = {r.doc_id for r in out.collect()}
        assert kept <= set(rows) and len(kept) == out.count()
        if name == "decontamination":
            seeds = decontaminate.Index.of(list(bench.items()))
            suspects = [i for i, t in rows.items() if len(seeds.hits(decontaminate.word_hashes(
                decontaminate.words(t)))[0])]
            bad = {i for i in suspects if any(brute_overlap(rows[i], t, 13) for t in bench.values())}
            assert bad and kept == set(rows) - bad
        elif name == "jaccard_join":
            sets = {i: set(jaccard.shingles(t).tolist()) for i, t in rows.items()}
            ids, up = sorted(sets), {i: i for i in sets}

            def find(i):
                while up[i] != i:
                    i = up[i]
                return i
            for a in ids:
                for b in ids:
                    if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        up[max(x, y)] = min(x, y)
            assert kept == {find(i) for i in ids}
        else:
            assert len(kept) >= 0.9 * len(rows)
        docs = out
    packed = stages["packing"](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}


def test_an_empty_corpus_runs_through(spark, docs):
    import corpus_pipeline as cp

    rows = docs([])
    for _, stage in cp.STAGES:
        rows = stage(spark, rows, SF)
    assert rows.count() == 0


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
