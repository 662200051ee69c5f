"""The word model of op7_quality against a plain statement of modified Kneser-Ney."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from billing_guard.llm import quality

TRUSTED = ["the cat sat on the mat ", "the cat sat on a hat\nand the cat ran", "a dog sat on the mat",
           "the dog ran and the cat sat"]
OTHERS = ["the cat sat on the mat", "mat the on sat cat the", "zebra, the cat \u00e9t\u00e9", "x", "the the the the "]


def words_of(text):
    return re.findall(rb"[^ \t\n\r\v\f]*[ \t\n\r\v\f]|[^ \t\n\r\v\f]+$", text.encode())


def brute_counts():
    tri = Counter()
    for t in TRUSTED:
        w = [b"", b"", *words_of(t)]
        tri.update(zip(w, w[1:], w[2:]))
    bi = Counter(g[1:] for g in tri)
    return {3: tri, 2: bi, 1: Counter(g[1:] for g in bi)}


def brute_log(text, counts, p0):
    def cut(order):
        n = Counter(counts[order].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        ds = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else y, 0.0), k) for k in (1, 2, 3)]
        return lambda c: ds[min(c, 3) - 1]

    cuts, held = {k: cut(k) for k in counts}, defaultdict(dict)
    for k in counts:
        for g, c in counts[k].items():
            held[k, g[:-1]][g[-1]] = c

    def p(k, gram):
        if k == 0:
            return p0(gram[-1])
        here = held.get((k, gram[-k:-1]), {})
        if not here:
            return p(k - 1, gram)
        total, c = sum(here.values()), here.get(gram[-1], 0)
        gamma = max(sum(map(cuts[k], here.values())) / total, 1e-12)
        return (c - cuts[k](c) if c else 0) / total + gamma * p(k - 1, gram)

    w = [b"", b"", *words_of(text)]
    return sum(math.log(p(3, g)) for g in zip(w, w[1:], w[2:]))


def test_word_model_is_kneser_ney_over_word_3_grams(spark, docs):
    counts = brute_counts()
    spelling = quality.train(spark.createDataFrame([(g[0].decode(),) for g in counts[1]], "text string"))
    folder, shards = quality.write_shards(spelling)
    every = [*TRUSTED, *OTHERS, OTHERS[0], None, ""]
    got = quality.perplexities(docs([(i, t, "en") for i, t in enumerate(every)]),
                               docs([(i, t, "en") for i, t in enumerate([*TRUSTED, None, ""])]).select("text")).collect()
    assert len(got) == len(every)

    def p0(word):
        return math.exp(quality._spelled(folder, shards, [word])[0])
    for r in got:
        text = every[r.doc_id]
        if not text:
            assert r.perplexity is None
        else:
            assert r.perplexity == pytest.approx(math.exp(-brute_log(text, counts, p0) / len(text.encode())), rel=1e-6)
    by_id = {r.doc_id: r.perplexity for r in got}
    assert by_id[4] < by_id[5]  # the same words in another order


def test_words_hold_every_byte_of_their_own_text():
    texts = [b"a b", b"a b ", b" \n", "\u00e9".encode(), b"b"]
    joint, starts, ends, words, text = quality.word_spans(texts)
    found = [[] for _ in texts]
    for s, e, t in zip(starts, ends, text):
        found[t].append(joint[s:e])
    assert found == [[b"a ", b"b"], [b"a ", b"b "], [b" ", b"\n"], ["\u00e9".encode()], [b"b"]]
    assert words[0] == words[2] and words[1] == words[-1] != words[3] and len(set(words.tolist())) == 6
    assert quality.before(words, text, 1).tolist() == [0, words[0], 0, words[2], 0, words[4], 0, 0]
    assert np.array_equal(quality.before(words, text, 2), np.zeros(8, np.uint64))
