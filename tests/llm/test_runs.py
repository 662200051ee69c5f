"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

from billing_guard.llm import queries, runs
from billing_guard.llm.common import table
from tests.llm.conftest import by


def brute_force(words, least=12):
    """Maximal stretches of every period; of equal stretches the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def periodic(rng):
    """Words of a small alphabet with copied stretches and some errors."""
    n, letters = rng.randrange(160), rng.choice([1, 2, 2, 3, 5])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n else 0):
        a, p = rng.randrange(n), rng.randrange(1, 40)
        for i in range(a + p, rng.randrange(a, n)):
            words[i] = words[i - p]
    for _ in range(rng.randrange(3) if n else 0):
        words[rng.randrange(n)] = rng.randrange(letters)
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_are_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        words = periodic(rng)
        assert runs.word_runs(words) == brute_force(words), words
    for words in (fibonacci(400), [7] * 300, [1] * 70 + [2] + [1] * 70, list(range(200)) * 3):
        assert runs.word_runs(words) == brute_force(words)


def test_words_may_arrive_in_any_pieces():
    rng = random.Random(4)
    for _ in range(300):
        words, catcher, at = periodic(rng), runs.SquareCatcher(), 0
        while at < len(words):
            step = rng.choice([1, 2, 3, 5, 50])
            catcher.feed(words[at:at + step])
            at += step
        assert catcher.finish() == brute_force(words)


def test_a_longer_least_length_keeps_the_longer_runs():
    words = [1] * 20 + [2] + [3] * 40
    assert runs.word_runs(words, 30) == [(21, 40, 1)] and len(runs.word_runs(words)) == 2


def test_a_misleading_hash_is_noticed():
    class Blind(runs.SquareCatcher):
        def _same(self, a, b, size):
            return True

    words = list(range(64)) * 2 + list(range(200, 264)) + list(range(100, 164))
    try:
        catcher = Blind()
        catcher.feed(words + words)
        found = catcher.finish()
    except runs._Misled:
        return
    assert found == brute_force(words + words)


def test_long_texts_take_time_in_proportion():
    rng = random.Random(5)
    unit = [rng.randrange(500) for _ in range(4_000)]
    assert runs.word_runs(unit * 20) == [(0, 80_000, 4_000)]
    assert runs.word_runs([0] * 100_000) == [(0, 100_000, 1)]


def test_find_runs_of_documents(docs):
    verse = "to be or\tnot  to be "
    texts = [None, "", " \n ", "one two", verse * 6, verse * 6, "a " * 40 + "B" + " a" * 40, "é\x85x " * 30]
    rows = docs([(i, t, "en") for i, t in enumerate(texts)] + [(None, "x " * 12, "en"), (1, "y " * 5, None)])
    got = by(runs.find_runs(rows), "doc_id")
    for i, text in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        expected = brute_force(words)
        dropped = {k for a, size, q in expected for k in range(a + q, a + size)}
        r = got[i][0]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), expected)
        assert r.collapsed == " ".join(w for k, w in enumerate(words) if k not in dropped)
    assert len(got[1]) == 2 and tuple(got[None][0].runs[0]) == (0, 12, 1)
    assert runs.find_runs(docs([])).count() == 0


def test_query_plants_and_digests(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = by(queries.queries()["op11_periodic_runs"](spark, sf_dir), "doc_id")
    planted = 0
    for d in table(spark, sf_dir, "documents").collect():
        words = re.findall("[^\x20\x09-\x0d]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if n > 3_000:
            continue  # brute force takes the square
        if h % 10 == 0 and n:
            planted += 1
            g = h // 10
            a, = [g % n]
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        expected = brute_force(words)
        r = got[d.doc_id][0]
        assert r.n_runs == len(expected)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{z},{q}\n" for a, z, q in expected).encode()).hexdigest()
        dropped = {k for a, z, q in expected for k in range(a + q, a + z)}
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        best = max(expected, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
    assert planted
