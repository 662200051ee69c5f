"""Token ids, counts, packing and files against the libraries and brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from billing_guard.llm import bpecount, packing, tokenfile
from billing_guard.llm.encode import BYTE_BPE, WORD_BPE, Encoder, encoder, tokenizer_path
from billing_guard.session import work_path
from tests.llm.conftest import by

TEXTS = [None, "", " ", "Of it.", "I'LL don't  x\n\n y_z __ 12²3 ½ ª º \t <|endoftext|> b <|ENDOFTEXT|>",
         "Ünï İstanbul ẞ ß … “quoted” — 中文字 ①", "á b\r\n", "x\x1cy \x85 z'S 'Ve", "​ naïve!!",
         "a" * 3000 + " ab" * 4000, "the cat " * 5, "the cat " * 5]


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(tokenizer_path(n)) for n in (BYTE_BPE, WORD_BPE)}


def ids(library, name, text):
    return library[name].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_encoder_gives_the_library_ids(library, name):
    for text in TEXTS:
        assert encoder(name)(text) == np.array(ids(library, name, text), "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text_gives_the_library_ids_and_counts(text):
    for name in (BYTE_BPE, WORD_BPE):
        encode = encoder(name)
        assert encode(text) == (encode._encode([text])[0] if text else b"")
    assert bpecount.count_tokens(text) == len(encoder(WORD_BPE)(text)) // 4


def test_counts(docs, library):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "x y", "en"), (3, TEXTS[3], "en")]
    got = by(bpecount.count_documents(docs(rows), limit=20), "doc_id")
    for i, text in enumerate(TEXTS):
        n = len(ids(library, WORD_BPE, text))
        for r in got[i]:
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), n, n > 20)
    assert len(got[3]) == 2 and got[None][0].n_tokens == 2
    assert bpecount.count_documents(docs([])).count() == 0


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_frequent_words_are_merged_once_however_many_others_come(library, name):
    encode = Encoder(name, cache_words=200)
    merge, merged = encode.merge, []
    encode.merge = lambda symbols: merged.append(symbols) or merge(symbols)
    rng = random.Random(3)
    for _ in range(40):
        text = "".join(f" {w}" for k in range(50) for w in
                       ("frequent", "".join(rng.choices("abcdefgh", k=9)), f"naïve{k % 5}"))
        assert encode(text) == np.array(ids(library, name, text), "<u4").tobytes()
    assert len(set(merged)) > 1_900
    assert sum("frequent" in symbols for symbols in merged) == 1
    assert len(encode.cache) + len(encode.cache.older) <= 200


# --- packing -------------------------------------------------------------------------
def test_fullest_is_the_best_subset():
    rng = random.Random(5)
    for _ in range(200):
        room = rng.randint(1, 30)
        items = [rng.randint(1, 15) for _ in range(rng.randint(1, 8))]
        counts = {x: items.count(x) for x in items}
        chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
        best = max(s for k in range(len(items) + 1) for c in combinations(items, k) if (s := sum(c)) <= room)
        assert sum(x * k for x, k in chosen.items()) == best
        assert all(k <= counts[x] for x, k in chosen.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    histogram = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(30)}
    used = dict.fromkeys(histogram, 0)
    for p in packing.plan(histogram, 64):
        assert sum(x * k for x, k in p.lengths) <= 64
        for x, k in p.lengths:
            used[x] += k * p.times
    assert used == histogram


def test_packing(docs, library):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "x y", "en"), (5, TEXTS[5], "en")]
    rows += [(1000 + i, "same words here", "en") for i in range(40)]
    out = packing.pack_documents(docs(rows), 64).collect()
    for i, text, _ in rows:
        full = np.array([*ids(library, BYTE_BPE, text), 0], "<u4")
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == i})
        assert sum(p[2] for p in own) == len(full) and [p[0] for p in own] == list(range(len(own)))
        assert all(p[2] == 64 for p in own[1:]) and all(p[2] <= 64 for p in own)
        for _, start, length, crc in own:
            assert crc == zlib.crc32(full[start:start + length].tobytes())
    assert len([r for r in out if r.doc_id == 5]) == 2 * len({r.piece for r in out if r.doc_id == 5})
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) == -(-sum(r.length for r in out) // 64)  # the lower bound
    assert packing.pack_documents(docs([])).count() == 0


def test_ranks_do_not_depend_on_the_salts(docs, monkeypatch):
    pieces = packing.token_pieces(docs([(i, "w " * (i % 3), "en") for i in range(60)]))
    monkeypatch.setattr(packing, "_GROUP_ROWS", 7)
    ranks = {}
    for r in packing.ranked(pieces, 60).collect():
        ranks.setdefault(r["length"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())


# --- files -----------------------------------------------------------------------------
@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=600))
def test_elias_fano_round_trip(values):
    values = np.array(sorted(values), np.int64)
    code = tokenfile.EliasFano.encode(values)
    data = code.to_bytes()
    back, used = tokenfile.EliasFano.from_bytes(memoryview(data))
    assert used == len(data) and np.array_equal(back.values(), values)
    assert [back.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 1000, 50_000))
    assert len(tokenfile.EliasFano.encode(ends).to_bytes()) * 8 < 50_000 * (2 + np.log2(500) + 1.2)


def test_files(spark, docs, library):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "n", "en"), (2**60, "big", "en"), (-5, "", "en"),
                                                          (4, TEXTS[4], "en")]
    manifest = tokenfile.write_token_files(docs(rows), work_path(spark, "files"), file_ids=500)
    out = sorted(tokenfile.read_token_files(manifest, chunk_ids=700).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i or 0))
    start, texts = 0, {}
    for i, t, _ in rows:
        texts[i] = t
    for r in out:
        full = np.array([*ids(library, WORD_BPE, texts[r.doc_id]), 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(full), zlib.crc32(full.tobytes()))
        start += len(full)
    first = sorted(manifest.collect(), key=lambda m: (m.part, m.roll))[0]
    file = tokenfile.TokenFile(first.ids_path, first.index_path)
    assert file.offset(0) == 0 and file.doc_id(0) is None
    empty = tokenfile.write_token_files(docs([]), work_path(spark, "files"))
    assert tokenfile.read_token_files(empty).count() == 0


def test_small_files_share_part_files_and_reading_tasks(spark, docs):
    rows = [(i, f"word {i}", "en") for i in range(40)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        manifest = tokenfile.write_token_files(docs(rows), work_path(spark, "files"))
        files, total = manifest.count(), manifest.agg({"n_ids": "sum"}).first()[0]
        assert files > 2
        assert len(manifest.inputFiles()) == 1
        for read_ids, parts in ((tokenfile.READ_IDS, 1), (total // 2, 2), (1, files)):
            out = tokenfile.read_token_files(manifest, read_ids=read_ids)
            assert out.rdd.getNumPartitions() == parts
            assert [r.doc_id for r in sorted(out.collect(), key=lambda r: r.start)] == list(range(40))
    finally:
        spark.conf.set(coalesce, held)
