"""Reading token files by ``select``."""

import numpy as np

from billing_guard.llm import tokenfile
from billing_guard.session import work_path


def test_runs_are_the_values_there():
    rng = np.random.default_rng(2)
    for size, step in ((1, 5), (700, 1), (1500, 40), (900, 2**40)):
        values = np.cumsum(rng.integers(0, step + 1, size)) - 9
        code = tokenfile.EliasFano.from_bytes(memoryview(tokenfile.EliasFano.encode(values).to_bytes()))[0]
        for _ in range(60):
            a, b = sorted(rng.integers(0, size + 1, 2).tolist())
            assert np.array_equal(code.run(a, b), values[a:b])


def test_the_reader_builds_no_table_of_a_whole_file(spark, docs):
    rows = [(None if i < 300 else i, "w " * (i % 7), "en") for i in range(900)]
    manifest = tokenfile.write_token_files(docs(rows).coalesce(1), work_path(spark, "files"))

    whole = tokenfile.read_token_files(manifest, chunk_ids=10**9).collect()
    held = tokenfile.EliasFano.values
    try:
        def refused(self):
            raise AssertionError("decoded whole")
        tokenfile.EliasFano.values = refused
        first = manifest.where("n_docs > 0").first()
        file = tokenfile.TokenFile(first.ids_path, first.index_path)
        assert file.reach(0, 0) == 1 and file.reach(0, 10**9) == file.n_docs
        read = tokenfile.read_token_files(manifest, chunk_ids=50)
        assert sorted(map(repr, read.collect())) == sorted(map(repr, whole))
    finally:
        tokenfile.EliasFano.values = held


def test_many_empty_documents_are_dealt_over_files(docs, spark):
    rows = docs([(i, None if i % 2 else "", "en") for i in range(1_000)])
    manifest = tokenfile.write_token_files(rows, work_path(spark, "empty_texts"), file_docs=60)
    files = manifest.collect()
    assert max(f.n_docs for f in files) == 60 and all(f.ids_path.startswith("file:") for f in files)
    back = tokenfile.read_token_files(manifest).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in back] == [(i, i, 1) for i in range(1_000)]
