"""One row of each group of near duplicates, whatever their ids."""

from billing_guard.llm import jaccard

NEAR = " ".join(f"word{i}" for i in range(120))
OTHER = " ".join(f"other{i}" for i in range(120))


def test_a_group_without_own_ids_keeps_one_row(docs):
    for ids in ((None, None, None), (7, 7, 9), (None, 3, None)):
        rows = [(i, NEAR + end, "en") for i, end in zip(ids, ("", " more", " yet more"))]
        rows += [(7, OTHER, "en"), (None, None, "en"), (8, "", "en")]
        kept = jaccard.keep_one_of_each_group(docs(rows)).collect()
        near = [r for r in kept if r.text and r.text.startswith(NEAR)]
        assert len(near) == 1 and near[0].doc_id == min((i for i in ids if i is not None), default=None)
        assert len(kept) == 4 and OTHER in [r.text for r in kept]
