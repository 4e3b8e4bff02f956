"""One row of each group of near copies, where doc_ids are null or repeated."""

from collections import Counter

from fixtures import documents

from tagloom.llm import jaccard


def test_one_row_of_each_group_stays(spark):
    def text(k, n=40):
        return " ".join(f"w{k}x{i}" for i in range(n))

    rows = [
        (1, text(1)), (1, text(1)),  # a repeated row that is the group's first
        (1, text(2)), (0, text(2)),  # another text under a doc_id, a copy; the first text of doc_id 1 stays
        (None, text(3)), (5, text(3) + " end"),  # a near copy without an id
        (None, text(4)), (None, text(4)),  # copies, all without an id
        (7, text(5)), (7, text(6)),  # two different texts under one doc_id
        (9, ""), (9, ""), (None, None), (10, text(7)),
    ]
    got = jaccard.keep_one(documents(spark, [(i, t, "en", "s") for i, t in rows]))
    want = [(1, text(1)), (0, text(2)), (5, text(3) + " end"), (None, text(4)), (7, text(5)), (7, text(6)), (9, ""), (9, ""), (None, None), (10, text(7))]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(want)
