"""Fill-in-the-middle forms against the rule written out, and back."""

import hashlib
import re

import pytest
from fixtures import documents, texts
from pyspark.sql import functions as F

from tagloom.llm import middle


def plain_version(doc_id, text):
    t = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not t or h3 % 100 >= 90 or any(m in t for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, t
    lo, hi = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def key(row):
    return tuple((x is None, x) for x in row)


def test_forms_and_back(spark):
    rows = texts() + [(200 + i, t, "en", "src0") for i, t in enumerate((
        "a <P> b", "<S>", "x<M>", "<", "<<", ">", "<P", "P>", "S><", "<S", "\U0001f600́é\n\x00a", "ab" * 200_000, "a1" * 300_000))]
    rows += [(300 + i, "<P <S <M M> S> P> ><" * (i % 7 + 1), "en", "src1") for i in range(60)]
    out = middle.fill_in_middle(documents(spark, rows)).withColumn("restored", middle.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in out), key=key) == sorted((plain_version(i, t) for i, t, *_ in rows), key=key)
    assert sorted(((r["doc_id"], r["restored"]) for r in out), key=key) == sorted(((i, t or "") for i, t, *_ in rows), key=key)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert middle.fill_in_middle(documents(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 1000])
def test_spans_of_long_texts(limit):
    text = "abc  d,é9xyzzy\n" * 20 + "q" * 50
    ends = [0, *middle.unit_ends(text)]
    for a in range(0, len(ends), 3):
        for b in (0, 5, len(ends) - 1):
            lo, hi = sorted((a, b))
            assert middle.cut_text(text, (a, b), limit) == (len(ends) - 1, ends[lo], ends[hi])
