"""Fill-in-the-middle forms of documents, cut where tokens end."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of

UNIT = r"[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: In percent: documents that are transformed, and those of them with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Code points matched at once; a capture takes about 100 bytes, so this bounds memory whatever the length of a text.
SLICE_CHARS = 1 << 18
FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_UNITS = regex.compile(f"({UNIT})*")
_LETTERS = regex.compile("[A-Za-z]*")


def unit_spans(text: str, limit: int = SLICE_CHARS) -> list[tuple[int, int]]:
    """Spans of about ``limit`` code points that cover the text and end where a unit ends."""
    spans, at = [], 0
    while at < len(text):
        end = min(len(text), at + limit)
        if text[end - 1].isascii() and text[end - 1].isalpha():
            end = _LETTERS.match(text, end).end()
        spans.append((at, end))
        at = end
    return spans


def unit_ends(text: str, start: int = 0, end: int | None = None) -> list[int]:
    """Where the units of the span end: one full match of (unit)*, whose group keeps every repetition."""
    return _UNITS.fullmatch(text, start, len(text) if end is None else end).ends(1)


def cut_text(text: str, draws: tuple[int, int], limit: int = SLICE_CHARS) -> tuple[int, int, int]:
    """(number of units n, end of the prefix, end of the middle); each cut is after draw % (n + 1) units, the smaller first."""
    spans = unit_spans(text, limit)
    if len(spans) < 2:
        ends = [0, *unit_ends(text)]
        lo, hi = sorted(d % len(ends) for d in draws)
        return len(ends) - 1, ends[lo], ends[hi]
    counts = [len(unit_ends(text, *s)) for s in spans]
    n = sum(counts)
    found = []
    for k in sorted(d % (n + 1) for d in draws):
        at = 0
        while k > counts[at]:
            k -= counts[at]
            at += 1
        found.append([spans[at][0], *unit_ends(text, *spans[at])][k])
    return n, found[0], found[1]


def draws_of(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of ``seed:doc_id``; a null doc_id is the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i: i + 4], "big") for i in range(0, 16, 4)]


def transform(text: str, draws: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n, lo, hi = cut_text(text, (draws[0], draws[1]))
    if not text or draws[2] % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if draws[3] % 100 < suffix_first:
        return n, "spm", lo, hi - lo, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", lo, hi - lo, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row; nothing is shuffled.

    A null text is the empty one, which has no units and stays plain, as do texts that hold a marker. A very long text is
    matched in spans of SLICE_CHARS code points that end where a unit ends. Rows that repeat a doc_id are each transformed
    with the same draws; a null doc_id draws from the seed alone. An empty table gives no rows; further columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = [transform(t, draws_of(i, seed), rate, suffix_first) for i, t in zip(ids, texts, strict=True)]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [c.split()[0] for c in FORMS.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, FORMS)


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made an output of.

    The parts hold no marker, and none can arise where a part meets a marker, as markers do not overlap; so the first
    occurrence of each marker is the one that was set.
    """
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substr(output, m + len(MIDDLE))
    psm = F.concat(F.substr(output, p + len(PREFIX), s - p - len(PREFIX)), middle, F.substr(output, s + len(SUFFIX), m - s - len(SUFFIX)))
    spm = F.concat(F.substr(output, p + len(PREFIX), m - p - len(PREFIX)), middle, F.substr(output, s + len(SUFFIX), p - s - len(SUFFIX)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
