"""Jaccard join of shingle sets by T-occurrence search after DivideSkip."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut
from .common import slices, small_side, text_of
from .groups import linked_groups

WORDS = 5
#: Two sets are linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A document in so many is read to find out which shingles have long lists, and in how many of those a shingle must stand.
SAMPLE, OFTEN = 16, 2
#: Two sets must meet in one list more for each so many shingles of the overlap they need.
STEP = 40
#: Shingles told apart as having long lists, and sets whose arrays are picked by a broadcast list, at most: 8 bytes each.
LONG_LISTS, PICKED = 1 << 20, 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(5)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for b in (_BASE, inverse):
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps))
        _POWERS[:] = _POWERS[-2:]
    return _POWERS[0], _POWERS[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of UTF-8 text, A-Z as a-z, a word being a run without ASCII white space."""
    found, starts, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + _CHUNK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        b = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        edge = np.diff(np.concatenate([[False], ~_SPACE[b], [False]]).astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(max(len(b), _CHUNK) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[b]] * up[: len(b)])])
        found.append(_mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(starts)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles; of a text with fewer words, of their whole sequence."""
    raw = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    hashes, starts = word_hashes(b" ".join(raw))
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
    whole = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
    for k in range(words):
        whole += hashes[k: k + len(whole)] * _PLACE[k % 16]
    whole = _mix(whole).view(np.int64)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo >= words:
            yield np.unique(whole[lo: hi - words + 1])
        elif hi > lo:
            short = hashes[lo:hi] * _PLACE[: hi - lo] + np.uint64(hi - lo)
            yield _mix(np.array([short.sum(dtype=np.uint64)])).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def required(n):
    """Least overlap with any set that a set of n shingles can be linked to."""
    return -(-PERCENT * n // 100)


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _long(shingles: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(shingles), dtype=bool)
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    return known[at] == shingles


def _batch(schema: str, *cols) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


SETS = "doc_id long, text_hash long, n_shingles long, set_id long"


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (null for an empty set) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [(len(s), set_id(s) if len(s) else None) for s in shingle_sets(b.column(2).to_pylist())]
            yield _batch(SETS, b.column(0).to_pylist(), b.column(1).to_pylist(), [n for n, _ in found], [i for _, i in found])

    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, SETS)


def long_lists(docs: DataFrame) -> np.ndarray:
    """Sorted shingles with long inverted lists, LONG_LISTS at most: those that stand most often in a sample of the texts.

    They only order the shingles (rare ones first); whichever are found, the join's result is the same.
    """
    text = text_of(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = list(shingle_sets(b.column(0).to_pylist()))
            keys, n = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)]), return_counts=True)
            yield _batch("key long, n long", keys, n)

    part = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).dropDuplicates(["text"])
    counts = cut(part.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN))
    least, total = OFTEN, 0
    for r in counts.groupBy(F.least("n", F.lit(4096)).alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("n")).collect():
        total += r["c"]
        if total > LONG_LISTS:
            least = r["n"] + 1
            break
    keys = counts.filter(F.col("n") >= least).select("key").toPandas()["key"].to_numpy(np.int64)
    return np.sort(keys)


POSTINGS = "key long, id long, size int, place int, rare int"


def short_list_postings(docs: DataFrame, long: np.ndarray) -> DataFrame:
    """(key, id, size, place, rare): each set under the shingles whose lists are merged, with their places in its order.

    Of a set's n shingles, ordered with the long lists last, the lists of the first n - T + 1 are merged; a set that shares
    T shingles with it cannot miss all of them, as only T - 1 lists are skipped. A task gives a set once, however many
    copies of a text it reads.
    """
    known = docs.sparkSession.sparkContext.broadcast(long)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in slices(batches, "text"):
            keys, ids, sizes, places, rares = [], [], [], [], []
            for s in shingle_sets(b.column(0).to_pylist()):
                if not len(s) or (i := set_id(s)) in seen:
                    continue
                seen.add(i)
                often = _long(s, known.value)
                first = np.concatenate([s[~often], s[often]])[: len(s) - required(len(s)) + 1]
                keys.append(first)
                ids.append(np.full(len(first), i))
                sizes.append(np.full(len(first), len(s)))
                places.append(np.arange(1, len(first) + 1))
                rares.append(np.full(len(first), len(s) - int(often.sum())))
            if keys:
                yield _batch(POSTINGS, *map(np.concatenate, (keys, ids, sizes, places, rares)))

    return docs.select(text_of(docs).alias("text")).mapInArrow(run, POSTINGS)


def shared_lists(postings: DataFrame) -> DataFrame:
    """The lists with two sets or more, with their centre: the set with the least share of rare shingles.

    A text that others were made from by small changes has no rare shingle, so it becomes the centre of its copies.
    """
    once = postings.repartition("key").dropDuplicates(["key", "id"])
    mark = F.struct("size", "place").alias("mark")
    best = F.struct((F.col("rare") / F.col("size")).alias("r"), "id", mark)
    w = Window.partitionBy("key")
    found = once.withColumns({"n": F.count("*").over(w), "best": F.min(best).over(w)}).filter("n > 1")
    return cut(found.select("key", "id", mark, F.col("best.id").alias("centre"), F.col("best.mark").alias("centre_mark")))


ARRAYS = "id long, shingles binary"


def set_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the wanted sets, each once; a written table."""
    few = wanted.limit(PICKED + 1).count() <= PICKED
    ids = np.sort(wanted.toPandas()["id"].to_numpy(np.int64)) if few else np.zeros(0, np.int64)
    picked = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in slices(batches, "text"):
            out = {}
            for s in shingle_sets(b.column(0).to_pylist()):
                if len(s) and (i := set_id(s)) not in seen and (not few or _long(np.array([i]), picked.value)[0]):
                    seen.add(i)
                    out[i] = s.tobytes()
            if out:
                yield _batch(ARRAYS, list(out), list(out.values()))

    rows = docs.select(text_of(docs).alias("text")).mapInArrow(run, ARRAYS)
    if not few:
        rows = rows.join(wanted, "id", "left_semi")
    return cut(rows.dropDuplicates(["id"]))


def reaching_overlap(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs whose sets reach the required overlap: one set's shingles are probed by binary search in the other's array."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            keep = []
            for x, y in zip(left, right, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                both = int(_long(x, y).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])

    left = arrays.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = arrays.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _needs(a: Column, b: Column) -> Column:
    """In how many early lists two sets must meet to be linked, null where a list is not early for both.

    A link needs an overlap of T. Early lists of a set are its first n - T + k; behind them it has T - k shingles, so two
    linked sets meet in k of them. k grows with T, up to where early lists are all the merged ones of the larger set.
    """
    overlap = F.ceil((a["size"] + b["size"]) * PERCENT / (100 + PERCENT))
    merged = overlap - F.ceil(F.greatest(a["size"], b["size"]) * PERCENT / 100) + 1
    k = F.least(merged, 1 + F.floor(overlap / STEP))
    sizes = F.least(a["size"], b["size"]) * 100 >= F.greatest(a["size"], b["size"]) * PERCENT
    behind = F.least(a["size"] - a["place"], b["size"] - b["place"])
    return F.when(sizes & (behind >= overlap - k), k)


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; a component is named by its smallest doc_id.

    Texts with equal sets are one item. T-occurrence search: the lists of an item's rarest shingles are merged (dealt and
    sorted by shingle on the cluster), the T - 1 longest are skipped and probed by binary search in the arrays of the
    candidates. Candidates are compared as ``groups`` says, so that a group of thousands of near copies is not
    expanded into pairs.

    A null or empty text, or one without words, has an empty set and is linked with nothing; its component is itself. Rows
    that repeat a doc_id are documents of their own; null doc_ids are passed over in a component's smallest id unless it has
    no other. Sets are told apart by 64-bit hashes of shingles and of sets. An empty table gives no rows; further columns are
    ignored.
    """
    named = labelled_sets(docs)
    least = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    many = least.filter("members > 1").select("component", "component_id")
    return named.join(many, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def labelled_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (null for an empty set) of every row; a written table."""
    sets = cut(document_sets(docs))
    lists = shared_lists(short_list_postings(docs, long_lists(docs)))

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = cut(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
        return reaching_overlap(pairs, set_arrays(docs, wanted))

    labels = linked_groups(lists, _needs, verify).select(F.col("node").alias("set_id"), "component")
    named = sets.join(labels, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    return cut(named.select("doc_id", "text_hash", "n_shingles", "component"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those linked to another one, directly or over others: one row of each group stays.

    That with the smallest doc_id, then hash of the text, then hash of the row; a null doc_id comes last. Texts without words
    are linked with nothing and stay. Rows equal in all columns are interchangeable.
    """
    rows = labelled_sets(docs).filter("component is not null")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    first = rows.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("members"))
    first = small_side(cut(first.filter("members > 1").select("component", "first")))
    # a key of doc_id and text is of one component, so it stays or goes as a whole; rows may share the one that stays
    keys = rows.join(first, "component").groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("rows"), F.any_value(place == F.col("first")).alias("stays"))
    keys = cut(keys.filter("not stays or rows > 1"))
    told = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs["doc_id"].cast("long").alias("id"), F.xxhash64(text_of(docs)).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    out = told.join(keys, same, "left_anti").select("doc")
    again = cut(keys.filter("stays").select("doc_id", "text_hash"))
    if not again.isEmpty():
        one = told.join(small_side(again), same, "left_semi").groupBy("id", "hash").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
        out = out.unionByName(one.select("doc"))
    return out.select("doc.*")
