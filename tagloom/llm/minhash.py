"""MinHash near-duplicates: a multi-index Hamming join of b-bit signatures.

Items that share a key stand in a list. Each list's centre is compared with its other members first, which joins the large
groups; what is still apart then meets only where an exact bound leaves a link possible (``possible_pairs``), so a group of
thousands of near copies costs about one comparison a member, and no pair is left out that could be linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut
from ..operators.graph import connected_components
from ..skew import join_one
from .common import BROADCAST_ROWS, slices, small_side, text_of
from .jaccard import shingle_sets

WORDS = 2
#: Two sets are linked when 100 * intersection >= PERCENT * union.
PERCENT = 80


@dataclass(frozen=True)
class Scheme:
    """Signatures of ``chunks * width`` symbols, the ``bits`` lowest bits of a minimum each.

    Two signatures that differ in at most ``distance`` symbols have a chunk with at most ``errors`` of them (pigeonhole). The
    keys of a chunk each leave out ``errors`` of its symbols, so they enumerate the errors allowed in it, and the two share a
    key. With the defaults that is 25 of 65 symbols; sets at a similarity of 0.8 differ in 13, in more than 25 once in 10,000
    times, and unrelated sets share a key when four symbols in a row of five agree by chance.
    """

    chunks: int = 13
    width: int = 5
    errors: int = 1
    bits: int = 16

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signatures(sets: Sequence[np.ndarray], scheme: Scheme) -> np.ndarray:
    """A row of symbols (uint16) for each set of 64-bit hashes; no set is empty."""
    if not sets:
        return np.zeros((0, scheme.symbols), np.uint16)
    rng = np.random.default_rng(11)
    factors = rng.integers(1, 1 << 63, scheme.symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = rng.integers(0, 1 << 63, scheme.symbols, dtype=np.uint64)
    hashes = np.concatenate(sets).view(np.uint64)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), scheme.symbols), np.uint16)
    for k in range(scheme.symbols):
        least = np.minimum.reduceat(hashes * factors[k] + terms[k], starts)
        out[:, k] = _spread(least) & np.uint64((1 << scheme.bits) - 1)
    return out


def chunk_keys(symbols: np.ndarray, scheme: Scheme) -> np.ndarray:
    """A row of keys (int64) for each signature: of every chunk, one for each way to leave out ``errors`` symbols."""
    keys = []
    for c in range(scheme.chunks):
        chunk = symbols[:, c * scheme.width: (c + 1) * scheme.width].astype(np.uint64)
        for left_out in combinations(range(scheme.width), scheme.errors):
            key = np.full(len(chunk), 1 + len(keys), np.uint64)
            for j in set(range(scheme.width)) - set(left_out):
                key = _spread(key * _ODD + chunk[:, j])
            keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


SETS = "doc_id long, text_hash long, n_shingles long, set_id binary, signature binary"


def document_sets(docs: DataFrame, scheme: Scheme, words: int) -> DataFrame:
    """SETS of every row; set_id (128 bits of the shingles' hashes) and signature are null for an empty set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = list(shingle_sets(b.column(2).to_pylist(), words))
            made = iter(signatures([s for s in sets if len(s)], scheme))
            cols = [
                b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_name(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(made).tobytes() if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in SETS.split(", ")])

    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, SETS)


def _name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def postings(items: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, id, size): each item under all keys of its signature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            symbols = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint16).reshape(-1, scheme.symbols)
            keys = chunk_keys(symbols, scheme)
            at = np.repeat(np.arange(b.num_rows), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), b.column(0).take(at), b.column(1).take(at)], ["key", "id", "size"])

    return items.select("id", "size", "signature").mapInArrow(run, "key long, id binary, size long")


def looked_up(rows: DataFrame, side: DataFrame, key: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with the row of ``side``, a written table, that has their key; broadcast if it was counted and is small."""
    if side.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(side), key)
    return join_one(rows, side, key, "inner")


def shared_lists(items: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, size, n, centre, centre_size) of the lists of n items, two or more; a written table.

    The centre of a list is the item with most fellows over all its lists: in a group of copies with small changes, that which
    they were made from. Lists are counted on the way and never gathered, however long one is.
    """
    rows = postings(items, scheme)
    shared = cut(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    lists = cut(rows.join(small_side(shared), "key"))
    fellows = cut(lists.groupBy("id").agg(F.sum("n").alias("fellows")))
    best = F.max(F.struct("fellows", "id", "size")).alias("best")
    centres = cut(looked_up(lists, fellows, "id").groupBy("key").agg(best).select("key", "best.id", "best.size").toDF("key", "centre", "centre_size"))
    found = looked_up(lists, centres, "key").filter(F.col("id") != F.col("centre"))
    return cut(found.groupBy("centre", "id").agg(F.first("size").alias("size"), F.first("centre_size").alias("centre_size"), F.max("n").alias("n")))


def near_signatures(pairs: DataFrame, items: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``scheme.distance`` symbols; a written table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, scheme.symbols) for i in (2, 3))
            keep = pa.array((x != y).sum(axis=1) <= scheme.distance)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    for name in ("a", "b"):
        side = items.select(F.col("id").alias(name), F.col("signature").alias(f"{name}_signature"))
        pairs = looked_up(pairs, side, name, BROADCAST_ROWS // 8)
    return cut(pairs.select("a", "b", "a_signature", "b_signature").mapInArrow(run, "a binary, b binary"))


ARRAYS = "id binary, shingles binary"


def set_arrays(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the items named by a text's hash in ``wanted``, each once; a written table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in slices(batches, "text"):
            new = []
            for text_hash, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text_hash not in seen:
                    seen.add(text_hash)
                    new.append(text)
            sets = [s for s in shingle_sets(new, words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_name(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    rows = docs.select(F.xxhash64(text_of(docs)).alias("text_hash"), text_of(docs).alias("text"))
    return cut(rows.join(small_side(wanted), "text_hash", "left_semi").mapInArrow(run, ARRAYS).dropDuplicates(["id"]))


def confirmed(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    for name in ("a", "b"):
        pairs = pairs.join(arrays.select(F.col("id").alias(name), F.col("shingles").alias(f"{name}_shingles")), name)
    return pairs.select("a", "b", "a_shingles", "b_shingles").mapInArrow(run, "a binary, b binary")


def new_shingles(members: DataFrame, arrays: DataFrame) -> DataFrame:
    """Members (centre, id, ...) with ``overlap``, the shingles shared with the centre, and ``novel``, the others; a written table."""
    kept = members.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            overlap, novel = [], []
            for own, centre in zip(batch.column(len(kept)), batch.column(len(kept) + 1), strict=True):
                own, centre = np.frombuffer(own.as_buffer(), np.int64), np.frombuffer(centre.as_buffer(), np.int64)
                known = centre[np.minimum(np.searchsorted(centre, own), len(centre) - 1)] == own
                overlap.append(int(known.sum()))
                novel.append(own[~known])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(overlap, pa.int64()), pa.array(novel, pa.list_(pa.int64()))], [*kept, "overlap", "novel"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema) + ", overlap long, novel array<long>"
    both = members.join(arrays.withColumnRenamed("shingles", "own"), "id").join(
        arrays.select(F.col("id").alias("centre"), F.col("shingles").alias("its")), "centre")
    return cut(both.select(*kept, "own", "its").mapInArrow(run, schema))


def sketches(items: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, word_0, ...): the four lowest bits of each symbol of an item's signature, sixteen symbols to a number."""
    words = -(-scheme.symbols // 16)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            symbols = np.zeros((b.num_rows, 16 * words), np.uint64)
            raw = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16)
            symbols[:, :scheme.symbols] = raw.reshape(-1, scheme.symbols) & 15
            packed = (symbols.reshape(-1, words, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(np.ascontiguousarray(packed[:, i])) for i in range(words))], ["id", *(f"word_{i}" for i in range(words))])

    return items.select("id", "signature").mapInArrow(run, "id binary, " + ", ".join(f"word_{i} long" for i in range(words)))


def _differing(x: Column) -> Column:
    """How many of the sixteen groups of four bits are not zero."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def possible_pairs(told: DataFrame, percent: int, distance: int) -> DataFrame:
    """The pairs (a, b) with one centre but different labels that may be linked; ``told``: new_shingles with label, apart.

    ``apart`` says that a member's label is not its centre's, so that it is not linked with the centre; one of a pair is. For a
    link x and y need an overlap of T shingles, at least 0.8 of either, and they share at most overlap(x), or overlap(y), of
    the centre's: at least T - overlap more must be new to both. In a common order, the rarest under this centre first, the
    first new shingle that they share has at least T - overlap - 1 behind it on either side; only such meetings count. Where
    a y is so small that T - overlap(x) is not positive, sizes alone decide. Pairs whose sketches (``word_`` columns) differ in more than ``distance`` symbols are left out as they are met.
    """
    own = ["centre", "id", *(c for c in told.columns if c not in ("centre", "id", "novel"))]
    new = told.select(*own, F.size("novel").alias("new"), F.explode("novel").alias("s"))
    often = new.groupBy("centre", "s").agg(F.count("*").alias("often"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    rare = Window.partitionBy("centre", "id").orderBy("often", "s")
    early = new.join(often, ["centre", "s"]).withColumn("behind", F.col("new") - F.row_number().over(rare))
    beyond = F.greatest(F.lit(1), F.ceil(F.col("size") * percent / 100) - F.col("overlap"))
    early = cut(early.filter((F.col("behind") + 1 >= beyond) & (F.col("lo") < F.col("hi"))).drop("new", "often", "lo", "hi"))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumnsRenamed({"id": name} | {c: f"{name}_{c}" for c in [*own[2:], "behind"] if c in rows.columns})

    x, y = side(early.filter("apart"), "x"), side(early, "y")
    needs = F.ceil((F.col("x_size") + F.col("y_size")) * percent / (100 + percent)) - F.col("x_overlap")
    alike = F.least("x_size", "y_size") * 100 >= F.greatest("x_size", "y_size") * percent
    differ = (F.col("x_label") != F.col("y_label")) & (~F.col("y_apart") | (F.col("x") < F.col("y"))) & alike
    words = [c for c in told.columns if c.startswith("word_")]
    near = sum((_differing(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in words), F.lit(0)) <= distance
    enough = 1 + F.least("x_behind", "y_behind") >= F.ceil((F.col("x_size") + F.col("y_size")) * percent / (100 + percent)) - F.least("x_overlap", "y_overlap")
    met = x.join(y, ["centre", "s"]).filter(differ & enough & near).select("x", "y")
    inside = side(told.filter("apart").filter(F.col("overlap") * 100 >= F.col("size") * percent).select(*own), "x")
    inside = inside.join(side(told.select(*own), "y"), "centre").filter(differ & near & (needs <= 0)).select("x", "y")
    return met.unionByName(inside).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def linked_items(items: DataFrame, docs: DataFrame, words: int, percent: int, scheme: Scheme) -> DataFrame:
    """(node, component) of the items that have a link; a component is named by its least item."""
    lists = shared_lists(items, scheme)

    def arrays_of(ids: DataFrame) -> DataFrame:
        return set_arrays(docs, cut(items.join(ids.distinct(), "id", "left_semi").select("text_hash")), words)

    def linked(pairs: DataFrame) -> DataFrame:
        near = near_signatures(pairs, items, scheme)
        return cut(confirmed(near, arrays_of(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id")))), percent))

    alike = F.least("size", "centre_size") * 100 >= F.greatest("size", "centre_size") * percent
    links = linked(lists.filter(alike).select(F.col("centre").alias("a"), F.col("id").alias("b")))
    labels = cut(connected_components(links, "a", "b"))
    own, its = (labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label")) for c in ("id", "centre"))
    named = lists.filter("n > 2").select("centre", "id", "size").join(own, "id", "left").join(its, "centre", "left")
    label = F.coalesce("id_label", "id")
    named = cut(named.select("centre", "id", "size", label.alias("label"), (label != F.coalesce("centre_label", "centre")).alias("apart")))
    mixed = cut(named.groupBy("centre").agg(F.max("apart").alias("mixed"), F.count("*").alias("n")).filter("mixed and n > 1").select("centre"))
    members = cut(named.join(mixed, "centre", "left_semi").join(sketches(items, scheme), "id"))
    arrays = arrays_of(members.select("id").unionByName(mixed.select(F.col("centre").alias("id"))))
    rest = cut(possible_pairs(new_shingles(members, arrays), percent, scheme.distance))
    return cut(connected_components(links.unionByName(linked(rest)), "a", "b"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; a component is named by its smallest doc_id, whose row is kept.

    Documents with equal sets are one item. Items whose signatures are within ``scheme.distance`` of each other share a key, and
    no such pair is lost: those that meet under a key are compared by signature, then on their full sets.

    A null or empty text, or one without words, has an empty set and is linked with nothing; its component is itself. Rows that
    repeat a doc_id are documents of their own. A null doc_id is passed over in a component's smallest id unless it has no
    other, and then kept. Memory follows the longest text. An empty table gives no rows; further columns are ignored.
    """
    sets = cut(document_sets(docs, scheme, words))
    items = cut(sets.filter("set_id is not null").groupBy(F.col("set_id").alias("id")).agg(
        F.first("n_shingles").alias("size"), F.first("signature").alias("signature"), F.min("text_hash").alias("text_hash")))

    labels = linked_items(items, docs, words, percent, scheme).withColumnRenamed("node", "set_id")
    named = join_one(sets.select("doc_id", "n_shingles", "set_id"), labels, "set_id")
    named = cut(named.select("doc_id", "n_shingles", F.coalesce("component", "set_id").alias("component")))
    least = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    many = cut(least.filter("members > 1").select("component", "component_id"))
    component_id = F.coalesce("component_id", "doc_id")
    return join_one(named, many, "component").select(
        "doc_id", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))
