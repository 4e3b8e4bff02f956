"""Alignment of the tokens that two tokenizers cut the same text into, each distinct text aligned once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut
from ..skew import join_one
from .common import slices, text_of
from .packing import encoder

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose pairs are looked up together.
BLOCK_BYTES = 4 << 20
#: Texts are encoded in parts of about so many code points, cut where neither vocabulary joins characters.
PART_CHARS = 1 << 16
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

#: Before a space between two other characters both tokenizers start a new token.
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


@dataclass(frozen=True)
class Vocabulary:
    """Encodes a text that starts with a space; ``tokens`` has the bytes of each id."""

    encode: Callable[[str], list[int]]
    tokens: list[bytes]


def byte_vocabulary(path: str) -> Vocabulary:
    """The byte-level vocabulary; its entries spell bytes by printable characters."""
    from tokenizers import Tokenizer

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    by_id = {i: t for t, i in Tokenizer.from_file(path).get_vocab().items()}
    spelled = [by_id.get(i, "") for i in range(max(by_id) + 1)]
    tokens = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in spelled]
    return Vocabulary(encoder(path, added_as_text=True), tokens)


def piece_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of pieces, which puts a space before a text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Vocabulary(lambda text: model.encode(text[1:]), tokens)


def parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``limit`` code points, each from a space between other characters on."""
    at = 0
    while len(text) - at > limit and (found := _CUT.search(text, at + limit)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def encoded(text: str, vocabulary: Vocabulary, whole: bytes) -> np.ndarray | None:
    """The ids of a text that starts with a space, or None if their bytes are not ``whole``."""
    ids = np.concatenate([np.array(vocabulary.encode(p), dtype=np.int64) for p in parts(text)])
    return ids if b"".join(map(vocabulary.tokens.__getitem__, ids.tolist())) == whole else None


class Aligner:
    """Aligns the tokens of many texts at once: their bytes are put in a row, where each text's end is one of both sides."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.sizes = [np.array([len(t) for t in v.tokens]) for v in (a, b)]
        shown = [[f"{i}{sep}".encode() for i in range(len(v.tokens))] for v, seps in ((a, ",|"), (b, ",;")) for sep in seps]
        self.shown = np.array([x for part in shown for x in part])
        self.starts = np.cumsum([0] + [len(x) for x in shown])

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, codes, times) of each text.

        A code is a linked pair, ``a * len(b's vocabulary) + b``; codes are distinct and sorted, times says how often each is linked.
        """
        ids_a, ids_b = [], []
        for text in texts:
            whole = b" " + text.encode()
            x = encoded(" " + text, self.a, whole) if text else None
            y = encoded(" " + text, self.b, whole) if x is not None else None
            ids_a.append(x if y is not None else x[:0] if x is not None else np.zeros(0, np.int64))
            ids_b.append(y if y is not None else np.zeros(0, np.int64))
        n_a, n_b = np.array([*map(len, ids_a)], dtype=np.int64), np.array([*map(len, ids_b)], dtype=np.int64)
        a, b = np.concatenate([*ids_a, np.zeros(0, np.int64)]), np.concatenate([*ids_b, np.zeros(0, np.int64)])
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        cuts, seen = np.unique(np.concatenate([ends_a, ends_b]), return_counts=True)
        both = cuts[seen == 2]
        # a stretch between two neighbouring cuts lies in one token of each side, and two tokens that overlap share one stretch
        codes = a[np.searchsorted(ends_a, cuts)] * len(self.b.tokens) + b[np.searchsorted(ends_b, cuts)]
        last = np.concatenate([[0], ends_a])[np.cumsum(n_a)]  # byte at which each text ends
        at_cuts = np.concatenate([[0], np.searchsorted(cuts, last, "right")])
        at_both = np.concatenate([[0], np.searchsorted(both, last, "right")])
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        close_a, close_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
        label = np.concatenate([a + self.starts[close_a.astype(int)], b + self.starts[2 + close_b.astype(int)]])[order]
        at_tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])
        for i in range(len(texts)):
            lo, hi = at_tokens[i], at_tokens[i + 1]
            groups = self.shown[label[lo:hi]].tobytes().replace(b"\0", b"")[:-1]
            found, times = np.unique(codes[at_cuts[i]:at_cuts[i + 1]], return_counts=True)
            yield (
                int(n_a[i]), int(n_b[i]), int(at_both[i + 1] - at_both[i]), int(at_cuts[i + 1] - at_cuts[i]),
                hashlib.sha256(groups).hexdigest() if hi > lo else "", found, times)


_aligners: dict = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_vocabulary(byte_path), piece_vocabulary(piece_path))
    return _aligners[byte_path, piece_path]


ALIGNED = (
    "name binary, copies long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "codes array<long>, times array<int>")


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """ALIGNED, one row for each distinct text; a written table.

    Rows are dealt by their full text and counted on the way, so copies, however many, reach a task once. ``name`` is the
    text's SHA-256, by which the measures find the documents again; ``block`` numbers BLOCK_BYTES of a task's texts.
    """
    once = docs.select(text_of(docs).alias("text")).groupBy("text").agg(F.count("*").alias("copies"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part, done = aligner(byte_path, piece_path), TaskContext.get().partitionId(), 0
        for b in slices(batches, "text"):
            texts = b.column(1).to_pylist()
            rows = list(zip(*work.align(texts), strict=True))
            codes, times = (pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(x) for x in col])]).astype(np.int32), pa.array(np.concatenate(col), kind))
                for col, kind in ((rows[5], pa.int64()), (rows[6], pa.int32())))
            block = pa.array(np.full(len(texts), (part << 32) + done // BLOCK_BYTES))
            done += sum(map(len, texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), block, *map(pa.array, rows[:5]), codes, times],
                [c.split()[0] for c in ALIGNED.split(", ")])

    named = once.select(F.unhex(F.sha2("text", 256)).alias("name"), "text", "copies")
    return cut(named.mapInArrow(run, ALIGNED))


PAIRS = "a long, b long, documents long, best boolean"


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(a, b, documents, best): in how many documents two ids are linked, and whether no other b has more with this a."""
    return _counted(_block_pairs(aligned), b_size).select(
        F.expr(f"code div {b_size}").alias("a"), (F.col("code") % b_size).alias("b"), "documents", "best")


def _block_pairs(aligned: DataFrame) -> DataFrame:
    """(block, code, documents): each linked pair once a block, with the documents of the block that hold it."""
    return aligned.select("block", "copies", F.explode("codes").alias("code")).groupBy("block", "code").agg(
        F.sum("copies").alias("documents"))


def _counted(pairs: DataFrame, b_size: int) -> DataFrame:
    # a has at most as many partners as b's vocabulary has entries, which bounds a window
    counts = pairs.groupBy("code").agg(F.sum("documents").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.expr(f"code div {b_size}")))
    return counts.withColumn("best", F.col("documents") == most)


def text_measures(aligned: DataFrame, b_size: int) -> DataFrame:
    """name and MEASURES of each distinct text.

    A block's distinct pairs go to the counts and come back as that block's part of them; the block's links are added up with it.
    Neither the counts nor the links of a text are ever in one place as a whole, and no pair is in more rows than blocks.
    """
    pairs = cut(_block_pairs(aligned))
    known = pairs.select("block", "code").join(_counted(pairs, b_size), "code")

    def add_up(texts: pa.Table, counts: pa.Table) -> pa.Table:
        codes, documents = counts["code"].to_numpy(), counts["documents"].to_numpy()
        order = np.argsort(codes)
        codes, documents, best = codes[order], documents[order], counts["best"].to_numpy()[order]
        n_best, count_sum = [], []
        for found, times in zip(texts["codes"], texts["times"], strict=True):
            at = np.searchsorted(codes, found.values.to_numpy())
            times = times.values.to_numpy()
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * documents[at]).sum()))
        kept = texts.select(["name", *(c for c in MEASURES if c in texts.column_names)])
        for name, col in (("n_best", n_best), ("count_sum", count_sum)):
            kept = kept.append_column(name, pa.array(col, pa.int64()))
        return kept.select(["name", *MEASURES])

    kinds = {"groups_sha256": "string"}
    schema = "name binary, " + ", ".join(f"{c} {kinds.get(c, 'long')}" for c in MEASURES)
    texts = aligned.drop("copies")
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(add_up, schema)


def align_tokenizers(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id and MEASURES of every row: how the tokens of its text under two vocabularies lie over each other.

    Both tokenizers see a space and the text. Groups end where tokens of both sides end; two tokens whose bytes overlap are
    linked; a linked pair of ids counts the documents that hold it anywhere in the table, copies included. ``n_best`` are the
    links whose pair has the highest count of its a id (ties included), ``count_sum`` adds the counts up over links.

    Texts that are null, empty, or that a vocabulary does not give back byte for byte have no tokens: zeros and an empty
    groups_sha256. Strings of special tokens are plain text. Very long texts are encoded in parts; memory follows their
    length and the longest stretch without a single space. Rows that repeat a doc_id or have none are documents of their own.
    An empty table gives no rows; further columns are ignored.
    """
    byte_path = byte_path or public_tokenizers.path(BYTE_FILE)
    piece_path = piece_path or public_tokenizers.path(PIECE_FILE)
    aligned = aligned_texts(docs, byte_path, piece_path)
    measures = cut(text_measures(aligned, len(aligner(byte_path, piece_path).b.tokens)))
    named = cut(docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(docs), 256)).alias("name")))
    return join_one(named, measures, "name", "inner").select("doc_id", *MEASURES)
