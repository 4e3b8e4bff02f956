"""Quality rules with a modified Kneser-Ney model of byte n-grams, counted over all documents of a language.

Nothing of the model is on the driver or in a broadcast. Blocks of neighbouring rows name their different n-grams once; the
model's log probabilities stand in sorted arrays, dealt by language and hash, which the requests are shuffled to; a block's
answers are written to the shared folder, and its rows are scored where they are read again.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import checkpoint_dir, cut
from .common import slices

#: Bytes of the longest n-gram, all 256 told apart; START, which no UTF-8 text has, stands before the text.
ORDER, BITS, START = 5, 8, 0xFF
#: Neighbouring rows of a file that ask for their n-grams together.
BLOCK_ROWS = 1 << 14
#: Arrays (a prime number) that the n-grams of a language are dealt to; blocks that one copy of an array answers.
RANGES, ASKING = 1021, 1 << 16
#: Blocks whose answers share a folder; n-grams that a task works on at a time.
TOGETHER, CHUNK = 16, 1 << 20
#: A language's bands lie so many distances from median to quartile beyond each quartile of its log perplexities (Kimber's
#: fences: Tukey's 1.5 interquartile ranges, taken for each side by its own half, as the sides are not alike).
SPREAD = 3.0
MIN_WORDS, MAX_REPEATS = 50, 50
MARKS = b"#*$%&|<>"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _windows(symbols: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that starts at each symbol, BITS a symbol."""
    s = symbols.astype(np.int64)
    code = np.zeros(len(s), dtype=np.int64)
    for k in range(order):
        code = (code[: len(s) - k] << BITS) | s[k:]
    return code


def _codes(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol."""
    return _windows(np.concatenate([np.full(order - 1, START), symbols]), order)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams that end at each byte of a text, at most CHUNK at a time."""
    s = np.concatenate([np.full(ORDER - 1, START, np.uint8), np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)])
    for at in range(0, len(s) - ORDER + 1, CHUNK):
        yield _windows(s[at: at + CHUNK + ORDER - 1], ORDER)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and block of every row: the same block for neighbouring rows of a file, on every scan.

    Rows that do not come from files are written to some first.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("lang"))

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.xxhash64("_metadata.file_path", F.expr(f"_metadata.row_index div {BLOCK_ROWS}")))

    try:
        return in_blocks(rows)
    except AnalysisException:
        return in_blocks(cut(rows))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, rising, with the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def block_counts(rows: DataFrame, limit: int = 1 << 22) -> DataFrame:
    """(block, lang, range, keys, n) of the n-grams of each block, keys rising; a task gives up what it holds when that grows large."""

    def out(held: dict[tuple[int, str], list]) -> Iterator[pa.RecordBatch]:
        for (block, lang), parts in held.items():
            keys, n = _summed(parts)
            ranges = keys % RANGES
            order = np.argsort(ranges, kind="stable")
            found, sizes = np.unique(ranges, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * len(found), pa.int64()), pa.array([lang] * len(found)), pa.array(found, pa.int32()),
                _lists(keys[order], sizes, pa.int64()), _lists(n[order], sizes, pa.int64())], ["block", "lang", "range", "keys", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}
        for b in slices(batches, "text"):
            fresh: dict[tuple[int, str], list[np.ndarray]] = {}
            blocks = b.column(2).to_pylist()
            for text, lang, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), blocks, strict=True):
                for piece in _pieces(text):
                    fresh.setdefault((block, lang), []).append(piece)
            for at, found in fresh.items():
                held.setdefault(at, []).append(np.unique(np.concatenate(found), return_counts=True))
            if sum(len(k) for parts in held.values() for k, _ in parts) > limit:
                held = {at: [_summed(parts)] for at, parts in held.items()}
            full = sum(len(k) for parts in held.values() for k, _ in parts) > limit // 2
            done = {at: parts for at, parts in held.items() if full or at[0] != blocks[-1]}
            yield from out(done)
            held = {at: parts for at, parts in held.items() if at not in done}
        yield from out(held)

    return rows.select("text", "lang", "block").mapInArrow(run, "block long, lang string, range int, keys array<bigint>, n array<bigint>")


def estimate(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, size, key, log_p, log_backoff) of the n-grams of each size, by modified Kneser-Ney smoothing.

    ``counts``: (lang, key, n) of the longest n-grams. Shorter ones count the distinct symbols before them. Three discounts
    of each language and size come from how many n-grams have counts 1 to 4; what they free is shared by the shorter
    n-grams. ``log_backoff`` of an n-gram is the weight of shorter ones after it, null where nothing follows it; size 0 is the empty one.
    """
    levels = {order: cut(counts.select("lang", "key", "n"))}
    for size in range(order - 1, 0, -1):
        tail = F.col("key").bitwiseAND((1 << BITS * size) - 1)
        levels[size] = cut(levels[size + 1].groupBy("lang", tail.alias("key")).agg(F.count("*").alias("n")))
    below, backoffs = None, {}
    for size in range(1, order + 1):
        grams = levels[size]
        ones = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"c{k}") for k in (1, 2, 3, 4)]
        rate = F.try_divide("c1", F.col("c1") + 2 * F.col("c2"))
        cuts = [
            F.coalesce(k - (k + 1) * rate * F.try_divide(f"c{k + 1}", f"c{k}"), F.lit(k / 2)).alias(f"d{k}")
            for k in (1, 2, 3)
        ]
        discounts = grams.groupBy("lang").agg(*ones).select("lang", *cuts)
        discounts = discounts.select("lang", *(F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), f"d{k}")).alias(f"d{k}") for k in (1, 2, 3)))
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        told = grams.join(F.broadcast(discounts), "lang").withColumn("taken", taken)
        told = told.withColumn("context", F.shiftright("key", BITS))
        rest = told.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("taken").alias("freed"))
        p = told.join(rest, ["lang", "context"])
        share = F.col("freed") / F.col("total")
        if below is None:
            p = p.withColumn("p", (F.col("n") - F.col("taken")) / F.col("total") + share / (1 << BITS))
        else:
            p = p.withColumn("tail", F.col("key").bitwiseAND((1 << BITS * (size - 1)) - 1))
            p = p.join(below.select("lang", F.col("key").alias("tail"), F.col("p").alias("q")), ["lang", "tail"])
            p = p.withColumn("p", (F.col("n") - F.col("taken")) / F.col("total") + share * F.col("q"))
        below = cut(p.select("lang", "key", "p"))
        backoffs[size - 1] = cut(rest.select("lang", F.col("context").alias("key"), F.ln(F.col("freed") / F.col("total")).alias("log_backoff")))
        levels[size] = below
    out = backoffs[0].select("lang", F.lit(0).alias("size"), "key", F.lit(None).cast("double").alias("log_p"), "log_backoff")
    for size in range(1, order + 1):
        part = levels[size].select("lang", F.lit(size).alias("size"), "key", F.ln("p").alias("log_p"))
        if size < order:
            part = part.join(backoffs[size], ["lang", "key"], "full").withColumn("size", F.lit(size))
        else:
            part = part.withColumn("log_backoff", F.lit(None).cast("double"))
        part = part.select("lang", "size", "key", "log_p", "log_backoff")
        out = out.unionByName(part)
    return cut(out)


def answers(model: DataFrame, blocks: DataFrame, asking: int) -> DataFrame:
    """(block, lang, keys, logs): the log probabilities of each block's n-grams.

    ``model``: (lang, key, log_p) of the longest n-grams. It becomes sorted arrays; an array goes before the requests for it
    through one task, which finds them by binary search. ``asking`` blocks share out over copies of the arrays, so that a
    language of any share of the rows is many tasks.
    """
    copies = max(1, math.ceil(asking / ASKING))
    place = ["lang", "range", "copy"]
    sorted_rows = F.array_sort(F.collect_list(F.struct("key", F.col("log_p").cast("float").alias("log_p"))))
    arrays = model.groupBy("lang", F.pmod("key", F.lit(RANGES)).cast("int").alias("range")).agg(sorted_rows.alias("a"))
    arrays = arrays.select(
        "lang", "range", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(None).cast("long").alias("block"),
        F.col("a.key").alias("keys"), F.col("a.log_p").alias("logs"))
    asked = blocks.select(
        "lang", "range", F.pmod("block", F.lit(copies)).cast("int").alias("copy"), "block", "keys", F.lit(None).cast("array<float>").alias("logs"))
    both = arrays.unionByName(asked).repartition(*place).sortWithinPartitions(*place, F.col("block").asc_nulls_first())

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, logs = None, np.zeros(0, np.int64), np.zeros(0, np.float32)
        for b in batches:
            langs, ranges, copy, block, lists, values = b.columns
            found, rows = [], []
            for i, where in enumerate(zip(langs.to_pylist(), ranges.to_pylist(), copy.to_pylist(), strict=True)):
                own = lists[i].values.to_numpy()
                if not block[i].is_valid:
                    at, keys, logs = where, own, values[i].values.to_numpy()
                    continue
                if at != where or not np.array_equal(keys[(spot := np.minimum(np.searchsorted(keys, own), len(keys) - 1))], own):
                    raise ValueError(f"n-grams of {where} that were not counted")
                rows.append(i)
                found.append(logs[spot])
            if rows:
                sizes, kept = [len(f) for f in found], pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [block.take(kept), langs.take(kept), lists.take(kept), _lists(np.concatenate(found), sizes, pa.float32())],
                    ["block", "lang", "keys", "logs"])

    return both.mapInArrow(search, "block long, lang string, keys array<bigint>, logs array<float>")


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; words are runs without ASCII white space.

    Words and then windows of two and three of them become numbers, so that a long text needs no object for each.
    """
    raw = text.encode()
    inside = raw.translate(None, b" \t\n\x0b\x0c\r")
    chars = len(inside) if inside.isascii() else len(inside.decode())
    marks = len(inside) - len(inside.translate(None, MARKS))
    lines = Counter(raw.split(b"\n"))
    again = sum(n - 1 for line, n in lines.items() if n > 1 and line.split())
    seen: dict[bytes, int] = {}
    words = np.fromiter((seen.setdefault(m.group(), len(seen)) for m in WORD.finditer(raw)), np.int64)
    repeated = 0
    if len(words) > 3:
        twos = np.unique(words[:-1] * len(seen) + words[1:], return_inverse=True)[1]
        _, threes, n = np.unique(twos[:-1] * len(seen) + words[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(n[threes] > 1)
        if len(starts):
            repeated = int(np.minimum(np.diff(starts), 3).sum()) + 3
    return len(words), chars, marks, again, repeated


def log_sums(texts: list[tuple[int, str]], keys: np.ndarray, logs: np.ndarray) -> Counter:
    """The sum of the log probabilities of each numbered text, CHUNK n-grams at a time."""
    out: Counter = Counter()
    held, owners, size = [], [], 0

    def settle() -> None:
        sums = np.bincount(np.repeat(np.arange(len(held)), [len(h) for h in held]), weights=logs[np.searchsorted(keys, np.concatenate(held))])
        for i, total in zip(owners, sums, strict=True):
            out[i] += float(total)

    for i, text in texts:
        for piece in _pieces(text):
            held.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= CHUNK:
                settle()
                held, owners, size = [], [], 0
    if held:
        settle()
    return out


SCORED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def score(rows: DataFrame, folder: str, parts: int) -> DataFrame:
    """SCORED of every row of ``_rows``; ``folder`` holds the answers by ``part``, a block's number modulo ``parts``."""

    def load(block: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        store, name = fs.FileSystem.from_uri(folder)
        found = pq.read_table(
            f"{name}/part={block % parts}", columns=["lang", "keys", "logs"], filters=[("block", "=", block)],
            filesystem=store, partitioning=None).combine_chunks()
        out = {}
        for lang in set(found.column("lang").to_pylist()):
            own = found.filter(pa.compute.equal(found.column("lang"), lang))
            keys, logs = (own.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "logs"))
            order = np.argsort(keys)
            out[lang] = keys[order], logs[order].astype(np.float64)
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCORED.split(", ")]
        loaded, model = None, {}
        for b in slices(batches, "text"):
            ids, texts, langs, blocks = (c.to_pylist() for c in b.columns)
            base = [base_counts(t) for t in texts]
            logs: list[float | None] = [None] * len(texts)
            groups: dict[int, dict[str, list]] = {}
            for i, (t, lang, block) in enumerate(zip(texts, langs, blocks, strict=True)):
                if t:
                    groups.setdefault(block, {}).setdefault(lang, []).append((i, t))
            for block, by_lang in groups.items():
                if block != loaded:
                    loaded, model = block, load(block)
                for lang, some in by_lang.items():
                    for i, total in log_sums(some, *model[lang]).items():
                        logs[i] = -total / len(texts[i])
            cols = [pa.array(ids, pa.int64()), pa.array(langs), *(pa.array(c, pa.int64()) for c in zip(*base, strict=True)), pa.array(logs, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.select("doc_id", "text", "lang", "block").mapInArrow(run, SCORED)


def quality_rules(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, perplexity, kept of every row.

    The model of a language is counted over all texts of documents of that lang, by bytes, so that all characters of all
    scripts are told apart. ``perplexity`` is that of a text's characters; a text is kept if it passes the base rules and lies within its language's bands, which come from the median
    and the quartiles over all its different perplexities of texts that pass them, so that copies do not narrow them.

    A null text has no words and fails; a null lang is a language of its own with those named by the empty text. A language with
    one text keeps it, as its quartiles are its value. Rows are independent but for the counts: repeated rows count as often as
    they stand and get equal results. A long text's n-grams are worked on CHUNK at a time; a task holds the text itself a few times and the
    different n-grams of a block. An empty table gives no rows; further columns are ignored.

    The shared folder is opened by executors as any file system that pyarrow knows.
    """
    rows = _rows(docs)
    blocks = cut(block_counts(rows))
    grams = blocks.select("lang", F.explode(F.arrays_zip("keys", "n")).alias("g"))
    grams = grams.groupBy("lang", F.col("g.keys").alias("key")).agg(F.sum("g.n").alias("n"))
    model = estimate(grams).filter(F.col("size") == ORDER).select("lang", "key", "log_p")
    asking = blocks.select("block").distinct().count()
    parts = max(1, math.ceil(asking / TOGETHER))
    folder = f"{checkpoint_dir(docs.sparkSession)}/ngrams-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    told = answers(model, blocks, asking).withColumn("part", F.pmod("block", F.lit(parts)))
    told = told.repartition("part").sortWithinPartitions("part", "block", "lang")
    told.write.partitionBy("part").option("parquet.block.size", str(8 << 20)).parquet(folder)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words"))
    scored = cut(score(rows, folder, parts).withColumn("base_failed", failed))
    passed = scored.filter("not base_failed").select("lang", "log_perplexity").distinct()
    quarters = passed.groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 100_000).alias("q"))
    low, middle, high = (F.col("q")[i] for i in range(3))
    bands = quarters.select("lang", (low - spread * (middle - low)).alias("lower"), (high + spread * (high - middle)).alias("upper"))
    judged = scored.join(F.broadcast(cut(bands)), "lang", "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.exp("log_perplexity").alias("perplexity"), (~F.col("base_failed") & inside).alias("kept"))
