"""Quality by compression: zstandard dictionaries of good and of bad text, and a calibrated difference of the sizes they give."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Texts are compressed in blocks of so many bytes, so that a dictionary matters throughout a long text.
BLOCK = 512
LEVEL, DICTIONARY = 3, 1 << 16
#: Labelled rows read for the fit, of each label, at most, and the characters read of each, from a place by hash.
FIT_ROWS, FIT_CHARS = 1200, 4096
THRESHOLD = 0.3


@dataclass
class Model:
    good: bytes
    bad: bytes
    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """With the good, the bad and no dictionary; a frame has no header fields that do not depend on the text."""
        plain = dict(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
        made = []
        for raw in (self.good, self.bad):
            shared = zstandard.ZstdCompressionDict(raw)
            shared.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=shared, **plain))
        return [*made, zstandard.ZstdCompressor(**plain)]

    def score(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.middle) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -35, 35)))


def features(text: str, compressors: list[zstandard.ZstdCompressor]) -> tuple[float, float]:
    """(bytes the bad dictionary takes more than the good one, bytes without one), both for each byte of the text."""
    raw, sizes = text.encode(), [0, 0, 0]
    for i in range(0, len(raw), BLOCK):
        part = raw[i: i + BLOCK]
        for k, c in enumerate(compressors):
            sizes[k] += len(c.compress(part))
    n = max(1, len(raw))
    return (sizes[1] - sizes[0]) / n, sizes[2] / n


def _dictionary(texts: list[str]) -> bytes:
    parts = [p for t in texts for raw in [t.encode()] for p in (raw[i: i + BLOCK] for i in range(0, len(raw), BLOCK))]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: all of it
        return b"".join(parts)[-DICTIONARY:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + keep, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(samples: list[tuple[str, int]], totals: dict[int, int]) -> Model | None:
    """A model from (text, label); every other row builds the dictionaries, the rest calibrates. None without both labels.

    ``totals``: labelled rows of each label; scores are probabilities at these shares.
    """
    samples = sorted(s for s in samples if s[0])
    halves = [[s for s in samples if s[1] == label] for label in (1, 0)]
    if min(map(len, halves)) < 4:
        return None
    good, bad = (_dictionary([t for t, _ in half[::2]]) for half in halves)
    model = Model(good, bad, np.zeros(2), np.ones(2), np.zeros(3))
    made = model.compressors()
    rest = [s for half in halves for s in half[1::2]]
    x, y = np.array([features(t, made) for t, _ in rest]), np.array([label for _, label in rest], dtype=float)
    model.middle, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    shares = {label: totals[label] / max(1, (y == label).sum()) for label in (0, 1)}
    weight = np.where(y == 1, shares[1], shares[0])
    model.weights = _logistic((x - model.middle) / model.scale, y, weight * len(y) / weight.sum())
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = FIT_ROWS) -> Model | None:
    """Fit on the labelled rows where ``learn``, a condition on doc_id, holds; about ``rows`` of each label, by hash."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
    known = known if learn is None else known.filter(learn)
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30))
    rate = F.lit(0.0)
    for label, n in totals.items():
        rate = F.when(F.col("quality") == label, min(1.0, rows / n)).otherwise(rate)
    drawn = known.filter(draw / (1 << 30) < rate).orderBy(draw).limit(2 * rows + 200).dropDuplicates(["doc_id"])
    text = F.col("text").cast("string")
    start = F.pmod(F.xxhash64(F.lit(19), text), F.greatest(F.lit(1), F.char_length(text) - FIT_CHARS)).cast("int") + 1
    found = docs.select("doc_id", F.substring(text, start, F.lit(FIT_CHARS)).alias("text")).join(F.broadcast(drawn), "doc_id")
    return fit([(r["text"] or "", r["quality"]) for r in found.select("text", "quality").limit(4 * rows).collect()], totals)


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted of every row, from its whole text.

    ``score`` is the calibrated share of label 1 among texts with such sizes; an empty or null text has the features 0 and
    0. Without both labels to learn from every score is 0.5. Rows are independent: repeated rows get equal scores, an empty
    table none; further columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = held.value.compressors() if held.value else None
        for b in slices(batches, "text"):
            texts = b.column(1).to_pylist()
            if made:
                scores = held.value.score(np.array([features(t or "", made) for t in texts]))
            else:
                scores = np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int"))
