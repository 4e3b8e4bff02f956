"""Language identification by string kernels: blended-spectrum presence kernel, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: n-grams of 1 to SPECTRUM characters; characters beyond the SYMBOLS most frequent ones count as one.
SPECTRUM, SYMBOLS = 3, 62
#: Characters of a window; a text's scores are the mean over all its windows, by their lengths.
WINDOW = 1024
#: Labelled rows read for the fit, of each language, at most; landmarks among their windows; ridge.
FIT_ROWS, LANDMARKS, RIDGE = 400, 160, 1e-3
#: Characters that are scored together, so that a batch of long texts needs no large matrices.
SLICE = 1 << 18
UNKNOWN = "und"
BREAK = SYMBOLS + 1
BASE = SYMBOLS + 2


def _units(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), dtype="<u2")


@dataclass
class Model:
    symbols: np.ndarray  # UTF-16 unit -> symbol
    columns: list[np.ndarray]  # by n: n-gram code -> column, -1 if no landmark has it
    landmarks: np.ndarray  # columns x landmarks, presence over the landmark's norm
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    languages: list[str]

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(presence matrix over its norm, text, length) of the windows of all texts."""
        parts, owner, sizes = [], [], []
        gap = np.full(SPECTRUM, BREAK, dtype=np.int64)
        window, count = [], 0
        for i, text in enumerate(texts):
            s = self.symbols[_units(text)].astype(np.int64)
            n = max(1, round(len(s) / WINDOW))
            edges = np.linspace(0, len(s), n + 1).astype(np.int64)
            sizes.append(np.diff(edges))
            owner.append(np.full(n, i))
            window.append(np.repeat(np.arange(count, count + n), sizes[-1]))
            window.append(np.full(SPECTRUM, count + n - 1))
            parts += [s, gap]
            count += n
        s, window = np.concatenate(parts), np.concatenate(window)
        has = np.zeros((count, self.landmarks.shape[0]), dtype=np.float32)
        code = np.zeros(len(s), dtype=np.int64)
        for n in range(SPECTRUM):
            code = code[: len(s) - n] * BASE + s[n:]
            column = self.columns[n][code]
            there = column >= 0
            has[window[: len(code)][there], column[there]] = 1
        has /= np.sqrt(np.maximum(has.sum(axis=1, keepdims=True), 1))
        return has, np.concatenate(owner), np.concatenate(sizes)

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text: means of the windows' kernel ridge scores, the best one as a share of [-1, 1]."""
        has, owner, sizes = self.windows(texts)
        scores = (has @ self.landmarks) @ self.weights + self.bias
        weight = np.maximum(sizes, 1)[:, None]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        mean = np.add.reduceat(scores * weight, starts) / np.add.reduceat(weight, starts)
        best = mean.argmax(axis=1)
        return [self.languages[b] for b in best], np.clip((mean.max(axis=1) + 1) / 2, 0, 1)


def fit(samples: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model from (text, language) of bounded windows; None if there is none."""
    samples = sorted((lang, text) for text, lang in samples if text)
    if not samples:
        return None
    languages = sorted({lang for lang, _ in samples})
    units = np.concatenate([_units(t) for _, t in samples])
    counts = np.bincount(units, minlength=1 << 16)
    symbols = np.zeros(1 << 16, dtype=np.uint8)
    often = np.argsort(-counts, kind="stable")[:SYMBOLS]
    often = often[counts[often] > 0]
    symbols[often] = np.arange(1, len(often) + 1)
    columns = [np.full(BASE**n, -1, dtype=np.int32) for n in range(1, SPECTRUM + 1)]
    each = max(4, landmarks // len(languages))
    chosen = [t for lang in languages for t in [x for y, x in samples if y == lang][:each]]
    made = 0
    for n in range(1, SPECTRUM + 1):
        seen = np.zeros(BASE**n, dtype=np.int32)
        for t in chosen:
            s = symbols[_units(t)].astype(np.int64)
            code = np.zeros(len(s), dtype=np.int64)
            for k in range(n):
                code = code[: max(0, len(s) - k)] * BASE + s[k:]
            seen[np.unique(code)] += 1
        found = np.flatnonzero(seen >= (2 if n > 1 else 1))
        columns[n - 1][found] = np.arange(made, made + len(found))
        made += len(found)
    model = Model(symbols, columns, np.zeros((made, 1), np.float32), np.zeros((1, 1)), np.zeros(1), languages)
    has, _, _ = model.windows([t for _, t in samples])
    marks, _, _ = model.windows(chosen)
    model.landmarks = np.ascontiguousarray(marks.T)
    among = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    rows = [i for i, (_, t) in enumerate(samples) for _ in range(max(1, round(len(_units(t)) / WINDOW)))]
    target = np.array([[1.0 if samples[i][0] == lang else -1.0 for lang in languages] for i in rows])
    weight = np.array([1 / sum(samples[i][0] == samples[j][0] for j in range(len(samples))) for i in range(len(samples))])[rows]
    weight = (weight / weight.mean())[:, None]
    phi = (has @ model.landmarks).astype(np.float64) @ root
    middle = (phi * weight).mean(axis=0)
    bias = (target * weight).mean(axis=0)
    inner = (phi - middle).T @ (weight * (phi - middle)) / len(rows) + ridge * np.eye(phi.shape[1])
    ridge_weights = np.linalg.solve(inner, (phi - middle).T @ (weight * (target - bias)) / len(rows))
    model.weights = (root @ ridge_weights).astype(np.float32)
    model.bias = (bias - middle @ ridge_weights).astype(np.float32)
    return model


def fit_sample(labelled: DataFrame, rows: int = FIT_ROWS) -> list[tuple[str, str]]:
    """(window of the text, language) of about ``rows`` rows of each language, chosen and placed by hash; bounded in size."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    rate = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, min(1.0, rows / n)).otherwise(rate)
    size = F.char_length("text")
    start = F.pmod(F.xxhash64(F.lit(13), "text"), F.greatest(F.lit(1), size - WINDOW)).cast("int") + 1
    drawn = labelled.withColumn("draw", draw).filter(draw < rate).filter(F.col("text").rlike(r"\p{L}"))
    found = drawn.select(F.substring("text", start, F.lit(WINDOW)).alias("text"), "lang", "draw").orderBy("draw").limit(rows * len(counts) * 2)
    return [(r["text"], r["lang"]) for r in found.collect()]


def train(docs: DataFrame, learn: Column | None = None) -> Model | None:
    """Fit on rows with a language where ``learn`` holds."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                       (F.lit(True) if learn is None else learn).alias("learn"))
    return fit(fit_sample(rows.filter("learn and lang is not null and text is not null")))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with all their columns, and lang_pred and score, which replace columns of these names.

    All windows of a text are scored by two matrix products of a slice, presence by landmarks and kernel by weights; only
    the texts go to Python. A null text, one without a letter, and any text if nothing could be learned, are UNKNOWN
    with score 0. Ties of two languages go to the first by name. Rows are independent: repeated rows get equal results,
    an empty table none.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if t] if held.value is not None else []
            ends = np.cumsum([len(texts.iat[i]) for i in known]) // SLICE
            for part in np.split(np.array(known, dtype=np.int64), np.flatnonzero(np.diff(ends)) + 1):
                if len(part):
                    found, scores[part] = held.value.decide([texts.iat[i] for i in part])
                    for i, lang in zip(part, found, strict=True):
                        names[i] = lang
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*keep, predict.asNondeterministic()(F.when(letters, F.col(text))).alias("_told"))
    return rows.select(*keep, "_told.lang_pred", "_told.score")
