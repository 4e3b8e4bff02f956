"""A small table with the hard cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, position long, id long, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sentence(rng: random.Random, words: int, lang: str) -> str:
    parts = {"en": ["the", "of", "ing", "th", "and", "ou"], "fr": ["é", "le", "eau", "que", "ois", "è"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def texts() -> list[tuple]:
    """Rows of documents: copies, near copies, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(3)
    rows, base = [], {lang: _sentence(rng, 90, lang) for lang in ("en", "fr")}
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        words = base[lang].split()
        if i % 4 == 0:  # near copies
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
            text = " ".join(words[:45]) + "\n" + " ".join(words[45:])
        elif i % 4 == 1:  # copies
            text = base[lang] + "\n" + base["en"][:60]
        else:
            text = "\n".join(_sentence(rng, rng.randint(1, 30), lang) for _ in range(rng.randint(1, 5)))
        rows.append((i, text, lang, f"src{i % 3 if i % 2 else 0}"))
    line = _sentence(rng, 12, "en")
    odd = [
        (100, None, "en", "src0"), (101, "", "en", "src0"), (102, "  \n\t ", None, None), (103, "1234 5678 !!", "en", "src1"),
        (104, _sentence(rng, 60_000, "en"), "en", "src0"), (105, "one two", "en", "src0"), (106, "One  two", "en", "src0"),
        (107, line + "\n" + line[:-1] + "x\n" + line, "en", "src2"), (108, "x" + line[1:] + "yz\n\nshort", "en", "src2"),
        (110, line + "\r\n" + "é\U0001f600ا " * 9, None, "src1"), (111, "<|endoftext|> a  b   c\n\n\n d", "en", "src1"),
        (None, "no id here at all, only text", "en", None), (None, None, None, None), (112, base["en"], "en", "src0"),
        (112, base["en"], "en", "src0"), (113, "a b c d e", "en", "src9"), (113, "f g h i j", "en", "src9"),
    ]
    return rows + odd


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The rows with further columns whose names the operators use themselves."""
    rows = texts() if rows is None else rows
    full = [(i, t, lang, s, len(t or ""), 1, 2, 3, "k") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def union_find(n: int):
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(a: int, b: int) -> None:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    return find, union


def shingle_set(text: str | None) -> frozenset:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(low)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i: i + 5]) for i in range(len(words) - 4))


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
