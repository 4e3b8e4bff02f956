"""The multi-index Hamming join against all pairs, and its promise about signatures."""

import random
from collections import defaultdict

import numpy as np
import pytest
from fixtures import WORD, documents, texts, union_find

from tagloom.llm import minhash


def pair_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 2:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:]))


def plain_version(rows):
    sets = [pair_set(t) for _, t, *_ in rows]
    find, union = union_find(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                union(i, j)
    least = defaultdict(list)
    for i, (doc_id, *_) in enumerate(rows):
        least[find(i)].append(doc_id)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        name = min((x for x in least[find(i)] if x is not None), default=None)
        out.append((doc_id, len(sets[i]), name, doc_id == name))
    return out


def near_copies(n, changes, seed, first_id):
    """n copies of one text, each with a few words of its own, and those with chains of changes."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        rows.append((first_id + i, " ".join(words), "en", "src0"))
    return rows


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("rows", [
    texts(), near_copies(150, 9, 1, 0) + near_copies(60, 14, 2, 1000) + [(5000 + i, "the very same words", None, None) for i in range(1500)],
    [], [(None, "a b", None, None), (None, None, None, None), (7, "a", None, None), (8, "A", None, None), (9, "a a a", None, None)],
])
def test_near_duplicates(spark, rows):
    got = minhash.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_version(rows), key=key)


@pytest.mark.parametrize("scheme", [minhash.Scheme(), minhash.Scheme(4, 3, 0, 8), minhash.Scheme(5, 6, 2, 4), minhash.Scheme(1, 4, 3, 16)])
def test_no_pair_under_the_distance_is_lost(scheme):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << scheme.bits, (1, scheme.symbols), dtype=np.uint16)
    rows = np.repeat(base, 400, axis=0)
    for i, r in enumerate(rows):
        at = rng.permutation(scheme.symbols)[: min(scheme.symbols, i % (scheme.distance + 8))]
        r[at] ^= 1
    keys = minhash.chunk_keys(rows, scheme)
    near = (rows != base).sum(axis=1) <= scheme.distance
    own = minhash.chunk_keys(base, scheme)[0]
    shares = np.array([len(np.intersect1d(own, k)) > 0 for k in keys])
    assert near.any() and shares[near].all()


def test_distance_of_signatures_follows_similarity():
    rng = np.random.default_rng(5)
    scheme = minhash.Scheme()
    far = []
    for _ in range(300):
        words = np.unique(rng.integers(-(1 << 62), 1 << 62, 180))
        x, y = minhash.signatures([words[:160], words[-160:]], scheme)  # 140 of 180 shared
        far.append((x != y).sum())
    assert abs(np.mean(far) - scheme.symbols * 40 / 180) < 1 and max(far) <= scheme.distance + 6
