"""What the perplexity verdict rejects beyond the base rules."""

import random

from fixtures import documents

from tagloom.llm import perplexity


def test_perplexity_rejects(spark):
    """Garbled and repetitive texts that pass the base rules lie outside the bands, one on each side; prose stays."""
    rng, letters = random.Random(17), "bcdfghjklmnpqrstvwxyzaeiou"
    parts = ["ta", "re", "mi", "son", "el", "ka", "du", "no"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    mess = lambda: "".join(rng.choice(letters) for _ in range(6))
    rare = [mess() for _ in range(2000)]

    def prose(share):
        return " ".join(rng.choice(rare if rng.random() < share else words) for _ in range(100))

    rows = [(i, prose(0.1 + 0.1 * rng.random())) for i in range(300)]
    rows += [(i, "".join(rng.choice(letters) if c != " " and rng.random() < 0.065 else c for c in prose(0.15))) for i in range(500, 506)]
    rows += [(i, " ".join(rng.choice(parts[:3]) * rng.randint(1, 6) if rng.random() < 0.3 else rng.choice(words) for _ in range(100))) for i in range(600, 606)]
    rows = perplexity.quality_rules(documents(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    got = {r["doc_id"]: r for r in rows}
    middle = sorted(r["perplexity"] for r in rows)[len(rows) // 2]
    assert not any(r["base_failed"] for r in rows)
    assert not any(r["kept"] for r in rows if r["doc_id"] >= 500), sorted((r["doc_id"], r["perplexity"], r["kept"]) for r in rows)[300:]
    assert all(got[i]["perplexity"] > middle for i in range(500, 506)) and all(got[i]["perplexity"] < middle for i in range(600, 606))
    assert sum(got[i]["kept"] for i in range(300)) >= 290
