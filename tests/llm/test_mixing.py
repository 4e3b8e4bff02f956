"""The mix against the given weights, over many periods."""

from collections import Counter

from pyspark.sql import functions as F

from tagloom.llm import mixing


def test_mix_follows_the_weights(spark):
    """Less than a block from the exact weight at any slot of the first phase: equal ones, odd ones and a tiny one."""
    for weights in ({f"s{i}": 1.0 for i in range(20)}, {"a": 0.7, "b": 0.29999, "c": 0.00001}, {f"r{i}": i**0.5 for i in range(1, 8)}):
        names, total = sorted(weights), sum(weights.values())
        source = F.get(F.array(*map(F.lit, names)), F.pmod("id", F.lit(len(names))).cast("int"))
        docs = spark.range(200 * 20).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), source.alias("source"))
        rows = mixing.mix_sources(docs, weights, block_rows=1).orderBy("slot").collect()
        assert [r["slot"] for r in rows] == list(range(4000))
        done, size = Counter(), Counter(r["source"] for r in rows)
        for t, r in enumerate(rows, 1):
            assert r["block"] == done[r["source"]]
            done[r["source"]] += 1
            assert all(abs(done[s] - t * weights[s] / total) < 1 + 1e-9 for s in names), (weights, t)
            if done[r["source"]] == size[r["source"]]:
                break


def test_stretches_are_the_schedule(spark):
    blocks, weights = {"a": 500, "b": 333, "c": 7}, {"a": 0.5, "b": 0.3, "c": 1e-7}
    whole, last = mixing.stretches(blocks, weights, 1 << 20)
    parts, same = mixing.stretches(blocks, weights, 10)
    assert len(parts) > len(whole) and last == same
    a, b = (sorted(map(tuple, mixing.block_slots(spark, p).collect())) for p in (whole, parts))
    assert a == b and sorted(x[2] for x in a) == list(range(840)) and {x[:2] for x in a} == {(s, i) for s, n in blocks.items() for i in range(n)}
