"""The mix in what the pipeline packs."""

from collections import defaultdict

import corpus_pipeline
from fixtures import documents

from tagloom.llm import mixing


def test_sequences_follow_the_weights(spark, tmp_path):
    """At each partition's end the sources' packed documents are within a few blocks of their weights, though a reread lost the order."""
    rows = [(i, f"a{i} " * 5, "en", "a") for i in range(1600)] + [(i, f"b{i} " * 300, "en", "b") for i in range(2000, 2400)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        corpus_pipeline.mix(spark, documents(spark, rows), "").write.parquet(f"{tmp_path}/mixed")
        out = corpus_pipeline.pack(spark, spark.read.parquet(f"{tmp_path}/mixed").repartitionByRange(8, "source", "doc_id"), "").filter("start = 0").select("doc_id", "sequence_id").collect()
    finally:
        spark.conf.set(coalesce, held)
    assert len(out) == 2000
    parts = defaultdict(lambda: [0, 0])
    for r in out:
        parts[r["sequence_id"] >> 40][r["doc_id"] >= 2000] += 1
    assert len(parts) >= 4
    done = [0, 0]
    for k in sorted(parts):
        done = [x + y for x, y in zip(done, parts[k], strict=True)]
        if done[1] == 400:
            break
        assert abs(done[1] - sum(done) / 3) <= 2 * mixing.BLOCK_ROWS, (k, done)  # weights are the roots of the rows, 2 to 1
