"""Groups that attach within a run, counters that add up, and windows that prune."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from tagloom.functions.keys import cluster_id_for
from tagloom.operators import weekly as W
from tagloom.operators.call_counters import CallCounters
from tagloom.sources.days import read_days, write_days

GROUPS = "group_id string, field_name string, normalized_label string, primary_status string, row_count long, representative string, raw_labels array<string>, centroid array<double>"
NEAR = "field_name string, group_id string, anomaly_cluster_id string, anomaly_name string, anomaly_similarity double"


def one_after_the_other(groups, near, safe, own):
    """(group -> cluster it attaches to), group by group in order."""
    made, attached = [], {}
    for g in sorted(groups, key=lambda g: (-g[4], g[1], g[2])):
        if g[3] == W.TRUE_ANOMALY:
            made.append(g)
            continue
        found = [(-near[g[0]][1], near[g[0]][0])] if g[0] in near else []
        for m in made:
            if m[1] == g[1] and m[7] is not None and g[7] is not None:
                sim = round(sum(a * b for a, b in zip(m[7], g[7])), 9)
                if sim >= 0.88:
                    found.append((-sim, own[m[0]]))
        if found:
            attached[g[0]] = min(found)[1]
        elif g[0] not in safe:
            made.append(g)
    return attached


def test_groups_attach_within_a_run(spark):
    rng = random.Random(9)
    groups, near, safe = [], {}, set()
    for i in range(160):
        angle = rng.uniform(0, 4)
        field, label = f"f{i % 3}", f"g{i:03d}"
        gid = f"{field}|{label}"
        status = W.TRUE_ANOMALY if rng.random() < 0.08 else W.CANDIDATE
        vector = None if i % 23 == 0 else [math.cos(angle), math.sin(angle)]
        groups.append((gid, field, label, status, rng.randint(1, 12), f"G {i}", [f"G {i}"], vector))
        if status == W.CANDIDATE and rng.random() < 0.1:
            near[gid] = (f"old_{i}", round(rng.uniform(0.88, 1), 6))
        if status == W.CANDIDATE and rng.random() < 0.1:
            safe.add(gid)
    g = spark.createDataFrame(groups, GROUPS)
    own = {r["group_id"]: r["id"] for r in g.select("group_id", cluster_id_for("weekly_anom", F.col("field_name"), F.col("normalized_label")).alias("id")).collect()}
    n = spark.createDataFrame([(k.split("|")[0], k, c, "Old", s) for k, (c, s) in near.items()], NEAR)
    got = W.same_run_targets(g, n, spark.createDataFrame([(s,) for s in safe], "group_id string")).collect()
    assert {r["group_id"]: r["anomaly_cluster_id"] for r in got} == one_after_the_other(groups, near, safe, own)
    assert len({r["group_id"] for r in got}) == len(got)


OUTPUTS = "field_name string, normalized_label string, source_record_id string, classified_at timestamp, created_at timestamp"


def outputs(spark, n, seed, weeks):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.choice(weeks) * 7 + rng.random() * 7)
        call = None if rng.random() < 0.05 else f"c{rng.randrange(60)}"
        rows.append(("f", f"l{rng.randrange(6)}", call, at if rng.random() < 0.8 else None, at))
    return spark.createDataFrame(rows, OUTPUTS)


def test_counters_add_up(spark, tmp_path):
    label_map = spark.createDataFrame(
        [("f", f"l{i}", f"k{i % 3}", i) for i in range(5)] + [("f", "l0", "k9", 4), ("f", "", "k1", 1)],
        "field_name string, normalized_label string, final_cluster_id string, value_count long")
    first, second = outputs(spark, 200, 1, [0, 1]), outputs(spark, 150, 2, [1, 2])
    kept = CallCounters(spark, str(tmp_path / "c"), buckets=4)

    def same(rows):
        want = W.cluster_counters(label_map, rows)
        got = kept.cluster_counters(label_map)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))

    kept.add(first, "one")
    same(first)
    numbers = {r["source_record_id"]: r["call_no"] for r in kept.numbers.read().collect()}
    kept.add(second, "two")  # nothing of the first batch is handed over
    same(first.unionByName(second))
    kept.add(second, "two")  # again
    same(first.unionByName(second))
    after = {r["source_record_id"]: r["call_no"] for r in kept.numbers.read().collect()}
    assert numbers.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1))


def test_windows_reach_the_scan(spark, tmp_path):
    rows = outputs(spark, 400, 3, [0, 1, 2, 3])
    rows.write.parquet(str(tmp_path / "plain"))
    start, end = "2024-01-08T00:00:00Z", "2024-01-10T00:00:00Z"
    want = sorted(map(str, rows.filter("coalesce(classified_at, created_at) >= '2024-01-08' AND coalesce(classified_at, created_at) < '2024-01-10'").collect()))
    plain = W.in_window(spark.read.parquet(str(tmp_path / "plain")), start, end)
    assert sorted(map(str, plain.collect())) == want and want
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(classified_at" in plan
    write_days(rows, str(tmp_path / "days"), W.EVENT_TIMES)
    days = read_days(spark, str(tmp_path / "days"), W.EVENT_TIMES, start, end)
    assert sorted(map(str, days.select(*rows.columns).collect())) == want
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan and "Or(And(GreaterThanOrEqual(classified_at" in plan
    read = {r[0] for r in days.select(F.regexp_extract(F.input_file_name(), "_day=([0-9-]+)", 1)).distinct().collect()}
    assert read <= {"2024-01-07", "2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11"}
