"""The running anomaly state: any split into batches, a start from history, labels that expire."""

import datetime as dt
import os

import pytest

from tagloom.streaming.anomaly_state import anomaly_state, history_evidence
from tagloom.streaming.mapper import run_to_table

SCHEMA = "field_name string, normalized_label string, mapping_status string, source_record_id string, classified_at timestamp"
DAY = dt.datetime(2024, 1, 1, 12)


def row(label, call, day=0.0, field="coaching_tags"):
    return (field, label, "TRUE_ANOMALY", call, DAY + dt.timedelta(days=day))


def stream(spark, folder, batches):
    """One file a batch, in order of time of writing."""
    for i, rows in enumerate(batches):
        path = f"{folder}/b{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        os.makedirs(f"{folder}/in", exist_ok=True)
        os.replace(f"{path}/{part}", f"{folder}/in/{i}.parquet")
        os.utime(f"{folder}/in/{i}.parquet", (1_700_000_000 + i * 10,) * 2)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def found(spark, folder, batches, **more):
    out = anomaly_state(stream(spark, folder, batches), **more)
    table = run_to_table(out, f"{folder}/out", ["field_name", "normalized_label"], mode="append")
    return sorted(r["normalized_label"] for r in table.read().collect()) if table.exists() else []


ROWS = [
    row("three calls", "a"), row("three calls", "b"), row("three calls", "c"), row("five times", "a"), row("five times", "a"),
    row("five times", "a"), row("five times", "a"), row("five times", "b"), row("two weeks", "a", 0), row("two weeks", "a", 8),
    row("too few", "a"), row("too few", "b"), row("too few", None), ("coaching_tags", "", "TRUE_ANOMALY", "z", DAY),
    ("coaching_tags", "known", "EXISTING_CLUSTER", "z", DAY),
]


@pytest.mark.parametrize("size", [1, 4, 100])
def test_any_split_into_batches(spark, tmp_path, size):
    order = ROWS if size == 1 else ROWS[::-1]
    batches = [order[i:i + size] for i in range(0, len(order), size)]
    assert found(spark, str(tmp_path), batches) == ["five times", "three calls", "two weeks"]


def test_start_from_history(spark, tmp_path):
    past = spark.createDataFrame(
        [row("split", "a", -7), row("split", "b", -7), row("done", "a", -7), row("done", "b", -7), row("done", "c", -7), row("same week", "a", -0.1)], SCHEMA)
    new = [[row("split", "c", -6.9)], [row("done", "d"), row("same week", "a"), row("fresh", "a")]]
    assert found(spark, str(tmp_path), new, history=history_evidence(past)) == ["split"]  # "done" was given out before


def test_a_label_expires(spark, tmp_path):
    batches = [
        [row("slow", "a", 0), row("steady", "a", 0), row("slow", "b", 0)],
        [row("steady", "b", 2), row("other", "x", 2)],
        [row("other", "y", 3.5), row("steady", "a", 3.5)],  # the watermark passes the end of what "slow" had
        [row("other", "x", 4)],
        [row("slow", "c", 4.1), row("steady", "c", 4.1)],
    ]
    assert found(spark, str(tmp_path / "forgets"), batches, keep="1 days 12 hours", watermark="0 seconds") == ["steady"]
    assert found(spark, str(tmp_path / "keeps"), batches) == ["slow", "steady"]


def test_only_one_clock(spark):
    with pytest.raises(ValueError):
        anomaly_state(spark.createDataFrame([], SCHEMA), keep="1 day", ttl="1 day")
