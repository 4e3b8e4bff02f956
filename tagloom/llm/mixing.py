"""Mixing sources to target weights: a Pfair schedule of blocks, earliest deadline first."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import count, islice
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import cut
from .common import number_rows, small_side

#: Rows of a block, the unit that is scheduled.
BLOCK_ROWS = 16
#: Slots of a stretch of the schedule, the least that is dealt out as one; numbers that the states of all stretches have.
PERIOD, STATES = 1024, 1 << 22
#: Without target weights a source weighs as its rows to this power, which lifts small sources.
POWER = 0.5
SEED = 7


def shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole numbers of slots near the proportion of the weights, one at least, summing to period times a whole number."""
    total = sum(weights.values())
    size = period * max(1, -(-2 * len(weights) // period))
    exact = {s: max(1.0, w * size / total) for s, w in weights.items()}
    out = {s: int(x) for s, x in exact.items()}
    left = size - sum(out.values())
    by_rest = sorted(exact, key=lambda s: (out[s] - exact[s], s))
    for k in range(abs(left)):
        s = by_rest[k % len(by_rest)] if left > 0 else max(out, key=lambda x: (out[x], x))
        out[s] += 1 if left > 0 else -1
    return out


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * unit) for s, x in exact.items()}


def scheduled(weights: Mapping[str, int], slot: int, done: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot from ``slot`` on, after ``done`` blocks of each source; without an end.

    Block i of a source with weight w of W in all is released at floor(i W / w) and due at ceil((i + 1) W / w). In each slot
    the released block with the earliest deadline runs, ties by name. As the shares sum to one every block meets its
    deadline, so at any time each source is less than one block from its share.
    """
    total = sum(weights.values())
    waiting = [(i * total // weights[s], s, i) for s, i in done.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for t in count(slot):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[s]), s, i))
        _, s, i = heapq.heappop(ready)
        yield s
        heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))


def period_schedule(slots: Mapping[str, int]) -> list[str]:
    """The source of each slot of a period in which the sources have these numbers of slots, which it ends exactly on."""
    return list(islice(scheduled(slots, 0, dict.fromkeys(slots, 0)), sum(slots.values())))


def stretches(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> tuple[list[tuple], dict[str, int]]:
    """The mix in stretches that can be dealt out, and the slot of each source's last block.

    In a phase the remaining sources follow the schedule of their exact weights; it ends when a source has no block left, and
    the others go on with weights in proportion to theirs. A stretch: its phase's first slot, its own first slot and
    its length, counted in the phase, the weights, and the blocks of each source done before the phase and within it. The
    schedule runs through once, but only the states at the stretches' starts are kept, STATES numbers or so in all.
    """
    left, first, out, last = {s: n for s, n in blocks.items() if n > 0}, 0, [], {}
    before = dict.fromkeys(blocks, 0)
    period = max(period, sum(blocks.values()) * len(blocks) // STATES)
    while left:
        shares, done, t = whole_weights({s: weights[s] for s in left}), dict.fromkeys(left, 0), 0
        for t, s in enumerate(scheduled(shares, 0, done)):
            if t % period == 0:
                out.append((first, t, period, shares, {x: before[x] for x in left}, dict(done)))
            done[s] += 1
            if done[s] == left[s]:
                last[s] = first + t
                break
        out[-1] = (*out[-1][:2], t % period + 1, *out[-1][3:])
        first += t + 1
        before |= {s: before[s] + done[s] for s in left}
        left = {s: n - done[s] for s, n in left.items() if n > done[s]}
    return out, last


def block_slots(spark: SparkSession, plan: list[tuple]) -> DataFrame:
    """(source, block, slot) of all blocks: each stretch is run again from its state, on the cluster."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.column(0).to_pylist():
                first, start, length, shares, before, done = pickle.loads(state)
                order = list(islice(scheduled(shares, start, done), length))
                at = {s: before[s] + done[s] for s in done}
                numbers = []
                for s in order:
                    numbers.append(at[s])
                    at[s] += 1
                slots = np.arange(first + start, first + start + length)
                yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(numbers, pa.int64()), pa.array(slots)], ["source", "block", "slot"])

    rows = spark.createDataFrame([(pickle.dumps(x),) for x in plan], "state binary")
    return rows.mapInArrow(run, "source string, block long, slot long")


def source_weights(rows: Mapping[str, int], weights: Mapping[str, float] | None) -> dict[str, float]:
    if weights is None:
        return {s: n**POWER for s, n in rows.items()}
    if unknown := [s for s in rows if weights.get(s, 0) <= 0]:
        raise ValueError(f"sources without a positive weight: {unknown[:5]}")
    return {s: float(weights[s]) for s in rows}


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS,
                period: int = PERIOD) -> DataFrame:
    """doc_id, source, text_crc32, block, slot, position of every row; ``position`` is gapless from 0.

    The rows of a source, in an order by hash, are cut into blocks; the schedule gives a block its slot and a row its
    position. Only the sources' counts reach the driver, which runs through the schedule once; tasks run its stretches again
    for the blocks' slots. All rows stay: when a source ends, the others go on by their weights. Within a phase, each source
    is less than a block from its exact target at any slot, however long the phase is.

    ``weights``: positive target weights by source, or None for rows ** POWER. A null source is a source of its own, named
    by the empty text together with it. A null doc_id or text is a value like any other; rows equal in doc_id and text are
    interchangeable. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(
        docs["doc_id"].alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"),
        F.crc32(F.encode(F.coalesce(docs["text"].cast("string"), F.lit("")), "UTF-8")).alias("text_crc32"))
    rows = rows.withColumn("shuffled", F.xxhash64(F.lit(SEED), "doc_id", "text_crc32"))
    counts = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    plan, last = stretches(blocks, source_weights(counts, weights), period)

    slots = small_side(cut(block_slots(docs.sparkSession, plan)))
    numbered = number_rows(rows, ["shuffled", "doc_id", "text_crc32"], within=["source"], rows=sum(counts.values()))
    met = numbered.withColumn("block", F.expr(f"row_no div {block_rows}")).join(slots, ["source", "block"])
    # the last block of a source may be short: positions behind it move up by what it lacks
    short = [(last[s], block_rows - n % block_rows) for s, n in counts.items() if n % block_rows]
    lacks, total = [], 0
    for at, missing in sorted(short):
        total += missing
        lacks.append((at, total))
    moved = F.lit(0).cast("long")
    if lacks:
        ends = F.array(*(F.lit(a).cast("long") for a, _ in lacks))
        sums = F.array(*(F.lit(t).cast("long") for _, t in lacks))
        before = F.aggregate(ends, F.lit(0), lambda acc, x: acc + F.when(x < F.col("slot"), 1).otherwise(0))
        moved = F.when(before > 0, F.get(sums, before - 1)).otherwise(0)
    position = F.col("slot") * block_rows + F.col("row_no") % block_rows - moved
    return met.withColumn("position", position.cast("long")).select("doc_id", "source", "text_crc32", "block", "slot", "position")


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The documents as they are, all of them, in the order of the mix: written files follow it one after the other."""
    at = mix_sources(docs, weights).groupBy("doc_id", "text_crc32", "source").agg(F.min("position").alias("position"))
    crc = F.crc32(F.encode(F.coalesce(docs["text"].cast("string"), F.lit("")), "UTF-8"))
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs["doc_id"].alias("id"), crc.alias("crc"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("of"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("crc") == F.col("text_crc32")) & (F.col("of") == F.col("source"))
    placed = rows.join(cut(at), same).select("doc", "position")
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("doc.*")
