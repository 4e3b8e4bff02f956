"""Exact nearest neighbours by blocked matrix products.

Rows are packed into blocks of about ``BLOCK_ROWS`` vectors. Spark pairs blocks (never
rows), a task multiplies one pair of blocks at a time with numpy and emits only the best
few rows per query, and a window merges the partial results. A field that holds a third of
all rows is many blocks, spread over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import cut
from ..sources.io import dense_index

BLOCK_ROWS = 1024
#: Points of a block; blocks of points meet few others, so they are smaller.
POINT_ROWS = 512


def salts_for(blocks: int) -> int:
    """Parts that one side of a join of blocks is dealt to, and copies of the other: about the root of the blocks."""
    return max(1, math.isqrt(blocks))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 16):
    """Few rows per Arrow batch: each row carries two blocks of vectors."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pack(
    df: DataFrame,
    on: list[str],
    row_id: str,
    vec: str,
    mask: str | None = None,
    cell: str | None = None,
    block_rows: int = BLOCK_ROWS,
    facts: str | None = None,
) -> DataFrame:
    """One row per block: ``on``, ``dim``, ``block``, ``ids`` (sorted), ``vecs``, ``masks``.

    Ids are unique within ``on``. Only vectors of one length share a block; with ``cell``
    only rows of one cell do. ``facts``, an array of numbers of each row, comes along as ``facts``.
    """
    group = [*on, "dim", *([cell] if cell else [])]
    # Read twice below; cutting it here keeps embedding and guard work from running twice.
    rows = cut(df.select(
        *on,
        F.size(vec).alias("dim"),
        *([cell] if cell else []),
        F.col(row_id).cast("string").alias("i"),
        V.as_double(F.col(vec)).alias("v"),
        (F.col(mask) if mask else F.lit(0)).cast("int").alias("m"),
        *([F.col(facts).alias("x")] if facts else []),
    ).filter(F.col("v").isNotNull()))
    sizes = rows.groupBy(*group).agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("parts")
    )
    placed = rows.hint("merge").join(sizes, group).withColumn("part", F.pmod(F.hash("i"), F.col("parts")))
    return (
        placed.groupBy(*group, "part")
        .agg(F.array_sort(F.collect_list(F.struct("i", "v", "m", *(["x"] if facts else [])))).alias("r"))
        .select(
            *on,
            "dim",
            F.concat_ws("/", *[F.col(g).cast("string") for g in group], "part").alias("block"),
            F.col("r.i").alias("ids"),
            F.flatten("r.v").alias("vecs"),
            F.col("r.m").alias("masks"),
            *([F.flatten("r.x").alias("facts")] if facts else []),
        )
    )


_PARTIAL = "q_id string, t_id string, sim double, conflict boolean, ok_first boolean"


def _partial_topk(on: list[str], k: int, min_sim: float, no_self: bool, metric: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            found = []
            for p in pairs.itertuples(index=False):
                q = np.asarray(p.q_vecs, dtype=np.float64).reshape(-1, p.dim)
                t = np.asarray(p.t_vecs, dtype=np.float64).reshape(-1, p.dim)
                if metric == "dot":
                    s = q @ t.T
                else:
                    d2 = (q * q).sum(1)[:, None] + (t * t).sum(1)[None, :] - 2 * (q @ t.T)
                    s = -np.maximum(d2, 0.0)
                s = np.round(s, 9) + 0.0
                q_ids, t_ids = np.asarray(p.q_ids), np.asarray(p.t_ids)
                usable = s >= min_sim
                if no_self:
                    usable &= q_ids[:, None] != t_ids[None, :]
                qm = np.asarray(p.q_masks, dtype=np.int64)[:, None]
                tm = np.asarray(p.t_masks, dtype=np.int64)[None, :]
                clash = (((qm & 7) & (tm >> 3)) | ((qm >> 3) & (tm & 7))) != 0
                order = np.argsort(-np.where(usable, s, -np.inf), axis=1, kind="stable")
                rows = np.arange(len(q_ids))[:, None]
                ranked_ok = (usable & ~clash)[rows, order]
                first_ok = np.where(ranked_ok.any(1), ranked_ok.argmax(1), -1)
                place = np.arange(order.shape[1])[None, :]
                is_first = place == first_ok[:, None]
                keep = ((place < k) & usable[rows, order]) | is_first
                qi, pi = np.nonzero(keep)
                if len(qi) == 0:
                    continue
                ti = order[qi, pi]
                out = {c: getattr(p, c) for c in on}
                found.append(pd.DataFrame(
                    out
                    | {
                        "q_id": q_ids[qi],
                        "t_id": t_ids[ti],
                        "sim": s[qi, ti],
                        "conflict": clash[qi, ti],
                        "ok_first": is_first[qi, pi],
                    }
                ))
            if found:
                yield pd.concat(found, ignore_index=True)

    return run


def pair_products(
    pairs: DataFrame, on: list[str], k: int, min_sim: float, no_self: bool, metric: str = "dot"
) -> DataFrame:
    """Partial top-k rows of joined block pairs, checkpointed."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*on).schema.fields)
    schema = f"{kinds}, {_PARTIAL}" if on else _PARTIAL
    columns = [*on, "dim", "q_ids", "q_vecs", "q_masks", "t_ids", "t_vecs", "t_masks"]
    with small_batches(pairs.sparkSession):
        return cut(
            pairs.select(*columns).mapInPandas(_partial_topk(on, k, min_sim, no_self, metric), schema)
        )


def _side(blocks: DataFrame, side: str) -> DataFrame:
    names = {c: f"{side}_{c}" for c in ("block", "ids", "vecs", "masks")}
    return blocks.withColumnsRenamed({c: n for c, n in names.items() if c in blocks.columns})


def merge_topk(partial: DataFrame, by: list[str], k: int) -> DataFrame:
    """Global ranks from partial top-k rows; at most (k + 1) rows per block and query.

    Keeps the ``k`` best and, beyond them, the best row without conflict (``ok_first``).
    """
    order = [F.col("sim").desc(), F.col("t_id")]
    all_rows = Window.partitionBy(*by).orderBy(*order)
    fine_rows = Window.partitionBy(*by).orderBy(F.col("conflict"), *order)
    return (
        partial.withColumns(
            {
                "rank": F.row_number().over(all_rows),
                "ok_first": (F.row_number().over(fine_rows) == 1) & ~F.col("conflict"),
            }
        )
        .filter((F.col("rank") <= k) | F.col("ok_first"))
    )


def best_targets(
    queries: DataFrame,
    targets: DataFrame,
    on: list[str],
    k: int,
    q: tuple[str, str, str | None],
    t: tuple[str, str, str | None],
    target_groups: list[str] = [],
    min_sim: float = -float("inf"),
) -> DataFrame:
    """Top ``k`` targets per query (and target group) by inner product.

    ``q`` and ``t`` name the id, vector and guard-mask columns. All targets of the same
    ``on`` are compared; both sides are blocks, joined under a salt.
    """
    packed = cut(pack(queries, on, *q))
    parts = salts_for(packed.count())
    qb = _side(packed, "q").withColumn("salt", F.pmod(F.hash("q_block"), F.lit(parts)))
    tb = _side(pack(targets, [*on, *target_groups], *t), "t").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    pairs = qb.hint("merge").join(tb, [*on, "dim", "salt"])
    by = [*on, *target_groups]
    return merge_topk(pair_products(pairs, by, k, min_sim, False), [*by, "q_id"], k)


def block_pairs(blocks: DataFrame, on: list[str]) -> DataFrame:
    """(on, q_block, t_block): all ordered pairs of blocks of one group and length, dealt under a salt."""
    ids, parts = blocks.select(*on, "dim", "block"), salts_for(blocks.count())
    q = ids.withColumnRenamed("block", "q_block").withColumn("salt", F.pmod(F.hash("q_block"), F.lit(parts)))
    t = ids.withColumnRenamed("block", "t_block").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return q.join(t, [*on, "dim", "salt"]).select(*on, "q_block", "t_block")


#: Rows and numbers of a tile at most, beside what one block more has; a task holds two tiles.
TILE_ROWS, TILE_VALUES = 16_384, 1 << 20
#: The same for neighbours, whose tasks hold few products beside the tiles, and the tiles of a group that is not larger than they allow.
NEAR_ROWS, NEAR_VALUES, NEAR_TILES = 32_768, 1 << 21, 5
#: Products that a task holds at a time.
SLAB = 1 << 22
#: Products of the same vectors may differ by so much from task to task.
NOISE = 2e-9


def tiles(blocks: DataFrame, on: list[str], least: int = 2 * BLOCK_ROWS, most: int = TILE_ROWS, values: int = TILE_VALUES,
          spread: int = 8) -> DataFrame:
    """Blocks with ``tile``, a number below ``tiles``: many blocks of a group and length, which a task takes at once.

    A row is then copied once for each tile of its group, not for each block. Large groups have tiles of ``most`` rows or
    ``values`` numbers, small ones up to ``spread`` of ``least`` rows at least.
    """
    n = F.sum(F.size("ids"))
    few = F.greatest(F.ceil(n / most), F.ceil(n * F.col("dim") / values), F.least(F.lit(spread), F.ceil(n / least)))
    counts = blocks.groupBy(*on, "dim").agg(F.greatest(F.lit(1), few).cast("int").alias("tiles"))
    return blocks.hint("merge").join(counts, [*on, "dim"]).withColumn("tile", F.pmod(F.xxhash64("block"), F.col("tiles")).cast("int"))


def tile_sides(tiled: DataFrame, on: list[str], q: list[str], t: list[str], half: bool) -> tuple[DataFrame, DataFrame]:
    """The blocks of either side, once for each pair of tiles that they are in."""
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    qs = tiled.select(*on, "dim", *q, F.col("tile").alias("q_tile"), F.explode(other).alias("t_tile"))
    ts = tiled.select(*on, "dim", *t, F.explode(other).alias("q_tile"), F.col("tile").alias("t_tile"))
    if half:
        qs, ts = qs.filter("q_tile <= t_tile"), ts.filter("q_tile <= t_tile")
    return qs, ts.select(*[F.col(c).alias(c) for c in ts.columns])  # columns of its own, as both sides are one table


def tile_pairs(tiled: DataFrame, on: list[str], q: list[str], t: list[str], work, schema: str, half: bool = False) -> DataFrame:
    """``work(key, q rows, t rows)`` for each pair of tiles of a group and length, ``half``: for one of its two orders.

    ``q`` and ``t`` are the columns that ``work`` reads of either side.
    """
    qs, ts = tile_sides(tiled, on, q, t, half)
    key = [*on, "dim", "q_tile", "t_tile"]
    return qs.groupBy(*key).cogroup(ts.groupBy(*key)).applyInPandas(work, schema)


def stacked(column, dim: int = 0) -> np.ndarray:
    """The arrays of a column as one, of vectors if ``dim`` is given."""
    whole = np.concatenate([np.asarray(x) for x in column])
    return np.asarray(whole, dtype=np.float64).reshape(-1, dim) if dim else whole


def distances2(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    return (q * q).sum(1)[:, None] + (t * t).sum(1)[None, :] - 2 * (q @ t.T)


def _scores(q, t, q_mask, t_mask, metric: str) -> np.ndarray:
    s = q @ t.T if metric == "dot" else -np.maximum(distances2(q, t), 0.0)
    if q_mask.any() and t_mask.any():
        s[np.ix_(q_mask != 0, t_mask != 0)] = -np.inf
    return s


def _best(s: np.ndarray, kth: np.ndarray, rank: np.ndarray, k: int, least: float):
    """(row, column, score) of the ``k`` best scores of each row, ties by ``rank`` of the column; none far below ``kth``."""
    floor = np.maximum(kth, least) - NOISE
    hit = s >= floor[:, None]
    n = s.shape[1]
    if n > k and np.count_nonzero(hit) > 8 * k * len(s):
        floor = np.maximum(floor, np.partition(s, n - k, axis=1)[:, n - k] - NOISE)
        hit = s >= floor[:, None]
    qi, ti = np.nonzero(hit)
    sim = np.round(s[qi, ti], 9) + 0.0
    fine = (sim >= least) & (sim > -np.inf)
    qi, ti, sim = qi[fine], ti[fine], sim[fine]
    order = np.lexsort((rank[ti], -sim, qi))
    qi, ti, sim = qi[order], ti[order], sim[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi, "left") < k
    return qi[keep], ti[keep], sim[keep]


def _ranks(keys: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), dtype=np.int64)
    out[np.argsort(keys.astype(str), kind="stable")] = np.arange(len(keys))
    return out


_NEAR = "key string, far array<double>, t array<string>"


def _lists(q_keys: np.ndarray, t_keys: np.ndarray, found) -> pd.DataFrame:
    """One row per query with its targets, the best first; ``far`` is the negative score."""
    qi, ti, sim = found
    if not len(qi):
        return pd.DataFrame({"key": [], "far": [], "t": []}, dtype=object)
    first = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
    return pd.DataFrame({"key": q_keys[qi[first]], "far": np.split(0.0 - sim, first[1:]), "t": np.split(t_keys[ti], first[1:])})


def _distinct(rows: DataFrame, on: list[str], k: int) -> tuple[DataFrame, DataFrame, int, bool]:
    """(vectors, rows by vector, targets to look for, whether an id has several vectors) of ``rows`` (on, rid, v).

    Equal vectors are one vector ``key``, so copies are not multiplied with each other. The ``k`` best rows of a query are
    among the ``k`` smallest other ids of each of its ``k`` best vectors and its own; an id that comes with several vectors
    needs as many more. Rows without an id (``m`` 1) are vectors of their own.
    """
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x))
    rows = cut(rows.filter(F.col("v").isNotNull()).filter(whole).dropna(subset=on).withColumns(
        {"dim": F.size("v"), "m": F.col("rid").isNull().cast("int")}))
    # ids with several vectors, rows without an id
    ids = rows.filter("m = 0").groupBy(*on, "rid").agg(F.count_distinct(F.xxhash64("v")).alias("n"))
    several = ids.agg(F.max("n")).first()[0] or 1
    unnamed = not rows.filter("m = 1").isEmpty()
    told = F.concat(*[F.hex(F.xxhash64(*c)) for c in (["v"], [F.lit(1), "v"])])
    name = F.concat("rep", F.lit("\0"), told) if several > 1 else F.col("rep")
    vectors = rows.groupBy(*on, "dim", "m", "v").agg(F.min("rid").alias("rep"))
    vectors = cut(vectors.select(
        *on, "dim", "m", "v", F.when(F.col("m") == 1, F.concat(F.lit("\0"), told)).otherwise(name).alias("key")))
    # Files of vectors may be far smaller than their rows, so Spark's guess of what fits a broadcast does not hold.
    by_vector = cut(rows.join(vectors.hint("merge"), [*on, "dim", "m", "v"]).groupBy(*on, "key", "rid").agg(F.count("*").alias("c")))
    return vectors, by_vector, k + several, several > 1 or unnamed


def _expanded(near: DataFrame, by_vector: DataFrame, on: list[str], k: int, wide: int, again: bool) -> DataFrame:
    """(on, q_id, t_id, far, rank): rows of the best vectors ``near`` (on, key, far, t), for every row."""
    merged = near.groupBy(*on, "key").agg(F.flatten(F.collect_list(F.arrays_zip("far", "t"))).alias("near"))
    each = merged.select(*on, "key", F.explode(F.slice(F.array_sort("near"), 1, wide)).alias("n")).select(
        *on, "key", "n.far", F.col("n.t").alias("t_key"))
    # The smallest ids of a vector, dealt first so that a vector with very many rows is many groups.
    part = F.pmod(F.xxhash64("rid"), F.lit(64)).alias("part")
    small = by_vector.select("*", part)
    for by in ([*on, "key", "part"], [*on, "key"]):
        small = small.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy("rid"))).filter(F.col("_rn") <= wide).drop("_rn")
    targets = small.select(*on, F.col("key").alias("t_key"), F.col("rid").alias("id"), F.least("c", F.lit(k)).alias("n"))
    best = each.join(targets, [*on, "t_key"]).groupBy(*on, "key").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("far", "id", "n"))), 1, wide).alias("best"))
    others = F.filter("best", lambda x: ~x["id"].eqNullSafe(F.col("rid")))
    copies = F.flatten(F.transform(others, lambda x: F.array_repeat(x, F.least(x["n"] * F.col("c"), F.lit(k)).cast("int"))))
    out = by_vector.join(best, [*on, "key"]).select(
        *on, F.col("rid").alias("q_id"), F.posexplode(F.slice(copies, 1, k)).alias("rank", "b")
    ).select(*on, "q_id", F.col("b.id").alias("t_id"), F.col("b.far").alias("far"), (F.col("rank") + 1).alias("rank"))
    if not again:
        return out
    order = Window.partitionBy(*on, "q_id").orderBy("far", "t_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _kinds(df: DataFrame, on: list[str]) -> str:
    return "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*on).schema.fields)


def _own_neighbors(on: list[str], k: int, min_sim: float):
    """Blocks with centre, radius and, for each row, the k-th best similarity inside the block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for blocks in batches:
            rows = []
            for b in blocks.itertuples(index=False):
                v = stacked([b.vecs], b.dim)
                s = v @ v.T
                n = len(v)
                kth = np.partition(s, n - k, axis=1)[:, n - k] - NOISE if n >= k else np.full(n, -np.inf)
                center = v.mean(0)
                length = np.sqrt((center * center).sum())
                center = center / length if length > 0 else center
                radius = np.arccos(np.clip(v @ center, -1.0, 1.0)).max()
                rows.append((kth, center, radius, max(float(kth.min()), min_sim)))
            more = pd.DataFrame(rows, columns=["kth", "center", "radius", "needed"])
            yield pd.concat([blocks.reset_index(drop=True), more], axis=1)

    return run


def _tile_neighbors(on: list[str], k: int, min_sim: float):
    """Neighbours of the rows of two tiles in each other, or of one in itself."""

    def best(qs: pd.DataFrame, ts: pd.DataFrame, dim: int) -> list[pd.DataFrame]:
        t, t_keys = stacked(ts["vecs"], dim), stacked(ts["ids"])
        rank, sizes = _ranks(t_keys), ts["ids"].map(len).to_numpy()
        qc, tc = stacked(qs["center"], dim), stacked(ts["center"], dim)
        between = np.arccos(np.clip(qc @ tc.T, -1.0, 1.0))
        gap = np.maximum(0.0, between - qs["radius"].to_numpy()[:, None] - ts["radius"].to_numpy()[None, :] - 1e-6)
        near = np.cos(gap) >= qs["needed"].to_numpy()[:, None] - 1e-9
        slab = max(1, SLAB // len(t))
        # Blocks that follow each other are of one cell mostly; small ones are taken together.
        group = np.cumsum(qs["ids"].map(len).to_numpy()) // max(1, min(slab, BLOCK_ROWS))
        found = []
        for g in np.unique(group):
            mine = np.flatnonzero(group == g)
            wanted = near[mine].any(0)
            if not wanted.any():
                continue
            cols = np.flatnonzero(np.repeat(wanted, sizes))
            some = qs.iloc[mine]
            q, q_keys, kth = stacked(some["vecs"], dim), stacked(some["ids"]), stacked(some["kth"])
            tv, tk, tr = (t, t_keys, rank) if len(cols) == len(t) else (t[cols], t_keys[cols], rank[cols])
            for a in range(0, len(q), slab):
                s = q[a:a + slab] @ tv.T
                found.append(_lists(q_keys[a:a + slab], tk, _best(s, kth[a:a + slab], tr, k, min_sim)))
        return found

    def run(key: tuple, qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        head, (dim, q_tile, t_tile) = dict(zip(on, key)), key[len(on):]
        none = pd.DataFrame({c: [] for c in [*on, "key", "far", "t"]}, dtype=object)
        if not len(qs) or not len(ts):
            return none
        qs, ts = qs.sort_values("block"), ts.sort_values("block")
        found = best(qs, ts, dim) + (best(ts, qs, dim) if q_tile != t_tile else [])
        out = pd.concat(found, ignore_index=True) if found else none
        return out.assign(**head)[[*on, "key", "far", "t"]]

    return run


def knn(
    df: DataFrame,
    on: list[str],
    row_id: str,
    vec: str,
    k: int,
    min_sim: float = -1.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact ``k`` nearest neighbours of unit vectors inside ``on``; ties by id.

    Equal vectors are searched once. Rows are first gathered in cells around pivot rows, so that blocks are compact; a group
    has about eight times the root of its blocks as cells. Tasks take pairs of tiles of many blocks; a pair of blocks in them
    is multiplied only if the angle between their centers, less their radii, can still beat the worst k-th similarity that
    the query block found inside itself (or ``min_sim``). The bound is exact: no neighbour is lost. A pair of tiles is taken
    once for both of its orders, and a group has NEAR_TILES tiles or fewer until they are full, so rows are copied up to
    NEAR_TILES + 1 times; in a larger group, once more for each tile more.
    """
    if not on:
        out = knn(df.withColumn("whole_table", F.lit(0)), ["whole_table"], row_id, vec, k, min_sim, block_rows)
        return out.drop("whole_table")
    named = df.select(*on, F.col(row_id).cast("string").alias("rid"), V.as_double(F.col(vec)).alias("v"))
    vectors, by_vector, wide, again = _distinct(named.filter("rid IS NOT NULL"), on, k)
    blocks_of = F.ceil(F.count("*") / F.lit(block_rows))
    groups = vectors.groupBy(*on, "dim").agg(
        F.count("*").alias("n"), F.least(blocks_of, F.ceil(8 * F.sqrt(blocks_of))).alias("cells"),
        F.min_by("key", F.struct(F.xxhash64("key"), F.col("key"))).alias("first"),
    )
    # A sample by hash of a few rows more than there are cells, and the first row, which every group has.
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)
    some = vectors.hint("merge").join(groups, [*on, "dim"]).filter((draw < (4 * F.col("cells") + 16) / F.col("n")) | (F.col("key") == F.col("first")))
    few = Window.partitionBy(*on, "dim").orderBy(F.xxhash64("key"), "key")
    pivots = some.withColumn("_rn", F.row_number().over(few)).filter(F.col("_rn") <= F.col("cells")).select(*on, "key", "v")
    nearest = best_targets(vectors, pivots, on, 1, ("key", "v", None), ("key", "v", None)).filter("rank = 1")
    placed = vectors.hint("merge").join(nearest.select(*on, F.col("q_id").alias("key"), F.col("t_id").alias("cell")), [*on, "key"])
    blocks = pack(placed, on, "key", "v", cell="cell", block_rows=block_rows).drop("masks")
    kinds = _kinds(blocks, on)
    with small_batches(df.sparkSession):
        known = cut(blocks.select(*on, "dim", "block", "ids", "vecs").mapInPandas(
            _own_neighbors(on, wide, min_sim),
            f"{kinds}dim int, block string, ids array<string>, vecs array<double>, kth array<double>, center array<double>, radius double, needed double"))
        columns = ["block", "ids", "vecs", "kth", "center", "radius", "needed"]
        tiled = tiles(known, on, most=NEAR_ROWS, values=NEAR_VALUES, spread=NEAR_TILES)
        near = tile_pairs(tiled, on, columns, columns, _tile_neighbors(on, wide, min_sim), f"{kinds}{_NEAR}", half=True)
        out = _expanded(near, by_vector, on, k, wide, again)
        return cut(out.select(*on, "q_id", "t_id", (F.lit(0.0) - F.col("far")).alias("sim"), "rank"))


def _knn_columns(ranked: DataFrame, on: list[str], k: int) -> DataFrame:
    return ranked.filter(F.col("rank") <= k).select(*on, "q_id", "t_id", "sim", "rank")


def _own_points(on: list[str], k: int):
    """Blocks of points with their box, their longest vector and the k-th best score of each row inside the block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for blocks in batches:
            rows = []
            for b in blocks.itertuples(index=False):
                v, m = stacked([b.vecs], b.dim), np.asarray(b.masks)
                s = _scores(v, v, m, m, "euclid")
                np.fill_diagonal(s, np.where(m != 0, -np.inf, 0.0))
                n = len(v)
                kth = np.partition(s, n - k, axis=1)[:, n - k] if n >= k else np.full(n, -np.inf)
                rows.append((kth, v.min(0), v.max(0), float((v * v).sum(1).max()), float(-kth.min())))
            more = pd.DataFrame(rows, columns=["kth", "lo", "hi", "longest", "worst"])
            yield pd.concat([blocks.reset_index(drop=True), more], axis=1)

    return run


def _slack(longest):
    """What the squared distance of vectors of that squared length may be off by."""
    return 2 * NOISE + 2e-14 * longest


def _near_points(on: list[str], k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            for p in pairs.itertuples(index=False):
                q, t = stacked([p.q_vecs], p.dim), stacked([p.t_vecs], p.dim)
                q_keys, t_keys = np.asarray(p.q_ids), np.asarray(p.t_ids)
                qm, tm = np.asarray(p.q_masks), np.asarray(p.t_masks)
                s = _scores(q, t, qm, tm, "euclid")
                if p.q_block == p.t_block:
                    np.fill_diagonal(s, np.where(qm != 0, -np.inf, 0.0))
                kth = np.asarray(p.q_kth) - _slack(max(p.q_longest, p.t_longest))
                out = _lists(q_keys, t_keys, _best(s, kth, _ranks(t_keys), k, -np.inf))
                if len(out):
                    yield out.assign(**{c: getattr(p, c) for c in on})[[*on, "key", "far", "t"]]

    return run


def _places(points: DataFrame, group: list[str], axis, name: str, size) -> DataFrame:
    """Points with ``name``, the number of their stretch of ``size`` points along an axis, within ``group``."""
    numbered = dense_index(points.withColumn("_at", axis), [*group, "_at", "key"], "_no")
    first = numbered.groupBy(*group).agg(F.min("_no").alias("_first"))
    place = F.floor((F.col("_no") - F.col("_first")) / size).cast("int")
    return numbered.join(first, group).withColumn(name, place).drop("_at", "_no", "_first")


def nearest_points(df: DataFrame, row_id: str, vec: str, k: int, on: list[str] = []) -> DataFrame:
    """Exact ``k`` nearest rows by Euclidean distance, for short vectors such as positions.

    Equal points are searched once. Points are cut into strips of equal counts along the first axis and these into blocks
    along the second, so that blocks are compact. A pair of blocks is compared only if their boxes are no further apart than
    the k-th nearest point that a point of the query block has inside its block: no neighbour is lost.
    """
    if not on:
        return nearest_points(df.withColumn("whole_table", F.lit(0)), row_id, vec, k, ["whole_table"]).drop("whole_table")
    named = df.select(*on, F.col(row_id).cast("string").alias("rid"), V.as_double(F.col(vec)).alias("v"))
    vectors, by_vector, wide, again = _distinct(named.filter(F.size(vec) > 0), on, k)
    group, block_rows = [*on, "dim"], max(POINT_ROWS, 4 * wide)
    sizes = vectors.groupBy(*group).agg(F.ceil(F.sqrt(F.count("*") / block_rows) * block_rows).alias("_size"))
    in_strip = [*group, "strip"]
    strips = _places(vectors.join(sizes, group), group, F.get("v", F.lit(0)), "strip", F.col("_size"))
    second = F.get("v", F.when(F.col("dim") > 1, F.lit(1)).otherwise(F.lit(0)))
    placed = _places(strips, in_strip, second, "part", F.lit(block_rows))
    blocks = placed.groupBy(*in_strip, "part").agg(F.array_sort(F.collect_list(F.struct("key", "v", "m"))).alias("r")).select(
        *on, "dim", "strip", F.concat_ws("/", *[F.col(c).cast("string") for c in in_strip], "part").alias("block"),
        F.col("r.key").alias("ids"), F.flatten("r.v").alias("vecs"), F.col("r.m").alias("masks"))
    kinds = _kinds(blocks, on)
    with small_batches(df.sparkSession):
        known = cut(blocks.mapInPandas(
            _own_points(on, wide),
            f"{kinds}dim int, strip int, block string, ids array<string>, vecs array<double>, masks array<int>, "
            "kth array<double>, lo array<double>, hi array<double>, longest double, worst double"))
        far = F.col("worst") + 2e-14 * F.col("longest") + 4 * NOISE
        box = known.select(*group, "strip", "block", "lo", "hi", "longest", "worst")
        # Strips in reach of a block, then their blocks.
        along = box.groupBy(*group, "strip").agg(
            F.min(F.col("lo")[0]).alias("_lo"), F.max(F.col("hi")[0]).alias("_hi"), F.max("longest").alias("_longest"))
        reach = F.sqrt(far + 2e-14 * F.col("_longest")) * (1 + 1e-9)
        asked = box.select(*group, F.col("block").alias("q_block"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), "longest", "worst")
        asked = asked.join(along, group).filter(
            (F.col("_lo") <= F.col("q_hi")[0] + reach) & (F.col("_hi") >= F.col("q_lo")[0] - reach))
        met = asked.join(box.select(*group, "strip", F.col("block").alias("t_block"), "lo", "hi"), [*group, "strip"])
        gap = F.transform(
            F.arrays_zip("q_lo", "q_hi", "lo", "hi"),
            lambda x: F.greatest(F.lit(0.0), x["lo"] - x["q_hi"], x["q_lo"] - x["hi"]))
        apart = F.aggregate(gap, F.lit(0.0), lambda a, x: a + x * x)
        wanted = met.filter(apart <= (far + 2e-14 * F.col("_longest")) * (1 + 1e-9)).select("q_block", "t_block")
        q = _side(known.select(*on, "dim", "block", "ids", "vecs", "masks", F.col("kth").alias("q_kth"), F.col("longest").alias("q_longest")), "q")
        t = _side(known.select("block", "ids", "vecs", "masks", F.col("longest").alias("t_longest")), "t")
        columns = [*on, "dim", *[f"{x}_{c}" for x in "qt" for c in ("block", "ids", "vecs", "masks", "longest")], "q_kth"]
        near = wanted.join(q, "q_block").join(t, "t_block").select(*columns).mapInPandas(_near_points(on, wide), f"{kinds}{_NEAR}")
        out = cut(_expanded(near, by_vector, on, k, wide, again))
    return out.select(*on, "q_id", "t_id", F.col("far").alias("squared_distance"), "rank")
