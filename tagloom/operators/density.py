"""Density clustering (HDBSCAN) of unit vectors, distributed and exact.

1. Core distances come from the blocked neighbour search.
2. Minimum spanning trees: the tree of a complete graph lies in the union of the trees of
   all pairs of blocks, so each task solves one pair of blocks in memory and a few rounds of
   Boruvka joins finish the union.
3. The condensed tree merges edges in order of weight, level by level: the components of a
   level's edges are merged side by side, and the next level sees each as one node.
4. Selection by excess of mass resolves ancestors by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import cut
from ..sources.io import dense_index, latest_per_key
from .blocks import (
    BLOCK_ROWS, SLAB, TILE_ROWS, _ranks, _side, block_pairs, distances2, knn, pack, small_batches, stacked, tile_pairs, tiles,
)
from .graph import connected_components

FLOOR = 1e-9  # least distance, so that equal vectors do not give infinite density
SLICE_EDGES = 200_000
#: Rows of a tile of the spanning trees; a task holds the distances of two.
TREE_ROWS = 4096
#: Distance sums of a tile at most: its points times the clusters of the configurations that are taken at once.
SUM_VALUES = 1 << 23
#: Clusters of a configuration beyond which distance sums are rows, as a task could not hold a useful tile of them.
MANY_CLUSTERS = 4096
#: Clusters a configuration up to which one product sums faster than a pass over sorted columns.
FEW_CLUSTERS = 40


def _local_tree(dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of a dense symmetric matrix; ties by (smaller, larger) row."""
    n = len(dist)
    rows = np.arange(n)
    inside = np.zeros(n, dtype=bool)
    inside[0] = True
    best, parent = dist[0].copy(), np.zeros(n, dtype=np.int64)
    best[0] = np.inf
    out = []
    for _ in range(n - 1):
        low = best.min()
        tied = np.flatnonzero(best == low)
        if len(tied) > 1:
            lo, hi = np.minimum(tied, parent[tied]), np.maximum(tied, parent[tied])
            tied = tied[np.lexsort((hi, lo))]
        v = tied[0]
        out.append((parent[v], v, low))
        inside[v] = True
        best[v] = np.inf
        d = dist[v]
        key_new = np.minimum(rows, v) * n + np.maximum(rows, v)
        key_old = np.minimum(rows, parent) * n + np.maximum(rows, parent)
        closer = ~inside & ((d < best) | ((d == best) & (key_new < key_old)))
        best[closer], parent[closer] = d[closer], v
    a = np.array(out, dtype=np.float64).reshape(-1, 3)
    return a[:, 0].astype(int), a[:, 1].astype(int), a[:, 2]


def _first(best: np.ndarray, ties: np.ndarray) -> int:
    """Index of the least value, of equal ones that with the least tie."""
    i = best.argmin()
    same = np.flatnonzero(best == best[i])
    return same[ties[same].argmin()] if len(same) > 1 else i


def _pair_tree(dist: np.ndarray, q_rank: np.ndarray, t_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, weight) of the minimum spanning tree of the edges between rows and columns; ties by (smaller, larger) rank."""
    n, m = dist.shape
    # Each side: distances from the other side's nodes, least one to the tree, its edge's place among equals, its other end.
    far = [np.ascontiguousarray(dist.T), dist]
    ranks, best, ends = (q_rank, t_rank), [np.full(n, np.inf), np.full(m, np.inf)], [np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)]
    ties, inside = [np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)], [np.zeros(n, dtype=bool), np.zeros(m, dtype=bool)]
    a, b, w = (np.empty(n + m - 1, dtype=kind) for kind in (np.int64, np.int64, np.float64))

    def grow(side: int, node: int) -> None:
        inside[side][node], best[side][node] = True, np.inf
        to = 1 - side
        d, mine = far[to][node], ranks[side][node]
        near = np.flatnonzero((d <= best[to]) & ~inside[to])
        tie = np.minimum(ranks[to][near], mine) * (n + m) + np.maximum(ranks[to][near], mine)
        closer = (d[near] < best[to][near]) | (tie < ties[to][near])
        near = near[closer]
        best[to][near], ties[to][near], ends[to][near] = d[near], tie[closer], node

    grow(0, 0)
    for i in range(n + m - 1):
        x, y = _first(best[0], ties[0]), _first(best[1], ties[1])
        side = int((best[0][x], ties[0][x]) > (best[1][y], ties[1][y]))
        node = (x, y)[side]
        a[i], b[i] = (node, ends[0][node]) if side == 0 else (ends[1][node], node)
        w[i] = best[side][node]
        grow(side, node)
    return a, b, w


def _reach(q: np.ndarray, t: np.ndarray, q_core: np.ndarray, t_core: np.ndarray) -> np.ndarray:
    """Mutual reachability distances of two sets of points."""
    d = q @ t.T
    d *= -2
    d += (q * q).sum(1)[:, None]
    d += (t * t).sum(1)[None, :]
    np.round(d, 9, out=d)
    np.maximum(d, 0.0, out=d)
    np.sqrt(d, out=d)
    np.maximum(d, q_core[:, None], out=d)
    np.maximum(d, t_core[None, :], out=d)
    np.maximum(d, FLOOR, out=d)
    return np.round(d, 9, out=d)


def _tile_trees(field: str):
    def run(key: tuple, qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        head, dim, q_tile, t_tile = key
        none = pd.DataFrame({field: [], "src": [], "dst": [], "w": []}, dtype=object)
        if not len(qs) or not len(ts):
            return none
        sides = []
        for side in (qs, ts):
            ids, v, core = stacked(side["ids"]), stacked(side["vecs"], dim), stacked(side["core"]).astype(float)
            order = np.argsort(ids.astype(str), kind="stable")
            sides.append((ids[order], v[order], core[order]))
        (q_ids, q, q_core), (t_ids, t, t_core) = sides
        if q_tile == t_tile:
            if len(q_ids) < 2:
                return none
            d = _reach(q, q, q_core, q_core)
            a, b, w = _local_tree(np.maximum(d, d.T, out=d))
            a, b = q_ids[a], q_ids[b]
        else:
            rank = _ranks(np.concatenate([q_ids, t_ids]))
            a, b, w = _pair_tree(_reach(q, t, q_core, t_core), rank[:len(q_ids)], rank[len(q_ids):])
            a, b = q_ids[a], t_ids[b]
        swap = a.astype(str) > b.astype(str)
        ends = {"src": np.where(swap, b, a), "dst": np.where(swap, a, b)}
        return pd.DataFrame(ends | {"w": w}).assign(**{field: head})[[field, "src", "dst", "w"]]

    return run


def _pair_trees(field: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            for p in pairs.itertuples(index=False):
                same = p.q_block == p.t_block
                ids = np.asarray(p.q_ids) if same else np.concatenate([p.q_ids, p.t_ids])
                v = np.asarray(p.q_vecs if same else np.concatenate([p.q_vecs, p.t_vecs])).reshape(-1, p.dim)
                core = np.asarray(p.q_core if same else np.concatenate([p.q_core, p.t_core]))
                if len(ids) < 2:
                    continue
                order = np.argsort(ids.astype(str), kind="stable")
                ids, v, core = ids[order], v[order], core[order]
                sq = (v * v).sum(1)
                d = np.sqrt(np.maximum(np.round(sq[:, None] + sq[None, :] - 2 * (v @ v.T), 9), 0.0))
                d = np.maximum(np.maximum(d, core[:, None]), core[None, :])
                d = np.round(np.maximum(np.maximum(d, d.T), FLOOR), 9)
                a, b, w = _local_tree(d)
                yield pd.DataFrame({
                    field: getattr(p, field),
                    "src": ids[np.minimum(a, b)], "dst": ids[np.maximum(a, b)], "w": w,
                })

    return run


def _repeats(rows: DataFrame, key: list[str]) -> bool:
    return not rows.groupBy(*key, "rid").count().filter("count > 1").isEmpty()


def _forest_of_rows(rows: DataFrame, field: str, block_rows: int) -> DataFrame:
    """The forest where ids repeat: every row takes part, in pairs of blocks."""
    blocks = pack(rows, [field], "rid", "v", block_rows=block_rows).drop("masks")
    cores = (
        blocks.select("block", F.posexplode("ids").alias("pos", "rid"), field)
        .join(rows.select(field, "rid", "core"), [field, "rid"])
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "core"))).getField("core").alias("core"))
    )
    blocks = cut(blocks.join(cores, "block"))
    pairs = block_pairs(blocks, [field]).filter("q_block <= t_block")
    q = _side(blocks, "q").withColumnRenamed("core", "q_core")
    t = _side(blocks, "t").withColumnRenamed("core", "t_core").drop(field, "dim")
    joined = pairs.select("q_block", "t_block").join(q, "q_block").join(t, "t_block")
    kind = rows.schema[field].dataType.simpleString()
    with small_batches(rows.sparkSession):
        edges = cut(
            joined.select(field, "dim", "q_block", "t_block", "q_ids", "q_vecs", "q_core", "t_ids", "t_vecs", "t_core")
            .mapInPandas(_pair_trees(field), f"{field} {kind}, src string, dst string, w double")
        )
    edges = edges.distinct()
    points = rows.groupBy(field).agg(F.count("*").alias("n"))
    surplus = edges.groupBy(field).agg(F.count("*").alias("e")).join(points, field).filter("e > n - 1")
    return edges if surplus.isEmpty() else _boruvka(cut(edges), field)


def spanning_forest(df: DataFrame, min_samples: int, field: str = "field_name", row_id: str = "label_id",
                    vec: str = "v", block_rows: int = 512, near: DataFrame | None = None) -> DataFrame:
    """(field, src, dst, w): minimum spanning tree of the mutual reachability distances.

    Equal vectors have equal cores, and no row is nearer to one of them than they are to each other: they hang on the
    smallest id among them, and only that takes part in the search. Tasks take pairs of tiles of at least ``block_rows``, up
    to ``TREE_ROWS`` rows.
    """
    rows = df.select(field, F.col(row_id).cast("string").alias("rid"), V.as_double(F.col(vec)).alias("v"))
    if min_samples > 1:
        near = knn(rows, [field], "rid", "v", min_samples - 1) if near is None else near.filter(F.col("rank") < min_samples)
        far = near.groupBy(field, F.col("q_id").alias("rid")).agg(
            F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("sim"))).alias("core")
        )
        rows = rows.hint("merge").join(far, [field, "rid"], "left").withColumn("core", F.coalesce("core", F.lit(0.0)))
    else:
        rows = rows.withColumn("core", F.lit(0.0))
    rows = cut(rows)
    if _repeats(rows, [field]):
        return _forest_of_rows(rows, field, block_rows)
    # The least core, as products that differ in the last place may round apart.
    first = cut(rows.groupBy(field, "v").agg(F.min("rid").alias("first"), F.min("core").alias("core")))
    copies = rows.select(field, "rid", "v").hint("merge").join(first, [field, "v"]).filter("rid <> first").select(
        field, F.col("first").alias("src"), F.col("rid").alias("dst"), F.round(F.greatest(F.col("core"), F.lit(FLOOR)), 9).alias("w"))
    points = first.select(field, F.col("first").alias("rid"), "v", "core")
    blocks = pack(points, [field], "rid", "v", block_rows=block_rows).drop("masks")
    cores = (
        blocks.select("block", F.posexplode("ids").alias("pos", "rid"), field)
        .join(points.select(field, "rid", "core"), [field, "rid"])
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "core"))).getField("core").alias("core"))
    )
    blocks = cut(blocks.hint("merge").join(cores, "block"))
    kind = df.schema[field].dataType.simpleString()
    columns = ["ids", "vecs", "core"]
    with small_batches(df.sparkSession):
        edges = cut(tile_pairs(
            tiles(blocks, [field], block_rows, max(block_rows, TREE_ROWS)), [field], columns, columns, _tile_trees(field),
            f"{field} {kind}, src string, dst string, w double", half=True))
    surplus = edges.groupBy(field).agg(F.count("*").alias("e")).join(points.groupBy(field).agg(F.count("*").alias("n")), field)
    tree = edges if surplus.filter("e > n - 1").isEmpty() else _boruvka(edges, field)
    return cut(copies if tree is None else tree.select(field, "src", "dst", "w").unionByName(copies))


def _boruvka(edges: DataFrame, field: str) -> DataFrame:
    """Minimum spanning forest of an edge table; total edge order (w, src, dst)."""
    order = F.struct("w", "src", "dst")
    nodes = edges.select(field, F.col("src").alias("node")).union(edges.select(field, "dst")).distinct()
    comp = cut(nodes.withColumn("c", F.col("node")))
    rest, tree = edges, None
    while True:
        a = comp.select(field, F.col("node").alias("src"), F.col("c").alias("cs"))
        b = comp.select(field, F.col("node").alias("dst"), F.col("c").alias("cd"))
        rest = cut(rest.select(field, "src", "dst", "w").join(a, [field, "src"]).join(b, [field, "dst"]).filter("cs <> cd"))
        if rest.isEmpty():
            break
        both = rest.select(field, F.col("cs").alias("c"), F.col("cd").alias("o"), order.alias("e")).unionByName(
            rest.select(field, F.col("cd").alias("c"), F.col("cs").alias("o"), order.alias("e"))
        )
        pick = cut(both.groupBy(field, "c").agg(F.min(F.struct("e", "o")).alias("m")).select(
            field, "c", F.col("m.o").alias("to"), "m.e.w", "m.e.src", "m.e.dst"))
        new = pick.select(field, "src", "dst", "w").distinct()
        tree = cut(new if tree is None else tree.unionByName(new))
        # Two components that pick each other form the only cycle; the smaller is the root.
        back = pick.select(field, F.col("c").alias("to"), F.col("to").alias("back"))
        jump = cut(pick.select(field, "c", "to").join(back, [field, "to"], "left").select(
            field, "c", F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c")).otherwise(F.col("to")).alias("to")))
        while True:
            nxt = jump.select(field, F.col("c").alias("to"), F.col("to").alias("to2"))
            further = cut(jump.join(nxt, [field, "to"]).select(field, "c", F.col("to2").alias("to"), (F.col("to") != F.col("to2")).alias("_moved")))
            done = further.filter("_moved").isEmpty()
            jump = further.drop("_moved")
            if done:
                break
        comp = cut(comp.join(jump, [field, "c"], "left").select(field, "node", F.coalesce("to", "c").alias("c")))
    return tree


_CLUSTER = "{key}, kind string, item string, cluster string, lam double, size long, comp string, mass double, below double"


def _merge_slice(key: list[str]):
    """Merge the edges of one slice in order; rows are edges and component states."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {k: pdf[k].iloc[0] for k in key}
        mcs = int(pdf["mcs"].iloc[0])
        st = pdf[pdf["kind"] == "state"]
        size = dict(zip(st["comp"], st["size"].astype(int)))
        cluster = {c: x if isinstance(x, str) else None for c, x in zip(st["comp"], st["cluster"])}
        mass = dict(zip(st["comp"], st["mass"]))
        below = dict(zip(st["comp"], st["below"]))
        root = {c: c for c in size}
        small = {c: [c] for c in size if cluster[c] is None}
        rows = []

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def emit(kind, item, clus, lam, n):
            rows.append((kind, item, clus, lam, n))

        e = pdf[pdf["kind"] == "edge"].sort_values(["w", "src", "dst"])
        for src, dst, w in zip(e["src"], e["dst"], e["w"]):
            a, b = find(src), find(dst)
            lam = 1.0 / max(w, FLOOR)
            ca, cb = cluster[a], cluster[b]
            n = size[a] + size[b]
            new = min(a, b)
            other = b if new == a else a
            if ca and cb:
                # A split seen from above: both clusters are born here, their mass is final.
                total = 0.0
                name = f"c|{new}|{n}"
                for x in (a, b):
                    stability = mass[x] - size[x] * lam
                    total += max(stability, below[x])
                    emit("child", cluster[x], name, lam, size[x])
                    emit("wins", cluster[x], None, stability if stability >= below[x] else -1.0, size[x])
                cluster[new], mass[new], below[new] = name, n * lam, total
            elif ca or cb:
                big, lost = (a, b) if ca else (b, a)
                for c in small.pop(lost, []):
                    emit("point", c, cluster[big], lam, 1)
                cluster[new], mass[new], below[new] = cluster[big], mass[big] + size[lost] * lam, below[big]
            elif n >= mcs:
                name = f"c|{new}|{n}"
                for x in (a, b):
                    for c in small.pop(x, []):
                        emit("point", c, name, lam, 1)
                cluster[new], mass[new], below[new] = name, n * lam, 0.0
            else:
                small[new] = small.pop(a, []) + small.pop(b, [])
                cluster[new], mass[new], below[new] = None, 0.0, 0.0
            root[other] = new
            size[new] = n
        out = pd.DataFrame(rows, columns=["kind", "item", "cluster", "lam", "size"])
        live = [
            ("comp", c, cluster[find(c)], 0.0, size[find(c)], find(c), mass[find(c)], below[find(c)]) for c in root
        ]
        state = pd.DataFrame(live, columns=["kind", "item", "cluster", "lam", "size", "comp", "mass", "below"])
        both = pd.concat([out, state], ignore_index=True)
        for k, v in head.items():
            both[k] = v
        return both[[*key, "kind", "item", "cluster", "lam", "size", "comp", "mass", "below"]]

    return run


def _levels(edges: DataFrame, key: list[str], slice_edges: int) -> DataFrame:
    """Edges with ``level``: the lighter half of a tree's edges, then half of what is left, until a slice holds the rest."""
    numbered = dense_index(edges, [*key, "w", "src", "dst"], "_no")
    counts = numbered.groupBy(*key).agg(F.min("_no").alias("_first"), F.count("*").alias("_n"))
    left = F.col("_n") - (F.col("_no") - F.col("_first"))
    last = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("_n") / F.lit(slice_edges))))
    level = F.least(F.floor(F.log2(F.col("_n") / left)), last).cast("int")
    return cut(numbered.join(counts, key).withColumn("level", level).drop("_no", "_first", "_n"))


def _units(edges: DataFrame, key: list[str], slice_edges: int) -> DataFrame:
    """Edges of one level with ``unit``, the component they belong to, and ``sub``, their slice within it.

    Components of a level do not touch each other, so each is a task of its own; one with more edges than a slice is taken
    slice after slice.
    """
    name = [F.concat_ws("\x1f", *key, c) for c in ("cs", "cd")]
    units = connected_components(edges.select(name[0].alias("src"), name[1].alias("dst")))
    placed = edges.withColumn("node", name[0]).join(units, "node").withColumnRenamed("component", "unit").drop("node", "cs", "cd")
    numbered = dense_index(placed, [*key, "unit", "w", "src", "dst"], "_no")
    first = numbered.groupBy(*key, "unit").agg(F.min("_no").alias("_first"))
    sub = F.floor((F.col("_no") - F.col("_first")) / F.lit(slice_edges)).cast("int")
    return cut(numbered.join(first, [*key, "unit"]).withColumn("sub", sub).drop("_no", "_first"))


def _without_copies(points: DataFrame, least: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(where, state, log) after the edges of the least length, which join equal vectors: these merge at once, in any order."""
    where = points.select(*key, "rid", F.col("rid").alias("comp"))
    log = None
    if least.isEmpty():
        state = points.select(*key, F.col("rid").alias("comp"), F.lit(1).cast("bigint").alias("size"), F.lit(None).cast("string").alias("cluster"))
    else:
        least = cut(least)
        named = [F.concat_ws("\x1f", *key, c) for c in ("src", "dst")]
        merged = connected_components(least.select(named[0].alias("src"), named[1].alias("dst")))
        where = where.withColumn("node", F.concat_ws("\x1f", *key, "rid")).join(merged, "node", "left")
        own = F.concat_ws("\x1f", *key, F.lit(""))
        where = cut(where.select(*key, "rid", F.when(F.col("component").isNull(), F.col("rid")).otherwise(
            F.substr("component", F.char_length(own) + 1)).alias("comp")))
        mcs = least.groupBy(*key).agg(F.first("mcs").alias("mcs"))
        sizes = where.groupBy(*key, "comp").agg(F.count("*").alias("size")).join(mcs, key, "left")
        name = F.concat(F.lit("c|"), F.col("comp"), F.lit("|"), F.col("size").cast("string"))
        state = cut(sizes.select(*key, "comp", "size", F.when((F.col("size") > 1) & (F.col("size") >= F.col("mcs")), name).alias("cluster")))
        born = state.filter("cluster IS NOT NULL").select(*key, "comp", "cluster")
        log = cut(where.join(born, [*key, "comp"]).select(
            *key, F.lit("point").alias("kind"), F.col("rid").alias("item"), "cluster", F.lit(1.0 / FLOOR).alias("lam"), F.lit(1).cast("bigint").alias("size")))
    mass = F.when(F.col("cluster").isNotNull(), F.col("size") / F.lit(FLOOR)).otherwise(F.lit(0.0))
    return where, state.withColumns({"mass": mass, "below": F.lit(0.0)}), log


def condense(points: DataFrame, edges: DataFrame, key: list[str], slice_edges: int = SLICE_EDGES) -> DataFrame:
    """Clusters of spanning trees: (key, rid, cluster_id, probability); -1 is noise.

    ``points`` (key, rid), ``edges`` (key, src, dst, w, mcs). Edges are merged level by level: a level's lighter edges fall
    into components that are merged side by side, so a tree is as many tasks as it has components there, and the next level
    sees each as one node. A component that is smaller than ``mcs`` keeps its points as separate members until it joins or
    forms a cluster. The result does not depend on ``slice_edges``.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.select(*key).schema.fields)
    # Where ids repeat, every row keeps its edges.
    copies = F.lit(False) if _repeats(points, key) else F.col("w") <= FLOOR
    where, state, log = _without_copies(points, edges.filter(copies), key)
    ranked = _levels(edges.filter(~copies), key, slice_edges)
    n_levels = (ranked.agg(F.max("level")).first()[0] or 0) + 1 if not ranked.isEmpty() else 0

    def placed(part: DataFrame) -> DataFrame:
        a = where.select(*key, F.col("rid").alias("src"), F.col("comp").alias("cs"))
        b = where.select(*key, F.col("rid").alias("dst"), F.col("comp").alias("cd"))
        return part.join(a, [*key, "src"]).join(b, [*key, "dst"])

    for level in range(n_levels):
        part = ranked.filter(F.col("level") == level).drop("level")
        last = level + 1 == n_levels
        part = part.withColumns({"unit": F.lit(""), "sub": F.lit(0)}) if last else _units(cut(placed(part)), key, slice_edges)
        n_sub = 1 if last else (part.agg(F.max("sub")).first()[0] or 0) + 1
        for i in range(n_sub):
            e = placed(part.filter(F.col("sub") == i)).select(
                *key, "unit", F.lit("edge").alias("kind"), F.col("cs").alias("src"), F.col("cd").alias("dst"), "w", "mcs",
                *[F.lit(None).cast(t).alias(c) for c, t in (("comp", "string"), ("size", "bigint"), ("cluster", "string"), ("mass", "double"), ("below", "double"))],
            )
            touched = e.select(*key, "unit", F.col("src").alias("comp"), "mcs").union(e.select(*key, "unit", "dst", "mcs")).distinct()
            s = state.join(touched, [*key, "comp"]).select(
                *key, "unit", F.lit("state").alias("kind"), F.lit(None).cast("string").alias("src"),
                F.lit(None).cast("string").alias("dst"), F.lit(None).cast("double").alias("w"), "mcs",
                "comp", "size", "cluster", "mass", "below",
            )
            out = cut(e.unionByName(s).groupBy(*key, "unit").applyInPandas(_merge_slice(key), _CLUSTER.format(key=kinds)))
            events = out.filter("kind <> 'comp'").select(*key, "kind", "item", "cluster", "lam", "size")
            # A component below mcs stands for all its points; events name components.
            names = where.select(*key, F.col("comp").alias("item"), "rid")
            points_out = events.filter("kind = 'point'").join(names, [*key, "item"]).select(
                *key, "kind", F.col("rid").alias("item"), "cluster", "lam", "size")
            part_log = points_out.unionByName(events.filter("kind <> 'point'"))
            log = cut(part_log if log is None else log.unionByName(part_log))
            moved = out.filter("kind = 'comp'").select(*key, F.col("item").alias("comp"), F.col("comp").alias("_to"))
            merged = out.filter("kind = 'comp'").select(*key, "comp", "size", "cluster", "mass", "below").distinct()
            if not last:
                state = cut(state.join(moved, [*key, "comp"], "left_anti").unionByName(merged))
                where = cut(where.join(moved, [*key, "comp"], "left").select(*key, "rid", F.coalesce("_to", "comp").alias("comp")))
    if log is None:
        return points.select(*key, "rid", F.lit(-1).alias("cluster_id"), F.lit(0.0).alias("probability"))
    return _select(points, log, key)


def _select(points: DataFrame, log: DataFrame, key: list[str]) -> DataFrame:
    """Topmost winning ancestor of each point's cluster, by pointer doubling."""
    parent = log.filter("kind = 'child'").select(*key, F.col("item").alias("c"), F.col("cluster").alias("up"))
    wins = log.filter("kind = 'wins' AND lam >= 0").select(*key, F.col("item").alias("c"), F.col("item").alias("top"))
    tree = cut(parent.join(wins, [*key, "c"], "left"))
    while True:
        nxt = tree.select(*key, F.col("c").alias("up"), F.col("up").alias("up2"), F.col("top").alias("top2"))
        stepped = cut(tree.join(nxt, [*key, "up"], "left").select(
            *key, "c", F.coalesce("up2", "up").alias("up"), F.coalesce("top2", "top").alias("top"),
            (F.col("up2").isNotNull()).alias("_moved")))
        done = stepped.filter("_moved").isEmpty()
        tree = stepped.drop("_moved")
        if done:
            break
    death = log.filter("kind IN ('point', 'child')").groupBy(*key, F.col("cluster").alias("top")).agg(F.max("lam").alias("dead"))
    fell = log.filter("kind = 'point'").select(*key, F.col("item").alias("rid"), F.col("cluster").alias("c"), "lam")
    own = fell.join(tree.select(*key, "c", "top"), [*key, "c"], "left").filter("top IS NOT NULL").join(death, [*key, "top"])
    sizes = own.groupBy(*key, "top").agg(F.count("*").alias("n"), F.min("rid").alias("first"))
    order = Window.partitionBy(*key).orderBy(F.col("n").desc(), F.col("first"))
    ids = sizes.withColumn("cluster_id", F.row_number().over(order) - 1).select(*key, "top", "cluster_id")
    got = own.join(ids, [*key, "top"]).select(
        *key, "rid", "cluster_id", (F.least("lam", "dead") / F.col("dead")).alias("probability")
    )
    return points.select(*key, "rid").join(got, [*key, "rid"], "left").select(
        *key, "rid", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), F.coalesce("probability", F.lit(0.0)).alias("probability")
    )


def density_cluster(df: DataFrame, min_cluster_size: int = 5, min_samples: int = 2, field: str = "field_name",
                    row_id: str = "label_id", vec: str = "v") -> DataFrame:
    """HDBSCAN per field: (field, row id, base_cluster_id, base_cluster_probability).

    Ids count from 0 per field by size, then by least member; the whole field is never one
    cluster.
    """
    edges = spanning_forest(df, min_samples, field, row_id, vec).withColumn("mcs", F.lit(min_cluster_size))
    points = df.select(field, F.col(row_id).cast("string").alias("rid"))
    out = condense(points, edges, [field])
    return out.select(
        field, F.col("rid").alias(row_id), F.col("cluster_id").alias("base_cluster_id"),
        F.col("probability").alias("base_cluster_probability"),
    )


# -- quality and tuning ---------------------------------------------------------------------


def _sums(ids, own, clusters: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    rows = len(ids)
    return pd.DataFrame({"rid": ids, "own": own, "c": [clusters] * rows, "total": list(totals), "n": [counts] * rows})


def _distance_sums(key: list[str]):
    def run(names: tuple, qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        dim, q_tile, t_tile = names[len(key):]
        columns = [*key, "rid", "own", "c", "total", "n"]
        if not len(qs) or not len(ts):
            return pd.DataFrame({c: [] for c in columns}, dtype=object)
        sides = []
        for side in (qs, ts):
            ids, v, own = stacked(side["ids"]), stacked(side["vecs"], dim), stacked(side["masks"]).astype(np.int64)
            order = np.argsort(own, kind="stable")
            clusters, first, counts = np.unique(own[order], return_index=True, return_counts=True)
            sides.append((ids[order], v[order], own[order], clusters, first, counts))
        (q_ids, q, q_own, qc, _, qn), (t_ids, t, t_own, tc, first, tn) = sides
        back, found = np.zeros((len(t), len(qc))), []
        place, slab = np.searchsorted(qc, q_own), max(1, SLAB // len(t))
        for a in range(0, len(q), slab):
            d = np.sqrt(np.maximum(np.round(distances2(q[a:a + slab], t), 9), 0.0))
            found.append(_sums(q_ids[a:a + slab], q_own[a:a + slab], tc, np.add.reduceat(d, first, axis=1), tn))
            here = place[a:a + slab]
            starts = np.flatnonzero(np.r_[True, here[1:] != here[:-1]])
            back[:, here[starts]] += np.add.reduceat(d, starts, axis=0).T
        if q_tile != t_tile:
            found.append(_sums(t_ids, t_own, qc, back, qn))
        return pd.concat(found, ignore_index=True).assign(**dict(zip(key, names)))[columns]

    return run


def _own_facts(side: pd.DataFrame, dim: int, configs: int):
    """(vectors, weights, clusters by configuration) of a tile, its points in order of their ids."""
    ids, v = stacked(side["ids"]), stacked(side["vecs"], dim)
    facts = stacked(side["facts"]).astype(np.int64).reshape(-1, 1 + configs)
    order = np.argsort(ids.astype(str), kind="stable")
    return v[order], facts[order, 0].astype(np.float64), facts[order, 1:]


def _columns(own: np.ndarray, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each configuration: points in order of their cluster, where clusters begin, the clusters, their weights."""
    found = []
    for mine in own.T:
        order = np.argsort(mine, kind="stable")
        order = order[np.searchsorted(mine[order], 0):]  # without noise
        clusters, first = np.unique(mine[order], return_index=True)
        n = np.add.reduceat(weight[order], first) if len(order) else np.zeros(0)
        found.append((order, first, clusters, n))
    return found


def _sums_to(d: np.ndarray, columns, weight: np.ndarray) -> np.ndarray:
    """Sums of the columns of ``d`` times their weights by cluster, configuration after configuration."""
    many = sum(len(c[2]) for c in columns)
    if many <= FEW_CLUSTERS * len(columns):
        place, start = np.zeros((d.shape[1], many)), 0
        for order, first, clusters, _ in columns:
            sizes = np.diff(np.r_[first, len(order)])
            place[order, start + np.repeat(np.arange(len(clusters)), sizes)] = weight[order]
            start += len(clusters)
        return d @ place
    d = d * weight
    return np.hstack([np.add.reduceat(d[:, order], first, axis=1) for order, first, _, _ in columns if len(order)])


def _tile_sums(key: list[str], configs: int):
    """Distance sums of the points of either tile to the clusters in the other one, in all configurations, from one product."""
    names = [*key, "dim", "tile", "own", "weight", "config", "cluster", "place", "n", "sums"]

    def run(head: tuple, qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        dim, q_tile, t_tile = head[len(key):]
        if not len(qs) or not len(ts):
            return pd.DataFrame({c: [] for c in names}, dtype=object)
        (q, qw, q_own), (t, tw, t_own) = (_own_facts(x, dim, configs) for x in (qs, ts))
        # Configurations that agree on both tiles have the same sums.
        _, lead, of = np.unique(np.concatenate([q_own, t_own]), axis=1, return_index=True, return_inverse=True)
        of = of.reshape(-1)
        qc, tc = _columns(q_own[:, lead], qw), _columns(t_own[:, lead], tw)
        there = np.empty((len(q), sum(len(c[2]) for c in tc)))
        back = np.zeros((len(t), sum(len(c[2]) for c in qc)))
        slab = max(1, SLAB // len(t))
        for a in range(0, len(q), slab):
            d = np.sqrt(np.maximum(np.round(distances2(q[a:a + slab], t), 9), 0.0))
            there[a:a + slab] = _sums_to(d, tc, tw)
            if q_tile != t_tile:
                part = _columns(q_own[a:a + slab, lead], qw[a:a + slab])
                starts = np.cumsum([0, *[len(c[2]) for c in qc]])
                at = [starts[i] + np.searchsorted(qc[i][2], c[2]) for i, c in enumerate(part)]
                back[:, np.concatenate(at)] += _sums_to(np.ascontiguousarray(d.T), part, qw[a:a + slab])

        def told(tile, own, weight, columns, sums):
            starts, each = np.cumsum([0, *[len(c[2]) for c in columns]]), [columns[i] for i in of]
            parts = (
                own, weight, np.repeat(np.arange(configs), [len(c[2]) for c in each]), np.concatenate([c[2] for c in each]),
                np.concatenate([starts[i] + np.arange(len(columns[i][2])) for i in of]), np.concatenate([c[3] for c in each]), sums)
            kinds = (np.int64, np.float64, np.int64, np.int64, np.int64, np.float64, np.float64)
            return (*head[:len(key)], dim, tile, *[np.ascontiguousarray(x, dtype=k).tobytes() for x, k in zip(parts, kinds)])

        out = [told(q_tile, q_own, qw, tc, there)]
        if q_tile != t_tile:
            out.append(told(t_tile, t_own, tw, qc, back))
        return pd.DataFrame(out, columns=names)

    return run


def _tile_silhouettes(key: list[str], sizes: list[int]):
    """Sums of the silhouettes of a tile's points by configuration; a tile's rows follow each other."""
    starts = np.cumsum([0, *sizes])

    def finish(head, own, weight, total, n) -> pd.DataFrame:
        rows = []
        for j in range(len(sizes)):
            some = own[:, j] >= 0
            mine, w = own[some, j], weight[some]
            if not len(mine):
                continue
            size, mean, at = n[starts[j]:starts[j + 1]], total[some, starts[j]:starts[j + 1]], np.arange(len(mine))
            inside = mean[at, mine] / np.where(size[mine] > 1, size[mine] - 1, 1.0)
            mean = np.where(size > 0, mean / np.where(size > 0, size, 1.0), np.inf)
            mean[at, mine] = np.inf
            other = mean.min(1)
            far = np.maximum(inside, other)
            fine = (size[mine] > 1) & (other < np.inf) & (far > 0)
            s = np.where(fine, (np.where(fine, other, 0.0) - inside) / np.where(fine, far, 1.0), 0.0)
            rows.append((*head, j, float((s * w).sum()), int(w.sum()), int((other < np.inf).sum())))
        return pd.DataFrame(rows, columns=[*key, "config", "total", "points", "others"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                now = tuple(getattr(r, c) for c in (*key, "dim", "tile"))
                if now != at:
                    if held:
                        yield finish(at[:len(key)], *held)
                    weight = np.frombuffer(r.weight)
                    own = np.frombuffer(r.own, dtype=np.int64).reshape(len(weight), -1)
                    at, held = now, (own, weight, np.zeros((len(weight), starts[-1])), np.zeros(starts[-1]))
                config, cluster, place = (np.frombuffer(x, dtype=np.int64) for x in (r.config, r.cluster, r.place))
                held[2][:, starts[config] + cluster] += np.frombuffer(r.sums).reshape(len(held[1]), -1)[:, place]
                held[3][starts[config] + cluster] += np.frombuffer(r.n)
        if held:
            yield finish(at[:len(key)], *held)

    return run


def silhouettes(rows: DataFrame, key: list[str], sizes: list[int]) -> DataFrame:
    """(key, config, silhouette, points): mean silhouette of the clustered points of each configuration and key.

    ``rows`` (key, rid, v, own) with ids that do not repeat; ``own`` has each configuration's cluster, from 0 to below its
    ``sizes``, or -1. Points with equal vectors and clusters are one point with a weight. The distances of a pair of tiles
    serve all configurations; a task holds the sums of one tile, and the sums of a tile from the others are added one by one.
    """
    points = rows.filter(F.col("v").isNotNull()).groupBy(*key, "v", "own").agg(F.min("rid").alias("rid"), F.count("*").alias("w"))
    points = points.select(*key, "rid", "v", F.concat(F.array("w"), F.col("own").cast("array<bigint>")).alias("facts"))
    kinds, columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*key).schema.fields), ["ids", "vecs", "facts"]
    blocks = cut(pack(points, key, "rid", "v", facts="facts"))
    most = min(TILE_ROWS, max(BLOCK_ROWS, SUM_VALUES // max(1, sum(sizes))))
    binary = ", ".join(f"{c} binary" for c in ("own", "weight", "config", "cluster", "place", "n", "sums"))
    place = [*key, "dim", "tile"]
    with small_batches(rows.sparkSession, 2):
        sums = tile_pairs(
            tiles(blocks, key, most=most), key, columns, columns, _tile_sums(key, len(sizes)), f"{kinds}, dim int, tile int, {binary}", half=True)
        each = cut(sums.repartition(*place).sortWithinPartitions(*place).mapInPandas(
            _tile_silhouettes(key, sizes), f"{kinds}, config int, total double, points bigint, others bigint"))
    return each.groupBy(*key, "config").agg(
        F.when(F.sum("others") > 0, F.sum("total") / F.sum("points")).otherwise(-1.0).alias("silhouette"), F.sum("points").alias("points"))


def silhouette(df: DataFrame, key: list[str], row_id: str, vec: str, cluster: str) -> DataFrame:
    """Mean silhouette (Euclidean) of all clustered points per key.

    -1 with fewer than two clusters. Pairs of tiles, each taken once for both sides, give distance sums per point and
    cluster; no pair of points is a row.
    """
    rows = df.filter(F.col(cluster) != -1)
    named = cut(rows.select(*key, F.col(row_id).cast("string").alias("rid"), V.as_double(F.col(vec)).alias("v"), F.col(cluster).cast("int").alias("c")))
    clusters = cut(named.dropna(subset=key).select(*key, "c").distinct().withColumn(
        "code", F.row_number().over(Window.partitionBy(*key).orderBy("c")) - 1))
    size = (clusters.agg(F.max("code")).first()[0] or 0) + 1
    if size > MANY_CLUSTERS or _repeats(named, key):
        return _silhouette_of_rows(named, key)
    placed = named.join(clusters, [*key, "c"]).select(*key, "rid", "v", F.array("code").alias("own"))
    return silhouettes(placed, key, [size]).drop("config")


def _silhouette_of_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """The silhouette where ids repeat, or with so many clusters that distance sums are rows: every row (key, rid, v, c) takes part."""
    blocks = cut(pack(rows, key, "rid", "v", mask="c"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*key).schema.fields)
    columns = ["ids", "vecs", "masks"]
    with small_batches(rows.sparkSession):
        sums = cut(tile_pairs(
            tiles(blocks, key), key, columns, columns, _distance_sums(key),
            f"{kinds}, rid string, own int, c array<int>, total array<double>, n array<bigint>", half=True))
    each = sums.select(*key, "rid", "own", F.explode(F.arrays_zip("c", "total", "n")).alias("x")).select(*key, "rid", "own", "x.*")
    per = each.groupBy(*key, "rid", "own", "c").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    point = per.groupBy(*key, "rid").agg(
        F.max(F.when(F.col("c") == F.col("own"), F.when(F.col("n") > 1, F.col("total") / (F.col("n") - 1)))).alias("a"),
        F.min(F.when(F.col("c") != F.col("own"), F.col("total") / F.col("n"))).alias("b"),
    )
    s = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)))
    return point.groupBy(*key).agg(
        F.when(F.count("b") > 0, F.avg(s)).otherwise(F.lit(-1.0)).alias("silhouette"), F.count("*").alias("points")
    )


def _grid_silhouettes(found: DataFrame, rows: DataFrame, field: str) -> DataFrame:
    """Silhouettes of the configurations of ``found`` (field, config, rid, cluster_id) over ``rows`` (field, rid, v)."""
    vectors, key = rows.select(field, "rid", V.as_double(F.col("v")).alias("v")), [field, "config"]
    counts = found.groupBy("config").agg((F.max("cluster_id") + 1).alias("n")).filter("n > 0").orderBy("config").collect()  # the grid
    many = max([r["n"] for r in counts], default=0)
    if not counts or many > MANY_CLUSTERS or _repeats(rows, [field]):
        return silhouette(found.join(vectors, [field, "rid"]), key, "rid", "v", "cluster_id")
    groups, room = [], 0
    for r in counts:
        if r["n"] > room:
            groups, room = [*groups, []], SUM_VALUES // TILE_ROWS
        groups[-1].append(r)
        room -= r["n"]
    out = None
    for group in groups:
        own = [F.coalesce(F.max(F.when(F.col("config") == r["config"], F.col("cluster_id"))), F.lit(-1)).cast("int") for r in group]
        clusters = found.filter("cluster_id <> -1").groupBy(field, "rid").agg(F.array(*own).alias("own"))
        got = silhouettes(vectors.hint("merge").join(clusters, [field, "rid"]), [field], [r["n"] for r in group])
        names = F.array(*[F.lit(r["config"]) for r in group])
        got = got.withColumn("config", names[F.col("config")])
        out = got if out is None else out.unionByName(got)
    return out


def tune_density(df: DataFrame, sizes: list[int], samples: list[int], field: str = "field_name",
                 row_id: str = "label_id", vec: str = "v") -> tuple[DataFrame, DataFrame]:
    """Best of a grid of configurations per field: (labels, scores of all configurations).

    One spanning tree per ``min_samples`` serves all sizes, which are condensed together; one neighbour search and the
    distances of one pass serve all configurations.
    Fields of fewer than ten labels take 5 and 2. Tuned labels carry no probability.
    """
    n_rows = df.groupBy(field).agg(F.count("*").alias("n"))
    rows = cut(df.select(field, F.col(row_id).cast("string").alias("rid"), F.col(vec).alias("v")).join(n_rows, field))
    spark = df.sparkSession
    found, every = None, sorted(set(samples) | {2})
    near = knn(rows, [field], "rid", "v", every[-1] - 1)
    for ms in every:
        grid = [(s, ms) for s in sorted(set(sizes) | {5}) if ms <= s]
        configs = spark.createDataFrame(grid, "mcs int, ms int")
        ok = (F.col("n") >= 10) & F.col("mcs").isin(sizes) & F.col("ms").isin(samples) & (F.col("mcs") < F.greatest(F.lit(10), F.floor(F.col("n") / 2)))
        default = (F.col("n") < 10) & (F.col("mcs") == 5) & (F.col("ms") == 2)
        # The grid is a handful of rows.
        keyed = n_rows.join(F.broadcast(configs)).filter(ok | default).select(
            field, "mcs", "ms", F.concat_ws("/", F.col("mcs").cast("string"), F.col("ms").cast("string")).alias("config"))
        forest = spanning_forest(rows, ms, field, "rid", "v", near=near)
        edges = forest.join(keyed, field).select(field, "config", "src", "dst", "w", "mcs")
        points = rows.select(field, "rid").join(keyed, field).select(field, "config", "rid")
        got = condense(points, edges, [field, "config"])
        found = got if found is None else found.unionByName(got)
    found = cut(found)
    key = [field, "config"]
    stats = found.join(n_rows, field).groupBy(*key, "n").agg(
        F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("n_clusters"),
        F.count_if(F.col("cluster_id") == -1).alias("anomaly_count"),
    )
    largest = found.filter("cluster_id <> -1").groupBy(*key, "cluster_id").count().groupBy(*key).agg(
        F.max("count").alias("largest_cluster_size"))
    sil = _grid_silhouettes(found, rows, field)
    n = F.col("n")
    ratio, big = F.col("anomaly_ratio"), F.col("largest_cluster_ratio")
    enough = (F.col("n_clusters") >= 2) & (
        (n - F.col("anomaly_count")) >= F.greatest(F.lit(10), F.least(F.lit(50), F.floor(n / 10))))
    parts = F.split("config", "/")
    scores = stats.join(largest, key, "left").join(sil, key, "left").withColumns({
        "largest_cluster_size": F.coalesce("largest_cluster_size", F.lit(0)),
        "anomaly_ratio": F.col("anomaly_count") / n,
        "silhouette": F.when(enough, F.coalesce("silhouette", F.lit(-1.0))).otherwise(F.lit(-1.0)),
        "min_cluster_size": parts[0].cast("int"), "min_samples": parts[1].cast("int"),
    }).withColumn("largest_cluster_ratio", F.col("largest_cluster_size") / n).withColumn(
        "score",
        F.col("silhouette") + (1 - ratio) * 0.25 - F.greatest(F.lit(0.0), ratio - 0.65) * 0.8
        - F.greatest(F.lit(0.0), 0.03 - ratio) - F.greatest(F.lit(0.0), big - 0.20) * 1.2
        - F.greatest(F.lit(0), 8 - F.col("n_clusters")) * 0.03,
    )
    scores = cut(scores)
    best = latest_per_key(scores, [field], [F.round("score", 9).desc(), F.col("min_cluster_size"), F.col("min_samples")])
    labels = found.join(best.select(*key), key, "left_semi").select(
        field, F.col("rid").alias(row_id), F.col("cluster_id").alias("base_cluster_id"),
        F.lit(None).cast("double").alias("base_cluster_probability"),
    )
    return labels, scores
