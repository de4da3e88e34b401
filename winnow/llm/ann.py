"""Approximate nearest neighbours by NN-descent and greedy graph search.

Distinct vectors are dealt out to shards of bounded size.  Each shard's neighbour graph starts from random neighbours and
is refined in rounds: a Spark join on the node in the middle pairs neighbours of one node, and each pair is offered to both
ends.  A query walks every shard's graph greedily, best first, and the shards' finds are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.session import materialize

SHARD_ROWS = 4096
DEGREE = 20
SAMPLE = 8  # fresh neighbours of a node that a round tries; twice as many of those that point at it
ROUNDS = 10
SETTLED = 0.005  # share of links that changed in a round, below which the graph is done
BEAM = 160
SEEDS = 32
EXPAND = 4
QUERY_ROWS = 512
SEED = 11

OLD, TRIED, WAITING = 0, 1, 2
STATE = "shard int, node long, vector array<double>, near array<long>, distance array<double>, mark array<int>, changed int"


def usable(vector: str) -> Column:
    """The vector as doubles; null for those that are null, empty, zero or hold null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    return F.when(F.coalesce(fine & some, F.lit(False)), F.transform(vector, lambda x: x.cast("double")))


# ---- one shard --------------------------------------------------------------------------------


def _matrix(lists: pa.ChunkedArray, rows: int) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _distances(vectors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for at in range(0, len(a), 1 << 16):
        some = slice(at, at + (1 << 16))
        gap = vectors[a[some]] - vectors[b[some]]
        out[some] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _state(shard: int, ids: np.ndarray, vectors: np.ndarray, u, v, d, mark, changed: np.ndarray, seed: list[int]) -> pa.Table:
    """State rows from links sorted by u; a sample of each node's waiting links is marked to be tried next."""
    rng = np.random.default_rng(seed)
    waiting = np.flatnonzero(mark == WAITING)
    waiting = waiting[np.lexsort((rng.random(len(waiting)), u[waiting]))]
    mark = mark.copy()
    mark[waiting[_rank_in_run(u[waiting]) < SAMPLE]] = TRIED
    ends = pa.array(np.searchsorted(u, np.arange(len(ids) + 1)), pa.int32())
    rows = lambda values, kind: pa.ListArray.from_arrays(ends, pa.array(values, kind))
    width = vectors.shape[1]
    return pa.table(
        {
            "shard": pa.array(np.full(len(ids), shard), pa.int32()),
            "node": pa.array(ids, pa.int64()),
            "vector": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * width, pa.int32()), pa.array(vectors.ravel())),
            "near": rows(ids[v], pa.int64()),
            "distance": rows(d, pa.float64()),
            "mark": rows(mark, pa.int32()),
            "changed": pa.array(changed, pa.int32()),
        }
    )


def _rank_in_run(sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.empty(0, int)
    heads = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return np.arange(len(sorted_keys)) - np.repeat(heads, np.diff(np.r_[heads, len(sorted_keys)]))


def _nearest(n: int, u, v, d, mark):
    """The ``DEGREE`` nearest of each node's links, without repeats; an older link stands before its repeat."""
    order = np.lexsort((mark, v, u))
    u, v, d, mark = u[order], v[order], d[order], mark[order]
    first = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])] if len(u) else np.empty(0, bool)
    u, v, d, mark = u[first], v[first], d[first], mark[first]
    order = np.lexsort((v, d, u))
    u, v, d, mark = u[order], v[order], d[order], mark[order]
    kept = _rank_in_run(u) < DEGREE
    return u[kept], v[kept], d[kept], mark[kept]


def _start(key: tuple, rows: pa.Table) -> pa.Table:
    """Random neighbours, a new draw for each node, in node order whatever the order of arrival."""
    rows = rows.sort_by("node")
    ids, vectors = rows.column("node").to_numpy(), _matrix(rows.column("vector"), len(rows))
    n, rng = len(ids), np.random.default_rng([SEED, key[0].as_py()])
    u = np.repeat(np.arange(n), DEGREE)
    v = (u + rng.integers(1, n, len(u))) % n if n > 1 else u
    u, v = u[u != v], v[u != v]
    u, v, d, mark = _nearest(n, u, v, _distances(vectors, u, v), np.full(len(u), WAITING))
    return _state(key[0].as_py(), ids, vectors, u, v, d, mark, np.zeros(n, int), [SEED, key[0].as_py(), 0])


def _refine(round_no: int, key: tuple, state: pa.Table, pairs: pa.Table) -> pa.Table:
    """Offer each pair to both of its ends."""
    state = state.sort_by("node")
    ids, vectors = state.column("node").to_numpy(), _matrix(state.column("vector"), len(state))
    n = len(ids)
    near = state.column("near").combine_chunks()
    u = np.repeat(np.arange(n), np.diff(near.offsets.to_numpy()))
    v = np.searchsorted(ids, near.flatten().to_numpy())
    d = state.column("distance").combine_chunks().flatten().to_numpy()
    mark = state.column("mark").combine_chunks().flatten().to_numpy().copy()
    mark[mark == TRIED] = OLD
    ends = np.searchsorted(ids, pairs.column("a").to_numpy()) * n + np.searchsorted(ids, pairs.column("b").to_numpy())
    ends = np.unique(ends)
    a, b = ends // n, ends % n
    dist = _distances(vectors, a, b)
    offered = np.full(2 * len(a), WAITING + 1)
    u, v, d, mark = _nearest(n, np.r_[u, a, b], np.r_[v, b, a], np.r_[d, dist, dist], np.r_[mark, offered])
    changed = np.bincount(u[mark == WAITING + 1], minlength=n)
    mark[mark == WAITING + 1] = WAITING
    shard = key[0].as_py()
    return _state(shard, ids, vectors, u, v, d, mark, changed, [SEED, shard, round_no])


def _refiner(round_no: int):
    return lambda key, state, pairs: _refine(round_no, key, state, pairs)


def _walk(queries: pa.Table, state: pa.Table, k: int, beam: int) -> pa.Table:
    """Greedy best-first search of a block of queries in one shard, all queries in step."""
    state = state.sort_by("node")
    ids, vectors = state.column("node").to_numpy(), _matrix(state.column("vector"), len(state))
    n, count = len(ids), len(queries)
    near = state.column("near").combine_chunks()
    u = np.repeat(np.arange(n), np.diff(near.offsets.to_numpy()))
    v = np.searchsorted(ids, near.flatten().to_numpy())
    links = np.unique(np.r_[u * n + v, v * n + u])  # both directions
    heads, tails = np.searchsorted(links, np.arange(n + 1) * n), links % n
    wanted = _matrix(queries.column("vector"), count)

    seen = np.full((count, n), np.inf)
    todo = np.zeros((count, n), bool)

    def visit(rows: np.ndarray, slots: np.ndarray) -> None:
        fresh = np.unique(rows * n + slots)
        rows, slots = fresh // n, fresh % n
        fresh = np.isinf(seen[rows, slots])
        rows, slots = rows[fresh], slots[fresh]
        for at in range(0, len(rows), 1 << 15):
            r, s = rows[at : at + (1 << 15)], slots[at : at + (1 << 15)]
            gap = wanted[r] - vectors[s]
            seen[r, s] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        todo[rows, slots] = True

    seeds = np.random.default_rng(SEED).permutation(n)[:SEEDS]
    visit(np.repeat(np.arange(count), len(seeds)), np.tile(seeds, count))
    active = np.arange(count)
    while len(active):
        found = seen[active]
        last = np.partition(found, min(beam, n) - 1, axis=1)[:, min(beam, n) - 1]
        found[~todo[active]] = np.inf
        step = min(EXPAND, n)
        best = np.argpartition(found, step - 1, axis=1)[:, :step]
        good = np.take_along_axis(found, best, axis=1)
        good = np.isfinite(good) & (good <= last[:, None])
        rows, slots = np.repeat(active, step)[good.ravel()], best[good]
        todo[rows, slots] = False
        lengths = heads[slots + 1] - heads[slots]
        reach = np.repeat(heads[slots], lengths) + _rank_in_run(np.repeat(np.arange(len(slots)), lengths))
        visit(np.repeat(rows, lengths), tails[reach])
        active = active[good.any(axis=1)]

    top = min(k, n)
    best = np.argsort(seen, axis=1, kind="stable")[:, :top]  # slots are in id order, so ties go to smaller ids
    score = np.take_along_axis(seen, best, axis=1)
    some = np.isfinite(score).ravel()
    return pa.table(
        {
            "query_id": np.repeat(queries.column("query_id").to_numpy(), top)[some],
            "node": ids[best].ravel()[some],
            "score": score.ravel()[some],
        }
    )


# ---- the graph --------------------------------------------------------------------------------


def distinct_vectors(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vector, node, n, shard): each distinct vector with its least id and its number of rows.

    Copies would be each other's only neighbours and cut the graph; they also are what makes a shard hot.  Shards hold
    vectors of one length; ``shard`` tells lengths apart.
    """
    one = rows.groupBy("vector").agg(F.min("id").alias("node"), F.count("*").alias("n"))
    one = materialize(one, "distinct-vectors")
    sizes = one.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows"))
    shards = F.greatest(F.ceil(F.col("rows") / shard_rows), F.lit(1)).cast("int")
    # one row per vector length
    first = F.coalesce(F.sum("shards").over(Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spread = sizes.withColumn("shards", shards).withColumn("first", first)
    placed = one.withColumn("size", F.size("vector")).join(F.broadcast(spread), "size")
    shard = (F.col("first") + F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("shards"))).cast("int")
    return placed.select("vector", "node", "n", "size", shard.alias("shard"))


def _pairs(state: DataFrame, round_no: int) -> DataFrame:
    """Neighbours of one node, paired where one of them is fresh; links count in both directions."""
    links = state.select("shard", "node", F.explode(F.arrays_zip("near", "mark")).alias("l")).where(F.col("l.mark") != WAITING)
    out = links.select("shard", F.col("node").alias("mid"), F.col("l.near").alias("end"), (F.col("l.mark") == TRIED).alias("fresh"))
    back = out.select("shard", F.col("end").alias("mid"), F.col("mid").alias("end"), "fresh")
    draw = Window.partitionBy("shard", "mid").orderBy(F.desc("fresh"), F.xxhash64(F.lit(round_no), "mid", "end"))
    back = back.withColumn("r", F.row_number().over(draw)).where(F.col("r") <= 2 * SAMPLE).drop("r")
    both = out.union(back)
    other = both.select("shard", "mid", F.col("end").alias("b"), F.col("fresh").alias("fresh_b"))
    met = both.join(other, ["shard", "mid"]).where("`end` < b AND (fresh OR fresh_b)")
    return met.select(F.col("shard").alias("of_shard"), F.col("end").alias("a"), "b")


def build_graph(nodes: DataFrame, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """The neighbour graph of ``distinct_vectors``, one row per node; each round is written to the shared folder.

    A round stops the descent when fewer than ``settled`` of the links changed.  Which fresh links are tried is a seeded
    draw, so reruns agree.
    """
    started = nodes.select("shard", "node", "vector").groupBy("shard").applyInArrow(_start, STATE)
    state = materialize(started, "graph")
    for round_no in range(1, rounds + 1):
        pairs = _pairs(state, round_no).groupBy("of_shard")
        refined = state.groupBy("shard").cogroup(pairs).applyInArrow(_refiner(round_no), STATE)
        state = materialize(refined, "graph")
        totals = state.agg(F.sum("changed"), F.sum(F.size("near"))).first()
        if (totals[0] or 0) <= settled * (totals[1] or 0):
            break
    return state


# ---- the operator -----------------------------------------------------------------------------


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id: str = "id", vector: str = "vector", beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` (Euclidean distance) of the k nearest found for each query.

    Every row is indexed.  A query's own id is no candidate of it; ties go to the smaller id; fewer candidates give fewer
    rows.  Null ids, and vectors that ``usable`` turns down, take no part on either side; vectors of different lengths
    never meet; rows that repeat an id are candidates each, rows that repeat id and vector count once.  Empty inputs give
    an empty result.  Of the copies of a vector the k + 1 smallest ids are looked up, which are all that can
    be among the k nearest.
    """
    pick = lambda df: df.select(F.col(id).cast("long").alias("id"), usable(vector).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    held = pick(rows)
    nodes = materialize(distinct_vectors(held), "nodes")
    graph = build_graph(nodes)

    asked = pick(queries).dropDuplicates(["id", "vector"]).withColumnRenamed("id", "query_id")
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    shards = nodes.select("size", "shard").distinct()
    asked = asked.withColumn("block", block).withColumn("size", F.size("vector"))
    left = asked.join(shards, "size").select("shard", "block", "query_id", "vector").groupBy("shard", "block")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    right = graph.select("shard", every, "node", "vector", "near").groupBy("shard", "block")
    found = left.cogroup(right).applyInArrow(
        lambda q, s: _walk(q, s, k + 1, beam) if len(q) and len(s) else _NONE, "query_id long, node long, score double"
    )

    many = nodes.where("n > 1").select("vector", "node")
    copies = held.join(many, "vector").select("node", "id").distinct()
    few = Window.partitionBy("node").orderBy("id")
    copies = copies.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1).select("node", "id")
    expanded = found.join(copies, "node", "left").select("query_id", F.coalesce("id", "node").alias("id"), "score")
    expanded = expanded.where("query_id <> id").groupBy("query_id", "id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return expanded.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


_NONE = pa.table({"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
