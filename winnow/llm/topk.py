"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are cut into blocks that become postings: for each term the slots that hold it and their weights.  A
query is a sparse row; each of its terms scatters its weighted postings into a dense array of scores, one per slot.
Each block selects its best by partition, and the blocks' winners are merged.  Every query meets every block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CELLS = 1 << 20  # vector components in a candidate block
QUERY_ROWS = 512  # queries scored together: with a block's slots, the size of the score array
SCALE = 256


def scaled(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null for vectors that are null or hold null or non-finite components.

    Products beyond the range of long saturate, as Spark's ``floor`` does.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(F.coalesce(finite, F.lit(False)), whole)


def _score_block(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """The k best candidates of the block for each query."""
    ids, query_ids = block.column("id").to_numpy(), queries.column("query_id").to_numpy()
    rows, terms, weights = _sparse(block)
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.empty(0, int)
    tails = np.r_[heads[1:], len(terms)]
    query_rows, query_terms, query_weights = _sparse(queries)

    scores = np.zeros((len(query_ids), len(ids)), np.int64)
    by_term = np.argsort(query_terms, kind="stable")
    query_rows, query_terms, query_weights = query_rows[by_term], query_terms[by_term], query_weights[by_term]
    for a, b in zip(heads, tails):
        lo, hi = np.searchsorted(query_terms, [terms[a], terms[a] + 1])
        slots, posted = rows[a:b], weights[a:b]
        for row, weight in zip(query_rows[lo:hi], query_weights[lo:hi]):
            scores[row, slots] += weight * posted  # a slot holds a term once, so nothing is lost

    found: list[tuple[np.ndarray, ...]] = []
    for query_id, row in zip(query_ids, scores):
        own = ids != query_id
        slots = np.flatnonzero(own)
        if len(slots) > k:
            least = np.partition(row[slots], len(slots) - k)[len(slots) - k]
            slots = slots[row[slots] >= least]  # all ties of the last place, then the smaller ids
        best = slots[np.lexsort((ids[slots], -row[slots].astype(object) if _deep(row) else -row[slots]))[:k]]
        found.append((np.full(len(best), query_id), ids[best], row[best]))
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3
    return pa.table(dict(zip(("query_id", "id", "score"), columns)))


def _deep(row: np.ndarray) -> bool:
    """Whether the least long is among the scores, which has no negative."""
    return bool(len(row)) and row.min() == np.iinfo(np.int64).min


def _sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the components that are not zero."""
    lists = table.column("terms").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lists)), lengths)
    terms = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = flat != 0
    return rows[some], terms[some], flat[some]


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id: str = "id",
    vector: str = "vector",
    block_cells: int = BLOCK_CELLS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of each query's k highest inner products.

    Both sides have an id (long) and a vector (array of long; see ``scaled``).  A query's own id is no candidate
    of it; ties go to the smaller id; fewer candidates give fewer rows.  Rows with a null id or vector take no part;
    of several vectors under one id the smallest (in array order) stands, so repeated rows count once.  Vectors may
    differ in length: missing terms are zero.  Sums beyond long wrap around.  Empty inputs give an empty result.

    All candidates meet all queries, in blocks: candidates go to each block of queries once and queries to each block of
    candidates once, and a task holds one block of each and their scores, all of bounded size.
    """
    pick = lambda df: df.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).groupBy(F.col(id).cast("long").alias("id")).agg(F.min(vector).alias("terms"))
    candidates, queries = pick(candidates), pick(queries).withColumnRenamed("id", "query_id")
    cells = candidates.agg(F.sum(F.size("terms")), F.count("*")).first()
    blocks = max(1, math.ceil((cells[0] or 0) / block_cells), math.ceil((cells[1] or 0) / block_cells * 64))
    query_blocks = max(1, math.ceil(queries.count() / query_rows))

    spread = lambda n, other: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(other)
    dealt = lambda key, n, own: F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(own)
    left = queries.select("*", dealt("query_id", query_blocks, "qb"), spread(blocks, "cb")).groupBy("qb", "cb")
    right = candidates.select("*", dealt("id", blocks, "cb"), spread(query_blocks, "qb")).groupBy("qb", "cb")
    won = left.cogroup(right).applyInArrow(
        lambda a, b: _score_block(a, b, k), "query_id long, id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return won.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
