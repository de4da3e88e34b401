"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets are one class from the start.  Signatures are banded; classes that share a band are
candidates.  A candidate pair is compared one batch of hashes after another and dropped as soon as the posterior
probability that its similarity reaches the threshold is below the chosen miss probability.  What survives is confirmed
on the full sets.

No bucket is expanded into all its pairs.  Each member is first compared with its bucket's most central member only, which
joins groups of near copies at a cost that grows with their size.  Then only members of one bucket that lie in
different components are compared, block by block inside a task, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.batches import pieces
from winnow.operators.ids import assign_ids
from winnow.session import materialize

PERCENT = 80
BANDS, ROWS = 40, 5  # a pair at similarity 0.8 shares no band with probability 1.3e-7
BATCH = 40  # hashes compared at a time
MISS = 1e-7  # posterior probability below which a pair is dropped
SEED = 71
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20  # members of a bucket that one block holds, and their shingles (8 bytes each)
SMALL = 64  # members of a bucket whose pairs may be written out
MEMO_WORDS = 500_000
BROADCAST_IDS = 1_000_000  # candidates (32 bytes each) that may be broadcast; beyond it the joins shuffle

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- shingles and signatures ------------------------------------------------------------------


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; words are cut at ASCII white space, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for j in range(width):
        total += hashes[j : len(words) - width + 1 + j] * _PLACES[j % 64] + np.uint64(j // 64)
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each of the hash functions over the set."""
    low = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 2048):
        some = shingles[at : at + 2048]
        hashed = some[None, :] * _FACTORS[:, None]
        hashed += _SHIFTS[:, None]
        hashed >>= np.uint64(32)
        np.minimum(low, hashed.min(axis=1), out=low)
    return low.astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    rows = sig.astype(np.uint64).reshape(BANDS, ROWS)
    total = (rows * _PLACES[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACES[60]
    return _mix(_mix(total) ^ rows[:, 0]).view(np.int64)


SIGNED = "doc_id long, n long, class binary, bands array<long>"
SETS = "doc_id long, n long, class binary, shingles binary, sig binary"


def _class_of(id: int | None, shingles: np.ndarray) -> bytes:
    """The digest of the set, or of the id where the set is empty."""
    if len(shingles):
        return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return hashlib.blake2b(repr(id).encode(), digest_size=16, salt=b"empty").digest()


def _shingled(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list, list[np.ndarray], list[bytes]]]:
    """Ids, sets and classes of (id, text) rows, a piece at a time."""
    memo = _WordHashes()
    for rows in pieces(batches):
        if len(memo) > MEMO_WORDS:
            memo.clear()
        ids = rows.column(0).to_pylist()
        sets = [shingle_set(t, width, memo) for t in rows.column(1).to_pylist()]
        yield ids, sets, [_class_of(i, s) for i, s in zip(ids, sets)]


def sign(docs: DataFrame, width: int) -> DataFrame:
    """The class, size and band keys of each (id, text) row; map-only, without the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, classes in _shingled(batches, width):
            bands = [band_keys(signature(s)).tolist() if len(s) else [] for s in sets]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(classes, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "bands"])

    return docs.mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """The class, size, set and signature of each (id, text) row; map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, classes in _shingled(batches, width):
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(classes, pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "shingles", "sig"])

    return docs.mapInArrow(run, SETS)


# ---- verification -----------------------------------------------------------------------------


def least_matches(threshold: float, hashes: int, miss: float) -> int:
    """The fewest matches among so many hashes that leave the threshold a posterior probability of ``miss``.

    With a uniform prior, P(similarity >= t | m of n match) is P(Binomial(n + 1, t) <= m).
    """
    below = 0.0
    for m in range(hashes + 1):
        below += math.comb(hashes + 1, m) * threshold**m * (1 - threshold) ** (hashes + 1 - m)
        if below >= miss:
            return m
    return hashes


def batch_limits(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared so far, matches needed to go on) after each batch."""
    return [(n, least_matches(percent / 100, n, miss)) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]


def plausible(a: np.ndarray, b: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signatures (rows of both) pass every batch; a pair that fails one is not looked at again."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for upto, least in limits:
        matches[alive] += (a[alive, done:upto] == b[alive, done:upto]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], upto
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _similar_size(a, b, percent: int):
    """Sets whose sizes are further apart cannot reach the similarity."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), BANDS * ROWS)


def screen(pairs: DataFrame, signed: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that survive sequential comparison of their signatures."""
    limits = batch_limits(percent, miss)
    side = lambda s: signed.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = _similar_size(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
            same = plausible(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")), limits)
            yield batch.select(["a", "b"]).filter(pa.array(size & same))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    return both.mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity: 100 * intersection >= percent * union."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"s_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("s_a"), batch.column("s_b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")
    return both.mapInArrow(run, "a long, b long")


def _shared(sets: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """How many members each set shares with one set; all are sorted and without repeats."""
    flat = np.concatenate(sets)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    heads = np.cumsum([0, *(len(s) for s in sets[:-1])])
    return np.add.reduceat(one[at] == flat, heads)


def _links_of_block(rows: list, limits: list[tuple[int, int]], percent: int) -> list[tuple[int, int]]:
    """Links of one block, or between two, that join different components.

    A pair is looked at in the first band it shares.  Where the sets are at hand, links are confirmed and join components
    on the spot, so a block of n members gives n - 1 links at most; else the pairs that survive the screen are given.
    """
    node, component, size, block, band = (np.concatenate([r[k] for r in rows]) for k in range(5))
    sig = np.concatenate([r[5] for r in rows])
    sets = [s for r in rows for s in r[6]]
    first, second = (np.flatnonzero(block == b) for b in (block.min(), block.max()))
    links = []
    for i in first:
        others = second[second > i] if block.min() == block.max() else second
        others = others[(component[others] != component[i]) & _similar_size(size[others], size[i], percent)]
        if not len(others):
            continue
        equal = sig[others].reshape(len(others), BANDS, ROWS) == sig[i].reshape(1, BANDS, ROWS)
        others = others[equal.all(axis=2).argmax(axis=1) == band[0]]
        others = others[plausible(np.broadcast_to(sig[i], (len(others), sig.shape[1])), sig[others], limits)]
        if len(others) and sets[i] is not None:
            shared = _shared([sets[k] for k in others], sets[i])
            others = others[100 * shared >= percent * (size[others] + size[i] - shared)]
        for k in others:
            if component[k] != component[i]:
                links.append((min(node[i], node[k]), max(node[i], node[k])))
                if sets[i] is not None:
                    component[component == component[k]] = component[i]
    return links


def across_components(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """(a, b, sure): links, or candidates, between members of one bucket that lie in different components.

    Pairs with a bucket's lead are decided already, so leads stand aside and buckets of two are done.  A bucket of up to
    ``SMALL`` members travels with signatures only and gives candidates, fewer than half of ``SMALL`` a member; a larger one
    takes its sets along and gives confirmed links only.
    """
    limits = batch_limits(percent, miss)
    labelled = members.where("node <> lead").join(labels, "node", "left").select(
        "band", "band_no", "node", "n", F.coalesce("component", "node").alias("component")
    )
    mixed = labelled.groupBy("band").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("shingles")
    )
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    mixed = mixed.where("lo <> hi").select("band", blocks, (F.col("m") > SMALL).alias("large"))
    placed = labelled.join(mixed, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # every two blocks of a bucket meet in one group; a bucket of one block is one group
    paired = placed.drop("n").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "band", "band_no", "node", "component", "block", "large",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    full = paired.join(sets.select("node", "n", "sig", "shingles"), "node")
    full = full.withColumn("shingles", F.when(F.col("large"), F.col("shingles")))
    ordered = full.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    ordered = ordered.select("band", "i", "j", "node", "component", "n", "block", "band_no", "sig", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out() -> pa.RecordBatch:
            links = np.array(_links_of_block(held, limits, percent), np.int64).reshape(-1, 2)
            sure = pa.array(np.full(len(links), held[0][6][0] is not None))
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1]), sure], ["a", "b", "sure"])

        for batch in pieces(batches):
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            columns = [batch.column(c).to_numpy().astype(np.int64) for c in range(3, 8)]
            columns.append(_signatures(batch.column(8)))
            columns.append([s if s is None else np.frombuffer(s, np.uint64) for s in batch.column(9).to_pylist()])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)] if len(keys) else []
            for a, b in zip(cuts, cuts[1:]):
                if key != tuple(keys[a]):
                    if held:
                        yield out()
                    held, key = [], tuple(keys[a])
                held.append([c[a:b] for c in columns])
        if held:
            yield out()

    return ordered.mapInArrow(run, "a long, b long, sure boolean").distinct()


# ---- components -------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the links reaches; a star contraction in rounds.

    Each round points larger neighbours, then smaller ones, at the least neighbour (large star, small star), and is
    written to the shared folder.  Rounds grow with the logarithm of the longest path.  Hot nodes are handled by a partial
    minimum and a join, never by a collected neighbourhood.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


# ---- the operator -----------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = PERCENT, miss: float = MISS
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Two documents are linked where 100 * intersection >= percent * union of their sets of word shingles; the
    component is the least id that links reach.  A text with fewer words than the width is one shingle; an empty, blank or
    null one has no shingle and no link, and is its own component.  Rows that repeat an id are one document.  Rows with a
    null id join the class of an equal set but start no link; where no row of a class has an id the component is null.
    ``docs`` is read twice, the second time for candidates only.
    ``kept`` says whether the id is the component's.  Whole texts count; other columns of the input are not read, whatever their
    names.  Ties cannot arise, as ids are least or not.  An empty table gives an empty result.
    """
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = materialize(sign(texts, width), "signed")
    classes = assign_ids(signed.groupBy("class").agg(F.min("doc_id").alias("first")), id_column="node")

    # one document of each class, joined on class and id, so copies make no hot key
    leading = classes.where("first IS NOT NULL").select("class", F.col("first").alias("doc_id"), "node")
    one_each = signed.select("class", "doc_id", "n", "bands").join(leading, ["class", "doc_id"])
    banded = one_each.select("node", "n", F.posexplode("bands").alias("band_no", "band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("m"))
    shared = banded.join(buckets.where("lo <> hi").select("band", "m"), "band")
    members = _with_leads(materialize(shared.select("band", "band_no", "node", "n", "m").distinct(), "members"))
    sets = _wanted_sets(texts, leading, members, width)

    star = members.where("node <> lead").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    links = materialize(confirm(screen(star, sets, percent, miss), sets, percent), "links")
    found = materialize(across_components(members, components(links), sets, percent, miss), "links")
    more = found.where("sure").select("a", "b").union(confirm(found.where("NOT sure").select("a", "b"), sets, percent))
    labels = components(links.union(more).union(_repeated_ids(signed, classes)))

    # the least id of each component of several classes
    inside = labels.union(labels.select(F.col("component").alias("node"), "component").distinct())
    least = inside.join(classes, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(inside.join(least, "component").select("node", "component_id"), "node", "left")
    named = named.select("class", F.coalesce("component_id", "first").alias("component_id"))
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "class").join(named, "class")
    return rows.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _repeated_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the nodes of an id that stands in several classes, each with the least of them."""
    ids = signed.where("doc_id IS NOT NULL").select("doc_id", "class", F.xxhash64("class").alias("h"))
    several = ids.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("doc_id")
    nodes = ids.join(several, "doc_id", "left_semi").join(classes, "class").select("doc_id", "node").distinct()
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return nodes.join(least, "doc_id").select("a", F.col("node").alias("b"))


def _with_leads(members: DataFrame) -> DataFrame:
    """The members of each bucket with its lead, the one that meets the most others over all its buckets.

    Near copies of one text lie closer to it than to each other, and it meets them all, so it leads.
    """
    met = members.groupBy("node").agg(F.sum("m").alias("met"))
    ranked = members.join(met, "node").groupBy("band").agg(F.max(F.struct("met", -F.col("node"))).alias("top"))
    leads = ranked.select("band", (-F.col("top.col2")).alias("lead"))
    return materialize(members.join(leads, "band").select("band", "band_no", "node", "n", "lead"), "members")


def _wanted_sets(texts: DataFrame, leading: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(node, n, shingles, sig) of the nodes that are candidates, made again from their texts: most texts are no candidate."""
    wanted = materialize(leading.join(members.select("node").distinct(), "node", "left_semi"), "wanted")
    n = wanted.count()
    small = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
    found = sets_of(texts.join(small.select("doc_id").distinct(), "doc_id", "left_semi"), width)
    sets = materialize(found.join(small, ["class", "doc_id"]).select("node", "n", "shingles", "sig"), "sets")
    if sets.count() > n:  # some rows repeat both id and text
        sets = materialize(sets.dropDuplicates(["node"]), "sets")
    return sets
