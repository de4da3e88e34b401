"""Periodic runs of words by online dyadic square catching.

Words arrive in order.  Whenever a block of 2^k words that begins at a multiple of 2^k is complete, a catcher takes it up and
watches a window of distances at which the block may come back; each new word ends one suffix a level, which is compared
with the catchers that wait for it.  A suffix that equals its block at distance q is grown to both sides while words q apart
agree.  From 2q words on that is a square; squares of one period that overlap are one stretch and merge into a run.  A
stretch that reaches the last word stays open and goes on with the words to come.

Block sizes follow from the shortest run that counts: words q apart agree over at least ``need(q)`` places in a row, and any
2b - 1 places hold a whole aligned block of b.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.batches import pieces

MIN_LENGTH = 24
MIN_POWER = 3
CHUNK_WORDS = 1 << 16  # words that are appended at once
ODD = 0x9E3779B97F4A7C15  # base of the hashes of blocks

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))

_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    """The first ``count`` powers of the base, modulo 2^64."""
    global _powers
    if len(_powers) < count:
        steps = np.full(max(count, 2 * len(_powers)), ODD, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers[:count]


def spread(ids: np.ndarray) -> np.ndarray:
    """Word numbers as well-mixed 64-bit numbers."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def watched(min_length: int, power: int, block: int) -> list[tuple[int, int]]:
    """The distances, as half-open intervals, at which catchers of this block size wait for their block.

    A run of period q that counts has ``need(q) = max(min_length - q, (power - 1) * q)`` places or more at which words q apart
    agree.  The block is the greatest one with ``2 * block - 1 <= need(q)``.
    """
    low, high = 2 * block - 1, 4 * block - 1
    turn = -(-min_length // power)  # from this period on the power decides
    short = (max(1, min_length - high + 1), min(turn, min_length - low + 1))
    long = (max(turn, -(-low // (power - 1))), -(-high // (power - 1)))
    found = [(a, b) for a, b in (short, long) if a < b]
    if len(found) == 2 and found[0][1] == found[1][0]:
        return [(found[0][0], found[1][1])]
    return found


class SquareCatcher:
    """Runs of one sequence of word numbers; give it words with ``append`` in pieces of any size."""

    def __init__(self, min_length: int = MIN_LENGTH, power: int = MIN_POWER):
        if min_length < 1 or power < 2:
            raise ValueError("runs need a length of 1 and a power of 2 at least")
        self.min_length, self.power = min_length, power
        self.words = np.empty(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # prefix sums of word * base^place
        self.size = 0
        self.open: list[list] = []  # [start, end, period, told] of stretches that reach the last word
        self.squares: list[list] = []  # the same of all stretches of two periods or more
        self.levels: list[tuple[int, list[tuple[int, int]]]] = []
        block = 1
        while block <= min_length and not watched(min_length, power, block):
            block *= 2
        self.next_block = block

    def append(self, words: np.ndarray) -> list[tuple[int, int]]:
        """Take more words; returns the new squares as (start, period)."""
        begin = self.size
        self._store(words)
        found = []
        for stretch in self.open:
            self._grow(stretch, found)
        self.open = [s for s in self.open if s[1] == self.size]
        while True:  # a level opens once a run that counts on it fits
            spans = watched(self.min_length, self.power, self.next_block)
            if spans and spans[0][0] + self.next_block > self.size:
                break
            if spans:
                self.levels.append((self.next_block, spans))
            self.next_block *= 2
        for block, spans in self.levels:
            self._advance(block, spans, begin, found)
        return found

    def _store(self, words: np.ndarray) -> None:
        size = self.size + len(words)
        if size > len(self.words):
            room = max(size, 2 * len(self.words))
            self.words = np.concatenate([self.words[: self.size], np.empty(room - self.size, np.int64)])
            self.sums = np.concatenate([self.sums[: self.size + 1], np.empty(room - self.size, np.uint64)])
        self.words[self.size : size] = words
        self.sums[self.size + 1 : size + 1] = np.cumsum(spread(words) * powers(size)[self.size :]) + self.sums[self.size]
        self.size = size

    def _advance(self, block: int, spans: list[tuple[int, int]], begin: int, found: list) -> None:
        """Compare each suffix of ``block`` words that ends in a new word with the catchers that wait for it."""
        homes, periods = [], []
        shift = block.bit_length() - 1
        for low, high in spans:
            first = max(begin - block + 1, low)
            at = np.arange(first, self.size - block + 1)
            if not len(at):
                continue
            suffix = self.sums[first + block : self.size + 1] - self.sums[first : self.size - block + 1]
            newest = ((at - low) >> shift) << shift
            for back in range(0, high - low, block):
                home = newest - back
                skip = int(np.searchsorted(at, low + back))  # before that the catcher would begin below word 0
                h, j = home[skip:], at[skip:]
                caught = self.sums[h + block] - self.sums[h]
                caught *= powers(high + block)[j - h]
                hit = np.flatnonzero((caught == suffix[skip:]) & (j - h < high))
                homes.append(h[hit])
                periods.append((j - h)[hit])
        if homes:
            self._catch(np.concatenate(homes), np.concatenate(periods), block, found)

    def _catch(self, home: np.ndarray, period: np.ndarray, block: int, found: list) -> None:
        order = np.lexsort((home, period))
        home, period = home[order], period[order]
        known = [s for s in self.squares if len(home) and s[1] > home.min()]
        while len(home):
            for start, end, p, _ in known:
                # inside a stretch of period p a multiple of p gives the same stretch again
                left = ~((home >= start) & (home + period + block <= end) & (period % p == 0))
                home, period = home[left], period[left]
                if not len(home):
                    return
            h, q = int(home[0]), int(period[0])
            home, period = home[1:], period[1:]
            known = []
            if np.array_equal(self.words[h : h + block], self.words[h + q : h + q + block]):
                stretch = [self._first(h, q), h + block + q, q, False]
                self._grow(stretch, found)
                if stretch[1] == self.size:
                    self.open.append(stretch)
                known = [stretch]

    def _first(self, at: int, q: int) -> int:
        """The least place from which words q apart agree up to ``at``."""
        width = 64
        while at > 0:
            low = max(0, at - width)
            apart = np.flatnonzero(self.words[low:at] != self.words[low + q : at + q])
            if len(apart):
                return low + int(apart[-1]) + 1
            at, width = low, 2 * width
        return 0

    def _grow(self, stretch: list, found: list) -> None:
        """Move the end on as far as words a period apart agree; note the stretch when it becomes a square."""
        start, end, q, told = stretch
        width = 64
        while end < self.size:
            high = min(self.size, end + width)
            apart = np.flatnonzero(self.words[end:high] != self.words[end - q : high - q])
            if len(apart):
                end += int(apart[0])
                break
            end, width = high, 2 * width
        stretch[1] = end
        if not told and end - start >= 2 * q:
            stretch[3] = True
            self.squares.append(stretch)
            found.append((start, q))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period; a stretch counts once, with its least period."""
        least: dict[tuple[int, int], int] = {}
        for start, end, q, _ in self.squares:
            if end - start >= max(self.min_length, self.power * q):
                least[start, end] = min(q, least.get((start, end), q))
        return sorted((s, e - s, q) for (s, e), q in least.items())


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """The runs of a list of words."""
    if len(words) < min_length:
        return []
    number = dict.fromkeys(words)
    number = dict(zip(number, range(len(number))))
    if len(number) == len(words):
        return []
    catcher = SquareCatcher(min_length, power)
    for at in range(0, len(words), CHUNK_WORDS):
        part = words[at : at + CHUNK_WORDS]
        catcher.append(np.fromiter(map(number.__getitem__, part), np.int64, len(part)))
    return catcher.runs()


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    kept, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at : max(at, begin)]
        at = max(at, end)
    return b" ".join(kept + words[at:])


def find_runs(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, power: int = MIN_POWER, keep: list[str] | None = None
) -> DataFrame:
    """The columns of ``keep`` (all but the text, if none are given) with ``runs`` and ``collapsed``, one row per row.

    Words are runs of characters other than blank and U+0009 to U+000D.  ``runs`` lists (start, length, period) in words by
    start, then period: every stretch with least period q, not extendable, of ``max(min_length, power * q)`` words or more.
    ``collapsed`` is the text with each run cut to its first period, words joined by one blank; a word goes if any run
    holds it after that run's first q words.

    Whole texts are read, however long: memory is about 24 bytes a word of the longest text.  Null and empty texts have no
    runs and collapse to an empty text.  Repeated rows each get the same answer; ties between runs cannot arise, as start and
    period differ.  An empty table gives an empty result.  Columns named ``runs`` or ``collapsed`` are replaced.  Map-only.
    """
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in (text, "runs", "collapsed")]
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, short = [], []
            for value in batch.column(batch.num_columns - 1).cast(pa.binary()):
                words = (value.as_py() or b"").split()
                own = runs_of(words, min_length, power)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                short.append(collapse(words, own))
            columns = [*batch.columns[:-1], pa.array(found, run_type), pa.array(short, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def strongest(runs: str) -> Column:
    """The run with the greatest exact length over period; the first of equals.  Null without a run."""
    better = "best IS NULL OR x.length * best.period > best.length * x.period"
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.expr(f"aggregate({runs}, CAST(NULL AS {kind}), (best, x) -> CASE WHEN {better} THEN x ELSE best END)")


def run_lines(runs: str) -> Column:
    """``start,length,period`` and a line feed for every run."""
    return F.expr(f"concat_ws('', transform({runs}, x -> concat_ws('', x.start, ',', x.length, ',', x.period, '\\n')))")


def planted(text: str, from_word: Column, period: Column) -> Column:
    """The text with each word from ``from_word`` on replaced so that the words from there repeat with that period.

    Word i >= a becomes word a + (i - a) modulo the period; words come out joined by one blank.  Native expressions.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    struct = F.struct(words.alias("w"), from_word.cast("int").alias("a"), period.cast("int").alias("p"))
    looped = F.transform(
        F.array(struct),
        lambda s: F.concat(
            F.slice(s["w"], F.lit(1), s["a"]),
            F.transform(F.sequence(F.lit(0), F.size(s["w"]) - s["a"] - 1), lambda i: F.get(s["w"], s["a"] + i % s["p"])),
        ),
    )
    return F.array_join(F.get(looped, F.lit(0)), " ")
