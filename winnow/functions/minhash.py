"""Character shingles, fingerprints and MinHash signatures.

A text is cut into sliding shingles of 13 code points.  Each shingle is hashed with SHA-1, of which
the first four bytes, read little-endian and cut to 30 bits, are the fingerprint ``x``.  Hash function
``j`` of the signature is the minimum of ``((1 + x) * a_j + b_j) mod 2038074743`` over the text.

The work is map-only: an Arrow UDF reads the UTF-8 buffer of a record batch and never builds a Python
string, so the cost per character is a few hundred nanoseconds and no row depends on another one.
Everything downstream of the signature (bands, scores) is native Spark SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Results agree with Spark's own MinHashLSH only for exactly these.
SHINGLE_WIDTH = 13
FINGERPRINT_MASK = 0x3FFFFFFF
HASH_PRIME = 2038074743
NUM_HASHES = 128
SEED = 42
BAND_COLUMNS = ("hash1", "hash2", "hash3")

# Bytes of text turned into shingles at a time, and shingles hashed at a time: the first bounds the
# memory of a task whatever the length of a document, the second keeps the working set in cache: some 24 arrays of
# four bytes a shingle, which at 16,384 fit the cache of one core.
_SLICE_BYTES = 1 << 20
_CHUNK = 1 << 14
_PIECE_BYTES = 2 << 20  # of text, of which the fingerprints are held and sent at a time


@lru_cache(maxsize=16)
def coefficients(num_hashes: int = NUM_HASHES, seed: int = SEED) -> tuple[tuple[int, int], ...]:
    """The (a, b) pairs Spark's MinHashLSH draws for ``seed``, from java.util.Random's documented rule."""
    mask = (1 << 48) - 1
    state = (seed ^ 0x5DEECE66D) & mask

    def next_int(bound: int) -> int:
        nonlocal state
        while True:
            state = (state * 0x5DEECE66D + 0xB) & mask
            bits = state >> 17
            value = bits % bound
            if bits - value + (bound - 1) < 1 << 31:
                return value

    return tuple((1 + next_int(HASH_PRIME - 1), next_int(HASH_PRIME - 1)) for _ in range(num_hashes))


# SHA-1 constants as arrays, which numpy need not convert on each of the many calls.
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0)
_ROUND = [np.array(v, np.uint32) for v in (0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xCA62C1D6)]
_BITS = {n: np.array(n, np.uint32) for n in (1, 2, 5, 27, 30, 31)}


def _rotate(x: np.ndarray, left: int, out: np.ndarray, spare: np.ndarray) -> None:
    np.right_shift(x, _BITS[32 - left], spare)
    np.left_shift(x, _BITS[left], out)
    np.bitwise_or(out, spare, out)


def _sha1_first_word(leading: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """First SHA-1 state word of many one-block messages: uint32 rows of their first words, and their lengths in bits.

    The words between are zero in all messages and cost nothing until a step fills them.  One pass over all messages per
    step: several times the speed of a hash object per shingle.
    """
    w = [*leading, *[None] * (15 - len(leading)), bits]
    size = len(bits)
    a, b, c, d, e = (np.full(size, v, np.uint32) for v in _START)
    f, g, t = (np.empty(size, np.uint32) for _ in range(3))
    for i in range(80):
        word = w[i & 15]
        if i >= 16:
            for other in (w[(i - back) & 15] for back in (3, 8, 14)):
                if word is None:
                    word = other if other is None else other.copy()
                elif other is not None:
                    np.bitwise_xor(word, other, word)
            if word is not None:
                _rotate(word, 1, word, t)
            w[i & 15] = word
        if i < 20:
            np.bitwise_xor(c, d, f)
            np.bitwise_and(f, b, f)
            np.bitwise_xor(f, d, f)
        elif i < 40 or i >= 60:
            np.bitwise_xor(b, c, f)
            np.bitwise_xor(f, d, f)
        else:
            np.bitwise_or(b, c, f)
            np.bitwise_and(f, d, f)
            np.bitwise_and(b, c, g)
            np.bitwise_or(f, g, f)
        _rotate(a, 5, g, t)
        for term in (_ROUND[i // 20], e, g) if word is None else (_ROUND[i // 20], e, word, g):
            np.add(f, term, f)
        _rotate(b, 30, g, t)
        # f is the new a, g the rotated b; the arrays of e and b are free for the next round
        a, b, c, d, e, f, g = f, a, g, c, d, e, b
    return a + np.uint32(_START[0])


def _fingerprints_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Fingerprint of ``data[begin:begin + size]`` for every shingle; at most 52 bytes, one SHA-1 block."""
    shortest, longest = int(size.min()), int(size.max())
    width = longest // 4 * 4 + 4
    padded = np.lib.stride_tricks.sliding_window_view(data, width)[begin]
    padded[:, shortest:][np.arange(shortest, width) >= size[:, None]] = 0
    padded[np.arange(len(begin)), size] = 0x80
    words = padded.view(">u4").T.astype(np.uint32, order="C")
    return _sha1_first_word(words, (size * 8).astype(np.uint32)).byteswap() & np.uint32(FINGERPRINT_MASK)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Cut rows into ``(first row, last row + 1, first byte, byte to stop starting at)`` of bounded size."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + _SLICE_BYTES, side="right")) - 1
        if stop > row:
            yield row, stop, int(offsets[row]), int(offsets[stop])
            row = stop
        else:
            for byte in range(int(offsets[row]), int(offsets[row + 1]), _SLICE_BYTES):
                yield row, row + 1, byte, min(byte + _SLICE_BYTES, int(offsets[row + 1]))
            row += 1


def _shingle_batches(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield ``(row of each shingle, ascending; fingerprint of each shingle)`` for a batch of strings."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for first, last, begin, stop in _slices(offsets):
        # a shingle that starts before `stop` ends at most 52 bytes later; pad so that the window of a message fits
        end = min(stop + 4 * SHINGLE_WIDTH, int(offsets[last]))
        part = np.concatenate([data[begin:end], np.zeros(64, np.uint8)])
        marks = np.flatnonzero((part[: end - begin] & 0xC0) != 0x80)
        if len(marks) < SHINGLE_WIDTH:
            continue
        ends = np.append(marks, end - begin)
        row_end = np.searchsorted(marks, np.minimum(offsets[first + 1 : last + 1], end) - begin)
        row_begin = np.concatenate([[0], row_end[:-1]])
        row_of = np.repeat(np.arange(first, last), row_end - row_begin)
        at = np.arange(len(marks) - SHINGLE_WIDTH + 1)
        at = at[at + SHINGLE_WIDTH <= row_end[row_of[at] - first]]
        at = at[marks[at] < stop - begin]
        for i in range(0, len(at), _CHUNK):
            chunk = at[i : i + _CHUNK]
            starts = marks[chunk]
            yield row_of[chunk], _fingerprints_of(part, starts, ends[chunk + SHINGLE_WIDTH] - starts)


def _list_array(values: np.ndarray, sizes: np.ndarray, missing: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()), mask=pa.array(missing))


def _signatures_of(texts: pa.Array, pairs: tuple[tuple[int, int], ...]) -> pa.Array:
    best = np.full((len(texts), len(pairs)), HASH_PRIME, np.uint64)
    prime = np.uint64(HASH_PRIME)
    for rows, prints in _shingle_batches(texts):
        base = prints.astype(np.uint64) + np.uint64(1)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
        owners = rows[cuts]
        value, quotient = np.empty_like(base), np.empty_like(base)
        for j, (a, b) in enumerate(pairs):
            np.multiply(base, np.uint64(a), out=value)
            value += np.uint64(b)
            np.floor_divide(value, prime, out=quotient)
            quotient *= prime
            value -= quotient
            best[owners, j] = np.minimum(best[owners, j], np.minimum.reduceat(value, cuts))
    missing = best[:, 0] == prime
    return _list_array(best.astype(np.int32).ravel(), np.full(len(texts), len(pairs)), missing)


def signature_udf(num_hashes: int = NUM_HASHES, seed: int = SEED):
    """Arrow UDF ``string -> array<int>``; null where the text is null or has no shingle."""
    pairs = coefficients(num_hashes, seed)

    @F.arrow_udf("array<int>")
    def minhash_signature(texts: pa.Array) -> pa.Array:
        # copies of a text in the same batch are hashed once
        distinct = texts.dictionary_encode()
        return _signatures_of(distinct.dictionary, pairs).take(distinct.indices)

    return minhash_signature


def signature(text: Column | str, num_hashes: int = NUM_HASHES, seed: int = SEED) -> Column:
    """MinHash signature; the first ``k`` of 128 hashes equal a signature made with ``num_hashes=k``."""
    return signature_udf(num_hashes, seed)(text)


def _print_column(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and fingerprints of sorted keys, in four bytes each."""
    return (keys >> 30).astype(np.int32), (keys & FINGERPRINT_MASK).astype(np.int32)


def _fingerprints_by_row(texts: pa.Array) -> pa.Array:
    # each slice is reduced to its distinct keys; rows ascend, so one that began in an earlier slice is merged with it
    # and all others are done
    done, last = [], np.empty(0, np.int64)
    for rows, prints in _shingle_batches(texts):
        keys = np.unique((rows.astype(np.int64) << 30) | prints)
        begun = np.searchsorted(keys, ((last[-1] >> 30) + 1) << 30) if len(last) else 0
        if begun:
            last = np.union1d(last, keys[:begun])
        if begun < len(keys):
            done.append(_print_column(last))
            cut = np.searchsorted(keys, (keys[-1] >> 30) << 30)
            if cut > begun:
                done.append(_print_column(keys[begun:cut]))
            last = keys[max(cut, begun):]
    done.append(_print_column(last))
    owners = np.concatenate([rows for rows, _ in done])
    values = np.concatenate([prints for _, prints in done])
    sizes = np.bincount(owners, minlength=len(texts))
    nulls = texts.is_null().to_numpy(zero_copy_only=False)
    return _list_array(values, sizes, nulls)


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """A batch in pieces of about ``_PIECE_BYTES`` of text, of one row at least."""
    texts = texts.cast(pa.string()) if pa.types.is_null(texts.type) else texts  # a bare NULL in SQL
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + _PIECE_BYTES, side="right")), first + 1)
        yield texts.slice(first, last - first)
        first = last


def fingerprints_udf():
    """Arrow UDF ``string -> array<int>``: the distinct fingerprints of a text, ascending.

    A batch is answered in pieces, so a worker holds the fingerprints of a piece and not those of ten thousand texts.
    """

    @F.arrow_udf("array<int>")
    def shingle_fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            if not len(texts):
                yield _fingerprints_by_row(texts)
            for piece in _pieces(texts):
                yield _fingerprints_by_row(piece)

    return shingle_fingerprints


def fingerprints(text: Column | str) -> Column:
    return fingerprints_udf()(text)


def shingle_count(text: Column | str) -> Column:
    """Number of shingle positions of a text; zero below 13 code points."""
    return F.greatest(F.length(text) - (SHINGLE_WIDTH - 1), F.lit(0))


def band_hashes(hashes: Column | str) -> list[Column]:
    """The leading hashes of a signature as the plain int columns that key a duplicate bucket."""
    return [F.element_at(hashes, i + 1).alias(name) for i, name in enumerate(BAND_COLUMNS)]


def equal_share(left: Column | str, right: Column | str) -> Column:
    """The share of positions at which two signatures are equal, which estimates the Jaccard similarity."""
    same = F.zip_with(left, right, lambda a, b: a == b)
    return F.size(F.filter(same, lambda e: e)) / F.size(same)


def overlap_score(left: Column | str, right: Column | str) -> Column:
    """Shared distinct values over the sum of both lengths less the shared ones, as a float.

    Positions are ignored and the lengths count repeated values, so this reads lower than the share
    of equal positions.
    """
    shared = F.size(F.array_intersect(left, right)).cast("double")
    return (shared / (F.size(left) + F.size(right) - shared)).cast("float")
