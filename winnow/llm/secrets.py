"""Secret scans with multipart credential linking.

One pass over the texts finds secrets that stand for themselves (the base kinds) and parts that alone prove nothing:
identifiers, secret-like strings and endpoints.  Parts become intervals, and an interval join pairs those that lie
within reach of each other in the same scope.  A weak part is reported only where its complement is near.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.batches import pieces
from winnow.session import materialize

#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

#: Parts that need a complement.
NAMED = re.compile(
    r"""(?:(user|username|login|account|client_?id|key_?id)|(host|server|endpoint|url))["']?\x20*[:=]\x20*["']?([^\s"',;]{3,})""",
    re.I | re.A,
)
ADDRESS = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+""")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
MIXED = (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]"))

REACH = 200  # characters between two parts of one credential

KINDS = ("assign", "access", "hex", "linked_identifier", "linked_secret", "linked_endpoint")
IDENTIFIER, SECRET, ENDPOINT = 3, 4, 5  # numbers of the linked kinds, and roles of parts

SPANS = "array<struct<start:int,kind:int,end:int>>"
PARTS = "array<struct<start:int,role:int,end:int,weak:boolean>>"
KEY, BASE, PART, LINKED = "__scope", "__base", "__parts", "__linked"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds: leftmost matches that do not overlap, those that are too short dropped."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if _has_run(text, 32):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _has_run(text: str, chars: int) -> bool:
    """Whether some word has so many characters; cheaper than trying a pattern at every place."""
    return max(map(len, text.split()), default=0) >= chars


def parts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(start, role, end, weak) of what may belong to a credential; base spans are parts that are not weak."""
    found = [(a, IDENTIFIER if kind == 1 else SECRET, b, False) for a, kind, b in base]
    if "=" in text or ":" in text:
        found += [(m.start(), IDENTIFIER if m[1] else ENDPOINT, m.end(), True) for m in NAMED.finditer(text)]
    if "://" in text:
        found += [(m.start(), ENDPOINT, m.end(), True) for m in ADDRESS.finditer(text)]
    if _has_run(text, 20):
        taken = sorted((a, b) for a, _, b, _ in found)
        starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
        for m in OPAQUE.finditer(text):
            if all(p.search(m[0]) for p in MIXED) and not _overlaps(starts, reach, m.start(), m.end()):
                found.append((m.start(), SECRET, m.end(), True))
    return sorted(found) if any(weak for *_, weak in found) else []


def _overlaps(starts: list[int], reach: list[int], start: int, end: int) -> bool:
    """Whether a span that begins before ``end`` goes beyond ``start``; ``reach`` is the running maximum of ends."""
    before = bisect_left(starts, end)
    return before > 0 and reach[before - 1] > start


def scan(docs: DataFrame, text: str) -> DataFrame:
    """All columns with base spans and parts of each whole text; map-only."""
    more = f"{BASE} {SPANS}, {PART} {PARTS}"
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
        part = pa.struct([("start", pa.int32()), ("role", pa.int32()), ("end", pa.int32()), ("weak", pa.bool_())])
        named = lambda rows, names: [[dict(zip(names, r)) for r in row] for row in rows]
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            base = [base_spans(t) for t in texts]
            own = [parts(t, b) for t, b in zip(texts, base)]
            columns = [
                *batch.columns,
                pa.array(named(base, ("start", "kind", "end")), pa.list_(span)),
                pa.array(named(own, ("start", "role", "end", "weak")), pa.list_(part)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, BASE, PART])

    return docs.mapInArrow(run, schema)


def link(scopes: DataFrame, reach: int = REACH) -> DataFrame:
    """The linked spans of each scope that has any, from its parts.

    An interval join: every part covers the bins of its characters, every weak part also looks up the bins within
    reach, and pairs meet in (scope, bin).  A bin is as wide as the reach, so it holds a bounded number of parts
    however many a scope has, and a hot scope spreads over its bins.  A weak identifier needs a secret, a weak secret
    needs an identifier, an endpoint needs both.
    """
    one = scopes.select(KEY, F.explode(PART).alias("p")).select(KEY, "p.*").distinct()
    bins = lambda a, b: F.explode(F.sequence(F.expr(a), F.expr(b))).alias("bin")
    seeks = one.where("weak").select(
        KEY, "start", "role", "end", bins(f"greatest(start - {reach}, 0) div {reach}", f"(`end` + {reach}) div {reach}")
    )
    there = one.select(
        KEY, F.col("start").alias("s"), F.col("role").alias("r"), F.col("end").alias("e"), bins(f"start div {reach}", f"`end` div {reach}")
    )
    near = seeks.join(there, [KEY, "bin"]).where(f"r <> role AND s - `end` <= {reach} AND start - e <= {reach}")
    met = near.groupBy(KEY, "start", "role", "end").agg(*(F.max(F.col("r") == r).alias(f"r{r}") for r in (IDENTIFIER, SECRET)))
    full = met.where(
        f"CASE role WHEN {IDENTIFIER} THEN r{SECRET} WHEN {SECRET} THEN r{IDENTIFIER} ELSE r{IDENTIFIER} AND r{SECRET} END"
    )
    return full.groupBy(KEY).agg(F.collect_set(F.struct("start", F.col("role").alias("kind"), "end")).alias(LINKED))


def _scoped(docs: DataFrame, text: str) -> DataFrame:
    """The scope of a part is its text; copies share one, so they are linked once."""
    return docs.withColumn(KEY, F.sha2(F.coalesce(text, F.lit("")), 256))


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None, reach: int = REACH) -> DataFrame:
    """The columns of ``keep`` (all but the text, if none are given) with ``base`` and ``spans``, one row per row.

    Spans are (start, kind, end) by start, then kind, in code points with the end exclusive; ``kind`` is a place in
    ``KINDS``.  ``spans`` holds the base spans and the linked ones.  Whole texts are scanned, of any length; null and empty ones
    have no spans; repeated rows get the same spans each; an empty table gives an empty result; columns named ``base`` or
    ``spans`` are replaced.
    """
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in (text, "base", "spans")]
    narrow = _scoped(docs, text).select(*(F.col(f"`{c}`") for c in kept), text, KEY)
    scanned = materialize(scan(narrow, text).drop(text), "secret-parts")
    some = scanned.where(F.size(PART) > 0)
    none = scanned.where(F.size(PART) == 0).withColumn(LINKED, F.array().cast(SPANS))  # most texts: nothing to join
    joined = some.join(link(some.dropDuplicates([KEY]), reach), KEY, "left").unionByName(none)
    every = F.array_sort(F.concat(BASE, F.coalesce(LINKED, F.array().cast(SPANS))))
    return joined.select(*(F.col(f"`{c}`") for c in kept), F.col(BASE).alias("base"), every.alias("spans"))


def redact(docs: DataFrame, text: str = "text", reach: int = REACH, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns; in the text, every secret (base or linked) is replaced by the mask.

    Spans that overlap are masked as one.  Null stays null, repeated rows get the same text each, texts are of any length, and
    an empty table gives an empty result.  Only the parts go through the join; texts meet the
    linked spans, which are few, by the digest of the text.
    """
    scoped = _scoped(docs.drop(KEY, BASE, PART, LINKED), text)
    parted = scan(scoped.select(text, KEY), text).where(F.size(PART) > 0).select(KEY, PART)
    linked = materialize(link(parted.dropDuplicates([KEY]), reach), "secret-links")
    schema = docs.schema
    joined = scoped.join(linked, KEY, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            masked = [
                t and mask_spans(t, [*base_spans(t), *((s["start"], s["kind"], s["end"]) for s in more or ())], mask)
                for t, more in zip(batch.column(text).to_pylist(), batch.column(LINKED).to_pylist())
            ]
            columns = [pa.array(masked, pa.string()) if c == text else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)


def mask_spans(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def span_string(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    one = f"concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)"
    return F.expr(f"array_join(transform({spans}, x -> {one}), ',')")


def count_kind(spans: str, kind: str) -> Column:
    return F.expr(f"size(filter({spans}, x -> x.kind = {KINDS.index(kind)}))").cast("long")
