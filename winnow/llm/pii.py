"""Personal data by weak supervision, with DataFrame operations only.

Patterns propose candidate spans.  Labelers of three sorts (patterns, word lists, context) vote yes, no or nothing on each.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, and its posteriors
are the soft labels on which a final naive Bayes classifier of spans is trained.  The base kinds hold by their rules alone;
the classifier decides on the others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.session import materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local_phone", "national_id", "person")

#: Word lists of the gazetteer and context labelers.
GIVEN_NAMES = (
    "Alice", "Anna", "Antonio", "Carlos", "Charles", "Claire", "David", "Elena", "Emma", "François", "Hans", "James", "Jean",
    "Johann", "John", "José", "Juan", "Julia", "Karl", "Laura", "Linda", "Lucía", "Marie", "María", "Mary", "Michael", "Paul",
    "Peter", "Pierre", "Robert", "Sarah", "Sophie", "Susan", "Thomas", "William",
)
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu")
CUES = ("mail", "contact", "call", "phone", "tel", "mobile", "fax", "card", "visa", "payment", "address", "name", "ssn", "born", "signed")
ANTI_CUES = ("version", "release", "section", "chapter", "isbn", "invoice", "order no", "figure", "table", "page", "serial", "part no")

#: A run that starts at a boundary or right after the match before; so a long run is read once, not once a character.
#: The look ahead at its first character comes first: it fails at most places, and fast.
_FRESH = r"(?=[{0}])(?:(?<![{0}])|\G)"
PATTERNS = {
    "email": _FRESH.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _FRESH.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?=[(0-9])(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "national_id": r"(?=[0-9])(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9.-])",
    "person": r"(?=[A-Z])(?<!\p{L})(?:(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20\p{Lu}\p{L}+(?:\x20\p{Lu}\p{L}+)?|(?:"
    + "|".join(GIVEN_NAMES)
    + r")\x20\p{Lu}\p{L}+)",
}
#: What a text must hold for a pattern to be tried on it, as a cheap test.
NEEDS = {"email": "@", "phone": r"\+", "person": "(?=[A-Z])(?:" + "|".join(("Mr", "Ms", "Dr", "Prof", *GIVEN_NAMES)) + r")[.\x20s]"}
BEFORE, AFTER = 40, 20
LABELERS = ("shape", "gazetteer", "cue", "anti_cue", "company")
FOUND = "array<struct<kind:int,i:int,gap:int,m:string,before:string,after:string>>"
ROUNDS = 12
ACCEPT = 0.5


# ---- candidates -------------------------------------------------------------------------------


def _matches(text: Column, kind: str) -> Column:
    """Matches of one kind with the text before and after each; the gaps between matches give their places."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), gaps.alias("g"), F.slice(gaps, 2, 1 << 30).alias("h")
    )
    found = F.filter(zipped, lambda z: z["m"].isNotNull())
    rows = F.transform(
        found,
        lambda z, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("i"),
            F.length(z["g"]).alias("gap"),
            z["m"].alias("m"),
            F.right(z["g"], F.lit(BEFORE)).alias("before"),
            F.left(z["h"], F.lit(AFTER)).alias("after"),
        ),
    )
    # most texts lack what the pattern needs and are not split at all
    likely = text.rlike(NEEDS.get(kind, "[0-9]")) & text.rlike(PATTERNS[kind])
    return F.when(likely, rows).otherwise(F.array().cast(FOUND))


def _digits(m: str) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    from_right = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * (1 + i % 2))
    return F.aggregate(from_right, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _valid() -> Column:
    """The rules that a match of a base kind must meet; others hold by their pattern."""
    n = F.length(_digits("m"))
    small = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    kind = F.col("kind")
    return (
        F.when(kind == KINDS.index("ip"), F.col("m").rlike(rf"^{small}(?:\.{small}){{3}}$"))
        .when(kind == KINDS.index("card"), F.when(n.between(13, 19), luhn(_digits("m"))).otherwise(False))
        .when(kind == KINDS.index("phone"), n.between(9, 15))
        .otherwise(True)
    )


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per candidate span of each distinct text: scope, kind, start, end, valid, m, before, after."""
    rows = scanned.where(F.size("found") > 0).select("scope", F.explode("found").alias("f")).select("scope", "f.*")
    rows = rows.dropDuplicates(["scope", "kind", "i"])  # copies share a scope
    so_far = Window.partitionBy("scope", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("m")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("m"))
    return placed.withColumn("valid", _valid()).drop("gap", "i")


# ---- labelers ---------------------------------------------------------------------------------


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0)


def vote(spans: DataFrame) -> DataFrame:
    """A column for each labeler: 1, -1 or 0 where it has no opinion."""
    is_kind = lambda *names: F.col("kind").isin([KINDS.index(n) for n in names])
    m, around = F.col("m"), F.lower(F.concat_ws(" ", "before", "after"))
    any_of = lambda words: around.rlike("|".join(words))
    shape = (
        F.when(is_kind("email"), _vote(m.rlike(r"\.[A-Za-z]{2,}$"), m.rlike(r"\.[0-9]+$")))
        .when(is_kind("ip", "card", "phone"), _vote(F.col("valid"), ~F.col("valid")))
        .when(is_kind("local_phone"), _vote(m.rlike(r"^\(?[2-9]"), m.rlike(r"^\(?[01]")))
        .when(is_kind("national_id"), _vote(~m.rlike("^(000|666|9)"), m.rlike("^(000|666|9)")))
        .otherwise(_vote(m.rlike(r"^(Mr|Mrs|Ms|Dr|Prof)\b"), F.lit(False)))
    )
    gazetteer = (
        F.when(is_kind("email"), _vote(m.rlike(rf"\.(?i:{'|'.join(DOMAINS)})$"), F.lit(False)))
        .when(is_kind("ip"), _vote(F.lit(False), m.rlike(r"^(0|127|255)\.")))
        .when(is_kind("card"), _vote(m.rlike(r"^(4|5[1-5]|3[47]|6011)"), m.rlike("^0")))
        .when(is_kind("person"), _vote(m.rlike(rf"(^|\x20)({'|'.join(GIVEN_NAMES)})\x20"), F.lit(False)))
        .otherwise(F.lit(0))
    )
    others = F.count("*").over(Window.partitionBy("scope")) > 1
    return spans.select(
        "*",
        shape.alias("shape"),
        gazetteer.alias("gazetteer"),
        _vote(any_of(CUES), F.lit(False)).alias("cue"),
        _vote(F.lit(False), any_of(ANTI_CUES)).alias("anti_cue"),
        _vote(others, F.lit(False)).alias("company"),
    )


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[float, dict[tuple[str, int, int], float]]:
    """The share of true spans and P(vote | class) of each labeler, by expectation-maximisation.

    ``patterns`` counts the spans of each combination of votes: 3 to the number of labelers at most.  The first
    posteriors are the majority of votes.  A round is one aggregation of sums; the driver holds only those.
    """
    total = sum((F.col(c) for c in LABELERS), F.lit(0))
    posterior = F.when(total > 0, 0.9).when(total < 0, 0.1).otherwise(0.5)
    prior, table = 0.5, {}
    for _ in range(rounds):
        p, n = posterior, F.col("n")
        sums = {"all": n, "true": p * n}
        for c in LABELERS:
            for v in (-1, 0, 1):
                here = F.when(F.col(c) == v, n).otherwise(0)
                sums |= {f"{c} {v} 1": here * p, f"{c} {v} 0": here * (1 - p)}
        row = patterns.agg(*(F.sum(e).alias(k) for k, e in sums.items())).first().asDict()
        if not row["all"]:
            return prior, {(c, v, k): 1 / 3 for c in LABELERS for v in (-1, 0, 1) for k in (0, 1)}
        true, count = row["true"], row["all"]
        prior = (true + 1) / (count + 2)
        mass = {1: true, 0: count - true}
        table = {(c, v, k): (row[f"{c} {v} {k}"] + 1) / (mass[k] + 3) for c in LABELERS for v in (-1, 0, 1) for k in (0, 1)}
        posterior = posterior_of(prior, table)
    return prior, table


def posterior_of(prior: float, table: dict[tuple[str, int, int], float]) -> Column:
    """P(true | votes) as an expression over the labelers' columns."""
    logit = F.lit(math.log(prior / (1 - prior)))
    for c in LABELERS:
        ratio = {v: math.log(table[c, v, 1] / table[c, v, 0]) for v in (-1, 0, 1)}
        logit = logit + F.when(F.col(c) == 1, ratio[1]).when(F.col(c) == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-logit))


# ---- final classifier -------------------------------------------------------------------------


def _features() -> Column:
    """A bounded number of feature values of a span, from itself and its neighbours."""
    edge = lambda c: F.when(c.rlike("[0-9]"), "digit").when(c.rlike(r"\p{L}"), "letter").when(c == "", "none").otherwise("other")
    name = lambda label, value: F.concat_ws("=", F.lit(label), value.cast("string"))
    return F.array(
        name("kind", F.col("kind")),
        name("length", F.least(F.floor(F.log2(F.length("m") + 1)), F.lit(8))),
        name("digits", F.floor(F.length(_digits("m")) * 4 / F.length("m"))),
        name("left", edge(F.right("before", F.lit(1)))),
        name("right", edge(F.left("after", F.lit(1)))),
        name("shape", F.col("shape")),
        name("cue", F.col("cue") + F.col("anti_cue")),
    )


def classify(voted: DataFrame) -> DataFrame:
    """The spans with ``p``, the probability of the final classifier trained on the posteriors of the votes."""
    patterns = materialize(voted.groupBy(*LABELERS).agg(F.count("*").alias("n")), "vote-patterns")
    soft = voted.withColumn("soft", posterior_of(*reliabilities(patterns))).withColumn("features", _features())
    # a few dozen feature values, whatever the input
    seen = soft.select("soft", F.explode("features").alias("feature")).groupBy("feature")
    sums = seen.agg(F.sum("soft").alias("yes"), F.sum(1 - F.col("soft")).alias("no")).collect()
    if not sums:
        return soft.withColumn("p", F.lit(0.0)).drop("soft", "features")
    kinds = [r for r in sums if r["feature"].startswith("kind=")]
    yes, no = sum(r["yes"] for r in kinds) + 1, sum(r["no"] for r in kinds) + 1
    weights = {r["feature"]: math.log((r["yes"] + 1) / (yes + 1)) - math.log((r["no"] + 1) / (no + 1)) for r in sums}
    known = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))
    logit = F.aggregate("features", F.lit(math.log(yes / no)), lambda s, f: s + F.coalesce(known[f], F.lit(0.0)))
    return soft.withColumn("p", 1 / (1 + F.exp(-logit))).drop("soft", "features")


# ---- the operator -----------------------------------------------------------------------------


def find_personal_data(docs: DataFrame, text: str = "text", keep: list[str] | None = None, accept: float = ACCEPT) -> DataFrame:
    """The columns of ``keep`` (all but the text, if none are given) with ``base`` and ``spans``, one row per row.

    Spans are (kind, start, end) by kind, then start, in code points with the end exclusive; ``kind`` is a place in ``KINDS``.
    ``spans`` has the base spans and those of other kinds that the classifier accepts and that overlap no base span.
    Whole texts are read; null and empty ones have no spans; copies of a text are judged once; an empty table gives an
    empty result.  Columns named ``base`` or ``spans`` are replaced.
    """
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in (text, "base", "spans", "scope", "found")]
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*(_matches(whole, kind) for kind in KINDS))
    scanned = docs.select(*(F.col(f"`{c}`") for c in kept), F.sha2(whole, 256).alias("scope"), found.alias("found"))
    scanned = materialize(scanned, "pii-scan")

    spans = materialize(vote(candidates(scanned)), "pii-spans")
    judged = classify(spans).withColumn("is_base", F.col("kind") < len(BASE))
    judged = judged.where((F.col("is_base") & F.col("valid")) | (~F.col("is_base") & (F.col("p") >= accept)))
    by_start = Window.partitionBy("scope").orderBy("start", F.desc("is_base"))
    ends = F.max(F.when(F.col("is_base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.min(F.when(F.col("is_base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    clash = F.coalesce(ends > F.col("start"), F.lit(False)) | F.coalesce(begins < F.col("end"), F.lit(False))
    judged = judged.withColumn("clash", clash).where(F.col("is_base") | ~F.col("clash"))

    one = F.struct("kind", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    per_scope = judged.groupBy("scope").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    every = F.coalesce("spans", none)
    some = scanned.where(F.size("found") > 0).drop("found").join(per_scope, "scope", "left")
    rest = scanned.where(F.size("found") == 0).drop("found").withColumn("spans", none)  # most texts: nothing to join
    return some.unionByName(rest).select(
        *(F.col(f"`{c}`") for c in kept),
        F.filter(every, lambda s: s["kind"] < len(BASE)).alias("base"),
        every.alias("spans"),
    )


def span_string(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)), ',')")


def count_kind(spans: str, kind: str) -> Column:
    return F.expr(f"size(filter({spans}, x -> x.kind = {KINDS.index(kind)}))").cast("long")
