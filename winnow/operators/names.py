"""Names of people in text, by a hidden Markov model that is counted, decoded and scored with DataFrame operations.

A window is a run of capitalised words with the word to its left.  Its hidden states are O (no name), B (first word of a name)
and I (further word).  Where a title stands in front of a run the words after it are a name for sure; those windows label
themselves, all others count as O, which names without a title hardly change as they are few among them.  Counts of words by
state, of left neighbours and of transitions come from one aggregation over all windows; the title is no feature, so
what is learnt carries over to names without one: their words, the words in front of them, and how many follow each other.

Words are hashed into ``BUCKETS``, so the model has a fixed size and the driver holds some ten thousand numbers whatever the
corpus.  Decoding is Viterbi as an ``aggregate`` over the words of a window.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
MOST_WORDS = 3  # words after a title that are its name
SMOOTHING = 0.5  # added to every transition that is possible
NEVER = -1e9

#: Titles that stand in front of a name, with or without a full stop.
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Sra")

_INSIDE = r"\p{L}\p{M}'’-"
_NAME = rf"\p{{Lu}}(?=[{_INSIDE}]*\p{{Ll}})[{_INSIDE}]*+"
FROM, TO = "SOBI", "OBIE"  # states that transitions lead from (S: start of the window) and to (E: its end)
IMPOSSIBLE = {"SI", "OI", "SE"}


def window_pattern(titles: tuple[str, ...] = TITLES) -> str:
    """Groups: the word to the left, the title, the run of capitalised words; every text is read once.  Repeats are possessive: long runs neither go back
    nor nest calls.  A match begins with a word or a capital, so what is inside of words is passed over at its first character."""
    title = rf"(?:{'|'.join(titles)})\.?(?!\S)"
    one = f"(?!{title}){_NAME}"
    left = rf"(?:(?<!\S)(?!{title}|[^\s\p{{L}}]*+{_NAME})(\S++)[ \t]++)?"
    return rf"(?:(?<!\S)|(?=\p{{Lu}})){left}(?:(?<!\S)({title})[ \t]++)?(?<![{_INSIDE}])({one}(?: {one})*+)"


def windows(text: Column | str, titles: tuple[str, ...] = TITLES) -> Column:
    """``array<struct<l: string, titled: boolean, words: array<string>>>`` of a text; a left word that ends a sentence is ``.``"""
    pattern = window_pattern(titles)

    def parts(m: Column) -> Column:
        group = lambda i: F.regexp_extract(m, "^" + pattern, i)
        left = F.when(group(1).rlike(r"[.!?]\z"), F.lit(".")).otherwise(F.lower(group(1)))
        return F.struct(left.alias("l"), (group(2) != "").alias("titled"), F.split(group(3), " ").alias("words"))

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parts)


def _bucket(word: str) -> str:
    return f"CAST(pmod(xxhash64({word}), {BUCKETS}) AS INT)"


@dataclass(frozen=True)
class NameModel:
    """Logarithms of probabilities: words by state (O, B, I), left words by O and B, transitions by ``FROM`` and ``TO``."""

    words: tuple[float, ...]
    left: tuple[float, ...]
    steps: tuple[float, ...]
    titles: tuple[str, ...] = TITLES


def _smoothed(counts: dict[int, int], background: list[float]) -> list[float]:
    """Log-probabilities of the buckets; the weight of the background is the number of buckets met once, as the share of what is
    met for the first time would have it."""
    total = sum(counts.values())
    weight = max(1, sum(c == 1 for c in counts.values()))
    return [math.log((counts.get(x, 0) + weight * background[x]) / (total + weight)) for x in range(BUCKETS)]


def _background(*counts: dict[int, int]) -> list[float]:
    every = [1 + sum(c.get(x, 0) for c in counts) for x in range(BUCKETS)]
    return [n / sum(every) for n in every]


def fit(df: DataFrame, text: str = "text", titles: tuple[str, ...] = TITLES, found: str | None = None) -> NameModel:
    """A model of the windows of all texts.  Null texts have none; without any window nothing is likely to be a name.

    ``found`` names a column that has the ``windows`` of the texts by these titles already; the text is not read then.  Finding
    them costs most, so write that column once for ``fit`` and ``detect``.

    One scan and one aggregation, partial before its shuffle; at most ``5 * BUCKETS + 16`` counts come to the driver.
    """
    label = f"IF(w.titled AND i < {MOST_WORDS}, IF(i = 0, 'B', 'I'), 'O')"
    every = F.col(f"`{found}`") if found else windows(text, titles)
    labelled = df.select(F.explode(every).alias("w")).withColumn("labels", F.expr(f"transform(w.words, (x, i) -> {label})"))
    step = "concat(IF(k = 0, 'S', element_at(labels, k)), IF(k = size(labels), 'E', element_at(labels, k + 1)))"
    seen = labelled.select(
        F.explode(
            F.expr(
                f"concat(transform(w.words, (x, i) -> named_struct('kind', labels[i], 'x', {_bucket('lower(x)')})),"
                f" array(named_struct('kind', IF(w.titled, 'left B', 'left O'), 'x', {_bucket('w.l')})),"
                f" transform(sequence(0, size(labels)), k -> named_struct('kind', {step}, 'x', 0)))"
            )
        ).alias("e")
    )
    counts: dict[str, dict[int, int]] = defaultdict(dict)
    for r in seen.groupBy("e.kind", "e.x").count().collect():
        counts[r["kind"]][r["x"]] = r["count"]
    common = _background(counts["O"], counts["B"], counts["I"])
    words = [p for s in "OBI" for p in _smoothed(counts[s], common)]
    beside = _background(counts["left O"], counts["left B"])
    left = [p for s in ("left O", "left B") for p in _smoothed(counts[s], beside)]
    steps = []
    for a in FROM:
        row = {b: counts[a + b].get(0, 0) + SMOOTHING for b in TO if a + b not in IMPOSSIBLE}
        steps += [math.log(row[b] / sum(row.values())) if b in row else NEVER for b in TO]
    return NameModel(tuple(words), tuple(left), tuple(steps), titles)


def _constant(values: tuple[float, ...]) -> Column:
    """A literal array: text that the optimizer folds, as one literal for each number would make a plan of thousands of nodes."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _step(a: str, b: str) -> str:
    """The transition between two states, given as SQL for one letter each."""
    return f"element_at(__t, 4 * instr('{FROM}', {a}) - 4 + instr('{TO}', {b}))"


def _said(state: str, word: str) -> str:
    return f"element_at(__w, {BUCKETS} * (instr('OBI', {state}) - 1) + 1 + {_bucket(f'lower({word})')})"


def _beside(state: str, left: str) -> str:
    return f"element_at(__l, IF({state} = 'B', {BUCKETS}, 0) + 1 + {_bucket(left)})"


def _first(*paths: tuple[str, str]) -> str:
    """The letter of the best path, the first of equals."""
    (letter, score), *others = paths
    if not others:
        return f"'{letter}'"
    return f"CASE WHEN {score} >= greatest({', '.join(s for _, s in others)}, {NEVER * 10}D) THEN '{letter}' ELSE {_first(*others)} END"


def _labels(w: str) -> str:
    """Viterbi: the states of a window as a string of letters."""
    ways = {b: [(a, f"a.{a} + {_step(repr(a), repr(b))}") for a in "OBI" if a + b not in IMPOSSIBLE] for b in TO}
    best = lambda b: ways[b][0][1] if len(ways[b]) == 1 else f"greatest({', '.join(s for _, s in ways[b])})"
    start = ", ".join(
        f"'{b}', " + (f"{NEVER}D" if b == "I" else f"{_step(repr('S'), repr(b))} + {_beside(repr(b), f'{w}.l')} + {_said(repr(b), f'{w}.words[0]')}")
        for b in "OBI"
    )
    move = ", ".join(f"'{b}', {best(b)} + {_said(repr(b), 'x')}" for b in "OBI")
    back = f"concat(a.back, {', '.join(_first(*ways[b]) for b in 'OBI')})"
    trace = f"""aggregate(IF(size({w}.words) > 1, sequence(size({w}.words) - 1, 1, -1), array()), {_first(*ways['E'])},
        (out, k) -> concat(substr(a.back, 3 * k - 3 + instr('OBI', left(out, 1)), 1), out))"""
    return f"""aggregate(slice({w}.words, 2, size({w}.words)), named_struct({start}, 'back', ''),
        (a, x) -> named_struct({move}, 'back', {back}), a -> {trace})"""


def _weight(labels: str, w: str) -> str:
    """The logarithm of the probability of a window with its states."""
    at = lambda k: f"substr({labels}, {k}, 1)"
    before = f"IF(j = 1, 'S', {at('j - 1')})"
    return f"""(aggregate(sequence(1, size({w}.words)), 0D, (sum, j) -> sum + {_said(at('j'), f'element_at({w}.words, j)')} + {_step(before, at('j'))})
        + {_beside(at('1'), f'{w}.l')} + {_step(f'right({labels}, 1)', repr('E'))})"""


def detect(df: DataFrame, model: NameModel, text: str = "text", column: str = "entities", found: str | None = None) -> DataFrame:
    """``df`` with the names of each text as entities: ``word``, ``entity_group`` PERSON, ``score``, in the order of the text.

    The score is the probability of the name against the same words being no name, all else as decoded: above 0, up to 1.  A
    null text has null entities, an empty one none; repeated rows get the same ones; a column of that name is replaced.
    ``found`` is as for ``fit``.  No Python, no shuffle.
    """
    plain = "overlay(p.s PLACING repeat('O', n) FROM k FOR n)"
    odds = f"1D / (1D + exp({_weight(plain, 'p.w')} - {_weight('p.s', 'p.w')}))"
    length = "length(regexp_extract(substr(p.s, k), '^BI*', 0))"
    word = "array_join(slice(p.w.words, k, n), ' ')"
    entity = f"named_struct('word', {word}, 'entity_group', 'PERSON', 'score', {odds})"
    named = f"""flatten(transform(
        filter(transform(__windows, w -> named_struct('w', w, 's', {_labels('w')})), p -> instr(p.s, 'B') > 0),
        p -> transform(filter(sequence(1, length(p.s)), k -> substr(p.s, k, 1) = 'B'),
                       k -> element_at(transform(array({length}), n -> {entity}), 1))))"""
    kept = [c for c in df.columns if c != column]
    constants = {"__w": _constant(model.words), "__l": _constant(model.left), "__t": _constant(model.steps)}
    every = F.col(f"`{found}`") if found else windows(text, model.titles)
    return df.withColumn("__windows", every).withColumns(constants).select(*(F.col(f"`{c}`") for c in kept), F.expr(named).alias(column))
