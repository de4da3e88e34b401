"""Repair of conversation structure by Viterbi with survivor coalescence.

The roles of a sound conversation read ``(s?(ua)+)?`` in initials.  Rows may be kept, given another role or deleted, and empty
rows inserted, each at a cost.  The decoder holds one cheapest path, its survivor, for each state of that automaton.  Paths
are branches of a tree of back-pointers with reference counts: a branch without a survivor is freed, and as soon as all
survivors share an ancestor the edits up to it are final and leave the tree.  So memory follows the unresolved part, not
the length of the conversation.

Equal costs are settled by the least string of edits.  That compares the complete unresolved suffixes of both paths: paths that
end in an edit of the same row are never prefixes of each other, so their order is fixed at the first edit in which they
differ, and is carried on as a rank in place of reading the suffixes again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.turns import grouped, stream, together

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: Costs of the edits, and of an unfinished text that stays.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1

#: States by what was said last: nothing, system, user, assistant.  A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that an edit can put next, and the state after it.
NEXT_ROLE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: (state, other): no continuation of ``state`` costs less than some continuation of ``other`` by more than this.
LEAD = {
    (START, SYSTEM): 4, (START, USER): 5, (START, ASSISTANT): 3,
    (SYSTEM, START): 0, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 0,
    (USER, START): 2, (USER, SYSTEM): 2, (USER, ASSISTANT): 2,
    (ASSISTANT, START): 0, (ASSISTANT, SYSTEM): 4, (ASSISTANT, USER): 2,
}


class Node:
    """One edit on a path; ``refs`` counts the branches and survivors that hold it."""

    __slots__ = ("parent", "branches", "refs", "edit", "role", "text")

    def __init__(self, parent: Node | None, edit: str, role: str | None, text: str | None):
        self.parent, self.edit, self.role, self.text = parent, edit, role, text
        self.branches: set[Node] = set()
        self.refs = 0
        if parent is not None:
            parent.branches.add(self)
            parent.refs += 1


class Repairer:
    """Feed rows with ``row``; edits come out as (edit, role, text) as soon as they are final, the rest with ``end``."""

    def __init__(self):
        self.root = Node(None, "", None, None)
        self.live = self.most_live = 0
        self.cost = 0
        # state: (cost, rank of the path up to its last row, inserts after that row, node)
        self.survivors: dict[int, tuple[int, int, str, Node]] = {}
        self._settle({START: (0, 0, lambda: self.root)})

    def row(self, role: str, text: str, must_go: bool, unfinished: bool) -> Iterator[tuple[str, str | None, str | None]]:
        best: dict[int, tuple] = {}

        def offer(state: int, cost: int, rank: int, edits: str, node: Node, edit: str, role: str | None, text: str | None) -> None:
            if state not in best or (cost, rank, edits + edit) < best[state][:3]:
                best[state] = (cost, rank, edits + edit, node, edit, role, text)

        for state, (cost, rank, edits, node) in self.survivors.items():
            offer(state, cost + DELETE, rank, edits, node, "D", None, None)
            if not must_go:
                stays = cost + UNFINISHED * unfinished
                after = STEPS[state].get(role[:1])
                if after is not None:
                    offer(after, stays, rank, edits, node, "K", role, text)
                other, after = NEXT_ROLE[state]
                offer(after, stays + REROLE, rank, edits, node, "R", other, text)
        ranks = {key: i for i, key in enumerate(sorted(b[1:3] for b in best.values()))}
        old = [node for *_, node in self.survivors.values()]
        self._settle({s: (b[0], ranks[b[1:3]], lambda b=b: self._node(*b[3:])) for s, b in best.items()})
        for node in old:
            self._release(node)
        yield from self._final()

    def _settle(self, bases: dict[int, tuple]) -> None:
        """Add inserts after the row, leave out states that cannot win any more, and make nodes of the rest."""
        paths = {s: (cost, rank, "", s) for s, (cost, rank, _) in bases.items()}
        changed = True
        while changed:
            changed = False
            for state, (cost, rank, edits, base) in list(paths.items()):
                after = NEXT_ROLE[state][1]
                if after not in paths or (cost + INSERT, rank, edits + "I") < paths[after][:3]:
                    paths[after] = (cost + INSERT, rank, edits + "I", base)
                    changed = True
        open_ = {s for s, p in paths.items() if not any(o != s and q[0] + LEAD[s, o] < p[0] for o, q in paths.items())}
        made: dict[tuple[int, str], Node] = {}
        self.survivors = {}
        for state in open_:
            cost, rank, edits, base = paths[state]
            if (base, "") not in made:
                made[base, ""] = bases[base][2]()
            node, at = made[base, ""], base
            for i in range(1, len(edits) + 1):
                role, at = NEXT_ROLE[at]
                if (base, edits[:i]) not in made:
                    made[base, edits[:i]] = self._node(node, "I", role, "")
                node = made[base, edits[:i]]
            node.refs += 1
            self.survivors[state] = (cost, rank, edits, node)

    def _node(self, *args) -> Node:
        self.live += 1
        self.most_live = max(self.most_live, self.live)
        return Node(*args)

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            parent = node.parent
            parent.branches.discard(node)
            parent.refs -= 1
            self.live -= 1
            node = parent

    def _final(self) -> Iterator[tuple[str, str | None, str | None]]:
        """Edits that all survivors share; the ancestor moves to where they part."""
        while self.root.refs == 1 and self.root.branches:
            self.root = self.root.branches.pop()
            self.root.parent = None
            self.live -= 1
            yield self.root.edit, self.root.role, self.root.text

    def end(self) -> Iterator[tuple[str, str | None, str | None]]:
        """Take the cheapest path that may end here, the least string of edits among equals."""
        chosen = min((s for s in self.survivors if s in (START, ASSISTANT)), key=lambda s: self.survivors[s][:3])
        self.cost = self.survivors[chosen][0]
        for state, (*_, node) in self.survivors.items():
            if state != chosen:
                self._release(node)
        yield from self._final()


class Faults:
    """Counts over the rows of a conversation in order."""

    def __init__(self):
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._last: str | None = None
        self._first_turn = self._turn = None
        self._turns = 0

    def row(self, turn: int | None, role: str, text: str, repeats: bool) -> tuple[bool, bool]:
        """Whether the row must go, and whether its text is unfinished; the first fault of a row counts."""
        said = text.rstrip(SPACE)
        blank = not said
        duplicate = repeats and not blank
        unfinished = not blank and not duplicate and said[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += unfinished
        initial = role[:1]
        self.illegal += self._last is not None and self._last + initial not in ("su", "ua", "au")
        self._last = initial
        if turn is not None and turn != self._turn:
            self._first_turn = turn if self._first_turn is None else self._first_turn
            self._turn, self._turns = turn, self._turns + 1
            self.gaps = self._turn - self._first_turn + 1 - self._turns
        return blank or duplicate, unfinished


def _rows(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order with ``again``: role and text occurred before in the conversation.

    One exchange, on the conversation; both sorts are within its partitions.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = together(rows, conversation, turn, role, text).select("c", F.col("t").cast("long").alias("t"), blank("r"), blank("x"))
    seen = Window.partitionBy("c", "r", "h").orderBy("t")
    rows = rows.withColumn("h", F.sha2("x", 256)).withColumn("n", F.row_number().over(seen))
    return rows.sortWithinPartitions("c", "t", "r", "x", "n").select("c", "t", "r", "x", (F.col("n") > 1).alias("again"))


def _decode(group: Iterator[tuple], faults: Faults, repairer: Repairer) -> Iterator[tuple[str, str | None, str | None]]:
    for turn, role, text, again in group:
        yield from repairer.row(role, text, *faults.row(turn, role, text, again))
    yield from repairer.end()


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
BATCH = 1024


def repair_summary(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its faults, the cost and initials of the cheapest edits, and a digest of the repaired rows.

    ``audit`` is the least string among the cheapest edits (D delete, I insert, K keep, R give another role).  ``gaps`` is
    maxTurn - minTurn + 1 - distinct turns, nulls aside.  ``repaired_sha256`` is of ``role:text`` of the repaired rows joined by
    line feeds, fed row by row as edits become final, as no conversation is ever held whole.

    Null ids are a conversation of their own; null roles and texts count as one blank, so such texts are blank and such
    roles fit nowhere.  Rows go by turn, nulls first, ties by role, then text; repeated rows are duplicates after the first.
    Texts may be empty or of any length.  An empty table gives an empty result.  Other columns are left out, whatever
    their names.  A conversation is decoded in order by one task, in memory that does not grow with it once
    survivors coalesce; conversations spread over tasks by their id.
    """
    schema = T.StructType([T.StructField(conversation, rows.schema[conversation].dataType), *T.StructType.fromDDL(SUMMARY).fields])
    return _rows(rows, conversation, turn, role, text).mapInArrow(_batched(_summaries, schema), schema)


def repair_rows(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The edits of each conversation in order, one row each: ``step`` from 0, ``edit``, and the repaired ``role`` and ``text``.

    Deleted rows have neither.  Everything else is as in ``repair_summary``; a conversation without edits (no rows) is absent.
    """
    more = "step long, edit string, role string, text string"
    schema = T.StructType([T.StructField(conversation, rows.schema[conversation].dataType), *T.StructType.fromDDL(more).fields])
    return _rows(rows, conversation, turn, role, text).mapInArrow(_batched(_edits, schema), schema)


def _summaries(key: Any, group: Iterator[tuple]) -> Iterator[tuple]:
    faults, repairer, audit, digest, first = Faults(), Repairer(), [], hashlib.sha256(), True
    for edit, role, text in _decode(group, faults, repairer):
        audit.append(edit)
        if edit != "D":
            digest.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
            first = False
    yield (
        key, faults.gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal,
        repairer.cost, "".join(audit), digest.hexdigest(),
    )


def _edits(key: Any, group: Iterator[tuple]) -> Iterator[tuple]:
    for step, (edit, role, text) in enumerate(_decode(group, Faults(), Repairer())):
        yield key, step, edit, role, text


def _batched(work, schema: T.StructType):
    """A function for ``mapInArrow`` that does ``work`` on each conversation of a partition, some rows out at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, group in grouped(stream(batches)):
            for row in work(key, group):
                out.append(row)
                if len(out) == BATCH:
                    yield _table(out, names)
                    out = []
        if out:
            yield _table(out, names)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
