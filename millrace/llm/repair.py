"""Repair of conversations whose turns do not alternate: cheapest edits by a Viterbi search.

A repaired conversation is empty, or a system turn if there is one, then turns of user and
assistant by turns, as many of one as of the other. Each row is kept (K), given the role user or
assistant (R) or deleted (D), and empty turns of user or assistant are inserted (I) anywhere.
Blank rows and rows whose role and text occurred before are deleted; a truncated row, whose text
does not end in ``.``, ``!`` or ``?``, costs more unless it is deleted. Of the cheapest edits those
are taken whose letters, in order, come first in ASCII order.

The rows of a conversation stream past in order of turn. After each row there is one survivor
for each of the four states (nothing yet, system, user, assistant came last): the cheapest way
to get there, and of equal costs the one whose letters come first. Survivors are leaves of a tree
of backpointers in which a node counts what refers to it: a node that no survivor needs any
more is freed, with all its ancestors of which that holds, and once the survivors share an
ancestor, the edits up to it are decided, leave as rows, and are forgotten. So a task holds the
rows since the survivors parted, not the conversation.

Ties are settled by the whole unresolved letters of both survivors, without walking them: the
survivors of a row are kept in the order of their letters. Inserted letters belong to the row
after them, so each survivor has a letter per row; two survivors differ within these letters, and
neither is the beginning of the other. Their order never changes afterwards, and the next letters
decide only between ways that come from one survivor. Survivors that cannot win are dropped (see
``_Search._prune``); otherwise a system turn that is followed by deletions alone would stay undecided.

Defined results: a null role or text counts as one space; rows with a null turn come first, rows
of one turn in order of role and text; rows with a null id are one conversation; a role counts by
its first character, upper case and empty ones fit no turn; only repeated rows after the first are
deleted for that; an empty table gives no rows; other columns are ignored. One conversation is
read by one task as a stream, since its digest and its letters come in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_SPACE = " \t\n\x0b\x0c\r"
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    ("s", _EMPTY): _SYSTEM,
    ("u", _EMPTY): _USER,
    ("u", _SYSTEM): _USER,
    ("u", _ASSISTANT): _USER,
    ("a", _USER): _ASSISTANT,
}
_LEGAL = {"su", "ua", "au"}
#: Rows and bytes of text that leave a task at a time.
_OUT_ROWS, _OUT_BYTES = 4096, 4 << 20


class Step(NamedTuple):
    """A way from one state to another: inserted roles, then what happens to the row."""

    source: int
    target: int
    cost: int
    letters: str
    inserted: tuple[str, ...]
    role: str | None


def _insertions(state: int) -> Iterator[tuple[int, tuple[str, ...]]]:
    """The states that inserted turns lead to, none of them twice."""
    seen, roles = {state}, ()
    yield state, ()
    while True:
        role = "assistant" if state == _USER else "user"
        state, roles = _NEXT[role[0], state], (*roles, role)
        if state in seen:
            return
        seen.add(state)
        yield state, roles


@cache
def steps(initial: str, fault: str) -> tuple[Step, ...]:
    """The cheapest step between each pair of states for a row, by its initial and its fault."""
    best: dict[tuple[int, int], Step] = {}
    more = TRUNCATED if fault == "truncated" else 0
    for source in range(4):
        for state, inserted in _insertions(source):
            paid, letters = INSERT * len(inserted), "I" * len(inserted)
            ways = [Step(source, state, paid + DELETE, letters + "D", inserted, None)]
            if fault not in ("blank", "duplicate"):
                if (initial, state) in _NEXT:
                    ways.append(Step(source, _NEXT[initial, state], paid + KEEP + more, letters + "K", inserted, None))
                role = "assistant" if state == _USER else "user"
                ways.append(
                    Step(source, _NEXT[role[0], state], paid + REROLE + more, letters + "R", inserted, role)
                )
            for step in ways:
                held = best.get(step[:2])
                if held is None or (step.cost, step.letters) < (held.cost, held.letters):
                    best[step[:2]] = step
    return tuple(best.values())


@cache
def endings(state: int) -> tuple[tuple[int, str, tuple[str, ...]], ...]:
    """Cost, letters and roles of the turns inserted after the last row, up to an accepted end."""
    return tuple(
        (INSERT * len(inserted), "I" * len(inserted), inserted)
        for end, inserted in _insertions(state)
        if end in (_EMPTY, _ASSISTANT)
    )


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str


class _Node:
    """An edit in the tree of survivors. ``refs``: its children, and 1 while it is a survivor."""

    __slots__ = ("parent", "step", "row", "children", "alive")

    def __init__(self, parent: _Node | None, step: Step | None, row: Row | None):
        self.parent, self.step, self.row = parent, step, row
        self.children: list[_Node] = []
        self.alive = True

    @property
    def refs(self) -> int:
        return len(self.children) + self.alive


Edited = tuple[str, Row | None, str | None]


class _Search:
    """The survivors of one conversation."""

    def __init__(self) -> None:
        self.root = _Node(None, None, None)
        # State to cost, place in the order of letters, and node.
        self.survivors: dict[int, tuple[int, int, _Node]] = {_EMPTY: (0, 0, self.root)}

    def add(self, row: Row) -> Iterator[Edited]:
        """Takes the next row; returns the edits that it decides."""
        best: dict[int, tuple[tuple[int, int, str], Step]] = {}
        for step in steps(row.role[:1], row.fault):
            survivor = self.survivors.get(step.source)
            if survivor is None:
                continue
            key = (survivor[0] + step.cost, survivor[1], step.letters)
            if step.target not in best or key < best[step.target][0]:
                best[step.target] = (key, step)
        self._prune(best)
        places = {key: place for place, key in enumerate(sorted(k[1:] for k, _ in best.values()))}
        old, self.survivors = self.survivors, {}
        for state, (key, step) in best.items():
            parent = old[step.source][2]
            node = _Node(parent, step, row)
            parent.children.append(node)
            self.survivors[state] = (key[0], places[key[1:]], node)
        for _, _, node in old.values():
            node.alive = False
            self._release(node)
        return self._decided()

    @staticmethod
    def _prune(best: dict[int, tuple[tuple[int, int, str], Step]]) -> None:
        """Drops survivors that end worse than the one of the state assistant, whatever follows.

        What follows a system turn also follows an assistant's, at the same cost. What follows
        nothing does so too, but for a system turn, which would be deleted instead: DELETE more.
        """
        if _ASSISTANT not in best:
            return
        key = best[_ASSISTANT][0]
        if _SYSTEM in best and best[_SYSTEM][0] > key:
            del best[_SYSTEM]
        if _EMPTY in best and best[_EMPTY][0][0] > key[0] + DELETE:
            del best[_EMPTY]

    def _release(self, node: _Node) -> None:
        while node is not self.root and not node.refs:
            parent = node.parent
            parent.children.remove(node)
            node.parent, node = None, parent

    def _decided(self) -> Iterator[Edited]:
        while not self.root.alive and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield from _edits(self.root)

    def finish(self) -> Iterator[Edited]:
        """The edits that are still open, and the turns inserted at the end."""
        ends = [
            (cost + more, place, letters, inserted, node)
            for state, (cost, place, node) in self.survivors.items()
            for more, letters, inserted in endings(state)
        ]
        *_, inserted, node = min(ends, key=lambda end: end[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            yield from _edits(node)
        for role in inserted:
            yield "I", None, role


def _edits(node: _Node) -> Iterator[Edited]:
    for role in node.step.inserted:
        yield "I", None, role
    yield node.step.letters[-1], node.row, node.step.role


def faults(conversations: DataFrame) -> DataFrame:
    """Rows with the fault that their text alone shows, and whether an earlier turn has both texts.

    The first turn of each role and text that occurs more than once is found by a partial
    aggregate over digests, and joined back; Spark broadcasts these if they are few, and
    splits a frequent text otherwise.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = (
        rows.groupBy(F.col("conv_id").alias("_conv"), digest.alias("_digest"))
        .agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (digest == F.col("_digest"))
    trimmed = F.rtrim("text", F.lit(_SPACE))
    return rows.join(repeated, met, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(trimmed == "", "blank")
        .when(F.coalesce(F.col("_first") < place, F.lit(False)), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
        .alias("fault"),
    )


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The edits of every conversation, in order within a partition.

    One row per edit: ``conv_id, edit, turn, old_role, fault, role, text``. ``edit`` is K, R, D or
    I; ``role`` and ``text`` are those of the repaired turn, null if it is deleted; ``turn``,
    ``old_role`` and ``fault`` (``blank``, ``duplicate``, ``truncated`` or empty) are those of the
    row, null for an inserted turn.
    """
    id_type = conversations.schema["conv_id"].dataType
    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(id_type)),
            ("edit", pa.string()),
            ("turn", pa.int64()),
            ("old_role", pa.string()),
            ("fault", pa.string()),
            ("role", pa.string()),
            ("text", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        search, current, last = None, None, None
        for batch in batches:
            for conv_id, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                decided: list[tuple[object, Edited]] = []
                if search is None or conv_id != current:
                    if search is not None:
                        decided += [(current, e) for e in search.finish()]
                    search, current, last = _Search(), conv_id, None
                # Copies within a turn are neighbours.
                if fault != "blank" and last == (turn, role, text):
                    fault = "duplicate"
                last = (turn, role, text)
                decided += [(conv_id, e) for e in search.add(Row(turn, role, text, fault))]
                for owner, edit in decided:
                    out.append((owner, *_columns(*edit)))
                    size += len(out[-1][-1] or "")
                if len(out) >= _OUT_ROWS or size >= _OUT_BYTES:
                    yield _batch(out, schema)
                    out, size = [], 0
        if search is not None:
            out += [(current, *_columns(*edit)) for edit in search.finish()]
        if out:
            yield _batch(out, schema)

    return (
        faults(conversations)
        .select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "fault")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
        .mapInArrow(
            run,
            f"conv_id {id_type.simpleString()}, edit string, turn long, old_role string, "
            "fault string, role string, text string",
        )
    )


def _columns(edit: str, row: Row | None, role: str | None) -> tuple:
    if row is None:
        return edit, None, None, None, role, ""
    if edit == "D":
        return edit, row.turn, row.role, row.fault, None, None
    return edit, row.turn, row.role, row.fault, role or row.role, row.text


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
    )


class _Summary:
    """Counts and digests of one conversation, from its edits in order."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = self.kept = 0
        self.before: str | None = None
        self.least = self.most = self.turn = None
        self.audit: list[str] = []
        self.hash = hashlib.sha256()

    def add(self, edit: str, turn: int | None, old_role: str | None, fault: str | None, role: str, text: str):
        self.audit.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
                self.cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
            if self.before is not None and self.before + old_role[:1] not in _LEGAL:
                self.illegal += 1
            self.before = old_role[:1]
            # Turns come in order, so that each is counted where it differs from the one before.
            if turn is not None and turn != self.turn:
                self.turns, self.turn, self.most = self.turns + 1, turn, turn
                self.least = turn if self.least is None else self.least
        if edit != "D":
            self.hash.update((("\n" if self.kept else "") + f"{role}:{text}").encode())
            self.kept += 1

    def row(self, conv_id: object) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            conv_id,
            gaps,
            *self.faults.values(),
            self.illegal,
            self.cost,
            "".join(self.audit),
            self.hash.hexdigest(),
        )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``: counts, cost, letters, digest.

    Reads the edits in the tasks that made them, in order; a task holds the letters of one
    conversation and no texts.
    """
    id_type = repaired.schema["conv_id"].dataType
    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(id_type)),
            *[(name, pa.int64()) for name in _COUNTS],
            ("audit", pa.string()),
            ("repaired_sha256", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = None, None
        for batch in batches:
            done = []
            for conv_id, *edit in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or conv_id != current:
                    if held is not None:
                        done.append(held.row(current))
                    held, current = _Summary(), conv_id
                held.add(*edit)
            if done:
                yield _batch(done, schema)
        if held is not None:
            yield _batch([held.row(current)], schema)

    counts = ", ".join(f"{name} long" for name in _COUNTS)
    return repaired.mapInArrow(
        run, f"conv_id {id_type.simpleString()}, {counts}, audit string, repaired_sha256 string"
    )


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` with faults planted by the CRC32 of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its ``.``, ``!`` and ``?``, 3
    repeats it, 4 sets its role to user. A null counts as one space.
    """

    def known(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known(F.col("conv_id")), F.lit(":"), known(F.col("turn")))) % 20
    text, role = known(F.col("text")), known(F.col("role"))
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            kind.alias("_kind"),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))))
        .select("conv_id", "turn", "role", "text", (F.col("_kind") == 0).alias("dropped"))
    )


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The digest of every conversation after damage and repair, of those without rows too."""
    damaged = damage(conversations)
    repaired = repair_digest(repair_conversations(damaged.filter("not dropped").drop("dropped")))
    gone = damaged.groupBy("conv_id").agg(F.min("dropped").alias("gone")).filter("gone")
    empty = _Summary().row(None)
    nothing = gone.select(
        "conv_id",
        *[F.lit(value).cast("long").alias(name) for name, value in zip(_COUNTS, empty[1:])],
        F.lit("").alias("audit"),
        F.lit(empty[-1]).alias("repaired_sha256"),
    )
    return repaired.unionByName(nothing)
