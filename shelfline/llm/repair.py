"""Repair of conversation structure with the cheapest audited edits (persistent audit search).

A conversation is in order when its role initials read `(s?(ua)+)?`. Rows are kept, given another role,
deleted, or empty rows are inserted; every path of edits is a chain of linked nodes that share their
prefixes. A node knows its ancestors at distances 1, 2, 4, ... and the rolling hash of its whole path, so
two paths of equal cost are compared by a search for their longest common prefix; what the hashes call
equal is verified on the edits themselves.

Rows reach a task sorted by conversation and turn, and are worked off as they come: edits on which all
open paths agree are final, their rows are handed on and their nodes forgotten. A conversation is a
sequence and cannot be cut among tasks, but what a task holds is only the stretch still undecided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
CUT_OFF = 1
BLANK, DUPLICATE = "b", "d"
START, SYSTEM, USER, ASSISTANT = range(4)
#: where an edit that sets or inserts a role leads; after the system turn and the assistant the user speaks
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\f\r"
#: conversations up to this length are looked up by the shape of their rows
SHORT = 24
#: rows after which the paths are asked how far they agree
SETTLE = 2048
MODULUS = (1 << 61) - 1
BASE = 1_000_003
LONGEST = (1 << 63) - 1


class Node:
    """The end of a path of edits."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, parent: Node | None, edit: str):
        self.edit = edit
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(edit)) % MODULUS
        up, step, far = [parent], 0, parent
        while step < len(far.up):
            far = far.up[step]
            up.append(far)
            step += 1
        self.up = tuple(up)


def ancestor(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.up[(node.depth - depth).bit_length() - 1]
    return node


def edits(node: Node) -> str:
    out = []
    while node.depth:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def _same(a: Node, b: Node) -> bool:
    """Whether two paths of one depth are equal edit by edit, up to the node they share."""
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def parting(a: Node, b: Node) -> tuple[Node, Node]:
    """The first edits in which two paths differ; where one path begins the other, its own end and the
    other's ancestor of that depth."""
    depth = min(a.depth, b.depth)
    x, y = ancestor(a, depth), ancestor(b, depth)
    if x.hash == y.hash and _same(x, y):
        return x, y
    if x.hash == y.hash:                        # a collision at the end: step out of it
        return _parting_by_edits(x, y)
    step = len(x.up) - 1
    while step >= 0:
        if step < len(x.up) and x.up[step].hash != y.up[step].hash:
            x, y = x.up[step], y.up[step]
        step -= 1
    if not _same(x.up[0], y.up[0]):             # the hashes called unequal prefixes equal
        return _parting_by_edits(x, y)
    return x, y


def _parting_by_edits(x: Node, y: Node) -> tuple[Node, Node]:
    first = x, y
    while x is not y:
        if x.edit != y.edit:
            first = x, y
        x, y = x.up[0], y.up[0]
    return first


def less(a: Node, b: Node) -> bool:
    """Whether the edits of `a` come before those of `b` in ASCII order."""
    x, y = parting(a, b)
    return x.edit < y.edit if x.edit != y.edit else a.depth < b.depth


class Search:
    """Cheapest paths to each state, over the rows seen so far."""

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, Node]] = {START: (0, Node(None, ""))}
        self._insert()

    def _offer(self, to: dict, state: int, cost: int, parent: Node, edit: str) -> None:
        there = to.get(state)
        if there is None or cost < there[0]:
            to[state] = cost, Node(parent, edit)
        elif cost == there[0]:
            node = Node(parent, edit)
            if less(node, there[1]):
                to[state] = cost, node

    def _insert(self) -> None:
        """Inserted rows between two rows; a second round trip through them never pays."""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(self.best, TURN[state], cost + COST[INSERT], node, INSERT)

    def row(self, kind: str) -> None:
        """One more row: `b` or `d` has to go, else the initial of its role, a capital where it is cut off."""
        to: dict[int, tuple[int, Node]] = {}
        more = CUT_OFF if kind.isupper() else 0
        initial = kind.lower()
        for state, (cost, node) in self.best.items():
            self._offer(to, state, cost + COST[DELETE], node, DELETE)
            if kind in (BLANK, DUPLICATE):
                continue
            self._offer(to, TURN[state], cost + COST[REROLE] + more, node, REROLE)
            if initial == "s" and state == START:
                self._offer(to, SYSTEM, cost + more, node, KEEP)
            elif initial == ("a" if state == USER else "u"):
                self._offer(to, TURN[state], cost + more, node, KEEP)
        self.best = to
        self._insert()
        # what can be done from these two states costs at most so much more from the assistant's
        if ASSISTANT in to:
            for state, margin in ((START, COST[DELETE]), (SYSTEM, 0)):
                if state in to and to[state][0] > to[ASSISTANT][0] + margin:
                    del to[state]

    def end(self) -> tuple[int, Node]:
        """Cost and edits of the cheapest path that ends in order."""
        other, best = self.best.get(START), self.best[ASSISTANT]
        if other and (other[0] < best[0] or other[0] == best[0] and less(other[1], best[1])):
            return other
        return best

    def settled(self) -> str:
        """Edits all open paths begin with; they are taken off the paths."""
        nodes = [node for _, node in self.best.values()]
        depth = min(n.depth for n in nodes)
        for node in nodes[1:]:
            x, y = parting(nodes[0], node)
            depth = min(depth, x.depth if x.edit == y.edit else x.depth - 1)
        done = edits(ancestor(nodes[0], depth))
        if done:
            made = dict.fromkeys((id(ancestor(n, depth)) for n in nodes), Node(None, ""))
            self.best = {s: (c, _regrown(n, made)) for s, (c, n) in self.best.items()}
        return done


def _regrown(node: Node, made: dict[int, Node]) -> Node:
    """The path beyond the nodes already made, as a path of its own; nodes that paths share stay shared."""
    chain = []
    while id(node) not in made:
        chain.append(node)
        node = node.up[0]
    own = made[id(node)]
    for old in reversed(chain):
        own = made[id(old)] = Node(own, old.edit)
    return own


@lru_cache(1 << 16)
def cheapest(kinds: str) -> tuple[int, str]:
    """Cost and edits for the kinds of all rows of one conversation."""
    search = Search()
    for kind in kinds:
        search.row(kind)
    cost, node = search.end()
    return cost, edits(node)


class Conversation:
    """One conversation, row by row: hands out final rows, then the figures."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.search: Search | None = None
        self.kinds, self.waiting = "", []
        self.counts = {BLANK: 0, DUPLICATE: 0, "truncated": 0, "illegal": 0}
        self.first = self.last = self.before = None
        self.distinct = 0
        self.audit: list[str] = []
        self.state = START

    def add(self, turn: int | None, initial: str, kind: str, role: bytes, text: bytes) -> list[tuple]:
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.distinct += turn != self.last
            self.last = turn
        if self.before is not None:
            self.counts["illegal"] += self.before + initial not in LEGAL
        self.before = initial
        self.counts["truncated"] += kind.isupper()
        if kind in self.counts:
            self.counts[kind] += 1
        self.kinds += kind
        self.waiting.append((role, text))
        if self.search is None and len(self.kinds) <= SHORT:
            return []
        if self.search is None:
            self.search = Search()
        for each in self.kinds:
            self.search.row(each)
        self.kinds = ""
        if len(self.waiting) % SETTLE == 0:
            return self._apply(self.search.settled())
        return []

    def finish(self) -> list[tuple]:
        if self.search is None:
            self.cost, rest = cheapest(self.kinds)
        else:
            self.cost, node = self.search.end()
            rest = edits(node)
        return self._apply(rest)

    def _apply(self, done: str) -> list[tuple]:
        """(edit, role, text) of every row that stays or comes in."""
        self.audit.append(done)
        out, row = [], 0
        for edit in done:
            if edit != INSERT:
                role, text = self.waiting[row]
                row += 1
            if edit == DELETE:
                continue
            if edit == KEEP:
                self.state = SYSTEM if role[:1] == b"s" else USER if role[:1] == b"u" else ASSISTANT
            else:
                self.state = TURN[self.state]
                role, text = NAMES[self.state], b"" if edit == INSERT else text
            out.append((edit, role, text))
        del self.waiting[:row]
        return out

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else min(self.last - self.first + 1 - self.distinct, LONGEST)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after planted damage, chosen by crc32 of `conv_id:turn` modulo 20: 0 drops the row (kept here
    with `gone`, so that its conversation stays known), 1 empties the text, 2 removes `[.!?]`, 3 repeats the
    row, 4 sets the role to user. A null anywhere is one space; null turns stay null."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                what.alias("what"), text("role").alias("role"), text("text").alias("text"))
    rows = rows.select(
        "conv_id", "turn", (F.col("what") == 0).alias("gone"),
        F.when(F.col("what") == 4, "user").when(F.col("what") > 0, F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", ""))
        .when(F.col("what") > 0, F.col("text")).alias("text"), "what")
    return rows.select("conv_id", "turn", "gone", "role", "text", F.explode(
        F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _rows(conversations: DataFrame, gone: str | None) -> DataFrame:
    """Rows of whole conversations in order, each with its initial and its kind (see `Search.row`)."""
    nothing = F.col(gone) if gone else F.lit(False)
    value = lambda name: F.when(~nothing, F.coalesce(F.col(name).cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.when(~nothing, F.col("turn").cast("bigint")).alias("turn"),
        nothing.alias("gone"), value("role").alias("role"), value("text").alias("text")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    rows = rows.withColumn("seen", seen)
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    trimmed = F.rtrim("text", F.lit(WHITE))
    kind: Column = (F.when(F.col("gone"), "").when(trimmed == "", BLANK).when(F.col("seen"), DUPLICATE)
                    .when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), known).otherwise(F.upper(known)))
    return rows.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "seen").select(
        "conv_id", "turn", "gone", initial.alias("initial"), kind.alias("kind"),
        F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, list[tuple], bool]]:
    """(conversation, rows that became final, whether it is complete), conversation by conversation."""
    now = None
    for batch in batches:
        for conv_id, turn, gone, initial, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now, now.finish(), True
                now = Conversation(conv_id)
            if not gone:
                done = now.add(turn, initial, kind, role, text)
                if done:
                    yield now, done, False
    if now is not None:
        yield now, now.finish(), True


_AUDIT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
_REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"


def repaired(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """The rows after repair: conv_id, place (from 0), the edit that left or made the row, role, text.

    Rows are read by turn (nulls first), equal turns by role and text. Nulls in role and text are one
    space, so a null text is blank and goes; rows without conv_id are one conversation. A role is judged by
    its first character; an empty or unknown one cannot be kept. Repeated rows are duplicates and go. An
    empty table gives an empty one, other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, place, out = None, 0, []
        for talk, done, _ in _walk(batches):
            if talk is not owner:
                owner, place = talk, 0
            for edit, role, text in done:
                out.append((talk.conv_id, place, edit, role.decode(), text.decode()))
                place += 1
            if len(out) >= SETTLE:
                yield _batch(out, _REPAIRED)
                out = []
        yield _batch(out, _REPAIRED)
    return _rows(conversations, gone).mapInArrow(run, _REPAIRED)


def audits(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cost and edits of its repair, and the digest of the repaired
    rows (`role:text`, joined by newlines).

    gaps counts the turns missing between the least and greatest (2^63 - 1 at most). Every row counts under
    its first fault: blank, duplicate, truncated. `gone` names a boolean column of rows that are no longer
    there; a conversation without any other gets zeros, an empty audit and the digest of the empty string.
    See `repaired` for nulls, ties and repeated rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, owner, digest, begun = [], None, None, False
        for talk, done, complete in _walk(batches):
            if talk is not owner:
                owner, digest, begun = talk, hashlib.sha256(), False
            for _, role, text in done:
                digest.update((b"\n" if begun else b"") + role + b":" + text)
                begun = True
            if complete:
                counts = talk.counts
                out.append((talk.conv_id, talk.gaps, counts[BLANK], counts[DUPLICATE], counts["truncated"],
                            counts["illegal"], talk.cost, "".join(talk.audit), digest.hexdigest()))
                if len(out) >= SETTLE:
                    yield _batch(out, _AUDIT)
                    out = []
        yield _batch(out, _AUDIT)
    return _rows(conversations, gone).mapInArrow(run, _AUDIT)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])
