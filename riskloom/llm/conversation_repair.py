"""Conversation structure repair: generalised LR parsing of role sequences with weighted edits.

The roles of a sound conversation follow ``RULES``: nothing, or an optional system row and then pairs of user and
assistant.  The LR(0) automaton of these rules drives a graph-structured stack: a stack node is a state on top of a shared
node, equal nodes are one object, so equal stack tops of several parses meet and only the cheapest parse, ties by the
ASCII-least audit, goes on.  Before and at each row a parse may keep the row (K, 0), rerole it to user or assistant
(R, 1), delete it (D, 2; the only choice for blank rows and duplicates) or insert an empty user or assistant row (I, 5);
a truncated row that is not deleted adds 5.

A row's first fault counts: *blank* (no character besides blanks), *duplicate* (role and text seen earlier in the
conversation), *truncated* (the last such character is not one of ``.!?``).

One shuffle by conversation; duplicates are numbered by a window in the same partitioning; rows are then sorted by
(turn, role, text) and stream through the parser.  For a conversation it holds the eight possible stack tops, each with
cost, rank of its audit among the others and a running SHA-256, and 16 bytes a row for the way back.  Neither texts nor
rows are gathered, so a conversation that holds a third of all rows needs little more memory than its audit, which is one
cell of the result.  (Its digest, one hash over the repaired text in order, has to be computed by one task.)

Defined results: a null conversation id is a conversation of its own; a null role or text counts as one space; a null
turn comes first and counts for no gap; rows of equal turn are taken by role, then text; an unknown or empty role is no
legal neighbour and is reroled or deleted; repeated rows are duplicates; very long texts are hashed as they pass; an empty
table gives no rows; extra columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.state import prepare

#: Left side and right side of each rule; C is the whole conversation, lower case are role initials.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}  #: roles that an edit may give
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = "\t\n\x0b\x0c\r "
LEGAL = ("su", "ua", "au")
WIDTH = 8  #: bytes for the parents, and for the edits, of one row


class Automaton:
    """LR(0) states of ``rules``; ``goto[state, symbol]``, ``reduce[state]`` (rule numbers)."""

    def __init__(self, rules=RULES):
        self.rules = rules
        names = {left for left, _ in rules}

        def closure(items):
            items = set(items)
            todo = list(items)
            while todo:
                rule, dot = todo.pop()
                for i, (left, _) in enumerate(rules):
                    if rules[rule][1][dot:dot + 1] == left and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
            return frozenset(items)

        start = closure((i, 0) for i, (left, _) in enumerate(rules) if left == rules[0][0])
        states, self.goto, self.reduce = [start], {}, {}
        for at, items in enumerate(states):  # grows as states are found
            self.reduce[at] = [r for r, dot in items if dot == len(rules[r][1])]
            for symbol in sorted({rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])}):
                to = closure((r, dot + 1) for r, dot in items if rules[r][1][dot:dot + 1] == symbol)
                if to not in states:
                    states.append(to)
                self.goto[at, symbol] = states.index(to)
        self.terminals = {s for _, right in rules for s in right} - names
        self.goal = rules[0][0]


class Stacks:
    """The graph-structured stack: nodes (state, node below), each made once, and what an edit does to a node."""

    def __init__(self, automaton: Automaton):
        self.lr, self.nodes, self.shared, self.memo = automaton, [(0, -1)], {(0, -1): 0}, {}

    def push(self, state: int, below: int) -> int:
        if (state, below) not in self.shared:
            self.shared[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.shared[state, below]

    def shift(self, node: int, symbol: str) -> int | None:
        """The top after the symbol and all reductions that it completes."""
        to = self.lr.goto.get((self.nodes[node][0], symbol))
        if to is None:
            return None
        top = self.push(to, node)
        while True:
            done = [r for r in self.lr.reduce[self.nodes[top][0]] if self.lr.rules[r][0] != self.lr.goal]
            if not done:
                return top
            left, right = self.lr.rules[done[0]]
            for _ in right:
                top = self.nodes[top][1]
            top = self.push(self.lr.goto[self.nodes[top][0], left], top)

    def accepts(self, node: int) -> bool:
        """Whether a rule of the goal is complete on top and nothing but its right side is on the stack."""
        for r in self.lr.reduce[self.nodes[node][0]]:
            left, right = self.lr.rules[r]
            at = node
            for _ in right:
                at = self.nodes[at][1]
            if left == self.lr.goal and at == 0:
                return True
        return False

    def inserted(self, node: int) -> list[tuple[int, str]]:
        """The node and the nodes that inserted rows lead to, with their roles; each by the fewest rows."""
        found, todo = {node: ""}, [node]
        for at in todo:
            for role in ROLES:
                to = self.shift(at, role)
                if to is not None and to not in found:
                    found[to] = found[at] + role
                    todo.append(to)
        return list(found.items())

    def moves(self, node: int, initial: str, fault: str) -> list[tuple[int, int, str, str]]:
        """(new node, cost, edits, roles of the inserted rows and of this one) for a row on this top.

        An insertion before a deletion has a cheaper-or-equal, ASCII-smaller twin after it, so it is left out.
        """
        key = (node, initial if initial in self.lr.terminals else "", fault)
        if key not in self.memo:
            out = [(node, DELETE, "D", "")]
            if fault not in ("blank", "duplicate"):
                more = TRUNCATED if fault == "truncated" else 0
                for at, roles in self.inserted(node):
                    edits, cost = "I" * len(roles), INSERT * len(roles) + more
                    kept = self.shift(at, key[1]) if key[1] else None
                    if kept is not None:
                        out.append((kept, cost, edits + "K", roles + "="))
                    out += [(to, cost + REROLE, edits + "R", roles + role) for role in ROLES if (to := self.shift(at, role)) is not None]
            least: dict = {}
            for move in out:
                if move[0] not in least or move[1:] < least[move[0]][1:]:
                    least[move[0]] = move
            self.memo[key] = list(least.values())
        return self.memo[key]


class Parser:
    """Repairs one conversation at a time, row by row."""

    def __init__(self):
        self.stacks = Stacks(Automaton())
        self.edits, self.code = [], {}

    def start(self) -> None:
        self.tops = [(0, 0, hashlib.sha256(), False)]  # by rank of the audit: node, cost, digest so far, whether it has rows
        self.parents, self.codes = bytearray(), bytearray()

    def row(self, role: str, text: str, fault: str) -> None:
        best: dict = {}
        for rank, (node, cost, _, _) in enumerate(self.tops):
            for to, more, edits, roles in self.stacks.moves(node, role[:1], fault):
                # audits of two tops differ before either ends, so their ranks order any continuation
                found = (cost + more, rank, edits, roles)
                if to not in best or found < best[to]:
                    best[to] = found
        chosen = sorted(best.items(), key=lambda x: x[1][1:3])
        if len(chosen) > WIDTH:
            raise RuntimeError("conversation_repair: the rules have more stack tops than WIDTH")
        parents, codes, tops = bytearray(WIDTH), bytearray(WIDTH), []
        for i, (node, (cost, rank, edits, roles)) in enumerate(chosen):
            parents[i] = rank
            codes[i] = self._code(edits)
            digest, any_ = self._digest(self.tops[rank], roles, role, text)
            tops.append((node, cost, digest, any_))
        self.tops = tops
        self.parents += parents
        self.codes += codes

    def _code(self, edits: str) -> int:
        if edits not in self.code:
            self.code[edits] = len(self.edits)
            self.edits.append(edits)
        return self.code[edits]

    @staticmethod
    def _digest(top, roles: str, role: str, text: str):
        if not roles:
            return top[2], top[3]  # never changed in place
        digest, any_ = top[2].copy(), top[3]
        for i, x in enumerate(roles):
            name, own = role if x == "=" else ROLES[x], text if i == len(roles) - 1 and text is not None else ""
            digest.update((("\n" if any_ else "") + name + ":" + own).encode("utf-8", "replace"))
            any_ = True
        return digest, any_

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, hex digest of the repaired rows) of the cheapest parse."""
        ends = [(cost + INSERT * len(roles), rank, "I" * len(roles), roles) for rank, (node, cost, _, _) in enumerate(self.tops)
                for to, roles in self.stacks.inserted(node) if self.stacks.accepts(to)]
        cost, rank, last, roles = min(ends)
        digest, _ = self._digest(self.tops[rank], roles, "", None)
        edits = [last]
        for at in range(len(self.parents) - WIDTH, -1, -WIDTH):
            edits.append(self.edits[self.codes[at + rank]])
            rank = self.parents[at + rank]
        return cost, "".join(reversed(edits)), digest.hexdigest()


def fault_of(text: str, again: bool) -> str:
    solid = text.rstrip(BLANKS)
    return "blank" if not solid else "duplicate" if again else "" if solid[-1] in ".!?" else "truncated"


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Report:
    def __init__(self, conv):
        self.conv, self.faults = conv, {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.low = self.turn = self.before = None
        self.turns = self.illegal = 0

    def add(self, turn, role: str, fault: str) -> None:
        self.faults[fault] += 1
        if turn is not None and turn != self.turn:  # rows come by turn
            self.low, self.turn, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]

    def row(self, cost: int, audit: str, digest: str) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.conv, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, cost, audit, digest)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def _parse(batches):
    """Reports of the conversations of one sorted partition."""
    parser, now, names = Parser(), None, ["conv_id", *(x.split()[0] for x in _REPORT.split(", "))]
    kind = None

    def batch_of(done):
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, present, turn, role, text, again in _rows(batch):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row(*parser.end()))
                now = _Report(conv)
                parser.start()
            if present:
                fault = fault_of(text, again)
                now.add(turn, role, fault)
                parser.row(role, text, fault)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.row(*parser.end())])


def _ordered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Rows by conversation, turn, role and text, with ``again`` (role and text came earlier)."""
    rows = rows.select(F.col(id_col).alias("conv"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
                       F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    equal = Window.partitionBy("conv", "present", "role", "text").orderBy("turn")  # in the partitions of conv: no second shuffle
    return (rows.repartition("conv").withColumn("again", F.row_number().over(equal) > 1)
            .sortWithinPartitions("conv", "present", "turn", "role", "text", "again"))


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present: Column | None = None) -> DataFrame:
    """One row per conversation: counts of faults, cost and audit of the cheapest edits, digest of the repaired rows.

    Rows where ``present`` is not true only name their conversation.
    """
    prepare(rows.sparkSession)
    ordered = _ordered(rows, id_col, turn_col, role_col, text_col, present)
    kind = ordered.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(_parse, f"conv_id {kind}, {_REPORT}").withColumnRenamed("conv_id", id_col)


class _Editor:
    """Applies an audit to the rows of its conversation, in order."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.place, self.before = conv, audit, 0, 0, ""

    def _put(self, turn, role: str, text: str) -> tuple:
        self.place, self.at, self.before = self.place + 1, self.at + 1, role[:1]
        return (self.conv, self.place, turn, role, text, self.audit[self.at - 1])

    def _next_role(self) -> str:
        return "assistant" if self.before == "u" else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            yield self._put(None, self._next_role(), "")

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        if self.audit[self.at] == "D":
            self.at += 1
        else:
            yield self._put(turn, role if self.audit[self.at] == "K" else self._next_role(), text)


def _apply(batches):
    """Repaired rows of one sorted partition; the audit of a conversation comes before its rows."""
    editor, kind, names = None, None, ["conv_id", "place", "turn", "role", "text", "edit"]

    def batch_of(done):
        types = [kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, turn, role, text, audit in _rows(batch):
            if audit is None:
                done += editor.row(turn, role, text)
            else:
                done += editor.inserted() if editor else ()
                editor = _Editor(conv, audit)
        if done:
            yield batch_of(done)
    if editor and (done := list(editor.inserted())):
        yield batch_of(done)


def repaired(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             present: Column | None = None) -> DataFrame:
    """(id, place from 1, turn, role, text, edit) of the repaired rows; inserted ones have no turn."""
    audits = repair(rows, id_col, turn_col, role_col, text_col, present)
    ordered = _ordered(rows, id_col, turn_col, role_col, text_col, present).where("present").select("conv", "turn", "role", "text")
    kind = ordered.schema["conv"].dataType.simpleString()
    both = (ordered.withColumn("audit", F.lit(None).cast("string"))
            .union(audits.select(id_col, F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("string"), "audit")))
    both = both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "text")
    return both.mapInArrow(_apply, f"conv_id {kind}, place long, turn long, role string, text string, edit string").withColumnRenamed("conv_id", id_col)
