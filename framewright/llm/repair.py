"""Cheapest repairs of the roles of conversations, by a dynamic program with checkpoints.

Every row of a conversation is kept, given another role or deleted, and rows may be inserted, so
that the initials of the roles give ``(s?(ua)+)?``. A row counts only through its initial and its
fault, so a conversation is a string of one letter a row. Four states say what came last
(nothing, s, u or a); a backward pass gives the cost of the rest from each of them, and a walk
forward takes, among the edits that keep to this cost, the least letter.

A conversation of n rows is cut into blocks of about the square root of n. A block alone gives
the costs between its ends for all states (a 4 x 4 matrix under minimum and sum); these matrices,
one row a block, give the state costs at the blocks' ends, the checkpoints, from the last to the
first. Then each block works out its inner costs again from its checkpoint and walks forward from
every state that it may start in; which of the walks holds follows from the blocks before. So
neither the costs nor the rows of a conversation are ever held together. The digest of the
repaired text reads its rows in order as they come, one at a time: SHA-256 has no parallel form.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.ordering import numbered
from framewright.llm.texts import slices
from framewright.session import stage

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: Faults in order of precedence; the first two must be deleted.
FAULTS = ("", "truncated", "blank", "duplicate")
INITIALS = "sua"

# States: what came last. Which initial leads where, and which initial a new or changed row gets.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEW_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
NEXT = {q: AFTER[q, NEW_ROLE[q][0]] for q in STATES}
FAR = 1 << 40


def letter(initial: Column, fault: Column) -> Column:
    """One character for a row: its initial (s, u, a or another) and its fault."""
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(ord("A")) + place * len(FAULTS) + fault)


def _read(code: str) -> tuple[str, str]:
    place, fault = divmod(ord(code) - ord("A"), len(FAULTS))
    return (INITIALS + "?")[place], FAULTS[fault]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """The costs when rows may be inserted first; at most three can be of use."""
    for _ in STATES:
        costs = [min(FAR, costs[q], COST[INSERT] + costs[NEXT[q]]) for q in STATES]
    return tuple(costs)


def _edits(code: str, q: int) -> list[tuple[str, int, int]]:
    """What may become of a row in state q: letter, its cost, next state."""
    initial, fault = _read(code)
    found = [(DELETE, COST[DELETE], q)]
    if fault not in ("blank", "duplicate"):
        late = TRUNCATED_COST * (fault == "truncated")
        if (q, initial) in AFTER:
            found.append((KEEP, COST[KEEP] + late, AFTER[q, initial]))
        found.append((REROLE, COST[REROLE] + late, NEXT[q]))
    return found


@lru_cache(maxsize=1 << 16)
def _step(code: str, rest: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """The costs before a row, of those after it, and for each state the least letters up to and
    with the row that keep to them, and the state after it."""
    own = [min(FAR, *(cost + rest[to] for _, cost, to in _edits(code, q))) for q in STATES]
    costs = _with_inserts(own)

    def walk(q):
        letters = ""
        while True:
            tight = [(e, to) for e, cost, to in _edits(code, q) if cost + rest[to] == costs[q]]
            if costs[q] == COST[INSERT] + costs[NEXT[q]]:
                tight.append((INSERT, NEXT[q]))
            edit, to = min(tight)
            letters, q = letters + edit, to
            if edit != INSERT:
                return letters, q

    return costs, tuple(walk(q) if costs[q] < FAR else ("", q) for q in STATES)


#: The costs after the last row: a conversation may end with nothing or with the assistant.
END = _with_inserts([0, FAR, FAR, 0])


def _ending(q: int) -> str:
    """The rows to insert after the last one."""
    return INSERT * (END[q] // COST[INSERT])


def backward(codes: str, rest: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before some rows, of those after them."""
    base = 0
    for code in reversed(codes):
        rest, _ = _step(code, rest)
        low = min(rest)
        rest, base = tuple(c - low if c < FAR else c for c in rest), base + low
    return tuple(c + base if c < FAR else c for c in rest)


def matrix(codes: str) -> list[int]:
    """The costs from each state before some rows to each state after them, row by row."""
    columns = [backward(codes, tuple(0 if q == to else FAR for q in STATES)) for to in STATES]
    return [min(columns[to][q], FAR) for q in STATES for to in STATES]


def walks(codes: str, rest: tuple[int, ...], starts=STATES) -> dict[int, tuple[str, int]]:
    """For each state before some rows: the least cheapest letters and the state after them."""
    moves = []
    low = min(rest)
    rest = tuple(c - low if c < FAR else c for c in rest)
    for code in reversed(codes):
        rest, move = _step(code, rest)
        low = min(rest)
        rest = tuple(c - low if c < FAR else c for c in rest)
        moves.append(move)
    found = {}
    for start in starts:
        q, letters = start, []
        for move in reversed(moves):
            more, q = move[q]
            letters.append(more)
        found[start] = "".join(letters), q
    return found


def illegal_pairs(codes: str) -> int:
    initials = "".join(_read(c)[0] for c in codes)
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _same() -> Column:
    """Role and text by their digest, so that no text moves."""
    return F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256).substr(1, 32)


def marked(rows: DataFrame) -> DataFrame:
    """``name, turn, position, total, code`` of the rows ``name, turn, role, text``: their places
    by turn (null first, then role, text) and their letters."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1)
    narrow = rows.select("name", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), _same().alias("same"))
    placed = stage(numbered(narrow, "name", [F.col("turn").asc_nulls_first(), F.col("same")]), "places")
    first = placed.where("fault <> 2").groupBy("name", "same").agg(F.min("position").alias("first"), F.count("*").alias("n")).where("n > 1")
    placed = placed.join(first.drop("n"), ["name", "same"], "left")
    fault = F.when(F.col("fault") == 2, 2).when(F.col("position") > F.col("first"), 3).otherwise(F.col("fault"))
    return placed.select("name", "turn", "position", "total", letter(F.col("initial"), fault).alias("code"))


def _blocks(rows: DataFrame, least: int) -> DataFrame:
    """``name, block, last, codes``: blocks of ``least`` rows, or of the square root of the conversation's."""
    size = F.greatest(F.lit(least), F.ceil(F.sqrt("total")).cast("long"))
    rows = rows.withColumn("block", F.floor(F.col("position") / size)).withColumn("last", F.floor((F.col("total") - 1) / size))
    codes = F.array_join(F.array_sort(F.collect_list(F.struct("position", "code")))["code"], "")
    return stage(rows.groupBy("name", "block", "last").agg(codes.alias("codes")), "blocks")


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations of several, with ``rest``: the state costs after each."""

    def costs(batches):
        for batch in batches:
            found = [matrix(c) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "costs"])

    def backwards(batches):
        name, rest = None, END
        for batch in batches:
            found = []
            for own, table in zip(batch.column("name").to_pylist(), batch.column("costs").to_pylist()):
                if own != name:
                    name, rest = own, END
                found.append(list(rest))
                rest = tuple(min(table[4 * q + to] + rest[to] for to in STATES) for q in STATES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(pa.int64()))], names=["name", "block", "last", "codes", "rest"])

    schema = "name string, block long, last long, codes string"
    dealt = blocks.mapInArrow(costs, f"{schema}, costs array<long>").repartition("name").sortWithinPartitions("name", F.desc("block"))
    return dealt.mapInArrow(backwards, f"{schema}, rest array<long>")


def _walked(blocks: DataFrame) -> DataFrame:
    """``name, block, last, codes, walks``: letters and end state, for each state before the block."""

    def run(batches):
        for batch in batches:
            block, codes, rest = (batch.column(c).to_pylist() for c in ("block", "codes", "rest"))
            found = []
            for b, c, r in zip(block, codes, rest):
                own = walks(c, tuple(r), STATES if b else [START])
                found.append([{"letters": own[q][0], "state": own[q][1]} if q in own else None for q in STATES])
            kind = pa.list_(pa.struct([("letters", pa.string()), ("state", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, kind)], names=["name", "block", "last", "codes", "walks"])

    schema = "name string, block long, last long, codes string, walks array<struct<letters:string,state:int>>"
    return blocks.mapInArrow(run, schema)


def repair(rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", least: int = 64) -> DataFrame:
    """One row per conversation: conversation, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    Rows are taken by turn, null first, those of one turn by a digest of role and text; a null
    role or text is one space; a null conversation is one. ``gaps`` counts the turns that lack
    between the least and the greatest. A row's first fault counts: blank (nothing but white
    space), duplicate (role and text seen earlier), truncated (the last visible character is none
    of ``.!?``). Edits cost: keep 0, other role 2, delete 3 (a must for blank and duplicate rows),
    insert 2; a truncated row that stays costs 1. ``audit`` has the letters of the cheapest edits
    in order, the ASCII-least of these; ``repaired_sha256`` is of the lines ``role:text``.
    Repeated rows are rows of their own; other columns are ignored; no rows give no rows.
    """
    kind = rows.schema[conversation].dataType
    name = F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit(""))
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(name.alias("name"), F.col(turn).cast("long").alias("turn"), written(role).alias("role"), written(text).alias("text"))
    blocks = _blocks(marked(rows), least)
    walked = blocks.where("last = 0").withColumn("rest", F.array(*[F.lit(c).cast("long") for c in END]))
    several = blocks.where("last > 0")
    if not several.isEmpty():
        walked = walked.unionByName(_checkpoints(several))
    parts = _walked(walked).select("name", F.lit(0).alias("kind"), "block", "codes", "walks")
    lines = rows.select("name", F.lit(1).alias("kind"), "turn", _same().alias("same"), "role", "text")
    dealt = parts.unionByName(lines, allowMissingColumns=True).repartition("name")
    dealt = dealt.sortWithinPartitions("name", "kind", "block", F.col("turn").asc_nulls_first(), "same")
    found = dealt.select("name", "kind", "codes", "walks", "role", "text").mapInArrow(_finish, ", ".join(f"{n} {t}" for n, t in FOUND.items()))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    found = found.join(rows.groupBy("name").agg(gaps.alias("gaps")), "name")
    label = F.when(F.col("name") != "", F.substring("name", 2, 2**31 - 1)).cast(kind)
    return found.select(label.alias(conversation), "gaps", *list(FOUND)[1:])


#: What the last pass gives for each conversation.
FOUND = {"name": "string"} | dict.fromkeys(["blank", "duplicate", "truncated", "illegal", "cost"], "long") | {"audit": "string", "repaired_sha256": "string"}


class _Conversation:
    """What is known of one conversation while its blocks and then its rows pass by."""

    def __init__(self, name: str):
        self.name, self.state, self.letters, self.last = name, START, [], ""
        self.counts, self.illegal = dict.fromkeys(FAULTS, 0), 0
        self.digest, self.audit, self.at, self.empty = hashlib.sha256(), None, 0, True

    def block(self, codes: str, walk: list[dict]) -> None:
        self.illegal += illegal_pairs(self.last + codes)
        self.last = codes[-1:]
        for code in set(codes):
            self.counts[_read(code)[1]] += codes.count(code)
        self.letters.append(walk[self.state]["letters"])
        self.state = walk[self.state]["state"]

    def begin(self) -> None:
        self.audit, self.truncated = "".join(self.letters) + _ending(self.state), 0
        self.letters, self.state = [], START

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.line(NEW_ROLE[self.state], "")
            self.state, self.at = NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        if self.audit is None:
            self.begin()
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == DELETE:
            return
        new = role if edit == KEEP else NEW_ROLE[self.state]
        self.line(new, text)
        self.state = AFTER[self.state, new[0]]
        self.truncated += not text.rstrip(BLANKS).endswith((".", "!", "?"))

    def end(self) -> tuple:
        self.inserts()
        cost = sum(COST[e] * self.audit.count(e) for e in COST) + TRUNCATED_COST * self.truncated
        return (self.name, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"], self.illegal, cost, self.audit, self.digest.hexdigest())


def _finish(batches):
    """Conversations in turn: first their blocks in order, then their rows."""
    held = None

    kinds = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in FOUND.items()])
    told = lambda rows: pa.RecordBatch.from_pylist([dict(zip(FOUND, r)) for r in rows], kinds)
    for batch in slices(batches, "text"):
        found = []
        for name, kind, codes, walk, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held.name != name:
                if held:
                    found.append(held.end())
                held = _Conversation(name)
            if kind:
                held.row(role, text)
            else:
                held.block(codes, walk)
        yield told(found)
    if held:
        yield told([held.end()])
