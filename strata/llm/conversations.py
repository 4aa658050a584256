"""Conversation structure repair (11): a suffix-shared automaton of role/fault signatures.

A row is a symbol: the initial of its role (system, user, assistant, other) with or without a cut-off
text, or one that must go (blank, duplicate). A conversation is a string of symbols; the cheapest edits
that make its role initials ``(s?(ua)+)?`` depend on that string alone.

1. Rows are reduced to (conv_id, turn, role, digest, copies, symbol); texts stay where they are.
2. Dealt by range and sorted, they are cut into blocks of at most ``BLOCK`` symbols, so that a
   conversation of any length is spread over tasks.
3. The distinct blocks, reversed and sorted, are the words of an automaton whose states are
   suffixes, shared from the end: next to its sorted neighbour a word adds only the states beyond the
   common suffix. For each state and each state of the grammar the cost to go and the best audit
   suffix are computed once, for all conversations.
4. What follows a block matters only through its cost to go per grammar state less their minimum: a
   small fixed set of vectors (``contexts``). The last block has the vector of the end.
5. One ordered pass over each conversation picks each block's audit by the state the one before ended
   in and applies it to the rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, drop

BLOCK = 512
# fixed values: blanks, sentence ends, costs of the edits
BLANKS = " \t\n\x0b\x0c\r"
SENTENCE_END = [".", "!", "?"]
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1

# symbols: initial (0 system, 1 user, 2 assistant, 3 other), plus 4 if the text is cut off; these must go:
BLANK, DUPLICATE = 8, 9
# states of the grammar: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
_NEXT = [AFTER_U, AFTER_U, AFTER_A, AFTER_U]  # by an inserted or re-roled turn
_TOLD = ["user", "user", "assistant", "user"]
_KEPT = [{0: AFTER_S, 1: AFTER_U}, {1: AFTER_U}, {2: AFTER_A}, {1: AFTER_U}]
_FAR = 1 << 40
END = -1  # context of the last block: the vector is number 0, the inserts at the end are its own
Level = tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]  # per grammar state: cost to go, audit, end state


def _inserted(cost: list[int], audit: list[str], end: list[int]) -> Level:
    """The level with inserts before it: cheapest first, then the least letter."""
    for _ in STATES:
        for q in STATES:
            to = _NEXT[q]
            if (INSERT + cost[to], "I") <= (cost[q], audit[q][:1] or "~"):
                cost[q], audit[q], end[q] = INSERT + cost[to], "I" + audit[to], end[to]
    return tuple(cost), tuple(audit), tuple(end)


def before(symbol: int, level: Level) -> Level:
    """Cost to go, best audit and end state before a row of this symbol, from those after it."""
    cost, audit, end = level
    costs, audits, ends = [], [], []
    for q in STATES:
        choices = [(DELETE + cost[q], "D", q)]
        if symbol < BLANK:
            off = CUT_OFF if symbol >= 4 else 0
            kept = _KEPT[q].get(symbol % 4)
            if kept is not None:
                choices.append((off + cost[kept], "K", kept))
            choices.append((REROLE + off + cost[_NEXT[q]], "R", _NEXT[q]))
        price, letter, to = min(choices)
        costs.append(price)
        audits.append(letter + audit[to])
        ends.append(end[to])
    return _inserted(costs, audits, ends)


def at_end() -> Level:
    """The end of a conversation: only nothing and whole pairs are accepted."""
    return _inserted([0, _FAR, _FAR, 0], [""] * 4, list(STATES))


@cache
def contexts() -> tuple[list[tuple[int, ...]], dict[tuple[int, int], int]]:
    """Every vector of costs to go, less its minimum, that a row of any symbol can leave (0: as at the end
    of a conversation), and the vector before a symbol for each vector after it."""
    vectors, moves = [at_end()[0]], {}
    number = {vectors[0]: 0}
    for k, after in enumerate(vectors):  # grows while it is walked
        for symbol in range(BLANK + 1):
            cost = before(symbol, (after, ("",) * 4, tuple(STATES)))[0]
            v = tuple(c - min(cost) for c in cost)
            if v not in number:
                number[v] = len(vectors)
                vectors.append(v)
            moves[k, symbol] = number[v]
    return vectors, moves


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, symbol) as a table: one line for equal rows; ``symbol`` is that
    of the first copy, the others are duplicates."""
    role, text = F.col("role"), F.col("text")
    last = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.rtrim(text, F.lit(BLANKS)) == "", BLANK).otherwise(kind + F.when(last.isin(SENTENCE_END), 0).otherwise(4))
    same = (rows.select("conv_id", "turn", "role", digest(), symbol.alias("symbol"))
            .groupBy("conv_id", "turn", "role", "digest", "symbol").agg(F.count("*").alias("copies")))
    same = cut(same, "turns")  # tables on both sides of the join, so that a hot key can be split
    first = cut(same.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("first"))
                .select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn")), "turns-first")
    met = same.join(first.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    again = (F.col("symbol") != BLANK) & ~F.col("turn").eqNullSafe(F.col("_turn"))
    out = cut(met.select("conv_id", "turn", "role", "digest", "copies", F.when(again, DUPLICATE).otherwise(F.col("symbol")).alias("symbol")),
              "turns-symbols")
    drop(same)
    drop(first)
    return out


def digest() -> Column:
    """Identity of a row's role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).alias("digest")


KEY = "turn long, role string, digest binary"
ORDER = ["conv_id", "turn", "role", "digest"]
COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]


class _Block:
    """A run of symbols of one conversation that is being gathered."""

    def __init__(self, key: tuple, sub: int):
        self.key, self.sub = key, sub
        self.signature = bytearray()
        self.count = dict.fromkeys(COUNTS, 0)
        self.low = self.high = None
        self.first = self.last = None

    def add(self, turn, initial: str, symbol: int) -> None:
        self.count["blank"] += symbol == BLANK
        self.count["duplicate"] += symbol == DUPLICATE
        self.count["truncated"] += 4 <= symbol < BLANK
        if self.last is None:
            self.first = initial
        else:
            self.count["illegal"] += self.last + initial not in ("su", "ua", "au")
        if turn is not None and turn != self.high:
            self.count["turns"] += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last = initial
        self.signature.append(min(symbol, BLANK))

    def row(self) -> dict:
        return dict(zip(ORDER, self.key, strict=True), sub=self.sub, tail=bytes(self.signature[::-1]), low=self.low, high=self.high,
                    first=self.first, last=self.last, **self.count)


BLOCKS = f"conv_id CONV, {KEY}, sub int, tail binary, low long, high long, first string, last string, " + ", ".join(f"{c} long" for c in COUNTS)


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _records(batches: Iterable[pa.RecordBatch], step: int = 2000) -> Iterator[dict]:
    for b in batches:
        for k in range(0, b.num_rows, step):
            yield from b.slice(k, step).to_pylist()


def _blocks(symbols: DataFrame, block: int) -> DataFrame:
    """Blocks of the conversations in order; a conversation's rows may lie in several tasks."""
    conv = dict(symbols.dtypes)["conv_id"]
    schema = _arrow(BLOCKS.replace("CONV", conv))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[dict]:
            now = None
            for r in _records(batches):
                key = tuple(r[c] for c in ORDER)
                if now is not None and now.key[0] != key[0]:
                    yield now.row()
                    now = None
                for copy in range(r["copies"]):
                    if now is None:
                        now = _Block(key, 0)
                    elif len(now.signature) >= block:
                        yield now.row()
                        now = _Block(key, now.sub + 1 if now.key == key else 0)
                    symbol = r["symbol"]
                    now.add(r["turn"], r["role"][:1], symbol if copy == 0 or symbol == BLANK else DUPLICATE)
            if now is not None:
                yield now.row()

        yield from _batches(blocks(), schema)

    return symbols.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, BLOCKS.replace("CONV", conv))


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def _with_context(blocks: DataFrame) -> DataFrame:
    """Blocks with ``context``, the vector of what follows them: one pass from each conversation's end."""
    ddl = BLOCKS.replace("CONV", dict(blocks.dtypes)["conv_id"]) + ", context int"
    schema = _arrow(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = contexts()[1]

        def told() -> Iterator[dict]:
            later = None
            for r in _records(batches):
                at = END
                if later is not None and later["conv_id"] == r["conv_id"]:
                    at = max(later["context"], 0)
                    for symbol in later["tail"]:
                        at = moves[at, symbol]
                later = {**r, "context": at}
                yield later

        yield from _batches(told(), schema)

    back = [F.col(c).desc() for c in ORDER[1:] + ["sub"]]
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", *back).mapInArrow(run, ddl)


ANSWERS = "context int, tail binary, costs array<long>, audits array<string>, ends array<int>"


def answers(words: DataFrame) -> DataFrame:
    """Cost, best audit and end state of each block (context, tail: its symbols from the last) from each
    state of the grammar.

    The sorted words are walked as a tree from the end; each state of the automaton (a suffix) is visited
    once, but for those on the way to a task's first word."""
    schema = _arrow(ANSWERS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = contexts()[0]

        def told() -> Iterator[dict]:
            path: list[Level] = []
            context, known = None, b""
            for r in _records(batches):
                tail = r["tail"]
                if r["context"] != context:
                    context, known = r["context"], b""
                    path = [at_end() if context == END else (vectors[context], ("",) * 4, tuple(STATES))]
                shared = 0
                for a, b in zip(known, tail, strict=False):
                    if a != b:
                        break
                    shared += 1
                del path[shared + 1:]
                for symbol in tail[shared:]:
                    path.append(before(symbol, path[-1]))
                known = tail
                cost, audit, end = path[-1]
                # the end's vector is part of the last block's cost, any other belongs to what follows
                later = [0 if context == END else vectors[context][q] for q in end]
                yield {"context": context, "tail": tail, "costs": [c - x for c, x in zip(cost, later, strict=True)],
                       "audits": list(audit), "ends": list(end)}

        yield from _batches(told(), schema, 200)

    words = words.select("context", "tail").distinct()
    return words.repartitionByRange("context", "tail").sortWithinPartitions("context", "tail").mapInArrow(run, ANSWERS)


REPORT = ("conv_id CONV, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
REPAIRED = "conv_id CONV, at long, edit string, role string, text string"


class _Conversation:
    """The ordered pass over one conversation: blocks first told, then their rows edited."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.state = self.grammar = START
        self.todo: deque[str] = deque()
        self.audits: list[str] = []
        self.cost = self.at = 0
        self.count = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.last = None
        self.hash = hashlib.sha256()

    def tell(self, r: dict) -> None:
        audit = r["audits"][self.state]
        self.cost += r["costs"][self.state]
        self.state = r["ends"][self.state]
        self.audits.append(audit)
        self.todo.extend(audit)
        for c in COUNTS:
            self.count[c] += r[c]
        if self.last is not None:
            self.count["illegal"] += self.last + r["first"] not in ("su", "ua", "au")
        self.last = r["last"]
        if r["low"] is not None:
            self.count["turns"] -= r["low"] == self.high
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]

    def emit(self, edit: str, role: str, text: str) -> dict:
        self.grammar = _KEPT[self.grammar]["sua".index(role[0])]
        self.hash.update((("\n" if self.at else "") + role + ":" + text).encode())
        self.at += 1
        return {"conv_id": self.conv_id, "at": self.at - 1, "edit": edit, "role": role, "text": text}

    def inserts(self) -> Iterator[dict]:
        while self.todo and self.todo[0] == "I":
            self.todo.popleft()
            yield self.emit("I", _TOLD[self.grammar], "")

    def edit(self, role: str, text: str) -> Iterator[dict]:
        yield from self.inserts()
        letter = self.todo.popleft()
        if letter == "K":
            yield self.emit("K", role, text)
        elif letter == "R":
            yield self.emit("R", _TOLD[self.grammar], text)

    def report(self) -> dict:
        n = self.count
        gaps = 0 if self.low is None else self.high - self.low + 1 - n["turns"]
        return {"conv_id": self.conv_id, "gaps": gaps, **{c: n[c] for c in COUNTS[:4]}, "cost": self.cost,
                "audit": "".join(self.audits), "repaired_sha256": self.hash.hexdigest()}


def _apply(rows: DataFrame, block: int, report: bool) -> DataFrame:
    conv = dict(rows.dtypes)["conv_id"]
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    symbols = _symbols(rows)
    blocks = cut(_blocks(symbols, block), "turns-blocks")
    drop(symbols)
    told = cut(_with_context(blocks), "turns-context")
    drop(blocks)
    known = cut(answers(told), "turns-answers").withColumnsRenamed({"context": "_context", "tail": "_tail"})
    # both grow with the conversations: the same join at every size
    met = told.join(known.hint("merge"), (F.col("context") == F.col("_context")) & (F.col("tail") == F.col("_tail")))
    met = met.drop("_context", "_tail", "context", "tail").withColumns({"row": F.lit(0), "text": F.lit(None).cast("string")})
    stream = met.unionByName(rows.select("*", digest(), F.lit(1).alias("row"), F.lit(0).alias("sub")), allowMissingColumns=True)
    ddl = (REPORT if report else REPAIRED).replace("CONV", conv)
    schema = _arrow(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[dict]:
            now = None
            for r in _records(batches, 200):
                if now is None or now.conv_id != r["conv_id"]:
                    if now is not None:
                        yield from finish(now)
                    now = _Conversation(r["conv_id"])
                if r["row"] == 0:
                    now.tell(r)
                    continue
                for line in now.edit(r["role"], r["text"]):
                    if not report:
                        yield line
            if now is not None:
                yield from finish(now)

        def finish(now: _Conversation) -> Iterator[dict]:
            for line in now.inserts():
                if not report:
                    yield line
            if report:
                yield now.report()

        yield from _batches(out(), schema, 500)

    return stream.repartition("conv_id").sortWithinPartitions(*ORDER, "row", "sub").mapInArrow(run, ddl)


def repair_report(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: ``gaps`` (turn numbers missing between the least and the greatest), the
    rows' first faults (``blank``, ``duplicate``, ``truncated``), ``illegal`` (neighbours whose role
    initials are not su, ua or au), the least ``cost`` of a repair, its ``audit`` (initials of the edits
    Keep, Rerole, Delete, Insert in order; of the cheapest the ASCII-least) and the SHA-256 of the
    repaired ``role:text`` lines.

    ``rows`` has conv_id, turn, role and text; other columns are left alone. Rows are in the order of turn
    (null first), then role, then the SHA-256 of role and text; rows that repeat are neighbours and, but
    for the first, duplicates. A null role or text is one space; a null conv_id is a conversation like
    others. A text without a character other than blanks (null and empty ones too) must go. A role whose
    first letter is not s, u or a (capitals too) can be re-roled or deleted only. Texts of any length are
    whole. An empty table gives an empty table. A conversation's rows are dealt over the tasks up to the
    last pass, where its hash and audit, which are sequential, are made in one task that holds one row
    at a time and the audit.
    """
    return _apply(rows, block, True)


def repaired_rows(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: (conv_id, at from 0, edit K, R or I, role, text). Rules as in
    ``repair_report``; conversations that lose every row are absent."""
    return _apply(rows, block, False)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 goes, 1 loses its text, 2 its
    sentence ends, 3 comes twice, 4 becomes a user's."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, "".join(SENTENCE_END), "")).otherwise(text)
    role = F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", space))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")
