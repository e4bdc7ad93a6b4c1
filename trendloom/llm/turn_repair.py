"""Repair the structure of conversations by the cheapest edits: roles must follow ``(s?(ua)+)?``.

A conversation may begin with a system turn; then user and assistant alternate, a user first and an assistant last. Turns
can be kept, given another role, deleted, and empty ones inserted. Blank turns and repeats must go; a turn that breaks off
may stay at a price.

The search is a depth-first branch-and-bound over the turns: an explicit stack of prefixes, suffix lower bounds from a relaxed
pattern, an incumbent (cost, audit), and for each node (turn, state of the pattern) a table of the best prefix that reached it.
The cheapest edits win; of equally cheap ones those whose initials, in order, come first in ASCII.

Conversations can be long, and one may hold a good part of all turns:

1. Equal turns at one place are one row with a count, and repeats are found by a hash of role and text.
2. Turns without their texts are dealt by ranges of conversation and turn, so that one conversation spreads over many tasks.
   Each task cuts its conversations into pieces of at most ``PIECE`` turns and searches each piece from the states it can
   begin with to those it can end with.
3. The few pieces of a long conversation are chained: best prefix by state, piece after piece. Equally cheap prefixes over the
   same turns are never a beginning of one another, so their order in ASCII outlives whatever follows.
4. The edits are applied to the turns as these stream by in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import ship_package, stage

PIECE = 256


@dataclass(frozen=True)
class Costs:
    """Prices of the edits; an undeleted turn that breaks off costs ``truncated`` more. All are above zero."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.rerole, self.delete, self.insert, self.truncated) <= 0:
            raise ValueError("prices must be above zero")


COSTS = Costs()

# States of the pattern: nothing yet, a system turn only, a user turn last, an assistant turn last.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
#: The role that a turn with a new role, or an inserted turn, takes in each state, and the state after it.
_EXPECTED = ("user", "user", "assistant", "user")
_AFTER = (USER, USER, ASSISTANT, USER)
#: Turns that must still be inserted at the end.
_OPEN = (0, 2, 1, 0)

# A turn is one letter to the search: the initial of its role (o: another), a capital if it breaks off, x if it must go.


def _kept_state(state: int, initial: str) -> int | None:
    """The state after a turn that keeps its role, None where it can't stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    return _AFTER[state] if initial == _EXPECTED[state][0] else None


def _moves(code: str, state: int, costs: Costs) -> list[tuple[int, str, int]]:
    """(cost, edits, next state) of all ways past one turn: up to two insertions, then what becomes of the turn."""
    out = []
    initial, extra = code.lower(), costs.truncated if code.isupper() else 0
    for inserted in range(3):
        price, edits = inserted * costs.insert, "I" * inserted
        out.append((price + costs.delete, edits + "D", state))
        if code != "x":
            if (kept := _kept_state(state, initial)) is not None:
                out.append((price + extra, edits + "K", kept))
            if initial != _EXPECTED[state][0]:
                out.append((price + costs.rerole + extra, edits + "R", _AFTER[state]))
        state = _AFTER[state]
    return out


def suffix_bounds(codes: str, costs: Costs) -> list[tuple[int, int]]:
    """For each turn, least costs from there on if a user or if an assistant is expected.

    The pattern is relaxed: system turns may stand anywhere, and the end may come at any time.
    """
    bounds = [(0, 0)]
    for code in reversed(codes):
        initial, extra, after = code.lower(), costs.truncated if code.isupper() else 0, bounds[-1]
        plain = []
        for expected in (0, 1):
            ways = [costs.delete + after[expected]]
            if code != "x":
                if initial == "s":
                    ways.append(extra + after[expected])
                ways.append((0 if initial == "ua"[expected] else costs.rerole) + extra + after[1 - expected])
            plain.append(min(ways))
        bounds.append(tuple(min(plain[e], costs.insert + plain[1 - e]) for e in (0, 1)))
    return bounds[::-1]


@lru_cache(maxsize=50_000)
def search(codes: str, entry: int = START, whole: bool = True, costs: Costs = COSTS) -> dict[int, tuple[int, str]]:
    """The best (cost, edits) from state ``entry`` over all turns, by the state they end in.

    With ``whole`` the conversation ends there, so what the pattern lacks is inserted, and all ends count as one, START.
    """
    bounds = suffix_bounds(codes, costs)
    ends = (START,) if whole else _STATES
    best: dict[int, tuple[int, str]] = {}
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, edits = stack.pop()
        if reached.get((at, state), (cost, edits)) < (cost, edits):
            continue  # a better prefix came here meanwhile
        if at == len(codes):
            end = START if whole else state
            found = (cost + _OPEN[state] * costs.insert, edits + "I" * _OPEN[state]) if whole else (cost, edits)
            best[end] = min(best.get(end, found), found)
            continue
        children = []
        for price, letters, after in _moves(codes[at], state, costs):
            child = (cost + price, edits + letters)
            least = child[0] + bounds[at + 1][after == USER]
            if len(best) == len(ends) and all((least, child[1]) > (b[0], b[1][: len(child[1])]) for b in best.values()):
                continue
            if child < reached.get((at + 1, after), (child[0], child[1] + "~")):
                reached[at + 1, after] = child
                children.append((least, child[1], after, child[0]))
        stack += [(at + 1, after, price, letters) for _, letters, after, price in sorted(children, reverse=True)]
    return best


@dataclass
class _Chain:
    """Best prefixes of a conversation by state, over the pieces seen so far; of each piece it keeps the way back."""

    costs: dict[int, int] = field(default_factory=lambda: {START: 0})
    ranks: dict[int, int] = field(default_factory=lambda: {START: 0})
    back: list[dict[int, tuple[int, str]]] = field(default_factory=list)

    def add(self, table: list[tuple[int, int, int, str]]) -> None:
        """table: (entry, end, cost, edits) of the next piece."""
        found: dict[int, tuple[int, int, str, int]] = {}
        for entry, end, cost, edits in table:
            if entry in self.costs:
                way = (self.costs[entry] + cost, self.ranks[entry], edits, entry)
                found[end] = min(found.get(end, way), way)
        order = sorted(found, key=lambda end: found[end][1:3])
        self.costs = {end: way[0] for end, way in found.items()}
        self.ranks = {end: order.index(end) for end in found}
        self.back.append({end: (way[3], way[2]) for end, way in found.items()})

    def result(self, costs: Costs) -> tuple[int, str]:
        """Cost and edits of the whole conversation. Prefixes in different states differ before the end of either."""
        total = {state: cost + _OPEN[state] * costs.insert for state, cost in self.costs.items()}
        state = min(total, key=lambda s: (total[s], self.ranks[s]))
        edits, cost = ["I" * _OPEN[state]], total[state]
        for ways in reversed(self.back):
            state, letters = ways[state]
            edits.append(letters)
        return cost, "".join(reversed(edits))


_LEGAL = {"su", "ua", "au"}
_PIECE_FIELDS = (
    "part int, number long, first_turn long, last_turn long, distinct_turns long, first_initial string, last_initial string,"
    " blank long, duplicate long, truncated long, illegal long, ways array<struct<entry: int, end: int, cost: long, edits: string>>"
)


class _Piece:
    """Turns in a row of one conversation."""

    def __init__(self):
        self.codes: list[str] = []
        self.first_turn = self.last_turn = self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def take(self, turn: int | None, initial: str, fault: str | None) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.codes:
            self.illegal += self.last + initial not in _LEGAL
        else:
            self.first = initial
        self.last = initial
        if fault:
            self.faults[fault] += 1
        code = initial if initial in ("s", "u", "a") else "o"
        self.codes.append("x" if fault in ("blank", "duplicate") else code.upper() if fault else code)

    def ways(self, costs: Costs) -> list[dict]:
        """From all states: a task can't see whether its conversation began before."""
        codes = "".join(self.codes)
        return [
            {"entry": entry, "end": end, "cost": cost, "edits": edits}
            for entry in _STATES
            for end, (cost, edits) in search(codes, entry, False, costs).items()
        ]


def _cut_into_pieces(costs: Costs, most: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, now, piece, out = TaskContext.get().partitionId(), 0, None, None, []

        def closed() -> dict:
            return {
                "conv_id": now[0], "part": part, "number": number, "first_turn": piece.first_turn, "last_turn": piece.last_turn,
                "distinct_turns": piece.turns, "first_initial": piece.first, "last_initial": piece.last, **piece.faults,
                "illegal": piece.illegal, "ways": piece.ways(costs),
            }

        for batch in batches:
            for row in batch.to_pylist():
                for copy in range(row["copies"]):
                    if piece is None or now != (row["conv_id"],) or len(piece.codes) >= most:
                        if piece is not None:
                            out.append(closed())
                            number += 1
                        now, piece = (row["conv_id"],), _Piece()
                    piece.take(row["turn"], row["initial"], row["fault"] if copy == 0 or row["fault"] == "blank" else "duplicate")
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if piece is not None:
            out.append(closed())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _chained(costs: Costs, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come sorted by conversation and place."""
        now, chain, sums, last, out = None, None, None, None, []

        def closed() -> dict:
            cost, edits = chain.result(costs)
            gaps = 0 if sums["low"] is None else last["last_turn"] - sums["low"] + 1 - sums["turns"]
            return {"conv_id": now[0], "gaps": gaps, **{k: sums[k] for k in _COUNTS}, "cost": cost, "audit": edits}

        for batch in batches:
            for piece in batch.to_pylist():
                if now != (piece["conv_id"],):
                    if now is not None:
                        out.append(closed())
                    now, chain, last = (piece["conv_id"],), _Chain(), None
                    sums = {"low": None, "turns": 0, **dict.fromkeys(_COUNTS, 0)}
                chain.add([(w["entry"], w["end"], w["cost"], w["edits"]) for w in piece["ways"]])
                for k in _COUNTS:
                    sums[k] += piece[k]
                if last is not None:
                    sums["illegal"] += last["last_initial"] + piece["first_initial"] not in _LEGAL
                if sums["low"] is None:
                    sums["low"] = piece["first_turn"]
                sums["turns"] += piece["distinct_turns"] - (last is not None and piece["first_turn"] is not None and piece["first_turn"] == last["last_turn"])
                last = {"last_initial": piece["last_initial"], "last_turn": piece["last_turn"] if piece["last_turn"] is not None else last and last["last_turn"]}
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            out.append(closed())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _applied(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each conversation its edits come first, then its turns in order."""
        now, edits, at, state, place, out, size = None, "", 0, START, 0, [], 0

        def written(role: str, text: str, edit: str) -> None:
            nonlocal place, size
            out.append({"conv_id": now[0], "place": place, "role": role, "text": text, "edit": edit})
            place, size = place + 1, size + len(text)

        def insertions() -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                written(_EXPECTED[state], "", "I")
                at, state = at + 1, _AFTER[state]

        for batch in (part for whole in batches for part in common.slices(whole)):
            for row in batch.to_pylist():
                if row["edits"] is not None:
                    insertions()
                    now, edits, at, state, place = (row["conv_id"],), row["edits"], 0, START, 0
                    continue
                for _ in range(row["copies"]):
                    insertions()
                    edit, at = edits[at], at + 1
                    if edit == "K":
                        written(row["role"], row["text"], edit)
                        state = _kept_state(state, row["role"][:1])
                    elif edit == "R":
                        written(_EXPECTED[state], row["text"], edit)
                        state = _AFTER[state]
                if size > 1 << 22 or len(out) > 2000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        insertions()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _hashed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 of each conversation's ``role:text``, joined by newlines, from its turns in order."""
        now, digest, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now != (row["conv_id"],):
                    if now is not None:
                        out.append({"conv_id": now[0], "repaired_sha256": digest.hexdigest()})
                    now, digest = (row["conv_id"],), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{row['role']}:{row['text']}".encode())
        if now is not None:
            out.append({"conv_id": now[0], "repaired_sha256": digest.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _null_safe(a: str, b: str, *names: str) -> Column:
    on = [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    return on[0] if len(on) == 1 else on[0] & _null_safe(a, b, *names[1:])


def _schemas(df: DataFrame, fields: str) -> tuple[str, pa.Schema]:
    """conv_id as in df with further fields, for Spark and for Arrow."""
    ddl = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {fields}"
    return ddl, df.sparkSession.createDataFrame([], ddl).toArrow().schema


def collapsed(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, copies: equal turns at one place as one row. Nulls in role and text are one space.

    ``copies`` may name a column that says how often a row stands.
    """
    copies = (F.col(copies) if copies else F.lit(1)).cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, copies.alias("copies"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")})


def audits(turns: DataFrame, costs: Costs = COSTS, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation of collapsed turns.

    Turns go by number, null ones first; turns of one number by a hash of role and text. A turn's first fault counts: blank (no character but
    space and U+0009 to U+000D), duplicate (role and text seen earlier), truncated (the last such character is none of ``.!?``).
    """
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn"))
    repeats = turns.groupBy("conv_id", "h1", "h2").agg(earliest.alias("first"), F.count("*").alias("places")).where("places > 1")
    repeats = stage(repeats.select("conv_id", "h1", "h2", "first"), "repeats")
    ending = F.rtrim(F.col("text"), F.lit(common.SPACES))
    fault = F.when(ending == "", "blank").when(~F.substring(ending, -1, 1).isin(".", "!", "?"), "truncated")
    narrow = turns.select("conv_id", "turn", "h1", "h2", "copies", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")).alias("t")
    seen = F.col("r.h1").isNotNull() & ~F.col("r.first.turn").eqNullSafe(F.col("t.turn"))
    told = narrow.join(repeats.alias("r"), _null_safe("t", "r", "conv_id", "h1", "h2"), "left")
    told = told.select("t.*", seen.alias("seen")).withColumn("fault", F.when((F.col("fault") == "blank") | ~F.col("seen"), F.col("fault")).otherwise("duplicate"))
    order = ["conv_id", "turn", "h1", "h2"]
    dealt = told.repartitionByRange(*order).sortWithinPartitions(*order).drop("h1", "h2", "seen")
    ddl, schema = _schemas(turns, _PIECE_FIELDS)
    pieces = stage(dealt.mapInArrow(_cut_into_pieces(costs, piece, schema), ddl), "pieces")
    ddl, schema = _schemas(turns, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    chains = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    return chains.mapInArrow(_chained(costs, schema), ddl)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text and edit (K, R or I) of all turns after the edits.

    The turns of a conversation pass through one task in order, none is held.
    """
    kind = {"audit": F.lit(0), "turn": F.lit(1)}
    given = turns.select("conv_id", kind["turn"].alias("kind"), "turn", "h1", "h2", "role", "text", "copies", F.lit(None).cast("string").alias("edits"))
    nothing = {"turn": "long", "h1": "long", "h2": "long", "role": "string", "text": "string", "copies": "long"}
    edits = audited.select("conv_id", kind["audit"].alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], F.col("audit").alias("edits"))
    both = given.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "h1", "h2")
    ddl, schema = _schemas(turns, "place long, role string, text string, edit string")
    return both.drop("kind", "turn", "h1", "h2").mapInArrow(_applied(schema), ddl)


def repair(turns: DataFrame, costs: Costs = COSTS, copies: str | None = None, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired turns) of a table conv_id, turn, role, text; see :func:`audits` and :func:`repaired`.

    Conversations with the id null are one conversation. Texts count whole, however long; repeated rows are duplicates, and an empty
    table gives none. Further columns are ignored; ``copies`` may name one that says how often a row stands.
    """
    ship_package(turns.sparkSession)
    rows = stage(collapsed(turns, copies), "turns")
    audited = stage(audits(rows, costs, piece), "audits")
    return audited, repaired(rows, audited)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the table with one row in 20 dropped, one emptied, one without ``.!?``, one doubled, one given the role user.

    Which is which follows from the CRC-32 of ``conv_id:turn``; nulls are one space.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    lot = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1])), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.where(lot != 0).select(
        "conv_id",
        "turn",
        F.when(lot == 4, "user").otherwise(role).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(lot == 3, 2).otherwise(1).alias("copies"),
    )


def repair_report(conversations: DataFrame, costs: Costs = COSTS) -> DataFrame:
    """One row for each conv_id of the table before the damage: the audit columns and repaired_sha256.

    Where no turn is left, numbers are zero, the audit is empty and the hash that of the empty string.
    """
    audited, turns = repair(damaged(conversations), costs, "copies")
    ddl, schema = _schemas(conversations, "repaired_sha256 string")
    hashes = turns.select("conv_id", "role", "text").mapInArrow(_hashed(schema), ddl)
    ids = conversations.select("conv_id").distinct().alias("c")
    joined = ids.join(audited.alias("a"), _null_safe("c", "a", "conv_id"), "left").join(hashes.alias("h"), _null_safe("c", "h", "conv_id"), "left")
    numbers = [F.coalesce(F.col(f"a.{n}"), F.lit(0)).cast("long").alias(n) for n in ("gaps", *_COUNTS, "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    return joined.select("c.conv_id", *numbers, F.coalesce("a.audit", F.lit("")).alias("audit"), F.coalesce("h.repaired_sha256", empty).alias("repaired_sha256"))
