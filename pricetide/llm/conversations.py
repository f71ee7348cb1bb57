"""Cheapest repair of turn structure, by tables over blocks of turns.

A repaired conversation reads ``(s?(ua)+)?`` in role initials: an optional system turn, then
user and assistant in alternation. Every turn is one of nine symbols (its initial, whether it is
cut short, or that it must go), and the least cost of repairing all that follows is a vector
over four states (nothing yet, after system, after user, after assistant). Differences within
such a vector are bounded, so few vectors exist once their least entry is taken off. `BlockTables` holds, for every
vector and every block of ``BLOCK`` symbols, the vector before the block and what was taken off.

Conversations of any length are cut into pieces by a range shuffle on their order. A piece's effect is a map
from vector to vector, looked up block by block; maps of one conversation's pieces are composed, and each
piece is then traced on its own from all four states it may begin in.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.sources.paths import stage

# Fixed values of the task: costs, and the characters that are white space or end a sentence.
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"

# Symbols: an initial (s, u, a, other) in lower case, in upper case when the turn is cut short, x
# for a turn that must go.
SYMBOLS = "sSuUaAoOx"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# The state after a user or assistant turn was put next; a system turn only comes first.
NEXT = (USER, USER, ASSISTANT, USER)
BLOCK = 4
# Turns of one range partition, about; a longer conversation has several pieces.
PART_TURNS = 100_000


def _kept(state: int, symbol: str) -> int | None:
    """The state after keeping a turn as it is, if the pattern allows that."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == NOTHING else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if role == "a" and state == USER else None


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Cost when no turn is left, by state.
END = _with_inserts([0, 10**6, 10**6, 0])


def before(after: tuple[int, ...], symbol: str) -> tuple[int, ...]:
    """Cost vector before a turn, from that after it."""
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if symbol != "x":
            extra = CUT_SHORT if symbol.isupper() else 0
            best = min(best, REROLE + extra + after[NEXT[state]])
            kept = _kept(state, symbol)
            if kept is not None:
                best = min(best, extra + after[kept])
        costs.append(best)
    return _with_inserts(costs)


def _turn(here: tuple[int, ...], after: tuple[int, ...], symbol: str, state: int) -> tuple[str, int]:
    """Edits at one turn on the cheapest way, and the state they lead to.

    Where several ways cost the same, the ASCII-least letter goes first: Delete, Insert, Keep,
    Rerole. A letter and a state have one outcome, so this gives the least audit as a whole.
    """
    edits = ""
    extra = CUT_SHORT if symbol.isupper() else 0
    while True:
        if here[state] == DELETE + after[state]:
            return edits + "D", state
        if here[state] == INSERT + here[NEXT[state]]:
            state = NEXT[state]
            edits += _inserted(state)
            continue
        kept = _kept(state, symbol)
        if kept is not None and here[state] == extra + after[kept]:
            return edits + "K", kept
        state = NEXT[state]
        return edits + ("U" if state == USER else "A"), state


def _inserted(state: int) -> str:
    return "u" if state == USER else "a"


class BlockTables:
    """All normalised cost vectors, and what every symbol and every block makes of each."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]
        known = {END: 0}
        steps = []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in SYMBOLS:
                costs = before(vector, symbol)
                low = min(costs)
                costs = tuple(c - low for c in costs)
                if costs not in known:
                    known[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append((known[costs], low))
            steps.append(row)
        step = np.array(steps, dtype=np.int32)
        self.step_to, self.step_off = step[:, :, 0], step[:, :, 1]
        size = len(self.vectors)
        to = np.arange(size, dtype=np.int32)[:, None]
        off = np.zeros((size, 1), dtype=np.int32)
        for _ in range(block):  # one more symbol in front, as the highest digit
            off = np.concatenate([off + self.step_off[to, c] for c in range(len(SYMBOLS))], axis=1)
            to = np.concatenate([self.step_to[to, c] for c in range(len(SYMBOLS))], axis=1)
        self.to, self.off = to, off
        self._traced: dict = {}

    def blocks(self, symbols: str) -> tuple[list[int], str]:
        """Codes of the full blocks from the front, and the symbols left over."""
        n = len(symbols) // self.block * self.block
        codes = []
        for begin in range(0, n, self.block):
            code = 0
            for symbol in symbols[begin : begin + self.block]:
                code = code * len(SYMBOLS) + SYMBOLS.index(symbol)
            codes.append(code)
        return codes, symbols[n:]

    def effect(self, symbols: str) -> tuple[np.ndarray, np.ndarray]:
        """Vector before the symbols and cost taken off, for every vector after them."""
        codes, rest = self.blocks(symbols)
        to = np.arange(len(self.vectors), dtype=np.int32)
        off = np.zeros(len(to), dtype=np.int64)
        for symbol in reversed(rest):
            c = SYMBOLS.index(symbol)
            off += self.step_off[to, c]
            to = self.step_to[to, c]
        for code in reversed(codes):
            off += self.off[to, code]
            to = self.to[to, code]
        return to, off

    def traced_block(self, vector: int, symbols: str, state: int) -> tuple[list[str], int]:
        """A block expanded backward from the vector after it, then followed from ``state``."""
        key = (vector, symbols, state)
        if key not in self._traced:
            costs = [self.vectors[vector]]
            for symbol in reversed(symbols):
                costs.append(before(costs[-1], symbol))
            costs.reverse()
            edits = []
            for k, symbol in enumerate(symbols):
                edit, state = _turn(costs[k], costs[k + 1], symbol, state)
                edits.append(edit)
            self._traced[key] = (edits, state)
        return self._traced[key]

    def trace(self, symbols: str, vector: int, states: list[int], last: bool) -> list[tuple[list[str], int]]:
        """Edits of each turn and the final state, for each state to begin in.

        ``vector`` is the cost vector after the symbols; ``last`` adds the turns missing at the
        conversation's end to the last turn's edits.
        """
        codes, rest = self.blocks(symbols)
        ends = [vector]
        for symbol in reversed(rest):
            ends.append(int(self.step_to[ends[-1], SYMBOLS.index(symbol)]))
        rest_ends = ends[::-1][1:]
        at = ends[-1]
        block_ends = []
        for code in reversed(codes):
            block_ends.append(at)
            at = int(self.to[at, code])
        block_ends.reverse()
        parts = [(v, symbols[k * self.block : (k + 1) * self.block]) for k, v in enumerate(block_ends)]
        parts += list(zip(rest_ends, rest))
        found = []
        for state in states:
            edits: list[str] = []
            for v, part in parts:
                more, state = self.traced_block(v, part, state)
                edits += more
            while last and state in (SYSTEM, USER):
                state = NEXT[state]
                edits[-1] += _inserted(state)
            found.append((edits, state))
        return found


@cache
def tables() -> BlockTables:
    return BlockTables()


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns in order, written with a rising number ``seq`` and the text's fault.

    Order: conversation, turn (nulls first), role, first 32 characters, MD5 of the text. Equal turns may fall
    into several partitions, so no conversation and no repeated turn is bound to one task.
    """
    spark = turns.sparkSession
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows.count() // PART_TURNS)
    order = [
        F.asc_nulls_first("conv"),
        F.asc_nulls_first("turn"),
        F.asc("role"),
        F.asc("head"),
        F.asc("mark"),
        F.asc("salt"),
    ]
    trimmed = F.rtrim("text", F.lit(WHITE))
    return stage(
        rows.withColumns(
            {
                "head": F.substring("text", 1, 32),
                "mark": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))),
                "salt": F.monotonically_increasing_id(),
            }
        )
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(
            F.monotonically_increasing_id().alias("seq"),
            "conv",
            "turn",
            "role",
            "text",
            "mark",
            (F.length(trimmed) == 0).alias("blank"),
            (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("short"),
        )
    )


def _initial(role: str) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))


def pieces_of(ordered: DataFrame) -> DataFrame:
    """One row per conversation and range partition: symbols, initials and numbers of faults.

    A turn's first fault counts: blank, then duplicate (role and text seen before in the conversation), then
    cut short. The first of equal turns is found by a grouping that combines map-side and told to the turns
    by their numbers, which are unique.
    """
    firsts = ordered.groupBy("conv", "mark").agg(F.min("seq").alias("first")).select("first")
    slim = ordered.select("seq", "conv", _initial("role").alias("initial"), "blank", "short")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(F.col("short"), "truncated")
    )
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    told = slim.join(firsts, F.col("seq") == F.col("first"), "left").withColumn("fault", fault)
    turn = F.struct("seq", symbol.alias("symbol"), "initial")
    return (
        told.groupBy("conv", F.shiftright("seq", 33).alias("part"))
        .agg(
            F.sort_array(F.collect_list(turn)).alias("turns"),
            *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")),
        )
        .select(
            "conv",
            F.col("turns")[0]["seq"].alias("piece"),
            F.array_join("turns.symbol", "").alias("symbols"),
            F.array_join("turns.initial", "").alias("initials"),
            "blank",
            "duplicate",
            "truncated",
        )
    )


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for piece, symbols, initials in zip(batch["piece"], batch["symbols"], batch["initials"]):
            to, off = tables().effect(symbols)
            illegal = sum(not _legal(initials[k : k + 2]) for k in range(len(initials) - 1))
            rows.append((piece, to.tolist(), off.tolist(), illegal, initials[0], initials[-1]))
        yield pd.DataFrame(rows, columns=["piece", "to", "off", "illegal", "first", "last"])


def _after(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the maps of a conversation's pieces: the vector after each, cost and illegal pairs of all."""
    for batch in batches:
        rows = []
        for pieces in batch["pieces"]:
            vector, cost, found = 0, 0, []
            for p in reversed(pieces):
                found.append((p["piece"], vector))
                cost += p["off"][vector]
                vector = p["to"][vector]
            cost += tables().vectors[vector][NOTHING]
            illegal = sum(p["illegal"] for p in pieces)
            illegal += sum(not _legal(p["last"] + q["first"]) for p, q in zip(pieces, pieces[1:]))
            last = found[0][0]
            chat = pieces[0]["piece"]
            rows += [(piece, chat, v, piece == last, cost, illegal) for piece, v in found]
        yield pd.DataFrame(rows, columns=["piece", "chat", "vector", "last", "cost", "illegal"])


def _traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of each turn and the state after them, from all states (from none yet, in a first piece)."""
    for batch in batches:
        rows = []
        for piece, chat, symbols, vector, last in zip(
            batch["piece"], batch["chat"], batch["symbols"], batch["vector"], batch["last"]
        ):
            states = [NOTHING] if piece == chat else [NOTHING, SYSTEM, USER, ASSISTANT]
            found = tables().trace(symbols, int(vector), states, bool(last))
            rows.append((piece, chat, [edits for edits, _ in found], [state for _, state in found]))
        yield pd.DataFrame(rows, columns=["piece", "chat", "edits", "states"])


def _states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state in which each piece of a conversation begins."""
    for batch in batches:
        rows = []
        for pieces in batch["pieces"]:
            state = NOTHING
            for p in pieces:
                rows.append((p["piece"], state))
                state = p["states"][state]
        yield pd.DataFrame(rows, columns=["piece", "state"])


def _listed(df: DataFrame, key: str, *names: str) -> DataFrame:
    """Pieces of each conversation in order; as many as the conversation has range partitions."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("piece", *names))).alias("pieces"))


class Repair:
    """The repair of every conversation of a table, as DataFrames.

    ``summary``: conv, chat, blank, duplicate, truncated, illegal, cost. ``edits``: seq, chat, edits per turn (``u``,
    ``a`` insert an empty turn of that role, ``D`` deletes, ``K`` keeps, ``U``, ``A`` give that role). ``turns``: chat, seq,
    at, role, text of the repaired conversations. ``chat`` is the number of a conversation's first turn.

    Null roles and texts count as one blank; a null conversation id is an id like any other. Turns of equal
    number are ordered as `ordered_turns` says. Other columns are ignored.
    """

    def __init__(
        self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
    ):
        self.ordered = ordered_turns(turns, conv, turn, role, text)
        pieces = stage(pieces_of(self.ordered))
        effects = stage(
            pieces.select("piece", "symbols", "initials")
            .mapInPandas(
                _effects,
                "piece bigint, to array<int>, off array<bigint>, illegal bigint, first string, last string",
            )
            .join(pieces.select("piece", "conv"), "piece")
        )
        after = stage(
            _listed(effects, "conv", "to", "off", "illegal", "first", "last")
            .select("pieces")
            .mapInPandas(_after, "piece bigint, chat bigint, vector int, last boolean, cost bigint, illegal bigint")
        )
        traced = stage(
            pieces.select("piece", "symbols")
            .join(after, "piece")
            .select("piece", "chat", "symbols", "vector", "last")
            .mapInPandas(_traces, "piece bigint, chat bigint, edits array<array<string>>, states array<int>")
        )
        begun = (
            _listed(traced.select("chat", "piece", "states"), "chat", "states")
            .select("pieces")
            .mapInPandas(_states, "piece bigint, state int")
        )
        self.pieces = stage(
            traced.join(begun, "piece").select(
                "piece", "chat", F.element_at("edits", F.col("state") + 1).alias("edits")
            )
        )
        self.summary = (
            pieces.join(after, "piece")
            .groupBy("chat")
            .agg(
                F.min(F.struct("piece", "conv"))["conv"].alias("conv"),
                *(F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")),
                F.max("illegal").alias("illegal"),
                F.max("cost").alias("cost"),
            )
        )

    @property
    def edits(self) -> DataFrame:
        return self.pieces.select("chat", "piece", F.posexplode("edits").alias("at", "edits")).select(
            "chat", (F.col("piece") + F.col("at")).alias("seq"), "edits"
        )

    @property
    def turns(self) -> DataFrame:
        rows = self.edits.join(self.ordered.select("seq", "role", "text"), "seq")
        each = rows.select("chat", "seq", "role", "text", F.posexplode(F.split("edits", "")).alias("at", "edit"))
        empty = F.col("edit").isin("u", "a")
        role = (
            F.when(F.lower("edit") == "u", F.lit("user"))
            .when(F.lower("edit") == "a", F.lit("assistant"))
            .otherwise(F.col("role"))
        )
        return each.filter("edit NOT IN ('D', '')").select(
            "chat", "seq", "at", role.alias("role"), F.when(empty, F.lit("")).otherwise(F.col("text")).alias("text")
        )

    @property
    def audits(self) -> DataFrame:
        """chat, audit: the letters D, I, K, R of a conversation's edits in order, one long text."""
        letters = F.translate(F.array_join("edits", ""), "uaUA", "IIRR")
        listed = F.sort_array(F.collect_list(F.struct("piece", letters.alias("letters"))))
        return self.pieces.groupBy("chat").agg(F.array_join(listed["letters"], "").alias("audit"))


def gaps(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """conv, gaps: turn numbers missing between the least and the greatest."""
    number = F.col(f"`{turn}`")
    return turns.groupBy(F.col(f"`{conv}`").alias("conv")).agg(
        F.coalesce(F.max(number) - F.min(number) + 1 - F.count_distinct(number), F.lit(0)).cast("bigint").alias("gaps")
    )


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    chat, state = None, None
    for batch in batches:
        done = []
        for here, line in zip(batch["chat"].tolist(), batch["line"]):
            if here != chat:
                if state is not None:
                    done.append((chat, state.hexdigest()))
                chat, state = here, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode())
        yield pd.DataFrame(done, columns=["chat", "sha256"])
    if state is not None:
        yield pd.DataFrame([(chat, state.hexdigest())], columns=["chat", "sha256"])


def text_hashes(turns: DataFrame) -> DataFrame:
    """chat, sha256 of a conversation's ``role:text`` lines joined by newlines.

    The hash reads its lines in order, so one task streams a conversation, however long, batch by batch.
    """
    return (
        turns.select("chat", "seq", "at", F.concat("role", F.lit(":"), "text").alias("line"))
        .repartition("chat")
        .sortWithinPartitions("chat", "seq", "at")
        .select("chat", "line")
        .mapInPandas(_hashed, "chat bigint, sha256 string")
    )


def damaged(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns with planted faults, chosen by CRC-32 of ``conv:turn`` modulo 20: 0 drops a turn, 1 empties
    it, 2 takes its sentence ends away, 3 repeats it, 4 makes it the user's. Nulls read as one blank; the ids
    stay as they are."""
    word = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat(word(conv), F.lit(":"), word(turn)).cast("binary")), F.lit(20))
    rows = turns.select(
        F.col(f"`{conv}`").alias(conv),
        F.col(f"`{turn}`").alias(turn),
        word(role).alias("_was"),
        word(text).alias("_said"),
        draw.alias("_draw"),
    ).filter("_draw <> 0")
    said = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("_said", ENDS, "")).otherwise(F.col("_said"))
    was = F.when(F.col("_draw") == 4, "user").otherwise(F.col("_was"))
    times = F.when(F.col("_draw") == 3, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).select(
        f"`{conv}`", f"`{turn}`", was.alias(role), said.alias(text)
    )
