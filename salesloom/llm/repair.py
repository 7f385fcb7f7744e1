"""Conversations brought back to the order of roles ``(system? (user assistant)+)?`` at least cost.

A row is one of nine symbols: its role by initial (system, user, assistant, other), whole or
truncated, or a row that has to go. The costs of finishing from each of four states (nothing yet,
after system, after user, after assistant), less their minimum, form one of a few vectors. Tables
precompute how every block of four symbols turns one vector into another, from right to left, so a
run of rows is worked through by one lookup a block. To trace the edits a block is expanded backward
from the vector at its right end, and then read forward, where of equally cheap edits the first in
ASCII is taken; that gives the least of all cheapest edit strings.

A conversation is cut into runs of bounded length. What a run does to any vector, and to any state,
is a small list of numbers, and such lists are chained to find what enters each run, level by level.
No task needs a whole conversation but the one that writes its digest.
"""

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm.batches import small_batches

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5  # costs; to keep costs nothing
INITIALS, OTHER = "sua", 3
GONE, NOTHING = 8, 9  # symbols: a row that has to go, and padding; 4 is added for truncated rows
SYMBOLS, BLOCK = 10, 4
STATES = 4
# The state after a role, where it may follow; states are nothing yet, system, user, assistant.
FOLLOWS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
# Traced edits: keep, delete, rerole to user or assistant, insert user or assistant.
TRACED, AUDIT = "kdUAua", "KDRRII"
SPACE = r"\x20\x09-\x0D"
RUN_BITS = 12  # rows of a run, and runs of a group of runs, as a power of two


def _inserted(state: int) -> tuple[str, int]:
    """The only role that may be inserted after a state, and the state after it."""
    return ("a", 3) if state == 2 else ("u", 2)


def _closed(costs: list[float]) -> list[float]:
    """Costs from each state where rows may be inserted first."""
    out = list(costs)
    for _ in range(2):
        out = [min(c, INSERT + out[_inserted(s)[1]]) for s, c in enumerate(out)]
    return out


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(traced edit, cost, next state)`` of a row in a state, insertions apart."""
    out = [("d", DELETE, state)]
    if symbol == GONE:
        return out
    role, extra = symbol % 4, TRUNCATED * (symbol // 4)
    if role != OTHER and (INITIALS[role], state) in FOLLOWS:
        out.append(("k", extra, FOLLOWS[INITIALS[role], state]))
    out += [(r.upper(), REROLE + extra, FOLLOWS[r, state]) for r in "ua" if (r, state) in FOLLOWS]
    return out


def _before(costs: tuple[float, ...], symbol: int) -> list[float]:
    """Costs from each state before a row, given those after it."""
    consumed = [min(c + costs[t] for _, c, t in _edits(symbol, s)) for s in range(STATES)]
    return _closed(consumed)


def _normal(costs: list[float]) -> tuple[float, ...]:
    return tuple(c - min(costs) for c in costs)


@cache
def tables() -> dict:
    """Vectors by number (0 is the end of a conversation), their steps by symbol and by block, and
    for each vector after a row, symbol and state the traced edits and the state they lead to."""
    end = _normal(_closed([0, float("inf"), float("inf"), 0]))
    vectors, step = [end], []
    number = {end: 0}
    while len(step) < len(vectors):
        row = []
        for symbol in range(GONE + 1):
            found = _normal(_before(vectors[len(step)], symbol))
            if found not in number:
                number[found] = len(vectors)
                vectors.append(found)
            row.append(number[found])
        step.append([*row, len(step)])
    step = np.array(step, np.int32)
    # A block's last symbol acts first.
    block = np.arange(len(vectors), dtype=np.int32)[:, None]
    for _ in range(BLOCK):
        block = np.stack([block[step[:, s]] for s in range(SYMBOLS)], axis=-1).reshape(len(vectors), -1)
    moves = {
        (v, symbol, s): _move(vectors[v], symbol, s)
        for v, symbol, s in product(range(len(vectors)), range(GONE + 1), range(STATES))
    }
    return {"vectors": vectors, "step": step, "block": block, "moves": moves}


def _move(after: tuple[float, ...], symbol: int, state: int) -> tuple[str, int]:
    """The cheapest edits of a row from a state, insertions before it included; of equally cheap ones
    the first in ASCII."""
    before, out = _before(after, symbol), ""
    while True:
        ways = [(c + after[t], AUDIT[TRACED.index(e)], e, t) for e, c, t in _edits(symbol, state)]
        role, follower = _inserted(state)
        ways.append((INSERT + before[follower], "I", role, follower))
        _, _, edit, state = min(ways)
        out += edit
        if edit not in "ua":
            return out, state


def _end_move(state: int) -> str:
    """What is inserted behind the last row."""
    return {0: "", 1: "ua", 2: "a", 3: ""}[state]


def _blocks(run: str) -> np.ndarray:
    """A run of symbols as numbers of blocks, padded in front."""
    symbols = np.frombuffer(run.encode(), np.uint8) - ord("0")
    padded = np.concatenate([np.full(-len(symbols) % BLOCK, NOTHING, np.int64), symbols])
    return padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def vectors_before(run: str) -> list[int]:
    """For each vector after a run the one before it."""
    table = tables()["block"]
    at = np.arange(len(table))
    for block in _blocks(run)[::-1]:
        at = table[at, block]
    return at.tolist()


def _vectors_inside(run: str, after: int) -> list[int]:
    """The vector behind each row of a run: looked up at block borders, expanded inside backward."""
    known, blocks = tables(), _blocks(run)
    out, pad, border = [0] * len(run), -len(run) % BLOCK, after
    for i in range(len(blocks) - 1, -1, -1):
        vector = border
        for place in range((i + 1) * BLOCK - 1 - pad, max(i * BLOCK - pad, 0) - 1, -1):
            out[place] = vector
            vector = known["step"][vector, ord(run[place]) - ord("0")]
        border = known["block"][border, blocks[i]]
    return out


def trace(run: str, after: int, state: int) -> tuple[list[str], int]:
    """The edits of each row of a run and the state behind it, from a state before it and the vector
    after it."""
    moves, out = tables()["moves"], []
    for symbol, vector in zip(run, _vectors_inside(run, after)):
        edits, state = moves[int(vector), ord(symbol) - ord("0"), state]
        out.append(edits)
    return out, state


def states_after(run: str, after: int) -> list[int]:
    """For each state before a run the one behind it."""
    return [trace(run, after, state)[1] for state in range(STATES)]


def _composed(lists: list, backward: bool) -> list[int]:
    out = None
    for one in lists[::-1] if backward else lists:
        out = np.asarray(one) if out is None else np.asarray(one)[out]
    return out.tolist()


def _entered(lists: list, first: int, backward: bool) -> list[int]:
    out = []
    for one in lists[::-1] if backward else lists:
        out.append(int(first))
        first = one[first]
    return out[::-1] if backward else out


def what_enters(runs: DataFrame, backward: bool = False, bits: int = RUN_BITS) -> DataFrame:
    """``(key, at, enters)`` for every run of ``runs(key, at, list)``.

    A list says for each number which other it becomes; number 0 enters the first run of a key (with
    ``backward`` the last one). Where a key has more than 2^``bits`` runs, groups of them are chained
    into runs of their own first, as often as it takes, so no task chains more than that.
    """
    in_order = F.array_sort(F.collect_list(F.struct("at", "list")))
    most = runs.groupBy("key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= 1 << bits:
        grouped = runs.groupBy("key").agg(in_order.alias("runs")).withColumn("enters", F.lit(0))
    else:
        grouped = runs.groupBy("key", F.shiftright("at", bits).alias("up")).agg(in_order.alias("runs"))
        grouped = scratch.materialize(grouped, "groups")

        @F.pandas_udf("array<int>")
        def chained(lists: pd.Series) -> pd.Series:
            return pd.Series([_composed(list(x), backward) for x in lists])

        upper = grouped.select("key", F.col("up").alias("at"), chained("runs.list").alias("list"))
        above = what_enters(scratch.materialize(upper, "upper"), backward, bits)
        grouped = grouped.join(above.withColumnRenamed("at", "up"), ["key", "up"])

    @F.pandas_udf("array<int>")
    def walked(lists: pd.Series, first: pd.Series) -> pd.Series:
        return pd.Series([_entered(list(x), f, backward) for x, f in zip(lists, first)])

    each = grouped.select("key", F.arrays_zip(F.col("runs.at"), walked("runs.list", "enters").alias("enters")).alias("z"))
    return each.select("key", F.inline("z")).toDF("key", "at", "enters")


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows with faults planted by the checksum of ``conversation:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's.
    Nulls are one space in the checksum, in roles and in texts."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    rows = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, "user").otherwise(text(role_col)).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text(text_col), "[.!?]", ""))
        .otherwise(text(text_col))
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("*", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("one")).drop("times", "one")


def _key(conv: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def arranged(rows: DataFrame) -> DataFrame:
    """Stored ``(key, conv_id, turn, role, text, slot)`` in the order of ``slot``.

    Conversations lie one behind the other, their rows by turn (null first), role, the first 64
    characters of the text and its checksum. Equal rows are told apart by their place in the scan, so
    neither a long conversation nor many copies of a row have to fit one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(_key(F.col("conv_id")).alias("key"), "conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("line", F.monotonically_increasing_id())
    by = [
        F.col("key"),
        F.col("turn").asc_nulls_first(),
        *[f(F.col(c)) for c in ("role", "text") for f in (lambda c: F.substring(c, 1, 64), lambda c: F.md5(c.cast("binary")))],
        F.col("line"),
    ]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("line")
    return scratch.materialize(placed.withColumn("slot", F.monotonically_increasing_id()), "turns")


def symbols(turns: DataFrame) -> DataFrame:
    """Stored ``(key, slot, role, fault, symbol, at)`` in the order of ``slot``; ``at`` numbers runs.

    The first fault of a row counts: blank, duplicate (role and text occurred before), truncated.
    """
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    role = F.when((F.length("role") == 0) | (initial == 0), OTHER).otherwise(initial - 1)
    same = F.md5(F.concat(F.md5(F.col("role").cast("binary")), F.md5(F.col("text").cast("binary"))).cast("binary"))
    narrow = turns.select(
        "key",
        "slot",
        role.alias("role"),
        same.alias("same"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
    )
    repeated = narrow.groupBy("key", "same").agg(F.min("slot").alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = narrow.join(repeated.drop("n"), ["key", "same"], "left")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("slot") > F.col("first"), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(
        F.col("role") + F.when(F.col("fault") == "truncated", 4).otherwise(0)
    )
    marked = marked.select("key", "slot", "role", fault.alias("fault")).withColumn("symbol", symbol)
    placed = marked.repartitionByRange("slot").sortWithinPartitions("slot")
    at = F.shiftright(F.monotonically_increasing_id(), RUN_BITS)
    return scratch.materialize(placed.withColumn("at", at), "symbols")


def edited_runs(marked: DataFrame, bits: int = RUN_BITS) -> DataFrame:
    """Stored ``(key, at, slots, edits, illegal, first, last)`` for each run of :func:`symbols`.

    ``edits`` holds the traced edits of each row, insertions before it included, and in the last run
    of a conversation one more entry for what is inserted behind it.
    """
    rows = F.array_sort(F.collect_list(F.struct("slot", "symbol", "role")))
    runs = marked.groupBy("key", "at").agg(rows.alias("rows"))
    pairs = F.zip_with(
        F.slice("rows.role", 1, F.size("rows") - 1), F.slice("rows.role", 2, F.size("rows") - 1), _is_illegal
    )
    runs = runs.select(
        "key",
        "at",
        F.col("rows.slot").alias("slots"),
        F.array_join(F.col("rows.symbol").cast("array<string>"), "").alias("run"),
        F.size(F.filter(pairs, lambda x: x)).alias("illegal"),
        F.col("rows")[0]["role"].alias("first"),
        F.element_at("rows", -1)["role"].alias("last"),
    )
    runs = scratch.materialize(runs, "runs")

    @F.pandas_udf("array<int>")
    def vectors(texts: pd.Series) -> pd.Series:
        return texts.map(vectors_before)

    lists = scratch.materialize(runs.select("key", "at", vectors("run").alias("list")), "vectors")
    runs = runs.join(what_enters(lists, True, bits).withColumnRenamed("enters", "after"), ["key", "at"])
    runs = scratch.materialize(runs, "runs")

    @F.pandas_udf("array<int>")
    def states(texts: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series([states_after(t, a) for t, a in zip(texts, after)])

    lists = scratch.materialize(runs.select("key", "at", states("run", "after").alias("list")), "states")
    ends = lists.groupBy("key").agg(F.max("at").alias("at")).withColumn("ends", F.lit(True))
    entered = what_enters(lists, False, bits).join(ends, ["key", "at"], "left")

    @F.pandas_udf("array<string>")
    def edits(texts: pd.Series, after: pd.Series, state: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for text, vector, start, last in zip(texts, after, state, ends):
            found, end = trace(text, vector, start)
            out.append([*found, _end_move(end)] if last else found)
        return pd.Series(out)

    done = runs.join(entered, ["key", "at"]).withColumn(
        "edits", edits("run", "after", "enters", F.coalesce("ends", F.lit(False)))
    )
    return scratch.materialize(done.select("key", "at", "slots", "edits", "illegal", "first", "last"), "edits")


def _is_illegal(one: Column, other: Column) -> Column:
    """Neither system before user nor user and assistant in turn."""
    pair = one * 4 + other
    return ~pair.isin(0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1)


def edited_rows(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """``(key, conv_id, turn, slot, behind, step, edit, role, text)``: one row for each edit.

    ``edit`` is K, R, D or I. ``role`` and ``text`` are those after the edit; a deleted row keeps its
    own, an inserted one has a null turn. The order is by slot, ``behind`` and ``step``.
    """
    each = runs.select("key", F.posexplode(F.arrays_zip("slots", "edits")).alias("i", "z"), F.element_at("slots", -1).alias("end"))
    # The entry behind the last row has no slot of its own.
    each = each.select(
        "key",
        F.coalesce("z.slots", "end").alias("slot"),
        F.col("z.slots").isNull().alias("behind"),
        F.posexplode(F.split("z.edits", "")).alias("step", "traced"),
    ).where("traced != ''")
    inserted = F.col("traced").isin("u", "a")
    role = F.when(F.lower("traced") == "u", "user").when(F.lower("traced") == "a", "assistant").otherwise(F.col("role"))
    rows = each.join(turns.drop("key"), "slot")
    return rows.select(
        "key",
        "conv_id",
        F.when(~inserted, F.col("turn")).alias("turn"),
        "slot",
        "behind",
        "step",
        F.translate("traced", TRACED, AUDIT).alias("edit"),
        role.alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of all conversations of ``rows(conv_id, turn, role, text)`` as rows, see
    :func:`edited_rows`; those whose edit is not D, in order, are the repaired conversations.

    A null role or text is read as one space. A null id is a conversation of its own, rows with a
    null turn come first, equal rows are duplicates. Other columns are left out, an empty table gives
    an empty result. The edits of a conversation are its cheapest, and of these the ASCII-least.
    """
    small_batches(rows.sparkSession)
    turns = arranged(rows)
    return edited_rows(turns, edited_runs(symbols(turns)))


def _digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each key's lines joined by newlines, read as a sorted stream: a task holds one batch
    of lines at a time, however long a conversation is."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            done = []
            for k, line in zip(batch["key"], batch["line"]):
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])

    order = ["key", "slot", "behind", "step"]
    sorted_ = lines.repartition("key").sortWithinPartitions(*order).select("key", "line")
    return sorted_.mapInPandas(stream, "key string, repaired_sha256 string")


def summaries(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row of figures for each id of ``conversations(conv_id)``, all distinct, on the repair of
    ``rows``: ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    Counts are of the rows as they come; ``gaps`` is the number of turns missing between the least
    and the greatest. A conversation without rows has zeros, no audit and the digest of no text.
    """
    small_batches(rows.sparkSession)
    turns = arranged(rows)
    marked = symbols(turns)
    runs = edited_runs(marked)

    turn = turns.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    faults = marked.groupBy("key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    behind = F.lag("last").over(Window.partitionBy("key").orderBy("at"))
    border = F.when(_is_illegal(behind, F.col("first")), 1).otherwise(0)
    parts = F.array_sort(F.collect_list(F.struct("at", F.array_join("edits", "").alias("edits"))))
    audits = runs.withColumn("illegal", F.col("illegal") + border).groupBy("key").agg(
        F.sum("illegal").alias("illegal"),
        F.translate(F.array_join(parts["edits"], ""), TRACED, AUDIT).alias("audit"),
    )
    edits = edited_rows(turns, runs).join(marked.select("slot", "fault"), "slot")
    price = (
        F.when(F.col("edit") == "D", DELETE)
        .when(F.col("edit") == "I", INSERT)
        .otherwise(F.when(F.col("edit") == "R", REROLE).otherwise(0) + F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0))
    )
    edits = scratch.materialize(
        edits.select(
            "key", "slot", "behind", "step", "edit", price.alias("price"), F.concat_ws(":", "role", "text").alias("line")
        ),
        "edited",
    )
    costs = edits.groupBy("key").agg(F.sum("price").cast("bigint").alias("cost"))
    out = conversations.select("conv_id", _key(F.col("conv_id")).alias("key"))
    for part in (turn, faults, audits, costs, _digests(edits.where("edit != 'D'"))):
        out = out.join(part, "key", "left")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
