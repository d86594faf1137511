"""Conversation structure repair by a run-length dynamic programme.

A conversation's rows become symbols, one per role initial and fault; edits turn them into
role initials of the form ``(s?(ua)+)?`` at the least cost:

* ``K`` keep (0), ``R`` change the role to user or assistant (3), ``D`` delete (4; a must for blank
  and duplicate rows), ``I`` insert an empty user or assistant row (3, anywhere);
* a truncated row that is not deleted adds 3.

The states are what was written last: nothing, s, u, a. A row's symbol is a 4 x 4
min-plus transition (insertions before the row included). Equal consecutive symbols are one
run, collapsed by Spark; a run of n rows advances the cost-to-go by the binary powers of
its transition, which are computed once per process. Costs run backwards over the blocks of
a conversation (``BLOCK`` rows each), then the choices are unrolled forwards, run by run
through the same powers: at each point the ASCII-least edit that keeps the least cost, which
gives the ASCII-least audit of all cheapest ones (an edit fixes the next point, so the least
next letter is always right).

Memory: one block's runs and one Arrow batch of rows, plus the audit of the conversation, which is
one cell of the result. A conversation is streamed through one task, since its digest
runs over its rows in order; nothing else of it is gathered.

Defined results: null roles and texts count as one space; a null turn comes first; equal
turns are ordered by role and text; a null ``conv_id`` is a conversation of its own. Faults, the
first that holds: blank (only ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen
earlier in the conversation), truncated (the last other character is not one of ``.!?``). A role
that begins with none of s, u, a can only be changed or deleted. A table without rows
gives no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import written

BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_FAR = 1 << 50
_BLANK, _SAYS = r"\A[\x20\x09-\x0D]*\z", r"[.!?][\x20\x09-\x0D]*\z"
#: States: nothing yet, s, u, a. What user/assistant row may follow, and what a kept row leads to.
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_ROLE = {2: "user", 3: "assistant"}
#: Cost-to-go behind the last row: inserts up to an accepted state.
_END = (0, 2 * INSERT, INSERT, 0)


def damage(turns: DataFrame) -> DataFrame:
    """Damage rows by ``crc32(conv_id:turn) % 20`` (nulls: one space): 0 drops a row, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":")
                      for c in ("conv_id", "", "turn")))
    text = F.coalesce("text", space)
    kind = F.col("kind")
    return (turns.withColumn("kind", F.crc32(name.cast("binary")) % 20).where("kind <> 0")
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
                    .alias("text"),
                    F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_"))
            .drop("_"))


def examined(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row with its place, fault, symbol and run (the place of the run's first row)."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    conv = Window.partitionBy("conv_id").orderBy("pos")
    same = Window.partitionBy("conv_id", "digest").orderBy("pos")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(
            F.col("turn").asc_nulls_first(), "role", "text")).cast("long"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))
    fault = (F.when(F.col("text").rlike(_BLANK), "blank").when(F.row_number().over(same) > 1, "duplicate")
             .when(~F.col("text").rlike(_SAYS), "truncated"))
    first = F.substring("role", 1, 1)
    kind = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(kind))
              .otherwise(kind))
    rows = rows.withColumn("fault", fault).withColumn("symbol", symbol)
    before = F.lag(F.substring("role", 1, 1)).over(conv)
    starts = (F.col("pos") - 1) % block == 0
    starts = starts | (F.col("symbol") != F.lag("symbol").over(conv))
    legal = F.concat(before, first).isin("su", "ua", "au")
    return rows.select("conv_id", "turn", "pos", "role", "text", "fault", "symbol",
                       F.max(F.when(starts, F.col("pos"))).over(conv).alias("run"),
                       F.coalesce(~legal, F.lit(False)).alias("illegal"))


def _one_row(symbol: str) -> tuple:
    """The min-plus transition of one row, insertions before it included."""
    matrix = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in _edits_of(symbol, state):
            matrix[state][to] = min(matrix[state][to], cost)
    for _ in range(2):                        # at most two insertions lead anywhere
        matrix = [[min(matrix[p][q], INSERT + matrix[_NEXT[p]][q]) for q in range(4)] for p in range(4)]
    return tuple(map(tuple, matrix))


def _edits_of(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """The edits of one row in a state: letter, cost, next state (inserts left aside)."""
    out = [("D", DELETE, state)]
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        kept = _KEPT[symbol.lower()].get(state)
        if kept is not None:
            out.append(("K", KEEP + more, kept))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[p][k] + b[k][q] for k in range(4)) for q in range(4)) for p in range(4))


def _apply(matrix: tuple, costs: tuple) -> tuple:
    return tuple(min(row[q] + costs[q] for q in range(4)) for row in matrix)


_POWERS: dict[str, list[tuple]] = {}


def power(symbol: str, level: int) -> tuple:
    """The transition of ``2 ** level`` rows of one symbol (cached)."""
    known = _POWERS.setdefault(symbol, [])
    while len(known) <= level:
        known.append(_times(known[-1], known[-1]) if known else _one_row(symbol))
    return known[level]


def advance(symbol: str, count: int, costs: tuple) -> tuple:
    """Cost-to-go before a run of ``count`` rows from that behind it."""
    for level in range(count.bit_length()):
        if count >> level & 1:
            costs = _apply(power(symbol, level), costs)
    return costs


def _row_costs(symbol: str, count: int, costs: tuple) -> Iterator[tuple[tuple, tuple]]:
    """For each row of a run in order, the cost-to-go before and behind it: the run is
    halved at powers of two, so only a logarithm of it is held."""
    stack = [(count, costs)]
    while stack:
        n, behind = stack.pop()
        while n > 1:
            level = (n - 1).bit_length() - 1
            stack.append((1 << level, behind))
            behind = _apply(power(symbol, level), behind)
            n -= 1 << level
        yield _apply(power(symbol, 0), behind), behind


def _edits(runs: list[tuple[str, int]], costs: tuple, state: int) -> Iterator[tuple[str, int]]:
    """The edits of the rows of a block, as (letters, state) per row: inserts, then the row's."""
    behind = [costs]
    for symbol, count in reversed(runs):
        behind.append(advance(symbol, count, behind[-1]))
    for (symbol, count), end in zip(runs, behind[-2::-1]):
        for here, after in _row_costs(symbol, count, end):
            letters = ""
            while True:
                options = [(letter, cost + after[to], to) for letter, cost, to in _edits_of(symbol, state)]
                options.append(("I", INSERT + here[_NEXT[state]], _NEXT[state]))
                letter, _, state = min(o for o in options if o[1] == here[state])
                letters += letter
                if letter != "I":
                    break
            yield letters, state


def _backwards(batches: Iterator) -> Iterator:
    """Blocks of a conversation from the last to the first: the cost-to-go behind each, and
    before it."""
    import pyarrow as pa

    conv, costs = (), _END
    for b in batches:
        behind, before = [], []
        for c, symbols, counts in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
            if (c,) != conv:
                conv, costs = (c,), _END
            behind.append(costs)
            for symbol, count in zip(reversed(symbols), reversed(counts)):
                costs = advance(symbol, count, costs)
            before.append(costs[0])
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(behind, pa.list_(pa.int64())), pa.array(before, pa.int64())],
            ["conv_id", "block", "symbols", "counts", "behind", "cost"])


def _planned(rows: DataFrame, block: int) -> DataFrame:
    """``(conv_id, block, symbols, counts, behind, cost)``: the runs of each block and the
    cost-to-go behind it; ``cost`` of block 0 is the conversation's."""
    runs = rows.groupBy("conv_id", "run").agg(F.first("symbol").alias("symbol"),
                                              F.count(F.lit(1)).cast("int").alias("n"))
    runs = (runs.groupBy("conv_id", F.floor((F.col("run") - 1) / block).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("run", "symbol", "n"))).alias("r")))
    runs = runs.select("conv_id", "block", F.array_join(F.transform("r", lambda x: x["symbol"]), "").alias("symbols"),
                       F.transform("r", lambda x: x["n"]).alias("counts"))
    return (runs.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
            .mapInArrow(_backwards, f"{_conv(rows)}, block long, symbols string, counts array<int>, "
                                    "behind array<long>, cost long"))


def _conv(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def _walk(batches: Iterator) -> Iterator[tuple]:
    """Every edit in order, as (conversation, letter, role, text). Rows come by conversation, block
    and place, a block's plan before its rows."""
    conv, state, edits = (), 0, iter(())
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            for c, role, text, symbols, counts, behind in zip(
                    *(part.column(j).to_pylist() for j in (0, 3, 4, 5, 6, 7))):
                if (c,) != conv:
                    yield from _tail(conv, state)
                    conv, state = (c,), 0
                if symbols is not None:
                    edits = _edits(list(zip(symbols, counts)), tuple(behind), state)
                    continue
                letters, after = next(edits)
                for letter in letters:
                    if letter == "I":
                        state = _NEXT[state]
                        yield c, "I", _ROLE[state], ""
                    else:
                        state = after
                        yield c, letter, _ROLE[after] if letter == "R" else role, text
    yield from _tail(conv, state)


def _tail(conv: tuple, state: int) -> Iterator[tuple]:
    while conv and state in (1, 2):
        state = _NEXT[state]
        yield conv[0], "I", _ROLE[state], ""


def _reports(batches: Iterator, kind) -> Iterator:
    import pyarrow as pa

    out: list = []
    for conv, edits in itertools.groupby(_walk(batches), key=lambda e: (e[0],)):
        audit, digest, between = [], hashlib.sha256(), ""
        for _, letter, role, text in edits:
            audit.append(letter)
            if letter != "D":
                digest.update(f"{between}{role}:{text}".encode())
                between = "\n"
        out.append((conv[0], "".join(audit), digest.hexdigest()))
        if len(out) == 1024:
            yield _batch(out, ["conv_id", "audit", "repaired_sha256"], pa.schema([("c", kind)]))
            out = []
    if out:
        yield _batch(out, ["conv_id", "audit", "repaired_sha256"], pa.schema([("c", kind)]))


def _batch(rows: list, names: list[str], schema):
    import pyarrow as pa

    first, *rest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(first, schema.field(0).type), *map(pa.array, rest)], names)


def _rewritten(batches: Iterator, kind) -> Iterator:
    import pyarrow as pa

    out: list = []
    place = itertools.count(1)
    conv = ()
    names = ["conv_id", "position", "edit", "role", "text"]
    for c, letter, role, text in _walk(batches):
        if (c,) != conv:
            conv, place = (c,), itertools.count(1)
        if letter != "D":
            out.append((c, next(place), letter, role, text))
        if len(out) == 256:
            yield _batch(out, names, pa.schema([("c", kind)]))
            out = []
    if out:
        yield _batch(out, names, pa.schema([("c", kind)]))


def _stream(rows: DataFrame, plan: DataFrame, block: int) -> DataFrame:
    none = {"role": "string", "text": "string", "symbols": "string", "counts": "array<int>", "behind": "array<long>"}
    plans = plan.select("conv_id", "block", F.lit(0).cast("long").alias("pos"),
                        *(F.lit(None).cast(none[c]).alias(c) for c in ("role", "text")), "symbols", "counts", "behind")
    texts = rows.select("conv_id", F.floor((F.col("pos") - 1) / block).cast("long").alias("block"), "pos", "role",
                        "text", *(F.lit(None).cast(none[c]).alias(c) for c in ("symbols", "counts", "behind")))
    return (plans.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos"))


def repaired(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: ``(conv_id, position, edit, role, text)``."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = written(examined(turns, block))
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    return _stream(rows, _planned(rows, block), block).mapInArrow(
        lambda b: _rewritten(b, kind), f"{_conv(rows)}, position long, edit string, role string, text string")


def report(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: gaps, the counts of faults, illegal neighbours, the least cost,
    the audit of the edits and the SHA-256 of the repaired ``role:text`` lines."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = written(examined(turns, block))
    plan = written(_planned(rows, block))
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    told = _stream(rows, plan, block).mapInArrow(
        lambda b: _reports(b, kind), f"{_conv(rows)}, audit string, repaired_sha256 string")
    # distinct turns: first per turn, then per conversation, so a long one is pre-aggregated
    faults = [F.sum((F.col("fault") == k).cast("long")).alias(k) for k in ("blank", "duplicate", "truncated")]
    turn = rows.groupBy("conv_id", "turn").agg(*faults, F.sum(F.col("illegal").cast("long")).alias("illegal"))
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    stats = turn.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *total)
    cost = plan.where("block = 0").select(F.col("conv_id").alias("p"), "cost")
    told = told.withColumnRenamed("conv_id", "t")
    return (stats.join(cost, F.expr("conv_id <=> p")).join(told, F.expr("conv_id <=> t"))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                    "repaired_sha256"))
