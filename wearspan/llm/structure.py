"""Conversation structure repair by Four-Russians block tables.

Rows of a conversation are symbols: a role initial and whether the row must go or is cut short. The cheapest repair is a
shortest path through the four states of the grammar `(s?(ua)+)?`. Seen from the end, the costs to finish from each state
are a vector; without its least value only a few hundred vectors occur. They are enumerated once, and a
table gives for every vector and every block of symbols the vector in front of the block and the cost it adds. A conversation is
priced by one look-up a block. To trace the repair, each block is expanded backward from the vector behind it, and the walk
forward takes the ASCII-least edit of all that keep the cost, so ties are settled exactly.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.frames import saved, ship

# Fixed values of the repair: costs, grammar and faults.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
NO_BLANK = r"[^\x20\x09-\x0D]"
ENDS = r"[.!?][\x20\x09-\x0D]*\z"
LEGAL_PAIRS = ("su", "ua", "au")
# States: at the start, behind s, behind u, behind a. The repair may end at the start or behind a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDING = 4, (0, 3)
# Symbols: (initial, cut short) of rows that may stay, and one for rows that must go.
INITIALS = "sua?"
GONE = 2 * len(INITIALS)
SYMBOLS = GONE + 1
FAR = 1 << 20


def symbol(initial: str, cut_short: bool) -> int:
    known = INITIALS.find(initial) if initial else -1
    return 2 * (known if 0 <= known < 3 else 3) + int(cut_short)


def edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row in a state, in ASCII order of the letters."""
    out = [("D", DELETE, state)]
    if code != GONE:
        extra = CUT_SHORT * (code % 2)
        initial = INITIALS[code // 2]
        if (state, initial) in STEP:
            out.append(("K", KEEP + extra, STEP[state, initial]))
        out += [("R", REROLE + extra, to) for (s, role), to in STEP.items() if s == state and role != "s"]
    return out


def inserts(state: int) -> list[int]:
    return [to for (s, role), to in STEP.items() if s == state and role != "s"]


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to finish from each state when empty rows may be inserted first."""
    out = list(costs)
    for _ in range(STATES):
        for s in range(STATES):
            out[s] = min([out[s], *(INSERT + out[to] for to in inserts(s))])
    return tuple(out)


def in_front(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs to finish in front of a row, from those behind it."""
    return closed([min((c + costs[to] for _, c, to in edits(s, code)), default=FAR) for s in range(STATES)])


@dataclass(frozen=True)
class BlockTable:
    """vectors: the normalised cost vectors, number 0 behind the last row; then for each vector and each block of
    `length` symbols (the first symbol is the highest digit) the vector in front and the cost added; and the same of one symbol."""

    length: int
    vectors: tuple[tuple[int, ...], ...]
    next_block: np.ndarray
    add_block: np.ndarray
    next_one: np.ndarray
    add_one: np.ndarray
    end_cost: int


@cache
def block_table(length: int = 3) -> BlockTable:
    """The table of every block of `length` symbols. Its size is fixed by the grammar and the costs, not by the data."""
    last = closed([0 if s in ENDING else FAR for s in range(STATES)])
    vectors = [tuple(v - min(last) for v in last)]
    known = {vectors[0]: 0}
    rows: list[list[tuple[int, int]]] = []
    while len(rows) < len(vectors):  # until no step leads to a new vector
        row = []
        for code in range(SYMBOLS):
            found = in_front(vectors[len(rows)], code)
            least = min(found)
            normal = tuple(v - least for v in found)
            if normal not in known:
                known[normal] = len(vectors)
                vectors.append(normal)
            row.append((known[normal], least))
        rows.append(row)
    one = np.array(rows, np.int32)
    next_one, add_one = one[:, :, 0], one[:, :, 1]
    to, add = next_one, add_one
    for _ in range(length - 1):  # one more symbol in front of each shorter block
        add = (add[:, None, :] + add_one[to].transpose(0, 2, 1)).reshape(len(vectors), -1)
        to = next_one[to].transpose(0, 2, 1).reshape(len(vectors), -1)
    return BlockTable(length, tuple(vectors), to, add, next_one, add_one, min(last))


def repair(codes: np.ndarray, table: BlockTable) -> tuple[int, str]:
    """(least cost, ASCII-least audit of that cost) of a row of symbols. No symbols: 0 and the empty text."""
    k, n = table.length, len(codes)
    whole = n // k
    rest = n - whole * k  # the first symbols, fewer than a block
    digits = SYMBOLS ** np.arange(k - 1, -1, -1)
    blocks = (codes[rest:].reshape(whole, k).astype(np.int64) @ digits).tolist() if whole else []
    behind = [0] * (whole + 1)
    cost = table.end_cost
    for b in range(whole - 1, -1, -1):
        behind[b] = int(table.next_block[behind[b + 1], blocks[b]])
        cost += int(table.add_block[behind[b + 1], blocks[b]])
    at = behind[0]
    for code in codes[:rest][::-1].tolist():
        cost += int(table.add_one[at, code])
        at = int(table.next_one[at, code])
    cost += table.vectors[at][0]
    audit: list[str] = []
    state = 0
    bounds = [(0, rest, behind[0])] + [(rest + b * k, rest + (b + 1) * k, behind[b + 1]) for b in range(whole)]
    for low, high, right in bounds:
        inner = [right]
        for code in codes[low:high][::-1].tolist():
            inner.append(int(table.next_one[inner[-1], code]))
        inner.reverse()
        for i, code in enumerate(codes[low:high].tolist()):
            front, back, gained = table.vectors[inner[i]], table.vectors[inner[i + 1]], int(table.add_one[inner[i + 1], code])
            while True:  # inserts stay in front of the row
                options = [(letter, to, True) for letter, c, to in edits(state, code) if c + back[to] == front[state] + gained]
                options += [("I", to, False) for to in inserts(state) if INSERT + front[to] == front[state]]
                letter, state, moved = min(options)
                audit.append(letter)
                if moved:
                    break
    end = table.vectors[0]
    while state not in ENDING:
        state = next(to for to in inserts(state) if INSERT + end[to] == end[state])
        audit.append("I")
    return cost, "".join(audit)


def repaired_roles(initials: Iterator[str], audit: str) -> Iterator[tuple[str, str]]:
    """(letter, role initial that it gives, or the empty text) of each edit, from the initials of the rows."""
    state = 0
    for letter in audit:
        initial = next(initials) if letter != "I" else ""
        if letter == "D":
            yield letter, ""
            continue
        role = initial if letter == "K" else next(r for (s, r), _ in STEP.items() if s == state and r != "s")
        state = STEP[state, role]
        yield letter, role


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, by crc32(`conv_id:turn`) mod 20: 0 drops a row, 1 empties its text, 2 removes its `[.!?]`, 3 repeats
    it, 4 sets role user. A NULL is one space wherever it is part of a text. `copies` is 1 or 2."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    slim = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return slim.where("kind <> 0").select("conv_id", "turn", role.alias("role"), changed.alias("text"), copies.alias("copies"))


def placed_rows(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation: by turn (NULLs first), role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("place", F.row_number().over(order).cast("long"))


def symbols(placed: DataFrame) -> DataFrame:
    """conv_id, place, copies, first, initial, blank, cut: the little that a repair needs of a row, without its text.

    `first`: no earlier row has the role and text. Equal rows are told by aggregates and a join on those that
    repeat, which Spark can split, and not by a window over equal texts.
    """
    slim = placed.select(
        "conv_id", "turn", "place", "copies", "role", F.sha2("text", 256).alias("digest"),
        F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(NO_BLANK)).alias("blank"), (~F.col("text").rlike(ENDS)).alias("cut"),
    )
    firsts = slim.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
    firsts = firsts.agg(F.min("place").alias("first_place"), F.count("*").alias("n")).where("n > 1").drop("n")
    # A NULL conv_id is a conversation too.
    told = slim.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    first = F.coalesce(F.col("place") == F.col("first_place"), F.lit(True))
    return told.select("conv_id", "place", "copies", first.alias("first"), "initial", "blank", "cut")


REPAIRS = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def in_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """The rows of sorted batches by conversation. Nothing is held but a batch."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, key=lambda row: row["conv_id"])


def repairs(marked: DataFrame, length: int = 3) -> DataFrame:
    """Faults, illegal pairs, least cost and audit of every conversation, from the rows of `symbols`.

    Rows stream by place; of a conversation a task holds one byte for each row beside the audit, which is one text by its contract.
    """
    ship(marked.sparkSession)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block_table(length)
        out: list[tuple] = []
        for conv, rows in in_conversations(batches):
            codes = bytearray()
            counts = dict.fromkeys(COUNTS, 0)
            last = None
            for row in rows:
                for copy in range(row["copies"]):
                    if row["blank"]:
                        fault = "blank"
                    elif copy or not row["first"]:
                        fault = "duplicate"
                    else:
                        fault = "truncated" if row["cut"] else None
                    if fault:
                        counts[fault] += 1
                    codes.append(GONE if fault in ("blank", "duplicate") else symbol(row["initial"], fault == "truncated"))
                    counts["illegal"] += last is not None and last + row["initial"] not in LEGAL_PAIRS
                    last = row["initial"]
            counts["cost"], audit = repair(np.frombuffer(codes, np.uint8), table)
            out.append((conv, *counts.values(), audit))
            if len(out) >= 2_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [*[pa.int64()] * 6, pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv_id", *COUNTS, "audit"])

    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(price, REPAIRS)


def repaired_lines(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, at, role and text of the repaired rows, in order of `at`: kept and re-roled rows with their texts, inserted ones with empty texts.

    The audit of a conversation comes in front of its rows in the same shuffle. Rows stream; no text is held.
    """
    ship(placed.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, rows in in_conversations(batches):
            rows = iter(rows)
            audit = next(rows)["text"]
            doubled = (row for row in rows for _ in range(row["copies"]))
            last: list[dict] = []

            def initials() -> Iterator[str]:
                for row in doubled:
                    last[:] = [row]
                    yield row["role"][:1]

            at, out = 0, []
            for letter, role in repaired_roles(initials(), audit):
                if role:
                    full = {"u": "user", "a": "assistant"}
                    out.append((conv, at, last[0]["role"] if letter == "K" else full[role], "" if letter == "I" else last[0]["text"]))
                    at += 1
                if len(out) >= 500:
                    yield lines(out)
                    out = []
            if out:
                yield lines(out)

    def lines(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv_id", "at", "role", "text"])

    heads = audits.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(1).alias("copies"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = placed.select("conv_id", "place", "copies", "role", "text").unionByName(heads)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(walk, "conv_id long, at long, role string, text string")


def line_digests(lines: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its `role:text` lines, newline-joined, as they stream out of `repaired_lines` (same tasks,
    same order). The digest of one conversation is a sequence by definition, so one task reads it; it holds one row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, rows in in_conversations(batches):
            state = hashlib.sha256()
            for i, row in enumerate(rows):
                state.update(f"{chr(10) if i else ''}{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
            yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    return lines.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def turn_gaps(rows: DataFrame) -> DataFrame:
    """conv_id and the turns missing between its first and its last, NULLs ignored."""
    distinct = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return distinct.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, faults and cheapest repair of every conversation of `conversations` (conv_id, turn, role, text).

    One row per conv_id, a NULL one included: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256. A
    conversation of which no row is left has zeros, an empty audit and the digest of the empty text. Rows of one turn are
    taken by role and text; repeated rows are duplicates; an empty table gives no rows; other columns are not read.
    """
    source = conversations.withColumn("conv_id", F.col("conv_id").cast("long"))
    placed = saved(placed_rows(damaged(source)), "placed")
    priced = saved(repairs(symbols(placed)), "repairs")
    digests = line_digests(repaired_lines(placed, priced))
    every = source.select("conv_id").distinct()
    found = every
    for part in (turn_gaps(placed), priced, digests):
        found = found.join(part.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS)]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
