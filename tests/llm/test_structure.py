from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearspan.llm import structure
from wearspan.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Cheapest and then ASCII-least edits, by a search over (cost, audit) that settles the least of both first."""
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if not re.fullmatch("(s?(ua)*u?)?", roles) or (roles.startswith("a")):
            continue
        state = (i, roles[-1:] if roles else "", roles == "s")
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(lines)
        if state in done:
            continue
        done[state] = 1
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, roles + role[0], (*lines, f"{role}:")))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles, lines))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = 5 if faults[i] == "truncated" else 0
        if role[:1] in ("s", "u", "a"):
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[0], (*lines, f"{role}:{text}")))
        for other in ("user", "assistant"):
            heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, roles + other[0], (*lines, f"{other}:{text}")))
    raise AssertionError


def plain_report(rows):
    out = []
    left = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = plain_faults(own)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = plain_repair(own, faults)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def random_rows(seed, conversations=120):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randint(0, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "author"])
            text = rng.choice(["Yes.", "No", " \t", None, "", "Why? ", "é!\n", "line\nline.", f"turn {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2, -turn]), role, text))
    rows += rows[::17]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_a_search(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit(1)).withColumn("audit", F.lit("x")).repartition(3)
    assert got(structure.repair_report(df)) == plain_report(rows)


def test_whole_table_equals_a_search(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_structure_repair"](spark, small_dir)) == plain_report(rows)


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_block_tables_price_and_trace_like_single_steps(length):
    table, single = structure.block_table(length), structure.block_table(1)
    assert len(table.vectors) < 500 and table.next_block.shape == (len(table.vectors), structure.SYMBOLS**length)
    rng = np.random.default_rng(length)
    for n in [*range(0, 14), 57, 300]:
        for _ in range(20):
            codes = rng.integers(0, structure.SYMBOLS, n).astype(np.uint8)
            assert structure.repair(codes, table) == structure.repair(codes, single)


def test_a_long_conversation_is_repaired(spark):
    n = 30_000
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"Answer {i}.") for i in range(n)]
    row = structure.repair_report(spark.createDataFrame(rows, SCHEMA)).first()
    left = sum(zlib.crc32(f"7:{i}".encode()) % 20 != 0 for i in range(n))
    assert row["gaps"] <= n - left and 0.9 * n < len(row["audit"]) < 1.2 * n and row["cost"] > 0


def test_empty_and_wholly_dropped(spark):
    assert structure.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = structure.repair_report(spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
