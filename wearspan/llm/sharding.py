"""Sharding by a k-d tree: distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.frames import saved

CODE_BITS, TIE_BITS, STEP_BITS = 16, 46, 12
# Low bits of a tie tell rows of one text apart.
ROW_BITS = 16
# Equal rows that one task numbers.
RUN = 10_000


@dataclass(frozen=True)
class Node:
    """A part of the tree that still holds the shards `first` to `first + shards - 1`."""

    first: int
    shards: int


@dataclass(frozen=True)
class Cut:
    """Rows of `node` whose key along `dimension` is below `key` go left."""

    node: Node
    dimension: str
    key: int

    @property
    def left(self) -> Node:
        return Node(self.node.first, self.node.shards // 2)

    @property
    def right(self) -> Node:
        half = self.node.shards // 2
        return Node(self.node.first + half, self.node.shards - half)


def common_bytes(df: DataFrame, names: list[str]) -> dict[str, int]:
    """Length in bytes of the beginning that all values of a text column share: that of the least and the greatest."""
    if not names:
        return {}
    ends = df.agg(*[F.hex(f(n)).alias(f"{n}_{end}") for n in names for end, f in (("lo", F.min), ("hi", F.max))]).first()
    return {n: len(os.path.commonprefix([ends[f"{n}_lo"] or "", ends[f"{n}_hi"] or ""])) // 2 for n in names}


def position(df: DataFrame, name: str, skip: int = 0) -> Column:
    """A number in the order of a metadata column: numbers by their logarithm, text by seven bytes behind its first `skip`."""
    if df.schema[name].dataType.typeName() == "string":
        head = F.substring(F.rpad(F.substring(F.hex(F.col(name)), 2 * skip + 1, 14), 14, "0"), 1, 14)
        return F.when(F.col(name).isNotNull(), F.conv(head, 16, 10).cast("double"))
    number = F.nanvl(F.greatest(F.least(F.col(name).cast("double"), F.lit(1e300)), F.lit(-1e300)), F.lit(None).cast("double"))
    return F.signum(number) * F.log1p(F.abs(number))


def coded(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Replaces each position by a code of 16 bits between its least and greatest value; NULL is 0."""
    ends = rows.agg(*[f(d).alias(f"{d}_{n}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = rows
    for d in dimensions:
        lo, hi = ends[f"{d}_lo"], ends[f"{d}_hi"]
        scale = (2**CODE_BITS - 1) / (hi - lo) if lo is not None and hi > lo else 0.0
        out = out.withColumn(d, F.coalesce(F.round((F.col(d) - F.lit(lo or 0.0)) * scale), F.lit(0)).cast("long"))
    return out


def key_of(dimension: str) -> Column:
    """Code, then a hash of text and row that orders equal codes: a cut can pass through a hot value or text."""
    return F.shiftleft(F.col(dimension), TIE_BITS).bitwiseOR(F.col("tie"))


def node_of(cuts: list[Cut]) -> Column:
    """First shard of the tree part that a row is in after the cuts made so far (at most one per shard)."""
    by_node = {c.node: c for c in cuts}

    def walk(node: Node) -> Column:
        cut = by_node.get(node)
        if cut is None:
            return F.lit(node.first)
        return F.when(key_of(cut.dimension) < F.lit(cut.key), walk(cut.left)).otherwise(walk(cut.right))

    return walk(max(by_node, key=lambda n: n.shards)) if by_node else F.lit(0)


def medians(rows: DataFrame, parts: dict[Node, tuple[str, float]], tolerance: float) -> list[Cut]:
    """Weighted cut of each part: dimension and bytes wanted on its left.

    Each pass counts bytes in 4,096 slices of the interval that holds the cut, and the next one looks
    into the slice where the sum passes the wanted bytes, until that slice is light enough or a single
    key. A pass returns one row per part to the driver.
    """
    bits = CODE_BITS + TIE_BITS
    low, done = {n: 0 for n in parts}, {n: 0.0 for n in parts}
    cuts: list[Cut] = []
    open_parts = dict(parts)
    while open_parts:
        step = min(STEP_BITS, bits)
        slots = max(n.first for n in open_parts) + 1
        keys, lows, targets = [F.lit(-1).cast("long")] * slots, [0] * slots, [math.inf] * slots
        for n, (dimension, target) in open_parts.items():
            keys[n.first], lows[n.first], targets[n.first] = key_of(dimension), low[n], target - done[n]

        def at_node(values: list) -> Column:
            return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), F.col("node"))

        at = at_node(keys) - at_node(lows)
        slices = rows.select("node", "size", at.alias("at")).select("node", "size", F.when(F.col("at").between(0, 2**bits - 1), F.shiftright("at", bits - step)).alias("slice"))
        slices = slices.groupBy("node", "slice").agg(F.sum("size").alias("bytes")).where("slice IS NOT NULL")
        running = Window.partitionBy("node").orderBy("slice")
        passing = slices.withColumn("sum", F.sum("bytes").over(running)).where(F.col("sum") >= at_node([float(t) for t in targets]))
        found = {r["node"]: r for r in passing.groupBy("node").agg(F.min(F.struct("slice", "bytes", "sum")).alias("s")).select("node", "s.*").collect()}
        bits -= step
        rest = {}
        for n, (dimension, target) in open_parts.items():
            r = found.get(n.first)
            if r is None:
                cuts.append(Cut(n, dimension, low[n] + 2 ** (bits + step)))
                continue
            before = done[n] + r["sum"] - r["bytes"]
            low[n] += r["slice"] << bits
            done[n] = before
            if bits == 0 or r["bytes"] <= tolerance * target:
                near_end = target - before > before + r["bytes"] - target
                cuts.append(Cut(n, dimension, low[n] + (1 << bits) * near_end))
            else:
                rest[n] = (dimension, target)
        open_parts = rest
    return cuts


def kd_cuts(rows: DataFrame, dimensions: list[str], shards: int, tolerance: float) -> list[Cut]:
    """All cuts of the tree, level by level; a level works on every part at once."""
    cuts: list[Cut] = []
    level = [Node(0, shards)] if shards > 1 else []
    while level:
        placed = saved(rows.withColumn("node", node_of(cuts)), "level")  # so that no pass walks the tree again
        spans = [(F.max(d) - F.min(d)).alias(d) for d in dimensions]
        stats = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("bytes"), *spans).collect()}
        parts = {}
        for n in level:
            r = stats.get(n.first)
            widest = max(dimensions, key=lambda d: r[d]) if r else dimensions[0]
            parts[n] = (widest, (r["bytes"] if r else 0) * (n.shards // 2) / n.shards)
        made = medians(placed, {n: p for n, p in parts.items() if p[1] > 0}, tolerance)
        made += [Cut(n, p[0], 0) for n, p in parts.items() if p[1] <= 0]
        cuts += made
        level = [child for c in made for child in (c.left, c.right) if child.shards > 1]
    return cuts


def numbered_copies(rows: DataFrame) -> DataFrame:
    """Rows with `copy`, a number from 0 among equal rows. Equal rows are counted, and runs of 10,000 copies written by
    different tasks."""
    counted = saved(rows.groupBy(*rows.columns).agg(F.count("*").alias("times")), "copies")
    if not counted.where("times > 1").limit(1).count():
        return counted.select(*rows.columns, F.lit(0).cast("long").alias("copy"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / RUN))))
    dealt = runs.repartition("doc_id", "code", "run")
    last = F.least(F.col("times"), (F.col("run") + 1) * RUN) - 1
    return saved(dealt.select(*rows.columns, F.explode(F.sequence(F.col("run") * RUN, last)).alias("copy")), "numbered")


def shard_documents(docs: DataFrame, shards: int = 24, dimensions: tuple[str, ...] = ("source", "lang", "n_chars"), tolerance: float = 0.0005, per_bucket: int = 20_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of `docs`.

    `law` is `bytes`: every part is cut where its bytes divide as its shards do, to within `tolerance` of the wanted
    bytes or one row, along the dimension in which it is widest. Equal codes are ordered by a hash of the
    text and then of the row, so hot sources and repeated rows are cut like any others, and a cut passes through at most
    one text among rows of one code; equal texts of different sources or languages may part. Slots number the rows of a shard:
    counts of hashed buckets (about `per_bucket` rows) are summed first, so no task sorts a whole shard.
    Rows are told apart by doc_id, text and a copy number, so the result does not depend on the files they lie in.
    NULL text: size 8 and crc32 of nothing; NULL metadata sorts lowest; missing dimensions are skipped. With
    fewer rows than shards some shards stay empty.
    """
    present = [d for d in dimensions if d in docs.columns]
    skip = common_bytes(docs, [d for d in present if docs.schema[d].dataType.typeName() == "string"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 8).cast("long").alias("size")
    dims = [position(docs, d, skip.get(d, 0)).alias(f"dim_{d}") for d in present] or [F.lit(0.0).alias("dim_none")]
    names = [f"dim_{d}" for d in present] or ["dim_none"]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("code"), *dims)
    slim = numbered_copies(saved(slim, "sizes"))
    same_text = F.shiftleft(F.shiftrightunsigned(F.xxhash64("code"), 64 - TIE_BITS + ROW_BITS), ROW_BITS)
    tie = same_text.bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id", "code", "copy"), 64 - ROW_BITS)).alias("tie")
    rows = coded(slim, names).select("*", tie)
    placed = rows.withColumn("shard", node_of(kd_cuts(rows, names, shards, tolerance)))
    buckets = max(1, round(slim.count() / per_bucket))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "code", "copy", F.lit(1)), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "bucket", before.alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "code", "copy")
    numbered = placed.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.row_number().over(order) - 1)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
