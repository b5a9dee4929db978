"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random directions, the projections are quantised, and several of them
together name a bucket, in many tables. Vectors that meet in a bucket are compared by their exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.blocks import crowded, meetings, units
from wearspan.llm.components import components
from wearspan.llm.frames import saved, ship
from wearspan.llm.minhash import mixed


# Components that are projected at once.
SLICE = 4096


@dataclass(frozen=True)
class StableParams:
    """cosine: least similarity of a link; width: of a quantum; together: projections of a bucket;
    missed: largest chance that a pair at the threshold shares no bucket; block: vectors compared at once."""

    cosine: float = 0.93
    width: float = 2.0
    together: int = 16
    missed: float = 3e-5
    block: int = 2048
    seed: int = 7

    @property
    def tables(self) -> int:
        """Tables needed for `missed`, from the chance that one projection of two vectors at the
        threshold's distance falls into one quantum."""
        t = self.width / math.sqrt(2 - 2 * self.cosine)
        tail = math.erfc(t / math.sqrt(2))
        one = 1 - tail - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))
        return math.ceil(math.log(self.missed) / math.log(1 - one**self.together))


    @property
    def table_bits(self) -> int:
        """A bucket key holds 32 bits of code, and its table and the vector's length in 32 further bits."""
        return self.tables.bit_length()

    @property
    def most(self) -> int:
        """Vectors must be shorter; with the default tables that is 16,777,216."""
        return 2 ** (32 - self.table_bits)


def usable(values: list | None, most: int) -> bool:
    return bool(values) and len(values) < most and None not in values and all(map(math.isfinite, values)) and any(values)


def projected(unit: np.ndarray, p: StableParams, drawn: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Shifted projections of vectors of one length on all directions. The directions of short vectors are kept in
    `drawn`; those of long ones are drawn again for every slice of components, so that none is held whole."""
    size, columns = unit.shape[1], p.tables * p.together
    if size in drawn:
        directions, shifts = drawn[size]
        return unit @ directions + shifts
    rng = np.random.default_rng([p.seed, size])
    if size <= SLICE:
        drawn[size] = rng.standard_normal((size, columns)), rng.uniform(0, p.width, columns)
        return projected(unit, p, drawn)
    total = np.zeros((len(unit), columns))
    for at in range(0, size, SLICE):
        part = unit[:, at : at + SLICE]
        total += part @ rng.standard_normal((part.shape[1], columns))
    return total + rng.uniform(0, p.width, columns)


def hashed(rows: DataFrame, p: StableParams) -> DataFrame:
    """(vec_id, digest, label, size, vector, keys) of vectors that may link: digest names label and components,
    label is its hash, vector is normalised, keys name the buckets, one 32-bit number per table."""
    factors = np.random.default_rng(p.seed).integers(0, 2**63, p.together, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            labels = batch.column("label").to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                if usable(v, p.most):
                    by_size.setdefault(len(v), []).append(i)
            for size, kept in by_size.items():
                x = np.array([vectors[i] for i in kept], np.float64)
                unit = x / np.abs(x).max(1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                quanta = np.floor(projected(unit, p, drawn) / p.width).astype(np.int64).view(np.uint64)
                codes = (quanta.reshape(len(kept), p.tables, p.together) * factors).sum(2)
                own = np.array([xxhash.xxh3_64_intdigest(f"{labels[i]}|{size}") for i in kept], np.uint64)
                keys = mixed(codes + mixed(own[:, None] + np.arange(p.tables, dtype=np.uint64)))
                keys = (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)
                digests = [xxhash.xxh3_128_digest(f"{labels[i]}|{size}|".encode() + r.tobytes()) for i, r in zip(kept, x + 0.0, strict=True)]
                ends = np.arange(len(kept) + 1)
                yield pa.record_batch(
                    [
                        batch.column("vec_id").take(pa.array(kept)),
                        pa.array(digests, pa.binary()),
                        pa.array(own.view(np.int64)),
                        pa.array(np.full(len(kept), size, np.int32)),
                        pa.ListArray.from_arrays(pa.array((ends * size).astype(np.int32)), pa.array(unit.ravel())),
                        pa.ListArray.from_arrays(pa.array((ends * p.tables).astype(np.int32)), pa.array(keys.ravel())),
                    ],
                    ["vec_id", "digest", "label", "size", "vector", "keys"],
                )

    return rows.mapInArrow(run, "vec_id long, digest binary, label long, size int, vector array<double>, keys array<int>")


def linked_counts(blocks: DataFrame, p: StableParams) -> DataFrame:
    """Per unit and node with a link: `links`, the weight of nodes linked to it that meet it in no earlier
    table, and `least`, the smallest node that it reaches inside the unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, inner, rows in units(batches, ["node", "weight", "table", "label", "vector", "keys"]):
            if not len(left) or not len(right) or (inner and len(left) == 1):
                continue
            node, table = rows["node"], int(rows["table"][0])
            linked = rows["vector"][left] @ rows["vector"][right].T >= p.cosine
            linked &= (rows["label"][left][:, None] == rows["label"][right][None, :]) & (node[left][:, None] != node[right][None, :])
            if not linked.any():
                continue
            i, j = np.nonzero(linked)
            keys = rows["keys"]
            if table:
                fresh = np.ones(len(i), bool)
                for at in range(0, len(i), 65536):
                    a, b = left[i[at : at + 65536]], right[j[at : at + 65536]]
                    fresh[at : at + 65536] = (keys[a, :table] != keys[b, :table]).all(1)
                i, j = i[fresh], j[fresh]
                if not len(i):
                    continue
            a, b = left[i], right[j]
            if not inner:
                a, b = np.r_[a, b], np.r_[b, a]
            links = np.bincount(a, weights=rows["weight"][b], minlength=len(node)).astype(np.int64)
            least = node.copy()
            while True:
                before = least.copy()
                np.minimum.at(least, a, before[b])
                if (least == before).all():
                    break
            touched = np.unique(a)
            yield pa.record_batch([pa.array(node[touched]), pa.array(links[touched]), pa.array(least[touched])], ["node", "links", "least"])

    return blocks.mapInArrow(run, "node long, links long, least long")


def near_vectors(rows: DataFrame, p: StableParams = StableParams()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `rows` (vec_id, embedding, label).

    Only vectors with equal labels that are not NULL are compared, and only those of one length. Equal
    vectors of a label form one class with a weight before anything is hashed into buckets, so copies
    are never compared. A pair is counted in the first table where it meets, inside blocks; only counts
    and the smallest node reached leave a block, never pairs. Vectors that are NULL, empty, zero, of 16,777,216 components or more (see `most`), or hold NULL or
    non-finite components link with nothing, as do rows without vec_id or label. Rows that repeat a vec_id with
    an equal vector are one vector.
    """
    ship(rows.sparkSession)
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    vectors = saved(hashed(slim.where("vec_id IS NOT NULL AND label IS NOT NULL"), p), "vectors")
    members = vectors.select("vec_id", "digest").distinct()
    classes = saved(members.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), "classes")
    heads = vectors.join(classes, "digest").where("vec_id = node").dropDuplicates(["node", "digest"])
    heads = saved(heads.select("node", "weight", "label", "size", "vector", "keys"), "heads")
    spread = heads.select("node", "size", F.posexplode("keys").alias("table", "code"))
    spread = spread.select("node", F.expr(f"shiftleft(cast(code AS long), 32) | shiftleft(cast(table AS long), {32 - p.table_bits}) | cast(size AS long)").alias("key"))
    placed = crowded(spread, p.block).join(heads.select("node", "weight", "label", "vector", "keys"), "node")
    placed = placed.withColumn("table", F.expr(f"cast(shiftright(key, {32 - p.table_bits}) & {2**p.table_bits - 1} AS int)"))
    found = saved(linked_counts(meetings(placed), p), "linked")
    reached = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_class = classes.join(counts, "node", "left").join(reached.select(F.col("id").alias("node"), "component"), "node", "left")
    by_class = by_class.select("digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = members.join(by_class, "digest").select("vec_id", "n_links", "component_id")
    every = slim.select("vec_id")
    return every.join(linked, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.expr("vec_id <=> component_id"))
