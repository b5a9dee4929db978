"""Near-duplicate documents by b-bit MinHash.

Minima of many hash functions over a document's word shingles are cut to their low bits and packed; bands
of whole minima make candidate buckets; inside a bucket the packed signatures give a similarity by bit
counts, corrected for chance collisions; and the pairs that it proposes are confirmed on the full shingle sets.
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
from wearspan.llm.frames import chunks, saved, ship

LOW = np.uint64(0x1111111111111111)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearParams:
    """percent: linked if 100 * intersection >= percent * union; hashes: minima per document, of each 4 bits
    are kept; fine: minima of documents that have candidates, of each one bit; missed: largest chance that a pair at the threshold shares no band; sigmas: how far
    below the threshold an estimate may lie and still be confirmed; block: signatures compared at once."""

    percent: int = 85
    words: int = 5
    hashes: int = 125
    fine: int = 1024
    missed: float = 1e-6
    sigmas: float = 4.5
    block: int = 512
    seed: int = 11

    @property
    def rows(self) -> int:
        t = self.percent / 100
        return max([r for r in range(1, 9) if (1 - t**r) ** (self.hashes // r) <= self.missed], default=1)

    def least_equal(self, parts: int, bits: int) -> int:
        """Equal signature parts of `bits` bits from which a pair is confirmed: the share expected at the
        threshold, chance collisions included, less `sigmas` standard deviations."""
        chance = 2.0**-bits
        equal = chance + (1 - chance) * self.percent / 100
        return math.floor(parts * equal - self.sigmas * math.sqrt(parts * equal * (1 - equal)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text. A-Z count as a-z; fewer than
    `words` words are one shingle; no words, none."""
    spelled = [t.encode().lower().split() if t else [] for t in texts]
    flat = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in spelled for w in ws), np.uint64, sum(map(len, spelled)))
    rolled = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for i in range(words):
        rolled = rolled * GOLDEN + flat[i : i + len(rolled)]
    rolled = mixed(rolled)
    out, at = [], 0
    for ws in spelled:
        n = len(ws)
        if n >= words:
            out.append(np.unique(rolled[at : at + n - words + 1]))
        elif n:
            short = np.array([n], np.uint64)
            for h in flat[at : at + n]:
                short = mixed(short * GOLDEN + h)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def minima_of(sets: list[np.ndarray], hashes: int, seed: int) -> np.ndarray:
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    factors = np.random.default_rng(seed).integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    minima = np.empty((len(sets), hashes), np.uint64)
    work = np.empty_like(flat)
    for k, factor in enumerate(factors):
        np.multiply(flat, factor, out=work)
        minima[:, k] = np.minimum.reduceat(work, starts)
    return minima


def packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each minimum, packed into 64-bit numbers."""
    each = 64 // bits
    out = np.zeros((len(minima), -(-minima.shape[1] // each)), np.uint64)
    for k in range(minima.shape[1]):
        low = (minima[:, k] ^ (minima[:, k] >> np.uint64(32))) & np.uint64(2**bits - 1)
        out[:, k // each] |= low << np.uint64(bits * (k % each))
    return out


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    bands = minima.shape[1] // rows
    keys = np.zeros((len(minima), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(minima), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = mixed(key * GOLDEN + minima[:, k])
        keys[:, b] = key
    return keys.view(np.int64)


def lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.view(np.int64).ravel()))


def sketched(docs: DataFrame, p: NearParams) -> DataFrame:
    """doc_id, n_shingles, digest of the set (NULL if empty), packed signature and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                sets = shingle_sets(texts, p.words)
                full = [i for i, s in enumerate(sets) if len(s)]
                digests: list[bytes | None] = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                sig = np.zeros((len(sets), -(-p.hashes // 16)), np.uint64)
                keys = np.zeros((len(sets), p.hashes // p.rows), np.int64)
                if full:
                    minima = minima_of([sets[i] for i in full], p.hashes, p.seed)
                    sig[full], keys[full] = packed(minima, 4), band_keys(minima, p.rows)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists(sig), lists(keys)],
                    ["doc_id", "n_shingles", "digest", "sig", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig array<long>, bands array<long>")


def batch_of(found: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate([f[i] for f in found])) for i in range(2)], ["a", "b"])


def proposals(blocks: DataFrame, p: NearParams, parts: int, bits: int, most: int | None) -> DataFrame:
    """Pairs (a, b) of different components whose sizes and estimate allow a link, from the unit of their first
    common band; with `most`, only that many per node and unit, best first."""
    least = p.least_equal(parts, bits)

    def equal_parts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        differ = np.zeros((len(x), len(y)), np.int32)
        for w in range(x.shape[1]):
            d = x[:, w, None] ^ y[None, :, w]
            if bits == 4:
                d |= d >> np.uint64(1)
                d |= d >> np.uint64(2)
                d &= LOW
            differ += np.bitwise_count(d)
        return parts - differ

    def best(score: np.ndarray) -> np.ndarray:
        mask = score > 0
        if most is not None:
            for i in np.flatnonzero(mask.sum(1) > most):
                mask[i] = False
                mask[i, np.argsort(-score[i], kind="stable")[:most]] = True
        return mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for left, right, inner, rows in units(batches, ["key", "node", "comp", "n", "sig", "bands"]):
            if not len(left) or not len(right) or (inner and len(left) == 1):
                continue
            node, comp, n, sig, bands = rows["node"], rows["comp"], rows["n"], rows["sig"].view(np.uint64), rows["bands"]
            score = equal_parts(sig[left], sig[right])
            small, large = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
            score[(score < least) | (comp[left][:, None] == comp[right][None, :]) | (100 * small < p.percent * large)] = 0
            band = int(np.flatnonzero(bands[left[0]] == rows["key"][0])[0])
            i, j = np.nonzero(score)
            for at in range(0, len(i), 65536) if band else ():
                x, y = i[at : at + 65536], j[at : at + 65536]
                met = (bands[left[x], :band] == bands[right[y], :band]).any(1)
                score[x[met], y[met]] = 0
            if not score.any():
                continue
            mask = best(score)
            if not inner:
                mask |= best(np.ascontiguousarray(score.T)).T
            i, j = np.nonzero(mask)
            a, b = node[left][i], node[right][j]
            found.append((np.minimum(a, b), np.maximum(a, b)))
            if len(found) == 2000:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    return blocks.mapInArrow(run, "a long, b long").distinct()


def near_components(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (doc_id, text).

    Documents with equal shingle sets form one class, named by its smallest doc_id, before anything is
    compared. A bucket is compared in blocks of about `block` members, so no task holds a whole hot
    bucket. First the two best partners of a node leave a block; the links confirmed among them join
    components. Then every other candidate pair between *different* components is judged by a finer
    signature and, if that allows a link, confirmed as well. So each candidate pair is confirmed, refuted, or
    inside one component already. The second look emits all pairs of a large group of texts just below the threshold,
    which stay in separate components; each carries two sets into its confirmation.

    NULL or empty texts and texts of blanks have no shingles and link with nothing. Rows that share a doc_id are one
    document with the links of all its texts. Rows without doc_id link with nothing and are kept.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = saved(sketched(slim, p), "sketches")
    named = sketch.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # Written, so that joins by digest are plain ones, in which Spark can split the digest of a hot group.
    classes = saved(named.groupBy("digest").agg(F.min("doc_id").alias("node")), "nodes")
    heads = saved(named.join(classes, "digest").where("doc_id = node").select("node", "digest", F.col("n_shingles").alias("n"), "sig", "bands").dropDuplicates(["node", "digest"]).drop("digest"), "classes")

    spread = heads.select("node", F.explode("bands").alias("key"))
    members = saved(crowded(spread, p.block), "members")

    code = F.xxhash64("digest")
    repeated = named.groupBy("doc_id").agg(F.min(code).alias("x"), F.max(code).alias("y")).where("x <> y").select("doc_id")
    own = named.select("doc_id", "digest").join(repeated, "doc_id").join(classes, "digest").select("doc_id", "node")
    links = saved(own.join(own.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b").where("a <> b"), "own")

    def linked_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs confirmed on the full sets."""
        first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        judged = pairs.join(first, "a").join(second, "b")
        return judged.where(100 * both >= p.percent * (F.size("x") + F.size("y") - both)).select("a", "b").distinct()

    placed = members.join(heads, "node").withColumn("comp", F.col("node"))
    near = saved(proposals(meetings(placed), p, p.hashes, 4, 2), "proposed")
    wanted = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    # The wanted ids grow with the input: the join is by shuffle at every size, one shuffle of the texts.
    sets = saved(full_sets(slim.join(wanted.hint("merge"), "doc_id", "left_semi"), p), "sets")
    links = saved(links.unionByName(linked_pairs(near, sets)), "links")
    reached = saved(components(links), "components")

    finer = heads.drop("sig").join(sets.select("node", F.col("fine").alias("sig")), "node").join(reached.select(F.col("id").alias("node"), "component"), "node", "left")
    finer = finer.withColumn("comp", F.coalesce("component", "node")).drop("component")
    rest = proposals(meetings(members.join(finer, "node")), p, p.fine, 1, None).join(near, ["a", "b"], "left_anti")
    links = links.unionByName(saved(linked_pairs(saved(rest, "proposed"), sets), "links"))
    reached = saved(components(links), "components")
    roots = reached.select(F.col("id").alias("node"), "component")
    homes = classes.join(roots, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    linked = named.select("doc_id", "n_shingles", "digest").join(homes, "digest").select("doc_id", "n_shingles", "component_id")
    alone = sketch.where("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.expr("doc_id <=> component_id"))


def full_sets(docs: DataFrame, p: NearParams) -> DataFrame:
    """node, all shingles, and a finer signature of every document given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                sets = shingle_sets(texts, p.words)
                full = [i for i, s in enumerate(sets) if len(s)]
                if not full:
                    continue
                sets = [sets[i] for i in full]
                offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
                fine = lists(packed(minima_of(sets, p.fine, p.seed + 1), 1))
                yield pa.record_batch([part.column("doc_id").take(pa.array(full)), shingles, fine], ["node", "shingles", "fine"])

    return docs.mapInArrow(run, "node long, shingles array<long>, fine array<long>")
