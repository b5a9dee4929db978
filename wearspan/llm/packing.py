"""Best-fit packing: documents to sequences of a fixed token budget, by merging residual bins.

Documents become pieces, each partition best-fits its pieces, nearly full bins leave, and the underfull
bins are dealt to fewer partitions as items of the next round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.bytebpe import shared_encoder
from wearspan.llm.frames import chunks, saved, ship

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>"


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def token_pieces(docs: DataFrame, vocabulary: bytes, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document is its ids and `end_id`; a NULL or empty text is `end_id` alone. Only documents above
    `capacity` are cut: the remainder comes first, then pieces of exactly `capacity`. Repeated rows
    are packed once per row. `vocabulary` is the file's bytes (fixed size), broadcast once.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_encoder(shared.value)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for part, texts in chunks(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    ids = bpe.encode(text or "") + end
                    total = len(ids) // 4
                    first = (total - 1) % capacity + 1
                    at, length, piece = 0, first, 0
                    while at < total:
                        code = zlib.crc32(ids[4 * at : 4 * (at + length)])
                        for column, value in zip(rows, (doc, piece, at, length, code), strict=True):
                            column.append(value)
                        at, length, piece = at + length, capacity, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def best_fit(fills: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item: largest first, into the fullest bin that still holds it."""
    order = np.argsort(-fills, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set while a bin with r tokens of room exists
    bins, offsets, count = np.empty(len(fills), np.int64), np.empty(len(fills), np.int64), 0
    for i, size in zip(order.tolist(), fills[order].tolist(), strict=True):
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                open_rooms ^= 1 << room
        else:
            room, b, count = capacity, count, count + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            if not stacks[left]:
                open_rooms |= 1 << left
            stacks[left].append(b)
    return bins, offsets


def packed_round(bins: DataFrame, parts: int, capacity: int) -> DataFrame:
    """Best-fit the bins (fill, members) inside each of `parts` even, deterministic shares."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        fills = group.column("fill").to_numpy()
        bin_of, base = best_fit(fills, capacity)
        members = group.column("members").combine_chunks()
        if isinstance(members, pa.ChunkedArray):
            members = members.chunk(0)
        sizes = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        owner = np.repeat(np.arange(len(fills)), sizes)
        moved = flat.field("offset").to_numpy() + base[owner]
        order = np.lexsort((moved, bin_of[owner]))
        taken = [pa.array(moved[order]) if f.name == "offset" else flat.field(f.name).take(pa.array(order)) for f in flat.type]
        counts = np.bincount(bin_of[owner])
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(taken, [f.name for f in flat.type]))
        return pa.table([pa.array(np.bincount(bin_of, weights=fills).astype(np.int64)), lists], ["fill", "members"])

    # By position in the written table, so that repeated rows are dealt like any others.
    dealt = bins.withColumn("share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))
    return dealt.groupBy("share").applyInArrow(lambda t: pack(t.drop_columns(["share"])), f"fill long, members array<{MEMBER}>")


def pack_pieces(pieces: DataFrame, capacity: int = 1024, nearly_full: float = 0.995, per_task: int = 20_000) -> DataFrame:
    """Sequences of at most `capacity` tokens: the pieces with sequence_id and a gapless offset.

    A round packs shares of about `per_task` bins, so a task holds a bounded number of them whatever
    the input. Bins of at least `nearly_full * capacity` leave after each round. Rounds end with a
    single share, or when a round joins fewer than one bin in a hundred: what is left then has no
    partner (for instance only bins of more than half the budget). Every piece is placed.
    """
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    bins = pieces.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    done = [bins.where(F.col("fill") == capacity)]
    rest, left = bins.where(F.col("fill") < capacity), 0
    left = rest.count()
    while left:
        parts = max(1, round(left / per_task))
        packed = saved(packed_round(rest, parts, capacity), "packed")
        under = F.col("fill") < nearly_full * capacity
        joined = left - packed.count()
        rest = packed.where(under)
        if parts == 1 or joined < left / 100:
            done.append(packed)
            break
        done.append(packed.where(~under))
        left = rest.count()
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.withColumn("sequence_id", F.monotonically_increasing_id()).select("sequence_id", F.inline("members")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def pack_documents(docs: DataFrame, vocabulary: bytes, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenize, cut and pack every row of `docs` (doc_id, text). See the functions above."""
    return pack_pieces(saved(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)


