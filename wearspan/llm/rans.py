"""Token-id output by a static range asymmetric numeral system (rANS).

All documents in ascending doc_id order make one stream of ids. It is cut into blocks of a fixed number
of ids that are coded independently with one shared table of frequencies, so any task can write or read any
block. In a block the ids are dealt over lanes that numpy codes side by side; the lanes' words lie interleaved,
step by step. Checkpoints inside a block hold the lanes' states, so that reading can start there. Checksums cover
the bytes of a block, the ids it holds, and the table it was written with.

A token folder holds three Parquet tables: `blocks` (part, seq, data), where `data` is the binary block described at
`Block`, `table` (id, frequency) and `parts` (part, pieces, tokens, start). Spark's writer commits them, so a
task that is lost and run again leaves no torn file; the parts table is written last and marks the folder as whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm.bytebpe import shared_encoder
from wearspan.llm.frames import chunks, saved, ship

MAGIC = b"WRNS0001"
HEAD = struct.Struct("<8sIIIIqqIIII")  # magic, part, seq, lanes, steps a checkpoint, before, ids, pieces, words, table crc, ids crc
PIECE = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("document", "<i8"), ("offset", "<i8"), ("total", "<i8"), ("length", "<i8")])
LOW = np.uint64(1 << 31)  # states stay at or above this
WORD = np.uint64(32)
# Frequencies of a table add up to 2^BITS; every id that occurs has at least one.
BITS = 20


@dataclass(frozen=True)
class RansParams:
    """block_ids: ids of a block; lanes: most lanes of a block; checkpoint: steps between checkpoints."""

    block_ids: int = 1 << 18
    lanes: int = 512
    checkpoint: int = 256


@dataclass(frozen=True)
class Frequencies:
    """The shared table: frequency and start of every id, and the id of every slot."""

    frequency: np.ndarray
    start: np.ndarray
    slots: np.ndarray
    crc: int

    @classmethod
    def of(cls, frequency: np.ndarray) -> Frequencies:
        frequency = np.ascontiguousarray(frequency, "<u4")
        if frequency.sum() not in (0, 1 << BITS):
            raise ValueError(f"frequencies add up to {frequency.sum()} and not to 2^{BITS}")
        start = np.concatenate([[0], np.cumsum(frequency, dtype=np.int64)[:-1]]).astype(np.uint64)
        slots = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)
        return cls(frequency.astype(np.uint64), start, slots, zlib.crc32(np.trim_zeros(frequency, "b").tobytes()))


def quantised(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that add up to 2^bits in proportion to the counts, 1 at least for each id that occurs.

    The error of rounding is settled on the most frequent ids, where it costs least. No counts: all zero.
    """
    total, target = int(counts.sum()), 1 << bits
    present = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out.astype(np.uint32)
    if len(present) > target:
        raise ValueError(f"{len(present)} different ids do not fit {bits} bits")
    # Exact in integers: the counts of a large corpus times 2^bits exceed 64 bits.
    out[present] = [max(1, int(c) * target // total) for c in counts[present].tolist()]
    order = present[np.argsort(-counts[present], kind="stable")]
    rest = target - int(out.sum())
    if rest > 0:
        out[order[0]] += rest
    for i in order:
        if rest >= 0:
            break
        taken = min(int(out[i]) - 1, -rest)
        out[i] -= taken
        rest += taken
    return out.astype(np.uint32)


def lane_count(ids: int, most: int) -> int:
    """A power of two with about 64 steps or more, so that the lanes' states stay small beside the words."""
    return max(1, min(most, 1 << max(0, (ids // 64).bit_length() - 1)))


@dataclass(frozen=True)
class Block:
    """One block. In bytes: the fields of HEAD, the pieces, for each checkpoint its place among the words and
    its lane states, the words, and the crc32 of everything before it; all little-endian.

    A piece is a run of ids of one document: whether its doc_id is NULL, the doc_id, the number of the document in the part, the ids of
    the document before the piece and in all, and its own ids. `before` counts the part's ids before the block.
    """

    part: int
    seq: int
    before: int
    pieces: np.ndarray
    ids: np.ndarray = field(repr=False)


def encode_block(block: Block, table: Frequencies, p: RansParams = RansParams()) -> bytes:
    """The bytes of a block. An id without a frequency in `table` is an error."""
    ids = block.ids.astype(np.int64)
    n, lanes = len(ids), lane_count(len(ids), p.lanes)
    frequency, start = table.frequency[ids], table.start[ids]
    if n and not frequency.all():
        raise ValueError(f"id {int(ids[frequency == 0][0])} has no frequency in the shared table")
    state = np.full(lanes, LOW, np.uint64)
    steps = -(-n // lanes)
    written: list[np.ndarray] = []
    states: dict[int, np.ndarray] = {}
    # Backward, because the coder is last in, first out; a full lane first sheds one word.
    for step in range(steps - 1, -1, -1):
        at = step * lanes
        f, c = frequency[at : at + lanes], start[at : at + lanes]
        x = state[: len(f)]
        full = x >= (f << np.uint64(63 - BITS))
        written.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> WORD, x)
        q = x // f
        state[: len(f)] = (q << np.uint64(BITS)) + (x - q * f) + c
        if step % p.checkpoint == 0:
            states[step] = state.copy()
    written.reverse()
    place = np.concatenate([[0], np.cumsum([len(w) for w in written], dtype=np.int64)])
    words = np.concatenate(written) if written else np.empty(0, "<u4")
    body = [
        HEAD.pack(MAGIC, block.part, block.seq, lanes, p.checkpoint, block.before, n, len(block.pieces), len(words), table.crc, zlib.crc32(block.ids.astype("<u4").tobytes())),
        block.pieces.tobytes(),
        *[place[s].astype("<i8").tobytes() + states[s].astype("<u8").tobytes() for s in sorted(states)],
        words.tobytes(),
    ]
    data = b"".join(body)
    return data + struct.pack("<I", zlib.crc32(data))


@dataclass(frozen=True)
class OpenBlock:
    """A block whose bytes have been checked, ready to be decoded from any checkpoint on."""

    part: int
    seq: int
    before: int
    n: int
    lanes: int
    every: int
    ids_crc: int
    pieces: np.ndarray
    checkpoints: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, data: bytes, table: Frequencies) -> OpenBlock:
        """Raises ValueError for foreign, torn or changed bytes and for another table of frequencies."""
        if len(data) < HEAD.size + 4 or data[:8] != MAGIC:
            raise ValueError("not a block of token ids")
        if zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("the checksum of a block does not hold")
        _, part, seq, lanes, every, before, n, count, n_words, table_crc, ids_crc = HEAD.unpack_from(data)
        if table_crc != table.crc:
            raise ValueError(f"block {part}/{seq} was written with another table of frequencies")
        at = HEAD.size
        pieces = np.frombuffer(data, PIECE, count, at)
        at += pieces.nbytes
        kind = np.dtype([("place", "<i8"), ("states", "<u8", (lanes,))])
        checkpoints = np.frombuffer(data, kind, -(-(-(-n // lanes)) // every), at)
        at += checkpoints.nbytes
        return cls(part, seq, before, n, lanes, every, ids_crc, pieces, checkpoints, np.frombuffer(data, "<u4", n_words, at))

    def segment(self, number: int, table: Frequencies) -> np.ndarray:
        """The ids from one checkpoint to the next, read without what lies before it."""
        first = number * self.every * self.lanes
        out = np.empty(min(self.n - first, self.every * self.lanes), np.uint32)
        at, state = int(self.checkpoints["place"][number]), self.checkpoints["states"][number].astype(np.uint64)
        mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
        for begin in range(0, len(out), self.lanes):
            x = state[: min(self.lanes, len(out) - begin)]
            slot = x & mask
            ids = table.slots[slot]
            out[begin : begin + len(x)] = ids
            x = table.frequency[ids] * (x >> bits) + slot - table.start[ids]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << WORD) | self.words[at : at + len(low)]
            at += len(low)
            state[: len(x)] = x
        return out

    def ids(self, table: Frequencies) -> np.ndarray:
        """All ids, checked against their checksum."""
        found = [self.segment(k, table) for k in range(len(self.checkpoints))]
        ids = np.concatenate(found) if found else np.empty(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != self.ids_crc:
            raise ValueError(f"the ids of block {self.part}/{self.seq} do not have their checksum")
        return ids

    def some(self, first: int, end: int, table: Frequencies) -> np.ndarray:
        """The ids from place `first` to `end` of the block, from the checkpoint in front of them."""
        size = self.every * self.lanes
        numbers = range(first // size, -(-end // size))
        ids = np.concatenate([self.segment(k, table) for k in numbers]) if numbers else np.empty(0, np.uint32)
        return ids[first - numbers.start * size : end - numbers.start * size]


def zeros_operator() -> np.ndarray:
    """The linear map on a crc32 register of one zero bit behind the data: column i is the image of bit i."""
    return np.array([0xEDB88320, *[1 << i for i in range(31)]], np.uint64)


def applied(operator: np.ndarray, register: int) -> int:
    out = 0
    for i in range(32):
        if register >> i & 1:
            out ^= int(operator[i])
    return out


_powers: list[np.ndarray] = []


def crc_behind(crc: int, length: int) -> int:
    """What a piece's crc32 adds, by xor, to the crc32 of a text in which `length` bytes follow the piece."""
    if not _powers:
        bit = zeros_operator()
        for _ in range(3):
            bit = np.array([applied(bit, int(c)) for c in bit], np.uint64)
        _powers.append(bit)
    k = 0
    while length:
        while len(_powers) <= k:
            last = _powers[-1]
            _powers.append(np.array([applied(last, int(c)) for c in last], np.uint64))
        if length & 1:
            crc = applied(_powers[k], crc)
        length, k = length >> 1, k + 1
    return crc


RAW = "part int, seq int, before long, pieces binary, ids binary"
RAW_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("pieces", pa.binary()), ("ids", pa.binary())])


def raw_blocks(docs: DataFrame, vocabulary: bytes, end_id: int, block_ids: int) -> DataFrame:
    """Documents in order, as blocks of plain 16- or 32-bit ids with their pieces.

    Rows are dealt into ranges of (doc_id, digest of the text, row), so a doc_id that is repeated many times does
    not make one large range. NULL doc_ids come first. Every id of a document, and `end_id` behind it, is in the stream.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    narrow = "<u2" if shared_encoder(vocabulary).size <= 1 << 16 and end_id < 1 << 16 else "<u4"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = shared_encoder(shared.value), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        pieces: list[tuple] = []
        held: list[np.ndarray] = []
        size = before = seq = document = 0

        def block() -> pa.RecordBatch:
            row = [part], [seq], [before], [np.array(pieces, PIECE).tobytes()], [np.concatenate(held).astype(narrow).tobytes()]
            return pa.record_batch([pa.array(v, t) for v, t in zip(row, RAW_ARROW.types, strict=True)], schema=RAW_ARROW)

        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                for doc, text in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                    ids = np.concatenate([np.frombuffer(bpe.encode(text), "<u4"), end])
                    at = 0
                    while at < len(ids):
                        taken = ids[at : at + block_ids - size]
                        pieces.append((doc is None, doc or 0, document, at, len(ids), len(taken)))
                        held.append(taken)
                        at, size = at + len(taken), size + len(taken)
                        if size == block_ids:
                            yield block()
                            before, seq, size, pieces, held = before + size, seq + 1, 0, [], []
                    document += 1
        if size:
            yield block()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    keyed = slim.withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("doc_id", "h", "r").sortWithinPartitions("doc_id", "h", "r")
    return ordered.select("doc_id", "text").mapInArrow(cut, RAW)


def id_counts(raw: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs, over all blocks. One row per id and task leaves the tasks, one row per id of the
    vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(plain_ids(ids.as_buffer(), size), minlength=size)
        present = np.flatnonzero(total)
        yield pa.record_batch([pa.array(present, pa.int32()), pa.array(total[present])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for row in raw.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["id"]] = row["n"]
    return out


def plain_ids(buffer: bytes, size: int) -> np.ndarray:
    return np.frombuffer(buffer, "<u2" if size <= 1 << 16 else "<u4")


def write_tokens(docs: DataFrame, path: str, vocabulary: bytes, end_id: int = 2, p: RansParams = RansParams()) -> None:
    """Tokenize every row of `docs` (doc_id, text) and write the token folder `path`, which must not exist.

    NULL and empty texts are `end_id` alone; repeated rows each come; rows of one doc_id are ordered by a hash of
    their text; an empty table makes a folder without blocks.
    """
    spark = docs.sparkSession
    size = max(shared_encoder(vocabulary).size, end_id + 1)
    raw = saved(raw_blocks(docs, vocabulary, end_id, p.block_ids), "raw-ids", compression="zstd")
    frequency = quantised(id_counts(raw, size))
    shared = spark.sparkContext.broadcast(frequency)
    cells = [(i, int(frequency[i])) for i in np.flatnonzero(frequency).tolist()]
    spark.createDataFrame(cells, "id int, frequency int").coalesce(1).write.parquet(f"{path}/table")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies.of(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, seq, before, pieces, ids = (batch.column(c)[row] for c in range(5))
                block = Block(part.as_py(), seq.as_py(), before.as_py(), np.frombuffer(pieces.as_buffer(), PIECE), plain_ids(ids.as_buffer(), size))
                yield pa.record_batch([pa.array([block.part], pa.int32()), pa.array([block.seq], pa.int32()), pa.array([encode_block(block, table, p)], pa.binary())], ["part", "seq", "data"])

    raw.mapInArrow(encode, "part int, seq int, data binary").write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    # One row per range partition: its size, and the ids of all partitions before it.
    width = 2 if size <= 1 << 16 else 4
    record = PIECE.itemsize
    opened = F.sum((F.length("pieces") / record).cast("long")).alias("pieces")
    sizes = raw.groupBy("part").agg(opened, F.sum((F.length("ids") / width).cast("long")).alias("tokens")).orderBy("part").collect()
    start, parts = 0, []
    for row in sizes:
        parts.append((row["part"], row["pieces"], row["tokens"], start))
        start += row["tokens"]
    spark.createDataFrame(parts, "part int, pieces long, tokens long, start long").coalesce(1).write.parquet(f"{path}/parts")


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """The frequencies of a token folder by id: at most one row per id of the vocabulary."""
    rows = spark.read.parquet(f"{path}/table").collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint32)
    for r in rows:
        out[r["id"]] = r["frequency"]
    return out


PIECES = "doc_id long, part int, document long, seen long, offset long, total long, length long, crc long, ids binary"
PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32())] + [(c, pa.int64()) for c in ("document", "seen", "offset", "total", "length", "crc")] + [("ids", pa.binary())])


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every piece of every document of a token folder, decoded block by block.

    Columns: doc_id, part and document (the document's place in the part), seen (the part's ids before the piece), offset (the
    document's ids before it), total (the document's ids), length, crc (what the piece adds by xor to the crc32 of the
    document's 32-bit ids), and on request the ids as little-endian 32-bit integers. A damaged block is an error.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies.of(shared.value)
        for batch in batches:
            for data in batch.column("data"):
                block = OpenBlock.of(data.as_buffer().to_pybytes(), table)
                ids = block.ids(table).astype("<u4").tobytes()
                pieces = block.pieces
                ends = np.cumsum(pieces["length"])
                begins = ends - pieces["length"]
                parts = [ids[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                behind = (pieces["total"] - pieces["offset"] - pieces["length"]).tolist()
                crc = [crc_behind(zlib.crc32(part), 4 * after) for part, after in zip(parts, behind, strict=True)]
                columns = [
                    pa.array(pieces["doc_id"], mask=pieces["null"].astype(bool)),
                    pa.array(np.full(len(pieces), block.part, np.int32)),
                    *[pa.array(np.ascontiguousarray(v, np.int64)) for v in (pieces["document"], block.before + begins, pieces["offset"], pieces["total"], pieces["length"], crc)],
                    pa.array(parts if with_ids else [None] * len(parts), pa.binary()),
                ]
                yield pa.record_batch(columns, schema=PIECES_ARROW)

    return spark.read.parquet(f"{path}/blocks").select("data").mapInArrow(decode, PIECES)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a token folder, from its blocks.

    `start` counts the ids of all documents before it. Only documents that lie in several blocks are shuffled; the
    parts of their checksums are put together by xor.
    """
    pieces = saved(read_pieces(spark, path).drop("ids"), "pieces")
    whole = F.col("length") == F.col("total")
    one = pieces.where(whole).select("doc_id", "part", "seen", "total", "length", "crc")
    several = (
        pieces.where(~whole)
        .groupBy("part", "document")
        .agg(F.first("doc_id").alias("doc_id"), F.min("seen").alias("seen"), F.first("total").alias("total"), F.sum("length").alias("length"), F.bit_xor("crc").alias("crc"))
        .select("doc_id", "part", "seen", "total", "length", "crc")
    )
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")  # one row per range partition
    complete = F.when(F.col("length") == F.col("total"), F.col("length")).otherwise(F.raise_error(F.lit("blocks of a document are missing")))
    joined = one.unionByName(several).join(F.broadcast(parts), "part")
    return joined.select("doc_id", (F.col("start") + F.col("seen")).alias("start"), complete.cast("long").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def read_range(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """block_start and ids of the part of each block that lies in the ids `first` to `end` of the whole stream.

    Blocks outside are pruned by part; inside a block, decoding starts at the checkpoint in front.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(read_table(spark, path))
    parts = spark.read.parquet(f"{path}/parts").where((F.col("start") < end) & (F.col("start") + F.col("tokens") > first))
    starts = {r["part"]: r["start"] for r in parts.collect()}  # one row per range partition

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies.of(shared.value)
        for batch in batches:
            for data in batch.column("data"):
                block = OpenBlock.of(data.as_buffer().to_pybytes(), table)
                at = starts[block.part] + block.before
                low, high = max(first - at, 0), min(end - at, block.n)
                if low < high:
                    ids = block.some(low, high, table)
                    yield pa.record_batch([pa.array([at + low]), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["start", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks").where(F.col("part").isin(list(starts)))
    return blocks.select("data").mapInArrow(decode, "start long, ids array<long>")
