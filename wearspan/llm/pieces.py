"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

Texts are spelled with a whitespace marker, pieces carry log scores, and characters that no piece
covers fall back to byte pieces. The piece table is read from a public model file and never trained.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.llm.frames import chunks, fresh, ship

MARKER = "▁"
# Score of an uncovered character below the worst piece (a fixed value of the format).
UNKNOWN_PENALTY = 10.0
# A run of blanks belongs to the word that follows it: no piece has a marker after another character.
WORD = re.compile(" *[^ ]+| +")


@dataclass(frozen=True)
class PieceTable:
    """Pieces by id as bytes, their log scores (NaN: never matched), and the ids of the 256 bytes."""

    pieces: list[bytes]
    scores: list[float]
    byte_ids: list[int]
    dummy_prefix: bool = True


def read_table(path: str, zipf: bool = False) -> PieceTable:
    """The table of a model file. `zipf` replaces scores that are merge ranks by log probabilities of
    Zipf's law over those ranks: log(1 / (rank * H)). Such ranks order the pieces but are no log scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = [math.nan] * size
    for i in plain:
        scores[i] = model.get_score(i)
    if zipf:
        ranked = sorted(plain, key=lambda i: (-scores[i], i))
        harmonic = sum(1 / r for r in range(1, len(ranked) + 1))
        for rank, i in enumerate(ranked, 1):
            scores[i] = -math.log(rank * harmonic)
    spelled = [model.id_to_piece(i) for i in range(size)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the model has no byte pieces")
    for b, i in enumerate(byte_ids):
        spelled[i] = ""
    pieces = [s.replace(MARKER, " ").encode() for s in spelled]
    for b, i in enumerate(byte_ids):
        pieces[i] = bytes([b])
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces[i] = b""
    return PieceTable(pieces, scores, byte_ids)


class DoubleArray:
    """A trie in two integer arrays: the child of state s by byte c is base[s] + c if check there is s."""

    def __init__(self, words: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for word, value in words.items():
            node = 0
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][c]
            values[node] = value
        size = 2 * len(children) + 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        place, dense, todo = {0: 0}, 1, [0]  # cells before `dense` are nearly all taken
        for node in todo:
            codes = sorted(children[node])
            if not codes:
                continue
            cell, taken = max(dense, codes[0] + 1) - 1, 0
            first = None
            while True:
                cell += 1
                if cell + 512 >= len(check):
                    for array, fill in ((base, 0), (check, -1), (value, -1)):
                        array.extend([fill] * len(array))
                if check[cell] >= 0:
                    taken += 1
                    continue
                first = first or cell
                at = cell - codes[0]
                if all(check[at + c] < 0 for c in codes):
                    break
            dense = cell if taken >= 0.9 * (cell - dense + 1) else max(dense, min(first, cell))
            state = place[node]
            base[state] = at
            for c in codes:
                child = children[node][c]
                check[at + c], value[at + c] = state, values[child]
                place[child] = at + c
                todo.append(child)
        end = max(i for i, c in enumerate(check) if c >= 0) + 257
        self.base, self.check, self.value = base[:end], check[:end], value[:end]
        self.check += [-1] * (end - len(self.check))


class PieceModel:
    """Encodes and decodes texts with a piece table; words are cached up to `cache_words` entries."""

    def __init__(self, table: PieceTable, cache_words: int = 500_000) -> None:
        self.table = table
        scored = {p: i for i, (p, s) in enumerate(zip(table.pieces, table.scores, strict=True)) if s == s and p}
        self.trie = DoubleArray(scored)
        self.unknown = min(s for s in table.scores if s == s) - UNKNOWN_PENALTY
        self.by_word = all(b" " not in p.lstrip(b" ") for p in scored)
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def best_path(self, word: bytes) -> tuple[list[int], float]:
        """Ids and score of the best segmentation; of equal ones, that whose last piece is longest."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.table.scores
        n = len(word)
        best = [-math.inf] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        for start in range(n):
            so_far = best[start]
            if so_far == -math.inf:
                continue
            lead = word[start]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            state, at, single = 0, start, False
            while at < n:
                step = base[state] + word[at]
                if check[step] != state or step == 0:
                    break
                state = step
                at += 1
                piece = value[state]
                if piece >= 0:
                    single |= at - start == width
                    score = so_far + scores[piece]
                    if score > best[at]:
                        best[at], back[at] = score, (start, piece)
            if not single:
                end = start + width
                score = so_far + self.unknown
                if score > best[end]:
                    best[end], back[end] = score, (start, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [self.table.byte_ids[b] for b in reversed(word[start:at])]
            at = start
        return ids[::-1], best[n]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids. Empty text: none."""
        if not text:
            return b""
        spelled = " " + text if self.table.dummy_prefix else text
        words = WORD.findall(spelled) if self.by_word else [spelled]
        found = list(map(self.cache.get, words))
        if None in found:
            if len(self.cache) > self.cache_words:
                self.cache.clear()
            for i, known in enumerate(found):
                if known is None:
                    ids, _ = self.best_path(words[i].encode())
                    found[i] = struct.pack(f"<{len(ids)}i", *ids)
                    if len(words[i]) < 64:
                        self.cache[words[i]] = found[i]
        return b"".join(found)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.table.pieces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.table.dummy_prefix and text.startswith(" ") else text


_models: dict[int, PieceModel] = {}


def worker_model(table: PieceTable) -> PieceModel:
    """This worker process's model of a table, with the words it has cached so far."""
    key = zlib.crc32(repr((table.pieces[-50:], table.scores[-50:], len(table.pieces))).encode())
    if key not in _models:
        _models.clear()
        _models[key] = PieceModel(table)
    return _models[key]


def id_lists(parts: list[bytes | None]) -> pa.Array:
    sizes = [0 if p is None else len(p) // 4 for p in parts]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p for p in parts if p), "<i4"))
    missing = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=missing)


def encode(df: DataFrame, table: PieceTable, column: str = "text", to: str = "ids") -> DataFrame:
    """All columns of `df` and the ids of `column`. NULL text: NULL ids; empty text: no ids. Repeated
    rows stay. `to` gets underscores if a column has that name. The table (its size is the
    vocabulary's) is broadcast; each worker builds the trie once."""
    ship(df.sparkSession)
    to = fresh(df, to)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(shared.value)
        for batch in batches:
            for part, texts in chunks(batch, column):
                ids = id_lists([None if t is None else model.encode(t) for t in texts])
                yield pa.record_batch([*part.columns, ids], [*part.schema.names, to])

    return df.mapInArrow(run, df.select("*").schema.add(to, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, table: PieceTable, column: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of `df` and the text of the ids in `column`; NULL ids give NULL, NULL inside a list
    is skipped, and bytes that form no character become U+FFFD."""
    ship(df.sparkSession)
    to = fresh(df, to)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(shared.value)
        for batch in batches:
            texts = [None if ids is None else model.decode([i for i in ids if i is not None]) for ids in batch.column(column).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, to])

    return df.mapInArrow(run, df.select("*").schema.add(to, "string"))


def tokens_and_round_trip(docs: DataFrame, table: PieceTable) -> DataFrame:
    """doc_id, ids, n_tokens, n_bytes (byte pieces), round_trip: decoding gives the text again.

    Both directions in one pass, so that neither ids nor texts travel twice. NULL text counts as empty.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(shared.value)
        is_byte = np.zeros(len(model.table.pieces), bool)
        is_byte[model.table.byte_ids] = True
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                coded = [model.encode(t or "") for t in texts]
                arrays = [np.frombuffer(c, "<i4") for c in coded]
                same = [model.decode(a.tolist()) == (t or "") for a, t in zip(arrays, texts, strict=True)]
                columns = [part.column("doc_id"), id_lists(coded), pa.array([len(a) for a in arrays], pa.int64())]
                columns += [pa.array([int(is_byte[a].sum()) for a in arrays], pa.int64()), pa.array(same)]
                yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "n_bytes", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, n_bytes long, round_trip boolean")
