"""Content fingerprint and lineage record.

A row of a series has one digest, of its position in the series and the exact bits of its values. The digests of the rows
in a window are summed limb by limb: positions are part of them, so the sum stands for the rows in their order, and it rolls
along the series as integers. A window's digest covers that sum, its engine, position and label.

`contents_of_series` gives the other form, a digest over the text of all values of every window, each window hashed whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.functions.digests import LIMBS, SHORT_HEX, SHORT_LIMBS, bits_text, limb, short_limb
from wearspan.operators.blocks import HALO
from wearspan.operators.ranked import RANK, LongSeries, split_by_rank
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.session import ship

DIGEST = "_d"
# Above this length the sum of a window's limbs might leave a BIGINT.
LONGEST_WINDOW = 32_768


def row_digest(position: Column, values: Column) -> Column:
    """SHA-256 of a row: its 1-based position and the text of its values' bits."""
    return F.sha2(F.concat_ws("|", position.cast("string"), values), 256)


def window_digest(engine: Column, position: Column, label: Column, content: list[Column]) -> Column:
    """SHA-256 of one window: 0-based position, label, its content (limb sums of its rows' digests or the text of its values), and engine."""
    head = [F.coalesce(c.cast("string"), F.lit("null")) for c in (position, label, *content)]
    return F.sha2(F.concat_ws("|", *head, engine), 256)


def check_length(window: int) -> None:
    if not 1 <= window <= LONGEST_WINDOW:
        raise ValueError(f"window must lie in 1 to {LONGEST_WINDOW}, got {window}")


def digests_of_series(rows: DataFrame, features: list[str], window: int, long: LongSeries | None = None) -> DataFrame:
    """(engine_id, window_index, label, `_d`) of every full window, from the rows: no window is built.

    Each row is digested once and what the frame holds of it is five integers, however many features there are. Long
    engines are cut by rank; `long` hands in a size check that was made already.
    """
    check_length(window)
    order = [CYCLE, *features]
    split = split_by_rank(rows.select(ENTITY, CYCLE, LABEL, *features), ENTITY, order, window - 1, long=long)
    series = Window.partitionBy(*split.keys).orderBy(*split.order)
    placed = split.dealt.withColumn("_position", F.coalesce(F.col(RANK), F.row_number().over(series).cast("long")))
    values = F.concat_ws(",", *[bits_text(F.col(c)) for c in features])
    digested = placed.withColumn("_row_digest", row_digest(F.col("_position"), values))
    frame = series.rowsBetween(1 - window, Window.currentRow)
    names = [f"_s{i}" for i in range(SHORT_LIMBS)]
    short = digested.withColumns({n: short_limb(F.col("_row_digest"), i) for i, n in enumerate(names)})
    summed = short.withColumns({n: F.sum(n).over(frame) for n in names})
    full = summed.filter((F.col("_position") >= window) & ~F.col(HALO)).withColumn("window_index", F.col("_position") - window)
    digest = window_digest(F.col(ENTITY), F.col("window_index"), F.col(LABEL), [F.col(n) for n in names])
    return full.select(F.col(ENTITY).alias("engine_id"), "window_index", LABEL, digest.alias(DIGEST))


def contents_of_series(rows: DataFrame, features: list[str], window: int, long: LongSeries | None = None) -> DataFrame:
    """(engine_id, window_index, label, `_d`) of every full window, hashed whole: 0-based position, label, the exact bits of all
    its values, oldest row first, and engine.

    The text of a row's bits is made once; a frame holds `window` such texts. Long engines are cut by rank as above.
    """
    order = [CYCLE, *features]
    split = split_by_rank(rows.select(ENTITY, CYCLE, LABEL, *features), ENTITY, order, window - 1, long=long)
    series = Window.partitionBy(*split.keys).orderBy(*split.order)
    placed = split.dealt.withColumn("_position", F.coalesce(F.col(RANK), F.row_number().over(series).cast("long")))
    texts = placed.withColumn("_bits", F.concat_ws(",", *[bits_text(F.col(c)) for c in features]))
    held = texts.withColumn("_bits", F.collect_list("_bits").over(series.rowsBetween(1 - window, Window.currentRow)))
    full = held.filter((F.col("_position") >= window) & ~F.col(HALO)).withColumn("window_index", F.col("_position") - window)
    digest = window_digest(F.col(ENTITY), F.col("window_index"), F.col(LABEL), [F.concat_ws(",", "_bits")])
    return full.select(F.col(ENTITY).alias("engine_id"), "window_index", LABEL, digest.alias(DIGEST))


def digests_of_windows(
    windows: DataFrame, width: int, position: str = "window_index", values: str = "windowed_features"
) -> DataFrame:
    """The digests of `digests_of_series` from a window table, whose flat windows have `width` values a step.

    All values of a window are read. A step whose position and bits are those of the next step of the window before it has
    that step's digest already, so in a table that lies in order a row is digested about once a batch and not once a window.
    """
    rows = windows.select(
        F.col("engine_id").cast("string"), F.col(position).cast("long").alias(position), F.col(LABEL).cast("int").alias(LABEL), F.col(values).cast("array<float>").alias("_values")
    )
    schema = f"engine_id string, `{position}` long, `{LABEL}` int, `{DIGEST}` string"

    ship(windows.sparkSession)

    def digested(batches):
        for batch in batches:
            yield batch_digests(batch, width)

    return rows.mapInArrow(digested, schema)


def batch_digests(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """One Arrow batch of engines, positions, labels and values to its window digests."""
    engines, places, labels = (batch.column(i).to_pylist() for i in range(3))
    lists = batch.column(3)
    found: list[str | None] = [None] * len(engines)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):  # one size, unless the table is broken
        at = np.flatnonzero(sizes == size)
        flat = lists.take(pa.array(at)).flatten()
        numbers = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype("<f4", copy=False)
        bits = np.where(np.isnan(numbers), np.uint32(0x7FC00000), numbers.view("<u4")).astype(np.int64)
        if flat.null_count:
            bits[pc.is_null(flat).to_numpy(zero_copy_only=False)] = -1
        steps = int(size) // width
        bits = bits.reshape(len(at), int(size))[:, : steps * width].reshape(len(at), steps, width)
        names, first = [engines[i] for i in at], [places[i] for i in at]
        for i, limbs in zip(at, _limb_sums(names, first, bits), strict=True):
            head = ["null" if x is None else str(x) for x in (places[i], labels[i], *limbs)]
            text = "|".join(head if engines[i] is None else [*head, engines[i]])
            found[i] = hashlib.sha256(text.encode()).hexdigest()
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in range(3)), pa.array(found, pa.string())], names=[*batch.schema.names[:3], DIGEST]
    )


def _limb_sums(engines: list, places: list, bits: np.ndarray) -> list[list[int]]:
    """Limb sums of the step digests of windows; `bits` are windows by steps by values, -1 for a missing value."""
    n, steps, _ = bits.shape
    follows = np.array(
        [i > 0 and engines[i] == engines[i - 1] and None not in places[i - 1 : i + 1] and places[i] == places[i - 1] + 1 for i in range(n)], dtype=bool
    )
    same = np.zeros((n, steps), dtype=bool)
    if n > 1 and steps > 1:
        same[1:, :-1] = follows[1:, None] & (bits[1:, :-1] == bits[:-1, 1:]).all(axis=2)
    number = np.cumsum(~same).reshape(n, steps) - 1  # of the steps that need a digest of their own
    for step in range(steps - 2, -1, -1):
        number[1:, step] = np.where(same[1:, step], number[:-1, step + 1], number[1:, step])
    fresh = np.argwhere(~same)
    limbs = np.empty((len(fresh), SHORT_LIMBS), dtype=np.int64)
    own = bits[~same].tolist()
    for k, ((i, step), row) in enumerate(zip(fresh.tolist(), own, strict=True)):
        values = ",".join("null" if b < 0 else str(b) for b in row)
        place = places[i]
        digest = hashlib.sha256((values if place is None else f"{place + step + 1}|{values}").encode()).hexdigest()
        limbs[k] = [int(digest[j * SHORT_HEX : (j + 1) * SHORT_HEX], 16) for j in range(SHORT_LIMBS)]
    sums = np.zeros((n, SHORT_LIMBS), dtype=np.int64)
    for step in range(steps):
        sums += limbs[number[:, step]]
    return sums.tolist()


def digests_of_packed(packed: DataFrame, width: int) -> DataFrame:
    """The digests of `digests_of_windows` from packed windows: a step that windows share lies there once and is digested once."""
    schema = f"engine_id string, window_index long, `{LABEL}` int, `{DIGEST}` string"
    ship(packed.sparkSession)

    def digested(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 16):
                yield _packed_digests(batch.slice(low, 16), width)

    return packed.select("engines", "positions", "labels", "starts", "size", "values").mapInArrow(digested, schema)


def _packed_digests(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    engines, places, labels, starts = (batch.column(i).flatten() for i in range(4))
    windows, lengths = (pc.list_value_length(batch.column(i)).to_numpy(zero_copy_only=False) for i in (3, 5))
    flat = batch.column(5).flatten()
    numbers = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype("<f4", copy=False)
    bits = np.where(np.isnan(numbers), np.uint32(0x7FC00000), numbers.view("<u4")).astype(np.int64)
    if flat.null_count:
        bits[pc.is_null(flat).to_numpy(zero_copy_only=False)] = -1
    bits = bits.reshape(-1, width)
    begins = (starts.to_numpy(zero_copy_only=False) + np.repeat(np.cumsum(lengths) - lengths, windows)) // width
    steps = np.repeat(batch.column(4).to_numpy(zero_copy_only=False) // width, windows)
    known = pc.is_valid(places).to_numpy(zero_copy_only=False)
    first = pc.fill_null(places, 0).to_numpy(zero_copy_only=False)
    # The position of every step and whether it has one; windows that share steps agree on both.
    position, placed = np.zeros(len(bits), dtype=np.int64), np.zeros(len(bits), dtype=bool)
    for size in np.unique(steps):
        at = np.flatnonzero(steps == size)
        inside = begins[at, None] + np.arange(size)
        position[inside] = first[at, None] + np.arange(1, size + 1)
        placed[inside] = known[at, None]
    found = []
    for place, has, row in zip(position.tolist(), placed.tolist(), bits.tolist(), strict=True):
        text = ",".join(["null" if b < 0 else str(b) for b in row])
        found.append(hashlib.sha256((f"{place}|{text}" if has else text).encode()).digest())
    octets = np.frombuffer(b"".join(found), dtype=np.uint8).reshape(len(found), 32)[:, : SHORT_LIMBS * SHORT_HEX // 2]
    limbs = octets.reshape(len(found), SHORT_LIMBS, SHORT_HEX // 2).astype(np.int64) @ (256 ** np.arange(SHORT_HEX // 2)[::-1])
    sums = np.concatenate([np.zeros((1, SHORT_LIMBS), dtype=np.int64), np.cumsum(limbs, axis=0)])
    held = (sums[begins + steps] - sums[begins]).tolist()
    digests = []
    for engine, place, label, own in zip(engines.to_pylist(), places.to_pylist(), labels.to_pylist(), held, strict=True):
        head = "|".join(["null" if x is None else str(x) for x in (place, label, *own)])
        digests.append(hashlib.sha256((head if engine is None else f"{head}|{engine}").encode()).hexdigest())
    return pa.RecordBatch.from_arrays([engines, places, labels, pa.array(digests, pa.string())], names=["engine_id", "window_index", LABEL, DIGEST])


def digest_total(digests: DataFrame, digest: str, by: list[str] | None = None) -> DataFrame:
    """Order-free digest of a set of rows: the row digests are summed limb by limb.

    Sums combine map-side, so no group is collected or sorted, however many rows it has. Every row
    digest covers its own position, so reordering rows inside an engine changes the result.
    """
    sums = digests.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.coalesce(F.sum(limb(F.col(digest), i)), F.lit(0)).cast("decimal(38,0)").alias(f"_l{i}")
            for i in range(LIMBS)
        ],
    )
    text = F.concat_ws(
        "|",
        F.col("rows").cast("string"),
        *[F.col(f"_l{i}").cast("string") for i in range(LIMBS)],
    )
    return sums.select(*(by or []), "rows", F.sha2(text, 256).alias("digest"))


def split_text(val_split: float, test_split: float, seed: int) -> str:
    """Split parameters as text; fractions in millionths."""
    return f"val={round(val_split * 1e6)};test={round(test_split * 1e6)};seed={seed}"


def fingerprint(
    digests: DataFrame, features: list[str], val_split: float, test_split: float, seed: int
) -> DataFrame:
    """One row: digest of the exact content trained on, with split parameters and feature names.

    `digests` are those of `digests_of_series` or `digests_of_windows`.
    """
    extra = f"{split_text(val_split, test_split, seed)};{','.join(features)}"
    return digest_total(digests, DIGEST).select(
        "rows",
        F.sha2(F.concat_ws("|", F.col("digest"), F.lit(extra)), 256).alias("fingerprint"),
    )


def lineage_tags(
    code_version: str | None = None,
    dirty: bool | None = None,
    data_hash: str | None = None,
    data_dir: str = "",
    image_tag: str | None = None,
) -> dict[str, str]:
    """Lineage of a run from job arguments; what is not known says so."""
    return {
        "code_version": code_version or "unknown",
        "code_dirty": "unknown" if dirty is None else str(dirty).lower(),
        "data_hash": data_hash or "unknown",
        "data_dir": data_dir,
        "image_tag": image_tag or code_version or "local-dev",
    }
