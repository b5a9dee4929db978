"""Audit of how document filters interact.

A table-driven transducer reads the UTF-8 bytes of the texts once. It counts words, capitals, code points and symbols,
and its word spans go into a hash table whose hits are verified byte by byte, so distinct words are exact. The
filters' verdicts are five bits a document; what every order of the filters keeps, removes and repeats
follows from counts by bit pattern.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.frames import saved, ship

# Fixed values of the audit: letters of the filters, white space and symbols.
FILTERS = "ABCDE"
BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#$%&*|"
# States: between words and inside a word. Emissions are bits.
BETWEEN, INSIDE = 0, 1
OPENS, CLOSES, CAPITAL, CODE_POINT, SYMBOL = 1, 2, 4, 8, 16
COUNTS = ("words", "distinct_words", "capitals", "code_points", "symbols")


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state of a byte, emission of a state and a byte).

    Every byte decides the state alone: blanks lead between words, all others, continuation bytes included, into one.
    So the state in front of byte i is the next state of byte i - 1, and a run over a buffer is two look-ups a byte.
    """
    into = np.full(256, INSIDE, np.uint8)
    into[list(BLANKS)] = BETWEEN
    out = np.zeros((2, 256), np.uint8)
    out[:, [b for b in range(256) if b & 0xC0 != 0x80]] |= CODE_POINT
    out[:, ord("A") : ord("Z") + 1] |= CAPITAL
    out[:, list(SYMBOLS)] |= SYMBOL
    out[BETWEEN, into == INSIDE] |= OPENS
    out[INSIDE, into == BETWEEN] |= CLOSES
    return into, out


INTO, OUT = transducer()


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span by prefix sums: the polynomial in an odd number, divided by the power at the begin."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(ODD, len(data)), out=sums[1:])
        return (sums[end] - sums[begin]) * powers(INVERSE, len(data) + 1)[begin]


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans that begin at `a` and `b` hold the same bytes."""
    if not len(a):
        return np.zeros(0, bool)
    total = np.cumsum(length)
    place = np.arange(int(total[-1])) - np.repeat(total - length, length)
    same = data[np.repeat(a, length) + place] == data[np.repeat(b, length) + place]
    return np.logical_and.reduceat(same, total - length)


def first_spans(data: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Indexes of the spans that are the only or first-placed of their bytes for their owner.

    Open addressing over all spans at once: a span takes its slot if it is free, is settled if the slot's span has its owner and
    bytes, and goes on to the next slot otherwise. A hash alone settles nothing.
    """
    n = len(begin)
    if not n:
        return np.empty(0, np.int64)
    size = 1 << (2 * n).bit_length()
    with np.errstate(over="ignore"):
        mixed = (span_hashes(data, begin, end) ^ (owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(ODD)
    slot = (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)
    length = end - begin
    held = np.full(size, -1, np.int64)
    open_spans = np.arange(n)
    while len(open_spans):
        at = slot[open_spans]
        free = held[at] < 0
        held[at[free]] = open_spans[free]  # one of the spans that want a free slot gets it
        other = held[at]
        like = (owner[other] == owner[open_spans]) & (length[other] == length[open_spans]) & (mixed[other] == mixed[open_spans])
        told = other == open_spans
        check = np.flatnonzero(like & ~told)
        mine, theirs = open_spans[check], other[check]
        told[check] = equal_spans(data, begin[mine], begin[theirs], length[mine])
        open_spans = open_spans[~told]
        slot[open_spans] = (slot[open_spans] + 1) & (size - 1)
    return held[held >= 0]


def scan(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts by text of words, capitals, code points and symbols; owner, begin and end of every word) of the texts
    that lie at `offsets` in `data`, in one pass of the transducer. Each text starts between words and closes its last."""
    before = np.empty(len(data), np.uint8)
    after = INTO[data]
    before[1:] = after[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[starts] = BETWEEN
    told = OUT[before, data]
    begin = np.flatnonzero(told & OPENS)
    # A word ends at a blank, or where its text ends.
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end = np.sort(np.concatenate([np.flatnonzero(told & CLOSES), last[after[last] == INSIDE] + 1]))
    owner = np.searchsorted(offsets, begin, side="right") - 1

    def by_text(bit: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum((told & bit) != 0, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    return np.stack([by_text(b) for b in (OPENS, CAPITAL, CODE_POINT, SYMBOL)]), owner, begin, end


def text_counts(data: np.ndarray, offsets: np.ndarray, block: int = 4_000_000) -> np.ndarray:
    """COUNTS (rows) of the texts (columns). Texts are taken together up to `block` bytes; a longer one is
    cut behind blanks, and its distinct words are joined as byte strings."""
    out = np.zeros((len(COUNTS), len(offsets) - 1), np.int64)
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, side="right")) - 1)
        low, high = int(offsets[first]), int(offsets[end])
        if high - low <= block:
            counts, owner, b, e = scan(data[low:high], offsets[first : end + 1] - low)
            distinct = np.bincount(owner[first_spans(data[low:high], owner, b, e)], minlength=end - first)
            out[:, first:end] = [counts[0], distinct, *counts[1:]]
        else:
            seen: set[bytes] = set()
            at = low
            while at < high:
                stop = min(at + block, high)
                while stop < high and INTO[data[stop - 1]] == INSIDE:
                    ahead = data[stop : min(stop + block, high)]
                    blanks = np.flatnonzero(INTO[ahead] == BETWEEN)
                    stop += int(blanks[0]) + 1 if len(blanks) else len(ahead)
                part = data[at:stop]
                counts, owner, b, e = scan(part, np.array([0, len(part)]))
                out[[0, 2, 3, 4], first] += counts[:, 0]
                seen.update(part[b[i] : e[i]].tobytes() for i in first_spans(part, owner, b, e).tolist())
                at = stop
            out[1, first] = len(seen)
        first = end
    return out


def count_words(docs: DataFrame, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all) columns of `docs` and COUNTS of the text in `column`; NULL counts as empty. Repeated rows stay."""
    ship(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), *(f"{c} long" for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column).cast(pa.large_string()).fill_null("")
            if texts.offset:
                texts = pa.concat_arrays([texts])
            _, offsets, data = texts.buffers()
            places = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
            counts = text_counts(np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), places)
            yield pa.record_batch([*(batch.column(c) for c in keep), *(pa.array(c) for c in counts)], [*keep, *COUNTS])

    return docs.mapInArrow(run, schema)


def failed_patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, n, good, toxic): documents by source and by the bits of the filters they fail, A the lowest.

    Of the rows of one text only those with its smallest doc_id pass filter E. Rows are first counted in groups of
    equal text digest, part, verdicts and labels, each with its smallest doc_id and the rows that carry it, so a text that
    many documents share is a few groups before its smallest doc_id is joined. A NULL doc_id has no smaller one, and no
    label. A doc_id with several rows of labels is good or toxic if one of them says so.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    counted = count_words(slim, keep=["doc_id", "part", "digest"])
    failed = [
        F.col("words") < 50,
        100 * F.col("distinct_words") < 65 * F.col("words"),
        100 * F.col("capitals") > 5 * F.col("code_points"),
        F.col("symbols") > 0,
    ]
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    rows = counted.groupBy("digest", "part", bits.alias("bits"), "doc_id").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    marked = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    groups = marked.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("with_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
    )
    groups = saved(groups, "verdicts")
    first = groups.groupBy("digest").agg(F.min("least").alias("first"))
    told = groups.join(first, "digest")
    passing = F.col("without_id") + F.when(F.col("least") == F.col("first"), F.col("with_least")).otherwise(0)
    both = F.array(F.struct(F.col("bits").alias("pattern"), passing.alias("n")), F.struct((F.col("bits") + (1 << FILTERS.index("E"))).alias("pattern"), (F.col("n") - passing).alias("n")))
    cells = told.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return cells.groupBy("part", "pattern").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def audit(patterns: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of `failed_patterns`.

    A part has at most 32 patterns. `kept[s]` sums those that meet no filter of set s; all other figures are
    differences of it. A document that fails k filters is removed by each of them in 120 / k orders.
    """
    sets = 1 << len(FILTERS)
    cell = F.collect_list(F.struct("pattern", "n", "good", "toxic"))
    parts = patterns.groupBy("part").agg(cell.alias("cells"))

    def kept(field: str) -> Column:
        def of_set(s: Column) -> Column:
            return F.aggregate(F.filter("cells", lambda c: c["pattern"].bitwiseAND(s) == 0), F.lit(0).cast("long"), lambda total, c: total + c[field])

        return F.transform(F.sequence(F.lit(0), F.lit(sets - 1)), of_set)

    parts = parts.select("part", "cells", *[kept(c).alias(f"kept_{c}") for c in ("n", "good", "toxic")])
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, start=1):
            steps.append(f"named_struct('filter_order', '{name}', 'step', {step}, 'before', {before}, 'bit', {1 << i})")
            before |= 1 << i
    each = parts.withColumn("s", F.explode(F.expr(f"array({', '.join(steps)})")))
    before, bit = F.col("s.before"), F.col("s.bit")
    upto = before.bitwiseOR(bit)

    def removed(field: str) -> Column:
        return F.get(f"kept_{field}", before) - F.get(f"kept_{field}", upto)

    def over_cells(good, value) -> Column:
        return F.aggregate(F.filter("cells", good), F.lit(0).cast("long"), lambda total, c: total + value(c))

    fails = F.get("kept_n", F.lit(0)) - F.get("kept_n", bit)
    orders = len(steps) // len(FILTERS)
    share = over_cells(lambda c: c["pattern"].bitwiseAND(bit) != 0, lambda c: c["n"] * (F.lit(orders) / F.bit_count(c["pattern"])).cast("long"))
    return each.select(
        "part",
        "s.filter_order",
        "s.step",
        F.get("kept_n", upto).alias("kept"),
        removed("n").alias("removed"),
        (fails - removed("n")).alias("redundant"),
        over_cells(lambda c: c["pattern"] == bit, lambda c: c["n"]).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        share.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How five filters interact on `docs` (doc_id, text, source): every order of them, step by step, for each source.

    A: under 50 words; B: under 65 distinct words in 100; C: over 5 capitals in 100 code points; D: holds a
    symbol; E: a smaller doc_id has the same text. NULL texts are empty, NULL sources the empty string; an empty
    table gives no rows. Other columns are not read.
    """
    return audit(saved(failed_patterns(docs, labels), "patterns"))
