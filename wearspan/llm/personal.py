"""Personal data: base patterns and bootstrapped contextual extraction, in Spark functions only.

The base patterns find emails, addresses, cards and phones. They are the seeds: the words in front of
them induce lexical patterns, patterns and the instances they introduce form a graph on which scores are
passed back and forth, and patterns of high confidence then discover identifiers that no base pattern knows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.frames import saved

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"
# Fixed values of the base scan. `\G` and the look-behind start a match where a run of its first class or the
# last match ends: the same matches as without them, found without trying every place inside a long run. Repeated
# groups are possessive, because Java's engine calls itself for each repetition of a greedy group; nothing follows them.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# An identifier: up to six capitals, then a digit and four or more digits and capitals, possibly in groups. A group
# ends at a word boundary; behind a blank it needs a digit, so that it takes no part of the next word.
IDENTIFIER = (
    r"(?<![A-Za-z0-9@.+-])[A-Z]{0,6}[-/]?[0-9]"
    r"(?:(?:[-/.](?=[A-Z0-9]++(?![a-z@]))| (?=[A-Z]*+[0-9][A-Z0-9]*+(?![a-z@])))?[A-Z0-9]){4,}+(?![A-Za-z0-9@])"
)
CUE = r"([\p{L}]+)([^\p{L}\p{N}]{1,4})$"
TWO_WORDS = r"([\p{L}]+[ ]+[\p{L}]+)[ ]$"


@dataclass(frozen=True)
class BootstrapParams:
    """epsilon: rounds of scoring end when no confidence rises by more; seeds: distinct seed values that a pattern
    needs; confidence of a pattern that may discover; look: characters in front of an instance that may hold its cue."""

    epsilon: float = 1e-4
    seeds: int = 3
    confidence: float = 0.7
    look: int = 48


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once: a lambda's own expressions are computed again for each of its elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def before(values: Column, zero: Column, plus: Callable[[Column, Column], Column], chunk: int = 512) -> Column:
    """For each element of an array, `plus` over the elements in front of it, from `zero` on.

    Arrays grow by copies, so the elements are taken in chunks: first a total for each chunk, then the places inside.
    """
    none = F.slice(F.array(zero), 1, 0)

    def walk(items: Column, start: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            return F.struct(plus(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(items, F.struct(start.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def of_parts(parts: Column) -> Column:
        firsts = walk(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, b: plus(a, b))), zero)
        return F.flatten(F.zip_with(parts, firsts, walk))

    def cut(items: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / chunk).cast("int"))
        return bound(F.transform(numbers, lambda c: F.slice(items, c * chunk + 1, F.lit(chunk))), of_parts)

    return bound(values, lambda items: F.when(F.size(items) > 0, cut(items)).otherwise(none))


def luhn(digits: Column) -> Column:
    """Whether a bound string of digits passes the check sum."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return bound(digits, lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    return F.length(digits).between(9, 15)


def places(text: Column, pattern: str, look: int) -> Column:
    """Array of (start, value, front) of the matches of a pattern, in code points: the text is split at the matches, and the
    lengths of pieces and matches add up to the starts. The front is the end of the last match and the piece behind it, at
    most `look` characters; no cue reaches over a whole match."""

    def located(both: Column) -> Column:
        # Both functions walk the same matches, so piece i lies in front of match i.
        found, pieces = both["found"], both["pieces"]
        last = F.concat(F.array(F.lit("")), F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))))
        fronts = F.zip_with(last, F.slice(pieces, 1, F.size(found)), lambda v, p: F.struct(F.length(p).alias("skip"), F.right(F.concat(v, p), F.lit(look)).alias("front")))
        return F.zip_with(found, fronts, lambda v, f: F.struct(f["skip"].alias("skip"), F.length(v).alias("length"), v.alias("value"), f["front"].alias("front")))

    def summed(items: Column) -> Column:
        starts = before(F.transform(items, lambda m: m["skip"] + m["length"]), F.lit(0), lambda a, b: a + b)
        return F.zip_with(items, starts, lambda m, at: F.struct((at + m["skip"]).alias("start"), m["value"].alias("value"), m["front"].alias("front")))

    both = F.struct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("found"), F.split(text, pattern, -1).alias("pieces"))
    none = F.array().cast("array<struct<start:int,value:string,front:string>>")
    return bound(both, lambda b: F.when(F.size(b["found"]) > 0, bound(located(b), summed)).otherwise(none))


def without_overlap(ids: Column, base: Column) -> Column:
    """The spans of `ids` that touch no span of `base`, by one walk over all spans in order of their starts: the largest end
    of a base span so far, and from the other side the least start to come."""

    def events(spans: Column, own: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s.alias("span")))

    def judged(items: Column) -> Column:
        ends = F.transform(items, lambda e: F.when(e["own"], -1).otherwise(e["end"]))
        starts = F.reverse(F.transform(items, lambda e: F.when(e["own"], 1 << 30).otherwise(e["start"])))
        left = bound(ends, lambda v: before(v, F.lit(-1), F.greatest))
        right = F.reverse(bound(starts, lambda v: before(v, F.lit(1 << 30), F.least)))
        clear = F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        told = F.zip_with(items, clear, lambda e, c: F.struct(e["span"].alias("span"), (e["own"] & (c["a"] <= e["start"]) & (c["b"] >= e["end"])).alias("good")))
        return F.transform(F.filter(told, lambda t: t["good"]), lambda t: t["span"])

    return F.when((F.size(ids) == 0) | (F.size(base) == 0), ids).otherwise(bound(F.array_sort(F.concat(events(ids, True), events(base, False))), judged))


def spotted(docs: DataFrame, p: BootstrapParams) -> DataFrame:
    """doc_id, row, and arrays of base spans and of identifier candidates with the text in front of them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # A character that every match must hold, so that most texts need no scan.
    worth = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "ip": F.col("digits"), "card": F.col("digits"), "id": F.col("digits")}
    slim = slim.withColumn("digits", F.col("text").rlike("[0-9]"))
    nothing = F.array().cast("array<struct<start:int,value:string,front:string>>")
    for kind, pattern in {**PATTERNS, "id": IDENTIFIER}.items():
        slim = slim.withColumn(f"at_{kind}", F.when(worth[kind], places(F.col("text"), pattern, p.look)).otherwise(nothing))

    def span(kind: str) -> Column:
        def one(m: Column) -> Column:
            start, value = m["start"], m["value"]
            return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.lit(kind).alias("kind"), value.alias("value"), m["front"].alias("front"))

        good = F.filter(F.col(f"at_{kind}"), lambda m: passes(kind, m["value"])) if kind in KINDS else F.col(f"at_{kind}")
        return F.transform(good, one)

    base = F.concat(*[span(k) for k in KINDS])
    slim = slim.select("doc_id", F.monotonically_increasing_id().alias("row"), base.alias("base"), span("id").alias("ids"))
    return slim.select("doc_id", "row", "base", without_overlap(F.col("ids"), F.col("base")).alias("ids"))


def cues(front: Column) -> Column:
    """Lexical patterns in front of an instance: its last word with a sign after it, or its last two words."""
    lower = F.lower(front)
    word, sign = F.regexp_extract(lower, CUE, 1), F.trim(F.regexp_extract(lower, CUE, 2))
    two = F.regexp_extract(lower, TWO_WORDS, 1)
    labelled = F.when((word != "") & sign.rlike("[:=#]"), F.concat(F.lit("1 "), word, F.lit(" "), F.substring(sign, 1, 1)))
    return F.array_compact(F.array(labelled, F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, " +", " ")))))


def confident_patterns(rows: DataFrame, p: BootstrapParams) -> DataFrame:
    """(pattern, kind, confidence) when the scores on the pattern-instance graph have settled.

    A seed counts 1 for its kind. A pattern's confidence in a kind is the sum of its instances' scores over
    their number plus one, so mixed and rare patterns stay low; an instance that is no seed gets the
    best confidence of its patterns, discounted. Patterns with `seeds` distinct seeds of one kind take part; an
    instance that a confident pattern has discovered is such a seed in the next round, with its own score.

    Confidences only rise, and what is left to rise shrinks by a tenth a round at least. Instances with one pattern feed
    only that one, so they are a number of the pattern, and its confidence is solved for them.
    """
    both = rows.select(F.explode(F.concat("base", "ids")).alias("s")).select("s.kind", F.upper(F.regexp_replace("s.value", "[ ./-]", "")).alias("value"), F.explode(cues(F.col("s.front"))).alias("pattern"))
    edges = saved(both.groupBy("pattern", "kind", "value").agg(F.count("*").alias("n")), "graph")
    open_edges = edges.where(F.col("kind") == "id").select("pattern", "value")
    several = saved(open_edges.groupBy("value").agg(F.count("*").alias("patterns")).where("patterns > 1").select("value"), "several")
    shared = saved(open_edges.join(several, "value", "left_semi").select("pattern", "value"), "shared")
    of_pattern = edges.groupBy("pattern").agg(F.count("*").alias("instances"), F.count_if(F.col("kind") == "id").alias("ids"))
    of_pattern = of_pattern.join(shared.groupBy("pattern").agg(F.count("*").alias("shared")), "pattern", "left")
    # Of every instance, its own ids give back nine tenths of the pattern's confidence.
    of_pattern = saved(of_pattern.select("pattern", (F.col("instances") + 1 - 0.9 * (F.col("ids") - F.coalesce("shared", F.lit(0)))).alias("weight")), "weights")
    seeds = saved(edges.where(F.col("kind") != "id").groupBy("pattern", "kind").agg(F.count("*").alias("seeds")), "seeds")
    patterns = saved(seeds.where(F.col("seeds") >= p.seeds).join(of_pattern, "pattern").select("pattern", "kind", (F.col("seeds") / F.col("weight")).alias("confidence")), "patterns")
    links = shared.limit(1).count()
    while links:
        reached = shared.join(patterns, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("best"))
        told = shared.join(reached, "value").groupBy("pattern", "kind").agg(F.sum(0.9 * F.col("best")).alias("more"), F.count_if(F.col("best") >= p.confidence).alias("found"))
        told = told.join(seeds, ["pattern", "kind"], "full").select("pattern", "kind", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("seeds", "found", "more")])
        scored = told.where(F.col("seeds") + F.col("found") >= p.seeds).join(of_pattern, "pattern")
        scored = scored.join(patterns.withColumnRenamed("confidence", "last"), ["pattern", "kind"], "left").withColumn("last", F.coalesce("last", F.lit(0.0)))
        scored = saved(scored.select("pattern", "kind", "last", F.greatest("last", (F.col("seeds") + F.col("more")) / F.col("weight")).alias("confidence")), "patterns")
        patterns = scored.drop("last")
        # A pattern that has just become confident may let new ones take part.
        risen = (F.col("confidence") - F.col("last") > p.epsilon) | ((F.col("confidence") >= p.confidence) & (F.col("last") < p.confidence))
        if not scored.where(risen).limit(1).count():
            break
    return patterns.where(F.col("confidence") >= p.confidence)


def span_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = {k: i for i, k in enumerate((*KINDS, FOUND))}

    def key(s: Column) -> Column:
        place = F.lit(len(rank))
        for k, i in rank.items():
            place = F.when(s["kind"] == k, F.lit(i)).otherwise(place)
        return F.struct(s["start"].alias("start"), place.alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))

    return F.array_sort(F.transform(spans, key))


def find_personal(docs: DataFrame, p: BootstrapParams = BootstrapParams()) -> DataFrame:
    """doc_id, base and found of every row of `docs` (doc_id, text): arrays of (start, rank, end, kind).

    Spans count code points, ends are exclusive. NULL and empty texts have none; repeated rows each come back.
    What is discovered depends on the whole table: the patterns are learned from all rows.
    """
    rows = saved(spotted(docs, p), "spotted")
    patterns = confident_patterns(rows, p)
    open_ids = rows.where(F.size("ids") > 0).select("row", F.explode("ids").alias("s"))
    hits = open_ids.select("row", "s.start", "s.end", F.explode(cues(F.col("s.front"))).alias("pattern")).join(patterns.select("pattern").distinct(), "pattern", "left_semi")
    spans = hits.select("row", "start", "end").distinct().groupBy("row").agg(F.collect_list(F.struct("start", "end", F.lit(FOUND).alias("kind"))).alias("found"))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind")))
    return rows.select("doc_id", "row", plain.alias("base")).join(spans, "row", "left").select("doc_id", in_order(F.col("base")).alias("base"), in_order(F.coalesce("found", none)).alias("found"))


def personal_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and all spans as text."""

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = span_text(F.array_sort(F.concat("base", "found")))
    return find_personal(docs).select("doc_id", *[of_kind(k) for k in KINDS], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), every.alias("spans"))
