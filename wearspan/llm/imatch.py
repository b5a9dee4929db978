"""I-Match fingerprints over randomised lexicon subsets, in Spark functions only.

Terms of a least inverse document frequency make the lexicon. A hash deals it into subsets, and thins them
by powers of two, so that texts with any number of lexicon terms keep a few per subset. A document's
terms in a subset, distinct and sorted, are hashed; these hashes are its fingerprint.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.frames import saved


@dataclass(frozen=True)
class MatchParams:
    """subsets of the lexicon; per_subset: terms that a document should keep in each; common: greatest share of
    documents that may hold a term of the lexicon. The band has no other end: terms seen once are in."""

    subsets: int = 16
    per_subset: float = 1.5
    common: float = 0.5


def term_codes(text: Column) -> Column:
    """Distinct 64-bit codes of the lower-case words of a text."""
    words = F.filter(F.split(F.lower(text), "[ \n\t.,;:!?]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def level_of(count: Column, p: MatchParams) -> Column:
    """How often a lexicon is halved for a document with that many of its terms."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(count, F.lit(1)) / (p.subsets * p.per_subset)))).cast("int")


def subset_bits(p: MatchParams) -> int:
    return int(math.log2(p.subsets))


def kept_terms(codes: Column, level: Column, p: MatchParams) -> Column:
    """The terms that survive the halvings of a level."""
    mask = (F.pow(F.lit(2.0), level) - 1).cast("long")
    return F.filter(codes, lambda c: F.shiftrightunsigned(c, subset_bits(p)).bitwiseAND(mask) == 0)


def fingerprint(terms: Column, level: Column, p: MatchParams) -> Column:
    """Hashes of the subsets at a level and at the next one, as `level:hash,hash,...;level:...`; a subset
    without terms is empty. Two levels let texts of similar length share one."""

    def at(lv: Column) -> Column:
        mask = (F.pow(F.lit(2.0), lv) - 1).cast("long")
        there = F.filter(terms, lambda c: F.shiftrightunsigned(c, subset_bits(p)).bitwiseAND(mask) == 0)

        def one(k: Column) -> Column:
            own = F.array_sort(F.filter(there, lambda c: c.bitwiseAND(F.lit(p.subsets - 1)) == k))
            return F.when(F.size(own) == 0, "").otherwise(F.substring(F.md5(F.array_join(F.transform(own, lambda c: c.cast("string")), " ")), 1, 12))

        return F.concat(lv.cast("string"), F.lit(":"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(p.subsets - 1)), one), ","))

    return F.concat(at(level), F.lit(";"), at(level + 1))


def likeness(x: Column, y: Column) -> Column:
    """Share of equal subsets among those that either fingerprint fills, at the shared level that has most
    equal ones; 0 without a shared level or any filled subset."""

    def at(a: Column, b: Column) -> Column:
        parts = F.zip_with(F.split(F.substring_index(a, ":", -1), ","), F.split(F.substring_index(b, ":", -1), ","), lambda s, t: F.when((s == "") & (t == ""), F.lit(None)).otherwise((s == t).cast("double")))
        share = F.aggregate(F.array_compact(parts), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("n")), lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")), lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]).otherwise(F.lit(0.0)))
        return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), share).otherwise(F.lit(0.0))

    xs, ys = F.split(x, ";"), F.split(y, ";")
    return F.greatest(*[at(xs[i], ys[j]) for i in (0, 1) for j in (0, 1)])


def next_keys(keys: DataFrame) -> DataFrame:
    """(doc_id, code, next_id, next_code, need): the next key in ascending order, the first after the last.

    Keys are sorted by range partitions; a partition's last key gets the first of the next partition
    from a table with one row per partition.
    """
    ordered = keys.repartitionByRange("doc_id", "code").sortWithinPartitions("doc_id", "code")
    ordered = saved(ordered.withColumn("part", F.spark_partition_id()), "order")
    key = F.struct("doc_id", "code")
    firsts = ordered.groupBy("part").agg(F.min(key).alias("first"))
    by_part = Window.orderBy("part")
    begin = firsts.agg(F.min(F.struct("part", "first"))["first"].alias("begin"))
    follows = firsts.select("part", F.lead("first").over(by_part).alias("after")).join(begin, F.lit(True)).select("part", F.coalesce("after", "begin").alias("after"))
    inside = F.lead(key).over(Window.partitionBy("part").orderBy("doc_id", "code"))
    linked = ordered.withColumn("next", inside).join(F.broadcast(follows), "part")
    following = F.coalesce("next", "after")
    return linked.select("doc_id", "code", "times", "n_chars", following["doc_id"].alias("next_id"), following["code"].alias("next_code"))


def fingerprints(docs: DataFrame, p: MatchParams = MatchParams()) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    The edited text of a document ends in the beginning of the next one (ascending doc_id, the first after
    the last); see `edited`. NULL text counts as empty. A NULL doc_id sorts first. Rows are told apart by doc_id and text: rows with one doc_id follow each
    other by a hash of their texts, and repeated rows get equal results and count once as neighbours. Equal texts
    have equal fingerprints.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    nameless = F.lit(-(2**63))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), nameless).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("code", F.xxhash64("text"))
    keys = rows.groupBy("doc_id", "code").agg(F.count("*").alias("times"), F.max(F.length("text")).alias("n_chars"))
    order = saved(next_keys(keys), "next")
    repeated = order.where("times > 1").limit(1).count()
    single = rows.dropDuplicates(["doc_id", "code"]) if repeated else rows

    # Each key also knows who needs its beginning: the key before it, a quarter of whose length is replaced.
    before = order.select(F.col("next_id").alias("doc_id"), F.col("next_code").alias("code"), F.col("doc_id").alias("to_id"), F.col("code").alias("to_code"), F.floor(F.col("n_chars") / 4).cast("int").alias("need"))
    begins = single.join(before, ["doc_id", "code"]).select(F.col("to_id").alias("doc_id"), F.col("to_code").alias("code"), "need", F.substring(F.col("text"), F.lit(1), F.col("need")).alias("begin"))
    joined = single.join(begins, ["doc_id", "code"])
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.col("need")), F.col("begin"))
    # The lexicon, from document counts of all terms over all rows: all terms but the common ones. Documents have n terms
    # on average, so at most n / p.common terms are common, and one array holds them.
    counts = saved(rows.select(F.explode(term_codes(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df")), "counts")
    n_rows = rows.count()
    common = counts.where(F.col("df") > max(1.0, p.common * n_rows)).agg(F.collect_list("term").alias("common"))
    # Only the words at the two cuts of an edited text may be in no document.
    whole = F.array_union(term_codes(F.col("text")), term_codes(F.regexp_replace("begin", r"[^ \n\t.,;:!?]+$", "")))
    both = joined.crossJoin(F.broadcast(common)).select("doc_id", "code", F.sha2(edited, 256).alias("edited_sha256"), *[F.array_except(t, "common").alias(c) for c, t in (("own", term_codes(F.col("text"))), ("new", term_codes(edited)), ("whole", whole))])
    both = both.withColumn("odd", F.array_except("new", "whole")).withColumn("own_level", level_of(F.size("own"), p)).withColumn("n_new", F.size("new"))
    both = both.select("doc_id", "code", "edited_sha256", "own_level", "n_new", "odd", kept_terms(F.col("own"), F.col("own_level"), p).alias("own"), kept_terms(F.col("new"), level_of(F.col("n_new") - F.size("odd"), p), p).alias("new"))
    both = saved(both, "terms")
    unknown = both.select("doc_id", "code", F.explode("odd").alias("term")).join(counts, "term", "left_anti").groupBy("doc_id", "code").agg(F.collect_list("term").alias("unknown"))
    marked = both.join(unknown, ["doc_id", "code"], "left").withColumn("unknown", F.coalesce("unknown", F.array().cast("array<long>")))
    prints = marked.select(
        "doc_id", "code", "edited_sha256",
        fingerprint(F.col("own"), F.col("own_level"), p).alias("fingerprint"),
        fingerprint(F.array_except("new", "unknown"), level_of(F.col("n_new") - F.size("unknown"), p), p).alias("edited_fingerprint"),
    )
    prints = saved(prints.join(order, ["doc_id", "code"]), "prints")
    following = prints.select(F.col("doc_id").alias("next_id"), F.col("code").alias("next_code"), F.col("fingerprint").alias("next_fingerprint"))
    out = prints.join(following, ["next_id", "next_code"])
    if repeated:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(
        F.nullif("doc_id", nameless).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
