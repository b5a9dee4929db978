"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of words and tags. Words score positive and tags negative, with weights learned from pages
whose authors marked the main content; one linear scan finds the contiguous region of the highest sum.
Blocks of the region make the text. Elements that are never content neither earn nor cost, and are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.frames import chunks, ship

LEXEME = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^<>"'])*+)>
    |<[/!?]?[a-zA-Z][^>]*>?
    |<[!?][^>]*>""",
    re.S | re.I | re.X,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br-block caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# Elements that are never part of an article, and words of class, id or role that say the same.
NEVER = frozenset("aside button dialog fieldset footer form head header input label menu nav select title".split())
NEVER_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments contentinfo cookie cookies disqus footer header login menu nav "
    "navbar navigation newsletter notice notices pagination popup promo promoted related respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split()
)
CLOSES_P = BLOCKS - {"br-block"}
INLINE_GAPS = frozenset(("br", "wbr"))


@dataclass(frozen=True)
class Token:
    """A word run or tag: kind (of its weight), count of words, text, block number, and its standing."""

    kind: str
    words: int
    text: str
    block: int
    never: bool
    marked: bool


def never_content(tag: str, rest: str) -> bool:
    """Whether a tag or one whole name of its class, id or role says so. A listed word inside of a longer name, as in
    `no-sidebar`, decides nothing; see `named`."""
    if tag in NEVER:
        return True
    if tag in ("html", "body", "article", "main") or not rest:
        return False
    return any(w in NEVER_NAMES for m in NAMES.finditer(rest) for w in (m[1] or m[2] or m[3] or "").lower().split())


def named(rest: str) -> bool:
    """Whether a listed word is part of a longer name: a feature of the words inside, with a learned weight."""
    found = (m[1] or m[2] or m[3] or "" for m in NAMES.finditer(rest))
    return any(w in NEVER_NAMES for f in found for name in f.lower().split() if name not in NEVER_NAMES for w in re.split(r"[^a-z]+", name))


@dataclass(frozen=True)
class Open:
    """An open element, with what its words need to know of the elements around it."""

    tag: str
    never: bool
    marked: bool
    around: str
    named: bool


def tokens(page: str, markers: frozenset[str] = frozenset(("article", "main"))) -> list[Token]:
    """Words and tags of a page in order. Unclosed and misnested elements are closed where HTML implies it."""
    out: list[Token] = []
    stack = [Open("", False, False, "", False)]
    count: Counter[str] = Counter()  # open elements by tag, so that nothing looks through the stack
    block, at = 0, 0

    def words(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        n = len(text.split())
        top = stack[-1]
        if n:
            kind = f"w:{top.around}{'+a' if count['a'] else ''}{'+n' if top.named else ''}"
            out.append(Token(kind, n, text, block, top.never, top.marked))
        elif text:
            out.append(Token("", 0, " ", block, top.never, top.marked))

    def close(tag: str) -> None:
        while count[tag]:
            closed = stack.pop().tag
            count[closed] -= 1
            if closed == tag:
                return

    for m in LEXEME.finditer(page):
        if m.start() > at:
            words(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            block += 1
        never, marked = stack[-1].never, stack[-1].marked
        if m["end"]:
            close(tag)
        else:
            if tag in CLOSES_P:
                close("p")
            if tag in ("li", "option", "tr", "td", "th", "dt", "dd") and stack[-1].tag == tag:
                close(tag)
            top = stack[-1]
            marked = top.marked
            never = top.never or never_content(tag, m["rest"])
            if tag not in VOID and not m["rest"].endswith("/"):
                stack.append(Open(tag, never, marked or tag in markers, tag if tag in BLOCKS else top.around, top.named or (bool(m["rest"]) and named(m["rest"]))))
                count[tag] += 1
        if tag in INLINE_GAPS:
            out.append(Token(f"t:{tag}", 0, " ", block, never, marked))
        else:
            out.append(Token(f"t:{tag}", 0, "", block, never, marked))
    if at < len(page):
        words(page[at:])
    return out


@dataclass(frozen=True)
class PageWeights:
    """Score of each kind of token, and of unknown kinds of word and tag."""

    known: dict[str, float]
    word: float = 0.5
    tag: float = -1.0

    def of(self, kind: str) -> float:
        """The learned score; words under a listed part of a name count as words without it until something is learned."""
        if not kind:
            return 0.0
        if kind in self.known:
            return self.known[kind]
        if kind.endswith("+n"):
            return self.of(kind[:-2])
        return self.word if kind[0] == "w" else self.tag


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and one past the last token of the contiguous region with the highest sum; the first of
    equals, (0, 0) if no token is positive."""
    best, first, last = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, first, last = total, start, i + 1
    return first, last


def main_text(page: str, weights: PageWeights) -> str:
    """The text of the best region, widened to whole blocks; blocks joined by a blank line."""
    row = tokens(page)
    first, last = best_region([0.0 if t.never else weights.of(t.kind) * max(1, t.words) for t in row])
    if first == last:
        return ""
    low, high = row[first].block, row[last - 1].block
    blocks: dict[int, list[str]] = {}
    for t in row:
        if low <= t.block <= high and not t.never and t.text:
            blocks.setdefault(t.block, []).append(t.text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(b for b in joined if b)


def fit_weights(pages: DataFrame, sample_pages: int = 20_000, kinds: int = 1000, column: str = "html") -> PageWeights:
    """Log odds of each kind of token inside and outside of marked content.

    Labelled pages are those with an article or main element; at most about `sample_pages` of them, chosen
    by a hash of the page, are counted, and the driver receives at most `kinds` counts. Without any such page
    the defaults hold. Tags and link words of elements that are never content count as outside. Their other
    words are not scored and not counted: long comments in paragraphs would make those of articles negative.
    """
    ship(pages.sparkSession)
    marked = pages.select(F.col(column).cast("string").alias("html")).where("html RLIKE '(?i)<(article|main)[ >]'")
    n = marked.count()
    share = 1_000_000 if n <= sample_pages else int(1_000_000 * sample_pages / n)
    sample = marked.where(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter[str] = Counter()
        outside: Counter[str] = Counter()
        for batch in batches:
            for _, texts in chunks(batch, "html"):
                for text in texts:
                    for t in tokens(text):
                        if not t.never or t.kind[:1] == "t" or t.kind.endswith("+a"):
                            (inside if t.marked and not t.never else outside)[t.kind] += max(1, t.words)
        names = [k for k in {*inside, *outside} if k]
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array([inside[k] for k in names], pa.int64()), pa.array([outside[k] for k in names], pa.int64())], ["kind", "inside", "outside"]
        )

    counted = sample.mapInArrow(count, "kind string, inside long, outside long").groupBy("kind").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    rows = counted.orderBy(F.desc(F.col("i") + F.col("o")), "kind").limit(kinds).collect()
    if not rows:
        return PageWeights({})
    total_in, total_out = sum(r["i"] for r in rows) or 1, sum(r["o"] for r in rows) or 1
    known = {}
    for r in rows:
        odds = math.log((r["i"] + 0.5) / (r["o"] + 0.5)) - math.log(total_in / total_out) * 0.5
        # Tags that stand inside and outside alike keep the general penalty.
        known[r["kind"]] = odds if r["kind"][0] == "w" else min(odds, 0.0) + PageWeights.tag * 0.1
    return PageWeights(known)


def extract(pages: DataFrame, weights: PageWeights) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`. NULL or empty html, and pages without any positive
    token, give an empty text. Repeated rows stay."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "html"):
                found = [main_text(t, weights) if t else "" for t in texts]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(f) for f in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def page_texts(pages: DataFrame) -> DataFrame:
    """Fit the weights on the marked pages of the table, then extract every page."""
    return extract(pages, fit_weights(pages))
