"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts common subsequences of three characters, gaps allowed and discounted, so
`id-iot`, `i.d.i.o.t` and `iddiot` stay close to `idiot`. Characters that are neither letters nor digits only
widen gaps. Landmark words are chosen from labelled sentences, the Nyström map turns kernel values into
a vector, and a linear machine with squared hinge loss separates the words of toxic and clean sentences.
A document is judged by the machine's margins over all its words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.frames import chunks, fresh, saved, ship

SENTENCE = re.compile(r"[.!?\n]+")
SPELLED = re.compile(r"(?<!\S)(?:\w[\s.,*_-]+){2,}\w(?!\w)")
EDGES = ".,;:!?\"'()[]{}$&%#*|-_=+/\\<>~`^@"


@dataclass(frozen=True)
class KernelParams:
    """gap: decay per character of width; width: longest stretch of a subsequence; codes: character
    classes; longest: characters of a word (longer words are compared by overlapping stretches)."""

    gap: float = 0.45
    width: int = 6
    codes: int = 48
    longest: int = 24
    power: int = 2


@dataclass
class ToxicityModel:
    """Everything needed to score: at most `landmarks` words and a few numbers."""

    kernel: KernelParams
    landmarks: list[str]
    weights: np.ndarray  # of the kernel values with each landmark: Nyström map times machine
    bias: float
    head: np.ndarray = field(default_factory=lambda: np.zeros(6))  # of the document features


def stretches(word: str, longest: int) -> list[str]:
    if len(word) <= longest:
        return [word]
    return [word[i : i + longest] for i in range(0, len(word) - longest // 2, longest // 2)]


def spell_codes(words: list[str], p: KernelParams) -> np.ndarray:
    """Character classes of `^word$`, 0 past the end, -1 for characters that only widen gaps."""
    out = np.zeros((len(words), p.longest + 2), np.int64)
    for r, word in enumerate(words):
        row = [1, *(3 + ord(c) % (p.codes - 3) if c.isalnum() else -1 for c in word), 2]
        out[r, : len(row)] = row
    return out


def subsequences(words: list[str], p: KernelParams) -> tuple[np.ndarray, np.ndarray]:
    """Feature number and discount of every subsequence of three characters, padded with weight 0."""
    codes = spell_codes(words, p)
    longest = int((codes != 0).sum(1).max(initial=3))
    codes = np.pad(codes[:, :longest], ((0, 0), (0, p.width)))
    ids, weights = [], []
    for j in range(1, p.width - 1):
        for k in range(j + 1, p.width):
            a, b, c = codes[:, :longest], codes[:, j : j + longest], codes[:, k : k + longest]
            good = (a > 0) & (b > 0) & (c > 0)
            ids.append(np.where(good, (a * p.codes + b) * p.codes + c, 0))
            weights.append(np.where(good, p.gap ** (k + 1), 0.0).astype(np.float32))
    return np.concatenate(ids, 1), np.concatenate(weights, 1)


def gathered(ids: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal subsequences of a word added up; the sum stands at the last of them."""
    order = np.argsort(ids, axis=1)
    ids = np.take_along_axis(ids, order, 1)
    sums = np.cumsum(np.take_along_axis(weights, order, 1), axis=1, dtype=np.float64)
    last = np.ones(ids.shape, bool)
    last[:, :-1] = ids[:, 1:] != ids[:, :-1]
    column = np.where(last, np.arange(ids.shape[1]), -1)
    before = np.maximum.accumulate(np.pad(column, ((0, 0), (1, 0)), constant_values=-1), axis=1)[:, :-1]
    base = np.where(before >= 0, np.take_along_axis(sums, np.maximum(before, 0), 1), 0.0)
    return ids, np.where(last & (ids > 0), sums - base, 0.0).astype(np.float32)


class StringKernel:
    """Normalised kernel of words with a fixed list of landmark words."""

    def __init__(self, landmarks: list[str], p: KernelParams) -> None:
        self.p = p
        ids, weights = gathered(*subsequences(landmarks, p))
        norms = np.sqrt((weights.astype(np.float64) ** 2).sum(1))
        used, place = np.unique(ids[weights > 0], return_inverse=True)
        self.row = np.zeros(p.codes**3, np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        self.table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
        owner = np.nonzero(weights > 0)[0]
        self.table[place + 1, owner] = weights[weights > 0] / norms[owner]

    def values(self, words: list[str], block: int = 1000) -> np.ndarray:
        """Kernel to the chosen power, one row per word; 0 for words without three letters or digits."""
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        for at in range(0, len(words), block):
            ids, weights = gathered(*subsequences(words[at : at + block], self.p))
            norms = np.sqrt((weights.astype(np.float64) ** 2).sum(1))
            rows = self.row[ids]
            word, column = np.nonzero((rows > 0) & (weights > 0))
            if len(word):
                hits = self.table[rows[word, column]] * weights[word, column, None]
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                out[at + word[starts]] = np.add.reduceat(hits, starts, axis=0)
            out[at : at + block] /= np.maximum(norms, 1e-12)[:, None]
        return out**self.p.power


def sentence_words(text: str) -> list[str]:
    """Lower-case words of a text with edge punctuation removed, and letters spelled out one by one joined."""
    lower = text.lower()
    words = [w.strip(EDGES) for w in lower.split()]
    if " " in lower:
        words += ["".join(c for c in m[0] if c.isalnum()) for m in SPELLED.finditer(lower)]
    return words


class WordScorer:
    """Margins of words under a model, cached up to `cache_words` entries."""

    def __init__(self, model: ToxicityModel, cache_words: int = 500_000) -> None:
        self.model = model
        self.kernel = StringKernel(model.landmarks, model.kernel)
        self.cache: dict[str, float] = {}
        self.cache_words = cache_words

    def margins(self, words: list[str]) -> np.ndarray:
        longest = self.model.kernel.longest
        split = [stretches(w, longest) for w in words]
        flat = [s for parts in split for s in parts]
        margins = self.kernel.values(flat) @ self.model.weights + self.model.bias
        if len(flat) == len(words):
            return margins
        starts = np.cumsum([0] + [len(s) for s in split[:-1]])
        return np.maximum.reduceat(margins, starts)

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Features of documents: 1, largest margin, positive mass, positive count and rate, length."""
        spelled = [sentence_words(t) if t else [] for t in texts]
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        new = [w for w in {w for words in spelled for w in words} if w not in self.cache]
        if new:
            self.cache.update(zip(new, self.margins(new).tolist(), strict=True))
        get = self.cache.__getitem__
        out = np.zeros((len(texts), 6))
        for i, words in enumerate(spelled):
            out[i, 0] = 1
            if words:
                m = np.fromiter(map(get, words), np.float64, len(words))
                above = m[m > 0]
                out[i, 1:] = max(m.max(), -2.0), np.log1p(above.sum()), np.log1p(len(above)), min(1.0, 10 * len(above) / (20 + len(words))), np.log1p(len(words)) / 8
        return out


_scorers: dict[int, WordScorer] = {}


def worker_scorer(model: ToxicityModel) -> WordScorer:
    key = zlib.crc32(repr(model.landmarks).encode() + model.weights.tobytes() + model.head.tobytes())
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = WordScorer(model)
    return _scorers[key]


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 40) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        xa, wa = x[on], weight[on]
        gradient = penalty * w - xa.T @ (wa * y[on] * slack[on])
        step = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (q - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def pick_landmarks(words: list[str], score: np.ndarray, wanted: int, p: KernelParams, near: float = 0.6) -> list[str]:
    """Best-scored words that are not close to one chosen before."""
    order = [words[i] for i in np.argsort(-score, kind="stable")[: 12 * wanted] if 2 < len(words[i]) <= p.longest]
    if not order:
        return []
    close = StringKernel(order, p).values(order)
    chosen: list[int] = []
    for i in range(len(order)):
        if len(chosen) < wanted and all(close[i, j] < near for j in chosen):
            chosen.append(i)
    return [order[i] for i in chosen]


def fit(labelled: DataFrame, sample_rows: int = 20_000, landmarks: int = 64, top_words: int = 60_000, kernel: KernelParams = KernelParams()) -> ToxicityModel | None:
    """Fit on rows (doc_id, text, toxic) of 0/1 labels; other labels are ignored.

    At most about `sample_rows` rows, chosen by a hash of doc_id, are used: half of them teach landmarks and
    machine, the other half the document head. The driver receives at most `top_words` word counts and
    six numbers a row. None if either label is missing.
    """
    ship(labelled.sparkSession)
    rows = labelled.where(F.col("toxic").isin(0, 1) & F.col("text").isNotNull())
    parts = 1_000_000
    spot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(parts))
    n = rows.count()
    share = 1.0 if n <= sample_rows else sample_rows / n
    rows = saved(rows.where(spot < int(share * parts)).select("text", F.col("toxic").cast("int").alias("toxic"), (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(2)) == 0).alias("teach")), "labelled")
    totals = {(r["teach"], r["toxic"]): r["count"] for r in rows.groupBy("teach", "toxic").count().collect()}
    if any(not totals.get((t, y)) for t in (True, False) for y in (0, 1)):
        return None

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                words, toxic = [], []
                for text, y in zip(texts, part.column("toxic").to_pylist(), strict=True):
                    own = {w for s in SENTENCE.split(text) for w in sentence_words(s) if len(w) > 2}
                    words += own
                    toxic += [y] * len(own)
                yield pa.record_batch([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])

    counts = rows.where("teach").select("text", "toxic").mapInArrow(seen, "word string, toxic int").groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("n1"))
    table = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(top_words).toPandas()
    words, n1 = table["word"].tolist(), table["n1"].to_numpy(float)
    n0 = table["n"].to_numpy(float) - n1
    d1, d0 = totals[True, 1], totals[True, 0]
    expected = (n0 + n1) * d1 / (d0 + d1)
    excess = (n1 - expected) / np.sqrt(expected + 0.5)
    chosen = pick_landmarks(words, excess, landmarks // 2, kernel)
    chosen += [w for w in pick_landmarks(words, n0, landmarks // 2, kernel) if w not in chosen]
    if not chosen:
        return None
    k = StringKernel(chosen, kernel)
    gram = k.values(chosen).astype(float)
    root, vectors = np.linalg.eigh((gram + gram.T) / 2)
    nystroem = vectors @ np.diag(1 / np.sqrt(np.maximum(root, 1e-3))) @ vectors.T
    short = [i for i, w in enumerate(words) if len(w) <= kernel.longest]
    x = np.hstack([k.values([words[i] for i in short]) @ nystroem, np.ones((len(short), 1))])
    lift = 0.4 * d0 / d1  # a word is toxic from 2.5 times the base rate on
    y = np.r_[np.ones(len(short)), -np.ones(len(short))]
    w = squared_hinge(np.vstack([x, x]), y, np.r_[n1[short] * lift, n0[short]], ridge=1.0 + 0.002 * n0.sum() / len(chosen))
    model = ToxicityModel(kernel, chosen, (nystroem @ w[:-1]).astype(np.float32), float(w[-1]))

    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(shared.value)
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                yield pa.record_batch([pa.array(scorer.documents(texts).tolist(), pa.list_(pa.float64())), part.column("toxic")], ["x", "toxic"])

    heads = rows.where("NOT teach").select("text", "toxic").mapInArrow(described, "x array<double>, toxic int").toPandas()
    model.head = logistic(np.array(heads["x"].tolist()), heads["toxic"].to_numpy(float))
    return model


def score(df: DataFrame, model: ToxicityModel | None, column: str = "text", to: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all) columns of `df` and a score from 0 to 1 of the whole text in `column`.

    NULL and empty texts have no words and get the score of such a document; without a model every
    score is 0. Equal texts get equal scores; repeated rows stay.
    """
    to = fresh(df, to)
    keep = df.columns if keep is None else keep
    if model is None:
        return df.select(*keep, F.lit(0.0).alias(to))
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(shared.value)
        for batch in batches:
            for part, texts in chunks(batch, column):
                p = 1 / (1 + np.exp(-np.clip(scorer.documents(texts) @ scorer.model.head, -30, 30)))
                yield pa.record_batch([*(part.column(c) for c in keep), pa.array(p)], [*keep, to])

    schema = df.select(*keep).schema.add(to, "double")
    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of every labelled document."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(labels.where(F.col("toxic").isNotNull()).select("doc_id", "toxic").distinct(), "doc_id")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; held-out rows teach nothing."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    teaching = labels.where(~held_out(F.col("doc_id")))
    model = fit(labelled_texts(slim, teaching))
    scored = score(slim, model, to="score", keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
