"""Quality classifier by co-training of two views.

The text view sees form (repetition, signs, case, word length) and the presence of the
words that tell good from bad documents best; the metadata view sees source, language and
length. Both are logistic models with calibrated probabilities. In each round, each view
labels the documents of an unlabelled pool that it is sure of, and the other view learns
from these too. In the end the calibrated views are combined and every document is scored.

A document is good if its label says quality 1 and not toxic; of repeated labels the worst
counts. The models are fitted on samples of bounded size: at most ``LABELLED`` labelled
and ``POOL`` unlabelled documents, chosen by a hash of the id. Scoring covers all documents.

Null and empty texts are scored like any other. Without labels of both kinds there is
nothing to learn: every document gets 0.5 and stays.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import append_column, free_name, map_rows, staged

LABELLED = 20_000
POOL = 4_000
VOCABULARY = 256
LEAST_DOCUMENTS = 8
ROUNDS = 3
SURE = 0.98
HELD_OUT = 5  # one labelled document in five calibrates
KEEP = 0.5  # below, a document is more likely bad than good
EDGES = ".,;:!?\"'()[]{}*#$%&|"
SIGNS = "$%#*&!|"
SCORES = "struct<text_score double, meta_score double, score double, keep boolean>"


def words_of(text: str) -> tuple[list[str], set[str]]:
    """All words, and the distinct ones in lower case without signs at their ends."""
    words = text.split()
    return words, {w.strip(EDGES) for w in set(text.lower().split())}


def form(text: str, words: list[str], distinct: set[str]) -> list[float]:
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    signs = [text.count(c) / n for c in SIGNS]
    return [
        math.log1p(len(words)),
        len(distinct) / n,
        len(distinct) / n * math.log1p(len(words)),
        sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        size / n,
        (text.count(".") + text.count(",")) / n,
        1 - len(set(lines)) / len(lines),
        max(signs),
        *signs,
    ]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Logistic:
    """Ridge logistic regression by Newton steps, on standardised columns, with Platt's calibration."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    slope: float = 1.0
    offset: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 2.0) -> Logistic:
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        self.weights = _newton(self._design(x), y, ridge)
        return self

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._design(x) @ self.weights

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.slope, self.offset = _newton(np.column_stack([self.raw(x), np.ones(len(x))]), y, 1e-3)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.raw(x) + self.offset)


def _newton(design: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    weights = np.zeros(design.shape[1])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(12):
        p = sigmoid(design @ weights)
        gradient = design.T @ (y - p) - penalty * weights
        curve = (design * np.maximum(p * (1 - p), 1e-5)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return weights


@dataclass
class Classifier:
    vocabulary: dict[str, int]
    sources: dict[str, int]
    langs: dict[str, int]
    text: Logistic | None = None
    meta: Logistic | None = None
    joint: np.ndarray | None = None

    def text_row(self, text: str | None) -> np.ndarray:
        text = text or ""
        words, distinct = words_of(text)
        shape = form(text, words, distinct)
        row = np.zeros(len(shape) + len(self.vocabulary), np.float32)
        row[: len(shape)] = shape
        for word in self.vocabulary.keys() & distinct:
            row[len(shape) + self.vocabulary[word]] = 1
        return row

    def meta_row(self, source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
        row = np.zeros(1 + len(self.sources) + len(self.langs), np.float32)
        row[0] = math.log1p(max(0, n_chars or 0))
        if source in self.sources:
            row[1 + self.sources[source]] = 1
        if lang in self.langs:
            row[1 + len(self.sources) + self.langs[lang]] = 1
        return row

    def scores(self, texts: list, sources: list, langs: list, sizes: list) -> list[dict]:
        if self.joint is None:
            return [{"text_score": 0.5, "meta_score": 0.5, "score": 0.5, "keep": True}] * len(texts)
        if not texts:
            return []
        t = self.text.probability(np.array([self.text_row(x) for x in texts]))
        m = self.meta.probability(np.array([self.meta_row(*x) for x in zip(sources, langs, sizes)]))
        p = sigmoid(np.column_stack([logit(t), logit(m), np.ones(len(t))]) @ self.joint)
        names = ("text_score", "meta_score", "score", "keep")
        return [dict(zip(names, x)) for x in zip(t.tolist(), m.tolist(), p.tolist(), (p >= KEEP).tolist())]


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Bounded: one row per sampled id with its text, metadata and label (null in the pool)."""
    own = F.when((F.min("quality") >= 1) & (F.coalesce(F.max("toxic"), F.lit(0)) <= 0), 1).otherwise(0)
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(own.alias("good"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    spare = docs.filter("doc_id IS NOT NULL").select("doc_id").orderBy(F.xxhash64("doc_id", F.lit("pool")), "doc_id").limit(POOL)
    pool = spare.distinct().join(known.select("doc_id"), "doc_id", "left_anti").withColumn("good", F.lit(None).cast("int"))
    ids = picked.unionByName(pool)  # at most LABELLED + POOL rows
    row = F.min(F.struct("text", "source", "lang", "n_chars")).alias("row")
    found = docs.select("doc_id", "text", "source", "lang", "n_chars").join(F.broadcast(ids), "doc_id")
    return staged(found.groupBy("doc_id", "good").agg(row).select("doc_id", "good", "row.*"), "quality-sample")


def telling_words(rows: DataFrame) -> list[str]:
    """The words whose presence depends most on the label, by chi-square over the labelled sample."""

    def counted(batch: dict) -> dict:
        seen = {0: Counter(), 1: Counter()}
        for text, good in zip(batch["text"], batch["good"]):
            seen[good].update(words_of(text or "")[1])
        words = list(seen[0] | seen[1])
        return {"word": words, "bad": [seen[0][w] for w in words], "good": [seen[1][w] for w in words]}

    labelled = rows.filter("good IS NOT NULL").select("text", "good")
    sums = map_rows(labelled, counted, "word string, bad long, good long").groupBy("word")
    counts = sums.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(f"bad + good >= {LEAST_DOCUMENTS}")
    totals = labelled.agg(F.sum(1 - F.col("good")), F.sum("good")).first()
    share = F.lit(totals[0] / (totals[0] + totals[1]))
    expected = (F.col("bad") + F.col("good")) * share
    gap = (F.col("bad") - expected) * (F.col("bad") - expected) / (expected * (1 - share))
    return [r.word for r in counts.orderBy(gap.desc(), "word").limit(VOCABULARY).select("word").collect()]


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    rows = sample(docs, labels)
    kinds = {r.good for r in rows.select("good").distinct().collect()}
    if not {0, 1} <= kinds:
        return Classifier({}, {}, {})
    names = {c: [r[0] for r in rows.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(200).collect()] for c in ("source", "lang")}
    places = [{x: i for i, x in enumerate(v)} for v in (telling_words(rows), names["source"], names["lang"])]
    own = Classifier(*places)

    def seen(batch: dict) -> dict:
        meta = zip(batch["source"], batch["lang"], batch["n_chars"])
        text = [own.text_row(t).tobytes() for t in batch["text"]]
        return {"doc_id": batch["doc_id"], "good": batch["good"], "text": text, "meta": [own.meta_row(*m).tobytes() for m in meta]}

    views = map_rows(rows, seen, "doc_id long, good int, text binary, meta binary").orderBy("doc_id").collect()
    x = {v: np.array([np.frombuffer(r[v], np.float32) for r in views], np.float64) for v in ("text", "meta")}
    return co_train(own, x, np.array([-1 if r.good is None else r.good for r in views]))


def co_train(own: Classifier, x: dict[str, np.ndarray], good: np.ndarray) -> Classifier:
    """Rounds of exchange on the sample; ``good`` is -1 for the pool."""
    labelled = np.flatnonzero(good >= 0)
    held = labelled[::HELD_OUT]
    learn = np.setdiff1d(labelled, held)
    if len(set(good[held])) < 2 or len(set(good[learn])) < 2:
        held = learn = labelled
    targets = {v: good.copy() for v in x}
    models: dict[str, Logistic] = {}
    for step in range(ROUNDS + 1):
        for v in x:
            rows = np.concatenate([learn, np.flatnonzero((good < 0) & (targets[v] >= 0))])
            models[v] = Logistic().fit(x[v][rows], targets[v][rows]).calibrate(x[v][held], good[held])
        added = 0
        for v, other in (("text", "meta"), ("meta", "text")):
            p = models[v].probability(x[v])
            sure = (good < 0) & (targets[other] < 0) & (np.maximum(p, 1 - p) >= SURE)
            targets[other][sure] = p[sure] >= 0.5
            added += int(sure.sum())
        if not added:
            break
    own.text, own.meta = models["text"], models["meta"]
    both = np.column_stack([*(logit(models[v].probability(x[v][held])) for v in ("text", "meta")), np.ones(len(held))])
    own.joint = _newton(both, good[held], 1e-2)
    return own


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the struct ``quality``: text_score, meta_score, score and keep."""
    own = train(docs, labels)
    columns = ("text", "source", "lang", "n_chars")
    return append_column(docs, free_name(docs, "quality"), SCORES, own.scores, columns)


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id with its scores, for every document."""
    found = scored(docs.select("doc_id", "text", "source", "lang", "n_chars"), labels)
    return found.select("doc_id", "quality.*")


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those the classifier rejects."""
    found = scored(docs, labels)
    verdict = found.columns[-1]
    return found.filter(F.col(f"{verdict}.keep")).drop(verdict)
