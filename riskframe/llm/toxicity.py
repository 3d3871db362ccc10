"""Toxicity by maximum-scoring segments.

Training counts, per token feature, the toxic and the clean labelled documents
that hold it. Features are whole words and their first five and seven letters
(in scripts without blanks, single characters), hashed to a fixed number of
slots, so that the table that tasks receive has one size whatever the corpus
is. A feature's log-odds come from its two counts under a Dirichlet prior of
``PRIOR`` documents at the base rate, moved ``CAUTION`` standard deviations
towards zero (and not beyond). A token has the largest log-odds of its
features, less ``GAP``, the cost of taking a token into a passage: every token
has its own score, positive or negative, down to the clearly clean ones.

A document is scanned once, left to right (Ruzzo and Tompa): the scan keeps
the list of disjoint maximal segments and is linear in the number of tokens.
Segment scores follow an extreme-value law; its rate solves
``E[exp(rate * score)] = 1`` over clean tokens, its location comes from the
clean documents' best segments. Each passage adds ``-ln`` of its expected
number in clean text of that length, if below one; where none is, the best
passage's (negative) value stands alone. This evidence becomes a probability by
isotonic regression. Rate, location and regression are fitted out of fold:
labelled documents are scanned with log-odds counted without their own fold
(``FOLDS`` folds by text hash, so that equal texts share one).

``PRIOR``, ``CAUTION`` and ``GAP`` were chosen by the out-of-fold log loss of
the labelled documents outside the held-out third.

Defined cases: null and empty texts have no token and no passage and get the
probability of the lowest bin; texts of any length are scanned whole; null
labels are no labels; repeated label rows count once (the larger label);
repeated document rows are scored each; with no labelled rows of both kinds
every score is 0; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import broadcast_if_small, portions, stored

SLOTS = 1 << 20
PRIOR = 0.25
CAUTION = 0.5
GAP = 2.0
FOLDS = 4
#: Runs of letters; a character of a script that sets no blanks between words is a token of its own.
SOLID = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{SOLID}]|[^\W\d_{SOLID}]+")
LOWEST = -50.0  # evidence of a text without tokens
BIN = 0.5
BINS = 400
EULER = 0.5772156649015329


def slots_of(word: str) -> list[int]:
    """Slots of a word and of its beginnings."""
    return [zlib.crc32(b"w" + word.encode()) % SLOTS] + [zlib.crc32(b"p" + word[:k].encode()) % SLOTS for k in (5, 7) if len(word) >= k]


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-odds of a document with the feature against the base rate, from document counts per slot."""
    base = n_toxic / (n_toxic + n_clean)
    a, b = toxic + PRIOR * base, clean + PRIOR * (1 - base)
    value = np.log(a / b) - math.log(base / (1 - base))
    away = np.maximum(np.abs(value) - CAUTION * np.sqrt(1 / a + 1 / b), 0.0)
    return (np.sign(value) * away).astype(np.float32)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end exclusive, score) of token scores.

    Every candidate keeps the running total before and after it and a link to
    the nearest earlier candidate whose left total is smaller; merges pop
    candidates, so each token is handled a constant number of times.
    """
    totals = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, link
    hot = np.flatnonzero(np.asarray(scores) > 0)
    for at, before, after in zip(hot.tolist(), totals[hot].tolist(), totals[hot + 1].tolist(), strict=True):
        start, end = at, at + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append((start, end, before, after, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


class Scorer:
    """Token scores by word, with the words met before kept (bounded)."""

    def __init__(self, weights: np.ndarray, max_kept: int = 400_000) -> None:
        self.weights, self.max_kept, self.known = weights, max_kept, {}

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]], np.ndarray]:
        words = WORD.findall((text or "").lower())
        known = self.known
        if len(known) > self.max_kept:
            known.clear()
        for w in set(words).difference(known):
            known[w] = max(float(self.weights[k]) for k in slots_of(w)) - GAP
        scores = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
        return len(words), maximal_segments(scores), scores


@dataclass
class ToxicityModel:
    weights: np.ndarray
    rate: float
    log_k: float
    levels: np.ndarray  # probability at each bin of evidence

    def evidence(self, n: int, segments) -> float:
        if not n:
            return LOWEST
        noise = self.log_k + math.log(n)
        each = [self.rate * s - noise for _, _, s in segments]
        return sum(e for e in each if e > 0) or max(each, default=-noise)

    def probability(self, evidence: float) -> float:
        """Level between the middles of the bins, with a thousandth that keeps the order of equal levels."""
        if not self.levels.any():
            return 0.0
        at = min(max((evidence - LOWEST) / BIN - 0.5, 0.0), BINS - 1.0)
        low = int(at)
        high = min(low + 1, BINS - 1)
        level = float(self.levels[low] + (self.levels[high] - self.levels[low]) * (at - low))
        return 0.999 * level + 0.001 / (1 + math.exp(-min(max(evidence, LOWEST), 300.0) / 20))


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted non-decreasing fit by pooling neighbours."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            total = w1 + w2
            blocks.append([(v1 * w1 + v2 * w2) / total if total else (v1 + v2) / 2, total, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fold: int = 1) -> DataFrame:
    """Texts with a label, without the held-out fold (crc32 of the id modulo 3)."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != fold)
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(broadcast_if_small(known), "id").select("text", "label", F.pmod(F.coalesce(F.xxhash64("text"), F.lit(0)), F.lit(FOLDS)).cast("int").alias("fold"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> ToxicityModel:
    """Fit on all labelled documents outside the held-out fold."""
    train = training_texts(docs, labels, id_col, text_col, label_col)
    sc = docs.sparkSession.sparkContext

    kinds = 2 * FOLDS  # a row of counts per fold and label

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((kinds, SLOTS + 1), np.int32)
        known: dict[str, list[int]] = {}
        for batch in portions(batches):
            if len(known) > 200_000:
                known.clear()
            for text, label, fold in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                row = seen[2 * fold + (1 if label else 0)]
                row[SLOTS] += 1
                words = set(WORD.findall((text or "").lower()))
                for w in words.difference(known):
                    known[w] = slots_of(w)
                if words:
                    row[list(set().union(*map(known.__getitem__, words)))] += 1
        at = np.flatnonzero(seen.any(axis=0))
        for k in range(0, len(at), 100_000):
            some = at[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(row[some].astype(np.int64)) for row in seen)], names=["slot", *names])

    names = [f"n{k}" for k in range(kinds)]
    # at most SLOTS + 1 rows, whatever the corpus is
    counts = (train.mapInArrow(count, "slot bigint, " + ", ".join(f"{c} bigint" for c in names)).groupBy("slot")
              .agg(*(F.sum(c).alias(c) for c in names)).toArrow())
    seen = np.zeros((kinds, SLOTS + 1))
    at = counts.column("slot").to_numpy()
    for k, c in enumerate(names):
        seen[k, at] = counts.column(c).to_numpy()
    toxic, clean = seen[1::2].sum(axis=0), seen[0::2].sum(axis=0)
    n_toxic, n_clean = toxic[SLOTS], clean[SLOTS]
    if not n_toxic or not n_clean:
        return ToxicityModel(np.zeros(SLOTS, np.float32), 1.0, 0.0, np.zeros(BINS))
    weights = log_odds(toxic[:SLOTS], clean[:SLOTS], n_toxic, n_clean)
    others = []
    for k in range(FOLDS):
        t, c = toxic - seen[2 * k + 1], clean - seen[2 * k]
        # a fold that has all documents of one kind leaves nothing to count: its documents get the whole counts
        others.append(log_odds(t[:SLOTS], c[:SLOTS], t[SLOTS], c[SLOTS]) if t[SLOTS] and c[SLOTS] else weights)
    held = sc.broadcast(others)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(w, 100_000) for w in held.value]
        for batch in portions(batches):
            n, label, segments, tokens = [], [], [], []
            for text, y, fold in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                size, found, scores = scorers[fold].passages(text)
                n.append(size)
                label.append(int(bool(y)))
                segments.append([s for _, _, s in found])
                value, times = np.unique(np.round(scores, 1), return_counts=True) if not y else ((), ())
                tokens.append([{"s": float(s), "n": int(k)} for s, k in zip(value, times, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(n, pa.int64()), pa.array(label, pa.int32()), pa.array(segments, pa.list_(pa.float64())),
                 pa.array(tokens, pa.list_(pa.struct([("s", pa.float64()), ("n", pa.int64())])))], names=["n", "label", "segments", "tokens"])

    scanned = stored(train.mapInArrow(scan, "n bigint, label int, segments array<double>, tokens array<struct<s:double,n:bigint>>"))
    clean = scanned.where("label = 0")
    rate = _rate({r["s"]: r["n"] for r in clean.select(F.inline("tokens")).groupBy("s").agg(F.sum("n").alias("n")).collect()})
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    log_k = clean.where("n > 0").agg(F.avg(best * rate - F.log("n"))).first()[0]
    log_k = (log_k if log_k is not None else 0.0) + EULER
    noise = F.lit(log_k) + F.log(F.greatest("n", F.lit(1)))
    each = F.transform("segments", lambda s: s * rate - noise)
    found = F.aggregate(each, F.lit(0.0), lambda acc, e: acc + F.greatest(F.lit(0.0), e))
    evidence = F.when(F.col("n") == 0, F.lit(LOWEST)).when(found > 0, found).otherwise(F.coalesce(F.array_max(each), -noise))
    place = F.greatest(F.least(F.floor((evidence - F.lit(LOWEST)) / BIN), F.lit(BINS - 1)), F.lit(0))
    table = (scanned.select(place.alias("bin"), "label").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).collect())
    n, y = np.zeros(BINS), np.zeros(BINS)
    for r in table:
        n[r["bin"]], y[r["bin"]] = r["n"], r["toxic"]
    base = n_toxic / (n_toxic + n_clean)
    # a quarter of a document at the base rate in every bin that has rows; empty bins take their neighbours' level
    fit = isotonic((y + base * 0.25)[n > 0] / (n + 0.25)[n > 0], (n + 0.25)[n > 0])
    levels = np.interp(np.arange(BINS), np.flatnonzero(n > 0), fit)
    return ToxicityModel(weights, rate, log_k, levels)


def _rate(tokens: dict[float, int]) -> float:
    """Root of E[exp(rate * score)] = 1 over clean tokens, between 0.05 and 8."""
    value, times = np.array(list(tokens)), np.array(list(tokens.values()), np.float64)
    low, high = 0.05, 8.0

    def excess(rate: float) -> float:
        return float((times * np.expm1(rate * value)).sum())

    if not len(value) or excess(high) <= 0:
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.7) -> DataFrame:
    """``id_col``, score, predicted, evidence, n_tokens, passages (start, end in tokens, score)."""
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.rate, model.log_k, model.levels))
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel(*held.value)
        scorer = Scorer(m.weights)
        for batch in portions(batches):
            score, evidence, size, passages = [], [], [], []
            for text in batch.column(1).to_pylist():
                n, found, _ = scorer.passages(text)
                e = m.evidence(n, found)
                noise = m.log_k + math.log(max(n, 1))
                evidence.append(e)
                size.append(n)
                score.append(m.probability(e))
                passages.append([{"start": a, "end": b, "score": s} for a, b, s in found if m.rate * s > noise])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(evidence, pa.float64()),
                                              pa.array(size, pa.int64()), pa.array(passages, kind)],
                                             names=["id", "score", "evidence", "n_tokens", "passages"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double, evidence double, n_tokens bigint, passages array<struct<start:bigint,end:bigint,score:double>>")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "n_tokens", "passages")
