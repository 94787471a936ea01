"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.langid import held_out

#: A sentence ends at a mark before white space, or at a line end.
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
WORD = re.compile(r"[^\W\d_]+")


#: Lengths of word beginnings that are features beside whole words; they end in an asterisk.
BEGINNINGS = (4, 5, 6, 7)
#: Words whose weight a worker remembers.
MEMORY = 300_000


def word_features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


@dataclass(frozen=True)
class ToxicModel:
    """Weights of lower-cased words and word beginnings and the bias of a sentence's logit; ``base`` is the share
    of toxic documents, used where no word could be learned. At most ``most_words`` entries."""

    weight: dict[str, float]
    bias: float
    base: float


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.split(text) if s]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_noisy_or(texts: list[str], labels: np.ndarray, most_words: int = 20_000, rounds: int = 400, rate: float = 0.05, decay: float = 0.03) -> ToxicModel:
    """Train sentence weights from document labels alone.

    A document's probability is the noisy-or of its sentences', 1 - prod(1 - p); the gradient
    of its log-likelihood reaches each sentence by its share of the blame. Words are sets in a
    sentence. Only words that toxic documents have more often than chance explains, by a
    likelihood ratio that allows for the number of words tried, get a weight; the weights are
    fitted by full-batch Adam with an L2 penalty around their start and a bound on one document's pull."""
    n, good = len(texts), float(np.sum(labels == 1))
    if not n or good in (0, n):
        return ToxicModel({}, 0.0, 0.0 if not n else good / n)
    bags = [[sorted({f for w in set(WORD.findall(s.lower())) for f in word_features(w)}) for s in sentences(t)] for t in texts]
    counts: dict[str, np.ndarray] = {}
    for doc, y in zip(bags, labels):
        for w in {w for s in doc for w in s}:
            counts.setdefault(w, np.zeros(2))[int(y)] += 1
    # evidence: twice the log-likelihood ratio of a word's own share of toxic documents
    rate_all = good / n
    often = {w: c for w, c in counts.items() if c.sum() >= 3}
    need = 2 * np.log(max(len(often), 2))
    share = lambda k, m, q: k * np.log(np.maximum(k, 1e-300) / (m * q)) if k else 0.0
    evidence = {
        w: 2 * (share(c[1], c.sum(), rate_all) + share(c[0], c.sum(), 1 - rate_all)) for w, c in often.items() if c[1] / c.sum() > rate_all
    }
    words = sorted((w for w, e in evidence.items() if e >= need), key=lambda w: (-evidence[w], w))[:most_words]
    # a word is covered by a beginning of its own, and that by a shorter one, of no less evidence
    chosen, known = [], set(words)
    for w in words:
        stems = [w.rstrip("*")[:k] + "*" for k in BEGINNINGS if len(w.rstrip("*")) > k]
        if not any(b in known and evidence[b] >= evidence[w] for b in stems):
            chosen.append(w)
    words = chosen
    if not words:
        return ToxicModel({}, 0.0, rate_all)
    index = {w: k for k, w in enumerate(words)}
    rows, cols, owner, at = [], [], [], 0
    for d, doc in enumerate(bags):
        for s in doc or [[]]:
            hit = [index[w] for w in s if w in index]
            rows += [at] * len(hit)
            cols += hit
            owner.append(d)
            at += 1
    rows, cols, owner = np.array(rows, np.int64), np.array(cols, np.int64), np.array(owner, np.int64)
    begin = np.searchsorted(owner, np.arange(n))
    x = np.concatenate([np.full(len(words), 6.0), [-8.0]])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        logit = np.bincount(rows, weights=x[cols], minlength=at) + x[-1]
        p = _sigmoid(logit)
        none = np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), begin)
        doc = np.clip(1 - np.exp(none), 1e-6, 1 - 1e-6)
        # d/dlogit of log P: (1 - doc) / doc * p for label 1, -p for label 0
        blame = np.where(labels == 1, np.minimum((1 - doc) / doc, 20.0), -1.0) / n
        g = blame[owner] * p
        grad = np.append(np.bincount(cols, weights=g[rows], minlength=len(words)), g.sum())
        grad[:-1] -= decay / n * (x[:-1] - 6.0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        x = x + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    kept = {w: float(k) for w, k in zip(words, x) if abs(k) > 0.05}
    return ToxicModel(kept, float(x[-1]), good / n)


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 6000) -> ToxicModel:
    """Fit on labelled documents outside of the held-out fifth: all, or the ``most_rows`` of
    smallest hash where there are more. The sample is gathered in one task of that bound; only
    the weights reach the driver. Null texts and labels are left out; a document that any label
    calls toxic is toxic; of several texts of one id the first in their order is learned from."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id", 5, 0))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        every = pd.concat(held).sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
        model = fit_noisy_or(every["text"].tolist(), every["toxic"].to_numpy())
        yield pd.DataFrame({"word": [*model.weight, "", " "], "weight": [*model.weight.values(), model.bias, model.base]})

    rows = rows.repartition(1).mapInPandas(run, "word string, weight double").collect()
    found = {r["word"]: r["weight"] for r in rows}
    bias, base = found.pop("", 0.0), found.pop(" ", 0.0)
    return ToxicModel(found, bias, base)


def sentence_logits(text: str, model: ToxicModel) -> np.ndarray:
    get = model.weight.get
    total = lambda s: sum(get(f, 0.0) for w in set(WORD.findall(s)) for f in word_features(w))
    return np.array([total(s.lower()) + model.bias for s in sentences(text)])


class _Weights(dict):
    """The weight of a word with all its features, worked out at its first use."""

    def __init__(self, model: ToxicModel):
        super().__init__()
        self.get_feature = model.weight.get

    def __missing__(self, word: str) -> float:
        self[word] = total = sum(self.get_feature(f, 0.0) for f in word_features(word))
        return total


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(doc_id, score, worst_start, worst_end, offending, sentences)`` for every row: the
    noisy-or of all sentences; ``offending``, the places in code points and probabilities of all
    sentences that reach ``threshold`` by themselves, in order; and the place of the one among
    them that contributes most (else null).

    A null or empty text has no sentence and the score 0; without labels to learn from every
    text gets the learned share of toxic ones. Repeated rows and null ids are rows like others."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        memory = _Weights(m)
        least = math.log(threshold / (1 - threshold))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
        for b in batches:
            out: list[tuple] = []
            for text in b.column(1).to_pylist():
                text = text or ""
                if len(memory) > MEMORY:
                    memory.clear()
                if not m.weight:
                    out.append((m.base if text else 0.0, None, None, [], 0))
                    continue
                none, worst, where, n, over = 0.0, -np.inf, None, 0, []
                for part in _spans(text):
                    n += 1
                    logit = m.bias + sum(map(memory.__getitem__, set(WORD.findall(text[slice(*part)].lower()))))
                    none -= np.log1p(np.exp(min(logit, 40.0)))  # log(1 - sigmoid)
                    if logit > worst:
                        worst, where = logit, part
                    if logit >= least:
                        over.append({"start": part[0], "end": part[1], "probability": 1 / (1 + math.exp(-min(logit, 40.0)))})
                out.append((float(-np.expm1(none)) if n else 0.0, *(where if over else (None, None)), over, n))
            kinds = (pa.float64(), pa.int64(), pa.int64(), spans, pa.int64())
            cols = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "score", "worst_start", "worst_end", "offending", "sentences"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, worst_start long, worst_end long, offending array<struct<start:bigint,end:bigint,probability:double>>, sentences long")


def _spans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    for m in SENTENCE.finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)
