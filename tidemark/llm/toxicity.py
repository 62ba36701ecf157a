"""Toxicity by multiple-instance learning: noisy-or over sentences.

A sentence's probability is logistic in the sum of its words' weights; a
document is toxic unless every sentence is not: ``1 - prod(1 - p)``. Weights are
trained from document labels alone, by gradient steps on the noisy-or likelihood
with a normal prior on the weights; the same sentence probabilities then say where a
document offends. Words are runs of letters and digits, hashed to 64 bits;
sentences end at ``. ! ?`` and line ends.

Length alone is no evidence: sentences of a probability under FLOOR do not add up,
however many there are; the strongest of them stands for all. A sentence without
a weighted word has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ready, uniform
from tidemark.llm.language import fold_of
from tidemark.llm.textblocks import slices, words

#: Sentences of less probability are not combined.
FLOOR = 0.1

_WORD = np.full(256, 0x20, np.uint8)
for _a, _b in ((ord("0"), ord("9")), (ord("A"), ord("Z")), (ord("a"), ord("z")), (0x80, 0xFF)):
    _WORD[_a : _b + 1] = np.arange(_a, _b + 1)
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


def sentences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the sentence of each word, the text of each sentence, the sentences' byte bounds."""
    bounds = np.union1d(np.flatnonzero(_END[raw]) + 1, offsets)
    hashed, first = words(_WORD[raw], bounds)
    sentence = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    text = np.searchsorted(offsets, bounds[:-1], "right") - 1
    return hashed, sentence, text, bounds


@dataclass(frozen=True)
class ToxicModel:
    """Sorted word hashes with a weight each, and the weight of any sentence."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_scores(self, hashed: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
        """Probability of each sentence; 0 without a weighted word."""
        if not len(self.hashes) or not len(hashed):
            return np.zeros(count)
        at = np.searchsorted(self.hashes, hashed)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == hashed
        z = self.bias + np.bincount(sentence[hit], self.weights[at[hit]], count)
        return np.where(np.bincount(sentence[hit], minlength=count) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)

    def document_scores(self, p: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
        """Noisy-or of the sentences from FLOOR on, or the strongest sentence if that is more."""
        top = np.zeros(count)
        np.maximum.at(top, text, p)
        strong = p >= FLOOR
        clean = np.bincount(text[strong], np.log1p(-np.minimum(p[strong], 1 - 1e-12)), count)
        return np.clip(np.maximum(top, -np.expm1(clean)), 0.0, 1.0)


def train(labelled: Iterator[tuple[str, int]], words_at_most: int = 2000, least_documents: int = 3, least_z: float = 4.0, spread: float = 5.0, rounds: int = 600, rate: float = 0.05) -> ToxicModel:
    """Fit to (text, 0 or 1) pairs; memory follows the sample, which the caller bounds."""
    docs, marks = [], []
    for text, mark in labelled:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        hashed, sentence, _, _ = sentences(raw, np.array([0, len(raw)]))
        if len(hashed):
            docs.append((hashed, np.unique(sentence, return_inverse=True)[1]))
            marks.append(mark)
    y = np.array(marks, bool)
    if not y.any() or y.all():
        return ToxicModel(np.zeros(0, np.uint64), np.zeros(0), -30.0 if not y.any() else 0.0)
    # words whose documents differ most in their labels, by a two-sample z score
    once = [np.unique(h) for h, _ in docs]
    vocabulary, where = np.unique(np.concatenate(once), return_inverse=True)
    owner = np.repeat(np.arange(len(once)), [len(o) for o in once])
    n1, n0 = y.sum(), (~y).sum()
    in1 = np.bincount(where[y[owner]], minlength=len(vocabulary))
    df = np.bincount(where, minlength=len(vocabulary))
    share = df / len(y)
    z = (in1 / n1 - (df - in1) / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    z[df < least_documents] = 0
    chosen = np.sort(np.argsort(-np.abs(z), kind="stable")[:words_at_most])
    chosen = chosen[np.abs(z[chosen]) >= least_z]
    hashes = vocabulary[chosen]
    # one flat array of (sentence, word); sentences know their document
    word, place, bag, base = [], [], [], 0
    for d, (hashed, sentence) in enumerate(docs):
        at = np.searchsorted(hashes, hashed)
        at[at == len(hashes)] = 0
        hit = hashes[at] == hashed if len(hashes) else np.zeros(len(hashed), bool)
        word.append(at[hit])
        place.append(sentence[hit] + base)
        count = int(sentence[-1]) + 1
        bag.append(np.full(count, d))
        base += count
    word, place, bag = np.concatenate(word), np.concatenate(place), np.concatenate(bag)
    # sentences without a chosen word have no probability and don't count
    used, place = np.unique(place, return_inverse=True)
    bag = bag[used]
    w, b = np.zeros(len(hashes)), -4.0
    m1, m2, mb1, mb2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):
        logit = np.clip(b + np.bincount(place, w[word], len(used)), -30, 30)
        p = 1 / (1 + np.exp(-logit))
        clean = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))
        q = np.exp(clean)
        pull = np.where(y, q / np.maximum(1 - q, 1e-9), -1.0) / len(y)
        g = pull[bag] * p
        gw = np.bincount(word, g[place], len(w)) if len(w) else np.zeros(0)
        gw = gw - w / (spread * spread * len(y))
        gb = g.sum()
        m1, m2 = 0.9 * m1 + 0.1 * gw, 0.999 * m2 + 0.001 * gw * gw
        mb1, mb2 = 0.9 * mb1 + 0.1 * gb, 0.999 * mb2 + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w = w + rate * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-6)
        b = min(-0.5, b + rate * (mb1 / c1) / (np.sqrt(mb2 / c2) + 1e-6))
    some = np.abs(w) > 1e-3
    return ToxicModel(hashes[some], w[some], float(b))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, sample_chars: int = 40_000_000) -> ToxicModel:
    """Learn from labelled rows that are not held out.

    The sample is ``sample_rows`` rows by a hash of the id, of
    which whole texts are read up to ``sample_chars`` characters in all. A count
    comes first, so that of many labels only some more than the sample are sorted.
    """
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    labelled = marked.count()
    if labelled > 2 * sample_rows:
        # hashes are even, so about 1.5 samples are left; far fewer than one is out of the question
        marked = marked.filter(uniform(F.lit(3), F.col("_id")) < 1.5 * sample_rows / labelled)
    ids = marked.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select(F.xxhash64("_id").alias("h"), "text", "_toxic").orderBy("h", "text")

    def bounded() -> Iterator[tuple[str, int]]:
        left = sample_chars
        for _, text, toxic in rows.toLocalIterator():
            left -= len(text or "")
            if left < 0:
                return
            yield text, int(toxic)

    return train(bounded())


def score_documents(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, held_out, score, predicted, offending for every document.

    ``offending`` lists, for documents predicted toxic, the sentences with at
    least half the probability of the worst one, as start:end in code points,
    comma-joined; it is empty for others. Defined cases: null and empty texts,
    and texts without a word, score 0; texts of any length are read whole;
    repeated rows score alike; null ids are carried as null; an empty table gives
    no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id")) == 0).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, raw, offsets in slices(batch, "text"):
                rows = part.num_rows
                hashed, sentence, text, bounds = sentences(raw, offsets)
                count = max(0, len(bounds) - 1)
                p = model.sentence_scores(hashed, sentence, count)
                total = model.document_scores(p, text, rows)
                offending = [""] * rows
                first = np.searchsorted(text, np.arange(rows + 1))
                for d in np.flatnonzero(total >= 0.5).tolist():
                    own = p[first[d] : first[d + 1]]
                    points = np.concatenate([[0], np.cumsum((raw[offsets[d] : offsets[d + 1]] & 0xC0) != 0x80)])
                    bad = np.flatnonzero(own >= own.max() / 2) + first[d]
                    offending[d] = ",".join(f"{points[bounds[s] - offsets[d]]}:{points[bounds[s + 1] - offsets[d]]}" for s in bad.tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(total), pa.array((total >= 0.5).astype(np.int32)), pa.array(offending, pa.string())],
                    names=["doc_id", "held_out", "score", "predicted", "offending"],
                )

    return texts.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, offending string")
