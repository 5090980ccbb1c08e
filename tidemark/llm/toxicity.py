"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A sentence is toxic with the probability that a logistic model of its words and their
beginnings gives (so inflected forms share what is learned), and a document is toxic unless
all its sentences are not (noisy-or). The model is fitted to the labels of documents alone;
the sentence probabilities it settles on then tell which sentences are to blame.

It learns from a bounded sample, about ``ROWS_A_LABEL`` documents of each label chosen by
a hash, weighted back to the shares the labels have. Scoring reads every text in full,
where it lies; only the weights, of a fixed size, are shipped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, unit_hash

#: Bound of the sample: documents of each label.
ROWS_A_LABEL = 4000
FEATURES = 1 << 18
#: Beginnings of so many letters are features beside the word itself.
BEGINNINGS = range(3, 9)
#: A feature counts if it is in so many sampled documents, and its share among toxic ones
#: is above that among the others by so many standard errors.
LEAST_DOCUMENTS, LEAST_DEVIATION = 4, 3.0
#: Words whose features or weights a worker keeps at most.
CACHED = 300_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=CACHED)
def features(word: str) -> list[int]:
    """Hashed features of a word: itself, and its beginnings."""
    parts = ["=" + word, *("^" + word[:n] for n in BEGINNINGS if n <= len(word))]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % FEATURES for p in parts]


def sentences(text: str | None) -> Iterator[tuple[int, int, set[str]]]:
    """Start, end and words of every sentence that has words."""
    for match in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(match[0].lower())
        if words:
            yield match.start(), match.end(), set(words)


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit_bags(words: np.ndarray, per_sentence: np.ndarray, per_doc: np.ndarray, toxic: np.ndarray,
             weight: np.ndarray, steps: int = 250, sparse: float = 2e-4) -> ToxicityModel:
    """Fit to documents given as features, features a sentence, and sentences a document.

    The loss is that of the noisy-or; steps are Adam's, each followed by shrinking all word
    weights towards zero, so words that tell nothing end there.
    """
    doc_of = np.repeat(np.arange(len(per_doc)), per_doc)
    sentence_of = np.repeat(np.arange(len(per_sentence)), per_sentence)
    firsts = np.cumsum(per_doc) - per_doc
    w, b = np.zeros(FEATURES), -5.0
    m, v, mb, vb = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    total = weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(sentence_of, w[words], len(per_sentence)) + b
        clean = np.add.reduceat(_softplus(z), firsts)  # minus the log of "no sentence is toxic"
        pull = np.where(toxic, -1 / np.expm1(np.maximum(clean, 1e-9)), 1.0) * weight / total
        grad = pull[doc_of] / (1 + np.exp(-z))
        g = np.bincount(words, grad[sentence_of], FEATURES)
        gb = grad.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.1 * min(1.0, 2 * (steps - t + 1) / steps)
        pace = rate / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-6)
        w -= pace * m / (1 - 0.9 ** t)
        w = np.sign(w) * np.maximum(0, np.abs(w) - pace * sparse)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-6)
    return ToxicityModel(w.astype(np.float32), float(b))


def fit(docs: DataFrame, labels: DataFrame, *, rows_a_label: int = ROWS_A_LABEL,
        id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> ToxicityModel:
    """The model learned from documents with a label.

    Labels that are NULL, or without a document, teach nothing; a document labelled more than
    once counts as toxic if any label says so. Texts without words teach nothing. Equal rows
    count once, and of each label at most ``2 * rows_a_label`` rows are learned from, however
    many rows an id has. Without usable labels the model calls nothing toxic.
    """
    marks = (labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id"))
             .agg((F.max(toxic_col) > 0).alias("toxic")))
    counts = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return ToxicityModel(np.zeros(FEATURES, np.float32), -5.0)
    share = {k: min(1.0, rows_a_label / n) for k, n in counts.items()}
    # The bound is kept exactly, so the broadcast is small whatever the tables' size.
    sample = marks.where(
        unit_hash(F.col("doc_id")) < F.when(F.col("toxic"), share.get(True, 1.0))
        .otherwise(share.get(False, 1.0))).orderBy(F.xxhash64("doc_id")).limit(3 * rows_a_label)
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("of")).join(F.broadcast(sample), "doc_id")
    # An id may have any number of rows: equal ones count once, and of the others the bound
    # holds for each label again, by a hash.
    narrow = marked.select("toxic", "doc_id", "of").distinct()
    taken = None
    for toxic in (True, False):
        some = narrow.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id", "of")).limit(
            2 * rows_a_label)
        taken = some if taken is None else taken.unionByName(some)
    texts = (marked.join(F.broadcast(checkpointed(taken)), ["toxic", "doc_id", "of"])
             .groupBy("toxic", "doc_id", "of").agg(F.min("text").alias("text")).select("toxic", "text"))

    def occurring(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "toxic": batch["toxic"],
                "features": [sorted({f for _, _, words in sentences(t) for w in words
                                     for f in features(w)}) for t in batch["text"]]})

    telling = _telling(texts.mapInPandas(occurring, "toxic boolean, features array<int>"))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for toxic, text in zip(batch["toxic"], batch["text"]):
                found = [[f for w in sorted(words) for f in features(w) if telling[f]]
                         for _, _, words in sentences(text)]
                if found:
                    out.append((toxic, [len(s) for s in found], [f for s in found for f in s]))
            yield pd.DataFrame(out, columns=["toxic", "sizes", "words"])

    kept = texts.mapInPandas(bags, "toxic boolean, sizes array<int>, words array<int>")
    kept = kept.orderBy(F.xxhash64("words", "sizes"), "toxic").toPandas()
    if not len(kept):
        return ToxicityModel(np.zeros(FEATURES, np.float32), -5.0)
    toxic = kept["toxic"].to_numpy(bool)
    weight = np.array([1 / share[t] for t in toxic])
    return fit_bags(np.concatenate(list(kept["words"])).astype(np.int64),
                    np.concatenate(list(kept["sizes"])).astype(np.int64),
                    np.array([len(s) for s in kept["sizes"]]), toxic, weight)


def _telling(rows: DataFrame) -> np.ndarray:
    """For every feature, whether toxic documents have it clearly more often than others."""
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = max(1, n.get(True, 0)), max(1, n.get(False, 0))
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if("toxic").alias("in_toxic"), F.count_if(~F.col("toxic")).alias("in_other"))
    share = (F.col("in_toxic") + F.col("in_other")) / (toxic + other)
    error = F.sqrt(share * (1 - share + 1e-9) * (1 / toxic + 1 / other))
    above = F.col("in_toxic") / toxic - F.col("in_other") / other
    found = counts.where((F.col("in_toxic") + F.col("in_other") >= LEAST_DOCUMENTS)
                         & (above >= LEAST_DEVIATION * error)).select("feature").toPandas()
    telling = np.zeros(FEATURES, bool)  # at most FEATURES rows came
    telling[found["feature"].to_numpy()] = True
    return telling


class Weights(dict):
    """Weights by word, looked up once a word and worker."""

    def __init__(self, model: ToxicityModel):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED:
            self.clear()
        value = self[word] = float(self.model.weights[features(word)].sum())
        return value


def judge(text: Column, model: ToxicityModel, spark) -> Column:
    """``struct<score, offending>`` of a whole text.

    ``score`` is the noisy-or over sentences; ``offending`` lists those whose own probability
    is 0.5 or more as ``struct<start, end, p>`` in code points. A text that is NULL, empty or
    without words counts as one sentence without words.
    """
    shipped = spark.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("offending", pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])

    @F.arrow_udf("score double, offending array<struct<start:int,end:int,p:double>>")
    def run(texts: pa.Array) -> pa.Array:
        weights, bias, out = Weights(shipped.value), shipped.value.bias, []
        for text in texts:
            spans, z = [], []
            for start, end, words in sentences(text.as_py()):
                z.append(bias + sum(map(weights.__getitem__, words)))
                if z[-1] >= 0:
                    spans.append({"start": start, "end": end, "p": 1 / (1 + np.exp(-z[-1]))})
            clean = float(_softplus(np.array(z or [bias])).sum())
            out.append({"score": -np.expm1(-clean), "offending": spans})
        return pa.array(out, kind)

    return run(text)


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score, predicted, offending``.

    One row for each row of ``docs``, judged by its text alone. Columns of ``docs`` with one
    of the three names are replaced; an empty table stays empty.
    """
    new = ("score", "predicted", "offending")
    inner = docs.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        judge(F.col(text_col), model, docs.sparkSession).alias("_j"))
    return inner.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in new],
                        "_j.score", (F.col("_j.score") >= 0.5).cast("int").alias("predicted"),
                        "_j.offending")
