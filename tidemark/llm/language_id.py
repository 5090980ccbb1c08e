"""Language identification with error-correcting output codes.

Each language has a codeword of bits. For every bit a linear classifier over hashed
character n-grams predicts whether a text's language has it set; decoding picks the
language whose codeword fits all predictions best, each bit's loss weighted by how well
its classifier does. A text whose two best codewords fit almost equally is ambiguous.

The classifiers are learned from a bounded sample of the labelled texts: about
``ROWS_A_LANGUAGE`` whole texts of each language (``SAMPLE_ROWS`` of all, but of no language
fewer than ``LEAST_ROWS`` if it has them), chosen by a hash, and as many fragments of them.
Every language is learned, however many there are. Prediction reads every text in full, where it lies; only the fitted weights are
shipped; their size grows with the logarithm of the number of languages, their codewords' with it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unit_hash

UNDETERMINED = "und"
#: Bounds of the sample that the classifiers are fitted on.
ROWS_A_LANGUAGE, SAMPLE_ROWS, LEAST_ROWS = 500, 4000, 8
ORDERS = (1, 2, 3)
FEATURES = 1 << 12
#: Code points that are counted at once.
CHUNK = 1 << 18
#: A text is ambiguous if the runner-up's probability is at least this share of the best's.
AMBIGUOUS = 0.5


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of the letters, runs of all else being one space.

    None for a text without letters.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letters = _letters()[codes]
    if not letters.any():
        return None
    codes = np.where(letters, codes, 32).astype(np.uint32)
    codes = codes[letters | np.r_[True, letters[:-1]]]
    codes = np.r_[np.uint32(32), codes, np.uint32(32)].astype(np.uint32)
    counts = np.zeros(FEATURES)
    for start in range(0, len(codes), CHUNK):
        part = codes[start:start + CHUNK + max(ORDERS) - 1]
        for n in ORDERS:
            ends = min(CHUNK, len(part) - n + 1)
            if ends <= 0:
                continue
            mixed = np.full(ends, n, np.uint32)
            for k in range(n):
                # The FNV prime and Knuth's constant, to mix and to spread.
                mixed = (mixed ^ part[k:k + ends]) * np.uint32(16777619)
            slots = (mixed * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
            counts += np.bincount(slots, minlength=FEATURES)
    return counts


def vector(counts: np.ndarray) -> np.ndarray:
    damped = np.sqrt(counts)
    return (damped / np.sqrt((damped ** 2).sum())).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """One row of bits (-1, 1) a language.

    Up to seven languages: every way to part them in two. Beyond that, columns drawn at
    random with as many bits as seven languages have, or ten for each doubling of the languages
    where that is more, the best of a hundred draws (fewer for thousands of languages) by the
    smallest distance between two rows.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 7:
        parts = [(1, *rest) for rest in itertools.product((1, -1), repeat=languages - 1)]
        return np.array([p for p in parts if -1 in p], np.int8).T
    bits = max(63, 10 * (languages - 1).bit_length())
    draw, best, found = np.random.default_rng(11), -1, None
    for _ in range(max(2, min(100, 100 * 1000 ** 2 // languages ** 2))):
        code = draw.choice(np.array([-1, 1], np.int8), (languages, bits))
        signs, least = code.astype(np.float32), bits
        for start in range(0, languages, 1024):
            alike = signs[start:start + 1024] @ signs.T
            own = np.arange(len(alike))
            alike[own, start + own] = -bits
            least = min(least, int(bits - alike.max()) // 2)
        if least > best:
            best, found = least, code
    return found


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # features x bits
    bias: np.ndarray      # bits
    trust: np.ndarray     # bits; weights of the losses, their mean is 1
    scale: float          # turns a mean loss into a log-probability

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted mean logistic loss of every codeword, a row for each row of ``x``."""
        margins = x @ self.weights + self.bias
        # A bit that is not set costs its margin more than one that is.
        least = (np.logaddexp(0, -margins) * self.trust).sum(axis=1, keepdims=True)
        return (least + (margins * self.trust) @ (self.code < 0).T.astype(float)) / self.code.shape[1]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        loss = -self.scale * self.losses(x)
        odds = np.exp(loss - loss.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def fit_vectors(x: np.ndarray, languages: list[str], steps: int = 150,
                ridge: float = 1e-4) -> LanguageModel:
    """Fit all bit classifiers at once, by gradient steps on the logistic loss."""
    names = sorted(set(languages))
    which = np.searchsorted(names, languages)
    code = codewords(len(names))
    y = code[which].astype(np.float32)
    share = np.bincount(which, minlength=len(names))
    row_weight = (len(x) / (len(names) * share[which])).astype(np.float32)[:, None]
    # Every fifth row of a language is held out, of one with fewer rows none.
    place = np.empty(len(x), np.int64)
    order = np.argsort(which, kind="stable")
    place[order] = np.arange(len(x)) - np.repeat(np.cumsum(share) - share, share)
    held = place % 5 == 4
    fit = ~held
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    means = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    rows = fit if fit.any() else held
    fx, fy, fr = x[rows], y[rows], row_weight[rows]
    for t in range(1, steps + 1):
        pull = -fy * fr / (1 + np.exp(fy * (fx @ w + b))) / len(fx)
        for value, grad, m, v in ((w, fx.T @ pull + ridge * w, *means[:2]),
                                  (b, pull.sum(axis=0), *means[2:])):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad ** 2 - v)
            value -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    right = ((x[held] @ w + b) * y[held] > 0).mean(axis=0) if held.any() else np.ones(len(b))
    trust = np.clip(right, 0.55, 0.999)
    trust = np.log(trust / (1 - trust))
    model = LanguageModel(names, code, w, b, trust / trust.mean(), 1.0)
    # The scale that makes the held-out probabilities most likely.
    loss = model.losses(x[held]) if held.any() else model.losses(x)
    truth = which[held] if held.any() else which
    scales = [2.0 ** k for k in range(-1, 6)]

    def cost(s: float) -> float:
        z = -s * loss
        top = z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(axis=1)) + top[:, 0]
                      - z[np.arange(len(z)), truth]).mean())

    return LanguageModel(names, code, w, b, trust / trust.mean(), min(scales, key=cost))


def _fragment(text: str) -> str:
    """Up to eight words from a place that the text itself decides."""
    words = text.split()
    start = hash_place(text, max(1, len(words) - 7))
    return " ".join(words[start:start + 1 + hash_place(text + "#", 8)])


def hash_place(text: str, places: int) -> int:
    import zlib

    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % places


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
        rows_a_language: int = ROWS_A_LANGUAGE) -> LanguageModel:
    """The model learned from a bounded sample of ``labelled``.

    Every value of ``lang_col`` is learned. Of each about
    ``rows_a_language`` texts are taken, by a hash of the text; copies of a text count once. NULL labels, and texts that are NULL or have no letter, teach nothing; a
    language that no usable text is left for is not learned. With no usable text at all the
    model knows no language and every prediction is undetermined.
    """
    lettered = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = lettered.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                           F.xxhash64(text_col).alias("of"))
    # Copies count once: shares are of the different texts, told apart by their hashes alone.
    hashes = rows.select("lang", "of").distinct()
    counts = hashes.groupBy("lang").count().collect()
    each = min(rows_a_language, max(LEAST_ROWS, SAMPLE_ROWS // max(1, len(counts))))
    # A share that all but surely holds that many texts; the surplus is dropped afterwards.
    drawn = each + 8 * each ** 0.5 + 16
    spark = rows.sparkSession
    shares = spark.createDataFrame(
        [(r.lang, drawn / r["count"]) for r in counts], "lang string, share double")
    near = hashes.join(F.broadcast(shares), "lang").where(
        unit_hash(F.col("of")) < F.col("share")).select("lang", "of").toPandas()
    near = near.sort_values(["lang", "of"]).groupby("lang").head(each)
    taken = spark.createDataFrame(
        [(lang, int(of)) for lang, of in zip(near["lang"], near["of"])], "lang string, of long")
    sample = (rows.join(F.broadcast(taken), ["lang", "of"]).groupBy("lang", "of")
              .agg(F.min("text").alias("text")).select("lang", "text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text in zip(batch["lang"], batch["text"]):
                for part in (text, _fragment(text)):
                    if (counts := ngram_counts(part)) is not None:
                        out.append((lang, vector(counts).astype("<f2").tobytes()))
            yield pd.DataFrame(out, columns=["lang", "x"])

    found = sample.mapInPandas(features, "lang string, x binary")
    # Equal features count once.
    found = found.distinct().orderBy(F.xxhash64("x"), "lang").toPandas()
    if not len(found):
        return LanguageModel([], np.ones((0, 1), np.int8), np.zeros((FEATURES, 1), np.float32),
                             np.zeros(1, np.float32), np.ones(1), 1.0)
    x = np.frombuffer(b"".join(found["x"]), "<f2").reshape(len(found), FEATURES).astype(np.float32)
    return fit_vectors(x, list(found["lang"]))


def predict(text: Column, model: LanguageModel, spark) -> Column:
    """``struct<lang_pred, score, runner_up, ambiguous>`` of a whole text.

    ``score`` is the best codeword's probability. A text that is NULL or has no letter is
    undetermined: ``und`` with score 0, ambiguous.
    """
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, runner_up string, ambiguous boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = shipped.value
        langs, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        second, unsure = np.full(len(texts), None, object), np.ones(len(texts), bool)
        values = list(texts)
        for start in range(0, len(values), 256):
            rows, xs = [], []
            for k in range(start, min(start + 256, len(values))):
                counts = ngram_counts(values[k]) if m.languages else None
                if counts is not None:
                    rows.append(k)
                    xs.append(vector(counts))
            if not rows:
                continue
            p = m.probabilities(np.array(xs))
            order = np.argsort(-p, axis=1, kind="stable")
            best, names = order[:, 0], np.array(m.languages, object)
            langs[rows], score[rows] = names[best], p[np.arange(len(p)), best]
            unsure[rows] = False
            if len(names) > 1:
                second[rows] = names[order[:, 1]]
                unsure[rows] = p[np.arange(len(p)), order[:, 1]] >= AMBIGUOUS * score[rows]
        return pd.DataFrame({"lang_pred": langs, "score": score.clip(0, 1), "runner_up": second,
                             "ambiguous": unsure})

    # A filter on a part of the result must not make Spark run the model a second time.
    return run.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, runner_up, ambiguous``.

    One row for each row of ``docs``, judged by its text alone. Columns of ``docs`` with one
    of the four names are replaced; an empty table stays empty.
    """
    new = ("lang_pred", "score", "runner_up", "ambiguous")
    inner = docs.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        predict(F.col(text_col), model, docs.sparkSession).alias("_p"))
    return inner.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in new], "_p.*")
