"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items: every run of ``window`` words, or
the whole item where it has fewer. Patterns of one length form a searcher. It slides
over the words of a document; a block of two words (one, for patterns of one word) at
the end of the slide looks up how far the slide may move before that block could lie
inside any pattern. Where the shift is zero, the block and the first block of the slide
select a short list of patterns, and a direct comparison decides.

Documents are searched where they are read, with no shuffle. The searchers are shipped
to all executors, at most ``BLOCK_WORDS`` benchmark words at a time: a larger benchmark
is searched in several passes, each adding to what the passes before have found.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpointed

WINDOW = 13
#: Words of the benchmark that are shipped at once: some 100 MB with all their windows.
BLOCK_WORDS = 500_000
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20

# Bytes that belong to words: digits, letters, and all of a non-ASCII character.
_WORD_BYTES = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128 else 32
                    for b in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; NULL has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Searcher:
    """Wu-Manber tables for patterns of one length, each with the items it comes from."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.default_shift = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple, list] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, self.length + 1):
                block = pattern[end - self.block:end]
                self.shift[block] = min(self.length - end,
                                        self.shift.get(block, self.default_shift))
            self.buckets[pattern[-self.block:], pattern[:self.block]].append((list(pattern), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start of every occurrence, with the items of its pattern."""
        length, block, default = self.length, self.block, self.default_shift
        shift, buckets, end, n = self.shift.get, self.buckets.get, self.length, len(words)
        while end <= n:
            suffix = tuple(words[end - block:end])
            step = shift(suffix, default)
            if step:
                end += step
                continue
            start = end - length
            for pattern, items in buckets((suffix, tuple(words[start:start + block])), ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


def searchers(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[Searcher]:
    """One searcher for each pattern length among the items."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[k:k + size])].add(item)
    return [Searcher(patterns) for _, patterns in sorted(by_length.items())]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, one in the driver at a time.

    A single longer item is a block of its own.
    """
    block, size = [], 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), text_col).toLocalIterator():
        if block and size + len(words_of(text)) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((str(item), text))
        size += len(words_of(text))
    if block:
        yield block


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _covered(spans: np.ndarray) -> np.ndarray:
    """Starts and ends, alternating, of the union of intervals given in the same form."""
    starts, ends = spans[0::2], spans[1::2]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return np.stack([starts[first], ends[np.r_[first[1:] - 1, len(ends) - 1]]], axis=1).ravel()


def _search(spark: SparkSession, text: Column, found: Column, block: list, window: int) -> Column:
    """``found`` with what the block's items add to it."""
    shipped = spark.sparkContext.broadcast(searchers(block, window))
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())),
                      ("items", pa.list_(pa.string()))])

    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        after = []
        for text, old in zip(texts, before):
            words, old = words_of(text.as_py()), old.as_py()
            spans, items = list(old["spans"]), set(old["items"])
            for searcher in shipped.value:
                for start, of in searcher.find(words):
                    if spans and spans[-2] <= start <= spans[-1]:
                        spans[-1] = max(spans[-1], start + searcher.length)
                    else:
                        spans += (start, start + searcher.length)
                    items |= of
            if len(spans) > 2:
                spans = _covered(np.array(spans, np.int32))
            after.append({"n_words": len(words), "spans": spans, "items": sorted(items)})
        return pa.array(after, kind)

    return scan(text, found)


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
                  one_in: int = ONE_IN, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, hit_spans, contaminated``.

    ``hit_spans`` holds the word ranges ``[start, end)`` inside occurrences of benchmark
    windows, ``items`` the ids of the items they come from, sorted as strings. A NULL or
    wordless text has no words and no hits and is never contaminated; a NULL or wordless
    item matches nothing; items without an id share the id ``None``; repeated items count
    once. Each row of ``docs`` is judged by itself, so repeated rows and NULL ids need no
    rule, and an empty table or benchmark gives no hits. Columns of ``docs`` with one of
    the five names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns
            if c not in ("n_words", "n_hit", "items", "hit_spans", "contaminated")]
    out = docs.select(
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col(text_col).alias("_text"),
        F.struct(F.lit(0).cast("long").alias("n_words"),
                 F.array().cast("array<int>").alias("spans"),
                 F.array().cast("array<string>").alias("items")).alias("_found"))
    blocks = list(itertools.islice(_blocks(benchmark, item_col, item_text_col), 2))
    passes = _blocks(benchmark, item_col, item_text_col) if len(blocks) > 1 else blocks or [[]]
    for block in passes:
        out = out.withColumn("_found", _search(spark, F.col("_text"), F.col("_found"), block,
                                               window))
        if len(blocks) > 1:  # written between passes, so that few tables are held at once
            out = checkpointed(out)
    spans = F.col("_found.spans")
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1),
        lambda i: F.struct(F.get(spans, 2 * i).alias("start"), F.get(spans, 2 * i + 1).alias("end")))
    out = out.select(
        "_row", F.col("_found.n_words").alias("n_words"), F.col("_found.items").alias("items"),
        F.when(F.size(spans) > 0, pairs).otherwise(
            F.array().cast("array<struct<start:int,end:int>>")).alias("hit_spans"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (out.withColumn("n_hit", n_hit)
            .select(*[F.col(f"_row.`{c}`") for c in kept], "n_words", "n_hit", "items",
                    "hit_spans", ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))
                    .alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their columns as they came."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                        F.col(options.pop("text_col", "text")).alias("_of"))
    return (contamination(inner, benchmark, text_col="_of", **options)
            .where("NOT contaminated").select("_doc.*"))
