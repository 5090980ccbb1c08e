"""Packing of documents into fixed-length sequences along a space-filling curve.

Each document's hashed token counts are projected to a few dimensions; the Hilbert key of
that point orders the documents so that neighbours on the curve have similar words. The
token streams of all documents, laid end to end in that order, are cut into sequences of
``seq_len`` tokens, so only the very last sequence has any padding.

Only keys and token counts are sorted: a range sort by Hilbert key, which splits a run of
copies with one key over several partitions, and running sums per partition give every
document its place. Texts are encoded once, into a table in the cluster's shared folder; their ids, not
the texts, are shuffled to meet that place and are cut into pieces.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import scratch_dir
from tidemark.llm.common import checkpointed

SEQ_LEN = 2048
END_ID = 1
DIMENSIONS, BITS = 3, 12
#: Size of the hashed count vector that is projected.
BUCKETS = 512
#: Encoded pieces that a worker keeps in each of two generations (some 100 MB each), and the
#: longest of them.
CACHED, CACHED_CHARS = 500_000, 40


def _below(limit: int, kind: str) -> str:
    """A character class of the code points below ``limit`` in a Unicode category."""
    return "".join(f"\\u{c:04x}" for c in range(limit) if unicodedata.category(chr(c))[0] == kind)


# The tokenizer's own split into pieces, for texts below U+0250.
_L, _N = _below(0x250, "L"), _below(0x250, "N")
_PIECE = re.compile(
    rf"[{_L}]+|[{_N}]|'(?:re|ve|ll|[stmd])|[^\t-\r \x85\xa0{_L}{_N}]+")
# Letters below U+0250 whose lower case lies beyond are left to the tokenizer as well.
_RISING = "".join(chr(c) for c in range(0x250) if any(ord(low) >= 0x250 for low in chr(c).lower()))
_BEYOND = re.compile(f"[^\x00-\u024f]|[{_RISING}]|<\\|")


class WordEncoder:
    """Token ids of texts, as little-endian bytes of ``width`` each.

    The tokenizer joins nothing across the pieces it splits a text into, nor across white
    space, so the ids of a text are those of its pieces, and pieces that return are encoded
    once. Below U+0250, where all characters are in normal form and change case by
    themselves, pieces are found here, in lower case; other texts, and those that may hold a
    special token, are only split at spaces and line ends.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if _BEYOND.search(text):
            return text.replace("\n", " ").split(" ")
        return _PIECE.findall(text.lower())

    def __call__(self, text: str | None) -> bytes:
        pieces = self.pieces(text or "")
        met = set(pieces)
        if len(self.known) + len(met) > CACHED:
            self.known, self.older = {}, self.known
        known, older, long = self.known, self.older, {}
        new = []
        for piece in met:
            if piece in known:
                continue
            if piece in older:
                known[piece] = older[piece]
            else:
                new.append(piece)
        for piece, coded in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False)):
            ids = np.array(coded.ids, f"<u{self.width}").tobytes()
            (known if len(piece) <= CACHED_CHARS else long)[piece] = ids
        if long:
            return b"".join([known[p] if p in known else long[p] for p in pieces])
        return b"".join(map(known.__getitem__, pieces))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def points(ids: list[np.ndarray]) -> np.ndarray:
    """Projected hashed count vectors, each dimension scaled to ``0 .. 2**BITS - 1``."""
    axes = np.random.default_rng(7).standard_normal((BUCKETS, DIMENSIONS))
    out = np.zeros((len(ids), DIMENSIONS))
    for row, tokens in enumerate(ids):
        # Fixed value: Knuth's multiplicative constant spreads ids over the buckets.
        buckets = (tokens.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        counts = np.sqrt(np.bincount(buckets, minlength=BUCKETS))
        out[row] = counts @ axes / max(1.0, np.sqrt((counts ** 2).sum()))
    # The logistic curve is close to the normal distribution, so cells fill evenly.
    return (2 ** BITS / (1 + np.exp(-1.702 * out))).clip(0, 2 ** BITS - 1).astype(np.int64)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of every cell along the Hilbert curve (the transpose form by Skilling)."""
    x = cells.T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, 0) ^ swap
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _placed(narrow: DataFrame) -> DataFrame:
    """``narrow`` with ``at``, the number of tokens ahead of a row in curve order."""
    order = ["key", "h1", "h2"]
    laid = checkpointed(narrow.repartitionByRange(*order).sortWithinPartitions(*order))
    sums = laid.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(F.col("n") * F.col("copies")).alias("n")).collect()  # one row a partition
    base, total = {}, 0
    for p, n in sorted((r.p, r.n) for r in sums):
        base[p], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = base.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            space = batch.column("n").to_numpy() * batch.column("copies").to_numpy()
            ends = at + np.cumsum(space)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1"), batch.column("h2"), pa.array(ends - space)],
                ["h1", "h2", "at"])
            at = int(ends[-1]) if len(ends) else at

    return laid.mapInArrow(run, "h1 long, h2 long, at long")


def pack(docs: DataFrame, tokenizer: str, *, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences: ``id_col, start, length, ids, doc_tokens, sequence_id,
    offset``.

    A document is the ids of its text with ``end_id`` after them; a NULL or empty text is
    ``end_id`` alone, so each row of ``docs`` has a piece. Every id lies in one piece, every
    sequence but the last holds exactly ``seq_len`` ids, and pieces lie in it without gaps
    from 0. Documents with one Hilbert key follow each other in the order of a hash of id and
    text; repeated rows lie side by side, each with a place of its own; rows with a NULL id
    are packed like any other. An empty table gives no pieces. Only the two columns named are
    read. ``ids`` holds little-endian unsigned 32-bit numbers.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = F.col("doc_id").isNull()

    @F.arrow_udf("key long, n long, width int, ids binary")
    def encoded(texts: pa.Array) -> pa.Array:
        encode = encoder(tokenizer)
        ids = [encode(t.as_py()) for t in texts]
        keys = hilbert_keys(points([np.frombuffer(i, f"<u{encode.width}") for i in ids]))
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.int64()),
             pa.array([len(i) // encode.width + 1 for i in ids], pa.int64()),
             pa.array([encode.width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
            ["key", "n", "width", "ids"])

    # A row is known by 128 bits of its id and text; rows equal in both are counted.
    table = f"{scratch_dir(docs.sparkSession, 'encoded')}/documents"
    rows.select("doc_id", F.xxhash64("doc_id", "text", known).alias("h1"),
                F.xxhash64(F.lit(2), "text", "doc_id", known).alias("h2"),
                encoded("text").alias("e")).select("doc_id", "h1", "h2", "e.*").write.parquet(table)
    rows = docs.sparkSession.read.parquet(table)
    narrow = rows.groupBy("h1", "h2").agg(F.first("key").alias("key"), F.first("n").alias("n"),
                                          F.count(F.lit(1)).alias("copies"))
    places = _placed(narrow)
    copy = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("h1"))
    met = rows.withColumn("copy", copy).join(places, ["h1", "h2"]).select(
        "doc_id", "width", "ids", "copy", "at")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [batch_id, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            columns = [[] for _ in names]
            size = 0
            for doc, width, ids, copy, at in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                ids += end
                n = len(ids) // 4
                at += (copy - 1) * n
                start = 0
                while start < n:
                    length = min(n - start, seq_len - (at + start) % seq_len)
                    piece = (doc, start, length, ids[4 * start:4 * (start + length)], n,
                             (at + start) // seq_len, (at + start) % seq_len)
                    for column, value in zip(columns, piece):
                        column.append(value)
                    start += length
                size += len(ids)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)
                    columns, size = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)

    from pyspark.sql.pandas.types import to_arrow_type

    batch_id = to_arrow_type(rows.schema["doc_id"].dataType)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(cut, f"doc {kind}, start long, length long, ids binary, doc_tokens long, "
                               "sequence_id long, offset long").withColumnRenamed("doc", id_col)


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of a piece's bytes, unsigned."""
    return F.crc32(ids)


def crc32_of(ids: list[int]) -> int:
    """The same for a list of ids."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
