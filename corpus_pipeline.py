"""A training corpus from raw documents: five stages, each written before the next reads it.

Language identification, near-duplicates, benchmark decontamination, personal data, packing.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import scratch_dir
from tidemark.llm import decontaminate, language_id, packing, simhash, surrogates
from tidemark.llm.common import held_out, table

#: Stands for the secret that a deployment passes in.
SURROGATE_SECRET = "public test data"
TOKENIZER = "word_bpe_49k.json"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, under the language that is predicted for them.

    Undetermined documents (NULL text, or no letter) are rejected.
    """
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                        language_id.predict(F.col("text"), model, spark).alias("_lang"))
    known = inner.where(F.col("_lang.lang_pred") != language_id.UNDETERMINED)
    return known.select(*[(F.col("_lang.lang_pred") if c == "lang" else F.col(f"_doc.`{c}`")).alias(c)
                          for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a telling share of benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` follows the text."""
    safe = surrogates.pseudonymise(docs, SURROGATE_SECRET)
    return safe.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, packed along the space-filling curve."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("surrogates", replace_private_data),
    ("packing", pack_sequences),
]

#: The fitted languages, XXH64 and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
