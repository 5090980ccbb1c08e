"""Cases that earlier forms of the text operators got wrong."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import packing, simhash, toxicity, warc_revisit, weighted_fingerprint
from tidemark.llm.queries import tokenizer_path


@pytest.mark.parametrize("n", [100, 1000, 10_000, 100_000])
def test_draws_agree_as_often_as_weights_overlap(spark, n):
    """One word of half the weight is shared, ``n`` others on either side are not."""
    heavy, draws = n // 2, 512 if n < 100_000 else 256
    want = heavy / (heavy + 2 * n)
    private = spark.range(2 * n).select(F.xxhash64("id").alias("t"), F.lit(1.0).alias("w"),
                                        (F.col("id") < n).alias("a"))
    shared = spark.createDataFrame([(-1, float(heavy), a) for a in (True, False)], private.schema)
    terms = private.unionByName(shared).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    value = weighted_fingerprint.with_draws(terms, F.col("t"), F.log("w"), {"v": F.col("k")})
    same = value.groupBy("k").agg(F.min(F.when(F.col("a"), F.col("v"))).alias("x"),
                                  F.min(F.when(~F.col("a"), F.col("v"))).alias("y")).where("x = y").count()
    assert abs(same / draws - want) < 4 * (want * (1 - want) / draws) ** 0.5


def test_fingerprints_without_spaces_and_with_text_ids(spark):
    text = "我们今天去城里看电影然后回家吃饭因为天气很好所以大家都很高兴"
    docs = spark.createDataFrame([("a", text), ("b", "完全不同的句子没有相同的意思"), (None, text), ("c", text)],
                                 "doc_id string, text string")
    got = {r.doc_id: r for r in weighted_fingerprint.edited_pairs(docs).collect()}
    assert len(got) == 4 and got["a"].signature == got["c"].signature == got[None].signature
    assert 0.4 < got["a"].near_edited < 1 and got["a"].near_next < 0.5


def test_token_ids_of_every_letter():
    encode = packing.encoder(tokenizer_path())
    rng = random.Random(3)
    far = [0x300, 0x301, 0x307, 0x3c3, 0x3c2, 0x1e9e, 0x212a, 0x212b, 0x4e2d, 0x1f600, 0xfb01, 0x2028, 0xa0]
    every = [chr(c) for c in range(1, 0x300)] + [chr(c) for c in far]
    texts = ["Əli", "ƏLİ", "Ɓoye", "ƊAN", "Ɛwe", "ƆKƆ", "", *every, *(f"a{c}b {c}" for c in every)]
    texts += ["".join(rng.choice(every) if rng.random() < 0.3 else rng.choice("aB 1.'") for _ in range(20))
              for _ in range(3000)]
    for text in texts:
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(memoryview(encode(text)).cast("H" if encode.width == 2 else "I")) == want, ascii(text)


def test_toxicity_learns_from_a_bounded_number_of_rows(spark, monkeypatch):
    docs = spark.range(6000).select((F.col("id") % 2).alias("doc_id"), F.concat(
        F.lit("kind words "), F.col("id").cast("string")).alias("text")).unionByName(
        spark.range(3000).select(F.lit(2).cast("long").alias("doc_id"), F.lit("vile fool").alias("text")))
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "doc_id long, toxic int")
    rows = []
    monkeypatch.setattr(toxicity, "fit_bags", lambda words, sentence, per_doc, toxic, weight: rows.extend(toxic))
    toxicity.fit(docs, labels, rows_a_label=30)
    assert rows.count(True) == 1 and 0 < rows.count(False) <= 60


RECORDS = ("record_id long, url string, ts long, revisit boolean, digest string, "
           "headers array<struct<name:string,value:string>>, base_id string, latest int")


def test_header_lines_and_repeated_records(spark):
    full = [("Set-Cookie", "b=2"), ("Set-Cookie", "a=1"), ("Vary", "x"), ("Vary", "y"), ("ETag", '"1"'),
            ("Date", "1"), (None, "n"), ("X", None)]
    again = [("vary", "z"), ("VARY", "q"), ("etag", '"1"'), ("set-cookie", "c=3")]
    url = "http://a.com/" + "p" * 100_000
    rows = [(1, url, 10, False, "d", full, "x", 1), (2, url, 20, True, None, again, "x", 1),
            (3, url, 30, True, None, None, "x", 1)]
    for times in (1, 2):
        got = {r.record_id: r for r in warc_revisit.resolve_revisits(
            spark.createDataFrame(rows * times, RECORDS)).collect()}
        assert sorted(got) == [2, 3]
        assert [tuple(h) for h in got[2].headers] == [
            ("date", "1"), ("etag", '"1"'), ("set-cookie", "b=2"), ("set-cookie", "a=1"), ("vary", "z"),
            ("vary", "q")]
        assert got[3].outcome == "resolved" and len(got[3].headers) == 6
    found = warc_revisit.resolve_revisits(spark.createDataFrame(rows * 2, RECORDS))
    assert found.count() == 2


def test_language_model_runs_once_in_the_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = corpus_pipeline.keep_known_languages(spark, docs, sf_dir)._jdf.queryExecution().executedPlan()
    assert len(re.findall(r"ArrowEvalPython", plan.toString().split("\n\n")[0])) == 1


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(200))
    other = " ".join(f"v{k}" for k in range(50))
    rows = [(5, text, "x", 1), (3, text, "y", 2), (3, other, "z", 3), (3, other, "z", 3),
            (None, text, "n", 4), (None, None, "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, k1 int")
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.fp for r in got.collect())) == ["e", "y", "z"]
