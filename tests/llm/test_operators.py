"""The text operators on small fixtures: brute force, round trips and edge cases."""

import collections
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import connect, differences  # noqa: E402
from tidemark.llm import (  # noqa: E402
    chat_trees, decontaminate, language_id, packing, sharding, simhash, surrogates, toxicity,
    warc_revisit, weighted_fingerprint)
from tidemark.llm.oracles import llm_oracles  # noqa: E402
from tidemark.llm.queries import llm_queries, tokenizer_path  # noqa: E402

DOCS = "doc_id long, text string, fp string, row string"
LONG = " ".join(f"word{k % 977}" for k in range(30_000))
ODD = [(1, "a b c d e", "x", "y"), (1, "a b c d e", "x", "y"), (2, None, None, None), (None, "", "", ""),
       (None, None, None, None), (3, " \n\t ", "x", None), (4, LONG, "x", "y"), (5, "é Ü 你好 Σ", "x", "y"),
       (6, "a b c d e", "z", "z"), (7, "Ok.", "x", "y")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", llm_oracles())
def test_query_matches_sql(spark, sf_dir, name):
    df = llm_queries()[name](spark, sf_dir)
    assert differences(df, connect(sf_dir), llm_oracles()[name]) == ""


@pytest.mark.parametrize("name", llm_queries())
def test_query_has_a_row_for_each_document(spark, sf_dir, name):
    if name in llm_oracles():
        pytest.skip("compared with SQL")
    df = llm_queries()[name](spark, sf_dir)
    want = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id for r in df.select("doc_id").collect()} == want
    assert name in driver.queries()


def test_native_queries_run_no_python(spark, sf_dir):
    for name in ("op3_weighted_fingerprints", "op6_chat_formatting"):
        plan = llm_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# Simhash

def brute_components(rows, radius=3):
    fps = np.array([np.uint64(f & (2 ** 64 - 1)) for _, f in rows])
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    ids = collections.defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        ids[root(k)].append(doc)
    return [min((d for d in ids[root(k)] if d is not None), default=None) for k in range(len(rows))]


def test_simhash_bits_by_definition():
    import xxhash

    text = "The the THE cat\tsat on\x0bthe mat the the the"
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text.lower()) if w]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]), 42) for k in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) % 2 ** 64 == want
    assert simhash.fingerprint("One two") % 2 ** 64 == xxhash.xxh64_intdigest("one two", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_simhash_components_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    seeds = [int(x) for x in rng.integers(-2 ** 63, 2 ** 63, 40)]
    rows = [(k, s) for k, s in enumerate(seeds)]
    for k in range(300):  # chains of near copies, across tile borders
        fp = rows[int(rng.integers(len(rows)))][1]
        for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            fp ^= 1 << int(bit)
        fp &= 2 ** 64 - 1
        rows.append((40 + k, fp - 2 ** 64 if fp >= 2 ** 63 else fp))
    monkeypatch.setattr(simhash, "HOME_ROWS", 3)  # several chunks a tile
    monkeypatch.setattr(simhash, "GUEST_ROWS", 5)
    classes = spark.createDataFrame([(f,) for f in {f for _, f in rows}], "fp long")
    label = {r.node: r.root for r in simhash.components(simhash.links(classes)).collect()}
    of = collections.defaultdict(list)
    for doc, fp in rows:
        of[label.get(fp, fp)].append(doc)
    assert [min(of[label.get(f, f)]) for _, f in rows] == brute_components(rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)], "a long, b long")
    found = simhash.components(edges).collect()
    assert len(found) == 61 and {r.root for r in found} == {0}
    assert simhash.components(edges.where("a < 0")).count() == 0


def test_simhash_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    want = brute_components([(r.doc_id, r.fp) for r in found])
    assert len(found) == len(ODD) and [r.component_id for r in found] == want
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in found})
    assert simhash.near_duplicates(empty).count() == 0 == simhash.drop_near_duplicates(empty).count()


# Decontamination

def test_wu_manber_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        items = [(str(k), " ".join(rng.choice(list("abc"), int(rng.integers(0, 9))))) for k in range(5)]
        words = list(rng.choice(list("abc"), 60))
        patterns = collections.defaultdict(set)
        for item, text in items:
            w = text.split()
            size = min(4, len(w))
            for k in range(len(w) - size + 1 if size else 0):
                patterns[tuple(w[k:k + size])].add(item)
        want = {(k, len(p), i) for p, of in patterns.items() for k in range(len(words))
                if tuple(words[k:k + len(p)]) == p for i in of}
        coded = [w.encode() for w in words]
        got = {(k, s.length, i) for s in decontaminate.searchers(items, 4)
               for k, of in s.find(coded) for i in of}
        assert got == want


def test_decontamination_odd_rows(spark, odd, empty, monkeypatch):
    bench = spark.createDataFrame([(1, "C d"), (1, "C d"), (2, None), (None, "ok"), (3, "!!"), (10, "é ü")],
                                  "item_id long, text string")
    for words in (decontaminate.BLOCK_WORDS, 1):  # at once, and in several passes
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        found = decontaminate.contamination(odd, bench)
        assert found.columns[:4] == odd.columns
        rows = {(r.doc_id, r.text): r for r in found.collect()}
        assert found.count() == len(ODD)
        assert (rows[1, "a b c d e"].n_words, rows[1, "a b c d e"].n_hit) == (5, 2)
        assert rows[7, "Ok."]["items"] == ["None"] and rows[7, "Ok."].contaminated
        assert rows[2, None].n_words == 0 and not rows[2, None].contaminated
    assert decontaminate.drop_contaminated(odd, bench).columns == odd.columns
    assert decontaminate.contamination(odd, bench.where("item_id > 99")).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0


# Packing

def test_hilbert_keys_step_to_neighbours():
    cells = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    path = cells[np.argsort(packing.hilbert_keys(cells, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(odd, tokenizer_path(), seq_len=64).collect()
    streams = collections.defaultdict(dict)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset + r.length <= 64
        streams[r.sequence_id][r.offset] = ids
    for k, pieces in streams.items():
        assert sum(map(len, pieces.values())) == 64 or k == max(streams)
        at = 0
        for offset in sorted(pieces):
            assert offset == at
            at += len(pieces[offset])
    whole = [i for k in sorted(streams) for o in sorted(streams[k]) for i in streams[k][o]]
    want = sorted(coder.encode(t or "", add_special_tokens=False).ids + [1] for _, t, *_ in ODD)
    assert len(whole) == sum(map(len, want))
    by_doc = collections.defaultdict(list)
    for r in rows:
        if r.doc_id in (4, 5, 7):
            by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for doc, text in ((4, LONG), (5, "é Ü 你好 Σ"), (7, "Ok.")):
        assert [i for _, ids in sorted(by_doc[doc]) for i in ids] == \
            coder.encode(text, add_special_tokens=False).ids + [1]
    assert packing.pack(empty, tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", [
    "", "Don't we'll '' --'s x\x85y\xa0z \x1c q", "İstanbul ΑΣ ß ½ ² 12345", "a<b|c <|endoftext|> <|startoftext|>x",
    "你好 мир ́a \t\v\f b", "ŉ Ǆ ǅ 'S 'T"])
def test_pieces_encode_like_the_whole(text):
    encode = packing.WordEncoder(tokenizer_path())
    want = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode(text), "<u2").tolist() == want


# Fingerprints

def test_collision_rate_is_generalised_jaccard(spark):
    a, b = {"x": 3, "y": 1, "z": 8}, {"x": 1, "y": 1, "w": 4, "z": 6}
    rows = [(s, t, float(w)) for s, of in (("a", a), ("b", b)) for t, w in of.items()]
    terms = spark.createDataFrame(rows, "s string, t string, w double").crossJoin(
        spark.range(4000).withColumnRenamed("id", "k"))
    drawn = (weighted_fingerprint.with_draws(terms, F.xxhash64("t"), F.log("w"), {"v": F.col("k")})
             .groupBy("k").pivot("s", ["a", "b"]).agg(F.min("v")))
    keys = a.keys() | b.keys()
    want = sum(min(a.get(t, 0), b.get(t, 0)) for t in keys) / sum(max(a.get(t, 0), b.get(t, 0)) for t in keys)
    assert abs(drawn.where("a = b").count() / 4000 - want) < 0.04


def test_fingerprints_of_odd_rows(odd, empty):
    rows = weighted_fingerprint.edited_pairs(odd).collect()
    assert len(rows) == len(ODD)
    same = {tuple(r.signature) for r in rows if r.doc_id in (1, 6)}
    assert len(same) == 1 and all(len(s) == weighted_fingerprint.SAMPLES for s in same)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert weighted_fingerprint.edited_pairs(empty).count() == 0


# Toxicity, language

def test_toxic_sentence_is_located(spark, empty):
    bags = [(k, "calm words here. " + ("You vile fool!" if k % 3 == 0 else "Kind friend!"), k % 3 == 0)
            for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in bags], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(y)) for k, _, y in bags] + [(1, None), (999, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    text = "All is calm. What a vile fool. Kind words!"
    found = toxicity.score(spark.createDataFrame([(1, text, 9.0), (2, None, 9.0), (3, "", 9.0)],
                                                 "doc_id long, text string, score double"), model).collect()
    assert [r.predicted for r in found] == [1, 0, 0]
    assert [text[s.start:s.end].strip() for s in found[0].offending] == ["What a vile fool"]
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(docs, labels.where("toxic > 7"))
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0


def test_languages_are_told_apart(spark, empty):
    parts = {"aa": "lorem ipsum dolor", "bb": "kwyjibo zzyzx qophs", "cc": "слово дело мир"}
    rows = [(k, f"{text} {k % 7}", lang) for k in range(90) for lang, text in [list(parts.items())[k % 3]]]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "dolor ipsum", "x"), (2, "zzyzx", "x"), (3, "мир", None), (4, None, "x"),
                                 (5, "12 !", "x")], "doc_id long, text string, score string")
    found = language_id.identify(odd, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["aa", "bb", "cc", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found) and found[3].ambiguous
    assert language_id.identify(empty, model).count() == 0
    blank = language_id.fit(odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in language_id.identify(odd, blank).collect()} == {"und"}


def test_more_than_64_languages_are_told_apart(spark):
    import random
    draw = random.Random(5)
    letters = {f"l{n:03d}": "".join(chr(draw.choice(range(0x4E00, 0x9FA0))) for _ in range(12)) for n in range(90)}
    rows = [("".join(draw.choices(own + " ", k=60)), lang) for lang, own in letters.items() for _ in range(12)]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == sorted(letters)
    new = [("".join(draw.choices(own + " ", k=60)), lang) for lang, own in letters.items()]
    found = language_id.identify(spark.createDataFrame(new, "text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 88


def test_a_language_of_copies_is_learned(spark):
    copies = spark.range(200_000).select(F.concat(F.lit("kwyjibo zzyzx qophs"), F.when(F.col("id") < 9, F.lit(" ab"))
                                                  .otherwise(F.lit(""))).alias("text"), F.lit("bb").alias("lang"))
    rows = copies.union(spark.createDataFrame([("слово дело мир", "cc"), ("12 !", "dd")], "text string, lang string"))
    model = language_id.fit(rows)
    assert model.languages == ["bb", "cc"]
    new = spark.createDataFrame([("zzyzx",), ("мир",)], "text string")
    assert [r.lang_pred for r in language_id.identify(new, model).collect()] == ["bb", "cc"]


def test_losses_by_definition():
    draw = np.random.default_rng(3)
    code, trust = language_id.codewords(9), draw.random(63)
    model = language_id.LanguageModel([str(k) for k in range(9)], code, draw.normal(size=(5, 63)), draw.normal(size=63),
                                      trust, 1.0)
    x = draw.normal(size=(4, 5))
    margins = (x @ model.weights + model.bias)[:, None, :] * code[None]
    assert np.allclose(model.losses(x), (np.logaddexp(0, -margins) * trust).mean(axis=2))


def test_codewords_part_every_two_languages():
    for n in (2, 4, 7, 20):
        code = language_id.codewords(n)
        assert len({tuple(row) for row in code}) == n


# Surrogates

KEY = surrogates._derived("test", 0)


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutation_without_fixed_points(size):
    image = [surrogates.permuted(k, size, KEY, "t") for k in range(size)]
    assert sorted(image) == list(range(size)) and all(k != v for k, v in enumerate(image))


def test_surrogates_keep_type_format_and_coreference():
    text = ("Mail a.12@mail3.example.com or A.12@MAIL3.EXAMPLE.COM, (504) 555-0953 = 504-555-0953, 126.40.69.100, "
            "4111 1111 1111 1111, Mr. John Smith, Mrs. Smith, г-жа Анна Иванова, DE89 3704 0044 0532 0130 00")
    new, spans = surrogates.replaced(text, KEY)
    assert [s["kind"] for s in spans] == [k.partition(":")[0] for _, _, k, _ in surrogates.entities(text)]
    parts = [new[s["start"]:s["end"]] for s in spans]
    assert parts[0].upper() == parts[1] and parts[0].endswith("example.com")
    assert re.sub(r"\D", "", parts[2]) == re.sub(r"\D", "", parts[3]) and re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", parts[2])
    card = re.sub(" ", "", parts[5])
    assert surrogates.luhn(card[:-1]) == int(card[-1]) and card[0] == "4"
    assert parts[6].lower() in surrogates.GIVEN["latin", "m"] and parts[7] == parts[8]
    assert parts[9].lower() in surrogates.GIVEN["cyrillic", "f"] and re.fullmatch("[А-Яа-я]+", parts[10])
    for old in ("a.12@mail3", "555-0953", "126.40.69.100", "4111 1111", "Smith", "3704 0044"):
        assert old not in new


@pytest.mark.parametrize("text", [
    "order 9807915762804490 of", "at 1733061600124 ms", "no 4111 1111 1111 1112", "7536784127813051"])
def test_numbers_that_are_no_cards_stay(text):
    assert surrogates.replaced(text, KEY) == (text, [])


@pytest.mark.parametrize("text, card", [
    ("4111 1111 1111 1111 12/27", "4111 1111 1111 1111"), ("no 4111111111111111 123", "4111111111111111"),
    ("99 4111-1111-1111-1111", "4111-1111-1111-1111"), ("3782 822463 10005 77 1", "3782 822463 10005"),
    ("9807915762804490 4845168114407329", "4845168114407329"),
    ("NO12 4111 1111 1111 1111", "4111 1111 1111 1111")])
def test_cards_beside_other_digits_are_found(text, card):
    assert [text[a:b] for a, b, kind, _ in surrogates.entities(text) if kind == "card"] == [card]
    assert card not in surrogates.replaced(text, KEY)[0]


@pytest.mark.parametrize("phone", [
    "+14155552671", "+1 415 555 2671", "+1 (415) 555-2671", "+49 30 12345678", "+49 (0)30 1234-5678", "030 12345678",
    "030/12345678", "(030) 12345678", "0171 1234567", "06 12 34 56 78", "06.12.34.56.78", "0612345678",
    "+33 6 12 34 56 78", "+33612345678", "+4930123456783", "+34 612 345 678", "(504) 555-0953", "504-555-0953"])
def test_phone_formats(phone):
    for text in (f"Bei {phone} oder", phone, f"({phone}), 2024"):
        found = [(text[a:b], kind) for a, b, kind, _ in surrogates.entities(text)]
        assert found == [(phone, "phone")]
        new = surrogates.replaced(text, KEY)[0]
        assert phone not in new and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", text)


def test_phone_numbers_share_surrogates_and_bare_ones_need_a_word():
    forms = [{f for *_, f in surrogates.entities(t)} for t in (
        "+33 6 12 34 56 78", "0033 6 12 34 56 78", "+33612345678 2024", "tel: 33612345678")]
    assert forms == [{"33612345678"}] * 4
    for text in ("Call me at 4155552671.", "Phone number: 4155552671", "Tel. 4155552671"):
        assert "4155552671" not in surrogates.replaced(text, KEY)[0]
    text = "01.02.2024 10:30, 01/02/2024, order 4155552671, at 1733061600, 0.12345678, 007, v1.20.300"
    assert surrogates.replaced(text, KEY) == (text, [])


def test_titled_names_share_surrogates():
    text = "Dr. Anna Weber, Anna Weber, Mrs. Anna Weber, Prof. Xenia Weber, Frau Xenia Weber"
    kinds = [kind for *_, kind, _ in surrogates.entities(text)]
    assert kinds == ["person:f", "person:family"] * 3 + ["person:", "person:family", "person:f", "person:family"]
    new, spans = surrogates.replaced(text, KEY)
    parts = [new[s["start"]:s["end"]] for s in spans]
    assert parts[:2] == parts[2:4] == parts[4:6] and parts[6:8] == parts[8:10]
    assert parts[0].lower() in surrogates.GIVEN["latin", "f"]


def test_names_of_all_roles_are_distinct():
    listed = [n for names in (*surrogates.GIVEN.values(), *surrogates.FAMILY.values()) for n in names]
    short = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    names = [(role, n) for k, n in enumerate(listed + short) for role in [("", "f", "m", "family")[k % 4]]]
    assert len(set(listed)) == len(listed)
    assert len({surrogates.surrogate(f"person:{r}", n, KEY) for r, n in names}) == len(names)


def test_surrogates_of_odd_rows(spark, odd, empty):
    found = surrogates.pseudonymise(odd, "s")
    assert found.count() == len(ODD) and found.columns == [*odd.columns, "entities"]
    assert [r.text for r in found.collect()] == [t for _, t, *_ in ODD]
    assert surrogates.pseudonymise(empty, "s").count() == 0


# Trees, sharding, revisits

def test_best_branch_of_a_tree(spark):
    #      1 -> 2 -> 4      5 is alone      8 <-> 9 is a cycle
    #        -> 3
    rows = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 5.0), (4, 2, 1.0), (5, None, None), (8, 9, 1.0), (9, 8, 1.0)]
    messages = spark.createDataFrame(rows, "node long, parent long, score double")
    best = chat_trees.best_branches(messages).collect()
    assert sorted((r.branch, r.turn, r.node) for r in best) == [(3, 0, 1), (3, 1, 3), (5, 0, 5)]
    two = chat_trees.best_branches(messages, most=2).collect()
    assert sorted((r.branch, r["rank"], r.node) for r in two) == [
        (3, 1, 1), (3, 1, 3), (4, 2, 1), (4, 2, 2), (4, 2, 4), (5, 1, 5)]


def test_conversations_round_trip(spark):
    texts = ["<|end|>", "a\\", "\\l<", "<|turn|>assistant\nhi", "", None, "\\e\\l", "x\n\ny"]
    rows = [(1, k, "assistant" if k % 2 else "us\ner<", t) for k, t in enumerate(texts)]
    rows += [(None, None, None, "t"), (None, None, None, "t"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a")]
    rows += [(3, k, "assistant", str(k)) for k in range(700)]  # over several stretches and segments
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_trees.format_conversations(frame).select(
        "*", chat_trees.read_turns(chat_trees.formatted(F.col("pieces"))).alias("turns"),
        chat_trees.read_loss(F.col("pieces")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [(r, t or "") for c, _, r, t in rows if c == 1]
    assert found[1].loss == "".join(t or "" for c, _, r, t in rows if c == 1 and r == "assistant")
    assert [(t.role, t.text) for t in found[None].turns] == [("", "t"), ("", "t")]
    assert found[2].loss == "ab" and found[3].loss == "".join(map(str, range(700)))
    assert chat_trees.format_conversations(frame.where("turn < -1")).count() == 0


def test_lookup_table_is_even_and_stable(odd, empty):
    names = [f"s{k}" for k in range(10)]
    table = sharding.lookup_table(names, 997)
    held = np.bincount(table, minlength=10)
    assert held.max() - held.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 997)
    moved = sharding.moved_share(table, names, fewer, names[:-1])
    assert 0.1 <= moved < 0.25
    heavy = np.bincount(sharding.lookup_table(["a", "b"], 997, [3, 1]))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    placed = sharding.place(odd, names, slots=997).collect()
    assert len(placed) == len(ODD) and all(table[r.slot] == r.shard for r in placed)
    assert len({r.shard for r in placed if r.doc_id is None}) == 1
    assert sharding.place(empty, names, slots=997).count() == 0


def test_revisits_by_walking(spark):
    rng = np.random.default_rng(9)
    urls = ["http://www.A.com/x/?b=2&a=1&utm_x=1#f", "https://a.com/x?a=1&b=2", "http://b.com", "ftp://c", None]
    rows = []
    for k in range(300):
        revisit = bool(rng.random() < 0.5)
        tag = None if rng.random() < 0.3 else f'"{int(rng.integers(2))}"'
        rows.append((k, urls[int(rng.choice(5, p=[.4, .3, .1, .1, .1]))], int(rng.integers(150)), revisit,
                     f"d{k}", [("ETag", tag), ("Date", str(k)), ("X", "1")]))
    frame = spark.createDataFrame(rows, "record_id long, url string, ts long, revisit boolean, digest string, "
                                        "headers array<struct<name:string,value:string>>")
    got = {r.record_id: r for r in warc_revisit.resolve_revisits(frame).collect()}
    canon = {urls[0]: "a.com/x?a=1&b=2", urls[1]: "a.com/x?a=1&b=2", urls[2]: "b.com", urls[3]: "ftp://c"}
    assert len(got) == sum(r[3] for r in rows)
    for k, url, ts, revisit, _, headers in rows:
        if not revisit:
            continue
        base = max((r for r in rows if not r[3] and url and r[1] and canon[r[1]] == canon[url] and r[2] <= ts),
                   key=lambda r: (r[2], r[0]), default=None)
        assert got[k].base_id == (base and base[0])
        own, theirs = headers[0][1], base and base[5][0][1]
        want = "orphan" if base is None else "mismatch" if own and theirs and own != theirs else "resolved"
        assert got[k].outcome == want
        if want == "resolved":
            merged = {h.name: h.value for h in got[k].headers}
            assert merged["date"] == str(k) and merged.get("etag") == (own or theirs) and got[k].digest == base[4]
    assert warc_revisit.resolve_revisits(frame.where("ts < 0")).count() == 0


# The pipeline

def test_pipeline_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(
            stage(spark, kept, sf_dir).toPandas(), docs.schema)
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.collect()}
        rows = before.collect()
        if name == "language_id":
            assert ids == {r.doc_id for r in rows if any(map(str.isalpha, r.text or ""))}
        elif name == "simhash_dedup":
            fps = [(r.doc_id, simhash.fingerprint(r.text)) for r in rows]
            assert ids == set(brute_components(fps))
        elif name == "surrogates":
            assert ids == {r.doc_id for r in rows}
            texts = {r.doc_id: r.text for r in kept.collect()}
            for r in rows:
                for start, end, _, _ in surrogates.entities(r.text):
                    assert r.text[start:end] not in texts[r.doc_id]
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
