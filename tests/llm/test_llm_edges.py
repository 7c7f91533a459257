"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

from __future__ import annotations

import corpus_pipeline
import plain
import pytest
from pyspark.sql import functions as F

from feedmill.llm import chat, embeddings, line_dedup, mixing, pages, pieces, pii, quality, sharding, simhash
from feedmill.llm.common import store
from feedmill.llm.queries import PIECES

PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, "one two three four five six seven " * 12, "en", "a"),
    (2, "one two three four five six seven " * 12, "en", "a"),
    (2, "one two three four five six seven " * 12, "en", "a"),  # a repeated row
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t ", "en", "b"),
    (6, "x" * 200_000, "de", "b"),
    (7, "a b c d e f g h i j k l m n o p " * 4000, "de", "c"),
    (8, f"start\n{PASSAGE}\nend", "en", "c"),
    (9, f"other start\n{PASSAGE}\nother end", "en", "c"),
    (10, "café \U0001f642 ▁ mark\nline two | $$ ##", "fr", "a"),
    (None, "no id at all here", "fr", "a"),
]
CLASHES = ["size", "target", "fp", "hash", "rank", "component_id", "_key", "_text", "_w", "_n", "_own", "quality"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="module")
def stage_dir(spark, tmp_path_factory):
    """Labels for the stages; texts of the documents do not matter to them."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (7, 1, 1)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns(spark, docs, stage_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, stage_dir)
        assert got.columns == docs.columns, name
        assert got.schema.simpleString() == docs.schema.simpleString(), name
        rows = got.collect()
        assert all(r[c] == f"own {c}" for r in rows for c in CLASHES), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, stage_dir)
    assert last.count() == len(TEXTS)


def test_stages_on_no_rows(spark, docs, stage_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), stage_dir).collect() == [], name


def test_quality(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.report(docs, labels).collect()
    assert len(rows) == len(TEXTS)
    by_id = {t[0]: t[1] for t in TEXTS}
    for r in rows:
        text = by_id[r["doc_id"]]
        got = tuple(r[f"_q_{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == plain.base_counts(text)
        assert r["_base"] == plain.base_failed(text) and r["_kept"] == (not r["_base"])


def test_line_dedup(docs):
    rows = {(r["doc_id"], r["_removed"]): r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[8, 0] == f"start\n{PASSAGE}\nend"
    assert rows[9, 1] == "other start\nother end"
    assert rows[3, 0] is None and rows[4, 0] == "" and rows[5, 0] == " \n\t "
    # The second of two equal texts is cut, and its repeated row alike.
    assert rows[2, 1] == "" and (1, 0) in rows


def test_chunks_resist_shifts():
    lines = [f"line {i} with some words that make it count {i * i}" for i in range(60)]
    a = {c[2] for c in line_dedup.chunks("\n".join(lines), False)}
    b = {c[2] for c in line_dedup.chunks("\n".join(["an inserted line of the other text", *lines]), False)}
    assert len(a & b) >= len(a) - 2 and len(a) > 10


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {t[0]: t[1] for t in TEXTS}
    got = {r["doc_id"]: r for r in rows}
    for key, r in got.items():
        assert r["fp"] & (2**64 - 1) == plain.fingerprint(by_id[key])
    # Texts without words are linked like any other.
    assert [got[k]["component_id"] for k in (3, 4, 5)] == [3, 3, 3]
    assert got[2]["component_id"] == 1 and got[None]["component_id"] is None
    # Both around the same passage.
    assert (plain.fingerprint(by_id[8]) ^ plain.fingerprint(by_id[9])).bit_count() <= 4
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == {1, 3, 6, 7, 8, 10, None}


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS)
    sizes = {}
    for t in TEXTS:
        sizes[t[3]] = sizes.get(t[3], 0) + len(plain.words(t[1]))
    want = plain.targets(sizes)
    for r in rows:
        m = r["_mix"]
        assert m["target"] == pytest.approx(want[r["source"]])
        assert m["taken"] == m["copies"] * m["size"] <= 2 * m["size"]
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs).collect()))


def test_weighted_mixing(spark):
    """Inclusion follows the weights, and no weight means never."""
    rows = [(i, "word " * 10, "s", float(i % 4)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    got = mixing.mix(df, weights=[1.0], share=0.3, weight="w").collect()
    taken = [sum(r["_mix"]["copies"] for r in got if r["w"] == w) for w in (0.0, 1.0, 2.0, 3.0)]
    assert taken[0] == 0 and sum(taken) == 1200
    assert taken[1] == pytest.approx(200, abs=45) and taken[2] == pytest.approx(400, abs=55) and taken[3] == pytest.approx(600, abs=60)


def test_sharding(docs):
    rows = sharding.assign(docs, 4, [1.0, 2.0, 1.0, 4.0]).collect()
    assert len(rows) == len(TEXTS)
    for s in range(4):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in rows)
    by_id = {t[0]: t[1] for t in TEXTS}
    assert all(r["text_crc32"] == plain.crc(by_id[r["doc_id"]]) for r in rows)


def test_shards_follow_weights(spark):
    df = spark.range(40_000).select(F.col("id").alias("k"))
    counts = dict(df.select(sharding.rendezvous(F.col("k"), 3, [1.0, 2.0, 5.0]).alias("s")).groupBy("s").count().collect())
    for s, w in enumerate((1, 2, 5)):
        assert counts[s] / 40_000 == pytest.approx(w / 8, abs=0.01)


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "s"), 3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(TEXTS)


def test_pieces(docs):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode(docs, PIECES, hot=20).collect()
    assert len(rows) == len(TEXTS)
    by_id = {t[0]: t[1] for t in TEXTS}
    for r in rows:
        text = by_id[r["doc_id"]] or ""
        assert list(r["ids"]) == sp.encode(text)
        assert r["decoded"] == text.replace("▁", " ")
    again = pieces.decode(pieces.encode(docs, PIECES, hot=5).select("doc_id", "ids", F.col("decoded").alias("d")), PIECES)
    assert again.filter("d <> decoded").count() == 0


def test_pieces_of_a_unigram_model(spark, tmp_path):
    """The same pieces as a unigram model: the fold is Viterbi then."""
    sp = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for i, p in enumerate(model.pieces):
        if p.type == 1:
            p.score = -7.0 - (i * 2654435761 % 4096) / 1024.0
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    lib = sp.SentencePieceProcessor(model_file=path)
    texts = ["the quick brown fox jumps", "internationalisation, unbelievable!", "zweihundert Euro und mehr", "aaaaaaa bbb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encode(df, path, hot=3).collect():
        assert list(r["ids"]) == lib.encode(texts[r["doc_id"]])
    assert pieces.encode_long("▁internationalisation", pieces.load(path)) == lib.encode("internationalisation")


def test_pii(docs, spark):
    texts = ["card 4041894974608795 and 4041-8949-7460-8795, not 4041894974608796", "4041894974608795", "on 1987-02-28 or 1987-02-30", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_n", F.lit(1))
    rows = {r["doc_id"]: r for r in pii.pseudonymize(df, "k").collect()}
    linked = rows[1]["text"]
    assert linked != "4041894974608795" and rows[0]["text"].startswith(f"card {linked} and {linked[:4]}-{linked[4:8]}-")
    assert rows[0]["text"].endswith("not 4041894974608796") and rows[2]["text"].endswith("or 1987-02-30")
    assert rows[3]["text"] is None and rows[4]["text"] == "" and rows[0]["_n"] == 1
    assert len(rows[0]["_values"]) == 2 and pii.pseudonymize(df, "other").collect()[1]["text"] != linked
    assert pii.pseudonymize(docs, "k").count() == len(TEXTS)


def test_feistel_is_one_to_one(spark):
    pairs = spark.range(12 * 35).select((F.col("id") % 12).alias("x"), F.floor(F.col("id") / 12).alias("y"))
    image = pii.feistel(F.col("x"), F.col("y"), F.lit(12), F.lit(35), "k", F.lit("t"))
    got = pairs.select(image.alias("i")).select("i.*").distinct()
    assert got.count() == 12 * 35 and got.filter("x < 0 or x >= 12 or y < 0 or y >= 35").count() == 0


def test_pseudonyms_stay_valid(spark):
    values = ["4111111111111111", "DE89 3704 0044 0532 0130 00", "FR1420041010050500013M02606", "212-555-0100", "+1 (212) 555-0100", "+49 30 1234567", "10.1.2.3", "123-45-6789", "2001-02-03", "03.02.2001", "25/12/2001"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    once = store(pii.pseudonymize(df, "k"), "once")
    twice = pii.pseudonymize(once.drop("_values"), "k")
    assert {r["doc_id"] for r in twice.collect() if len(r["_values"]) == 1} == set(range(len(values)))
    shape = F.regexp_replace("text", "[0-9]", "0")
    kept = {r[0]: r[1] for r in once.select("doc_id", shape).collect()}
    assert all(kept[i] == "".join("0" if c.isdigit() else c for c in v) for i, v in enumerate(values) if v != "10.1.2.3")


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "bot", "hello"),
        (2, 0, "user", "hi"), (2, 1, "bot", "hello"), (2, 2, "user", "more <|im_end|>"),
        (3, 0, "user", "hi"), (3, 1, "bot", "hello"), (3, 2, "user", "more <|im_end|>"), (3, 2, "user", "more <|im_end|>"),
        (4, 0, None, "x"), (5, 0, "x", None), (None, 0, "user", "hi"), (6, None, "user", "lost"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.render(df.withColumn("_c", F.lit(0))).collect()}
    assert set(got) == {2, 4, 5, 6} and got[2]["n_equal"] == 2 and got[2]["n_turns"] == 3
    assert got[2]["text"].endswith("<|im_start|>user\nmore < |im_end|><|im_end|>\n")
    assert got[4]["text"] == "<|im_start|>unknown\nx<|im_end|>\n" and got[5]["text"] == "<|im_start|>x\n<|im_end|>\n"
    assert chat.render(df.limit(0)).collect() == []


def test_long_conversation(spark):
    """A conversation over many blocks, and a prefix of it that ends inside a later one."""
    n, part = 2600, 2100
    turns = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    both = turns.unionByName(turns.filter(f"turn < {part}").withColumn("conv_id", F.lit(2).cast("long")))
    both = both.select("*", F.lit("user").alias("role"), F.concat(F.lit("t"), "turn").alias("text"))
    got = chat.render(both).orderBy("part").collect()
    assert {r["conv_id"] for r in got} == {1} and [r["part"] for r in got] == list(range(-(-n // 256)))
    whole = "".join(r["text"] for r in got)
    assert whole == "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(n))


def test_embeddings(spark):
    rows = [
        (1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0, -0.0]), (3, [1.0, 0.1, 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0, 0.0]),
        (6, [1.0, None, 0.0, 0.0]), (7, [float("nan"), 0.0, 0.0, 1.0]), (8, [float("inf"), 0.0, 0.0, 1.0]),
        (9, [0.0, 0.0, 1.0, 0.0]), (10, [1.0, 0.0, 0.0, 0.0]), (11, []), (12, [0.0, 1e-30, 0.0, 0.0]), (13, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("own"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df).collect()}
    assert got == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 10: (3, 1), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9),
        11: (0, 11), 12: (0, 12), 13: (0, 13),
    }
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_pages(spark):
    site = (
        "<html><head><title>T</title></head><body><nav><a href=/>home</a></nav><article><h1>Head &amp; line</h1>"
        "<p>One  two&nbsp;three,<br>four and some more words of text.<p>Second part that is long enough to be one."
        "<div class='comments'><p>Nice text, I have read all of it twice, thank you.</p></div></article>"
        "<footer>2020</footer></body></html>"
    )
    rows = [(1, "u", site), (1, "u", site), (2, None, None), (3, "u", ""), (4, "u", "<" * 300_000), (5, "u", "<div>" * 30_000 + "</p><li>" * 30_000 + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = {r["page_id"]: r for r in pages.extract(df).collect()}
    assert got[1]["text"] == (
        "Head & line\n\nOne two three, four and some more words of text.\n\nSecond part that is long enough to be one."
    )
    assert got[1]["n_chars"] == len(got[1]["text"]) and [got[k]["text"] for k in (2, 3)] == ["", ""]
    assert pages.extract(df.limit(0)).collect() == []


def test_marginals_are_exact():
    """Against all label assignments of a small tree."""
    import itertools
    import math

    parents, scores, pair = [-1, 0, 0, 1, 1], [0.3, -1.0, 0.7, 2.0, -0.4], [0.5, -0.2, 0.1, 0.9]
    total, ones, joint = 0.0, [0.0] * 5, [0.0] * 4
    for y in itertools.product((0, 1), repeat=5):
        w = math.exp(sum(s for s, v in zip(scores, y) if v) + sum(pair[2 * y[parents[i]] + y[i]] for i in range(1, 5)))
        total += w
        for i in range(5):
            ones[i] += w * y[i]
        for i in range(1, 5):
            joint[2 * y[parents[i]] + y[i]] += w
    chance, expected = pages.marginals(parents, scores, pair)
    assert chance == pytest.approx([v / total for v in ones])
    assert expected == pytest.approx([v / total for v in joint])


def test_binomial(spark):
    from math import comb

    rows = [(0, 10), (3, 40), (9, 200), (50, 900)]
    df = spark.createDataFrame(rows, "k long, n long")
    for r in df.withColumn("p", quality.binomial_cdf(F.col("k"), F.col("n"), 0.05)).collect():
        want = sum(comb(r["n"], i) * 0.05**i * 0.95 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == pytest.approx(want, rel=1e-9)


def test_thresholds(spark):
    """A stratum with enough good documents gets cutoffs, one with a few does not."""
    good = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"w{i}$$$" for i in range(80))
    rows = [(i, f"{good} n{i}", "en") for i in range(900)] + [(2000 + i, f"{good} n{i}", "fr") for i in range(50)]
    rows += [(5000, junk, "en"), (5001, junk, "fr"), (5002, junk, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = df.filter("doc_id < 5000").select("doc_id", F.lit(1).alias("quality"))
    lost = {r["doc_id"] for r in quality.judge(df, labels).filter("not _kept").collect()}
    assert lost == {5000}
