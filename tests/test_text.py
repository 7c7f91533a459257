"""Edge rows of validation, normalisation and byte cutting; a plain spec on random texts."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.operators import validation

VALIDATE = [
    (None, ["empty_review"]),
    ("   ", ["empty_review"]),
    ("\u001c\u00a0\u3000", ["empty_review"]),
    ("ok", ["too_short"]),
    ("123456789", ["too_short"]),
    ("1234567890", []),
    ("a " * 5001, ["too_long", "low_vocabulary_diversity"]),
    ("<p><br></p>", ["content_is_urls_or_html_only"]),
    ("www.example.com/x", ["content_is_urls_or_html_only"]),
    ("<b>", ["too_short", "content_is_urls_or_html_only"]),
    ("good " * 5, []),
    ("good " * 6, ["low_vocabulary_diversity"]),
    ("Good good GOOD good good good", ["low_vocabulary_diversity"]),
]

NORMALIZE = [
    (None, ""),
    ("Great!!! Really... ok..", "Great! Really. ok.."),
    ("<b>Hi</b>  there", "Hi there"),
    ("see HTTPS://a.b/c?d now www.x.y end", "see now end"),
    ("a\U0001f600\U0001f600b", "a b"),
    ("why \U0001f914 not", "why \U0001f914 not"),
    ("\u65e5\u672c\u8a9e text", "text"),
    ("\u2615 time", "time"),
    ("&amp;lt;b&amp;gt; &LT;", "<b> &LT;"),
    ("&lt;b&gt;x", "<b>x"),
    ("Cafe\u0301", "Caf\u00e9"),
    ("\u001c\u00a0x\u3000", "x"),
    ("a\t\tb", "a\t\tb"),
    ("a\n\n\n\nb", "a\n\nb"),
    ("x ---- y", "x - y"),
    ("a&nbsp;&nbsp;b", "a b"),
    ("1 < 2 and 3 > 2", "1 2"),
    ("wait!?!?", "wait!?!?"),
]

HTML = re.compile(r"<[^>]+>")
URL = re.compile(r"https?://\S+|www\.\S+", re.I)
EMOJI = re.compile("[\u24c2-\U0001f251\U0001f300-\U0001f64f\U0001f680-\U0001f6ff]+")
PUNCT = re.compile(r"([!?.,;:-])\1\1+")


def plain_normalize(text):
    """Our own statement of the cleaning steps, for random texts."""
    text = unicodedata.normalize("NFC", text or "")
    for pattern in (HTML, URL, EMOJI):
        text = pattern.sub(" ", text)
    for entity, char in tx.ENTITIES:
        text = text.replace(entity, char)
    text = PUNCT.sub(lambda m: m.group(1), text)
    text = re.sub("  +", " ", text)
    return re.sub("\n\n\n+", "\n\n", text).strip()


def plain_issues(text):
    if text is None or not text.strip():
        return ["empty_review"]
    text = text.strip()
    clean = URL.sub(" ", HTML.sub(" ", text)).strip()
    words = clean.lower().split()
    found = {
        "too_short": len(text) < 10,
        "too_long": len(text) > 10_000,
        "content_is_urls_or_html_only": not clean,
        "low_vocabulary_diversity": bool(words) and len(set(words)) / len(words) < 0.2,
    }
    return [name for name, hit in found.items() if hit]


def apply(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(make(df).collect())]


def random_texts(n, seed=11):
    rng = random.Random(seed)
    pieces = list("aB1 .!?-,;:<>&\n\t") + [
        "  ", "...", "!!!", "<b>", "</i>", "http://x.y/z ", "WWW.a.b ", "&amp;", "&lt;", "&nbsp;", "---",
        "\u00e9", "e\u0301", "\u00a0", "\u2003", "\u3000", "\U0001f600", "\u65e5", "\u2615", "\u212b", "\uac00",
        "\u1100\u1161", "\u0958", "\x1c", "\x85", "word ", "word ",
    ]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_validate_edges(spark):
    got = apply(spark, [t for t, _ in VALIDATE], lambda d: validation.validate(d, "t").select("i", "issues"))
    assert got == [issues for _, issues in VALIDATE]


def test_null_issue_option(spark):
    got = apply(spark, [None, " "], lambda d: validation.validate(d, "t", null_issue="too_short").select("i", "issues"))
    assert got == [["too_short"], ["empty_review"]]


def test_invalid_encoding(spark):
    df = spark.createDataFrame([(bytearray(b"good text \xff\xfe here"),), (bytearray(b"good text as it is"),)], "b binary")
    rows = validation.validate(df.select(F.col("b").cast("string").alias("t")), "t").select("issues").collect()
    assert sorted(r.issues for r in rows) == [[], ["invalid_encoding"]]


def test_normalize_edges(spark):
    got = apply(spark, [t for t, _ in NORMALIZE], lambda d: d.select("i", tx.normalize_text(F.col("t")).alias("n")))
    assert got == [want for _, want in NORMALIZE]


def test_narrow_emoji_class_keeps_scripts(spark):
    got = apply(spark, ["\u65e5\u672c \U0001f600"], lambda d: d.select("i", tx.normalize_text(F.col("t"), "narrow").alias("n")))
    assert got == ["\u65e5\u672c"]


def test_random_texts_match_plain_spec(spark):
    texts = random_texts(800)
    got = apply(spark, texts, lambda d: d.select("i", tx.normalize_text(F.col("t")).alias("n")))
    assert got == [plain_normalize(t) for t in texts]
    got = apply(spark, texts, lambda d: validation.validate(d, "t").select("i", "issues"))
    assert got == [plain_issues(t) for t in texts]


def test_normalize_is_idempotent_without_entities(spark):
    texts = [t.replace("&", "") for t in random_texts(300, seed=5)]
    once = [plain_normalize(t) for t in texts]
    stable = [t for t in once if plain_normalize(t) == t]
    got = apply(spark, stable, lambda d: d.select("i", tx.normalize_text(F.col("t")).alias("n")))
    assert got == stable and len(stable) > 200


def test_characters_spared_the_nfc_function_are_stable():
    """No spared character changes under NFC, alone or behind a base character."""
    spared = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), tx._NFC_STABLE) + "]")
    seconds = set()
    for code in range(0x110000):
        char = chr(code)
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    for code in range(0x30000):
        char = chr(code)
        if spared.match(char):
            assert unicodedata.is_normalized("NFC", char), hex(code)
            assert unicodedata.combining(char) == 0 and char not in seconds, hex(code)


@pytest.mark.parametrize(
    ("text", "limit"),
    [
        ("a" * 4999 + "\u00e9", 5000),
        ("aa\U0001f600b", 5),
        ("aa\U0001f600b", 6),
        ("aa\ufffd\U0001f600", 7),
        ("\u65e5\u672c\u8a9e", 4),
        ("short", 5000),
        ("", 3),
    ],
)
def test_truncate_bytes(spark, text, limit):
    got = apply(spark, [text], lambda d: d.select("i", tx.truncate_bytes(F.col("t"), limit).alias("n")))
    assert got == [text.encode()[:limit].decode(errors="ignore")]


def test_summary_of_empty_table_and_of_files_without_rows(spark):
    empty = validation.validate(spark.createDataFrame([], "source_key string, t string"), "t")
    row = validation.validation_summary(empty, by=()).collect()[0].asDict()
    assert row == {
        "total_rows": 0, "valid_rows": 0, "invalid_rows": 0, "quality_score": 0.0,
        "validation_issues": {"no_content_found": 1},
    }
    rows = validation.validate(spark.createDataFrame([("a", "a good long text"), ("a", "no")], "source_key string, t string"), "t")
    files = spark.createDataFrame([("a",), ("b",)], "source_key string")
    got = {r.source_key: r for r in validation.validation_summary(rows, files=files).collect()}
    assert got["a"].quality_score == 50.0 and got["a"].validation_issues == {"too_short": 1}
    assert got["b"].total_rows == 0 and got["b"].validation_issues == {"no_content_found": 1}


def test_golden_score(spark):
    rows = spark.range(1465).selectExpr("'f' as source_key", "case when id < 931 then 'a text that is fine' else 'x' end as t")
    got = validation.validation_summary(validation.validate(rows, "t")).collect()[0]
    assert (got.valid_rows, got.invalid_rows, got.quality_score) == (931, 534, 63.55)


def test_tags_without_an_end_are_linear(spark):
    """Nothing behind the last closing bracket is searched."""
    import time

    df = spark.range(1).selectExpr("repeat('<', 1000000) as a", "concat('<b>x</b> ', repeat('<', 1000000)) as b")
    start = time.perf_counter()
    row = df.select(*[tx.strip_html(F.col(c)).alias(c) for c in ("a", "b")]).collect()[0]
    assert time.perf_counter() - start < 5
    assert row.a == "<" * 1000000 and row.b == " x  " + "<" * 1000000
