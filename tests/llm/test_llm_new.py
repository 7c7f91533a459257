"""Streaming BPE, bracketed resampling and the rotated centroid filter against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from feedmill.llm import bpe, centroids, resampling
from feedmill.llm.queries import MERGES, QUERIES

TEXTS = [
    (1, "Hello there, it's THE   end<|endoftext|>of 123 Wörlds"), (1, "Hello there, it's THE   end<|endoftext|>of 123 Wörlds"),
    (2, None), (3, ""), (4, " \n\t "), (5, "x" * 200_000), (6, "the ing exhilarating " * 20_000), (7, "exhilarating" * 9_000),
    (8, "ΟΔΟΣ İstanbul ﬁ é é 日本語 \U0001f642‍\x1c\x85end"), (None, "no id at all here"), (9, "a<|b|> <|startoftext|<|startoftext|>"),
]
CLASHES = ["_doc", "_ids", "_text", "_words", "_score", "_rank", "_key", "_x", "_cluster", "rank", "n_tokens", "weight"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(MERGES)


# --- op11 ---------------------------------------------------------------------


def test_op11(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_stream_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_encode_edges(spark, docs, library):
    more = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES if not c.startswith("_ids")})
    got = bpe.encode(more.drop("_ids"), MERGES).collect()
    assert len(got) == len(TEXTS) and all(r["_doc"] == "own _doc" and r["_text"] == "own _text" for r in got)
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["_ids"]) == ids and r["_decoded"] == library.decode(ids, skip_special_tokens=False)
        assert bytes(r["_packed"]) == np.array(ids, "<u4").tobytes()
    assert bpe.encode(docs.limit(0), MERGES).collect() == []
    back = bpe.decode(bpe.encode(docs, MERGES).select("doc_id", "_ids"), MERGES, "_ids", form="text").collect()
    assert {r["decoded"] for r in back if r["doc_id"] == 1} == {"hello there , it 's the end <|endoftext|>of 1 2 3 wörlds "}


def small_model(merges):
    """A model over the letters a to d with the given merge list."""
    letters = "abcd"
    tokens = [*letters, *(c + bpe.END for c in letters), *dict.fromkeys(u + v for u, v in merges)]
    ids = {t: i for i, t in enumerate(tokens)}
    rules = {ids[u] << bpe.BITS | ids[v]: rank << bpe.BITS | ids[u + v] for rank, (u, v) in enumerate(merges)}
    first = [ids.get(chr(b), 0) for b in range(256)]
    last = [ids.get(chr(b) + bpe.END, 4) for b in range(256)]
    width = max(len(t.removesuffix(bpe.END)) for t in tokens)
    return bpe.Model(tokens, rules, first, last, {}, bpe.lookahead(merges), width)


def test_lookahead_suffices():
    """Random merge lists: whatever is cut off, the streamed tokens are those of merging the whole unit rule by rule."""
    rng = random.Random(4)
    for _ in range(60):
        tokens, merges = list("abcd"), []
        while len(merges) < 25:
            u, v = rng.choice(tokens), rng.choice([*tokens, *(t + bpe.END for t in "abcd")])
            if len(u + v) < 12 and u + v not in tokens and (u + v).removesuffix(bpe.END) + "!" not in tokens:
                if not any(x + y == u + v for x, y in merges):
                    merges.append((u, v))
                    if not v.endswith(bpe.END):
                        tokens.append(u + v)
        model = small_model(merges)
        for n in (1, 2, 30, 700):
            unit = "".join(rng.choice("abcd"[: rng.randrange(1, 5)]) for _ in range(n))
            parts = [*unit[:-1], unit[-1] + bpe.END]
            for u, v in merges:
                i = 0
                while i + 1 < len(parts):
                    if (parts[i], parts[i + 1]) == (u, v):
                        parts[i : i + 2] = [u + v]
                    i += 1
            steps = bpe.Transducer(model)
            out, at = [], 0
            while at < n:
                step = rng.randrange(1, 40)
                out += steps.feed(unit[at : at + step].encode())
                assert len(steps.held) < steps.window + 40
                at += step
            out += steps.close()
            assert [model.tokens[i] for i in out] == parts, (merges, unit)
            assert steps.unit(unit.encode()) == out


def test_lookahead_of_a_chain():
    """Each rule hands the front on to the next; the bound is the length of the chain and the end mark."""
    assert bpe.lookahead([("a", "b")]) == 2
    assert bpe.lookahead([("b", "a"), ("c", "b"), ("d", "c")]) == 4
    assert bpe.lookahead([("c", "b"), ("b", "a")]) == 2
    with pytest.raises(ValueError, match="out of order"):
        bpe.lookahead([("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError, match="out of order"):
        bpe.lookahead([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])


def test_memory_is_bounded():
    model = bpe.load(MERGES)
    few, many = bpe.Encoder(model, most=3), bpe.Encoder(model)
    text = "one two three four five, one two! six seven eight nine ten one " * 3
    assert few.encode(text) == many.encode(text) and len(few.young) <= 3 and len(few.old) <= 3


def test_decoder_is_incremental():
    model = bpe.load(MERGES)
    encoder = bpe.Encoder(model)
    for text in ("naïve 日本 \U0001f642 z", "\U0001f642" * 9, "", "a" * 50):
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        for form in ("surface", "text"):
            steps = bpe.Decoder(model, form)
            assert "".join([*(steps.feed([i]) for i in ids), steps.close()]) == bpe.decode_ids(ids, model, form)
    # Half a character: kept back, then replaced at the end.
    steps = bpe.Decoder(model, "text")
    assert steps.feed([model.first[0xE6]]) == "" and steps.feed([model.first[0x97], model.last[0xA5]]) == "日 "
    assert steps.feed([model.first[0xF0]]) == "" and steps.close() == "�"


# --- op12 ---------------------------------------------------------------------


def plain_draw(docs, target, percent, least_words, seed=42):
    def features(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c if c > "\x7f" or c.isdigit() or "a" <= c <= "z" else " " for c in text or "").split(" ")
        w = [x for x in w if x]
        return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text)[1]:
                counts[bucket(f)] += 1
    out = []
    for i, (key, text) in enumerate(docs):
        n, f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (s.sum() + 10_000) / ((s[b] + 1.0) * (t.sum() + 10_000)))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, key, len(f), weight, score, n))
    inside = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[4], r[1] is None, r[1], r[3]))
    place = {r[0]: i + 1 for i, r in enumerate(inside[: percent * len(inside) // 100])}
    return sorted((r[1:5] + (place.get(r[0]),) for r in out), key=repr)


def drawn(docs, target, **kw):
    rows = resampling.draw(docs, target, **kw).collect()
    return sorted(((r["doc_id"], r["_features"], r["_weight"], r["_score"], r["_rank"]) for r in rows), key=repr)


@pytest.mark.parametrize("accuracy", [10_000, 3])
def test_draw(spark, accuracy):
    """Ties, nulls, repeated rows, long texts; a coarse sketch only widens the bracket."""
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "Beta", "gam-ma", "é", "9", "x_y"])
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(None, "alpha beta " * 30), (None, "alpha beta " * 30), (7, "alpha " * 25), (7, "alpha " * 25), (500, None), (501, ""), (502, "é " * 70_000)]
    target = ["alpha beta gamma", "Beta 9", None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = spark.createDataFrame([(x,) for x in target], "text string")
    for percent, least in ((5, 20), (100, 0), (50, 1)):
        assert drawn(df, want, percent=percent, least_words=least, accuracy=accuracy) == plain_draw(rows, target, percent, least)


def test_draw_edges(spark, docs):
    target = spark.createDataFrame([("the end",)], "text string")
    more = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES if c not in ("_words", "_score", "_rank")})
    rows = resampling.draw(more, target, percent=50, least_words=1).collect()
    assert len(rows) == len(TEXTS) and all(r["_key"] == "own _key" and r["rank"] == "own rank" for r in rows)
    assert sorted(r["_rank"] for r in rows if r["_rank"]) == list(range(1, sum(bool(plain.words(t)) for _, t in TEXTS) // 2 + 1))
    assert all(r["_weight"] == r["_features"] == 0 for r in rows if not plain.words(r["text"]))
    for none in (docs.limit(0), docs.filter("doc_id = 3")):
        assert all(r["_rank"] is None for r in resampling.draw(none, target).collect())
    assert resampling.draw(docs, target.limit(0), percent=100, least_words=0).filter("_rank is null").count() == 0


def test_only_the_bracket_is_sorted(spark):
    rows = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(10_000_000)).alias("s"))
    low, high, above = resampling.bracket(rows, "s", 10_000, 200_000)
    inside = rows.filter(F.col("s").between(low, high)).count()
    assert above < 10_000 <= above + inside and inside < 400


# --- op13 ---------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dims, scale, seed):
    kept = [(key, [math.floor(scale * float(x)) for x in v]) for key, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = lambda key: hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (named(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def place():
        return [min(range(len(centers)), key=lambda c: (far(v, centers[c]), c)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for c in set(at):
            own = [v for (_, v), a in zip(kept, at) if a == c]
            centers[c] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    away = [far(v, centers[a]) for (_, v), a in zip(kept, at)]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(
        ((key, a, d, sum(e for e, b in zip(away, at) if b == a), sum(away), name[a]) for (key, _), a, d in zip(kept, at, away)), key=repr
    )


def clustered(df, **kw):
    rows = centroids.cluster(df, **kw).collect()
    return sorted(((r["vec_id"], r["_cluster"], r["_distance"], r["_cluster_inertia"], r["_inertia"], r["_centroid_sha256"]) for r in rows), key=repr)


def test_clusters(spark):
    """Ties on a grid, repeated rows, vectors to leave out, fewer vectors than clusters, an empty table."""
    rng = random.Random(8)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.randrange(-3, 4) / 4 + (0.0 if i % 3 else rng.random()) for _ in range(6)]) for i in range(300)]
    rows += [rows[4], rows[4], (None, rows[9][1]), (None, rows[10][1]), (400, None), (401, []), (402, [1.0] * 5), (403, [nan] * 6)]
    rows += [(404, [inf, *[0.0] * 5]), (405, [None, *[0.0] * 5]), (406, [-1e5] * 6), (407, [1e5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    more = df.withColumns({c: F.lit(f"own {c}") for c in CLASHES if c != "_cluster"})
    for k, rounds in ((7, 4), (1, 2), (40, 0), (500, 1)):
        kw = {"k": k, "rounds": rounds, "dims": 6, "scale": 16.0}
        assert clustered(more, **kw) == plain_clusters(rows, k, rounds, 6, 16.0, 2), k
    assert centroids.cluster(more, k=3, dims=6).select("_x", "_doc").first()["_doc"] == "own _doc"
    assert centroids.cluster(df.limit(0), dims=6).collect() == [] and centroids.cluster(df, dims=9).collect() == []
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], df.schema), dims=2).collect()


def test_filter_spares_comparisons():
    """Vectors near a few directions: the bound leaves few centroids, and never the nearest one out."""
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 64)) * 300 + rng.normal(size=(3000, 64)) * 20).astype(np.int64)
    c = x[:40]
    axes, lead = centroids.rotation(np.cov(x.astype(float).T))
    mean = x.mean(axis=0)
    args = (*centroids.rotated(x.astype(float), mean, axes, lead), c, *centroids.rotated(c.astype(float), mean, axes, lead))
    choice, distance, compared = centroids.nearest(x, *args)
    whole = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (choice == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert lead <= 32 and compared < 0.1 * whole.size
