"""Every query of the package against a plain version or its SQL twin."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import oracle
import plain
import pytest

from feedmill.llm import quality, queries
from feedmill.llm.common import store


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def rows(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    problem = oracle.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert problem is None, problem


def test_op1(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op1_pareto_mix")
    sizes, taken, largest = {}, {}, {}
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == len(plain.words(docs[r["doc_id"]]["text"]))
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    want = plain.targets(sizes)
    assert len(got) == len(docs)
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest[s]


def test_op3(spark, sf_dir, docs):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=queries.PIECES)
    got = rows(spark, sf_dir, "op3_piece_lattice")
    assert len(got) == len(docs)
    assert all(r["round_trip"] and list(r["ids"]) == lib.encode(docs[r["doc_id"]]["text"]) for r in got)


def test_op4(spark, sf_dir, docs):
    """No valid card, phone, address or mail is left, and the rest of each text stays."""
    import re

    def valid(v):
        digits = [int(c) for c in v[::-1]] if v.isdigit() else [0]
        return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0

    value = re.compile(r"\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\w|\b(?:\d{1,3}\.){3}\d{1,3}\b")
    for r in rows(spark, sf_dir, "op4_feistel_pseudonyms"):
        text = docs[r["doc_id"]]["text"]
        assert not set(filter(valid, value.findall(text))) & set(value.findall(r["text"]))
        assert (r["n_values"] == 0) == (r["text"] == text)
        if r["n_values"]:
            assert set(plain.words(text)) & set(plain.words(r["text"]))


def test_op5(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in vectors], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b]
    group = plain.groups(range(len(x)), links)
    for r in rows(spark, sf_dir, "op5_multi_index"):
        i = [v["vec_id"] for v in vectors].index(r["vec_id"])
        assert r["n_links"] == near[i].sum() - 1
        assert r["component_id"] == vectors[group[i]]["vec_id"]


def test_op6(spark, sf_dir, docs):
    prints = {k: plain.fingerprint(r["text"]) for k, r in docs.items()}
    distinct = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 4]
    group, least = plain.groups(distinct, links), {}
    for k, p in prints.items():
        least[group[p]] = min(k, least.get(group[p], k))
    got = rows(spark, sf_dir, "op6_simhash_pigeonring")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        k: (format(p, "016x"), least[group[p]]) for k, p in prints.items()
    }


def test_op7(spark, sf_dir):
    """All pages: the text of the article element of each. Held-out pages: test_pages_with_other_markup."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = rows(spark, sf_dir, "op7_dom_marginals")
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_op8(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op8_rendezvous_shards")
    assert len(got) == len(docs)
    slots = {}
    for r in got:
        text = docs[r["doc_id"]]["text"]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text.encode()) + 1, plain.crc(text), "key")
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op9(spark, sf_dir, docs):
    gone = plain.repeated_lines({k: r["text"] for k, r in docs.items()})
    for r in rows(spark, sf_dir, "op9_line_chunks"):
        lines = docs[r["doc_id"]]["text"].split("\n")
        cut = gone[r["doc_id"]]
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in cut)


def test_op10(spark, sf_dir, docs):
    for r in rows(spark, sf_dir, "op10_risk_rules"):
        text = docs[r["doc_id"]]["text"]
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert counts == plain.base_counts(text) and r["base_failed"] == plain.base_failed(text)
        assert not (r["base_failed"] and r["kept"])


def test_op10_with_proofs(spark, sf_dir):
    """Enough labels for proofs: the certified rungs and the verdicts against a plain binomial test."""
    import unicodedata
    from math import comb

    folder = f"{sf_dir}/../sf0.1"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    seen = {}
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if r["quality"] is not None:
            seen[r["doc_id"]] = min(r["quality"], seen.get(r["doc_id"], 1))

    def values(text):
        words, chars, symbols, dups, repeats = plain.base_counts(text)
        lines = sum(bool(plain.words(x)) for x in text.split("\n"))
        uppers = sum(unicodedata.category(c) == "Lu" for c in text)
        per = lambda a, b: a / b if b else 0.0
        return per(symbols, words), per(dups, lines), per(repeats, words), per(chars, words), per(uppers, chars)

    good = {(docs[k]["lang"], docs[k]["text"]) for k, q in seen.items() if q == 1 and not plain.base_failed(docs[k]["text"])}
    held = {}
    for lang, text in good:
        held.setdefault(lang, []).append(values(text))
    rungs = list(zip(*quality.RULES.values()))
    want = {}
    for lang, rows in held.items():
        for i, cuts in enumerate(rungs):
            n, k = len(rows), sum(any(v > c for v, c in zip(row, cuts)) for row in rows)
            chance = sum(comb(n, j) * quality.RISK**j * (1 - quality.RISK) ** (n - j) for j in range(k + 1)) if k < n * quality.RISK else 1.0
            if chance > quality.DELTA / len(held):
                break
            want[lang] = i
    assert len(want) > 1
    cut = 0
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_risk_rules"](spark, folder).collect()}
    for k in list(docs)[::7]:
        r, text, lang = got[k], docs[k]["text"], docs[k]["lang"]
        broken = lang in want and any(v > c for v, c in zip(values(text), rungs[want[lang]]))
        assert r["kept"] == (not plain.base_failed(text) and not broken), k
        cut += broken and not r["base_failed"]
    assert cut > 0


def test_pipeline(spark, sf_dir):
    """Stage by stage, each on what its predecessor kept."""
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=queries.PIECES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], sf_dir), "stage"))
    raw, ruled, cut, single, mixed, coded = [d.collect() for d in kept]
    assert {r["doc_id"] for r in ruled} == {r["doc_id"] for r in raw if not plain.base_failed(r["text"])}
    assert {r["doc_id"] for r in cut} == {r["doc_id"] for r in ruled} and all(r["n_chars"] == len(r["text"]) for r in cut)
    prints = [plain.fingerprint(r["text"]) for r in single]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[i + 1 :])
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single}
    texts = {r["doc_id"]: r["text"] for r in mixed}
    assert len(coded) == len(mixed) and all(list(r["ids"]) == lib.encode(texts[r["doc_id"]]) for r in coded)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], r["n_ids"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_ids"]) for r in coded)
