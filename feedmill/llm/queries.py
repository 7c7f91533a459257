"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import (
    bpe, centroids, chat, embeddings, line_dedup, mixing, pages as page_text, pieces, pii, quality, resampling, sharding, simhash,
)
from feedmill.llm.common import table
from feedmill.llm.registry import ORACLES, QUERIES, query  # noqa: F401


@query("op1_pareto_mix")
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document; documents full of symbols have lower odds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source").withColumn("_odds", mixing.tidiness("text"))
    mixed = mixing.mix(docs, weights=[3.0, 1.0, 2.0], share=1.5, weight="_odds")
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken", "_mix.copies")


@query("op8_rendezvous_shards")
def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, and its shard if there was one more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
        F.col("slot").cast("long"), F.col("grown_shard").cast("int"),
    )


@query(
    "op10_risk_rules",
    r"""
    with rungs(rung, symbols, dups, repeats, chars, uppers) as (values
        (0, 2.5, 0.95, 0.5, 40, 0.95), (1, 2.0, 0.9, 0.49, 35, 0.9), (2, 1.5, 0.85, 0.48, 30, 0.8),
        (3, 1.0, 0.8, 0.47, 25, 0.7), (4, 0.75, 0.75, 0.46, 20, 0.65), (5, 0.5, 0.7, 0.45, 16, 0.6),
        (6, 0.35, 0.6, 0.42, 14, 0.55), (7, 0.25, 0.5, 0.4, 12, 0.5)),
    t as (select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
        from documents),
    spots as (select doc_id, i, count(*) over (partition by doc_id, win) as often
        from (select doc_id, i, [w[i], w[i + 1], w[i + 2]] as win
            from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t))),
    covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from spots
        where often > 1) group by 1),
    lines as (select doc_id, count(*) as n, count(*) - count(distinct line) as dup
        from (select doc_id, unnest(string_split(t, chr(10))) as line from t)
        where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
    counts as (select t.doc_id, lang, len(w) as n_words, list_sum(list_transform(w, lambda x: length(x)))::bigint as chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as symbols, coalesce(l.n, 0) as n_lines,
            coalesce(l.dup, 0) as dup, coalesce(c.n, 0) as repeats, len(regexp_extract_all(t, '\p{Lu}')) as uppers
        from t left join covered c using (doc_id) left join lines l using (doc_id)),
    base as (select counts.*, text.t as text, n_words < 50 or 100 * repeats > 50 * n_words as failed,
            case when n_words > 0 then symbols / n_words else 0 end as r1, case when n_lines > 0 then dup / n_lines else 0 end as r2,
            case when n_words > 0 then repeats / n_words else 0 end as r3, case when n_words > 0 then chars / n_words else 0 end as r4,
            case when coalesce(chars, 0) > 0 then uppers / chars else 0 end as r5 from counts join (select doc_id, t from t) text using (doc_id)),
    good as (select doc_id from labels where quality is not null group by 1 having min(quality) = 1),
    tested as (select coalesce(lang, '') as lang, rung, count(*) as n,
            count(*) filter (where r1 > symbols_cut or r2 > dups or r3 > repeats_cut or r4 > chars_cut or r5 > uppers_cut) as k
        from (select distinct lang, text, r1, r2, r3, r4, r5 from base semi join good using (doc_id) where not failed),
            (select rung, symbols as symbols_cut, dups, repeats as repeats_cut, chars as chars_cut, uppers as uppers_cut from rungs)
        group by 1, 2),
    proved as (select *, case when k < n * 0.01 then (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
            + i * ln(0.01) + (n - i) * ln(0.99))) from (select unnest(range(0, k + 1)) as i)) else 1 end
            <= 0.05 / (select count(distinct lang) from tested) as safe from tested),
    best as (select lang, max(rung) as rung from (select lang, rung, bool_and(safe) over (partition by lang order by rung) as ok
        from proved) where ok group by 1),
    cuts as (select b.lang as cut_lang, r.* from best b join rungs r using (rung))
    select doc_id, n_words, coalesce(b.chars, 0) as word_chars, b.symbols as n_symbols, dup as n_dup_lines,
        b.repeats as n_repeat_words, failed as base_failed,
        not failed and not coalesce(r1 > c.symbols or r2 > c.dups or r3 > c.repeats or r4 > c.chars or r5 > c.uppers, false) as kept
    from base b left join cuts c on coalesce(b.lang, '') = cut_lang
    """,
)
def op10_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of each document and whether the certified rules keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    judged = quality.report(docs, labels)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *[F.col(f"_q_{c}").alias(c) for c in counts], F.col("_base").alias("base_failed"), F.col("_kept").alias("kept")
    )


@query("op6_simhash_pigeonring")
def op6_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and the smallest id of its group of near copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_line_chunks")
def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the line chunks that an earlier document or place has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.dedup_lines(docs)
    return cut.select("doc_id", "text", F.col("_removed").cast("long").alias("n_removed_lines"))


#: Where the public piece table lies; never part of this repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op3_piece_lattice")
def op3_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of each document, and whether they decode to its text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encode(docs, PIECES)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query(
    "op2_snapshot_collapse",
    """
    with turns as (
        select conv_id, row_number() over (partition by conv_id order by turn nulls last, role nulls first, text nulls first) pos,
               role, text
        from (select distinct conv_id, turn, role, text from conversations)
    ),
    talks as (
        select conv_id, count(*) n_turns, list({'r': role, 't': text} order by pos) said from turns group by conv_id
    ),
    talk_prefixes as (
        select distinct k, said[1:k] said from (select said, unnest(range(1, n_turns)) k from talks)
    ),
    best as (
        select min(conv_id) conv_id, any_value(n_turns) n_turns, count(*) n_equal, said from talks t
        where not exists (select 1 from talk_prefixes p where p.k = t.n_turns and p.said = t.said)
        group by said
    )
    select t.conv_id, (t.pos - 1) // 256 part, b.n_turns, b.n_equal,
           string_agg('<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10)
               || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' order by pos) as text
    from turns t join best b on t.conv_id is not distinct from b.conv_id
    group by t.conv_id, (t.pos - 1) // 256, b.n_turns, b.n_equal
    """,
)
def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat texts of all conversations that no other conversation contains."""
    return chat.render(table(spark, sf_dir, "conversations"))


@query("op4_feistel_pseudonyms")
def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with pseudonyms for its personal values. A deployment passes its own key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.pseudonymize(docs, key="public test key")
    return done.select("doc_id", "text", F.size("_values").cast("long").alias("n_values"))


@query(
    "op5_multi_index",
    """
    with recursive fine as (
        select vec_id, embedding::double[] as e from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    near as (select a.vec_id as x, b.vec_id as y from fine a join fine b
        on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
    reach as (select x, y from near union select r.x, n.y from reach r join near n on r.y = n.x)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
        vec_id <= coalesce(low, vec_id) as kept
    from embeddings left join (select x, count(*) as n from near group by 1) c on c.x = vec_id
        left join (select x, min(y) as low from reach group by 1) r on r.x = vec_id
    """,
)
def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each vector at a cosine of 0.9, and whether it is the one that its group keeps."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query("op7_dom_marginals")
def op7_dom_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return page_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


#: Where the public merge list lies; never part of this repository.
MERGES = "/opt/tokenizers/word_bpe_49k.json"


@query("op11_stream_bpe")
def op11_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode(docs, MERGES)
    return done.select(
        "doc_id", F.size("_ids").cast("long").alias("n_tokens"), F.sha2("_packed", 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op12_bracketed_resampling",
    r"""
    with bits as (select list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as t
        from (select unnest(range(256))::bigint as b)),
    texts as (select 0 as kind, row_number() over () as r, doc_id, coalesce(text, '') as t from documents
        union all select 1, row_number() over (), null, coalesce(text, '') from benchmark),
    split as (select kind, r, doc_id, regexp_extract_all(
            translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from texts),
    runs as (select kind, r, array_to_string(w[i:i + n - 1], ' ') as f
        from (select kind, r, w, n, unnest(range(1, len(w) - n + 2)) as i from split, (select unnest([1, 2, 3]) as n))),
    codes as (select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(f))),
            lambda i: ('0x' || hex(encode(f))[2 * i + 1:2 * i + 2])::bigint)),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as b
        from (select distinct f from runs), bits),
    counted as (select kind, r, b, count(*) as n from runs join codes using (f) group by 1, 2, 3),
    totals as (select b, coalesce(sum(n) filter (where kind = 0), 0)::double as s, coalesce(sum(n) filter (where kind = 1), 0)::double as t
        from counted group by 1),
    gain as (select b, floor(1000 * ln((t + 1) * ((select sum(s) from totals) + 10000) / ((s + 1) * ((select sum(t) from totals) + 10000)))) as g
        from totals),
    weighed as (select r, sum(n)::bigint as n_features, sum(n * g)::bigint as weight from counted join gain using (b) where kind = 0 group by 1),
    scored as (select r, doc_id, len(w) as words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
        from split left join weighed using (r) where kind = 0),
    placed as (select r, row_number() over (order by score desc, doc_id) as place from scored where words >= 20)
    select doc_id, n_features, weight, score,
        case when place <= 5 * (select count(*) from placed) // 100 then place end as rank
    from scored left join placed using (r)
    """,
)
def op12_bracketed_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and place of each document in a draw of 5 % that leans towards the benchmark texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.draw(docs, table(spark, sf_dir, "benchmark").select("text"), carry=["doc_id"])
    return drawn.select(
        "doc_id", F.col("_features").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"),
        F.col("_rank").alias("rank"),
    )


def _rounds_sql(rounds: int) -> str:
    """Assignment and new means for each round, as one step after the other."""
    near = """
    d{i} as materialized (select r, c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as dist
        from v, c{i} m),
    a{i} as materialized (select r, c, dist from d{i} qualify row_number() over (partition by r order by dist, c) = 1)"""
    mean = """,
    s{i} as (select c, pos, sum(x[pos])::hugeint as s, count(*)::hugeint as n
        from a{i} join v using (r), (select unnest(range(1, 65)) as pos) group by 1, 2),
    n{i} as (select c, list((case when s >= 0 then s // n else -((n - 1 - s) // n) end)::bigint order by pos) as x from s{i} group by 1),
    c{j} as materialized (select c, coalesce(n{i}.x, c{i}.x) as x from c{i} left join n{i} using (c)),"""
    return "".join(near.format(i=i) + (mean.format(i=i, j=i + 1) if i < rounds else "") for i in range(rounds + 1))


@query(
    "op13_rotated_filter",
    f"""
    with v as materialized (
        select row_number() over (order by vec_id) as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x
        from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    c0 as (select row_number() over (order by sha256('2:' || vec_id)) - 1 as c, x from v
        order by sha256('2:' || vec_id) limit 40),
    {_rounds_sql(5)}
    select vec_id, a5.c::int as cluster, dist as distance, (sum(dist) over (partition by a5.c))::bigint as cluster_inertia,
        (sum(dist) over ())::bigint as inertia, sha256(array_to_string(c5.x, ',')) as centroid_sha256
    from a5 join v using (r) join c5 on c5.c = a5.c
    """,
)
def op13_rotated_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector after five rounds around 40 centroids, in exact whole numbers."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    done = centroids.cluster(vectors, k=40, rounds=5, carry=["vec_id"])
    return done.select(
        "vec_id", F.col("_cluster").alias("cluster"), F.col("_distance").alias("distance"),
        F.col("_cluster_inertia").alias("cluster_inertia"), F.col("_inertia").alias("inertia"),
        F.col("_centroid_sha256").alias("centroid_sha256"),
    )
