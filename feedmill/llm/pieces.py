"""SentencePiece encoding and decoding as a relational lattice.

A text becomes units: a run of word marks with the word behind it, or a line
break. No piece crosses a unit, so units are encoded by themselves. For a table
of units the substrings of at most the longest piece's length are exploded and
equi-joined with the piece table, the edges found are grouped by unit, and a
higher-order aggregate folds them into the unit's pieces:

* ``unigram`` models: Viterbi, the path with the highest sum of scores;
* ``bpe`` models: the merge order, i.e. again and again the best-scored edge
  that spans exactly two neighbouring symbols, leftmost first. The highest sum
  of scores is not what such a model means, and its ids would be wrong.

Characters without a piece become their bytes' pieces.

Units are repeated very unevenly. The ``HOT`` most frequent ones (a bound, not a
cut) are encoded ahead, and their ids are broadcast. Every other unit is encoded
once by the same lattice, and its ids go to the buckets of texts that hold it.
Texts are dealt to buckets by a hash and moved once, packed; ids of other units
move as blocks, one per bucket and task. Nothing that grows with the corpus is
broadcast.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from feedmill.functions.text import bind
from feedmill.llm.common import slices, small_batches, store

#: Fixed value: the mark that stands for a space.
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
HOT = 600_000
#: Share of the documents in which frequent units are looked for. Any choice gives the same ids.
PROBE = 0.3
#: A unit's boundaries are bits of a long. Longer units are encoded one by one in Python.
LONGEST = 62
#: Buckets of texts per shuffle partition: more make partitions even, fewer make larger blocks of units.
SPREAD = 4
#: Units that a task holds before it passes them on.
HELD = 200_000


@dataclass(frozen=True)
class Model:
    """The piece table of a model file."""

    kind: str  # "bpe" or "unigram"
    ids: dict[str, int]  # ordinary pieces
    scores: dict[str, float]
    byte_ids: list[int]
    texts: list[bytes]  # what each id decodes to
    longest: int

    def table(self, spark: SparkSession) -> DataFrame:
        # Pieces of equal score rank equal.
        order = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        rows = [(p, i, order[self.scores[p]], self.scores[p]) for p, i in self.ids.items()]
        return spark.createDataFrame(rows, "piece string, id int, rank int, score double")


def load(path: str) -> Model:
    """Read a ``.model`` file. Raises ValueError where units would not be independent."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    kinds = {1: "unigram", 2: "bpe"}
    spec = model.normalizer_spec
    if model.trainer_spec.model_type not in kinds or not model.trainer_spec.byte_fallback:
        raise ValueError("only unigram and bpe models with byte fallback are supported")
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
        raise ValueError("only models that keep texts as they are, behind one word mark, are supported")
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
    if len(model.pieces) >= 1 << 20:
        raise ValueError("an edge holds ids below 2^20")
    if any("\n" in p or MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("a piece crosses units")
    byte_ids, texts = [0] * 256, []
    for i, p in enumerate(model.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[3:5], 16)] = i
            texts.append(bytes([int(p.piece[3:5], 16)]))
        else:
            texts.append(p.piece.replace(MARK, " ").encode() if p.type == 1 else b"")
    scores = {p: model.pieces[i].score for p, i in ids.items()}
    return Model(kinds[model.trainer_spec.model_type], ids, scores, byte_ids, texts, max(map(len, ids)))


def units(text: str | None) -> list[str]:
    return UNIT.findall(MARK + text.replace(" ", MARK)) if text else []


def pack_units(coded: Iterable[tuple[str, bytes]]) -> bytes:
    """Units of at most ``LONGEST`` characters and their ids, four bytes each, as one block."""
    coded = list(coded)
    names = [u.encode() for u, _ in coded]
    # A unit has at most four bytes, so four ids, a character.
    sizes = np.array([list(map(len, names)), [len(ids) // 4 for _, ids in coded]], "u1")
    # The ids' first bytes, then their second ones: the high bytes are nearly all zero.
    planes = np.frombuffer(b"".join([ids for _, ids in coded]), "u1").reshape(-1, 4).T
    block = b"".join([len(coded).to_bytes(4, "little"), sizes.tobytes(), *names, planes.tobytes()])
    return zstandard.ZstdCompressor(level=3).compress(block)


def unpack_units(packed: bytes) -> dict[str, bytes]:
    block = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(block[:4], "little")
    sizes = np.frombuffer(block[4 : 4 + 2 * n], "u1").reshape(2, n).astype("i8")
    names = np.cumsum([4 + 2 * n, *sizes[0]]).tolist()
    ids = np.frombuffer(block[names[-1] :], "u1").reshape(4, -1).T.tobytes()
    ends = np.cumsum([0, *(4 * sizes[1])]).tolist()
    return {block[a:b].decode(): ids[c:d] for (a, b), (c, d) in zip(pairwise(names), pairwise(ends))}


class Ahead(dict):
    """The units that are encoded ahead; a block while they are sent, as each executor keeps a file of them."""

    def __reduce__(self) -> tuple:
        return unpack_units, (pack_units(self.items()),)


def _coded(units: pa.Array, ids: pa.ListArray) -> list[tuple[str, bytes]]:
    offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<i4")
    return [(u, values[a:b].tobytes()) for u, a, b in zip(units.to_pylist(), offsets, offsets[1:])]


def _shift(value: Column, bits: int | Column) -> Column:
    return F.call_function("shiftleft", value.cast("long"), F.lit(bits) if isinstance(bits, int) else bits)


def _field(edge: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(edge, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


#: An edge is one long: rank of the piece, start, end, whether it is a character
#: without a piece, and its id or code point. Sorted edges are in merge order.
_RANK, _START, _END, _RAW, _VALUE = (34, 20), (28, 6), (22, 6), (21, 1), (0, 21)


def _edge(rank: Column, start: Column, end: Column, raw: Column, value: Column) -> Column:
    parts = zip((rank, start, end, raw, value), (_RANK, _START, _END, _RAW, _VALUE))
    edge = F.lit(0).cast("long")
    for part, (at, _) in parts:
        edge = edge.bitwiseOR(_shift(part, at))
    return edge


def _bit(place: Column) -> Column:
    return _shift(F.lit(1), place.cast("int"))


def _masks(edge: Column) -> Column:
    """Bits of an edge's two ends, of the boundaries inside it, of both, and the edge without its rank."""
    low = edge.bitwiseAND(F.lit((1 << _RANK[0]) - 1).cast("long"))
    ends = _bit(_field(edge, *_START)).bitwiseOR(_bit(_field(edge, *_END)))
    inner = _bit(_field(edge, *_END)) - _bit(_field(edge, *_START) + 1)
    two = F.struct(ends.alias("ends"), inner.alias("inner"), low.alias("low"))
    return bind(
        two, lambda t: F.struct(t["ends"], t["inner"], t["ends"].bitwiseOR(t["inner"]).alias("cover"), t["low"])
    )


def _byte_pieces(code: Column, model: Model) -> Column:
    """The byte pieces of a code point's UTF-8 form."""
    table = F.array(*[F.lit(i) for i in model.byte_ids])
    tail = lambda at: F.shiftrightunsigned(code, at).bitwiseAND(F.lit(63)) + 128
    head = lambda at, mark: F.shiftrightunsigned(code, at) + mark
    octets = (
        F.when(code < 0x80, F.array(code))
        .when(code < 0x800, F.array(head(6, 192), tail(0)))
        .when(code < 0x10000, F.array(head(12, 224), tail(6), tail(0)))
        .otherwise(F.array(head(18, 240), tail(12), tail(6), tail(0)))
    )
    return F.transform(octets, lambda o: F.get(table, o.cast("int")))


def _merge(edges: Column, full: Column, size: Column) -> Column:
    """Boundaries that are left after all merges; ``edges`` are masks, best first.

    Boundaries only go, so an edge that has lost an end, or all inside it, never applies again.
    """

    def applies(mask: Column, e: Column) -> Column:
        return (mask.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1)

    def alive(mask: Column, e: Column) -> Column:
        return (mask.bitwiseAND(e["ends"]) == e["ends"]) & (mask.bitwiseAND(e["inner"]) != 0)

    def step(state: Column, _: Column) -> Column:
        best = F.get(F.filter(state["rest"], lambda e: applies(state["mask"], e)), F.lit(0))["inner"]
        merged = bind(
            F.struct(
                state["mask"].bitwiseAND(F.bitwise_not(F.coalesce(best, F.lit(0).cast("long")))).alias("mask")
            ),
            # Where no edge applies the mask stays, and none will apply later.
            lambda new: F.struct(
                new["mask"].alias("mask"),
                F.filter(state["rest"], lambda e: (new["mask"] != state["mask"]) & alive(new["mask"], e)).alias("rest"),
            ),
        )
        return F.when(F.size(state["rest"]) == 0, state).otherwise(merged)

    start = F.struct(full.alias("mask"), edges.alias("rest"))
    return F.aggregate(F.sequence(F.lit(1), size.cast("int")), start, step)["mask"]


def _viterbi(edges: Column, size: Column) -> Column:
    """Boundaries of the best path; ``edges`` are sorted by their end. Of equal paths the first found stays."""
    seed = F.transform(
        F.sequence(F.lit(0), size.cast("int")),
        lambda k: F.struct(F.when(k == 0, F.lit(0.0)).alias("score"), F.when(k == 0, F.lit(1).cast("long")).alias("mask")),
    )

    def step(best: Column, e: Column) -> Column:
        before, at = F.get(best, e["start"].cast("int")), F.get(best, e["end"].cast("int"))
        score = before["score"] + e["score"]
        better = before["score"].isNotNull() & (at["score"].isNull() | (score > at["score"]))
        cell = F.struct(score.alias("score"), before["mask"].bitwiseOR(_bit(e["end"])).alias("mask"))
        return F.when(better, F.transform(best, lambda c, k: F.when(k == e["end"], cell).otherwise(c))).otherwise(best)

    return F.element_at(F.aggregate(edges, seed, step), -1)["mask"]


def encode_units(rows: DataFrame, model: Model, by: list[str]) -> DataFrame:
    """``by`` and ``ids`` for ``rows(*by, unit)``; units have 1 to ``LONGEST`` characters.

    Further columns, the same in all rows of a group, are carried along. Only
    ``by`` and one number per edge are grouped. ``rows`` that are already
    partitioned by columns of ``by`` are not shuffled: exploding and the join
    with the broadcast piece table, whose size the model file bounds, keep the
    partitioning.
    """
    both = list(dict.fromkeys([*by, "unit"]))
    more = [c for c in rows.columns if c not in both]
    starts = rows.select(*both, *more, F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("_s"))
    longest = F.least(F.lit(model.longest), F.length("unit") - F.col("_s"))
    spans = starts.select(*both, *more, "_s", F.explode(F.sequence(F.lit(1), longest)).alias("_n"))
    # A unit's first character carries the further columns, its other edges need not.
    first = (F.col("_s") == 0) & (F.col("_n") == 1)
    spans = spans.select(
        *by, *[F.when(first, F.col(c)).alias(c) for c in more], "_s", "_n",
        F.substring("unit", F.col("_s") + 1, F.col("_n")).alias("_piece"),
    )
    pieces = F.broadcast(model.table(rows.sparkSession).withColumn("_hash", F.xxhash64("piece")))
    # Joined by a number, as most substrings are no piece; each a prefix of the other, so equal.
    equal = F.startswith("_piece", "piece") & F.startswith("piece", "_piece")
    found = spans.join(pieces, (F.xxhash64("_piece") == F.col("_hash")) & equal, "left")
    found = found.filter((F.col("_n") == 1) | F.col("id").isNotNull())
    raw = F.col("id").isNull()
    edge = _edge(
        F.coalesce("rank", F.lit((1 << _RANK[1]) - 1)), F.col("_s"), F.col("_s") + F.col("_n"), raw.cast("long"),
        F.coalesce("id", F.ascii("_piece")),
    )
    # A character without a piece costs more than any piece.
    lost = min(model.scores.values()) - 10.0
    scored = F.struct(edge.alias("edge"), F.coalesce("score", F.lit(lost)).alias("score"))
    lattice = found.groupBy(*by).agg(
        F.collect_list(edge if model.kind == "bpe" else scored).alias("_l"), *[F.first(c, True).alias(c) for c in more]
    )
    if model.kind == "bpe":
        lattice = lattice.withColumn("_e", F.sort_array("_l"))  # best first
    else:
        lattice = lattice.withColumn("_e", F.transform("_l", lambda x: x["edge"]))
    # Masks only for edges of several characters; each character is an edge besides.
    wide = lambda e: _field(e, *_END) - _field(e, *_START) > 1
    lattice = lattice.withColumn("_w", F.transform(F.filter("_e", wide), _masks))
    lattice = lattice.withColumn("_o", F.filter("_e", lambda e: ~wide(e)))
    size = F.size("_o")
    every = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(LONGEST + 1) - size)
    lattice = lattice.withColumn("_full", every)
    if model.kind == "bpe":
        merged = F.when(F.size("_w") == 0, F.col("_full")).otherwise(_merge(F.col("_w"), F.col("_full"), size))
        folded = lattice.withColumn("_mask", merged)
    else:
        order = F.transform(
            "_l",
            lambda x: F.struct(
                _field(x["edge"], *_END).alias("end"), _field(x["edge"], *_START).alias("start"), x["score"].alias("score")
            ),
        )
        folded = lattice.withColumn("_mask", _viterbi(F.sort_array(order), size))

    def on_path(mask: Column) -> Column:
        several = F.filter("_w", lambda e: mask.bitwiseAND(e["cover"]) == e["ends"])
        ends = lambda e: _shift(F.lit(3), _field(e, *_START).cast("int"))
        single = F.filter("_o", lambda e: mask.bitwiseAND(ends(e)) == ends(e))
        low = F.lit((1 << _RANK[0]) - 1).cast("long")
        # Without its rank an edge sorts by its start.
        return F.sort_array(F.concat(F.transform(several, lambda e: e["low"]), F.transform(single, lambda e: e.bitwiseAND(low))))

    # Bound, or the optimizer would fold the merges into the test of every edge.
    path = bind(F.col("_mask"), on_path)
    value = lambda e: _field(e, *_VALUE).cast("int")
    ids = F.flatten(
        F.transform("_path", lambda e: F.when(_field(e, *_RAW) == 0, F.array(value(e))).otherwise(_byte_pieces(value(e), model)))
    )
    return folded.withColumn("_path", path).select(*by, *more, ids.alias("ids"))


def encode_long(unit: str, model: Model) -> list[int]:
    """One unit of any length, in time n log n; for units beyond ``LONGEST`` only."""
    if model.kind == "unigram":
        lost = min(model.scores.values()) - 10.0
        best: list = [(0.0, 0)] + [None] * len(unit)
        for end in range(1, len(unit) + 1):
            for start in range(max(0, end - model.longest), end):
                score = model.scores.get(unit[start:end], lost if end - start == 1 else None)
                if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                    best[end] = (best[start][0] + score, start)
        cuts, end = [], len(unit)
        while end:
            cuts.append((best[end][1], end))
            end = best[end][1]
        spans = cuts[::-1]
    else:
        after, before = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
        ends = after[:]
        heap: list = []

        def offer(a: int, b: int) -> None:
            score = model.scores.get(unit[a : ends[b]])
            if score is not None:
                heapq.heappush(heap, (-score, a, ends[a], ends[b]))

        for k in range(len(unit) - 1):
            offer(k, k + 1)
        while heap:
            _, a, middle, end = heapq.heappop(heap)
            if ends[a] != middle or middle >= len(unit) or ends[middle] != end or middle != after[a]:
                continue
            ends[a], after[a] = end, after[middle]
            ends[middle] = -1
            if after[a] < len(unit):
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        spans, k = [], 0
        while k < len(unit):
            spans.append((k, ends[k]))
            k = ends[k]
    out = []
    for a, b in spans:
        piece = unit[a:b]
        out += [model.ids[piece]] if piece in model.ids else [model.byte_ids[x] for x in piece.encode()]
    return out


def decode_ids(ids: list[int], model: Model) -> str:
    """The text of a list of ids, without the space that encoding put in front."""
    return b"".join(map(model.texts.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def _counts(docs: DataFrame) -> DataFrame:
    """``(unit, n)``: units and how often a task has seen them, in parts; they only choose what is encoded ahead."""

    def parts(seen: Counter) -> Iterator[pa.RecordBatch]:
        names = ["unit", "n"]
        whole = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names)
        yield from slices(iter([whole]), 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                seen.update(units(text))
            if len(seen) > HELD:
                yield from parts(seen)
                seen.clear()
        yield from parts(seen)

    counts = docs.mapInArrow(run, StructType([StructField("unit", StringType()), StructField("n", LongType())]))
    return counts.filter(F.length("unit") <= LONGEST)


def hot_units(docs: DataFrame, model: Model, text: str, hot: int) -> dict[str, bytes]:
    """The ids, four bytes each, of at most ``hot`` frequent units; this bounded table goes to the driver."""
    spark = docs.sparkSession
    probe = docs.select(F.col(text).alias("_text")).sample(PROBE, seed=3)
    counts = store(_counts(probe).groupBy("unit").agg(F.sum("n").alias("n")).filter("n > 1"), "units")
    # The lowest count that still leaves at most `hot` units; counts of 10,000 and more share a step.
    steps = counts.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count("*").alias("units")).orderBy(F.desc("n")).collect()
    least, total = 10_000, 0
    for step in steps:
        total += step["units"]
        if total > hot:
            break
        least = step["n"]
    top = counts.filter(F.col("n") >= least).select("unit").limit(hot)
    encoded = encode_units(top.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit"), model, ["unit"])
    out: dict[str, bytes] = {}
    for row in encoded.toArrow().to_batches():
        out.update(_coded(row.column(0), row.column(1)))
    return out


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``(key, text, ids, decoded)`` per row of ``docs``: ids and the text decoded from them again.

    Null and empty texts have no ids and decode to an empty text. A text that
    holds the word mark itself decodes to a space there, as in any encoder of
    this kind. Repeated rows stay repeated.
    """
    spark, model = docs.sparkSession, load(path)
    small_batches(spark)
    hot_ids = spark.sparkContext.broadcast(Ahead(hot_units(docs, model, text, hot)))
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Copies of a text under other keys go to other buckets.
    bucket = F.pmod(F.xxhash64(key, text), F.lit(many * SPREAD)).cast("int")
    slim = docs.select(bucket.alias("_bucket"), F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The units of each bucket that are not encoded ahead."""
        known = hot_ids.value
        for batch in slices(batches):
            rare: dict[int, set[str]] = defaultdict(set)
            for b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rare[b].update(u for u in set(units(text)).difference(known) if len(u) <= LONGEST)
            # Sorted, so that neighbours share their beginnings where they are written.
            pairs = sorted((u, b) for b, found in rare.items() for u in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([u for u, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.int32())], names=["unit", "_bucket"]
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encoded units as one block per bucket that asked for them."""
        held: dict[int, list[tuple[str, bytes]]] = defaultdict(list)

        def blocks() -> pa.RecordBatch:
            packed = pa.array([pack_units(coded) for coded in held.values()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), packed], names=["_bucket", "_packed"])

        n = 0
        for batch in batches:
            for coded, buckets in zip(_coded(batch.column(0), batch.column(2)), batch.column(1).to_pylist()):
                n += len(buckets)
                for b in buckets:
                    held[b].append(coded)
            if n > HELD:
                yield blocks()
                held.clear()
                n = 0
        yield blocks()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            packed = [None if t is None else small.compress(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["_bucket", "_key", "_packed"]
            )

    place, binary = slim.schema["_bucket"], StructField("_packed", BinaryType())
    rare = slim.select("_bucket", "_text").mapInArrow(scan, StructType([StructField("unit", StringType()), place]))
    # Each of them is encoded once, however many texts hold it.
    # A few bytes become many edges, so the partitions are not joined by their bytes.
    asked = rare.repartition(many, "unit").groupBy("unit").agg(F.collect_set("_bucket").alias("_buckets"))
    coded = encode_units(asked, model, ["unit"]).select("unit", "_buckets", "ids").mapInArrow(gather, StructType([place, binary]))
    packed = slim.mapInArrow(pack, StructType([place, slim.schema["_key"], binary]))
    no_key = F.lit(None).cast(slim.schema["_key"].dataType).alias("_key")
    both = coded.select("_bucket", no_key, F.lit(False).alias("_is_text"), "_packed").union(
        packed.select("_bucket", "_key", F.lit(True).alias("_is_text"), "_packed")
    )
    # Each bucket's units stand before its texts.
    joined = both.repartition(many, "_bucket").sortWithinPartitions("_bucket", "_is_text")

    def coded_unit(unit: str, own: dict[str, bytes]) -> bytes:
        if len(unit) > LONGEST:
            return np.array(encode_long(unit, model), "<i4").tobytes()
        ids = own.get(unit)
        if not ids:
            raise RuntimeError(f"the lattice gave no ids for the unit {unit!r}")
        return ids

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unpack = hot_ids.value, zstandard.ZstdDecompressor()
        bucket, own = None, {}
        for batch in slices(batches):
            rows, texts, found, decoded = [], [], [], []
            columns = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for row, (b, is_text, data) in enumerate(zip(*columns)):
                if b != bucket:
                    bucket, own = b, {}
                if not is_text:
                    own.update(unpack_units(data))
                    continue
                text = None if data is None else unpack.decompress(data).decode()
                names = units(text)
                parts = list(map(known.get, names))
                for k, ids in enumerate(parts):
                    if ids is None:
                        parts[k] = coded_unit(names[k], own)
                ids = np.frombuffer(b"".join(parts), "<i4")
                rows.append(row)
                texts.append(text)
                found.append(ids)
                decoded.append(decode_ids(ids.tolist(), model))
            sizes = np.cumsum([0, *map(len, found)])
            values = pa.array(np.concatenate(found) if found else np.zeros(0, "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(pa.array(rows, pa.int32())), pa.array(texts, pa.string()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values), pa.array(decoded, pa.string()),
                ],
                names=["_key", "_text", "_ids", "_decoded"],
            )

    out = StructType(
        [slim.schema["_key"], StructField("_text", StringType()), StructField("_ids", ArrayType(IntegerType())), StructField("_decoded", StringType())]
    )
    done = joined.mapInArrow(finish, out)
    return done.select(F.col("_key").alias(key), F.col("_text").alias("text"), F.col("_ids").alias("ids"), F.col("_decoded").alias("decoded"))


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` plus the text of its ``ids`` column; null ids decode to null."""
    model = load(path)

    @F.pandas_udf(StringType())
    def run(column):
        return column.map(lambda x: None if x is None else decode_ids(list(x), model))

    return rows.withColumn(name, run(F.col(ids)))
