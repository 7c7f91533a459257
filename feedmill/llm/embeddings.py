"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and split into halves. Each half has a codebook
of its own, so a pair of code words names a cell of a product grid. A vector
lives in its nearest cell and visits the cells of its multi-sequence: the two
code words' distances are added, and cells come in the order of the sum. The
number of visits is the smallest that found the target share of links in a
bounded sample. Candidates are verified by their cosine in double precision.

Codebooks are fitted on a bounded sample (``SAMPLE`` vectors); every vector is
indexed. A cell's residents are dealt to blocks and its visitors to parts of
bounded size; a block and a part give counts and a spanning forest of its links, never its pairs.
Equal vectors are one node with a weight.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bounded, components, store

LIMIT = 0.9
SAMPLE = 4096
RECALL = 0.995
#: Residents per cell aimed at, and per block.
CELL = 128
BLOCK = 2048
#: Visitors per part of a cell.
PART = 4 * BLOCK


def unit_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, _v)``: ``_v`` is the vector in doubles, null if it cannot link: null, zero, or with a null or non-finite part."""
    v = F.col(vector).cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are the same vector.
    return rows.select(F.col(key).alias(key), F.when(fine, F.transform(v, lambda x: x + F.lit(0.0))).alias("_v"))


def _unit(block: np.ndarray) -> np.ndarray:
    # Scaling by the largest part first keeps the squares in range.
    block = block / np.abs(block).max(axis=1, keepdims=True)
    return block / np.linalg.norm(block, axis=1, keepdims=True)


def _codebook(points: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Plain k-means over a bounded sample."""
    words = points[rng.choice(len(points), size, replace=False)]
    for _ in range(rounds):
        near = (points @ words.T - 0.5 * (words**2).sum(1)).argmax(1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=size)[:, None]
        words = np.where(counts > 0, sums / np.maximum(counts, 1), words)
    return words


def traversal(near: np.ndarray, far: np.ndarray, visits: int) -> list[int]:
    """The ``visits`` cells with the lowest sums ``near[i] + far[j]``, lowest first, as ``i * len(far) + j``."""
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    heap, out, seen = [(near[a[0]] + far[b[0]], 0, 0)], [], {(0, 0)}
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append(int(a[i]) * len(b) + int(b[j]))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (near[a[x]] + far[b[y]], x, y))
    return out


def _halves(unit: np.ndarray) -> list[np.ndarray]:
    half = unit.shape[1] // 2
    return [unit[:, :half], unit[:, half:]]


def cells(unit: np.ndarray, books: list[np.ndarray], visits: int) -> list[list[int]]:
    """The cells each vector visits, its home first."""
    near, far = (
        (h**2).sum(1)[:, None] - 2 * h @ w.T + (w**2).sum(1)[None, :] for h, w in zip(_halves(unit), books)
    )
    return [traversal(a, b, visits) for a, b in zip(near, far)]


def fit(sample: np.ndarray, rows: int, limit: float, recall: float, seed: int = 5) -> tuple[list[np.ndarray], int]:
    """Two codebooks, and the visits that find the target share of links: the sample's own and jittered ones."""
    rng = np.random.default_rng(seed)
    size = int(max(1, min(np.sqrt(rows / CELL), 4096, len(sample))))
    books = [_codebook(h, size, rng) for h in _halves(sample)]
    base = sample[:1024]
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(1, keepdims=True) * base
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    # Cosines spread evenly from the limit to 1.
    cos = rng.uniform(limit, 1.0, size=(len(base), 1))
    pairs = [(base, cos * base + np.sqrt(1 - cos**2) * noise)]
    i, j = np.nonzero(sample @ base.T >= limit)
    other = i != j
    if other.any():
        pick = rng.permutation(int(other.sum()))[:1024]
        pairs.append((sample[i[other][pick]], sample[j[other][pick]]))
    grid = size * size
    most = min(grid, 4096)
    ranks: list[int] = []
    for a, b in pairs:
        # A link is found from either side.
        for x, y in zip(cells(a, books, most), cells(b, books, most)):
            first = x.index(y[0]) if y[0] in x else grid
            second = y.index(x[0]) if x[0] in y else grid
            ranks.append(min(first, second) + 1)
    return books, int(max(2, min(grid, np.quantile(ranks, recall))))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given edges."""
    up: dict[int, int] = {}

    def find(n: int) -> int:
        while up.setdefault(n, n) != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def dealt(placed: DataFrame) -> DataFrame:
    """``(node, weight, _v, cells, cell, block, part, resident)``: each visitor of a cell meets each of its residents once.

    ``placed`` is ``(node, weight, _v, cells, home)``. A cell's residents are
    dealt to as many blocks, its visitors to as many parts as their numbers
    need; every block meets every part, so no group grows with the table.
    """
    sizes = placed.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    # Residents visit their own cell, so each cell has visitors.
    come = placed.select(F.explode("cells").alias("_at")).groupBy("_at").agg(F.ceil(F.count("*") / PART).cast("int").alias("_parts"))
    sizes = sizes.join(come, F.col("home") == F.col("_at")).select(F.col("home").alias("cell"), "_blocks", "_parts")
    visitors = placed.select("node", "weight", "_v", "cells", F.explode("cells").alias("cell")).join(sizes, "cell")
    # A visitor carries its home only; a resident needs all the cells that it visits itself.
    visitors = visitors.select(
        "node", "weight", "_v", F.slice("cells", 1, 1).alias("cells"), "cell",
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("_parts").cast("long")).cast("int").alias("part"), F.lit(False).alias("resident"),
    )
    residents = placed.withColumnRenamed("home", "cell").join(sizes, "cell").select(
        "node", "weight", "_v", "cells", "cell",
        F.pmod(F.xxhash64("node"), F.col("_blocks").cast("long")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), F.lit(True).alias("resident"),
    )
    return residents.unionByName(visitors)


def links(nodes: DataFrame, books: list[np.ndarray], visits: int, limit: float) -> DataFrame:
    """``(node, n, other)``: parts of each node's link count, weighted, and forest edges (``n`` = 0).

    ``nodes`` is ``(node, weight, _v)``. A pair is met where one node visits
    the other's cell; if it is met from both sides, each side counts itself.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(books)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                f["cells"] = cells(_unit(np.stack(f["_v"].to_numpy())), shared.value, visits)
                yield f

    placed = nodes.mapInPandas(place, "node long, weight long, _v array<double>, cells array<long>")
    placed = store(placed.withColumn("home", F.get("cells", F.lit(0))), "cells")
    def verify(f: pd.DataFrame) -> pd.DataFrame:
        here, come = f[f["resident"]], f[~f["resident"]]
        empty = pd.DataFrame({"node": [], "n": [], "other": []}).astype("int64")
        if not len(here) or not len(come):
            return empty
        own, own_weight = here["node"].to_numpy(), here["weight"].to_numpy()
        own_home = int(here["cell"].iloc[0])
        own_cells = [set(c) for c in here["cells"]]
        unit = _unit(np.stack(here["_v"].to_numpy()))
        counts: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for at in range(0, len(come), BLOCK):
            part = come.iloc[at : at + BLOCK]
            ids, weight = part["node"].to_numpy(), part["weight"].to_numpy()
            homes = [int(c[0]) for c in part["cells"]]
            hit = _unit(np.stack(part["_v"].to_numpy())) @ unit.T >= limit
            x, y = np.nonzero(hit)
            other = ids[x] != own[y]
            x, y = x[other], y[other]
            for n, w in zip(ids[x].tolist(), own_weight[y].tolist()):
                counts[n] = counts.get(n, 0) + w
            # The resident counts it too, unless it visits the visitor's cell itself.
            for i, j in zip(x.tolist(), y.tolist()):
                if homes[i] != own_home and homes[i] not in own_cells[j]:
                    n = int(own[j])
                    counts[n] = counts.get(n, 0) + int(weight[i])
            edges += _forest(ids[x], own[y])
        rows = [(n, w, n) for n, w in counts.items()]
        rows += [(a, 0, b) for a, b in _forest(*map(np.array, zip(*edges)))] if edges else []
        return pd.DataFrame(rows, columns=["node", "n", "other"]).astype("int64") if rows else empty

    return dealt(placed).groupBy("cell", "block", "part").applyInPandas(verify, "node long, n long, other long")


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", limit: float = LIMIT,
    sample: int = SAMPLE, recall: float = RECALL,
) -> DataFrame:
    """``(key, n_links, component_id)`` per row.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest key reachable. Vectors that cannot link have 0 links and their own
    key. Vectors of another length than the most common one link among
    themselves only. Repeated rows are rows of their own and link to each other.
    An empty table gives no rows.
    """
    all_rows = unit_vectors(rows, key, vector).withColumn("_size", F.size("_v"))
    grouped = all_rows.filter("_v is not null").groupBy("_v").agg(
        F.count("*").alias("weight"), F.min(key).alias("_least"), F.first("_size").alias("_size")
    )
    nodes = store(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    lengths = [r["_size"] for r in nodes.groupBy("_size").count().orderBy("_size").collect()]
    found = None
    for length in lengths:
        own = nodes.filter(F.col("_size") == length).select("node", "weight", "_v")
        count = own.count()
        picked = bounded(own.select("_v"), ["_v"], sample).toPandas()["_v"]
        part = links(own, *fit(_unit(np.stack(picked.to_numpy())), count, limit, recall), limit)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return all_rows.select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    found = store(found, "links")
    counts = found.filter("n > 0").groupBy("node").agg(F.sum("n").alias("_n"))
    parts = components(found.filter("n = 0").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector_parts")
    parts = parts.withColumnRenamed("node", "_node")
    known = nodes.join(counts, "node", "left").join(parts, F.col("node") == F.col("_node"), "left")
    known = known.select("_v", "weight", "_least", F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("component", "node").alias("_part"))
    named = known.groupBy("_part").agg(F.min("_least").alias("component_id"))
    known = known.join(named, "_part").select(
        F.xxhash64("_v").alias("_print"), F.col("_v").alias("_kv"), (F.col("_n") + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    joined = all_rows.withColumn("_own", F.xxhash64("_v")).join(
        known, (F.col("_own") == F.col("_print")) & (F.col("_v") == F.col("_kv")), "left"
    )
    return joined.select(
        key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", F.col(key)).alias("component_id")
    )
