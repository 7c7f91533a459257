"""Lloyd's centroid clustering in exact integers, with a PCA-rotated filter.

Vectors become whole numbers first, so that distances, ties and means are exact
and reruns agree. Each vector is stored with its leading coordinates in a
rotated frame and the norm of the rest. The squared distance of the leading
coordinates plus the squared difference of the two norms is a lower bound of
the distance to a centroid; only centroids whose bound, less what rounding can
add, does not exceed the best distance found are compared in whole numbers.

The rotation comes from the second moments of all vectors. It decides how many
centroids survive the filter, never the result. Centroids, ``k`` vectors, go to
every task; sums per centroid and component come back, ``k`` times ``dims``
numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from feedmill.llm.common import slices, small_batches, store, unwrap, wrap

#: Vectors looked at together, and pairs compared in whole numbers together.
ROWS, PAIRS = 2048, 16_384
#: Whole components beyond this could take a squared distance beyond a long.
REACH = 1 << 27
#: Share of the variance that the leading coordinates hold, up to a half of all coordinates.
ENERGY = 0.9


def whole(rows: DataFrame, vector: str, dims: int, scale: float) -> DataFrame:
    """``(_doc, _x)``: the rows whose vector has ``dims`` components, all finite, as whole numbers.

    Raises where a component is too large for exact distances in a long.
    """
    v = F.col(vector).cast("array<double>")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    scaled = F.transform(v, lambda x: F.lit(float(scale)) * x)
    most = F.array_max(F.transform(scaled, lambda x: F.abs(x)))
    message = F.lit(f"a component is beyond {REACH} after scaling")
    x = F.when(most <= float(REACH), F.transform(scaled, lambda x: F.floor(x))).otherwise(F.raise_error(message).cast("array<bigint>"))
    kept = rows.filter(F.coalesce(fine, F.lit(False)))
    return wrap(kept, _x=F.transform(x, lambda c: c.cast("int")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def moments(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of all vectors; a task sends ``dims`` squared numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = np.hstack([matrix(batch.column(0), dims).astype(float), np.ones((batch.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "s"])

    schema = StructType([StructField("at", IntegerType()), StructField("s", DoubleType())])
    sums = vectors.select("_x").mapInArrow(run, schema).groupBy("at").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros((dims + 1) ** 2)
    for r in sums:
        flat[r["at"]] = r["s"]
    s = flat.reshape(dims + 1, dims + 1)
    n = max(1.0, s[-1, -1])
    mean = s[-1, :-1] / n
    return mean, s[:-1, :-1] / n - np.outer(mean, mean)


def rotation(cov: np.ndarray) -> tuple[np.ndarray, int]:
    """Orthonormal columns by falling variance, and how many of them lead."""
    values, axes = np.linalg.eigh(cov)
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    total = values.sum()
    held = int(np.searchsorted(np.cumsum(values), ENERGY * total)) + 1 if total > 0 else 1
    return axes, min(held, max(1, len(values) // 2))


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of the others."""
    y = (x - mean) @ axes
    return y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(axis=1))


def exact(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two matrices of longs."""
    d = x - c
    return (d * d).sum(axis=1)


def nearest(
    x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (of equal ones the first), its squared distance, and the number of exact comparisons."""
    own = (lead**2).sum(axis=1) + rest**2
    theirs = (c_lead**2).sum(axis=1) + c_rest**2
    bound = own[:, None] + theirs[None, :] - 2.0 * (lead @ c_lead.T + np.outer(rest, c_rest))
    # More than rounding can add to a bound, of rotation, norms and product together.
    bound -= 1e-9 * (own[:, None] + theirs[None, :]) + 1e-3
    guess = bound.argmin(axis=1)
    best = exact(x, centroids[guess])
    row, col = np.nonzero(bound <= best[:, None])
    found = np.full(bound.shape, np.iinfo(np.int64).max)
    for at in range(0, len(row), PAIRS):
        r, c = row[at : at + PAIRS], col[at : at + PAIRS]
        found[r, c] = exact(x[r], centroids[c])
    choice = found.argmin(axis=1)
    return choice, found[np.arange(len(x)), choice], len(row)


class Frame:
    """What every task needs: the rotation and the centroids in it."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, lead: int):
        self.mean, self.axes, self.lead = mean, axes, lead

    def place(self, centroids: list[list[int]]) -> "Frame":
        out = Frame(self.mean, self.axes, self.lead)
        out.centroids = np.array(centroids, np.int64).reshape(-1, len(self.mean))
        out.c_lead, out.c_rest = rotated(out.centroids.astype(float), self.mean, self.axes, self.lead)
        return out


def _blocks(batches: Iterator[pa.RecordBatch], frame: Frame):
    """``(batch, x, cluster, distance)`` for parts of bounded size; the last three columns are vector, lead and rest."""
    dims = len(frame.mean)
    for batch in slices(batches, ROWS):
        if not batch.num_rows:
            continue
        at = batch.num_columns - 3
        x = matrix(batch.column(at), dims).astype(np.int64)
        lead, rest = matrix(batch.column(at + 1), frame.lead), batch.column(at + 2).to_numpy()
        cluster, distance, _ = nearest(x, lead, rest, frame.centroids, frame.c_lead, frame.c_rest)
        yield batch, x, cluster, distance


def _place(vectors: DataFrame, frame: Frame) -> DataFrame:
    """``vectors`` plus ``_lead`` and ``_rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            lead, rest = rotated(matrix(batch.column(1), len(frame.mean)).astype(float), frame.mean, frame.axes, frame.lead)
            sizes = np.arange(0, lead.size + 1, frame.lead, dtype=np.int32)
            packed = pa.ListArray.from_arrays(pa.array(sizes), pa.array(lead.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(rest)], names=["_doc", "_x", "_lead", "_rest"])

    made = [StructField("_lead", ArrayType(DoubleType())), StructField("_rest", DoubleType())]
    return vectors.select("_doc", "_x").mapInArrow(run, StructType([vectors.schema["_doc"], vectors.schema["_x"], *made]))


def means(placed: DataFrame, frame: Frame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round. A task sends the sums of the clusters it saw."""
    k, dims, here = len(centroids), len(frame.mean), frame.place(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, cluster, _ in _blocks(batches, here):
            np.add.at(sums, cluster, x)
            sizes += np.bincount(cluster, minlength=k)
        # The last number of a cluster is its size.
        seen = np.nonzero(sizes)[0]
        table = np.hstack([sums[seen], sizes[seen, None]])
        number = np.repeat(seen, dims + 1), np.tile(np.arange(dims + 1), len(seen))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number[0].astype(np.int32)), pa.array(number[1].astype(np.int32)), pa.array(table.ravel())], names=["cluster", "at", "s"]
        )

    schema = StructType([StructField("cluster", IntegerType()), StructField("at", IntegerType()), StructField("s", LongType())])
    parts = placed.select("_x", "_lead", "_rest").mapInArrow(run, schema)
    # Sums of longs need more room than a long.
    total = parts.groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    sums: dict[int, list[int]] = {}
    for r in total.collect():
        sums.setdefault(r["cluster"], [0] * (dims + 1))[r["at"]] = int(r["s"])
    return [[s // sums[c][dims] for s in sums[c][:dims]] if c in sums else old for c, old in enumerate(centroids)]


def assign(placed: DataFrame, frame: Frame, centroids: list[list[int]]) -> DataFrame:
    """``(_doc, _cluster, _distance)``."""
    here = frame.place(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in _blocks(batches, here):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["_doc", "_cluster", "_distance"]
            )

    made = [StructField("_cluster", IntegerType()), StructField("_distance", LongType())]
    return placed.select("_doc", "_x", "_lead", "_rest").mapInArrow(run, StructType([placed.schema["_doc"], *made]))


def seeds(vectors: DataFrame, key: str, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors whose keys hash lowest (fewer if there are fewer).

    A null key hashes as an empty one; vectors of equal keys go by their components.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"_doc.`{key}`").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(named, 256).alias("_h"), "_x").orderBy("_h", "_x").limit(k)
    return [list(r["_x"]) for r in first.collect()]


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, seed: int = 2,
    key: str = "vec_id", vector: str = "embedding", carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` of the clustered rows (default: all) plus ``_cluster``, ``_distance``,
    ``_cluster_inertia``, ``_inertia`` and ``_centroid_sha256``.

    Rows without ``dims`` finite components are left out; repeated rows are
    rows of their own. An empty cluster keeps its centroid.
    """
    names = rows.columns if carry is None else carry
    small_batches(rows.sparkSession, ROWS)
    held = whole(rows, vector, dims, scale)
    slim = held.select(F.struct(*[F.col(f"_doc.`{c}`") for c in dict.fromkeys([*names, key])]).alias("_doc"), "_x")
    vectors = store(slim, "vectors")
    centroids = seeds(vectors, key, k, seed)
    mean, cov = moments(vectors, dims)
    axes, lead = rotation(cov)
    frame = Frame(mean, axes, lead)
    placed = store(_place(vectors, frame), "rotated")
    for _ in range(rounds if centroids else 0):
        centroids = means(placed, frame, centroids)
    done = store(assign(placed, frame, centroids), "assigned")
    # One row for each cluster.
    sums = done.groupBy("_cluster").agg(F.sum(F.col("_distance").cast("decimal(20,0)")).alias("s")).collect()
    by_cluster = {r["_cluster"]: int(r["s"]) for r in sums}
    table = rows.sparkSession.createDataFrame(
        [(c, by_cluster.get(c, 0), sum(by_cluster.values()), digest(x)) for c, x in enumerate(centroids)],
        "_number int, _cluster_inertia long, _inertia long, _centroid_sha256 string",
    )
    joined = done.join(F.broadcast(table), F.col("_cluster") == F.col("_number"))
    return unwrap(joined, names, "_cluster", "_distance", "_cluster_inertia", "_inertia", "_centroid_sha256")
