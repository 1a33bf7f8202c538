"""Clustering around centroids with n-simplex projection as a filter before exact distances.

A few pivots span a simplex. The distances of a vector to them, computed once and cached, make it the apex of that simplex:
its coordinates follow from the distances alone, and its height over the pivots' plane is their last one. For two
vectors the distance of their apexes is a lower bound of their own distance, and with one apex below the plane
it is an upper bound. A centroid whose lower bound is above the least upper bound cannot be the nearest. The centroids
that are left are compared by exact integer distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.session import cut_lineage

DIM = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 8
SEED = "1:"
#: Integer components are below this, so that squared distances of ``DIM`` components fit 64 bits.
MOST = 1 << 27
#: A pivot has at least this height over the others, as a share of its distance to the first.
_LEAST_HEIGHT = 1e-3
#: Slack of the bounds against rounding, as a share of the squared distances to the first pivot.
_SLACK = 1e-7


@dataclass
class Simplex:
    """Pivots (whole numbers) and the coordinates of all but the first in their own plane, a lower triangle."""

    pivots: np.ndarray
    base: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Pivots among the rows: the first, then each time the one highest over those chosen, while one has a height."""
        chosen, base = [0], np.zeros((0, 0))
        while len(chosen) < min(most, len(vectors)):
            simplex = cls(vectors[chosen], base)
            apexes = simplex.apexes(simplex.squares(vectors))
            far = np.sqrt((apexes**2).sum(axis=1))
            height = np.where(apexes[:, -1] > _LEAST_HEIGHT * far, apexes[:, -1], 0)
            best = int(np.argmax(height))
            if height[best] <= 0:
                break
            chosen.append(best)
            base = np.vstack((np.hstack((base, np.zeros((len(base), 1)))), apexes[best]))
        return cls(vectors[chosen], base)

    def squares(self, vectors: np.ndarray) -> np.ndarray:
        """Exact squared distances to the pivots."""
        return np.stack([squared(vectors, p) for p in self.pivots], axis=1)

    def apexes(self, squares: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: the place in their plane, then the height over it."""
        squares = squares.astype(float)
        if not len(self.base):
            return np.sqrt(squares[:, :1])
        right = (squares[:, :1] - squares[:, 1:] + (self.base**2).sum(axis=1)) / 2
        flat = np.linalg.solve(self.base, right.T).T
        height = np.sqrt(np.maximum(0, squares[:, 0] - (flat**2).sum(axis=1)))
        return np.column_stack((flat, height))


def squared(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to one vector."""
    off = vectors.astype(np.int64) - one.astype(np.int64)
    return np.einsum("ij,ij->i", off, off)


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid (of equals the smallest), exact squared distance, and how many were compared."""
    flat = ((apexes[:, None, :-1] - centroid_apexes[None, :, :-1]) ** 2).sum(axis=2)
    low = flat + (apexes[:, None, -1] - centroid_apexes[None, :, -1]) ** 2
    high = flat + (apexes[:, None, -1] + centroid_apexes[None, :, -1]) ** 2
    reach = (apexes**2).sum(axis=1) + (centroid_apexes**2).sum(axis=1).max(initial=0.0)
    may = low <= (high.min(axis=1) + _SLACK * reach + 1e-6)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    cluster = np.zeros(len(vectors), np.int64)
    for c, one in enumerate(centroids):
        rows = np.flatnonzero(may[:, c])
        exact = squared(vectors[rows], one)
        closer = exact < best[rows]
        best[rows[closer]], cluster[rows[closer]] = exact[closer], c
    return cluster, best, may.sum(axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 32-bit integers."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= MOST:
        raise OverflowError(f"a component is {MOST // scale} or more; exact squared distances would not fit 64 bits")
    return scaled.astype(np.int32)


@dataclass
class Model:
    """Centroids after the last round, and the simplex that filters them."""

    centroids: np.ndarray
    simplex: Simplex

    def assign(self, cached: DataFrame, keep: list[str]) -> DataFrame:
        """(columns ``keep``, cluster, distance, compared) of the cached vectors."""
        shared = cached.sparkSession.sparkContext.broadcast((self.centroids, self.simplex.apexes(self.simplex.squares(self.centroids))))
        dim = self.centroids.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, tops = shared.value
            for batch in batches:
                if not len(batch):
                    continue
                vectors, apexes = _matrix(batch.column(0), dim), _matrix(batch.column(1), tops.shape[1])
                found = nearest(vectors, apexes, centroids, tops)
                yield pa.RecordBatch.from_arrays([*batch.columns[2:], *(pa.array(x, t) for x, t in zip(found, (pa.int32(), pa.int64(), pa.int32())))], names=names)

        names = [*keep, "cluster", "distance", "compared"]
        kept = "".join(f"`{c}` {cached.schema[c].dataType.simpleString()}, " for c in keep)
        return cached.select("v", "apex", *keep).mapInArrow(run, f"{kept}cluster int, distance bigint, compared int")

    def move(self, cached: DataFrame) -> Model:
        """Centroids as the exact floor of their vectors' mean; an empty one stays.

        A task emits one row of sums per centroid, whatever its vectors, and the sums of all tasks are added by Spark.
        """
        shared = cached.sparkSession.sparkContext.broadcast((self.centroids, self.simplex.apexes(self.simplex.squares(self.centroids))))
        k, dim = self.centroids.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, tops = shared.value
            counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
            for batch in batches:
                if not len(batch):
                    continue
                vectors, apexes = _matrix(batch.column(0), dim), _matrix(batch.column(1), tops.shape[1])
                cluster, _, _ = nearest(vectors, apexes, centroids, tops)
                counts += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    sums[c] += vectors[cluster == c].sum(axis=0, dtype=np.int64)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                names=["cluster", "n", "sums"],
            )

        parts = cached.select("v", "apex").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
        added = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")
        )
        moved = self.centroids.copy()
        for row in added.collect():
            moved[row["cluster"], row["at"]] = int(row["s"]) // row["n"]
        return Model(moved, self.simplex)


def kept_vectors(vectors: DataFrame, vector_col: str, dim: int) -> DataFrame:
    """Rows whose vector has exactly ``dim`` components, none null, not a number or infinite."""
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter((F.size(vector_col) == dim) & sound)


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, pivots: int = PIVOTS,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, Model] | None:
    """(id, cluster, distance, compared) as a written table, and the model; None if no vector is kept.

    Vectors of another length and those with a component that is null or not finite are left out. Components become the
    integers floor(``scale`` * x). The ``k`` vectors with the smallest SHA-256 of their id are the first centroids, those without an id
    last, equal ids by their components; with fewer vectors there are fewer centroids. Equal distances go to the smaller
    number. Rows that share an id have one row each. Other columns are not read. At most ``k`` vectors, sums and
    pivots go through the driver. A component too large for exact 64-bit distances ends the job.
    """
    kept = kept_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e")), "e", dim)
    digest = F.sha2(F.concat(F.lit(SEED), F.col("id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "e").limit(k).select("e").toArrow()
    if not len(first):
        return None
    start = _whole(_matrix(first.column("e").combine_chunks(), dim), scale)
    model = Model(start.astype(np.int64), Simplex.of(start.astype(np.int64), pivots))
    simplex, kind = model.simplex, kept.schema["id"].dataType.simpleString()

    def cache(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _whole(_matrix(batch.column(1), dim), scale)
            apexes = simplex.apexes(simplex.squares(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())) for x in (rows, apexes))],
                names=["id", "v", "apex"],
            )

    cached = cut_lineage(kept.mapInArrow(cache, f"id {kind}, v array<int>, apex array<double>"), "apexes")
    for _ in range(rounds):
        model = model.move(cached)
    assigned = cut_lineage(model.assign(cached, ["id"]), "assigned")
    return assigned.withColumnRenamed("id", id_col), model


def clusters_with_inertia(vectors: DataFrame, id_col: str = "vec_id", **settings) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared) per kept vector; see :func:`cluster`.

    The sums are one row a centroid and are broadcast.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    found = cluster(vectors, id_col=id_col, **settings)
    if found is None:
        return spark.createDataFrame(
            [], f"`{id_col}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, compared int"
        )
    assigned, model = found
    digests = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(model.centroids)]
    by = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"))
    total = by.agg(F.sum("s").cast("bigint")).scalar()
    named = by.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster").select(
        "cluster", F.col("s").cast("bigint").alias("cluster_inertia"), total.alias("inertia"), "centroid_sha256"
    )
    return assigned.join(F.broadcast(named), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"
    )
