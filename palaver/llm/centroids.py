"""Exact centroid clustering whose nearest centroid is found by a progressive Walsh-Hadamard search.

Vectors become integers once, are transformed by the integer Walsh-Hadamard matrix H and are kept as
coefficients in sequency order, coarse patterns first. H has orthogonal rows of squared length ``WIDTH``, so
``WIDTH`` times the squared distance of two vectors is the squared distance of their coefficients, and the
part over the first coefficients is a lower bound that only grows. The search adds coefficients level
by level (1, 1, 2, 4, ... of them). After the first level the centroid that leads a vector is measured to the
end, which bounds the best distance from above; a centroid whose part is strictly above that bound is
dropped. The others finish all ``WIDTH`` coefficients, so the answer is exact and ties go to the
smaller number. Sums of coefficients are transforms of sums of vectors (H H = ``WIDTH``), so the mean needs no second column.

Each round is one Spark job over the written coefficients: a task adds up its vectors per
centroid and sends ``k * (WIDTH + 1)`` numbers, which are added by key; the driver receives as many, whatever the
input. A round that changes no centroid ends the search, since all further ones would repeat it.

Edge cases: a null vector, one of another length and one with a null or non-finite component take no
part; with fewer than k vectors there are as many centroids; an empty centroid stays as it is; a null
number counts as the word ``null`` among the first centroids; vectors of equal numbers are told apart by their
coefficients there; equal rows all count; an empty table gives no rows; other columns are not read.
Integers are exact as long as a sum of squares fits 64 bits (components below 2**17); larger ones raise an ``OverflowError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palaver.session import written

WIDTH, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Coefficients up to here have squares whose sums fit 64 bits; beyond, Python's integers take over.
NARROW, LARGEST = 1 << 27, 1 << 33


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Product of integer rows with the Walsh-Hadamard matrix, by additions and subtractions."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, width)
        half *= 2
    return rows


def sequency(width: int = WIDTH) -> np.ndarray:
    """Rows of the matrix by their number of sign changes."""
    matrix = hadamard(np.eye(width, dtype=np.int64))
    return np.argsort((matrix[:, 1:] != matrix[:, :-1]).sum(axis=1), kind="stable")


def levels(width: int = WIDTH) -> list[slice]:
    ends = [1 << i for i in range(width.bit_length())]
    return [slice(a, b) for a, b in zip([0] + ends[:-1], ends)]


ORDER, LEVELS = sequency(), levels()


def coefficients(rows: np.ndarray) -> np.ndarray:
    return hadamard(rows)[:, ORDER]


def vectors(rows: np.ndarray) -> np.ndarray:
    """The integer rows (Python integers) that coefficients stand for."""
    back = np.zeros(rows.shape, object)
    back[:, ORDER] = rows
    return hadamard(back) // WIDTH


def squares(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=-1)


def search(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each point, ``WIDTH`` times its squared distance, and the number of coefficients met."""
    n, k = len(points), len(centres)
    if max(np.abs(points).max(initial=0), np.abs(centres).max(initial=0)) > NARROW:
        points, centres = points.astype(object), centres.astype(object)
    part = np.zeros((n, k), points.dtype)
    alive = np.ones((n, k), bool)
    bound, met = None, 0
    for level in LEVELS:
        row, centre = np.nonzero(alive)
        part[row, centre] += squares(points[row, level] - centres[centre, level])
        met += len(row) * (level.stop - level.start)
        if bound is None:
            bound = squares(points - centres[part.argmin(axis=1)])
            met += n * WIDTH
        alive &= part <= bound[:, None]
    # what is alive has met all coefficients; the leader's distance is one of them
    total = np.where(alive, part, bound[:, None] + 1)
    best = total.argmin(axis=1)
    return best, total[np.arange(n), best], met


def matrix(column) -> np.ndarray:
    """Rows of an Arrow column of lists of ``WIDTH`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, WIDTH), pa.int32()), pa.array(rows.ravel(), pa.int64()))


def transform(incoming) -> Iterator[pa.RecordBatch]:
    for batch in incoming:
        scaled = np.floor(SCALE * matrix(batch.column(1)).astype(np.float64))
        if np.abs(scaled).max(initial=0) * WIDTH > LARGEST:
            raise OverflowError("a squared distance of such components does not fit 64 bits")
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(coefficients(scaled.astype(np.int64)))], names=["vec_id", "coefficients"])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, coefficients)`` of the vectors that take part, written once."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter((F.size("vector") == WIDTH) & ~broken)
    return written(rows.mapInArrow(transform, "vec_id long, coefficients array<long>"), "coefficients")


def first_centres(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors (Python integers) of the k smallest hashes of their numbers."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    chosen = rows.select(draw.alias("draw"), "coefficients").orderBy("draw", "coefficients").limit(k).collect()
    return vectors(np.array([r.coefficients for r in chosen], object).reshape(-1, WIDTH))


def centre_coefficients(centres: np.ndarray) -> np.ndarray:
    """Coefficients of centroids; they are means of vectors, so they fit 64 bits as those do."""
    return coefficients(centres).astype(np.int64)


def member_sums(centres: np.ndarray):
    """Mapper: per task ``(cluster, place, total)``, place ``WIDTH`` for the number of members."""

    def run(incoming):
        totals = np.zeros((len(centres), WIDTH + 1), object)
        for batch in incoming:
            points = matrix(batch.column(0))
            best, _, _ = search(points, centres)
            for c in np.unique(best):
                own = points[best == c]
                totals[c, :WIDTH] += own.sum(axis=0)
                totals[c, WIDTH] += len(own)
        cluster, place = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place, pa.int32()),
                                          pa.array(totals[cluster, place].tolist(), pa.int64())], names=["cluster", "place", "total"])

    return run


def moved(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means of their members."""
    sums = rows.select("coefficients").mapInArrow(member_sums(centre_coefficients(centres)), "cluster int, place int, total long")
    exact = sums.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals = np.zeros((len(centres), WIDTH + 1), object)
    for r in exact:
        totals[r.cluster, r.place] = int(r.total)
    out, full = centres.copy(), totals[:, WIDTH] > 0
    out[full] = vectors(totals[full, :WIDTH]) // totals[full, WIDTH:]
    return out


def assign(centres: np.ndarray):
    """Mapper: ``(vec_id, cluster, distance)``."""

    def run(incoming):
        for batch in incoming:
            best, total, _ = search(matrix(batch.column(1)), centres)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array((total // WIDTH).tolist(), pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return run


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` per vector that takes part, and the final centroids (one row of integers each)."""
    rows = usable(df, key, vector)
    centres = first_centres(rows, k, seed)
    for _ in range(rounds if len(centres) else 0):
        after = moved(rows, centres)
        if (after == centres).all():
            break
        centres = after
    if not len(centres):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centres
    return written(rows.mapInArrow(assign(centre_coefficients(centres)), "vec_id long, cluster int, distance long"), "clusters"), centres


def with_inertia(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``cluster_inertia, inertia, centroid_sha256``; the sums of the k clusters are looked up from an array."""
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r.cluster: int(r.total) for r in sums}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    if not names:
        names = [""]

    def own(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return found.select("vec_id", "cluster", "distance",
                        own([totals.get(i, 0) for i in range(len(names))], "long").alias("cluster_inertia"),
                        F.lit(sum(totals.values())).cast("long").alias("inertia"), own(names, "string").alias("centroid_sha256"))
