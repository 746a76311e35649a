"""Embedding whitening (op 13) from polarisation covariances.

Entries c become long x = floor(scale * c) + 0. The fit list is each distinct x vector
once: n vectors with sums S by dimension. With u = n * x - S, centred before anything is
multiplied, tasks add up u_i^2 for each dimension and (u_i + u_j)^2 for each pair.
As (u_i + u_j)^2 - u_i^2 - u_j^2 = 2 u_i u_j, differences of variances give every
cross-covariance. All sums are integers, exact at any size: int64 halves where the
bound of |u| allows, Python integers elsewhere, sent as 48-bit limbs. The driver gets dim sums and
dim * (dim + 1) / 2 sums of squares, whatever the number of rows, and runs eigh on the dim x dim matrix.

Null vectors and those with null or non-finite entries are dropped, and so are entries whose
``scale``-fold leaves the long range (they have no x). Vectors can be compared only in one length:
the most frequent one (the longest of equally frequent) counts, others are dropped.
Repeated vectors count once in the fit list and are all returned, as are repeated rows.
Empty tables give empty results; with no spread (one vector, or all equal) there is no
component to divide by: whitened, explained and identity_error are null, deviation
stands. The same holds for components whose eigenvalue is 0 to double precision, which identity_error leaves out. Of equal
eigenvalues any basis may come out; it is one for all rows, with each component's largest
entry (the first of equals) positive. ``deviation`` is null where it has over 38 digits.
Kept columns travel in a struct; one named like a result column gives way to it.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm._blocks import configure, written

SCALE = 256
COMPONENTS = 4
#: Rows that a task squares at once.
ROWS = 512
RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")
_LIMB, _HALF = 48, 24
_MASK = (1 << _LIMB) - 1


def scaled(vector, scale: int = SCALE):
    """x of a vector column as array<long>; null where the vector is dropped."""
    y = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    # 2^63 itself is a double: the largest one below it still fits
    good = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * F.lit(float(scale))) < F.lit(2.0**63)))
    return F.when(good, F.transform(y, lambda x: x + F.lit(0).cast("long")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _centred(x: np.ndarray, n: int, sums: list[int], most: int) -> np.ndarray:
    """n * x - S, as int64 if |u_i + u_j| <= 4 * n * most stays below 2^48, else as Python integers."""
    if 4 * n * (most + 1) < 1 << 2 * _HALF:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(w: np.ndarray) -> list[int]:
    """Exact column sums of w^2, of at most ``ROWS`` rows."""
    if w.dtype == object:
        return [int(v) for v in (w * w).sum(0)]
    high, low = w >> _HALF, w & ((1 << _HALF) - 1)
    a, b, c = (high * high).sum(0), (high * low).sum(0), (low * low).sum(0)
    return [(int(p) << 2 * _HALF) + (int(q) << _HALF + 1) + int(r) for p, q, r in zip(a, b, c)]


def _limbs(totals: list[int], first: int) -> pa.RecordBatch:
    """Each total as limbs of 48 bits, the last one signed."""
    place, limb, part = [], [], []
    for i, v in enumerate(totals):
        k = 0
        while True:
            last = -(1 << 62) < v < 1 << 62
            place.append(first + i), limb.append(k), part.append(v if last else v & _MASK)
            if last:
                break
            v, k = v >> _LIMB, k + 1
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(part, pa.int64())], ["place", "limb", "part"])


def _sum_of(df: DataFrame, run) -> dict[int, int]:
    """Totals of what the tasks emit as limbs; as many as ``run`` has places."""
    parts = df.mapInArrow(run, "place int, limb int, part long")
    out: dict[int, int] = {}
    for r in parts.groupBy("place", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        out[r.place] = out.get(r.place, 0) + (int(r.part) << _LIMB * r.limb)
    return out


def _add(batches, dim: int, of):
    """Exact totals over all of a task's batches of what ``of`` gives for some rows."""
    total: list[int] | None = None
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            more = of(_matrix(batch.slice(a, ROWS).column(0), dim))
            total = more if total is None else [p + q for p, q in zip(total, more)]
    if total:
        yield _limbs(total, 0)


def polarised_sums(fit: DataFrame, n: int, sums: list[int], most: int) -> list[list[int]]:
    """Exact sums of u_i * u_j over the fit list, u = n * x - S."""
    dim = len(sums)
    i, j = np.triu_indices(dim, 1)

    def of(x: np.ndarray) -> list[int]:
        u = _centred(x, n, sums, most)
        pairs: list[int] = []
        for a in range(0, len(i), 4096):  # bounded pair matrices for wide vectors
            pairs += _squares(u[:, i[a : a + 4096]] + u[:, j[a : a + 4096]])
        return _squares(u) + pairs

    found = _sum_of(fit, lambda batches: _add(batches, dim, of))
    out = [[0] * dim for _ in range(dim)]
    for k in range(dim):
        out[k][k] = found.get(k, 0)
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        out[a][b] = out[b][a] = (found.get(dim + k, 0) - out[a][a] - out[b][b]) // 2
    return out


def components(cross: list[list[int]], n: int, most: int) -> tuple[np.ndarray, list[float], list[float]]:
    """Unit eigenvectors (rows) of V = cross / n^3 by falling eigenvalue, eigenvalues and their shares of the trace."""
    cubed = n**3
    values, vectors = np.linalg.eigh(np.array([[float(Fraction(v, cubed)) for v in row] for row in cross]))
    trace = float(Fraction(sum(cross[k][k] for k in range(len(cross))), cubed))
    least = len(cross) * np.finfo(float).eps * max(float(values[-1]), 0.0)
    order = [k for k in range(len(values) - 1, -1, -1) if values[k] > least][:most]
    picked = vectors[:, order].T
    sign = np.array([1.0 if v[int(np.argmax(np.abs(v)))] > 0 else -1.0 for v in picked])
    return picked * sign.reshape(-1, 1), [float(values[k]) for k in order], [float(values[k]) / trace for k in order]


def whiten(table: DataFrame, keep: list[str], vector: str = "embedding", scale: int = SCALE, top: int = COMPONENTS) -> DataFrame:
    """A row for each kept row and component up to ``top``: ``keep`` columns, component, n,
    deviation (decimal), whitened, explained, identity_error."""
    configure(table.sparkSession)
    keep = [k for k in keep if k not in RESULTS]
    rows = table.select(F.struct(*keep).alias("_keep"), scaled(F.col(vector)).alias("_x")).where("_x is not null")
    schema = T.StructType([
        T.StructField("_keep", rows.schema["_keep"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")),
    ])
    # distinct vectors, combined map-side, once in the shared folder for the four passes over them
    distinct = written(rows.select("_x").groupBy("_x").agg(F.count(F.lit(1)).alias("copies")), "fit-list")
    lengths = distinct.groupBy(F.size("_x").alias("dim")).agg(F.sum("copies").alias("rows"))
    widest = lengths.orderBy(F.desc("rows"), F.desc("dim")).first()
    dim = widest.dim if widest else 0
    fit = distinct.where(F.size("_x") == dim).select("_x")
    n = fit.count()
    most = fit.agg(F.max(F.greatest(F.array_max("_x"), F.lit(0)).cast("decimal(38,0)")).alias("a"), F.min(F.least(F.array_min("_x"), F.lit(0)).cast("decimal(38,0)")).alias("b")).first()
    most = max(int(most.a or 0), -int(most.b or 0))

    def add_up(x: np.ndarray) -> list[int]:
        return [int(v) for v in (x if most < 1 << 48 else x.astype(object)).sum(0)]

    found = _sum_of(fit, lambda batches: _add(batches, dim, add_up)) if dim else {}
    sums = [found.get(k, 0) for k in range(dim)]
    axes, values, shares = components(polarised_sums(fit, n, sums, most), n, top) if n and dim else (np.zeros((0, 0)), [], [])
    scales = np.sqrt(np.array(values)).reshape(-1, 1)

    def project(u: np.ndarray) -> np.ndarray:
        return (u.astype(float) / n) @ (axes / scales).T

    def projected(batches):
        for batch in batches:
            if batch.num_rows:
                y = project(_centred(_matrix(batch.column(0), dim), n, sums, most))
                yield pa.RecordBatch.from_arrays([pa.array(y[:, k]) for k in range(len(values))], [f"y{k}" for k in range(len(values))])

    error = None
    if values:
        size = range(len(values))
        y = fit.mapInArrow(projected, ", ".join(f"y{k} double" for k in size))
        # Spark's covariance merges centred moments
        error = max(abs(v) for v in y.agg(*(F.covar_pop(f"y{a}", f"y{b}") - F.lit(float(a == b)) for a in size for b in size if a <= b)).first())

    parts = max(1, min(top, dim))

    def each(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                some = batch.slice(a, ROWS)
                u = _centred(_matrix(some.column(1), dim), n, sums, most)
                if u.dtype == object or 4 * dim * n * n * (most + 1) ** 2 >= 1 << 63:
                    square = [sum(v * v for v in r) for r in u.astype(object).tolist()]
                else:
                    square = (u * u).sum(1).tolist()
                square = [Decimal(v) if v < 10**38 else None for v in square]
                y = project(u) if values else None
                for k in range(parts):
                    there = k < len(values)
                    m = some.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), pa.array([k + 1] * m, pa.int32()), pa.array([n] * m, pa.int64()), pa.array(square, pa.decimal128(38, 0)), pa.array(y[:, k] if there else [None] * m, pa.float64()),
                         pa.array([shares[k] if there else None] * m, pa.float64()), pa.array([error] * m, pa.float64())],
                        ["_keep", *RESULTS],
                    )

    out = rows.where((F.size("_x") == dim) & (F.lit(dim) > 0))
    return out.mapInArrow(each, schema).select("_keep.*", *RESULTS)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """All vectors of ``embeddings``, whitened along the four widest components."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(table, ["vec_id"]).withColumn("deviation", F.expr("try_cast(deviation as long)"))
