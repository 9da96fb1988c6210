"""Whitening of embeddings by a covariance from polarisation (operator 13).

An entry ``c`` becomes the whole number ``x = floor(64 * c) + 1000000``. Over the
distinct vectors, ``n`` of them with sums ``S``, centred values ``y = n * x - S`` are
whole numbers too. Tasks add up exactly the squares of ``y_i`` for every dimension
and of ``y_i + y_j`` for every pair of dimensions; then

    2 * sum(y_i * y_j) = sum((y_i + y_j)^2) - sum(y_i^2) - sum(y_j^2)

gives every covariance as a quotient of whole numbers, rounded once. The matrix,
whose size depends on the dimensions alone, is decomposed by ``eigh`` on the driver,
and tasks project every vector.

Sums of squares are exact at any size: ``y`` is cut into digits of 20 bits, and the
products of each pair of digits are added up by their place in 64-bit numbers, which
Spark adds as decimals.

Vectors that are null, or hold null or non-finite entries, are dropped, and so are,
where vectors differ in length, those not of the commonest length (the longest of
several; never an empty one), and entries of 2^36 or more in magnitude, whose ``x`` could not be
centred in 64 bits. Repeated vectors count once in the fit and keep their
rows in the result; ids may be null or repeated. Components whose eigenvalue
is not above rounding error (relative 1e-13) have no rows, so a table with fewer than
two different vectors gives an empty result, as an empty table does. ``deviation``
is null where it exceeds 64 bits. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_batches, materialise

by_value(__name__)

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries at least so large are dropped.
LARGEST = 2.0**36
#: Bits of a digit, digits of a centred value, and the places of their products.
BITS, DIGITS = 20, 4
PLACES = 2 * DIGITS - 1
#: Rows whose squares are added in 64 bits at once: 2^14 rows of squares of sums of two digits.
BLOCK_ROWS = 1 << 14


def whole_numbers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part."""
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)), F.lit(False)))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT)).alias("x"))


def matrix(column):
    """A list column of equal lengths as an int64 array of rows."""
    import numpy as np

    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), -1)


def centred(x, n: int, sums):
    """n * x - S, exactly: int64 where it fits, else Python's whole numbers."""
    import numpy as np

    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    near = x - whole
    if len(near) and int(np.abs(near).max()) * n + n >= 1 << 62:
        return near.astype(object) * n - rest
    return near * n - rest


def digits(y) -> list:
    """``y`` as digits of BITS bits, the lowest first; the last one has the sign. No digits above those needed."""
    import numpy as np

    out = []
    while len(out) < DIGITS - 1 and int(np.abs(y).max(initial=0)) >= 1 << BITS:
        out.append((y & ((1 << BITS) - 1)).astype(np.int64))
        y = y >> BITS
    if int(np.abs(y).max(initial=0)) >= 1 << (BITS + 3):
        raise OverflowError("centred values of more than 83 bits")
    return [*out, y.astype(np.int64)]


def squares(y):
    """[place, pair] sums of the squares of y_i (pairs (i, i)) and y_i + y_j (i < j), by the place of digits, in the order of ``pairs_of``."""
    import numpy as np

    d = y.shape[1]
    out = np.zeros((PLACES, d * (d + 1) // 2), dtype=np.int64)
    parts = digits(y)
    at = 0
    for i in range(d):
        z = [p[:, i:] + p[:, i : i + 1] for p in parts]
        for k, p in enumerate(parts):
            z[k][:, 0] = p[:, i]
        for p in range(len(z)):
            for q in range(p, len(z)):
                out[p + q, at : at + d - i] += (1 + (p < q)) * np.einsum("ij,ij->j", z[p], z[q])
        at += d - i
    return out


def pairs_of(d: int):
    import numpy as np

    return np.triu_indices(d)


def one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` of the commonest length, and that length (0: no rows)."""
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = top[0]["d"] if top else 0
    return rows.filter(F.size("x") == d), d


def sums_of(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension."""

    def task(batches):
        import pyarrow as pa

        n, total = 0, [0] * d
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                x = matrix(batch.column(0).slice(lo, BLOCK_ROWS))
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        if n:  # a task's sums as two numbers of 32 bits and the rest
            low = [t & 0xFFFFFFFF for t in total]
            high = [t >> 32 for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["i", "n", "low", "high"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    got = map_batches(fit.select("x"), task, "i int, n long, low long, high long").groupBy("i").agg(F.sum("n").alias("n"), *wide).collect()  # d rows
    sums = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in got}
    return (got[0]["n"] if got else 0), [sums.get(i, 0) for i in range(d)]


def covariance(fit: DataFrame, d: int, n: int, sums: list[int]):
    """The covariance of x over ``fit``, every entry the exact quotient rounded once."""
    import numpy as np

    def task(batches):
        import numpy as np
        import pyarrow as pa

        total, rows = None, 0

        def given(total):
            i, j = pairs_of(d)
            numbers = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(t, pa.int64()) for t in total)]
            return pa.RecordBatch.from_arrays(numbers, ["i", "j", *(f"p{k}" for k in range(PLACES))])

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                y = centred(matrix(batch.column(0).slice(lo, BLOCK_ROWS)), n, sums)
                if total is not None and rows + len(y) > BLOCK_ROWS:
                    yield given(total)
                    total, rows = None, 0
                now = squares(y)
                total, rows = now if total is None else total + now, rows + len(y)
        if total is not None:
            yield given(total)

    places = [f"p{k}" for k in range(PLACES)]
    parts = map_batches(fit.select("x"), task, "i int, j int, " + ", ".join(f"{p} long" for p in places))
    got = parts.groupBy("i", "j").agg(*(F.sum(F.col(p).cast("decimal(38,0)")).alias(p) for p in places)).collect()  # a row for each pair of dimensions
    exact = {(r["i"], r["j"]): sum(int(r[p]) << (BITS * k) for k, p in enumerate(places)) for r in got}
    out = np.zeros((d, d))
    for (i, j), s in exact.items():
        product = s if i == j else (s - exact[i, i] - exact[j, j]) // 2
        out[i, j] = out[j, i] = product / n**3
    return out


def principal(cov, components: int):
    """(eigenvalues, eigenvectors as columns, trace), largest first, those above rounding error only."""
    import numpy as np

    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1], vectors[:, ::-1]
    some = int((e[:components] > 1e-13 * max(e[0], 0.0)).sum()) if len(e) and e[0] > 0 else 0
    return e[:some], vectors[:, :some], float(np.trace(cov))


class Whitener:
    """The fitted transformation: plain numbers, of a size that depends on the dimensions alone."""

    def __init__(self, n: int, sums: list[int], values, vectors, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace

    def project(self, x):
        """Whitened coordinates of int64 rows, and their centred whole numbers."""
        import numpy as np

        y = centred(x, self.n, self.sums)
        near = y.astype(np.float64) / self.n if y.dtype != object else np.array([[v / self.n for v in row] for row in y.tolist()])
        return near @ (self.vectors / np.sqrt(self.values)), y


def deviations(y) -> list:
    """Sums of squares of the rows, exactly; None beyond 64 bits."""
    import numpy as np

    d = y.shape[1] or 1
    if y.dtype != object and int(np.abs(y).max(initial=0)) < int((2**62 // d) ** 0.5):
        return np.einsum("ij,ij->i", y, y).tolist()
    return [s if s < 1 << 63 else None for s in (sum(v * v for v in row) for row in y.tolist())]


def fit_whitener(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitener:
    """From a table of distinct vectors ``x`` of ``d`` whole numbers."""
    n, sums = sums_of(fit, d)
    if not n:
        return Whitener(0, sums, [], None, 0.0)
    return Whitener(n, sums, *principal(covariance(fit, d, n, sums), components))


def measured_identity_error(fit: DataFrame, model: Whitener) -> float:
    """The largest absolute entry of the covariance of the whitened ``fit`` less the identity, measured on its rows."""
    import numpy as np

    k = len(model.values)

    def moments(mean):
        def task(batches):
            import numpy as np
            import pyarrow as pa

            total = np.zeros(k if mean is None else k * k)
            for batch in batches:
                if batch.num_rows:
                    w = model.project(matrix(batch.column(0)))[0]
                    total += w.sum(axis=0) if mean is None else ((w - mean).T @ (w - mean)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

        got = map_batches(fit.select("x"), task, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(k if mean is None else k * k)
        for r in got:
            out[r["i"]] = r["s"] / model.n
        return out

    cov = moments(moments(None)).reshape(k, k)
    return float(np.abs(cov - np.eye(k)).max())


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Runs jobs while it is built (the fit)."""
    numbers, d = one_length(whole_numbers(rows, vec_id, vector))
    fit = materialise(numbers.select("x").distinct())
    model = fit_whitener(fit, d, components)
    k = len(model.values)
    kind = numbers.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    error = measured_identity_error(fit, model)

    def task(batches):
        import numpy as np
        import pyarrow as pa

        explained = np.asarray(model.values) / model.trace
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                w, y = model.project(matrix(part.column(1)))
                m = len(w)
                each = np.repeat(np.arange(m), k)
                columns = [
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()),
                    pa.array(deviations(y), pa.int64()).take(pa.array(each)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(numbers, task, schema)
