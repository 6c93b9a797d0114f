"""Whitening of embeddings: components from the R factor of a shifted Cholesky QR."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import materialise

SCALE, OFFSET = 64, 1_000_000
# An entry beyond this has no whole number in a double.
LARGEST = float(1 << 52)
PASSES = 3
COMPONENTS = 32
GATHERED_BYTES = 64 << 20
ADDERS = 16

VECTORS = "vec_id long, x array<long>"
WHITENED = "vec_id long, deviation long, whitened array<double>"


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) stored: floor(64 * entry) + 1,000,000 of every usable vector.

    Left out are NULL vectors, those with a NULL, NaN or infinite entry or one of 2 ** 52 / 64
    and more (no double tells whole numbers apart there), and those of another length than most
    (the longer one if two lengths are equally frequent; an empty vector has no entries to whiten).
    """
    wide = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    fine = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / SCALE))
    wide = wide.filter(F.col("_v").isNotNull() & (F.size("_v") > 0) & fine)
    vectors = materialise(wide.select("vec_id", F.transform(
        "_v", lambda c: F.floor(c * SCALE).cast("bigint") + OFFSET).alias("x")), "vectors")
    sizes = vectors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(2).collect()
    return vectors.filter(F.size("x") == sizes[0]["width"]) if len(sizes) > 1 else vectors


def _matrix(column) -> np.ndarray:
    """An array<long> column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension)."""

    def work(batches):
        count, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                # Entries stay below 2 ** 52: the halves of a batch's sums cannot overflow.
                x = _matrix(batch.column("x"))
                own = ((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))
                own = [(int(a) << 32) + int(b) for a, b in zip(*own)]
                sums = own if sums is None else [a + b for a, b in zip(sums, own)]
                count += batch.num_rows
        if count:
            yield pa.RecordBatch.from_pydict({"n": [count], "sums": [[str(s) for s in sums]]},
                                             schema=pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.string()))]))

    found = vectors.select("x").mapInArrow(work, "n long, sums array<string>")
    n = found.agg(F.sum("n")).first()[0] or 0
    totals = found.select(F.posexplode("sums").alias("i", "s")).groupBy("i") \
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return n, [int(r["s"]) for r in totals]


class Centre:
    """Exact deviations from the mean: n * x - S, in 64 bits where they fit."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        # A whole number near each mean comes off first; what is left of S is small.
        self.pivot = np.array([s // n for s in sums], np.int64)
        self.rest = [s - n * int(p) for s, p in zip(sums, self.pivot)]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers (Python's if 64 bits are too few)."""
        near = x - self.pivot
        top = max(int(near.max(initial=0)), -int(near.min(initial=0)))
        if self.n * (top + 1) < 1 << 62:
            return near * self.n - np.array(self.rest, np.int64)
        return near.astype(object) * self.n - np.array(self.rest, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return self.scaled(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - S) squared over the dimensions, exactly."""
        scaled = self.scaled(x)
        if scaled.dtype != object:
            top = max(int(scaled.max(initial=0)), -int(scaled.min(initial=0)))
            if top * top * x.shape[1] >= 1 << 63:
                scaled = scaled.astype(object)
        return [int(v) for v in (scaled * scaled).sum(axis=1)]


def _solve(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows times the inverse of each upper triangular factor in turn."""
    for factor in factors:
        out = np.empty_like(rows)
        for j in range(factor.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
        rows = out
    return rows


def _gram(vectors: DataFrame, width: int, transform) -> tuple[np.ndarray, np.ndarray]:
    """(Gram matrix, column sums) of ``transform(x)`` over all rows.

    Each task adds up one matrix; a bounded number of tasks adds those up, so that what the
    driver gathers stays below 64 MB whatever the number of rows.
    """
    size = width * width + width
    schema = pa.schema([("part", pa.binary())])

    def cell(total):
        return pa.RecordBatch.from_pydict({"part": [total.tobytes()]}, schema=schema)

    def work(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                rows = transform(_matrix(batch.column("x")))
                total[:-width] += (rows.T @ rows).ravel()
                total[-width:] += rows.sum(axis=0)
        yield cell(total)

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part)
        yield cell(total)

    adders = max(1, min(ADDERS, GATHERED_BYTES // (8 * size)))
    parts = vectors.select("x").mapInArrow(work, "part binary").repartition(adders).mapInArrow(add, "part binary")
    total = np.sum([np.frombuffer(r["part"]) for r in parts.collect()], axis=0)
    return total[:-width].reshape(width, width), total[-width:]


def r_factor(vectors: DataFrame, centre: Centre, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(R, column sums): R'R is the Gram matrix of the centred rows A.

    A pass forms the Gram matrix G of the rows, A times the inverses of the factors so far, and
    takes the Cholesky factor of G plus a small shift, which keeps it positive definite when
    dimensions depend on each other.  The next pass works on rows that are closer to orthogonal,
    so that what the shift and the squared condition of G lost in one pass is won back in the
    next.  The product of the factors is R.
    """
    factors, column_sums = [], None
    unit = np.finfo(float).eps / 2
    for _ in range(PASSES):
        done = list(factors)
        gram, sums = _gram(vectors, width, lambda x: _solve(centre.centred(x), done))
        if column_sums is None:
            column_sums = sums
        norm = float(np.linalg.norm(gram, 2))
        if norm == 0:
            return np.zeros((width, width)), column_sums
        shift = 11 * width * (centre.n + width + 1) * unit * norm if not factors else 4 * width * unit * norm
        shift = min(shift, norm / 100)
        factors.append(np.linalg.cholesky(gram + shift * np.eye(width)).T)
    product = factors[0]
    for factor in factors[1:]:
        product = factor @ product
    return product, column_sums


class Whitening:
    """Mean and components of a fit list.

    ``components`` are unit eigenvectors of the covariance (divisor n) in its columns, by
    falling eigenvalue; ``explained`` are their shares of the trace.  Directions without
    variance have no component.
    """

    def __init__(self, centre: Centre, components: np.ndarray, eigenvalues: np.ndarray, trace: float,
                 identity_error: float):
        self.centre, self.components, self.eigenvalues = centre, components, eigenvalues
        self.explained = eigenvalues / trace if trace else eigenvalues
        self.identity_error = identity_error


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors of ``whole_vectors``; None if there are none.

    The components come from the singular values of R, an SVD of a d x d matrix on the driver;
    everything that reads rows is a distributed pass.  ``identity_error`` is measured: one more
    pass forms the covariance of the whitened rows.
    """
    n, sums = _sums(vectors)
    if not n:
        return None
    width, centre = len(sums), Centre(n, sums)
    factor, column_sums = r_factor(vectors, centre, width)
    _, singular, right = np.linalg.svd(factor)
    eigenvalues = singular * singular / n
    trace = float(eigenvalues.sum())
    used = int((singular > singular[0] * 1e-9).sum()) if singular[0] > 0 else 0
    take = min(components, used)
    axes, eigenvalues = right[:take].T, eigenvalues[:take]
    if not take:
        return Whitening(centre, axes, eigenvalues, trace, 0.0)
    scale = axes / np.sqrt(eigenvalues)
    mean = column_sums / n @ scale
    gram, rest = _gram(vectors, take, lambda x: centre.centred(x) @ scale - mean)
    covariance = gram / n - np.outer(rest, rest) / n / n
    return Whitening(centre, axes, eigenvalues, trace, float(np.abs(covariance - np.eye(take)).max()))


def whiten(vectors: DataFrame, fitted: Whitening | None) -> DataFrame:
    """(vec_id, deviation, whitened) of every vector: its squared distance from the mean times
    n squared, exactly, and its whitened coordinates.

    ``deviation`` is a BIGINT; a larger one is an error, not a wrong number.
    """
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    centre, scale = fitted.centre, fitted.components / np.sqrt(fitted.eigenvalues)

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                flat = np.ascontiguousarray(centre.centred(x) @ scale)
                places = np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(centre.deviation(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(places), pa.array(flat.ravel()))],
                    names=["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(work, WHITENED)


def whitened_embeddings(rows: DataFrame, components: int = COMPONENTS, key: str = "vec_id",
                        vector: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """The whitened vectors of a table and what they were whitened with.

    The whole numbers of the vectors are stored once and read by each pass: sums, three Gram
    passes, the measured error, the result.

    Defined results: vectors that cannot be used (see ``whole_vectors``) are left out; each row
    counts, also with an id that is NULL or occurs twice; directions without variance give no
    component, so equal vectors and a single vector give empty coordinates; an empty table gives
    an empty result; extra columns are ignored.
    """
    vectors = whole_vectors(rows, key, vector)
    fitted = fit(vectors, components)
    return whiten(vectors, fitted), fitted
