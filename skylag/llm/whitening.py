"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000, so their sums are exact. The
covariance V of the fit list is never formed: a pass over the vectors gives V Q for a
block Q of columns, each task adding up the products of its own centred rows. The
iteration is

1. a few Lanczos passes with one vector, for bounds of the spectrum from both sides;
2. a Chebyshev polynomial of V on the block, by its three-term recurrence, one pass a
   degree: on the unwanted interval, from the lower bound to the least Ritz value of the
   block, it stays below 1, above it it grows fast;
3. QR, one pass for V Q, Rayleigh-Ritz, residuals;

until the wanted pairs are certified: residuals at rounding level, or no longer falling
and far below the gaps. A last pass whitens the fit list and adds up its covariance,
whose distance from the identity is returned. The block has ``EXTRA`` columns more than
wanted; if that is as many as the vectors have entries, Rayleigh-Ritz is exact at once.

The driver holds blocks of dimensions x columns. Partial sums of the tasks are added up
by Spark before they get there, so that their number does not grow with the tasks.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import stored

COMPONENTS = 32
EXTRA = 16
DEGREE = 12
LANCZOS = 10
ROUNDS = 60
# Relative residual that ends the iteration, and the one accepted where it stops to fall.
TOLERANCE = 2e-15
ACCEPTED = 1e-10
SCALE, SHIFT = 64.0, 1_000_000
SEED = 13


@dataclass
class Fit:
    """Mean and components: ``count, sums`` exact, ``vectors`` a column for each component."""

    count: int
    sums: list
    trace: float
    values: object
    vectors: object
    residual: float
    passes: int


def whole_numbers(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, x``: the fit list. Vectors that are null, empty, or hold null or non-finite
    entries are left out; so are those whose length is not the commonest (of equally
    common ones the largest)."""
    entries = F.col("v")
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & (F.size(entries) > 0))
    rows = rows.select("vec_id", F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    rows = stored(rows, "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).take(2)
    return rows if len(lengths) < 2 else rows.where(F.size("x") == lengths[0].length)


def _summed(rows: DataFrame, part) -> dict[int, list[float]]:
    """Adds up the arrays that ``part`` makes of each task's batches: row number -> array.

    ``part(x)`` gets the rows of a batch and gives a matrix; all have one shape.
    """

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column(0)))
                total = own if total is None else total + own
        if total is not None:
            at = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(list(total), pa.list_(pa.float64()))], ["at", "sums"])

    parts = rows.select("x").mapInArrow(run, "at int, sums array<double>")
    each = parts.select("at", F.posexplode("sums").alias("pos", "value"))
    sums = each.groupBy("at", "pos").agg(F.sum("value").alias("value"))
    return {(r.at, r.pos): r.value for r in sums.collect()}


def matrix(column):
    """Equally long arrays as a matrix of whole numbers."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def centred(x, count: int, sums):
    """x - sums/count in doubles, the difference exact where it fits 63 bits."""
    import numpy as np

    sums = np.array(sums, dtype=object)
    # x - round(mean) is small; the rest of the mean is a fraction.
    near = np.array([int(s) // count for s in sums], dtype=np.int64)
    rest = np.array([(int(s) - int(k) * count) / count for s, k in zip(sums, near)])
    return (x - near).astype(np.float64) - rest


def fit(rows: DataFrame, components: int = COMPONENTS, extra: int = EXTRA) -> Fit | None:
    """The leading components of the covariance of ``x``, None for an empty list.

    Components whose variance is zero within rounding are left out.
    """
    import numpy as np

    total = rows.select(F.posexplode("x")).groupBy("pos").agg(
        F.sum(F.col("col").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")
    ).collect()
    if not total:
        return None
    count, dims = total[0].n, len(total)
    sums = [int(r.s) for r in sorted(total, key=lambda r: r.pos)]
    passes = 0

    def covariance(block):
        """V block, by one pass."""
        nonlocal passes
        passes += 1
        width = block.shape[1]

        def part(x):
            c = centred(x, count, sums)
            return c.T @ (c @ block)

        out = np.zeros((dims, width))
        for place, value in _summed(rows, part).items():
            out[place] = value
        return out / count

    squares = _summed(rows, lambda x: (centred(x, count, sums) ** 2).sum(axis=0)[None, :])
    trace = sum(squares.values()) / count
    wanted, width = min(components, dims), min(components + extra, dims)
    if trace == 0:
        return Fit(count, sums, 0.0, np.zeros(0), np.zeros((dims, 0)), 0.0, 0)
    rng = np.random.default_rng(SEED)
    block = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    low = _lower_bound(covariance, rng.standard_normal(dims), min(LANCZOS, dims - 1)) if width < dims else 0.0
    best, previous = None, float("inf")
    for _ in range(ROUNDS):
        product = covariance(block)
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        block, product = block @ turn, product @ turn
        residual = float(np.linalg.norm(product - block * values, axis=0)[:wanted].max() / values[0])
        best = Fit(count, sums, trace, values[:wanted], block[:, :wanted], residual, passes)
        if residual <= TOLERANCE or (residual <= ACCEPTED and residual > previous / 2) or width == dims:
            break
        previous = residual
        block = np.linalg.qr(_filtered(covariance, block, product, values[-1], min(low, values[-1] * 0.999), values[0]))[0]
    else:
        if best.residual > ACCEPTED:
            raise RuntimeError(f"components are not certified: residual {best.residual:.1e} after {passes} passes")
    kept = best.values > trace * dims * np.finfo(float).eps
    best.values, best.vectors = best.values[kept], best.vectors[:, kept]
    return best


def _lower_bound(covariance, start, steps: int) -> float:
    """A bound below the spectrum: the least Ritz value of some Lanczos steps less the last residual."""
    import numpy as np

    basis, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(steps):
        v = covariance(basis[-1][:, None])[:, 0]
        alpha.append(basis[-1] @ v)
        for _ in range(2):
            for q in basis:
                v = v - (q @ v) * q
        beta.append(float(np.linalg.norm(v)))
        if beta[-1] <= 1e-14 * abs(alpha[0]):
            break
        basis.append(v / beta[-1])
    small = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(small)[0] - beta[-1]))


def _filtered(covariance, block, product, upper: float, lower: float, top: float):
    """The block times the Chebyshev polynomial of V that is small from ``lower`` to ``upper``,
    scaled to 1 at ``top`` so that it does not overflow; the first product is known."""
    centre, radius = (upper + lower) / 2, (upper - lower) / 2
    sigma = radius / (top - centre)
    first = sigma
    now = (product - centre * block) * (sigma / radius)
    before = block
    for _ in range(DEGREE - 1):
        nxt = 1 / (2 / first - sigma)
        now, before = 2 * nxt / radius * (covariance(now) - centre * now) - sigma * nxt * before, now
        sigma = nxt
    return now


def whitened_rows(rows: DataFrame, found: Fit) -> DataFrame:
    """``vec_id, deviation, whitened``: the sum over dimensions of (n x - S)^2, exact, and
    the projections on the components over the root of their variance."""
    count, sums = found.count, found.sums
    turn = found.vectors / found.values ** 0.5
    # n x - S is n (x - near) - rest, of smaller numbers.
    near = [s // count for s in sums]
    rest = [s - k * count for s, k in zip(sums, near)]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            own = x - np.array(near, dtype=np.int64)
            far = (int(abs(own).max()) + 1) * count
            kind = np.int64 if far * far * len(sums) < 2 ** 62 else object
            gap = own.astype(kind) * count - np.array(rest, dtype=kind)
            deviation = (gap * gap).sum(axis=1).tolist()
            own = centred(x, count, sums) @ turn
            values = pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), own.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), values], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest distance between the covariance of the whitened fit list and the identity, by one pass."""
    import numpy as np

    count, sums, width = found.count, found.sums, len(found.values)
    turn = found.vectors / found.values ** 0.5

    def part(x):
        own = centred(x, count, sums) @ turn
        return np.vstack([own.T @ own, own.sum(axis=0)])

    total = np.zeros((width + 1, width))
    for place, value in _summed(rows, part).items():
        total[place] = value
    mean = total[width] / count
    return float(np.abs(total[:width] / count - np.outer(mean, mean) - np.eye(width)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """For each vector of the fit list and each component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``.

    Repeated rows are each answered; other columns are ignored. An empty list, or one
    without any variance, gives no rows. A deviation beyond 63 bits is an error.
    """
    spark = embeddings.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows = whole_numbers(embeddings, vector, key)
    found = fit(rows, components)
    if found is None or not len(found.values):
        return spark.createDataFrame([], schema)
    error = identity_error(rows, found)
    share = F.array(*[F.lit(float(v) / found.trace) for v in found.values])
    each = whitened_rows(rows, found).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.count).cast("long").alias("n"), "deviation",
        "whitened", share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
