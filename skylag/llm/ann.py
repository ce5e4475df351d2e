"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample with balanced k-means, kept in memory, and
searched through a graph of their neighbours. A vector on a boundary is written to
the lists of several centroids: to those nearly as close as its closest, unless a nearer
list that it is in lies closer to the centroid than the vector does, and to ``COPIES`` at
most. A query reads the lists whose centroid is within a ratio of its closest centroid,
and scores them exactly. The ratio is the one that finds ``TARGET`` of the true
neighbours inside the sample.

Lists that lie side by side are packed into units of bounded bytes, a longer list into
several; queries are sent once to each unit that holds lists of theirs, and come back with
the best of the unit, so rows are per query and unit, not per query and list.

Inner products become distances by one more component: with M the largest norm,
a vector v gets sqrt(M^2 - |v|^2) and a query q gets 0, and the order of distances
is the order of inner products. Copies of a vector are one entry, and copies of a
query are one search. Vectors of different lengths are compared with their own kind
only; all but the commonest lengths are compared without lists, which is exact.
"""

import math
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import stored

# Vectors the centroids are fitted on, and vectors per list it aims at.
FIT_VECTORS = 20_000
LIST_VECTORS = 200
ROUNDS = 12
# Neighbours of a centroid in the graph, and centroids that a search expands at least.
DEGREE = 16
BEAM = 24
# A vector goes to lists this much farther than the closest at most, and to so many in all.
BOUNDARY = 1.05
COPIES = 4
# Share of the neighbours inside the sample that the ratio of a query must find, and queries it is measured on.
TARGET, MEASURED = 0.96, 500
# Bytes of the vectors of a unit, and queries compared with it in one task.
UNIT_BYTES = 1 << 24
UNIT_QUERIES = 4096
# Rows of a distance matrix at a time.
CHUNK = 512
# Lengths of vectors that get lists of their own.
KINDS = 8
QUERY_EVERY = 20


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vec`` of the vectors that take part.

    Left out are null ids, null, empty and zero vectors and those with null or non-finite
    components.
    """
    fits = F.expr("""vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0
        AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
        AND exists(embedding, x -> x <> 0)""")
    # Zero has two signs, which would make two of one vector.
    plain = F.expr("transform(embedding, x -> cast(x AS double) + 0.0D)")
    return embeddings.where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), plain.alias("vec"))


def _squares(a, b):
    import numpy as np

    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


class Lists:
    """Centroids with their graph."""

    def __init__(self, sample, n_lists: int, seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        n = len(sample)
        k = max(1, min(n_lists, n))
        centers = sample[rng.choice(n, k, replace=False)].copy()
        penalty, target = np.zeros(k), n / k
        for _ in range(ROUNDS):
            own, near = np.empty(n, dtype=np.int64), np.empty(n)
            for at in range(0, n, CHUNK):
                d = _squares(sample[at:at + CHUNK], centers)
                own[at:at + CHUNK], near[at:at + CHUNK] = np.argmin(d + penalty, axis=1), d.min(axis=1)
            size = np.bincount(own, minlength=k)
            # Crowded lists look farther away in the next round.
            penalty = np.maximum(0, penalty + 0.1 * near.mean() * (size / target - 1))
            order = np.argsort(own, kind="stable")
            filled = np.flatnonzero(size)
            sums = np.add.reduceat(sample[order], np.concatenate([[0], np.cumsum(size[filled])[:-1]]), axis=0)
            centers[filled] = sums / size[filled][:, None]
            for c in np.flatnonzero(size == 0):
                centers[c] = sample[rng.integers(n)]
        # Centroids are numbered along their main direction, so that neighbours have near numbers.
        spread = centers - centers.mean(axis=0)
        main = np.linalg.eigh(spread.T @ spread)[1][:, -1]
        centers = centers[np.argsort(spread @ main, kind="stable")]
        edges = [set() for _ in range(k)]
        for at in range(0, k, CHUNK):
            d = _squares(centers[at:at + CHUNK], centers)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            degree = min(DEGREE, k - 1)
            if degree:
                for c, row in enumerate(np.argpartition(d, degree - 1, axis=1)[:, :degree].tolist(), at):
                    edges[c].update(row)
                    for other in row:
                        edges[other].add(c)
        # A chain through all centroids keeps the graph in one piece.
        for c in range(1, k):
            edges[c].add(c - 1)
            edges[c - 1].add(c)
        self.centers, self.edges = centers, [sorted(e) for e in edges]
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 16)).astype(np.int64)).tolist()

    @classmethod
    def of(cls, centers, edges, entries) -> "Lists":
        """Lists from their parts, which travel without the class."""
        lists = cls.__new__(cls)
        lists.centers, lists.edges, lists.entries = centers, edges, entries
        return lists

    def search(self, point, ratio: float, beam: int = BEAM) -> list[tuple[float, int]]:
        """The centroids within ``ratio`` of the closest one found, as distance and number, nearest first.

        Best-first over the graph: the nearest centroid waiting in a heap is expanded, until
        at least ``beam`` are and the nearest waiting lies beyond the ratio.
        """
        import numpy as np

        seen, waiting, found = set(self.entries), [], []
        new = self.entries
        while True:
            if new:
                gaps = self.centers[new] - point
                for d, c in zip(np.sqrt(np.einsum("ij,ij->i", gaps, gaps)).tolist(), new):
                    heappush(waiting, (d, c))
            if not waiting or len(found) >= beam and waiting[0][0] > ratio * found[0][0]:
                break
            nearest = heappop(waiting)
            found.append(nearest)
            # The closest one is kept in front.
            if nearest < found[0]:
                found[0], found[-1] = found[-1], found[0]
            new = [c for c in self.edges[nearest[1]] if c not in seen]
            seen.update(new)
        found.sort()
        limit = ratio * found[0][0]
        return [f for f in found if f[0] <= limit]

    def homes(self, point) -> list[int]:
        """The lists that a vector is written to."""
        import numpy as np

        chosen: list[int] = []
        for d, c in self.search(point, BOUNDARY, COPIES):
            gaps = self.centers[chosen] - self.centers[c]
            if not chosen or (np.einsum("ij,ij->i", gaps, gaps) > d * d).all():
                chosen.append(c)
                if len(chosen) == COPIES:
                    break
        return chosen


def probe_ratio(lists: Lists, sample, points, k: int) -> float:
    """The ratio at which the points find ``TARGET`` of their k nearest inside the sample.

    ``points`` are the first vectors of the sample as queries.
    """
    import numpy as np

    homes = [lists.homes(v) for v in sample]
    needed = []
    for at in range(0, len(points), CHUNK):
        part = points[at:at + CHUNK]
        d = np.sqrt(_squares(part, lists.centers))
        gaps = _squares(part, sample)
        gaps[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
        best = np.argsort(gaps, axis=1)[:, :min(k, len(sample) - 1)]
        for q, row in enumerate(best):
            closest = max(d[q].min(), 1e-300)
            needed += [d[q, homes[j]].min() / closest for j in row]
    return float(np.quantile(needed, TARGET)) if needed else 1.0


def _extended(vectors, largest: float, query: bool):
    import numpy as np

    rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(largest**2 - (vectors**2).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _matrix(column):
    import numpy as np

    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _postings(vectors: DataFrame, shared, largest: float) -> DataFrame:
    """One row per vector and list: ``length, list, key, first_id, vec``."""

    def run(batches):
        import pyarrow as pa

        lists = Lists.of(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            homes = [lists.homes(p) for p in _extended(_matrix(batch.column(3)), largest, False)]
            take = pa.array([k for k, own in enumerate(homes) for _ in own], pa.int64())
            columns = [c.take(take) for c in batch.columns]
            home = pa.array([c for own in homes for c in own], pa.int32())
            yield pa.RecordBatch.from_arrays([columns[0], home, *columns[1:]], ["length", "list", "key", "first_id", "vec"])

    rows = vectors.select("length", "key", "first_id", "vec")
    return rows.mapInArrow(run, "length int, list int, key long, first_id long, vec array<double>")


def _probes(points: DataFrame, shared, largest: float, ratio: float, k: int, units: list[tuple[int, int, int]]) -> DataFrame:
    """One row per query and unit: ``length, unit, key, vec, lists``; ``units`` are for each list its
    first unit, their number, and its entries.

    A query whose lists may hold less than k other vectors reads the next ones too.
    """

    def run(batches):
        import pyarrow as pa

        lists = Lists.of(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            of, unit, reads = [], [], []
            for q, point in enumerate(_extended(_matrix(batch.column(2)), largest, True)):
                asked: dict[int, list[int]] = {}
                near, held, enough = lists.search(point, ratio), 0, COPIES * (k + 1)
                if sum(units[c][2] for _, c in near) < enough:
                    wanted, near = near, lists.search(point, math.inf)
                    upto = 0
                    while upto < len(near) and (upto < len(wanted) or held < enough):
                        held += units[near[upto][1]][2]
                        upto += 1
                    near = near[:upto]
                for _, c in near:
                    first, n, _ = units[c]
                    for u in range(first, first + n):
                        asked.setdefault(u, []).append(c)
                of += [q] * len(asked)
                unit += asked.keys()
                reads += asked.values()
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), pa.array(unit, pa.int32()), batch.column(1).take(take), batch.column(2).take(take),
                pa.array(reads, pa.list_(pa.int32())),
            ], ["length", "unit", "key", "vec", "lists"])

    return points.select("length", "key", "vec").mapInArrow(
        run, "length int, unit int, key long, vec array<double>, lists array<int>"
    )


def _scored(entries: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query, key, first_id, score``: for each query and unit the best k + 1 entries of the lists it reads there.

    A query may be a copy of its nearest entry, so one more than k is kept. Entries with
    equal products come in the order of their smallest ids.
    """
    # Many queries of one unit are cut into parts, each of which meets the unit's entries.
    asks = stored(asked.groupBy("length", "unit").agg(F.count("*").alias("queries")).select(
        F.col("length").alias("al"), F.col("unit").alias("au"),
        F.expr(f"cast(ceil(queries / {UNIT_QUERIES}) AS int)").alias("parts"),
    ), "ann-asks")
    same = F.expr("length = al AND unit = au")
    asked = asked.join(asks, same).withColumn("part", F.expr("cast(pmod(xxhash64(key), parts) AS int)")).drop("al", "au", "parts")
    entries = entries.join(asks, same).withColumn("part", F.expr("explode(sequence(0, parts - 1))")).drop("al", "au", "parts")

    def score(entries, asked):
        import numpy as np
        import pyarrow as pa

        names = ["query", "key", "first_id", "score"]
        if not entries.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})
        entries, asked = entries.combine_chunks(), asked.combine_chunks()
        of_list = entries["list"].to_numpy()
        order = np.argsort(of_list, kind="stable")
        matrix = _matrix(entries["vec"].combine_chunks())[order]
        keys, ids, of_list = (entries[c].to_numpy()[order] for c in ("key", "first_id", "list"))
        starts = np.flatnonzero(np.concatenate([[True], of_list[1:] != of_list[:-1]])).tolist()
        spans = {int(of_list[a]): slice(a, b) for a, b in zip(starts, [*starts[1:], len(of_list)])}
        points, queries, reads = _matrix(asked["vec"].combine_chunks()), asked["key"].to_numpy(), asked["lists"].to_pylist()
        widest = np.sqrt((matrix**2).sum(axis=1).max())
        out = []
        for at in range(0, len(points), 256):
            part = points[at:at + 256]
            readers: dict[int, list[int]] = {}
            for q, own in enumerate(reads[at:at + 256]):
                for c in own:
                    readers.setdefault(c, []).append(q)
            near = np.full((len(part), len(matrix)), -np.inf)
            for c, own in readers.items():
                if c in spans:
                    near[own, spans[c]] = part[own] @ matrix[spans[c]].T
            # A vector may be there once for each of its lists.
            most = min(COPIES * (k + 1), len(matrix))
            least = np.partition(near, len(matrix) - most, axis=1)[:, len(matrix) - most]
            for q in range(len(part)):
                margin = 1e-12 * widest * np.sqrt((part[q] ** 2).sum())
                row = np.flatnonzero((near[q] >= least[q] - margin) & (near[q] > -np.inf))
                # The rows are summed alike wherever an entry lies, so equal products tie exactly.
                exact = (matrix[row] * part[q]).sum(axis=1)
                # A vector in several lists of the unit is one entry.
                best = np.lexsort((ids[row], -exact))
                _, first = np.unique(keys[row][best], return_index=True)
                best = best[np.sort(first)][:k + 1]
                out.append((np.full(len(best), queries[at + q]), keys[row][best], ids[row][best], exact[best]))
        return pa.table({n: np.concatenate(c) for n, c in zip(names, zip(*out))})

    by = ("length", "unit", "part")
    found = entries.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(
        score, "query long, key long, first_id long, score double"
    )
    return found.groupBy("query", "key", "first_id").agg(F.max("score").alias("score"))


def _unit_vectors(length: int) -> int:
    return max(256, UNIT_BYTES // (8 * length))


def _exact_units(distinct: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and queries without lists: the vectors of a length are spread over units, and each query reads all."""
    units = distinct.groupBy("length").agg(F.count("*").alias("n")).select(
        F.col("length").alias("of_length"), F.expr(f"cast(ceil(n / greatest(256, {UNIT_BYTES} div (8 * length))) AS int)").alias("units")
    )
    same = F.col("length") == F.col("of_length")
    entries = distinct.join(units, same).selectExpr(
        "length", "0 AS list", "key", "first_id", "vec", "cast(pmod(xxhash64(key), units) AS int) AS unit"
    )
    asked = points.join(units, same).selectExpr(
        "length", "explode(sequence(0, units - 1)) AS unit", "key", "vec", "array(0) AS lists"
    )
    return entries, asked


def _listed_units(
    distinct: DataFrame, points: DataFrame, n: int, length: int, k: int, list_vectors: int, fit_vectors: int, probe: float | None
) -> tuple[DataFrame, DataFrame]:
    """Entries and queries of one length, by posting lists."""
    import numpy as np

    spark = distinct.sparkSession
    largest = distinct.agg(F.max(F.expr("sqrt(aggregate(vec, 0D, (s, x) -> s + x * x))"))).first()[0]
    sample = np.array([r[0] for r in distinct.orderBy("key").limit(fit_vectors).select("vec").collect()])
    whole = _extended(sample, largest, False)
    lists = Lists(whole, max(1, min(len(sample) // 4, round(n / list_vectors))))
    ratio = probe or probe_ratio(lists, whole, _extended(sample[:MEASURED], largest, True), k)
    shared = spark.sparkContext.broadcast((lists.centers, lists.edges, lists.entries))
    postings = stored(_postings(spread_rows(distinct), shared, largest), "ann-postings")
    # Lists are packed in the order of their numbers; as many rows as lists come to the driver.
    sizes = dict(postings.groupBy("list").count().collect())
    units, unit, held, most = [], 0, 0, _unit_vectors(length)
    for c in range(len(lists.centers)):
        size = sizes.get(c, 0)
        if held and held + size > most:
            unit, held = unit + 1, 0
        pieces = -(-size // most) or 1
        units.append((unit, pieces, size))
        held += size
        if pieces > 1:
            unit, held = unit + pieces, 0
    places = spark.createDataFrame([(c, u, m) for c, (u, m, _) in enumerate(units)], "of_list int, first_unit int, pieces int")
    entries = postings.join(F.broadcast(places), F.col("list") == F.col("of_list")).selectExpr(
        "length", "list", "key", "first_id", "vec", "cast(first_unit + pmod(xxhash64(key), pieces) AS int) AS unit"
    )
    return entries, stored(_probes(spread_rows(points), shared, largest, ratio, k, units), "ann-probes")


def nearest(
    embeddings: DataFrame, k: int = 20, query_every: int = QUERY_EVERY,
    list_vectors: int = LIST_VECTORS, fit_vectors: int = FIT_VECTORS, probe: float | None = None,
) -> DataFrame:
    """The k nearest found by inner product of every row whose vec_id is divisible by
    ``query_every``: ``query_id, rank, vec_id, score``, ties to the smaller vec_id.

    All rows but the query's own are candidates; rows that repeat a vec_id are one row
    for each vector. Fewer than k candidates are all returned. Columns other than
    vec_id and embedding are ignored. ``probe`` replaces the measured ratio.
    """
    rows = stored(usable(embeddings).distinct().withColumns(
        {"length": F.size("vec"), "key": F.xxhash64("vec")}), "ann-rows")
    distinct = stored(rows.groupBy("length", "key").agg(
        F.first("vec").alias("vec"), F.min("vec_id").alias("first_id")), "ann-distinct")
    queries = rows.where(F.col("vec_id") % query_every == 0)
    asked_keys = queries.select(F.col("length").alias("ql"), F.col("key").alias("asked")).distinct()
    points = stored(distinct.join(asked_keys, F.expr("length = ql AND key = asked"), "left_semi"), "ann-points")
    common = distinct.groupBy("length").count().orderBy(F.desc("count"), "length").limit(KINDS).collect()
    listed = {length: n for length, n in common if n >= 4 * list_vectors}
    others = ~F.col("length").isin(*listed) if listed else F.lit(True)
    entries, asked = _exact_units(distinct.where(others), points.where(others))
    for length, n in listed.items():
        own = F.col("length") == length
        more = _listed_units(distinct.where(own), points.where(own), n, length, k, list_vectors, fit_vectors, probe)
        entries, asked = entries.unionByName(more[0]), asked.unionByName(more[1])
    near = stored(_scored(entries, asked, k), "ann-near")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    # Of the copies of an entry only the k + 1 smallest ids can be among the k nearest.
    copies = rows.select(F.col("key").alias("entry"), "vec_id", F.row_number().over(
        Window.partitionBy("key").orderBy("vec_id")).alias("copy")).where(F.col("copy") <= k + 1)
    per_point = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = near.join(copies, F.col("key") == F.col("entry")).select(
        "query", "vec_id", "score", F.row_number().over(per_point).alias("place")
    ).where(F.col("place") <= k + 1)
    # Every copy of a query takes the same neighbours, less itself.
    answers = queries.select(F.col("key").alias("of"), F.col("vec_id").alias("query_id")).join(
        best, F.col("of") == F.col("query")
    ).where("query_id <> vec_id")
    per_query = Window.partitionBy("query_id", "of").orderBy(F.desc("score"), "vec_id")
    return answers.select(
        "query_id", F.row_number().over(per_query).alias("rank"), "vec_id", "score"
    ).where(F.col("rank") <= k)


def spread_rows(rows: DataFrame) -> DataFrame:
    """Small rows that cost much work each, dealt over all tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
