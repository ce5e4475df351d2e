"""Shared folder, per-process values, and connected groups."""

import re
import sys
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words: maximal runs of bytes that are not ASCII white space; case folding of A-Z only.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Rows that a task of a step over few rows takes.
TASK_ROWS = 100_000
# Rows that a pair to compare counts as.
PAIR_ROWS = 50
# Bytes of a batch that are worked on at a time.
SLICE_BYTES = 4 << 20
# Whether Spark removes the shuffle files of a query at its end; else they stay until the driver collects garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Largest table that is broadcast.
BROADCAST = 64 << 20
# Comparisons with hubs go on, at most so often, while more pairs are left.
MANY_PAIRS, MOST_HUBS = 1e9, 5


# Folder of a local session without a shared one, and all that was made, oldest first.
_local: list[str] = []
_made: list[str] = []


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share.

    That is ``spark.checkpoint.dir``, where unset a folder of the warehouse; only a local
    session gets a temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and spark.sparkContext.master.startswith("local"):
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="shared-"))
        root = _local[0]
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    _made.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch():
    """Deletes at its end what is made inside. What is left must have been written elsewhere.

    A store that only Spark reaches keeps its tables.
    """
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            try:
                store, path = open_store(_made.pop())
                store.delete_dir(path)
            except (OSError, ValueError):  # pyarrow's errors are kinds of these
                continue


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: lineage ends here.

    Nothing else uses the shuffles of the write, so their files go with it.
    """
    spark = df.sparkSession
    uri = shared_uri(spark, name)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(uri)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(uri)


def give_back() -> None:
    """Return memory that is free to the system: glibc and Arrow keep it for a process's later work,
    but a driver or a worker does other work next."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def slices(batches):
    """The rows of Arrow batches in order, about ``SLICE_BYTES`` at a time: what is made of a batch
    is held several times over, in the worker and where it is read again."""
    give_back()
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def spread(work: DataFrame) -> DataFrame:
    """Rows that each stand for much work (a file, a block of a file), dealt out one by one.

    Adaptive execution would join such small rows into one task.
    """
    spark = work.sparkSession
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return work.repartition(max(1, min(work.count(), tasks)))


def open_store(uri: str):
    """File system and path of a URI, for tasks that write or read files of their own."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def once_per_process(name: str, build):
    """A value that a worker process builds once and keeps for its later tasks."""
    kept = sys.__dict__.setdefault("_kept_by_process", {})
    if name not in kept:
        kept[name] = build()
    return kept[name]


def few_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for a step over so few rows that starting tasks and writing files would be most of its work."""
    return max(1, min(rows // TASK_ROWS + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def with_least(links: DataFrame, tasks: int) -> DataFrame:
    """Links ``u, v`` with ``least``, the smallest v of their u.

    The minimum is combined inside each task. It is grouped by one column more than
    the join uses, so the join deals both sides anew and Spark can split a u that
    holds a large share of the links.
    """
    least = (
        links.groupBy("u", F.pmod(F.xxhash64("u"), F.lit(7)).alias("part"))
        .agg(F.min("v").alias("least"))
        .select(F.col("u").alias("of"), "least").coalesce(tasks)
    )
    return links.join(least, F.col("u") == F.col("of")).drop("of").coalesce(tasks)


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected groups of undirected links ``a, b``: one row ``node, root`` for each
    node that has a link, root being the smallest node of its group.

    Alternates the two star steps: larger neighbours move to the smallest neighbour,
    then smaller ones do, until every group is one star. Each round is written to the
    shared folder; rounds grow with the logarithm of a group's diameter, and links that
    are stars already need none. Nothing is collected but whether a round is the last.
    """
    tasks = few_tasks(links.sparkSession, links.count())
    ends = links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v")
    stars = stored(ends.distinct().coalesce(tasks), name)
    while not _are_stars(stars, tasks):
        both = stars.union(stars.selectExpr("v AS u", "u AS v"))
        large = with_least(both, tasks).where("v > u").selectExpr("v AS u", "least(u, least) AS v").distinct().coalesce(tasks)
        near = with_least(large, tasks)
        small_ = near.where("v <> least").selectExpr("v AS u", "least AS v").union(
            near.selectExpr("u", "least AS v")
        ).distinct()
        stars = stored(small_.coalesce(tasks), name)
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.selectExpr("u AS node", "v AS root").union(roots)


def _are_stars(links: DataFrame, tasks: int) -> bool:
    """Whether no node has two smaller neighbours, or both a smaller and a larger one."""
    ends = links.selectExpr("u AS node", "1 AS up", "0 AS down").union(links.selectExpr("v", "0", "1"))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).coalesce(tasks)
    return nodes.where("up + down > 1").isEmpty()


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """The stored table, marked for broadcast if its rows fit into ``BROADCAST`` bytes; else
    Spark joins it by a shuffle, which it may split."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST else df


def near_components(
    buckets: DataFrame, linker, far: str, name: str, many_pairs: float = MANY_PAIRS, details: DataFrame | None = None,
    no_link: str = "false", beyond: str | None = None,
) -> DataFrame:
    """Connected groups of nodes that share a bucket and are linked: ``node, root`` for
    nodes with a link.

    ``buckets`` has ``bucket, node, mark``, a mark being a value of the node. ``far`` is
    SQL on two marks ``x`` and ``y`` that is true of pairs which are surely no link. It may
    allow more in some buckets than in others if those have the smaller numbers: a pair
    that is far in a bucket is far in all later ones.
    ``linker`` gets the nodes that share a bucket and gives a function that keeps the
    links of a frame of pairs ``a, b``. ``details`` has ``node, detail`` of every node, and ``no_link``
    is SQL on two details ``x`` and ``y`` that is true only of pairs which are no link: a test too wide for
    marks, made where the pairs left meet, so that those which fail are never rows. ``beyond`` is SQL on
    two marks ``x <= y`` that is true only of pairs which are no link in any bucket and, with one, of all
    pairs of its bucket that enclose it in the order of marks: rows without a partner then need no details.

    Exact, without all pairs of a bucket: first each node is compared with one hub, the
    smallest near node of its buckets' smallest, and groups are joined; then, in buckets
    that still hold two groups, with a largest one. While the pairs left are very many
    (``many_pairs``), further hubs follow, picked by a hash, so that each large group of a
    bucket gets one soon; then come the pairs not compared yet that share a bucket and
    are still in different groups, in one bucket for each set of nodes. A bucket of near copies is
    one group after the first steps, and has no pairs left.

    The rows of a bucket pass through one task in order, without being held in memory.
    Rows get their node's group by a window over the node, which has few rows.
    """
    def apart(x: str, y: str, test: str = far) -> str:
        return re.sub(r"\b[xy]\b", lambda m: x if m[0] == "x" else y, test)

    whole = Window.partitionBy("bucket")
    own = F.struct("node", "mark")
    shared = stored(
        buckets.select(
            "*", F.min(own).over(whole).alias("low"), F.max(own).over(whole).alias("high"),
            F.count("*").over(whole).alias("members"),
        ).where(f"low <> high AND NOT (members = 2 AND {apart('low.mark', 'high.mark')})").drop("members"),
        f"{name}-shared",
    )
    link = linker(shared.select("node").distinct())
    nodes = shared.agg(F.approx_count_distinct("node")).first()[0]
    links = tested = None
    for turn in range(MOST_HUBS):
        if turn < 2:
            hub, rows = ("low", "high")[turn], shared
        else:
            first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("rank"), "node", "mark", "grp"))
            hub, rows = "first", shared.select("*", first.over(whole).alias("first")).where("grp <> first.grp")
        near = rows.where(f"node <> {hub}.node AND NOT {apart('mark', f'{hub}.mark')}")
        pairs = near.groupBy("node").agg(F.min(f"{hub}.node").alias("hub")).selectExpr(
            "least(node, hub) AS a", "greatest(node, hub) AS b"
        ).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        # Comparing a pair may be much work.
        pairs = stored(pairs.coalesce(few_tasks(pairs.sparkSession, PAIR_ROWS * nodes)), f"{name}-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = link(pairs)
        links = stored(found if links is None else links.unionByName(found), f"{name}-links")
        shared = _divided(shared, components(links, f"{name}-stars"), name)
        if turn:
            sizes = shared.groupBy("bucket").count().agg(
                F.sum("count").alias("rows"), F.sum(F.expr("double(count) * (count - 1) / 2")).alias("pairs")
            ).first()
            if (sizes.pairs or 0) <= many_pairs:
                break
    # Buckets of a node before each of its buckets: a pair counts in the first that both share.
    before = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shared = _one_of_each(shared)
    if beyond is not None:
        shared = _with_partners(shared, lambda x, y: apart(x, y, beyond))
    shared = stored(shared.withColumn("earlier", F.collect_list("bucket").over(before)), f"{name}-rest")
    if details is not None:
        shared = shared.join(details.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).drop("of")
    left, right = shared.alias("l"), shared.alias("r")
    meet = f"l.bucket = r.bucket AND l.grp < r.grp AND NOT {apart('l.mark', 'r.mark')} AND NOT arrays_overlap(l.earlier, r.earlier)"
    if details is not None:
        meet += f" AND NOT {apart('l.detail', 'r.detail', no_link)}"
    rest = left.join(right, F.expr(meet)).selectExpr("least(l.node, r.node) AS a", "greatest(l.node, r.node) AS b").distinct()
    links = stored(links.unionByName(link(rest.join(tested, ["a", "b"], "left_anti"))), f"{name}-links")
    return components(links, f"{name}-stars")


def _with_partners(shared: DataFrame, beyond: Callable[[str, str], str]) -> DataFrame:
    """The rows whose neighbour before or behind, in their bucket's order of marks, is not beyond
    reach, in buckets where such rows are of more than one group.

    A row dropped here is beyond all others of its bucket, as those enclose its neighbours.
    """
    ordered, whole = Window.partitionBy("bucket").orderBy("mark"), Window.partitionBy("bucket")
    near = shared.select("*", F.lag("mark").over(ordered).alias("before"), F.lead("mark").over(ordered).alias("behind")).where(
        f"before IS NOT NULL AND NOT {beyond('before', 'mark')} OR behind IS NOT NULL AND NOT {beyond('mark', 'behind')}"
    ).drop("before", "behind")
    ends = near.select("*", F.min("grp").over(whole).alias("g0"), F.max("grp").over(whole).alias("g1"))
    return ends.where("g0 <> g1").drop("g0", "g1")


def _one_of_each(shared: DataFrame) -> DataFrame:
    """The rows of one bucket for each set of nodes: no pair is far in the first of its buckets and near in
    a later one, so the first of equal buckets will do.

    Sets are told apart by their size, ends and two hashes of 64 bits.
    """
    sets = shared.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("z"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    kept = sets.groupBy("n", "a", "z", "x", "y").agg(F.min("bucket").alias("kept")).select("kept")
    return shared.join(kept, F.col("bucket") == F.col("kept"), "left_semi")


def _divided(shared: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """The rows of buckets that hold nodes of more than one group, with ``grp``."""
    plain, tasks = shared.drop("grp"), few_tasks(shared.sparkSession, shared.count())
    both = plain.withColumn("root", F.lit(None).cast("long")).unionByName(groups, allowMissingColumns=True)
    root = F.max("root").over(Window.partitionBy("node"))
    known = both.withColumn("grp", F.coalesce(root, "node")).where("low IS NOT NULL").select(*plain.columns, "grp").coalesce(tasks)
    whole = Window.partitionBy("bucket")
    ends = known.select("*", F.min("grp").over(whole).alias("g0"), F.max("grp").over(whole).alias("g1"))
    return stored(ends.where("g0 <> g1").drop("g0", "g1").coalesce(tasks), f"{name}-open")
