"""Per-key processing without imbalance: fragment-replicate by estimated load.

Rows are counted per key with a map-side aggregate. A key above a share of one
task's load is *large*; there are at most ``LARGE_PER_TASK * tasks`` of them, so
the plan that travels to the driver is bounded whatever the number of keys.
The others are folded into ``BUCKETS_PER_TASK * tasks`` hash buckets. Large keys
are cut into shards in proportion to their rows, and shards and buckets are
packed onto tasks, heaviest first into the least loaded task. A matching side is
sent only to the tasks that hold shards of its key.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.session import parallelism, stage, unused_name

LARGE_PER_TASK = 4
BUCKETS_PER_TASK = 8


@dataclass(frozen=True)
class Placement:
    """Where the rows of each key go.

    large:   (position of the key in `keys`, rows, task of each shard)
    buckets: task of each hash bucket of the remaining keys
    """

    tasks: int
    keys: list[tuple]
    shards: list[list[int]]
    buckets: list[int]
    loads: list[float]


def pack(pieces: list[tuple[float, object]], tasks: int) -> tuple[dict, list[float]]:
    """Longest-processing-time packing: {piece: task} and the load of each task."""
    heap = [(0.0, t) for t in range(tasks)]
    where: dict = {}
    loads = [0.0] * tasks
    for weight, piece in sorted(pieces, key=lambda p: (-p[0], str(p[1]))):
        load, task = heapq.heappop(heap)
        where[piece] = task
        loads[task] = load + weight
        heapq.heappush(heap, (loads[task], task))
    return where, loads


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def plan_placement(df: DataFrame, keys: list[str], tasks: int | None = None, other: DataFrame | None = None) -> Placement:
    """Count rows per key and place shards and buckets on tasks.

    other: the side that will be joined; a key's load is the rows of both sides.
    Rows of other alone load no task.
    """
    spark = df.sparkSession
    tasks = tasks or parallelism(spark)
    n, m = unused_name("n_rows", df), unused_name("m_rows", df)
    counts = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(n))
    if other is not None:
        more = other.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(m))
        counts = counts.join(more, keys, "left").select(*[F.col(f"`{k}`") for k in keys], (F.col(n) + F.coalesce(F.col(m), F.lit(0))).alias(n))
    counts = stage(counts, "key-counts")
    total = counts.agg(F.sum(n)).first()[0] or 0
    limit = max(1.0, total / (LARGE_PER_TASK * tasks))
    large = counts.where(F.col(n) > limit).collect()
    nb = BUCKETS_PER_TASK * tasks
    small = counts.where(F.col(n) <= limit).groupBy(_bucket(keys, nb).alias("bucket")).agg(F.sum(n).alias("load")).collect()
    pieces: list[tuple[float, object]] = []
    for i, row in enumerate(large):
        parts = max(1, -(-int(row[n]) // int(max(1, limit))))
        pieces += [(row[n] / parts, ("key", i, s)) for s in range(parts)]
    pieces += [(float(r["load"]), ("bucket", r["bucket"])) for r in small]
    where, loads = pack(pieces, tasks)
    shards: list[list[int]] = [[] for _ in large]
    buckets = [b % tasks for b in range(nb)]
    for piece, task in sorted(where.items(), key=lambda x: x[0]):
        if piece[0] == "key":
            shards[piece[1]].append(task)
        else:
            buckets[piece[1]] = task
    return Placement(tasks, [tuple(r[k] for k in keys) for r in large], shards, buckets, loads)


def _prefix(*frames: DataFrame) -> str:
    """A beginning that no column of the frames has."""
    names, p = [c.lower() for f in frames for c in f.columns], "_p"
    while any(c.startswith(p) for c in names):
        p += "_"
    return p


def _frames(df: DataFrame, keys: list[str], plan: Placement, p: str) -> tuple[DataFrame, DataFrame]:
    """The placement as two frames of bounded size."""
    spark = df.sparkSession
    types = [T.StructField(f"{p}k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    large = spark.createDataFrame(
        [(*key, shards) for key, shards in zip(plan.keys, plan.shards)], T.StructType([*types, T.StructField(f"{p}shards", T.ArrayType(T.IntegerType()))])
    )
    bucket = spark.createDataFrame(list(enumerate(plan.buckets)), f"`{p}bucket` int, `{p}task` int")
    return large, bucket


def _with_shards(df: DataFrame, keys: list[str], plan: Placement, p: str) -> DataFrame:
    """df with <p>shards, the tasks that hold the key of the row (one task for keys that aren't large)."""
    large, bucket = _frames(df, keys, plan, p)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"{p}k{i}")) for i, k in enumerate(keys)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return (
        df.join(F.broadcast(large), cond, "left")
        .withColumn(f"{p}bucket", _bucket(keys, len(plan.buckets)))
        .join(F.broadcast(bucket), f"{p}bucket", "left")
        .withColumn(f"{p}shards", F.coalesce(f"{p}shards", F.array(f"{p}task")))
        .drop(*[f"{p}k{i}" for i in range(len(keys))], f"{p}bucket", f"{p}task")
    )


def fragment(df: DataFrame, keys: list[str], plan: Placement, task: str) -> DataFrame:
    """df with the column `task`, and every row in the partition of that number.

    The shard of a row of a large key comes from its content and its place in
    the input, so repeated rows spread too and a repeated task gives the same.
    """
    p = _prefix(df)
    spread = F.xxhash64(*[F.col(f"`{c}`").cast("string") if isinstance(df.schema[c].dataType, T.MapType) else F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id())
    placed = _with_shards(df.withColumn(f"{p}spread", spread), keys, plan, p)
    at = F.element_at(f"{p}shards", F.pmod(F.col(f"{p}spread"), F.size(f"{p}shards")).cast("int") + 1)
    return placed.withColumn(task, at).drop(f"{p}shards", f"{p}spread").repartitionById(plan.tasks, F.col(task))


def replicate(df: DataFrame, keys: list[str], plan: Placement, task: str) -> DataFrame:
    """df once for each task that holds a shard of its key."""
    p = _prefix(df)
    return _with_shards(df, keys, plan, p).withColumn(task, F.explode(F.array_distinct(f"{p}shards"))).drop(f"{p}shards").repartitionById(plan.tasks, F.col(task))


def balanced_join(left: DataFrame, right: DataFrame, keys: list[str], extra: Column | None = None, how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Equi-join on `keys` (same names on both sides) in which no task gets a whole large key of `left`.

    left is cut into shards, right goes only where shards of its keys are.
    how: inner, left, left_semi or left_anti; all are exact because each left row
    meets every right row of its key in one task. Null keys match nothing.
    `extra` is a further condition over columns of both sides. Columns of right
    other than the keys must not clash with left; a clash raises ValueError.
    An empty side gives what the plain join gives.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how={how!r} is not supported")
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    plan = plan_placement(left, keys, tasks, right)
    p = _prefix(left, right)
    a = fragment(left, keys, plan, f"{p}left")
    b = replicate(right, keys, plan, f"{p}right").withColumnsRenamed({k: f"{p}r{i}" for i, k in enumerate(keys)})
    cond = F.col(f"{p}left") == F.col(f"{p}right")
    for i, k in enumerate(keys):
        cond = cond & (F.col(f"`{k}`") == F.col(f"{p}r{i}"))
    joined = a.join(b, cond if extra is None else cond & extra, how)
    return joined.drop(f"{p}left", f"{p}right", *[f"{p}r{i}" for i in range(len(keys))])


def balanced_aggregate(df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, Column]], tasks: int | None = None) -> DataFrame:
    """Per-key aggregates, complete for every key, with large keys spread over tasks.

    aggs: {result: (kind, expression)} with kind count, sum, min or max. Each
    task reduces its shards, and the shard results (at most as many a key as it
    has shards) are merged. Nulls in a key form a key of their own, as in SQL;
    repeated rows count each time; an empty frame gives an empty result.
    """
    merge = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    plan = plan_placement(df, keys, tasks)
    task = unused_name("_task", df)
    parts = fragment(df, keys, plan, task).groupBy(task, *[F.col(f"`{k}`") for k in keys]).agg(*[first[kind](e).alias(name) for name, (kind, e) in aggs.items()])
    return parts.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[merge[kind](F.col(f"`{name}`")).alias(name) for name, (kind, _) in aggs.items()])
