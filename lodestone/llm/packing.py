"""Filling containers of fixed capacity, mixed to target proportions by deficit round-robin.

Texts are measured in tokens of a public tokenizer. Every source is a queue in a
fixed random order. Prefix sums of tokens along each queue come from two levels
(hash buckets, then places inside a bucket), so no queue is ever in one task.
Divided by the weight of its source, the prefix sum of an item is the virtual
time at which fair queueing serves it, and equal amounts of tokens between
virtual times make the partitions. In a partition a deficit round-robin over the
queues fills windows of several containers to the target proportions: a source
that was served too much or too little has it set off in later rounds and
windows, and what it was served beyond its share before a partition begins is
known from the prefix sums, so deficits are carried across partitions too
without a pass in order. The items of a window are put into containers by best
fit, the largest first, and containers with space left take items of the next
windows.
"""

from __future__ import annotations

import bisect
import math
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.session import parallelism, stage

CAPACITY = 4096
#: Containers filled by one window, and windows of one partition.
WINDOW_CONTAINERS, PARTITION_WINDOWS = 32, 24
#: A container with less free space than this share is closed at the end of a window.
CLOSE_BELOW = 1 / 256
TOKENIZERS = "/opt/tokenizers"


@lru_cache(maxsize=4)
def token_counter(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken"):
    """A function from a list of texts to their numbers of tokens."""
    import base64
    import importlib.util

    import tiktoken

    with open(f"{folder}/{name}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    encoding = tiktoken.Encoding(name, pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(texts: list[str | None]) -> list[int]:
        return [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]

    return count


def count_tokens(df: DataFrame, text: str, result: str = "n_tokens", tokenizers: str = TOKENIZERS) -> DataFrame:
    """df without the column text, with its number of tokens; null and empty texts have 0. The text is read whole."""
    if result.lower() in {c.lower() for c in df.columns if c != text}:
        raise ValueError(f"df already has {result}")
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(tokenizers)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(count(batch.column(text).to_pylist()), pa.int64())], names=[*kept, result])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept]
    return df.mapInArrow(run, ", ".join([*fields, f"`{result}` bigint"]))


class Containers:
    """Best fit into open containers."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.n = capacity, 0
        self.open: list[tuple[int, int]] = []  # (free space, container), sorted

    def put(self, size: int) -> int:
        at = bisect.bisect_left(self.open, (size, -1))
        if at < len(self.open):
            free, container = self.open.pop(at)
        else:
            free, container = self.capacity, self.n
            self.n += 1
        if free > size:
            bisect.insort(self.open, (free - size, container))
        return container

    def close(self, least: int) -> None:
        self.open = self.open[bisect.bisect_left(self.open, (least, -1)) :]


def round_robin(queues: dict[str, list[int]], weights: dict[str, float], carried: dict[str, float], budget: int, quantum: int) -> Iterator[list[tuple[str, int]]]:
    """Windows of (source, place in its queue) of about `budget` tokens each, from queues of sizes.

    In a round each source with items left gets its share of `quantum` tokens,
    which it may spend at once or later. carried: what it has at the beginning
    (negative if it was served too much before).
    """
    left = {s: deque(enumerate(sizes)) for s, sizes in queues.items() if sizes}
    deficit = {s: carried.get(s, 0.0) for s in left}
    window: list[tuple[str, int]] = []
    filled = 0
    while left:
        total = sum(weights[s] for s in left)
        for s in sorted(left):
            queue = left[s]
            deficit[s] += quantum * weights[s] / total
            while queue and queue[0][1] <= deficit[s]:
                place, size = queue.popleft()
                deficit[s] -= size
                filled += size
                window.append((s, place))
            if not queue:
                del left[s]
            if filled >= budget:
                yield window
                window, filled = [], filled - budget
    if window:
        yield window


def fill(group: pd.DataFrame, weights: dict[str, float], begins: float, capacity: int, window_containers: int) -> pd.DataFrame:
    """The container of every row of a partition: columns source, size, before (prefix sum in the queue of the source)."""
    group = group.sort_values(["source", "before", "item", "piece"], kind="stable").reset_index(drop=True)
    places = {s: rows.index.tolist() for s, rows in group.groupby("source", sort=True)}
    sizes, before = group["size"].tolist(), group["before"].tolist()
    carried = {s: min(0.0, weights[s] * begins - before[rows[0]]) for s, rows in places.items()}
    queues = {s: [sizes[r] for r in rows] for s, rows in places.items()}
    containers = Containers(capacity)
    of = [0] * len(group)
    for window in round_robin(queues, weights, carried, capacity * window_containers, capacity):
        rows = sorted((places[s][p] for s, p in window), key=lambda r: (-sizes[r], r))
        for r in rows:
            of[r] = containers.put(sizes[r])
        containers.close(max(1, int(capacity * CLOSE_BELOW)))
    group["container"] = of
    return group


def _virtual_times(totals: dict[str, int], weights: dict[str, float], step: int) -> list[float]:
    """Virtual times at which `step`, 2 * `step`, ... tokens have been served in all, ending with one that nothing reaches."""
    ends = sorted((totals[s] / weights[s], s) for s in totals if totals[s])
    cuts, served, now, rate = [], 0.0, 0.0, sum(weights[s] for _, s in ends)
    goal = float(step)
    for end, s in ends:
        while served + (end - now) * rate > goal:
            now += (goal - served) / rate
            served = goal
            cuts.append(now)
            goal += step
        served += (end - now) * rate
        now = end
        rate -= weights[s]
    return [*cuts, math.inf]


def pack_items(df: DataFrame, item: str, source: str, size: str, capacity: int = CAPACITY, weights: dict[str, float] | None = None, window_containers: int = WINDOW_CONTAINERS, partition_windows: int = PARTITION_WINDOWS) -> DataFrame:
    """(item, piece, first_token, size, source, container): every item in a container, none of which holds more than `capacity`.

    An item is divided only if it exceeds the capacity by itself: into pieces of
    full capacity and a rest, which is packed like an item. weights: the target
    proportions of tokens by source, while a source lasts; by default those of
    the whole input. A source that isn't in weights, or a null source, is a
    source with the least weight given. An item without size (null or 0) is in
    no container: its container is null. Repeated rows are packed each. An empty
    frame gives an empty result. The number of sources must fit in the driver.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = df.sparkSession
    rows = df.select(F.col(f"`{item}`").alias("item"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"), F.greatest(F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0)), F.lit(0)).alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(capacity))).cast("int")
    pieces = rows.select("item", "source", "n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("piece"))
    first = F.col("piece").cast("bigint") * F.lit(capacity)
    order = F.xxhash64("item", "piece", F.lit(8))
    n_buckets = max(64, 4 * parallelism(spark))
    pieces = stage(pieces.select("item", "source", "piece", first.alias("first_token"), F.least(F.lit(capacity), F.col("n") - first).cast("bigint").alias("size"), order.alias("_at"), F.pmod(order, F.lit(n_buckets)).cast("int").alias("_bucket")), "pieces")
    real = pieces.where(F.col("size") > 0)
    per = stage(real.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")), "bucket-sizes")
    totals = {r["source"]: r["n"] for r in per.groupBy("source").agg(F.sum("_sum").alias("n")).collect()}
    least = min(weights.values()) if weights else 1.0
    if least <= 0:
        raise ValueError("weights must be positive")
    share = {s: float((weights or {}).get(s, least) if weights else n) for s, n in totals.items()}
    cuts = _virtual_times(totals, share, capacity * window_containers * partition_windows)
    earlier = per.withColumn("_base", F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).select("source", "_bucket", F.coalesce("_base", F.lit(0)).alias("_base"))
    inside = F.sum("size").over(Window.partitionBy("source", "_bucket").orderBy("_at", "item", "piece").rowsBetween(Window.unboundedPreceding, -1))
    placed = real.withColumn("_in", F.coalesce(inside, F.lit(0))).join(earlier, ["source", "_bucket"]).withColumn("before", F.col("_base") + F.col("_in"))
    schema = f"item {rows.schema['item'].dataType.simpleString()}, piece int, first_token bigint, size bigint, source string, container bigint"

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the partition of every piece: how many cuts its virtual time has passed."""
        for batch in batches:
            v = [bisect.bisect_right(cuts, b / share[s]) for b, s in zip(batch.column("before").to_pylist(), batch.column("source").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(v, pa.int64())], names=[*batch.schema.names, "_part"])

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        p = int(key[0])
        out = fill(group, share, cuts[p - 1] if p else 0.0, capacity, window_containers)
        out["container"] = out["container"] + (p << 24)
        return out[["item", "piece", "first_token", "size", "source", "container"]]

    fields = placed.select("item", "piece", "first_token", "size", "source", "before")
    cut = fields.mapInArrow(partition, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.schema.fields), "_part bigint"]))
    packed = cut.groupBy("_part").applyInPandas(run, schema)
    without = pieces.where(F.col("size") <= 0).select("item", "piece", "first_token", "size", "source", F.lit(None).cast("bigint").alias("container"))
    return packed.unionByName(without).withColumnRenamed("item", item)
