"""Questions about processing progress, over an append-only table of versioned rows
(updated_date_time, block_number, processor, meta_network_name, complete, task_count).

Frames in, frames out; the few scalar decisions (next block, capacity) are expressions over one aggregated row, so they too are plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["processor", "meta_network_name", "block_number"]
SCOPE = KEY[:2]


def latest_version(progress: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """The last row of each block by updated_date_time, then by ``tiebreak``, then a complete one, then the most tasks; a missing ``complete``
    counts as 0."""
    ties = [*(tiebreak or []), *(c for c in ("complete", "task_count") if c in progress.columns)]
    order = [F.col("updated_date_time").desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in ties)]
    df = progress.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).where("n = 1").drop("n")
    return df.withColumn("complete", F.coalesce("complete", F.lit(0)))


def stored_range(progress: DataFrame) -> DataFrame:
    """First and last block of each scope that has rows."""
    return progress.groupBy(*SCOPE).agg(F.min("block_number").alias("min_block"), F.max("block_number").alias("max_block"))


def incomplete(latest: DataFrame) -> DataFrame:
    return latest.where("complete = 0")


def count_incomplete(latest: DataFrame) -> DataFrame:
    return latest.groupBy(*SCOPE).agg(F.sum((F.col("complete") == 0).cast("long")).alias("n_incomplete"))


def oldest_incomplete(latest: DataFrame, at_least: int) -> DataFrame:
    return incomplete(latest).where(F.col("block_number") >= at_least).groupBy(*SCOPE).agg(F.min("block_number").alias("block_number"))


def newest_incomplete(latest: DataFrame, at_most: int | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """The last incomplete block of each scope: up to ``at_most``, or within the scope's range (min_block, max_block)."""
    df = incomplete(latest) if ranges is None else incomplete_within(latest, ranges)
    df = df if at_most is None else df.where(F.col("block_number") <= at_most)
    return df.groupBy(*SCOPE).agg(F.max("block_number").alias("block_number"))


def _first(df: DataFrame, n: int) -> DataFrame:
    """The n smallest blocks of each scope (Spark keeps n a task before it moves rows)."""
    return df.withColumn("k", F.row_number().over(Window.partitionBy(*SCOPE).orderBy("block_number"))).where(F.col("k") <= n).drop("k")


def incomplete_blocks(latest: DataFrame, n: int, low: int | None = None, high: int | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """The n first incomplete blocks of each scope: from ``low`` to ``high``, or within the scope's range (min_block, max_block)."""
    df = incomplete(latest).select(*KEY) if ranges is None else incomplete_within(latest, ranges)
    df = df if low is None else df.where(F.col("block_number") >= low)
    df = df if high is None else df.where(F.col("block_number") <= high)
    return _first(df, n)


def incomplete_within(latest: DataFrame, ranges: DataFrame) -> DataFrame:
    """All incomplete blocks of each scope's range (min_block, max_block)."""
    return incomplete(latest).join(ranges, SCOPE).where("block_number between min_block and max_block").select(*KEY)


def every_block(ranges: DataFrame, slice_of: int = 65_536) -> DataFrame:
    """The blocks of each scope's range (min_block, max_block). A long range is generated in slices, so it spreads over tasks."""
    slices = ranges.where("min_block <= max_block").withColumn("start", F.explode(F.sequence("min_block", "max_block", F.lit(slice_of).cast("long"))))
    return slices.repartition(*SCOPE, "start").withColumn("block_number", F.explode(F.sequence("start", F.least(F.col("start") + slice_of - 1, F.col("max_block"))))).select(*KEY)


def missing_blocks(progress: DataFrame, ranges: DataFrame | None = None, slice_of: int = 65_536) -> DataFrame:
    """Blocks of each scope's range (min_block, max_block; the stored range by default) that have no row."""
    every = every_block(stored_range(progress) if ranges is None else ranges, slice_of)
    return every.join(progress.select(*KEY), KEY, "left_anti")


def missing_ranges(progress: DataFrame, ranges: DataFrame | None = None, bucket: int = 1 << 20) -> DataFrame:
    """The gaps of ``missing_blocks`` as ranges (key, first_block, last_block): a row a gap, however long, and no row a missing block. Blocks are
    looked at in buckets side by side, then the buckets' edges, so no scope has to fit into one task."""
    blocks = progress.select(*KEY)
    if ranges is not None:
        inside = blocks.join(ranges.select(*SCOPE, "min_block", "max_block"), SCOPE).where("block_number between min_block and max_block").select(*KEY)
        fence = F.explode(F.array(F.col("min_block") - 1, F.col("max_block") + 1)).alias("block_number")
        blocks = inside.unionByName(ranges.where("min_block <= max_block").select(*SCOPE, fence))
    blocks = blocks.distinct().withColumn("bucket", F.floor(F.col("block_number") / bucket).cast("long"))
    gap = lambda before, at: [(F.col(before) + 1).alias("first_block"), (F.col(at) - 1).alias("last_block")]
    inner = blocks.withColumn("before", F.lag("block_number").over(Window.partitionBy(*SCOPE, "bucket").orderBy("block_number")))
    edges = blocks.groupBy(*SCOPE, "bucket").agg(F.min("block_number").alias("low"), F.max("block_number").alias("high"))
    edges = edges.withColumn("before", F.lag("high").over(Window.partitionBy(*SCOPE).orderBy("bucket")))  # a row a bucket
    found = inner.where("block_number - before > 1").select(*SCOPE, *gap("before", "block_number"))
    return found.unionByName(edges.where("low - before > 1").select(*SCOPE, *gap("before", "low")))


def first_of(ranges: DataFrame, n: int) -> DataFrame:
    """The first n blocks of each scope in its ranges (first_block, last_block, apart from each other): only these become rows."""
    ordered = Window.partitionBy(*SCOPE).orderBy("first_block")
    few = ranges.withColumn("k", F.row_number().over(ordered)).where(F.col("k") <= n)  # each has a block at least
    before = F.coalesce(F.sum(F.least(F.col("last_block") - F.col("first_block") + 1, F.lit(n))).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    few = few.withColumn("room", F.lit(n) - before).where("room > 0")
    last = F.least(F.col("last_block"), F.col("first_block") + F.col("room") - 1)
    return few.select(*SCOPE, F.explode(F.sequence("first_block", last)).alias("block_number"))


def is_complete(latest: DataFrame, blocks: DataFrame) -> DataFrame:
    """The asked blocks (processor, network, block) with complete; blocks without a row aren't."""
    return blocks.join(latest.select(*KEY, (F.col("complete") == 1).alias("is_complete")), KEY, "left").withColumn("is_complete", F.coalesce("is_complete", F.lit(False)))


def recently_processed(progress: DataFrame, as_of, seconds: int) -> DataFrame:
    """Blocks with a row of the last ``seconds`` before ``as_of``."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds))
    return progress.where(F.col("updated_date_time") >= since).select(*KEY).distinct()


def stale_blocks(latest: DataFrame, as_of, seconds: int = 300) -> DataFrame:
    """Incomplete blocks whose last row is at least ``seconds`` old."""
    until = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds))
    return incomplete(latest).where(F.col("updated_date_time") <= until).select(*KEY, "updated_date_time")


def limiter_max(beacon: DataFrame) -> DataFrame:
    """Per network the payload block of the latest slot that has one."""
    return beacon.where("execution_payload_block_number is not null").groupBy("meta_network_name").agg(F.max_by("execution_payload_block_number", "slot_start_date_time").alias("limiter_max"))


def next_block(scopes: DataFrame, progress: DataFrame, mode: str = "forwards", chain_head: int | None = None, limits: DataFrame | None = None) -> DataFrame:
    """For each scope (processor, network): next_block, or null if there is none to process.

    Forwards: one past the last stored block, or the chain head of an empty store (0 if unknown). Backwards: one before the first, none
    below 0. ``limits`` (network, limiter_max) bounds forwards work: an empty store begins one before the limit, a block just past the limit
    waits, one further past goes on; networks without a limit count as 0.
    """
    head = F.lit(chain_head).cast("long")
    df = scopes.join(stored_range(progress), SCOPE, "left")
    if mode == "backwards":
        following = F.when(F.col("min_block").isNull(), head).when(F.col("min_block") > 0, F.col("min_block") - 1)
        return df.select(*SCOPE, following.cast("long").alias("next_block"))
    following = F.coalesce(F.col("max_block") + 1, F.greatest(head, F.lit(0).cast("long")), F.lit(0).cast("long"))
    if limits is None:
        return df.select(*SCOPE, following.alias("next_block"))
    df = df.join(limits, "meta_network_name", "left").withColumn("limiter_max", F.coalesce("limiter_max", F.lit(0).cast("long")))
    limit = F.col("limiter_max")
    bounded = F.when(F.col("max_block").isNull() & (limit > 0), limit - 1).when(following != limit + 1, following)
    return df.select(*SCOPE, bounded.cast("long").alias("next_block"))


def next_blocks(scopes: DataFrame, progress: DataFrame, count: int, mode: str = "forwards", chain_head: int | None = None, limits: DataFrame | None = None) -> DataFrame:
    """Up to ``count`` consecutive blocks from the next one on; forwards not past the chain head or the limit, backwards not below 0."""
    first = next_block(scopes, progress, mode, chain_head, limits).where("next_block is not null")
    df = first.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))) if count > 0 else first.withColumn("i", F.lit(0)).where("false")
    df = df.withColumn("block_number", F.col("next_block") + (F.col("i") if mode != "backwards" else -F.col("i")))
    fits = F.col("block_number") >= 0
    if mode != "backwards":
        if chain_head is not None:
            fits &= F.col("block_number") <= chain_head
        if limits is not None:
            df = df.join(limits, "meta_network_name", "left")
            fits &= F.col("block_number") <= F.coalesce("limiter_max", F.lit(0))
    return df.where((F.col("i") == 0) | fits).select(*KEY)


def head_distance(scopes: DataFrame, progress: DataFrame, mode: str = "forwards", chain_head: int | None = None, limits: DataFrame | None = None, limited: bool = False) -> DataFrame:
    """Distance from the next block to the head and which head that is; 0 and '' if there is no next block.

    Forwards with ``limits`` the head is the limit ('beacon_chain_head'). ``limited`` without ``limits`` says that they couldn't be had: the
    execution head stands in ('execution_head_fallback'). A scope that has a next block but no known head fails the query."""
    df = next_block(scopes, progress, mode, chain_head, limits)
    if limits is None or mode == "backwards":
        kind = "execution_head_fallback" if limited and limits is None and mode != "backwards" else "execution_head"
        missing = "both heads unavailable" if kind == "execution_head_fallback" else "execution head not available"
        head = F.raise_error(F.lit(missing)).cast("long") if chain_head is None else F.lit(chain_head).cast("long")
    else:
        df = df.join(limits, "meta_network_name", "left")
        head, kind = F.coalesce("limiter_max", F.lit(0).cast("long")), "beacon_chain_head"
    there = F.col("next_block").isNotNull()
    return df.select(*SCOPE, F.when(there, head - F.col("next_block")).otherwise(0).cast("long").alias("distance"), F.when(there, kind).otherwise("").alias("head_type"))


def gap_window(progress: DataFrame, lookback: int = 0, pending: int = 0) -> DataFrame:
    """The range that a gap scan covers: behind the last stored block by ``lookback`` (0: all), without the last ``pending`` blocks."""
    df = stored_range(progress)
    low = F.col("min_block") if lookback == 0 else F.greatest(F.col("max_block") - lookback, F.col("min_block"))
    high = F.col("max_block") - pending - 1 if pending > 0 else F.col("max_block")
    df = df.where(F.col("max_block") > pending) if pending > 0 else df
    return df.select(*SCOPE, low.alias("min_block"), high.alias("max_block")).where("min_block <= max_block")


def gaps(latest: DataFrame, limit: int | None = None, lookback: int = 0, pending: int = 0) -> DataFrame:
    """Blocks of each scope to process again, with gap_type; with a ``limit`` so many at most: incomplete ones first, then missing ones,
    each in order."""
    window = gap_window(latest, lookback, pending)
    begun = incomplete_within(latest, window).withColumn("gap_type", F.lit("incomplete"))
    if limit is None:
        return begun.unionByName(missing_blocks(latest, window).withColumn("gap_type", F.lit("missing")))
    never = first_of(missing_ranges(latest, window), limit).withColumn("gap_type", F.lit("missing"))
    order = Window.partitionBy(*SCOPE).orderBy("gap_type", "block_number")
    return begun.unionByName(never).withColumn("k", F.row_number().over(order)).where(F.col("k") <= limit).drop("k")


def capacity(scopes: DataFrame, latest: DataFrame, pending: int, mode: str = "forwards") -> DataFrame:
    """With next_block in ``scopes``: the incomplete block that counts, capacity (blocks that may still be begun) and blocked. An
    incomplete block on the wrong side of the next one blocks. Without a range (``pending`` of 0 or less) there is no limit: capacity is null
    and nothing blocks."""
    if pending <= 0:
        none = F.lit(None)
        return scopes.select(*SCOPE, "next_block", none.cast("long").alias("nearest"), none.cast("int").alias("capacity"), F.lit(False).alias("blocked"))
    open_ones = incomplete(latest).select(*KEY)
    df = scopes.join(open_ones, SCOPE, "left")
    ahead = mode == "backwards"
    near = F.col("block_number") <= F.col("next_block") + pending if ahead else F.col("block_number") >= F.greatest(F.col("next_block") - pending, F.lit(0).cast("long"))
    pick = F.max if ahead else F.min
    df = df.groupBy(*SCOPE, "next_block").agg(pick(F.when(near, F.col("block_number"))).alias("nearest"))
    distance = F.col("nearest") - F.col("next_block") if ahead else F.col("next_block") - F.col("nearest")
    room = F.when(F.col("nearest").isNull(), pending).when(distance < 0, 0).otherwise(F.greatest(F.lit(pending) - distance, F.lit(0)))
    return df.select(*SCOPE, "next_block", "nearest", room.cast("int").alias("capacity"), (room <= 0).alias("blocked"))


def within_leash(scopes: DataFrame, latest: DataFrame, count: int, pending: int, mode: str = "forwards") -> DataFrame:
    """Whether a batch of ``count`` blocks fits."""
    if pending <= 0 or count <= 0:
        return scopes.withColumn("fits", F.lit(True))
    return capacity(scopes, latest, pending, mode).select(*SCOPE, "next_block", ((F.lit(count) <= pending) & (F.lit(count) <= F.col("capacity"))).alias("fits"))


def block_completion(tasks: DataFrame, expected: DataFrame) -> DataFrame:
    """Blocks with completed (distinct finished task ids), task_count and whether the block is complete, and enqueued_at if ``expected`` has
    it; tasks of unregistered blocks complete nothing."""
    done = tasks.select(*KEY, "task_id").distinct().groupBy(*KEY).agg(F.count("*").alias("completed"))
    since = ["enqueued_at"] if "enqueued_at" in expected.columns else []
    df = done.join(expected.select(*KEY, "task_count", *since), KEY, "full")
    return df.select(*KEY, F.coalesce("completed", F.lit(0)).alias("completed"), "task_count", *since, F.coalesce(F.coalesce("completed", F.lit(0)) >= F.col("task_count"), F.lit(False)).alias("is_complete"))


def task_bitmaps(tasks: DataFrame) -> DataFrame:
    """Finished tasks (key, task_index) as bitmaps: (key, bucket, bitmap), a row a block and 32,768 indexes. Repeated tasks set one bit."""
    at = F.col("task_index").cast("long")
    return tasks.where("task_index is not null").groupBy(*KEY, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))


def merge_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of several batches, merged: a task that stands in more than one of them counts once."""
    every = bitmaps[0]
    for more in bitmaps[1:]:
        every = every.unionByName(more)
    return every.groupBy(*KEY, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_completion(bitmaps: DataFrame, expected: DataFrame) -> DataFrame:
    """``block_completion`` from bitmaps: what is stored of a block is of fixed size, and batches merge without their tasks' names."""
    done = bitmaps.groupBy(*KEY).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    df = done.join(expected.select(*KEY, "task_count"), KEY, "full").withColumn("completed", F.coalesce("n", F.lit(0)))
    return df.select(*KEY, "completed", "task_count", F.coalesce(F.col("completed") >= F.col("task_count"), F.lit(False)).alias("is_complete"))


def reprocess_candidates(incomplete_rows: DataFrame, tracked: DataFrame, fresh: DataFrame) -> DataFrame:
    """Incomplete blocks that nothing tracks and that a fresh snapshot still has as incomplete."""
    return incomplete_rows.select(*KEY).join(tracked.select(*KEY), KEY, "left_anti").join(incomplete(fresh).select(*KEY), KEY, "left_semi")


def pipeline_health(latest: DataFrame, chain_head: int) -> DataFrame:
    """Per scope: stored range, rows, complete and incomplete blocks, missing blocks in the range, distance to the head."""
    df = latest.groupBy(*SCOPE).agg(
        F.min("block_number").alias("min_block"), F.max("block_number").alias("max_block"), F.count("*").alias("n_blocks"), F.sum((F.col("complete") == 1).cast("long")).alias("n_complete"), F.sum((F.col("complete") == 0).cast("long")).alias("n_incomplete")
    )
    return df.withColumns({"n_missing": F.col("max_block") - F.col("min_block") + 1 - F.col("n_blocks"), "head_distance": F.lit(chain_head).cast("long") - F.col("max_block") - 1})


def task_id(processor, network, block, tx_hash=None):
    """Name of a unit of work, the same at each try."""
    return F.concat_ws(":", processor, network, block.cast("string"), F.lit("block") if tx_hash is None else tx_hash)


def contiguous_prefix(requested: DataFrame, found: DataFrame, by_scope: bool = False) -> DataFrame:
    """Of requested blocks those before the first that wasn't found; ``by_scope`` each scope has its own."""
    if by_scope:
        first = requested.join(found.select(*KEY), KEY, "left_anti").groupBy(*SCOPE).agg(F.min("block_number").alias("gap"))
        return requested.join(first, SCOPE, "left").where("gap is null or block_number < gap").select(*KEY)
    first = requested.join(found.select("block_number"), "block_number", "left_anti").agg(F.min("block_number").alias("gap"))
    return requested.join(F.broadcast(first)).where("gap is null or block_number < gap").drop("gap")  # one row


def is_empty(df: DataFrame, **equal) -> bool:
    """Whether no row has these values."""
    for c, v in equal.items():
        df = df.where(F.col(c) == v)
    return df.isEmpty()
