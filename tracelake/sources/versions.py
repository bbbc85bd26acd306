"""Tables that only grow: each write adds a version of some transactions' or blocks' rows, reading takes the latest, compaction merges.

A table is a folder. ``rows/version=<v>`` has the rows of one write, in files that are sorted by network and block, so their statistics prune
a scan; ``log/version=<v>`` has the keys which that write replaced: (meta_network_name, block_number, transaction_hash, transaction_index), a
null hash for a whole block. A version counts from the moment its log folder is there, which is one rename (atomic where the file system's
rename is; on stores without one, commit through a table format). What a killed write leaves in ``rows`` is never read.

A row is current if no later version has its transaction or its whole block. A write costs what it writes: nothing that is stored is read
or written again, whatever the size of the table. Versions are ordered by the writers' clocks.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.plans import store

BLOCK = ["meta_network_name", "block_number"]
TRANSACTION = [*BLOCK, "transaction_hash"]
LOG = "meta_network_name string, block_number long, transaction_hash string, transaction_index long, n_rows long"
#: Keys with later versions up to which a read sends them to all tasks; beyond it rows and keys are joined by shuffle.
FEW_KEYS = 500_000
#: Different values in a row group that a Bloom filter is made for.
ROW_GROUP_VALUES = 1_000_000
#: Rows that a task of a read by shuffle, or of a compaction, has at most, about.
MOST_ROWS = 1_048_576
#: Marks of a compacted version: it sorts behind the last version that went into it and before every later one.
COMPACTED = "~"


def _new_version() -> str:
    return f"v{time.time_ns() // 1000:020d}-{uuid.uuid4().hex[:8]}"


def committed(spark: SparkSession, path: str) -> list[str]:
    """The table's versions in order; none if there is no table."""
    fs, log = store._path(spark, f"{path.rstrip('/')}/log")
    if not fs.exists(log):
        return []
    return sorted(x.getPath().getName().partition("=")[2] for x in fs.listStatus(log) if x.getPath().getName().startswith("version="))


def _read(spark: SparkSession, path: str, part: str, versions: list[str], first: int | None = None, last: int | None = None) -> DataFrame:
    folder = f"{path.rstrip('/')}/{part}"
    reader = spark.read.option("basePath", folder)
    df = (reader.schema(f"{LOG}, version string") if part == "log" else reader).parquet(*[f"{folder}/version={v}" for v in versions])
    df = df if first is None else df.where(F.col("block_number") >= first)
    return df if last is None else df.where(F.col("block_number") <= last)


def _commit(keys: DataFrame, path: str, version: str, n_rows: int) -> None:
    spark = keys.sparkSession
    aside = f"{path.rstrip('/')}/.log-{version}"
    hash_, index = (F.col(c) if c in keys.columns else F.lit(None) for c in ("transaction_hash", "transaction_index"))
    keys.select(*BLOCK, hash_.cast("string").alias("transaction_hash"), index.cast("long").alias("transaction_index"), F.lit(n_rows).cast("long").alias("n_rows")).sortWithinPartitions(*BLOCK).write.parquet(aside)
    fs, log = store._path(spark, f"{path.rstrip('/')}/log")
    fs.mkdirs(log)
    if not fs.rename(store._path(spark, aside)[1], store._path(spark, f"{path.rstrip('/')}/log/version={version}")[1]):
        raise OSError(f"version {version} of {path} could not be committed")


def _put(rows: DataFrame, folder: str, blooms: list[str]) -> int:
    """Write rows and return how many there were, as the write itself counted them."""
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd")
    for c in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(ROW_GROUP_VALUES))
    writer.parquet(folder)
    return seen.get["n"]


def write(rows: DataFrame, path: str, keys: DataFrame, blooms: list[str] | None = None) -> str:
    """Add ``rows`` as the new rows of ``keys``: transactions (meta_network_name, block_number, transaction_hash and maybe transaction_index) or
    whole blocks (without transaction_hash). Keys without rows are noted, too, and have no rows from now on. ``blooms`` are columns that
    ``lookup`` is to find rows by. Returns the version."""
    version = _new_version()
    ordered = rows.sortWithinPartitions(*[c for c in TRANSACTION if c in rows.columns])
    n = _put(ordered, f"{path.rstrip('/')}/rows/version={version}", blooms or [])
    _commit(keys, path, version, n)
    return version


def written(spark: SparkSession, path: str) -> DataFrame:
    """What each version holds: version, n_keys, and n_rows as the write counted them."""
    return log(spark, path).groupBy("version").agg(F.count("*").alias("n_keys"), F.max("n_rows").alias("n_rows"))


def log(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The keys of all versions, with version; of blocks first to last, if given."""
    versions = committed(spark, path)
    return _read(spark, path, "log", versions, first, last) if versions else spark.createDataFrame([], f"{LOG}, version string")


def _later(keys: DataFrame) -> DataFrame:
    """Keys (block, hash or null) of blocks with several versions, with their last version: what may hide older rows."""
    each = keys.groupBy(*TRANSACTION).agg(F.min("version").alias("first"), F.max("version").alias("last"))
    each = each.withColumn("first", F.min("first").over(Window.partitionBy(*BLOCK)))
    return each.where("last > first").select(*TRANSACTION, F.col("last").alias("later"))


def _tasks(spark: SparkSession, rows: int) -> int | None:
    """How many tasks of ``MOST_ROWS`` rows there are; None where Spark's own number of partitions is enough, which it then fills by bytes. (From
    201 tasks on Spark holds what a task deals out in memory, about 1.5 GB for 128 MB of files, so there are no more of them than needed.)"""
    n = -(-rows // MOST_ROWS)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _current(rows: DataFrame, later: DataFrame, few: bool, blocks: bool, single: bool, newest: str) -> DataFrame:
    """Rows (with version) that no later key hides. Rows without transaction_hash, of tables by block, are hidden by blocks alone. Where rows and
    keys are joined by shuffle, only the kinds of keys that there are (``blocks``, ``single``) are joined, and nothing as new as the ``newest``;
    keys are dealt to as many tasks as the rows need, so that the sorts of a join don't grow with the table. (Spark takes the rows to the same
    tasks; it would move the join in front of an exchange of theirs.)"""
    if not few:
        kept = rows.where(F.col("version") >= newest)
        rows = rows.where(F.col("version") < newest)
        n = _tasks(rows.sparkSession, rows.count())
    side = lambda df, by: F.broadcast(df) if few else df.repartition(n, *by) if n else df
    hidden = lambda a, b, by: [*(a[c] == b[c] for c in by), a["version"] < b["later"]]
    if blocks:
        whole = later.where("transaction_hash is null").select(*BLOCK, "later")
        rows = rows.join(side(whole, BLOCK), hidden(rows, whole, BLOCK), "left_anti")
    if single and "transaction_hash" in rows.columns:
        keys = later.where("transaction_hash is not null")
        rows = rows.join(side(keys, TRANSACTION), hidden(rows, keys, TRANSACTION), "left_anti")
    return rows if few else rows.unionByName(kept)


def _latest(spark: SparkSession, path: str, part: str, versions: list[str], all_versions: list[str], first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of some versions that are current among all. How many keys have later versions is counted in the narrow log first."""
    rows = _read(spark, path, part, versions, first, last)
    later = _later(_read(spark, path, "log", all_versions, first, last))
    n, single, newest = later.agg(F.count("*"), F.count("transaction_hash"), F.max("later")).first()
    return _current(rows, later, n <= FEW_KEYS, single < n, single > 0, newest) if n else rows


def read(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The table as it is now; of blocks first to last, if given: then files of other blocks are read neither of rows nor of the log."""
    versions = committed(spark, path)
    if not versions:
        raise ValueError(f"no table at {path}")
    return _latest(spark, path, "rows", versions, versions, first, last).drop("version")


def keys(spark: SparkSession, path: str) -> DataFrame:
    """The current keys: one row a stored transaction (or block, where whole blocks were written)."""
    versions = committed(spark, path)
    if not versions:
        return spark.createDataFrame([], LOG).drop("n_rows")
    found = _latest(spark, path, "log", versions, versions).drop("n_rows")
    return found.groupBy(*TRANSACTION).agg(F.max_by("transaction_index", "version").alias("transaction_index"))


def compact(spark: SparkSession, path: str, full: bool = False, files: int | None = None, blooms: list[str] | None = None) -> str | None:
    """Merge the versions that were not compacted yet, or all if ``full``, into one, sorted over all its files (by block, or by the columns
    ``blooms``, by which rows are then looked up); what is hidden goes. Writers
    may go on meanwhile. Killed at any moment it leaves the same table: until its commit nothing reads the new version, after it the old ones
    are hidden by it, and they are forgotten before they are deleted. Returns the new version; none if there is nothing to merge."""
    every = committed(spark, path)
    old = [v for v in every if full or not v.endswith(COMPACTED)]
    if len(old) < 2:
        return None
    version = max(old) + COMPACTED
    rows = _latest(spark, path, "rows", old, every).drop("version")
    by = [c for c in (blooms or TRANSACTION) if c in rows.columns]
    files = files or _tasks(spark, _read(spark, path, "rows", old).count())
    dealt = rows.repartitionByRange(*([files] if files else []), *by).sortWithinPartitions(*by)
    folder = f"{path.rstrip('/')}/rows/version={version}"
    store.drop_path(spark, folder)  # of a compaction that was killed
    n = _put(dealt, folder, blooms or [])
    # a key stands for its whole block only as long as it is the block's last; the others are those of its transactions
    kept = _latest(spark, path, "log", old, every).groupBy(*TRANSACTION).agg(F.max_by("transaction_index", "version").alias("transaction_index")).repartitionByRange(*BLOCK)
    store.drop_path(spark, f"{path.rstrip('/')}/.log-{version}")
    _commit(kept, path, version, n)
    for part in ("log", "rows"):
        for v in old:
            store.drop_path(spark, f"{path.rstrip('/')}/{part}/version={v}")
    return version


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> int:
    """Delete what killed writes have left: row folders without a log and log folders that were never renamed, if they are older than a
    running write can be. Returns how many."""
    known, root = set(committed(spark, path)), path.rstrip("/")
    before = time.time() * 1000 - older_than_hours * 3.6e6
    fs, rows = store._path(spark, f"{root}/rows")
    left = []
    if fs.exists(rows):
        left += [x for x in fs.listStatus(rows) if x.getPath().getName().partition("=")[2] not in known]
    if fs.exists(rows.getParent()):
        left += [x for x in fs.listStatus(rows.getParent()) if x.getPath().getName().startswith(".log-")]
    left = [x for x in left if x.getModificationTime() < before]
    for x in left:
        fs.delete(x.getPath(), True)
    return len(left)


def done_transactions(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """Of the given blocks (meta_network_name, block_number): done (distinct stored transactions) and last_index. Only the part of the log
    between the first and the last of the blocks is read."""
    low, high = blocks.agg(F.min("block_number"), F.max("block_number")).first()
    noted = log(spark, path, low, high).where("transaction_hash is not null").join(blocks.select(*BLOCK).distinct(), BLOCK, "left_semi")
    # a bit a transaction: repeated ones set it again, and partial bitmaps merge where they are made; those without an index count by hash
    at = F.col("transaction_index")
    parts = noted.groupBy(*BLOCK, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"), F.max(at).alias("last"), F.countDistinct(F.when(at.isNull(), F.col("transaction_hash"))).alias("others"))
    return parts.groupBy(*BLOCK).agg((F.sum(F.bitmap_count("bits")) + F.sum("others")).alias("done"), F.max("last").alias("last_index"))


def lookup(spark: SparkSession, path: str, column: str, values: list, most: int = 1_000) -> DataFrame:
    """The current rows with one of a few values of a column that the table was written for (``blooms``): the values go to the Parquet reader,
    which skips row groups by their Bloom filters and statistics. More than ``most`` values are an error: join instead."""
    if len(values) > most:
        raise ValueError(f"a lookup has at most {most} values")
    # above this number of values Spark would push their range alone
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(max(most, int(spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")))))
    return read(spark, path).where(F.col(column).isin(list(values)))
