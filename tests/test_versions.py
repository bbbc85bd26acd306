"""Versioned tables: latest rows, cost of a write, compaction, and writes that are killed between any two steps."""

import os

import pytest
from pyspark.sql import functions as F

from tracelake.plans import store
from tracelake.sources import sinks, versions

ROW = "meta_network_name string, block_number long, transaction_hash string, index long, v long"


def rows(spark, *items):
    """Two rows of value v for each (block, hash, v)."""
    return spark.createDataFrame([("n", b, h, i, v) for b, h, v in items for i in (0, 1)], ROW)


def keys(spark, *items):
    return spark.createDataFrame([("n", b, h, int(h)) for b, h in items], "meta_network_name string, block_number long, transaction_hash string, transaction_index long")


def put(spark, path, *items):
    versions.write(rows(spark, *items), path, keys(spark, *{(b, h) for b, h, _ in items}))


def now(spark, path, **kw):
    return sorted((r["block_number"], r["transaction_hash"], r["v"]) for r in versions.read(spark, path, **kw).collect() if r["index"] == 0)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_latest_version_of_transactions_and_blocks(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (1, "1", 1), (2, "0", 1))
    put(spark, path, (1, "1", 2), (3, "0", 2))
    assert now(spark, path) == [(1, "0", 1), (1, "1", 2), (2, "0", 1), (3, "0", 2)]
    assert versions.read(spark, path).count() == 8
    # a transaction that has no rows any more, and a whole block with other transactions
    versions.write(rows(spark).where("false"), path, keys(spark, (2, "0")))
    versions.write(rows(spark, (1, "5", 4)), path, spark.createDataFrame([("n", 1)], "meta_network_name string, block_number long"))
    assert now(spark, path) == [(1, "5", 4), (3, "0", 2)]
    put(spark, path, (1, "0", 5))
    assert now(spark, path) == [(1, "0", 5), (1, "5", 4), (3, "0", 2)]
    assert now(spark, path, first=2) == [(3, "0", 2)] and now(spark, path, first=1, last=2) == [(1, "0", 5), (1, "5", 4)]
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path / "none"))
    assert versions.log(spark, str(tmp_path / "none")).isEmpty() and versions.keys(spark, str(tmp_path / "none")).isEmpty()


def test_networks_are_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1))
    versions.write(rows(spark, (1, "0", 2)).withColumn("meta_network_name", F.lit("m")), path, keys(spark, (1, "0")).withColumn("meta_network_name", F.lit("m")))
    assert sorted(r["v"] for r in versions.read(spark, path).collect()) == [1, 1, 2, 2]


def test_a_write_costs_what_it_writes(spark, tmp_path):
    """A batch of ten rows is as small beside 40,000 stored rows of the same block range as it is alone."""
    path, alone = str(tmp_path / "t"), str(tmp_path / "a")
    many = spark.range(40_000).select(F.lit("n").alias("meta_network_name"), (F.col("id") % 50).alias("block_number"), F.sha1(F.col("id").cast("string")).alias("transaction_hash"), F.lit(0).cast("long").alias("index"), F.col("id").alias("v"))
    versions.write(many, path, many.select(*versions.TRANSACTION))
    before = size(path)
    few = [(b, str(b), 7) for b in range(5)]
    put(spark, path, *few)
    put(spark, alone, *few)
    assert size(path) - before == pytest.approx(size(alone), rel=0.2) and size(alone) < before / 20
    assert versions.read(spark, path).count() == 40_010


@pytest.mark.parametrize("full", [False, True])
def test_compaction_changes_nothing_but_the_files(spark, tmp_path, full):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (1, "1", 1), (2, "0", 1))
    put(spark, path, (1, "1", 2), (3, "0", 2))
    first = versions.compact(spark, path)
    versions.write(rows(spark, (1, "5", 3)), path, spark.createDataFrame([("n", 1)], "meta_network_name string, block_number long"))
    put(spark, path, (3, "0", 4), (9, "0", 4))
    want, noted = now(spark, path), sorted(map(tuple, versions.keys(spark, path).where("transaction_hash is not null").collect()))
    second = versions.compact(spark, path, full)
    assert now(spark, path) == want == [(1, "5", 3), (2, "0", 1), (3, "0", 4), (9, "0", 4)]
    assert versions.committed(spark, path) == ([second] if full else [first, second])
    assert sorted(map(tuple, versions.keys(spark, path).where("transaction_hash is not null").collect())) == noted
    put(spark, path, (2, "0", 6))
    assert (2, "0", 6) in now(spark, path) and (2, "0", 1) not in now(spark, path)
    assert sorted(os.listdir(f"{path}/rows")) == sorted(f"version={v}" for v in versions.committed(spark, path))


def test_compaction_beside_a_writer(spark, tmp_path, monkeypatch):
    """What is committed while a compaction runs stays the latest."""
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (2, "0", 1))
    put(spark, path, (1, "0", 2))
    real, once = versions._commit, []

    def commit(k, p, version, n):
        if version.endswith(versions.COMPACTED) and not once:
            once.append(1)
            put(spark, path, (2, "0", 3))
        real(k, p, version, n)

    monkeypatch.setattr(versions, "_commit", commit)
    versions.compact(spark, path)
    assert now(spark, path) == [(1, "0", 2), (2, "0", 3)]


class Killed(Exception):
    pass


def killed_at(monkeypatch, module, name, call):
    """Raises at the n-th call of a function (before it runs)."""
    real, n = getattr(module, name), [0]

    def f(*a, **k):
        n[0] += 1
        if n[0] == call:
            raise Killed
        return real(*a, **k)

    monkeypatch.setattr(module, name, f)


def test_a_killed_write_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1))
    with monkeypatch.context() as m:
        killed_at(m, versions, "_commit", 1)
        with pytest.raises(Killed):
            put(spark, path, (1, "0", 2), (2, "0", 2))
    assert now(spark, path) == [(1, "0", 1)] and len(os.listdir(f"{path}/rows")) == 2
    put(spark, path, (1, "0", 3))
    assert now(spark, path) == [(1, "0", 3)]
    assert versions.vacuum(spark, path) == 0 and versions.vacuum(spark, path, older_than_hours=-1) == 1
    assert now(spark, path) == [(1, "0", 3)] and len(os.listdir(f"{path}/rows")) == 2


@pytest.mark.parametrize("step", ["_commit 1", "drop_path 3", "drop_path 4", "drop_path 5", "drop_path 6"])
def test_a_killed_compaction_leaves_the_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (2, "0", 1))
    put(spark, path, (1, "0", 2))
    name, call = step.split()
    with monkeypatch.context() as m:
        killed_at(m, versions if name == "_commit" else store, name, int(call))
        with pytest.raises(Killed):
            versions.compact(spark, path)
    assert now(spark, path) == [(1, "0", 2), (2, "0", 1)]
    put(spark, path, (2, "0", 3))
    versions.compact(spark, path, full=True)
    versions.vacuum(spark, path, older_than_hours=-1)
    assert now(spark, path) == [(1, "0", 2), (2, "0", 3)]
    assert sorted(os.listdir(f"{path}/rows")) == sorted(f"version={v}" for v in versions.committed(spark, path))


def test_requeue_of_a_versioned_table(spark, tmp_path):
    path, progress = str(tmp_path / "t"), str(tmp_path / "p")
    put(spark, path, (1, "0", 1), (2, "0", 1), (2, "1", 1))
    known = spark.createDataFrame([("n", 2, 2)], "meta_network_name string, block_number long, task_count long")
    out = sinks.requeue_blocks(known, known, lambda b: rows(spark, (2, "0", 8)), "structlog", path, progress, versions.write)
    assert [r["status"] for r in out.collect()] == ["queued"]
    assert now(spark, path) == [(1, "0", 1), (2, "0", 8)]


def test_written_rows_are_counted_by_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (2, "0", 1))
    put(spark, path, (1, "0", 2))
    assert sorted((r["n_keys"], r["n_rows"]) for r in versions.written(spark, path).collect()) == [(1, 2), (2, 4)]
    versions.compact(spark, path)
    assert [(r["n_keys"], r["n_rows"]) for r in versions.written(spark, path).collect()] == [(2, 4)] and versions.read(spark, path).count() == 4


def test_stored_transactions_as_bits(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, (1, "0", 1), (1, "40000", 1), (2, "0", 1))
    put(spark, path, (1, "0", 2), (1, "7", 2))
    versions.write(rows(spark, (2, "9", 1)), path, keys(spark, (2, "9")).drop("transaction_index"))
    asked = spark.createDataFrame([("n", 1), ("n", 2), ("n", 3), ("m", 1)], "meta_network_name string, block_number long")
    assert sorted((r["block_number"], r["done"], r["last_index"]) for r in versions.done_transactions(spark, path, asked).collect()) == [(1, 3, 40000), (2, 2, 0)]


def scanned(df):
    """Rows that the scans of a plan gave."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "FileSourceScanExec" in node.getClass().getSimpleName():
            out.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(out)


def test_lookups_skip_row_groups(spark, tmp_path):
    """100 hashes of 200,000 transactions in 40 files: few files have one, and those rows are found."""
    path = str(tmp_path / "t")
    df = spark.range(200_000).select(F.lit("n").alias("meta_network_name"), F.floor(F.col("id") / 100).alias("block_number"), F.sha1(F.col("id").cast("string")).alias("transaction_hash"), F.col("id").alias("v"))
    versions.write(df, path, df.select(*versions.TRANSACTION), blooms=["transaction_hash"])
    asked = [r["h"] for r in spark.range(100).select(F.sha1((F.col("id") * 7).cast("string")).alias("h")).collect()]
    found = versions.lookup(spark, path, "transaction_hash", [*asked[:5], "none"])
    assert sorted(r["v"] for r in found.collect()) == [0, 7, 14, 21, 28]
    assert versions.lookup(spark, path, "transaction_hash", ["none", "nowhere"]).isEmpty() and scanned(versions.lookup(spark, path, "transaction_hash", ["none", "nowhere"])) == 0
    versions.write(df.where("v < 10"), path, df.where("v < 10").select(*versions.TRANSACTION))
    versions.compact(spark, path, full=True, files=40, blooms=["transaction_hash"])
    many = versions.lookup(spark, path, "transaction_hash", asked)
    assert sorted(r["v"] for r in many.collect()) == [7 * i for i in range(100)]
    few = versions.lookup(spark, path, "transaction_hash", asked[:3])
    assert few.count() == 3 and scanned(few) <= 4 * 200_000 / 40
    with pytest.raises(ValueError):
        versions.lookup(spark, path, "transaction_hash", asked, most=99)
