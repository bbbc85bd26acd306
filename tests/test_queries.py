"""Every registered query of the library against its DuckDB statement."""

import pytest

from tests.conftest import normal
from tracelake import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_same_as_sql(spark, sf_dir, duck, name):
    got = queries.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    names, rows = duck(SQL[name])
    assert columns == sorted(names)
    order = [names.index(c) for c in columns]
    assert normal(map(tuple, got.select(*columns).collect())) == normal(tuple(r[i] for i in order) for r in rows)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_gaps_all_reaches_every_block(spark):
    """At ten times the tests' size: more gaps than one scan hands out."""
    sf = "/root/testdata/sf0.01"
    short, whole = ({tuple(r) for r in queries.queries()[q](spark, sf).select("processor", "meta_network_name", "block_number", "gap_type").collect()} for q in ("gaps", "gaps_all"))
    assert short < whole and len(whole) > 6 * queries.PAGE
    p = queries._progress(spark, sf)
    scopes = {(r["processor"], r["meta_network_name"]): (r["min_block"], r["max_block"]) for r in queries.pg.stored_range(p).collect()}
    last = {tuple(r)[:3]: r["complete"] for r in queries._latest(spark, sf).select("processor", "meta_network_name", "block_number", "complete").collect()}
    kind = {None: "missing", 0: "incomplete"}
    assert whole == {(*s, b, kind[c]) for s, (lo, hi) in scopes.items() for b in range(lo, hi - 5) if (c := last.get((*s, b))) != 1}


def test_bounds_follow_the_stored_range(spark, tmp_path):
    """Blocks far above those of the tests' size decide the results."""
    import datetime

    at = datetime.datetime(2024, 1, 1)
    # eight events a block from block 1000 on; blocks 1500 and 1900 have no completed row
    rows = [(i, at, (i % 8) % 6, "purchase" if i // 8 not in (500, 900) else "view") for i in range(8_000)]
    rows = [r for r in rows if r[3] == "purchase" or r[0] % 5 >= 3]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    read = lambda name: queries.queries()[name](spark, str(tmp_path)).collect()
    assert all(max(r["block_number"] for r in read(q)) == 1900 for q in ("newest_incomplete", "newest_incomplete_all"))
    assert {r["block_number"] for r in read("incomplete_in_range_all")} == {1500, 1900} == {r["block_number"] for r in read("incomplete_in_range")}
    prefix = read("contiguous_prefix_all")
    assert len(prefix) == 6 * 500 and max(r["block_number"] for r in prefix) == 1499
    assert sorted(r["block_number"] for r in read("contiguous_prefix")) == list(range(1000, 1500))
