"""Every registered signal query against its SQL in DuckDB."""

import os

import duckdb
import numpy as np
import pytest

from sigloom.plans import catalogue, recordings

QUERIES, ORACLES = catalogue.QUERIES | recordings.QUERIES, catalogue.ORACLES | recordings.ORACLES


def canon(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(canon(x) for x in v)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    return v.item() if isinstance(v, np.generic) else v


@pytest.fixture(scope="module")
def db(small):
    c = duckdb.connect()
    for t in os.listdir(small):
        c.execute(f"create view {t.split('.')[0]} as select * from '{small}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, db, name):
    out = QUERIES[name](spark, small)
    columns = sorted(out.columns)
    got = sorted(repr(tuple(canon(r[c]) for c in columns)) for r in out.collect())
    rel = db.sql(ORACLES[name])
    names = list(rel.columns)
    assert sorted(names) == columns
    want = sorted(repr(tuple(canon(r[names.index(c)]) for c in columns)) for r in rel.fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_run(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_cum_offsets_add_in_the_order_of_rows(spark, tmp_path):
    """Equal customers have equal totals, those of the SQL row by row; by default DuckDB gives the 19th of some as 4287140."""
    prices = [288364.18, 341564.73, 92359.44, 350611.58, 76989.41, 254003.8, 311786.25, 298162.64, 324816.65, 232557.37, 74319.32, 33538.53, 66481.67, 170768.16, 97674.12, 401664.97, 331578.47, 484783.68, 55115.03]
    c = duckdb.connect()
    c.execute("set debug_window_mode='separate'")
    c.execute("create table orders as select i as o_custkey, i * 100 + j as o_orderkey, (?::double[])[j] as o_totalprice from range(60) a(i), range(1, 20) b(j)", [prices])
    c.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    got = {(r["o_custkey"], r["o_orderkey"]): r["offset_end"] for r in QUERIES["cum_offsets"](spark, str(tmp_path)).collect()}
    assert got == {(k, o): end for k, o, end in c.sql(ORACLES["cum_offsets"]).fetchall()}
    assert len(got) == 60 * 19 and {got[k, k * 100 + 19] for k in range(60)} == {4287139}


def test_cum_offsets_equal_the_cumsum_of_numpy(spark, small):
    """The reference's rule for a channel's lengths: cumsum().astype(int)."""
    o = spark.read.parquet(f"{small}/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice").toPandas()
    o = o.sort_values(["o_custkey", "o_orderkey"])
    want = {}
    for k, rows in o.groupby("o_custkey"):
        want |= {(k, i): int(e) for i, e in zip(rows.o_orderkey, rows.o_totalprice.to_numpy().cumsum().astype(int))}
    got = {(r["o_custkey"], r["o_orderkey"]): r["offset_end"] for r in QUERIES["cum_offsets"](spark, small).collect()}
    assert got == want and got


def test_cum_offsets_add_rows_without_a_key_last(spark, tmp_path):
    c = duckdb.connect()
    c.execute("create table orders as select * from (values (1::bigint, null::bigint, 7.5::double), (1, 3, 1.25), (1, 1, 5.5), (2, null, 2.5), (null, 2, 4.0), (null, null, 8.0), (3, 1, null)) t(o_custkey, o_orderkey, o_totalprice)")
    c.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    got = {(r["o_custkey"], r["o_orderkey"], r["offset_end"]) for r in QUERIES["cum_offsets"](spark, str(tmp_path)).collect()}
    assert got == set(c.sql(f"select o_custkey, o_orderkey, offset_end from ({ORACLES['cum_offsets']})").fetchall())
    assert {(1, 3, 6), (1, None, 14), (None, 2, 4), (None, None, 12), (3, 1, None)} <= got


def test_spike_trains_hold_every_spike(spark, small):
    """Each order is a spike of one of five units, none of which is left out."""
    orders = [(r["o_orderkey"], r["o_custkey"]) for r in spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_custkey").collect()]
    got = QUERIES["spike_trains"](spark, small).collect()
    assert sum(r["spikes"] for r in got) == len(orders)
    assert {(r["channel_id"], r["unit"]) for r in got} == {(1 + c % 3, k % 5) for k, c in orders} and {r["unit"] for r in got} == {0, 1, 2, 3, 4}
