"""Queries of recordings on orders at the edges of what formats hold."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from sigloom.plans import recordings
from sigloom.sources import mef


def same_as_sql(spark, folder, name, keys, customers):
    pd.DataFrame({"o_orderkey": np.asarray(keys, "int64"), "o_custkey": np.asarray(customers, "int64"), "o_totalprice": np.arange(len(keys)) + 0.25}).to_parquet(folder / "orders.parquet")
    got = recordings.QUERIES[name](spark, str(folder))
    c = duckdb.connect()
    c.execute(f"create view orders as select * from '{folder}/orders.parquet'")
    want = c.execute(f"select {', '.join(got.columns)} from ({recordings.ORACLES[name]})").fetchall()
    assert want and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_moberg_values_beyond_24_bits(spark, tmp_path):
    """The greatest and least of 24 bits, and beyond them; each in a file of its own."""
    edge = 1 << 23
    same_as_sql(spark, tmp_path, "moberg_samples", [5, edge, edge + 1000, edge + 1700, edge + 1701, 40_000_000], [edge + 4, 0, 999, 0, 3, 7])


def test_records_before_1970(spark, tmp_path):
    same_as_sql(spark, tmp_path, "mef3_records", [0, 1, 2, 3, 7, 11, 40, 43, 2003], [1, 5000, 77, 9128, 7109, 3, 40, 43_001, 9])


def test_stored_times_come_back():
    for t, offset in ((0, mef.NO_OFFSET), (5, mef.NO_OFFSET), (-7, -8), (0, -8), (12, -8), (12, 4)):
        assert mef.absolute_time(mef.stored_time(t, offset), offset) == t
    for t, offset in ((-1, mef.NO_OFFSET), (4, 4)):
        with pytest.raises(ValueError, match="needs a recording offset"):
            mef.stored_time(t, offset)
