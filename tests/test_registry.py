"""The registered queries: contract, and a sample against their SQL on DuckDB."""

import glob
import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import canonical

# the slower half is compared by check_oracle.py
SAMPLE = (
    "exact_revenue",
    "ubi_sum_limbs",
    "ubi_sum_grouped",
    "ubi_add_denominators",
    "ubi_sign",
    "asof_keyed_sliced",
    "asof_global_sliced",
    "swap_delta_sliced",
    "percentiles_sliced",
    "series_parts",
    "two_role_join",
    "swap_volume_fused",
    "rated_amounts",
    "pools",
    "land_events",
    "log_profile",
    "published_table",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_contract(spark):
    assert entry(spark).count() == 6
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) > 80


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_parts_follow_the_size_of_the_table(spark, sf_dir, monkeypatch):
    from tidepool.operators import balance
    from tidepool.registry import aggregates

    def most(query):
        plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        return max((int(n) for n in re.findall(r"RepartitionByExpression \[.*\], (\d+)", plan)), default=0)

    assert most(aggregates.many_denominators) == 7
    monkeypatch.setattr(balance, "TASK_BYTES", 2048)
    few = [most(q) for q in (aggregates.many_denominators, aggregates.native_extremes)]
    monkeypatch.setattr(balance, "TASK_BYTES", 1024)
    many = [most(q) for q in (aggregates.many_denominators, aggregates.native_extremes)]
    assert all(a > 7 and 1.8 * a < b for a, b in zip(few, many))
