"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from foldmark.queries import all_oracles, all_queries
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["s12_scan_result_table", "k09_bundle_round_trip", "p06_analyse_totals_only"])
def test_keys_may_be_large(spark, tmp_path, name):
    """Keys beyond 10^12, as shifted copies of the tables have them."""
    import duckdb

    con = duckdb.connect()
    for table, keys in (("part", ["p_partkey"]), ("lineitem", ["l_partkey", "l_orderkey"])):
        far = ", ".join(f"{k} + {2 * 10**12} AS {k}" for k in keys)
        source, path = f"read_parquet('{SF}/{table}.parquet')", f"{tmp_path}/{table}.parquet"
        con.execute(f"COPY (SELECT * FROM {source} UNION ALL BY NAME SELECT * REPLACE ({far}) FROM {source}) TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], str(tmp_path)) is None
