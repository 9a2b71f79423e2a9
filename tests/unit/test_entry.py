"""The registry, and all queries with SQL against DuckDB on the smallest tables."""

import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import __spark_entry__
from quarrystone.plans import registry

DATA = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def _plain(x):
    return 0.0 if isinstance(x, float) and x == 0 else x  # the sign of a zero isn't part of a result


@pytest.fixture(scope="module")
def differences(spark):
    """What is wrong with each query that has SQL: nothing, or the first rows that differ. Queries run five at a time."""
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    queries, sql = registry.queries(), registry.oracle_sql()

    def compare(name):
        try:
            r = con.cursor().sql(sql[name])
            df = queries[name](spark, DATA)
            cols = sorted(df.columns)
            if cols != sorted(r.columns):
                return name, f"columns {cols} and {sorted(r.columns)}"
            want = Counter(repr([_plain(row[r.columns.index(c)]) for c in cols]) for row in r.fetchall())
            got = Counter(repr([_plain(row[c]) for c in cols]) for row in df.collect())
            return name, None if got == want else f"{list((want - got))[:2]} and {list((got - want))[:2]}"
        except Exception as e:  # noqa: BLE001  one query's failure is that query's result
            return name, f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(5) as pool:
        return dict(pool.map(compare, sorted(sql)))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(differences, name):
    assert differences[name] is None
