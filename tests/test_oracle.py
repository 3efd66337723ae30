"""Every queries() key against its oracle_sql() through DuckDB on the sf0.001 tables
(rows, column names, column types, order-insensitive value hash)."""
import os

import pytest

SF = "/root/testdata/sf0.001"


def _keys():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


KEYS = _keys()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    from __spark_entry__ import oracle_sql, queries
    from tools.check_oracle import digest
    df = queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
    from tools.check_oracle import SPARK_TO_DUCK
    rel = duck.sql(oracle_sql()[key])
    dtypes = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t.upper()) == dtypes[f.name], (f.name, t, dtypes[f.name])


@pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="test tables not present")
def test_entry_and_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
