"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

ORACLE = E.oracle_sql()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}
# Fits of the learned model: tests/test_ml.py trains small ones; tools/oracle_check.py runs these.
SLOW = {"ml_two_stage", "ml_forecast", "ml_save_load"}
NO_ORACLE = sorted(set(E.queries()) - set(ORACLE))


@pytest.fixture(scope="module")
def con():
    import duckdb
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srec = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [c[0] for c in cur.description]
    drec = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    assert spark_types == duck_types
    assert len(srec) == len(drec)
    assert rows_of(srec, sdf.columns) == rows_of(drec, dcols)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NO_ORACLE)
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["week_no", "store_id", "product_id", "quantity"]
    assert df.count() > 0
