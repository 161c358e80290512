"""Every registered query against its DuckDB oracle at sf0.01 (the
correctness gate), and the rows-only ones for non-empty results."""

import pytest

import __spark_entry__ as E
from lookout.plans import catalog
from tests.conftest import SF01
from tools.oracle_check import canon, duck, type_mismatches

catalog.load_all()
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) > 0
        return
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(dcols, cur.fetchall())
    assert sc == dc
    assert type_mismatches(df, con, ORACLE[name]) == {}
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["class_id", "class_name", "n_images"]
