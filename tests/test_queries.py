"""Every query with SQL gives the rows of its SQL at the smallest scale."""

import glob
import os

import pytest

from captionlake import queries as Q

DATA = "/root/testdata/sf0.001"


def rows(frame, columns):
    whole = lambda v: None if v is None or v != v else int(v) if isinstance(v, float) and v.is_integer() else v
    frame = frame[columns].astype(object)
    return sorted(str([whole(v) for v in t]) for t in frame.where(frame.notna(), None).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    got = Q.QUERIES[name](spark, DATA).toPandas()
    sql = Q.ORACLE_SQL.get(name)
    if sql is None:
        assert len(got)
        return
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = c.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
