import duckdb
import pytest

from alloyframe.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    got = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    assert sorted(map(key, (tuple(r) for r in df.select(names).collect()))) == sorted(map(key, got.fetchall()))


def test_all_are_there():
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
