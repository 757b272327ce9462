import duckdb
import pytest

import __spark_entry__ as entry
from millwright.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", queries.SQL)
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    got = queries.registered()[name](spark, FOLDER).select(*columns).collect()
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, got), key=key) == sorted(cursor.fetchall(), key=key)
