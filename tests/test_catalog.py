"""The query catalogue: every entry documented, every oracle valid DuckDB SQL over the driver views."""

import duckdb

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_every_query_documented_and_mostly_oracle_checked():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    qs, orc = E.catalog.QUERIES, E.catalog.ORACLES
    assert len(qs) >= 41
    assert set(qs) == set(orc)
    for name, fn in qs.items():
        assert (fn.__doc__ or "").strip(), name


def test_oracles_bind_in_duckdb():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        cols = con.sql(f"SELECT * FROM ({sql}) q LIMIT 0").columns
        assert len(cols) == len(set(cols)), name
