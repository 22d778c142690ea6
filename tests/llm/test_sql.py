"""Every query of the subpackage that SQL can express equals its DuckDB form."""

import duckdb
import pytest

from lacuna.llm.queries import QUERIES

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def ordered(rows):
    """Rows (dicts) as sorted tuples of strings, columns by name."""
    return sorted(tuple(str(r[c]) for c in sorted(r)) for r in rows)


def of_spark(df):
    return ordered([r.asDict() for r in df.collect()])


def of_duckdb(con, sql):
    return ordered(con.sql(sql).to_arrow_table().to_pylist())


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_equals_sql(name, spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    fn, sql = QUERIES[name]
    assert of_spark(fn(spark, sf_small)) == of_duckdb(con, sql)


ODD = ["op4_source_mixing", "op5_substring_dedup", "op8_quality_rules"]


@pytest.mark.parametrize("name", ODD)
def test_odd_rows_equal_sql(name, spark, odd_docs, as_table):
    if name.startswith("op8"):  # its SQL form repeats a text for each of its words
        odd_docs = odd_docs.where("text IS NULL OR length(text) < 100000")
    folder = as_table(documents=odd_docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    fn, sql = QUERIES[name]
    assert of_spark(fn(spark, folder)) == of_duckdb(con, sql)


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in
                                  ("op3", "op4", "op5", "op6", "op7", "op8")])
def test_empty_table(name, spark, no_docs, as_table):
    folder = as_table(documents=no_docs)
    assert QUERIES[name][0](spark, folder).count() == 0
