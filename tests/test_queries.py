"""Every registered query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{tiny}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return repr(round(float(x), 9))
    return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQL))
def test_query_equals_sql(name, spark, con, tiny):
    df = QUERIES[name](spark, tiny)
    res = con.sql(SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(res.columns, res.fetchall())


def test_terms_of_every_field(spark, tiny):
    """p1_terms has a row for each non-empty field at least; p1_found those of fields with two or more terms."""
    terms = QUERIES["p1_terms"](spark, tiny).collect()
    some = {tuple(r) for r in QUERIES["p1_found"](spark, tiny).collect()}
    size = {}
    for r in terms:
        size[r.image_id, r.field_name] = max(size.get((r.image_id, r.field_name), 0), r.pos)
    assert len({(r.image_id, r.field_name, r.pos) for r in terms}) == len(terms) == sum(size.values())
    assert some == {tuple(r) for r in terms if size[r.image_id, r.field_name] > 1}


@pytest.mark.parametrize("name", ["freetext", "indexed_terms", "media", "resources"])
def test_flat_tables_have_the_linked_rows(spark, tiny, name):
    links = {(r.line_id, r.item_path): r for r in QUERIES["p5_links"](spark, tiny).where(F.col("table") == name).collect()}
    rows = QUERIES[f"p5_{name}"](spark, tiny).collect()
    assert len(rows) == len(links) > 0
    for r in rows:
        own = links[r.line_id, r.item_path]
        parent = f"{r.line_id}:{own.parent_path}" if own.parent_path else str(r.line_id)
        assert (r.key, r.parent_key, r.ordinal) == (f"{r.line_id}:{r.item_path}", parent, own.ordinal) and r.value


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
