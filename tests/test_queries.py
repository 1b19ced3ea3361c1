"""Every registered engine query against its DuckDB counterpart."""

import math
import os

import duckdb
import pytest

from framequarry.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(names, found):
    order = sorted(names)
    at = [names.index(n) for n in order]
    clean = lambda x: round(x, 9) if isinstance(x, float) and not math.isnan(x) else x
    return order, sorted((tuple(clean(r[k]) for k in at) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry_needs_no_optional_part(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_queries_without_sql():
    """Only the background model, which goes from frame to frame, has no SQL; test_pixels compares it with plain loops."""
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"q23_motion_percent"}
