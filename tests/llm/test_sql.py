"""Queries of the corpus operators against their SQL, as the driver holds them; and rules that do reject."""

import duckdb
import pytest

from quire.llm import queries


def both(spark, name, data):
    duck = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = duck.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in want.description]
    found = queries.QUERIES[name](spark, data)
    assert sorted(found.columns) == sorted(columns)
    return sorted(map(tuple, found.select(columns).collect()), key=repr), sorted(want.fetchall(), key=repr), columns


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    got, want, _ = both(spark, name, "/root/testdata/sf0.001")
    assert got == want


def test_quality_rules_where_the_cutoffs_reject(spark):
    """At this scale three strata have labels enough to prove cutoffs."""
    got, want, columns = both(spark, "op3_quality_rules", "/root/testdata/sf0.1")
    assert got == want
    kept, failed = columns.index("kept"), columns.index("base_failed")
    assert sum(not r[failed] and not r[kept] for r in got) > 100
