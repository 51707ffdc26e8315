"""Every registered query of the library against its SQL, on the smallest tables; and plan assertions."""

import glob
import os

import duckdb
import pytest

from quire.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.ORACLE_SQL])
def test_query_equals_its_sql(spark, duck, name):
    found = registry.QUERIES[name](spark, DATA)
    want = duck.execute(registry.ORACLE_SQL[name])
    columns = [x[0] for x in want.description]
    assert sorted(columns) == sorted(found.columns)
    rows = found.select(*(f"`{c}`" for c in columns)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE_SQL])
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


@pytest.mark.parametrize("name", ["region_overlap_anti", "char_cover_mask", "watermark_images", "flagship_kind_counts", "chunk_kinds_base", "meta_acts", "doc_html_judgment"])
def test_plan_has_no_product_and_no_python(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "MapInPandas"):
        assert node not in plan


def test_scan_reads_only_what_it_needs(spark):
    plan = registry.QUERIES["layout_lines"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "n_chars" not in plan and "lang" not in plan.partition("ReadSchema")[2][:80]
