import duckdb
import pytest

import __spark_entry__ as entry_points
import check
import oracles

SF = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()
QUERIES = {name: query for name, query in entry_points.queries().items() if not name.startswith("op") and name != "pipeline"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    relation = con.execute(SQL[name])
    columns = [c[0] for c in relation.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, relation.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["page_id", "sid", "link_ord", "link", "dates", "sentence"]
    assert not entry_points.entry(spark).isEmpty()


@pytest.mark.parametrize("name", ["pair_dates", "clean_text", "links", "sentences", "sections", "date_mentions", "format_pairs"])
def test_row_local_jobs_move_no_text(spark, name):
    """Beyond the joins that make up the sample pages there is no exchange."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    sample = QUERIES["keep_articles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == sample.count("Exchange")
