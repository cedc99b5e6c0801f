"""Every registered market-data query against its SQL, on the smallest tables."""

import pytest
from oracle import connect, same

from marketlake.queries import control, ingest, merges, relational, reports
from marketlake.queries.registry import Tables

GROUPS = {m.__name__.rpartition(".")[2]: m.G for m in (ingest, merges, control, reports, relational)}
NAMES = [(g, n) for g, group in GROUPS.items() for n in group.queries]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize(("group", "name"), NAMES, ids=[n for _, n in NAMES])
def test_query(spark, sf_dir, con, group, name):
    same(GROUPS[group].queries[name](spark, sf_dir), con, GROUPS[group].sql[name])


def test_every_query_has_sql():
    assert all(set(g.queries) == set(g.sql) for g in GROUPS.values())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["marketlake.llm.queries", "corpus_pipeline"])
def test_entry_without_optional_parts(monkeypatch, name):
    """A part that can't be imported, because it or something it needs is missing, leaves the others in place."""
    import importlib
    import sys

    import __spark_entry__

    every = set(__spark_entry__.queries())
    monkeypatch.setitem(sys.modules, name, None)
    alone = importlib.reload(__spark_entry__)
    market = {n for _, n in NAMES}
    assert market <= set(alone.queries()) and "pipeline" not in alone.queries() and set(alone.oracle_sql()) <= set(alone.queries())
    if name != "corpus_pipeline":
        assert set(alone.queries()) == market
    monkeypatch.undo()
    assert set(importlib.reload(__spark_entry__).queries()) == every


def test_upsert_reads_few_columns_and_no_python(spark, sf_dir):
    plan = GROUPS["reports"].queries["coverage_dashboard"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "o_orderpriority" not in plan and "c_mktsegment" in plan


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("name", "parser", "shuffle"), [("load_overview", "overview_rows", "RepartitionByExpression"), ("load_balance_sheet", "reports", "Aggregate"), ("load_cash_flow", "reports", "Aggregate")])
def test_documents_are_parsed_once_by_many_tasks(spark, sf_dir, monkeypatch, name, parser, shuffle):
    """The rows of documents are stored before the merge, which reads keys and rows apart; documents are made after a shuffle, not by the few tasks that read the short rows."""
    seen, real = [], getattr(ingest.payloads, parser)
    monkeypatch.setattr(ingest.payloads, parser, lambda df, *a, **b: seen.append(optimized(df)) or real(df, *a, **b))
    merged = optimized(ingest.G.queries[name](spark, sf_dir))
    assert "StructsToJson" not in merged and "_name#" not in merged
    below = [x for plan in seen for x in plan.split("StructsToJson")[1:]]
    assert below and all(shuffle in x.partition("Relation [")[0] for x in below)


def test_report_lines_are_the_statements_and_read_lines_once(spark, tmp_path):
    """Lines are counted before the join, in one pass for both periods; suppliers of one name add up, lines without a supplier don't count."""
    lines = [(1, "1995-01-31 00:00:00"), (1, "1995-02-01 00:00:00"), (1, "1995-12-31 23:59:59"), (2, "1995-03-31 12:00:00"), (3, "1995-01-01 00:00:00"), (3, None), (None, "1995-01-01 00:00:00"), (9, "1995-01-01 00:00:00")]
    spark.createDataFrame(lines, "l_suppkey long, d string").selectExpr("l_suppkey", "CAST(d AS TIMESTAMP) AS l_shipdate", "1.5D AS l_extendedprice", "2.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "Supplier#000000001"), (2, "Supplier#000000001"), (3, None), (4, "Supplier#000000004")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    t = Tables(spark, str(tmp_path))
    columns = ["symbol", "fiscal_date_ending", "period_type", "n_lines"]
    found, wanted = ingest.report_lines(t).select(columns), t.statements.select(columns)
    assert found.dtypes == wanted.dtypes
    rows = sorted(map(str, found.collect()))
    assert rows == sorted(map(str, wanted.collect())) and len(rows) == 7
    plan = optimized(found)
    assert plan.count("Relation [l_suppkey") == 1 and "Aggregate" in plan.partition("Join")[2]


@pytest.mark.parametrize("name", ["load_cash_flow", "load_balance_sheet", "load_income_statement"])
def test_statements_meet_the_table_by_shuffle(spark, sf_dir, name):
    """Sizes that are guessed from small files must not send the batch's keys through the driver."""
    df = ingest.G.queries[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
