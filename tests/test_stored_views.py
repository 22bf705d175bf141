"""Views that several scans read: one join for all of them, tables cleaned as concurrent jobs."""

from __future__ import annotations

import threading

import pytest

from catalog import queries, views


@pytest.fixture
def tables(spark, tmp_path):
    orders = """VALUES (1L, 10L, timestamp'2001-05-01'), (2L, NULL, timestamp'2002-05-01'), (2L, 11L, NULL), (NULL, 12L, timestamp'2003-05-01'),
        (37L, 13L, timestamp'2003-05-01') AS t(o_orderkey, o_custkey, o_orderdate)"""
    lines = """VALUES (1L, 1, 5D, 10D, 0.5D, 'O', timestamp'2001-06-01'), (1L, 1, 5D, 10D, 0.5D, 'O', timestamp'2001-06-01'), (2L, 1, NULL, 20D, 0D, 'F', NULL),
        (NULL, 1, 7D, 30D, 0D, 'F', NULL), (37L, 2, 8D, 40D, NULL, NULL, timestamp'2001-06-01'), (99L, 1, 9D, 50D, 0D, 'O', NULL)
        AS t(l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_linestatus, l_shipdate)"""
    spark.sql(f"SELECT *, 'unused' AS o_comment FROM {orders}").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"SELECT *, 'A' AS l_returnflag FROM {lines}").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_views_over_one_join_share_it(spark, tables, rows, monkeypatch):
    made, stage = [], views.stage
    monkeypatch.setattr(views, "stage", lambda df, label: made.append(df.columns) or stage(df, label))
    names = ("v_inst", "v_balance", "v_pos")
    stored = views.stored_views(spark, tables, names)
    assert len(made) == 1 and "o_comment" not in made[0] and "l_returnflag" not in made[0]
    for name in names:
        plain = views.view(spark, tables, name)
        assert [(f.name, f.dataType) for f in stored[name].schema] == [(f.name, f.dataType) for f in plain.schema]
        assert rows(stored[name]) == rows(plain)
        plan = stored[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
    assert stored["v_pos"].count() == 5


def test_tables_are_cleaned_at_the_same_time(spark):
    meet = threading.Barrier(len(queries.ROLES), timeout=20)  # breaks if one waits for another

    def step(table):
        meet.wait()
        return spark.range(3).count(), table

    assert queries._each_role(step) == {table: (3, table) for table in queries.ROLES}
