"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest

from attesta.plans import oracle_sql, queries
from oracle import DATA


def explain(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_names_line_up():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 190


@pytest.mark.parametrize("name,read,pushed", [
    ("j2_exists", "struct<o_custkey:bigint,o_orderstatus:string>", "EqualTo(o_orderstatus,O)"),
    ("o5_latest_nonempty", "struct<event_id:bigint,user_id:bigint,event_type:string,props:string>", "EqualTo(event_type,view)"),
    ("j3_stale", "struct<l_partkey:bigint>", ""),  # reads all rows: no filter
])
def test_columns_and_filters_reach_the_scan(spark, name, read, pushed):
    plan = explain(queries()[name](spark, f"{DATA}/sf0.001"))
    assert read in plan and pushed in plan


@pytest.mark.parametrize("name", [n for n in sorted(queries()) if not n.startswith(("st", "m14", "s7", "s8", "s9", "q18"))])
def test_no_cross_products(spark, name):
    plan = explain(queries()[name](spark, f"{DATA}/sf0.001"))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_top_n_is_pruned_before_the_shuffle(spark):
    assert "WindowGroupLimit" in explain(queries()["o2_newest_n_hidden"](spark, f"{DATA}/sf0.001"))


def test_a_range_list_is_tested_once_as_a_whole(spark):
    plan = explain(queries()["f7_range_list"](spark, f"{DATA}/sf0.001")).upper()
    assert 1 <= plan.count("RLIKE") <= 2  # the list and the one with junk; never per element or per column


def test_fresh_rows_are_worked_out_before_the_merge(spark):
    plan = explain(queries()["u5_cached_merge"](spark, f"{DATA}/sf0.001"))
    assert "lineitem" not in plan and "Aggregate" not in plan  # a table of groups would stay beside the sorted rows of the join


def test_whole_texts_do_not_go_to_python_in_large_batches(spark):
    plan = explain(queries()["f4_nfkc"](spark, f"{DATA}/sf0.001"))
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
