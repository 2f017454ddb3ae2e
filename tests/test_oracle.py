"""Every plan with comparison SQL, on the smallest tables."""

import pytest
from oracle import DATA, compare, connect

from attesta.plans import oracle_sql, queries

SF = "0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    problem, _ = compare(queries()[name](spark, f"{DATA}/sf{SF}"), con, oracle_sql()[name])
    assert problem is None, problem


def test_rows_only_plans_run(spark):
    for name in sorted(set(queries()) - set(oracle_sql())):
        assert queries()[name](spark, f"{DATA}/sf{SF}").count() > 0, name


@pytest.mark.parametrize("name", ["s10_entity_docs", "o1_newest_nulls_last", "w5_attribution", "w6_runs", "w7_longest_block", "w16_gap_clusters",
                                  "w17_nearest_within", "j5_certain_link", "j19_null_safe_first", "j24_two_evidence", "a16_upper_median", "t3_lexical_support"])
def test_large_group_path_gives_the_same(spark, con, tiny_blocks, name):
    problem, _ = compare(queries()[name](spark, f"{DATA}/sf{SF}"), con, oracle_sql()[name])
    assert problem is None, problem


def test_scoped_fix_of_letters_without_a_single_capital(spark, con, tmp_path):
    docs = [(1, "Erß war"), (2, "ﬁn"), (3, "ça va"), (4, "weiß"), (5, ""), (6, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i != 4)) for i, _ in docs], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    own = con.cursor()
    for name in ("documents", "labels"):
        own.execute(f"CREATE TEMP VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    problem, n = compare(queries()["j28_scoped_fix"](spark, str(tmp_path)), own, oracle_sql()["j28_scoped_fix"])
    assert problem is None and n == 6, problem
