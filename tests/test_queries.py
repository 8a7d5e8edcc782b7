"""Every registered query: against its SQL where it has one, else it must give
rows with a stable schema."""

import compare
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare.difference(spark, contract.queries()[name], ORACLE[name], SF, con) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLE)))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["vec_id", "pred", "seen", "hits", "accuracy"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.queries()["p16_filter"](spark, SF))
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "o_custkey" not in plan
    plan = plan_of(contract.queries()["g1_keyed_count"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_round_filters_reach_the_scan(spark):
    from millrace.operators.order import with_rank

    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    ranked = with_rank(rows, "vec_id", dense_from=0).filter("rank >= 64 and rank < 128")
    assert "LessThan(vec_id,128)" in plan_of(ranked)
