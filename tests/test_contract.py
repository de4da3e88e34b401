"""Every registered query against its SQL, and the plans that matter at scale."""

import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import SF
from winnow.operators import dedup, upsert
from winnow.plans import oracles, queries

TABLES = ("events", "documents", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


#: Queries that SQL cannot express; test_names.py holds this one against brute force.
WITHOUT_SQL = {"named_entities"}


def test_every_query_has_sql():
    assert set(queries.QUERIES) - WITHOUT_SQL == set(oracles.ORACLES)
    assert queries.QUERIES.items() <= contract.queries().items()
    assert oracles.ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    columns = sorted(result.columns)
    got = sorted((tuple(map(comparable, r)) for r in result.select(*columns).collect()), key=repr)
    reply = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in reply.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(comparable(r[i]) for i in order) for r in reply.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 182


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_signature_scan_reads_two_columns_without_a_shuffle(spark):
    plan = plan_of(dedup.bands(queries.table(spark, SF, "documents"), "doc_id", "text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "Exchange" not in plan


def test_survivors_are_aggregated_before_the_shuffle(spark):
    plan = plan_of(dedup.survivors(dedup.bands(queries.table(spark, SF, "documents"), "doc_id", "text"), "doc_id"))
    assert "partial_min" in plan
    assert plan.count("Exchange ") == 1


def test_upsert_reads_only_the_keys_of_the_target(spark):
    docs = queries.table(spark, SF, "documents")
    plan = plan_of(upsert.not_matched(docs.where(F.col("lang") == "en"), docs, "doc_id"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan


def test_no_cross_joins(spark):
    for name in ("near_dup_keep", "near_dup_pairs", "near_dup_pair_scores", "upsert_by_band", "consolidate_ids"):
        plan = plan_of(contract.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan


def test_texts_are_not_sorted_to_join_ids(spark, documents):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    earlier = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        kept = dedup.keep_first(documents, "doc_id", "text")
        kept.collect()
        assert "ShuffledHashJoin" in plan_of(kept).split("Initial Plan")[0]
    finally:
        spark.conf.set(setting, earlier)


def test_tables_may_be_folders(spark, documents, tmp_path):
    documents.repartition(3, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("near_dup_keep", "stream_dedup"):
        assert contract.queries()[name](spark, str(tmp_path)).count() == 182
