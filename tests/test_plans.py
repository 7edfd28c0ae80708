"""Plans, and the counts the derived table is known to give at sf0.01."""

from __future__ import annotations

import pytest

from tests.test_correct import setting
from txclean.catalogue import derived, queries
from txclean.plans.pipeline import clean
from txclean.shared import shared_folder

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark):
    return clean(derived.raw_transactions(spark, SF_DIR), derived.config(spark))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_survivors_are_picked_before_the_shuffle(run):
    text = plan(run.deduped)
    assert "Partial" in text[text.index("Exchange hashpartitioning"):]
    assert text.count("WindowGroupLimit") >= 2


def test_row_changes_need_no_shuffle(run):
    text = plan(run.row_changes())
    assert "Exchange hashpartitioning" not in text
    assert text.count("FileScan") == 2  # the rows and the corrections


def test_scan_reads_the_columns_in_use_only(run):
    text = plan(run.traced.select("merchant_name"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_corrections_are_broadcast_by_size_only(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        large = clean(derived.raw_transactions(spark, SF_DIR), derived.config(spark))
        assert "Broadcast" not in plan(large.staging)
        assert large.staging.count() == 15_750


@pytest.mark.parametrize("log, reads", [("audit_log", 3), ("audit_lineage", 2)])
def test_reads_of_the_input_by_the_logs(run, log, reads):
    entries = getattr(run, log)()
    entries.collect()
    final = plan(entries).split("== Initial Plan ==")[0]
    assert final.count("ReadSchema: struct<o_") == reads


def test_counts_of_stages_leave_the_names_alone(run):
    for df in (run.row_counts(), run.violation_counts(), run.repeated_ids()):
        assert "merchant" not in plan(df) and "regexp" not in plan(df)


def test_grouping_is_shared_by_the_counts(run):
    summary = run.summary()
    summary.collect()
    assert "ReusedExchange" in plan(summary)


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_folder(spark) == configured


class Session:
    """A session with nothing but settings."""

    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_a_cluster_must_name_its_shared_folder():
    local = shared_folder(Session(spark_master="local[8]"))
    assert local == shared_folder(Session(spark_master="local[8]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="spark://host:7077"))
    named = Session(spark_master="spark://host:7077", spark_checkpoint_dir="hdfs:///shared")
    assert shared_folder(named) == "hdfs:///shared"


def test_known_counts(run):
    final = run.final
    assert {r.stage: r.rows for r in run.row_counts().collect()} == {
        "raw": 15_750, "staging": 15_750, "deduped": 15_000, "final": 15_000
    }
    assert str(final.groupBy().sum("transaction_amount").first()[0]) == "-1502557769.38"
    assert final.where("category = 'Income Reversal'").count() == 456
    assert {r.column_changed: int(r.number_of_changes) for r in run.summary().collect()} == {
        "merchant_name": 12_275,
        "category": 5_700,
        "transactionamount": 479,
        "duplicate_row": 750,
        "exchangerate": 14_926,
        "BookingDateTime": 1_308,
    }
    staging = run.staging
    assert staging.where("merchant_name is not null").count() == 15_694
    assert staging.select("merchant_name").where("merchant_name is not null").distinct().count() == 166
    assert staging.select("category").distinct().count() == 25


def test_row_wise_operators_take_streams(spark, tmp_path):
    from pyspark.sql import functions as F

    from txclean.operators import (
        check,
        classify_keywords,
        fill_from,
        relabel_when,
        standardise_text,
    )
    from txclean.plans import presets

    rows = [(" nando's ", "Retail", None, 5), ("x", "Income", -1, -1), ("y", "Income", 0, 0)]
    batch = spark.createDataFrame(rows, "name string, category string, amount int, instructed int")
    batch.write.parquet(f"{tmp_path}/in")

    def cleaned(df):
        df = standardise_text(df, trim=["name"], titlecase=["name"])
        df = classify_keywords(df, "category", presets.CATEGORY_RULES)
        df = fill_from(df, "amount", "instructed")
        df = relabel_when(df, "category", F.col("amount") < 0, "Reversal")
        return df.where(check("nonzero", F.col("amount") != 0).predicate)

    stream = cleaned(spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in"))
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(out.collect()) == sorted(cleaned(batch).collect())
    assert out.count() == 2
