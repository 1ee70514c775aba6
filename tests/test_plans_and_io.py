"""Plan shape, files, registry, runs on bad data, and the stream path."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from scoreloom.catalog.score_queries import MODEL_FEATURES, _fixed_model
from scoreloom.config import DEFAULT_SPEC
from scoreloom.functions.expressions import insert_column
from scoreloom.operators import binning, evaluate, score
from scoreloom.operators.prepare import Feature, FeatureEncoder
from scoreloom.plans.development import DevelopmentRun
from scoreloom.plans.scoring import ScoringRun
from scoreloom.sources import snapshots as io, tables
from scoreloom.sources.registry import ModelRegistry, model_name
from scoreloom.catalog import QUERIES, SQL
from scoreloom.sources.workspace import fresh_path, shared_folder, stored
from scoreloom.streaming.scoring import read_stream, score_stream, write_stream



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def train(spark, tiny_dir):
    return stored(tables.snapshot(spark, tiny_dir, "TRAIN"), "train")


def test_scoring_is_one_narrow_stage(spark, train):
    encoder = FeatureEncoder.fit(train)
    text = plan(score.score_snapshot(encoder.transform(train), MODEL_FEATURES, _fixed_model()))
    assert "Exchange" not in text and "Python" not in text
    scanned = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert "acctbal" not in scanned and "total_price" in scanned


@pytest.mark.parametrize("name", ["eval_scale", "score_points", "score_clamp", "score_grade", "registry_model_name"])
def test_row_operators_do_not_shuffle(spark, tiny_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, tiny_dir))


def test_no_python_workers_and_no_sorting_aggregates(spark, tiny_dir):
    for name in ("snapshot", "binning_summary", "psi_bins", "eval_roc_auc", "dist_prefix_sum", "prep_dev", "validate_modeling"):
        text = plan(QUERIES[name](spark, tiny_dir))
        assert "Python" not in text and "CartesianProduct" not in text, name
        # A maximum of texts is the one thing that Spark cannot hold in a hash table of an aggregation.
        sorting = [line for line in text.splitlines() if "SortAggregate" in line and "o_orderstatus" not in line]
        assert not [line for line in sorting if "max(" not in line], name


def test_filters_and_columns_reach_the_files(spark, tiny_dir):
    text = plan(QUERIES["snapshot"](spark, tiny_dir))
    assert "o_orderdate" in re.search(r"PushedFilters: \[([^\]]*GreaterThan[^\]]*)\]", text).group(1)
    lines = plan(QUERIES["score_grade_distribution"](spark, tiny_dir))
    assert re.search(r"ReadSchema: struct<([^>]*)>", lines).group(1) == "l_orderkey:bigint,l_linenumber:int"


def test_one_month_reads_one_partition(spark, tiny_dir):
    path = io.write_by_month(tables.snapshots(spark, tiny_dir), fresh_path(spark, "months"))
    month = io.read_month(spark, path, "200012")
    assert "PartitionFilters: [" in plan(month) and "base_ym" in re.search(r"PartitionFilters: \[(.*?)\]", plan(month)).group(1)
    assert {r[0] for r in month.select("base_ym").distinct().collect()} == {"200012"}
    assert month.count() == tables.snapshot(spark, tiny_dir, "TEST").count()


def test_profile_jobs_do_not_grow_with_variables(spark, train):
    def jobs(df, group):
        spark.sparkContext.setJobGroup(group, group)
        binning.profile(df, df)
        spark.sparkContext.setJobGroup("rest", "rest")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few = train.select("base_ym", "customer_id", "customer_hash", "PERF", "acctbal", "segment")
    many = few.select("*", *[(F.col("acctbal") * i).alias(f"x{i}") for i in range(2, 12)],
                      *[F.concat("segment", F.lit(str(i))).alias(f"s{i}") for i in range(5)])
    assert jobs(many, "many") <= jobs(few, "few") + 2


def test_csv_files(spark, train):
    folder = fresh_path(spark, "csv")
    assert io.month_file("d/", "202304") == "d/sample_data_202304.csv"
    assert io.month_file("d", "202306", scoring=True) == "d/sample_score_data_202306.csv"
    labelled = io.read_snapshot(spark, io.write_labelled(train, folder, "199912"))
    assert labelled.schema["base_ym"].dataType.simpleString() == "string" and labelled.columns == train.columns
    assert labelled.exceptAll(train.select(labelled.columns)).count() == 0
    unlabelled = io.read_snapshot(spark, io.write_unlabelled(train, folder, "199912"), train.drop("PERF").schema)
    assert "PERF" not in unlabelled.columns and unlabelled.count() == train.count()


def test_writing_scores_again_replaces_that_month_only(spark):
    path = fresh_path(spark, "scores")
    schema = "base_ym string, customer_id bigint, customer_hash string, probability double, log_odds double, score double, grade int"
    row = lambda ym, s: (ym, 1, "h", 0.5, 0.0, s, 2)
    io.write_scores(spark.createDataFrame([row("202301", 600.0), row("202302", 601.0)], schema), path, "general")
    io.write_scores(spark.createDataFrame([row("202302", 602.0)], schema), path, "general")
    io.write_scores(spark.createDataFrame([row("202302", 603.0)], schema), path, "single")
    found = {(r["score_type"], str(r["base_ym"]), r["score"]) for r in spark.read.parquet(path).collect()}
    assert found == {("general", "202301", 600.0), ("general", "202302", 602.0), ("single", "202302", 603.0)}


def test_registry(spark):
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    first, second = (model_name("xgb", datetime(2023, 10, d, 15, 5, 11)) for d in (17, 18))
    assert first == "xgb_231017_150511"
    for name in (second, first, first):  # a name registered again replaces its rows
        registry.append_result(name, "xgb", 2, 0.7, 0.69, 0.68)
        registry.append_importance(name, [("b", 0.4, 2, 1.5), ("a", 0.6, 3, 2.5)])
        registry.append_params(name, {"max_depth": 3})
    registry.append_result("lgb_991231_000000", "lgb", 1, 0.5, 0.5, 0.5)
    assert registry.latest("xgb") == second and registry.features(first) == ["b", "a"]
    assert registry.results().count() == 3 and registry.params().count() == 2
    with pytest.raises(ValueError):
        registry.latest("cat")
    encoder = FeatureEncoder(
        DEFAULT_SPEC,
        (Feature("x", "x"), Feature("s_a", "s", "a"), Feature("s_other", "s", "other", ("a",))), ("x", "gone", "s_a", "s_other"),
    )
    registry.append_encoder(first, encoder)
    assert registry.encoder(first) == encoder


def test_runs_refuse_invalid_snapshots(spark, train):
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    run = DevelopmentRun(registry, fresh_path(spark, "out"), datetime(2024, 1, 1), datetime(2024, 1, 2))
    with pytest.raises(ValueError, match="train: Duplicate values"):
        run.run(train.union(train), train)
    with pytest.raises(ValueError, match="should be removed"):
        ScoringRun(registry, fresh_path(spark, "scores")).run(train)


def test_columns_can_be_inserted(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    assert insert_column(frame, 1, "mid", F.lit(0)).columns == ["a", "mid", "b"]


def test_shared_folder_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir") and (before is None or folder == before)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_stream_scores_like_batch(spark, train):
    inbox, out = fresh_path(spark, "inbox"), fresh_path(spark, "scored")
    encoder = FeatureEncoder.fit(train)
    arriving = train.drop("PERF")
    arriving.write.parquet(inbox)
    stream = read_stream(spark, inbox, arriving.schema)
    query = write_stream(
        score_stream(stream, encoder, MODEL_FEATURES, _fixed_model()), out, fresh_path(spark, "progress")
    )
    query.awaitTermination(120)
    batch = score.score_snapshot(encoder.transform(arriving), MODEL_FEATURES, _fixed_model())
    assert spark.read.parquet(out).exceptAll(batch).count() == 0 and spark.read.parquet(out).count() == train.count()


def test_hot_group_is_split_over_ranges(spark):
    """One group with most rows and one frequent score: totals still equal the plain count."""
    frame = spark.range(40_000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("part"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 40_000).alias("probability"),
        (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("PERF"),
    )
    one = {r["part"]: r["roc_auc"] for r in evaluate.roc_auc(frame, groups=["part"]).collect()}
    many = {r["part"]: r["roc_auc"] for r in evaluate.roc_auc(frame, groups=["part"], rows_per_range=500).collect()}
    assert one == pytest.approx(many, abs=1e-12)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and {"probability", "score", "grade"} <= set(frame.columns)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert not [n for n in QUERIES if n.startswith("op") or "pipeline" in n]


def test_shared_folder(spark, monkeypatch):
    """The folder of the session, else that of the context, else one of its own in local mode only."""
    from types import SimpleNamespace

    def session(conf, directory, master):
        made = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: directory, setCheckpointDir=made.append)
        options = dict(conf)
        return SimpleNamespace(
            sparkContext=context, conf=SimpleNamespace(get=lambda k, d: options.get(k, d), set=options.__setitem__)), made

    named = {"spark.checkpoint.dir": "hdfs://x/y"}
    fake, made = session(named, None, "yarn")
    assert shared_folder(fake) == "hdfs://x/y" and made == ["hdfs://x/y"]
    assert shared_folder(session({}, "hdfs://set/here", "yarn")[0]) == "hdfs://set/here"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session({}, None, "spark://host:7077")[0])
    assert shared_folder(session({}, None, "local[4]")[0])


def test_scoring_reports_its_own_months(spark, tiny_dir):
    """What another month left in the folder does not count, and a repeated run changes nothing."""
    found = QUERIES["monthly_scoring_stump"](spark, tiny_dir).collect()
    assert sum(r["general_count"] for r in found) == QUERIES["prep_scoring"](spark, tiny_dir).count()


@pytest.mark.parametrize("name,scans", [("eval_psi", 1), ("eval_band_combined", 1), ("validate_every_month", 1)])
def test_sources_are_scanned_once(spark, tiny_dir, name, scans):
    assert plan(QUERIES[name](spark, tiny_dir)).count("FileScan") == scans
