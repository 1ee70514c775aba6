"""Hand-computed cases, one small table per rule."""

import math

import pytest
from pyspark.sql import functions as F

from scoreloom import config
from scoreloom.functions import scaling
from scoreloom.functions.expressions import nan_to_null
from scoreloom.functions.hashing import hash_below
from scoreloom.functions.names import ascii_map, ascii_name, with_ascii_names
from scoreloom.operators import binning, evaluate, prepare, ranges, sample, validate
from scoreloom.operators.prepare import FeatureEncoder
from scoreloom.operators.score import grade_distribution, with_score

INF, NAN = float("inf"), float("nan")


def values(df, name):
    return [r[name] for r in df.collect()]


def column_of(spark, numbers, name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], f"i int, {name} double").coalesce(1).orderBy("i")


# -- scoring ----------------------------------------------------------------------------------


def test_extreme_probabilities(spark):
    rows = with_score(column_of(spark, [0.0, 1.0, None, NAN, 0.5], "probability")).orderBy("i").collect()
    assert [r["score"] for r in rows] == [1.0, 1000.0, None, None, 600.0]
    assert [r["grade"] for r in rows] == [8, 1, 0, 0, 2]
    assert rows[0]["log_odds"] == -INF and rows[1]["log_odds"] == INF and rows[4]["log_odds"] == 0.0


def test_points_round_half_to_even(spark):
    odds = column_of(spark, [0.5 * math.log(2), 1.5 * math.log(2), 2.5 * math.log(2)])
    assert values(odds.select(scaling.points(F.col("x"), 600, 1).alias("p")), "p") == [600.0, 602.0, 602.0]
    shifted = column_of(spark, [math.log(2)])
    assert values(shifted.select(scaling.points(F.col("x"), 500, 20, base_odds=2).alias("p")), "p") == [500.0]
    with pytest.raises(ValueError):
        scaling.points(F.col("x"), pdo=0)


def test_grades(spark):
    scores = [638, 637, 582, 581, 538, 537, 498, 497, 457, 456, 418, 417, 322, 321, 1, 0]
    frame = column_of(spark, [float(s) for s in scores])
    for kind in ("general", "single"):
        got = values(frame.select(scaling.grade(F.col("x"), kind).alias("g")), "g")
        assert got == [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 0]
    with pytest.raises(ValueError):
        scaling.grade(F.col("x"), "double")


def test_bands(spark):
    frame = column_of(spark, [0.9, 0.8999, 0.7, 0.6, 0.3, 0.1, 0.0, -0.1, NAN, None])
    assert values(frame.select(scaling.band(F.col("x")).alias("b")), "b") == [1, 2, 3, 4, 7, 9, 10, 0, 0, 0]


def test_distribution_adds_up(spark):
    scored = with_score(column_of(spark, [i / 100 for i in range(101)], "probability"))
    rows = grade_distribution(scored, "single").collect()
    assert sum(r["single_count"] for r in rows) == 101
    assert sum(r["single_percentage"] for r in rows) == pytest.approx(100)


def test_score_grows_with_probability(spark):
    rows = with_score(column_of(spark, [i / 1000 for i in range(1001)], "probability")).orderBy("i").collect()
    scores = [r["score"] for r in rows]
    assert scores == sorted(scores) and scores[0] == 1 and scores[-1] == 1000


# -- evaluation -------------------------------------------------------------------------------


def auc(spark, scores, labels, **options):
    frame = spark.createDataFrame(list(zip(scores, labels)), "probability double, PERF int")
    return evaluate.roc_auc(frame, **options).first()["roc_auc"]


def test_auc(spark):
    scores, labels = [1.0, 0.4, 0.4, 0.1, 0.9], [1, 0, 1, 0, 0]
    assert auc(spark, scores, labels) == 0.75
    assert auc(spark, [-s for s in scores], labels) == pytest.approx(0.25)
    assert auc(spark, scores, [1] * 5) is None
    assert auc(spark, [0.1, NAN, None, 0.9], [0, 1, 1, 1]) == 1.0


def test_auc_does_not_depend_on_ranges_or_partitions(spark):
    import random
    rng = random.Random(3)
    rows = [(0.5 if rng.random() < 0.4 else round(rng.random(), 3), int(rng.random() < 0.3), i % 3) for i in range(3000)]
    frame = spark.createDataFrame(rows, "probability double, PERF int, part int")
    whole = evaluate.roc_auc(frame).first()["roc_auc"]
    pos = [s for s, y, _ in rows if y]
    neg = [s for s, y, _ in rows if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert whole == pytest.approx(pairs, abs=1e-12)
    by_part = {r["part"]: r["roc_auc"] for r in evaluate.roc_auc(frame, groups=["part"]).collect()}
    for n in (1, 4, 16):
        split = frame.repartition(n)
        assert evaluate.roc_auc(split, rows_per_range=100).first()["roc_auc"] == pytest.approx(whole, abs=1e-12)
        again = evaluate.roc_auc(split, groups=["part"], rows_per_range=50).collect()
        assert {r["part"]: r["roc_auc"] for r in again} == pytest.approx(by_part, abs=1e-12)


def test_psi_is_zero_for_equal_and_skips_missing_bands(spark):
    rows = [("val", p, y) for p, y in [(0.95, 1), (0.85, 0), (0.05, 0), (0.05, 1)]]
    same = [("test", p, y) for _, p, y in rows]
    frame = evaluate.with_band(spark.createDataFrame(rows + same, "split string, probability double, PERF int"))
    combined = evaluate.band_combined(evaluate.band_summary(frame))
    assert evaluate.score_psi(combined).first()["psi"] == 0.0
    fewer = evaluate.with_band(spark.createDataFrame(rows + same[:1], "split string, probability double, PERF int"))
    combined = evaluate.band_combined(evaluate.band_summary(fewer)).orderBy("scale")
    assert values(combined, "sample_count_test") == [1, None, None]
    expected = (0.25 - 1.0) * math.log(0.25 / 1.0)
    assert evaluate.score_psi(combined).first()["psi"] == pytest.approx(expected)


# -- binning ----------------------------------------------------------------------------------


def edges(spark, numbers, **options):
    return binning.quantile_edges(column_of(spark, numbers), ["x"], **options)["x"]


def test_edges_with_heavy_ties(spark):
    assert edges(spark, [1.0] * 7 + [2.0, 3.0, 4.0]) == [2.0]
    assert edges(spark, [5.0] * 10) == []
    assert edges(spark, []) == []
    assert edges(spark, [None, None]) == []


def test_edges_with_many_nulls_give_an_empty_top_interval(spark):
    numbers = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None, None]
    frame = column_of(spark, numbers).select(
        "x", (F.col("i") % 2).alias("PERF"), F.lit("TRAIN").alias("data_type")
    )
    bins = binning.fit_bins(frame)
    assert bins.edges["x"] == [1.0, 3.0, 4.0, 6.0]
    top = binning.numerical_summary(binning.bin_counts(frame, bins), bins, bounds=True).orderBy("bin_order").collect()[-1]
    assert (top["count"], top["iv_1"], top["bin_low"], top["bin_high"], top["bad_rate"]) == (0, 0.0, 6.0, INF, None)


def brute_edges(numbers, quantiles, special=()):
    pool = [x for x in numbers if x is None or (x == x and x not in special)] + [None] * sum(
        1 for x in numbers if x is not None and x != x
    )
    found = set()
    for q in quantiles:
        fitting = [v for v in set(pool) - {None} if 10 * sum(1 for x in pool if x is not None and x <= v) <= round(10 * q) * len(pool)]
        found |= {max(fitting)} if fitting else set()
    return sorted(found)


@pytest.mark.parametrize("leaf,n_ranges", [(10**6, 256), (40, 4), (5, 3), (1, 16), (0, 2)])
def test_edges_equal_brute_force_on_every_path(spark, leaf, n_ranges):
    import random
    rng = random.Random(11)
    numbers = []
    for _ in range(1500):
        u = rng.random()
        numbers.append(
            7.0 if u < 0.33 else None if u < 0.4 else NAN if u < 0.42 else -0.0 if u < 0.44 else 0.0 if u < 0.46
            else -99999999.0 if u < 0.5 else round(rng.lognormvariate(2, 1), 2)
        )
    frame = column_of(spark, numbers).select("x", (F.col("x") > 5).alias("flag"), F.lit(None).cast("double").alias("none"))
    special = (-99999999.0,)
    got = binning.quantile_edges(
        frame, ["x", "flag", "none"], (0.2, 0.4, 0.6, 0.8), special, leaf_rows=leaf, n_ranges=n_ranges
    )
    assert got["x"] == brute_edges(numbers, (0.2, 0.4, 0.6, 0.8), special)
    flags = [None if x is None else float(x != x or x > 5) for x in numbers]
    assert got["flag"] == brute_edges(flags, (0.2, 0.4, 0.6, 0.8)) and got["none"] == []


@pytest.mark.parametrize("leaf,n_ranges", [(10**6, 256), (2, 3)])
def test_infinite_values_frame_the_edges(spark, leaf, n_ranges):
    numbers = [-INF] * 4 + [1.0, 2.0] + [INF] * 10
    assert edges(spark, numbers, leaf_rows=leaf, n_ranges=n_ranges) == [2.0]
    frame = column_of(spark, numbers)
    assert values(frame.select(binning.assign_bin(F.col("x"), [2.0]).alias("b")), "b") == [0] * 6 + [1] * 10


def test_bins_are_right_closed(spark):
    frame = column_of(spark, [0.0, 1.0, 2.0, 3.0, 5.0, 9.0, None])
    assert values(frame.select(binning.assign_bin(F.col("x"), [2.0, 5.0]).alias("b")), "b") == [0, 0, 0, 1, 1, 2, None]
    special = frame.select(binning.assign_bin(F.col("x"), [2.0], [9.0, 3.0], str).alias("b"))
    assert values(special, "b") == ["0", "0", "0", "-2", "1", "-1", None]


def test_one_sided_bins_have_no_iv(spark):
    rows = [("a", 1), ("a", 1), ("b", 0), ("b", 0), ("c", 0), ("c", 1), (None, 1)]
    frame = spark.createDataFrame(rows, "s string, PERF int").withColumn("data_type", F.lit("TRAIN"))
    bins = binning.fit_bins(frame)
    found = binning.binning_summary(binning.bin_counts(frame, bins), bins).orderBy("bin").collect()
    assert [(r["bin"], r["count"], r["bad"]) for r in found] == [("a", 2, 2), ("b", 2, 0), ("c", 2, 1)]
    assert [r["iv_1"] for r in found] == [0.0, 0.0, 0.0] and sum(r["total_ratio"] for r in found) == pytest.approx(1)


def test_psi_of_a_level_only_in_train_is_zero(spark):
    rows = [("TRAIN", "a", 0), ("TRAIN", "b", 1), ("TEST", "a", 1), ("TEST", "z", 0)]
    frame = spark.createDataFrame(rows, "data_type string, s string, PERF int")
    bins = binning.fit_bins(frame)
    counts = binning.bin_counts(frame, bins)
    per_bin = {r["bin"]: r["psi"] for r in binning.psi_bins(counts).collect()}
    assert per_bin == {"a": 0.0, "b": 0.0}
    same = counts.where("data_type = 'TRAIN'").unionByName(counts.where("data_type = 'TRAIN'").withColumn("data_type", F.lit("TEST")))
    assert values(binning.variable_psi(binning.psi_bins(same)), "psi") == [0.0]


def test_profile_overflow(spark):
    rows = [("TRAIN", f"l{i % 7}" if i % 2 else "big", i % 2) for i in range(70)]
    frame = spark.createDataFrame(rows, "data_type string, s string, PERF int")
    with pytest.raises(ValueError, match="More than 3 levels"):
        binning.fit_bins(frame, max_levels=3)
    bins = binning.fit_bins(frame, max_levels=3, overflow="other")
    found = {r["bin"]: r["count"] for r in binning.binning_summary(binning.bin_counts(frame, bins), bins).collect()}
    assert len(found) == 3 and found["big"] == 35 and "other" in found and sum(found.values()) == 70
    few, many = frame.where("s = 'big'").drop("data_type"), frame.drop("data_type")
    keys = ("base_ym", "customer_id", "customer_hash")
    few, many = [df.select(*[F.lit("k").alias(k) for k in keys], "*") for df in (few, many)]
    with pytest.raises(ValueError, match="More than 3 levels"):
        binning.profile(few, many, edges_from="train", max_levels=3)


def test_variable_types_reject_others(spark):
    frame = spark.createDataFrame([("a", 1, True)], "s string, n int, b boolean")
    assert binning.variable_types(frame) == (["s"], ["n", "b"])
    with pytest.raises(TypeError):
        binning.variable_types(frame.withColumn("d", F.current_date()))


# -- preparation ------------------------------------------------------------------------------

SPEC_COLUMNS = "base_ym string, customer_id bigint, customer_hash string, PERF int"


def test_null_levels_and_booleans(spark):
    rows = [("1", 1, "h", 0, "b", True), ("1", 2, "h", 1, None, None), ("1", 3, "h", 0, "a", False)]
    frame = spark.createDataFrame(rows, SPEC_COLUMNS + ", s string, b boolean")
    encoded = prepare.one_hot(frame)
    assert encoded.columns[4:] == ["b", "s_0", "s_a", "s_b"]
    assert [tuple(r)[4:] for r in encoded.orderBy("customer_id").collect()] == [
        (True, 0, 0, 1), (False, 1, 0, 0), (False, 0, 1, 0)
    ]


def test_one_hot_overflow(spark):
    rows = [("1", i, "h", 0, "abcabdabe"[i]) for i in range(9)]
    frame = spark.createDataFrame(rows, SPEC_COLUMNS + ", s string")
    with pytest.raises(ValueError, match="More than 3 levels"):
        prepare.one_hot(frame, max_levels=3)
    encoded = prepare.one_hot(frame, max_levels=3, overflow="other")
    assert encoded.columns[4:] == ["s_a", "s_b", "s_other"]
    assert [sum(r) for r in zip(*[tuple(r)[4:] for r in encoded.collect()])] == [3, 3, 3]
    named = frame.withColumn("s", F.when(F.col("s") == "a", "other").otherwise(F.col("s")))
    encoded = prepare.one_hot(named, max_levels=3, overflow="other")
    assert encoded.columns[4:] == ["s_b", "s_other"]
    assert [sum(r) for r in zip(*[tuple(r)[4:] for r in encoded.collect()])] == [3, 6]


def test_scoring_uses_fitted_levels(spark):
    train = spark.createDataFrame([("1", 1, "h", 0, "a", 1.0), ("1", 2, "h", 1, "b", NAN)], SPEC_COLUMNS + ", s string, x double")
    later = spark.createDataFrame([("2", 7, "h", "z")], "base_ym string, customer_id bigint, customer_hash string, s string")
    encoder = FeatureEncoder.fit(train)
    assert encoder.transform(later).collect()[0].asDict() == {
        "base_ym": "2", "customer_id": 7, "customer_hash": "h", "x": 0, "s_a": 0, "s_b": 0
    }
    assert values(encoder.transform(train).orderBy("customer_id"), "x") == [1.0, 0.0]


def test_keep_lists_and_alignment(spark):
    frame = spark.createDataFrame([("1", 1, "h", 0, "a", "q", 2)], SPEC_COLUMNS + ", s string, t string, x int")
    assert prepare.one_hot(frame, keep=["s", "x"]).columns[4:] == ["x", "s_a"]
    assert prepare.one_hot(frame, keep=["t_q", "x", "s_gone"]).columns[4:] == ["t_q", "x", "s_gone"]
    wide = spark.createDataFrame([(1, 2, 3)], "a int, c int, z int")
    assert prepare.align(wide, ["a", "b", "c"]).collect()[0].asDict() == {"a": 1, "b": 0, "c": 2}
    assert prepare.common_features(["d", "a", "b"], ["b", "c", "d"]) == ["d", "b"]


def test_test_snapshot_without_a_level(spark):
    schema = SPEC_COLUMNS + ", s string"
    train = spark.createDataFrame([("1", i, "h", 0, "ab"[i % 2]) for i in range(6)], schema)
    test = spark.createDataFrame([("2", i, "h", 0, "a") for i in range(6)], schema)
    assert prepare.prepare(train, test).encoder.names == ["s_a"]
    assert prepare.prepare(train, test, keep=["s_b"]).encoder.names == ["s_b"]
    with pytest.raises(ValueError, match="Dataset mismatch"):
        prepare.prepare(train, test.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="Check target"):
        prepare.prepare(train, test.drop("PERF"))


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_splits_do_not_depend_on_partitions(spark, partitions):
    frame = spark.range(1500).withColumnRenamed("id", "customer_id")
    chosen = lambda df: set(values(df.where("split = 'val'"), "customer_id"))
    exact = prepare.split_exact(frame.repartition(partitions))
    assert len(chosen(exact)) == 450
    hashed = frame.repartition(partitions).withColumn("split", F.when(prepare.is_validation(), "val"))
    import hashlib
    digest = {i: hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(1500)}
    assert chosen(hashed) == {i for i, h in digest.items() if h < "4ccccccd"}
    assert chosen(exact) == set(sorted(digest, key=lambda i: (digest[i], i))[:450])
    assert hash_below(0.3) == "4ccccccd"


def test_first_rows_by_hash(spark):
    frame = spark.range(3000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    order = [r["k"] for r in sorted(frame.collect(), key=lambda r: (r["h"], r["k"]))]
    for k in (0, 1, 2, 1234, 3000, 3001):
        first, others = ranges.first_by_hash(frame, "h", k)
        assert {r["k"] for r in first.collect()} == set(order[:k])
        assert sorted(r["k"] for r in others.collect()) == sorted(order[k:])


def test_first_rows_of_repeated_and_missing_keys(spark):
    """Exact numbers where many rows share a key, differ elsewhere or not at all, or have none."""
    rows = [(i % 10, i % 3) for i in range(100)] + [(3, 1)] * 20 + [(None, 1)] * 5
    frame = spark.createDataFrame(rows, "customer_id bigint, x bigint")
    hashed = frame.withColumn("h", F.md5(F.col("customer_id").cast("string")))
    for k in (1, 5, 33, 47, 119, 120, 125):
        first, others = ranges.first_by_hash(hashed, "h", k)
        assert (first.count(), others.count()) == (min(k, 120), 125 - min(k, 120))
    split = prepare.split_exact(frame)
    assert split.where("split = 'val'").count() == 38 and split.count() == 125
    for n in (5, 33, 200):
        assert sample.sample_rows(frame, n, "customer_id").count() == min(n, 120)


def test_equal_rows_are_dealt_exactly(spark, monkeypatch):
    """A third and more of the rows are equal in every column; their copies come from several tasks."""
    monkeypatch.setattr(ranges.copies, "__defaults__", (40,))
    rows = [(7, "same", None)] * 500 + [(i, "other", 1.5) for i in range(300)]
    frame = spark.createDataFrame(rows, "customer_id bigint, s string, x double").withColumn("h", F.md5(F.col("customer_id").cast("string")))
    below = frame.where("customer_id != 7 OR s != 'same'").where(F.col("h") < F.md5(F.lit("7"))).count()
    for k in (below + 1, below + 250, below + 499):
        first, others = ranges.first_by_hash(frame, "h", k)
        assert first.columns == frame.columns == others.columns
        assert (first.count(), others.count()) == (k, 800 - k)
        assert first.unionAll(others).exceptAll(frame).count() == 0
    written = ranges.copies(spark.sql("SELECT struct(1 AS a) AS row, 995L AS n"), F.col("n"))
    per_task = [r["count"] for r in written.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 995 and len(per_task) > 3 and max(per_task) < 600


def test_missing_groups_and_keys_stay(spark):
    frame = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 4)], "g string, v double, n bigint")
    for points in ([], [1.5]):
        got = sorted(((r["g"], r["running_n"]) for r in ranges.running_totals(frame, ["g"], "v", ["n"], points).collect()), key=repr)
        assert got == sorted([(None, 2), (None, 5), ("a", 4)], key=repr)
    keys = spark.createDataFrame([(1,), (None,), (2,)], "k bigint")
    features = spark.createDataFrame([(10, "x"), (None, "y"), (11, "z")], "f bigint, s string")
    joined = {r["k"]: r["s"] for r in sample.positional_join(keys, features, "k", "f").collect()}
    assert set(joined) == {1, 2, None} and joined[None] is None and {joined[1], joined[2]} == {"x", "z"}


def test_any_number_of_levels(spark):
    """A profile and an encoding of a column with far more levels than others, running sums over many ranges."""
    rows = [(f"customer-{i:06d}", "ab"[i % 2], i % 3 % 2, "TRAIN") for i in range(12_000)]
    frame = spark.createDataFrame(rows, "wide string, s string, PERF int, data_type string")
    bins = binning.fit_bins(frame)
    summary = binning.categorical_summary(binning.bin_counts(frame, bins), bins).where("variable = 'wide'").orderBy("bin").collect()
    assert [r["bin_order"] for r in summary] == list(range(12_000))
    bad = 0
    for r in summary:
        bad += r["bad"]
        assert r["cumulative_bad"] == bad
    encoded = prepare.one_hot(frame.where("wide < 'customer-000400'").drop("data_type"))
    assert len([c for c in encoded.columns if c.startswith("wide_")]) == 400


def test_one_strange_level_does_not_join_the_ranges(spark):
    """Levels that begin alike, beside one that does not, still lie in many ranges of about the same size."""
    rows = [(f"customer-{i:06d}", i % 3 % 2, "TRAIN") for i in range(4000)] + [("NA", 1, "TRAIN"), ("", 0, "TRAIN"), ("é", 1, "TRAIN")]
    frame = spark.createDataFrame(rows, "wide string, PERF int, data_type string")
    bins = binning.fit_bins(frame)
    counts = binning.bin_counts(frame, bins)
    placed, points = binning._level_place(binning.pooled(counts, "pooled"), 200)
    sizes = [r["count"] for r in placed.select("place").groupBy("place").count().collect()]
    assert len(points) == 20 and len(sizes) > 15 and max(sizes) < 600
    many = binning.categorical_summary(counts, bins, rows_per_range=200).orderBy("bin").collect()
    assert many == binning.categorical_summary(counts, bins).orderBy("bin").collect()
    assert [r["bin_order"] for r in many] == list(range(4003))


def test_no_task_gets_all_levels_of_a_variable(spark):
    """The summary of one wide variable comes from many tasks, and no join deals its levels by variable."""
    rows = [(f"customer-{i:06d}", i % 3 % 2, "TRAIN") for i in range(4000)]
    frame = spark.createDataFrame(rows, "wide string, PERF int, data_type string")
    bins = binning.fit_bins(frame)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        summary = binning.categorical_summary(binning.bin_counts(frame, bins), bins, rows_per_range=200)
        sizes = [r["count"] for r in summary.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and len(sizes) > 5 and max(sizes) < 2000


def test_running_totals_and_positions(spark):
    rows = [(g, float(v), v % 5 + 1) for g in ("a", "b") for v in range(200)]
    frame = spark.createDataFrame(rows, "g string, v double, n bigint")
    for points in ([], [50.0, 51.0, 120.0], [float(p) for p in range(0, 200, 7)]):
        got = {(r["g"], r["v"]): r["running_n"] for r in ranges.running_totals(frame, ["g"], "v", ["n"], points).collect()}
        assert got == {(g, v): sum(x % 5 + 1 for x in range(int(v) + 1)) for g, v, _ in rows}
    hashed = frame.where("g = 'a'").withColumn("h", F.md5(F.col("v").cast("string")))
    numbered = ranges.positions(hashed, ranges.hash_bucket("h", 1), ["h"]).orderBy("position").collect()
    assert [r["position"] for r in numbered] == list(range(1, 201))
    assert [r["h"] for r in numbered] == sorted(r["h"] for r in numbered)


@pytest.mark.parametrize("alike", [False, True])
def test_positions_of_hot_keys(spark, alike):
    """A third of the rows has one key, a fifth has none: all are numbered in key order, whatever else they hold."""
    hot = lambda i: 7.0 if i % 3 == 0 else None if i % 5 == 0 else float(i // 4)
    keys = [hot(i) for i in range(900)]
    frame = spark.createDataFrame([(k, "same" if alike else str(i)) for i, k in enumerate(keys)], "k double, `s.x` string")
    bucket = F.floor(F.col("k") / 40)
    plain = ranges.positions(frame, bucket, ["k"])
    split = ranges.positions(frame, bucket, ["k"], rows_per_task=20)
    order = sorted(keys, key=lambda k: (k is None, k or 0))
    for found in (plain, split):
        rows = sorted(found.collect(), key=lambda r: r["position"])
        assert found.columns == ["k", "s.x", "position"]
        assert [r["position"] for r in rows] == list(range(1, 901)) and [r["k"] for r in rows] == order
        assert sorted(r["s.x"] for r in rows) == sorted(r["s.x"] for r in frame.collect())
    parts = ranges._hot_values(frame.withColumn("__bucket", bucket), ["k"], 20).collect()
    assert {r["__hot_0"]: r["__parts"] for r in parts} == {k: -(-keys.count(k) // 20) for k in set(keys) if keys.count(k) > 20}
    assert ranges.positions(frame.limit(0), bucket, ["k"]).collect() == []


# -- names ------------------------------------------------------------------------------------


def test_ascii_names(spark):
    assert ascii_name("마감년월") == "magamnyeonweol" and ascii_name("café_x") == "cafe_x"
    assert ascii_name("月") == "u6708"
    frame = spark.createDataFrame([(1, 2)], "`마감년월` int, plain int")
    assert with_ascii_names(frame).columns == ["magamnyeonweol", "plain"]
    with pytest.raises(ValueError):
        ascii_map(["é", "e"])
    assert ascii_map(["é", "e"], {"é": "e_acute"}) == {"é": "e_acute", "e": "e"}


def test_any_column_name_works(spark):
    from scoreloom.operators.model import fit_model
    from scoreloom.operators.score import with_probability
    rows = [("1", i, "h", i % 2, float(i % 7), i % 3 == 0, ["p.q", "r s", None][i % 3]) for i in range(60)]
    odd = ["a.b", "x`y z", "마감.구분"]
    frame = spark.createDataFrame(rows, SPEC_COLUMNS + ", a double, b boolean, c string").toDF(
        "base_ym", "customer_id", "customer_hash", "PERF", *odd
    )
    for leaf in (10**6, 3):
        found = binning.profile(frame, frame, leaf_rows=leaf, n_ranges=4)
        assert found.bins.edges["a.b"] == [0.0, 1.0, 3.0, 4.0]
        assert sorted(values(found.table, "variable")) == sorted(odd)
    encoded = prepare.one_hot(frame)
    assert encoded.columns[4:] == ["a.b", "x`y z", "magam.gubun_0", "magam.gubun_p.q", "magam.gubun_r s"]
    fitted = fit_model(encoded, None, encoded.columns[4:], {"max_depth": 2, "n_estimators": 2})
    assert with_probability(encoded, fitted.model).where("probability between 0 and 1").count() == 60


# -- validation -------------------------------------------------------------------------------

GOOD = [("1", 1, "h", 0), ("1", 2, "h", 1)]


@pytest.mark.parametrize(
    "rows,drop,scoring,message",
    [
        (GOOD, (), False, config.VALID),
        (GOOD, ("customer_hash", "PERF"), False, "Missing key values."),
        ([(None, 1, "h", 0), ("1", 1, "h", None)], (), False, "Key values contain NULL."),
        ([("1", 1, "h", 0), ("1", 1, "h", None)], (), False, "Duplicate values found in 'customer_id'."),
        (GOOD, ("PERF",), False, "No target data ('PERF') found."),
        ([("1", 1, "h", None)], (), False, "Target data ('PERF') contains NULL."),
        (GOOD, ("PERF",), True, config.VALID),
        (GOOD, (), True, "Target data ('PERF') should be removed."),
        ([("1", 1, "h", 0), ("1", 1, "h", 0)], (), True, "Duplicate values found in 'customer_id'."),
        ([], (), False, config.VALID),
    ],
)
def test_messages(spark, rows, drop, scoring, message):
    frame = spark.createDataFrame(rows, SPEC_COLUMNS).drop(*drop)
    check = validate.validate_score_data if scoring else validate.validate_modeling_data
    assert check(frame) == (message == config.VALID, message)


def test_nan_keys_and_korean_names(spark):
    spec = config.KOREAN_SPEC
    frame = spark.createDataFrame([("1", 1.0, "h", 0), ("1", NAN, "h", 0)], SPEC_COLUMNS.replace("bigint", "double"))
    assert validate.validate_modeling_data(frame) == (False, "Key values contain NULL.")
    named = frame.toDF(*spec.keys, "PERF").where(f"`{spec.customer_id}` = 1")
    assert validate.validate_modeling_data(named, spec) == (True, config.VALID)
    assert validate.validate_modeling_data(named.union(named), spec)[1] == "Duplicate values found in '계약자고객ID'."
    assert not validate.has_no_nulls(frame, ["customer_id"]) and validate.has_no_nulls(frame, ["PERF"])
    assert values(nan_to_null(frame).orderBy("customer_id"), "customer_id") == [None, 1.0]
    assert validate.has_duplicates(frame, ["customer_hash"]) and not validate.has_duplicates(frame, ["customer_id"])


# -- sampling ---------------------------------------------------------------------------------


def test_sampling_and_positional_join(spark):
    frame = spark.range(100).select("id", (F.col("id") - 10).cast("double").alias("age"))
    assert sample.keep_positive(frame, "age").count() == 89
    first = set(values(sample.sample_rows(frame, 30, "id", 5), "id"))
    assert len(first) == 30 and first == set(values(sample.sample_rows(frame.repartition(7), 30, "id", 5), "id"))
    assert sample.sample_rows(frame, 1000, "id").count() == 100
    keys = sample.key_table(spark, 120, "202304")
    assert keys.where("length(customer_hash) = 10").count() == 120
    joined = sample.positional_join(keys, frame, "customer_id", "id")
    assert joined.count() == 120 and joined.where("id is null").count() == 20
    assert joined.where("id is not null").agg(F.max("customer_id")).first()[0] == 100
