import pytest
from pyspark.sql import functions as F

from catalog.trips import featured_trips
from farebox.ml import experiments, models, prep, stability, tuning
from farebox.operators import evaluate
from farebox.operators.columns import slot_names
from farebox.operators.quality import complete_rules, quarantine
from farebox.operators.sampling import hash_split
from farebox.operators.scaling import partition_profile, partition_sizes, persisted, spread, storage_report
from farebox.schema import FEATURES_13, GOLD_COLS
from farebox.plans.layers import run_layers
from farebox.sources.model_store import load_first_model, load_model, save_model
from farebox.sources.readers import read_trips

TREES = {"rf": {"numTrees": 4, "maxDepth": 4}, "gbt": {"maxIter": 3, "maxDepth": 3}, "dt": {"maxDepth": 4}}


@pytest.fixture(scope="module")
def data(spark, sf):
    rows = featured_trips(spark, sf).cache()
    train, test = hash_split(rows, "trip_id")
    fitted = prep.feature_pipeline().fit(train)
    return fitted.transform(train).cache(), fitted.transform(test).cache(), fitted


@pytest.fixture(scope="module")
def fitted(data):
    return {k: models.fit(k, data[0], **TREES.get(k, {})) for k in models.ESTIMATORS}


@pytest.mark.parametrize("kind", sorted(models.ESTIMATORS))
def test_each_regressor_beats_the_mean(data, fitted, kind):
    train, test, _ = data
    mean = train.agg(F.avg("label")).first()[0]
    baseline = evaluate.regression_metrics(test.withColumn("prediction", F.lit(mean))).first()["rmse"]
    assert models.evaluate_model(fitted[kind].model, test).first()["rmse"] < baseline
    assert fitted[kind].seconds > 0


def test_comparison_measures_all_models_at_once(data, fitted):
    table = models.compare_models({k: f.model for k, f in fitted.items()}, data[1]).collect()
    assert {r["model_name"] for r in table} == set(models.ESTIMATORS)
    assert [r["rmse"] for r in table] == sorted(r["rmse"] for r in table)
    alone = models.evaluate_model(fitted["dt"].model, data[1]).first()["rmse"]
    assert next(r["rmse"] for r in table if r["model_name"] == "dt") == pytest.approx(alone)


def test_settings_and_unknown_kinds():
    assert models.make_regressor("rf").getNumTrees() == 50
    assert models.make_regressor("gbt", maxIter=7).getMaxIter() == 7
    with pytest.raises(ValueError):
        models.make_regressor("svm")


def test_importances_sum_to_one_and_carry_slot_names(data, fitted):
    names = slot_names(data[0], "features_raw")
    assert names == list(FEATURES_13)
    table = models.importances(data[0], fitted["rf"].model, names).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    assert table[0]["feature"] in ("trip_distance", "avg_speed_mph")
    assert models.importances(data[0], fitted["lr"].model, names).count() == 0
    with pytest.raises(ValueError):
        models.importances(data[0], fitted["rf"].model, names[:-1])


def test_vectors_are_standardised_on_the_training_side(data):
    train, _, fitted = data
    stats = {r["feature"]: r for r in prep.scaler_statistics(fitted, train, FEATURES_13).collect()}
    assert stats["trip_distance"]["mean"] == pytest.approx(train.agg(F.avg("trip_distance")).first()[0])
    assert stats["pickup_month"]["std"] == 0.0


def test_category_index_order_ties_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "c string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "c string")
    got = {r["c"]: r["c_index"] for r in prep.index_categories(train, df, ["c"]).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, "z": 3.0, None: 3.0}


def test_rows_with_missing_inputs_are_set_aside_with_a_reason(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (float("nan"), "b"), (2.0, "b")], "x double, c string")
    complete, rejects = quarantine(df, complete_rules(["x"]))
    assert [r["reject_reason"] for r in rejects.collect()] == ["null_x", "null_x"]
    out = prep.feature_pipeline(("c",), ("x",)).fit(complete).transform(complete)
    assert out.count() == 2
    with pytest.raises(Exception):
        prep.feature_pipeline(("c",), ("x",)).fit(df).transform(df).count()
    assert slot_names(out, "features_raw") == ["x", "c_encoded_a", "c_encoded_b", "c_encoded___unknown"]


@pytest.mark.parametrize("kind", ["lr", "rf"])
def test_saved_models_predict_the_same(data, fitted, tmp_path, kind):
    path = str(tmp_path / kind)
    save_model(fitted[kind].model, path)
    save_model(fitted[kind].model, path)  # overwrites
    with pytest.raises(Exception):
        save_model(fitted[kind].model, path, overwrite=False)
    back = load_first_model([path + "-missing", path], kind)
    both = models.score({"a": fitted[kind].model, "b": back}, data[1])
    assert both.filter("prediction_a != prediction_b").count() == 0
    save_model(data[2], str(tmp_path / "features"))
    assert len(load_model(str(tmp_path / "features"), "features").stages) == len(data[2].stages)


def test_tuning_finds_the_best_combination(data):
    estimator = models.make_regressor("dt")
    grid = {"maxDepth": [1, 4], "maxBins": [8, 32]}
    assert len(tuning.param_grid(estimator, grid)) == 4
    for method in ("tvs", "cv"):
        best, table = tuning.tune(estimator, grid, data[0], method=method, folds=2, id_col="trip_id")
        rows = table.collect()
        assert len(rows) == 4 and rows[0]["rmse"] == min(r["rmse"] for r in rows)
        assert f"maxDepth={best.getMaxDepth()}" in rows[0]["params"]
    with pytest.raises(ValueError):
        tuning.tune(estimator, grid, data[0], method="grid")


@pytest.mark.parametrize("method, metric", [("tvs", "rmse"), ("cv", "mae"), ("tvs", "r2"), ("tvs", "mse")])
def test_boosted_grids_are_measured_on_prefixes_of_one_fit(data, monkeypatch, method, metric):
    """The same table as separate fits give, from one fit for each combination of the other settings."""
    estimator = models.make_regressor("gbt", maxBins=16)
    grid, fits = {"maxIter": [1, 3, 5], "maxDepth": [2, 3]}, []
    fit = type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, rows, params=None: (fits.append(params), fit(self, rows, params))[1])
    how = {"method": method, "folds": 2, "id_col": "trip_id", "metric": metric}
    best, table = tuning.tune(estimator, grid, data[0], **how)
    shared = {r["params"]: r[metric] for r in table.collect()}
    assert len(fits) == 2 * (2 if method == "cv" else 1) + 1
    monkeypatch.setattr(tuning, "PREFIX_METRICS", ())
    again, plain = tuning.tune(estimator, grid, data[0], **how)
    assert shared == pytest.approx({r["params"]: r[metric] for r in plain.collect()}, rel=1e-9)
    assert [r["params"] for r in table.collect()] == [r["params"] for r in plain.collect()]
    assert (best.getMaxIter(), best.getMaxDepth()) == (again.getMaxIter(), again.getMaxDepth())


def test_prefix_metrics_of_an_unknown_metric(data, fitted):
    with pytest.raises(ValueError, match="metric"):
        tuning.prefix_metrics(fitted["gbt"].model, data[1], [1], "var")
    constant = data[1].withColumn("label", F.lit(3.0))
    assert tuning.prefix_metrics(fitted["gbt"].model, constant, [2], "r2")[2] != tuning.prefix_metrics(fitted["gbt"].model, constant, [2], "r2")[2]


def test_default_grid_sizes():
    sizes = {k: len(tuning.param_grid(models.make_regressor(k), g)) for k, g in tuning.DEFAULT_GRIDS.items()}
    assert sizes == {"lr": 9, "dt": 12, "rf": 18, "gbt": 27, "glr": 3}


def test_stability(data, fitted):
    still = stability.stability(fitted["lr"].model, data[1], "trip_id", sd=0.0).first()
    assert (still["records"], still["mean_change"], still["verdict"]) == (data[1].count(), 0.0, "STABLE")
    moved = [stability.stability(fitted["lr"].model, d, "trip_id", sd=1.0).first() for d in (data[1], data[1].repartition(5))]
    assert moved[0]["verdict"] == "UNSTABLE"
    assert moved[0]["mean_change"] == pytest.approx(moved[1]["mean_change"], rel=1e-9)
    assert stability.stability(fitted["lr"].model, data[1], "trip_id", fraction=0.5).first()["records"] > 0


def test_noise_is_standard_normal(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    df = spark.range(20_000).select(F.col("id"), array_to_vector(F.array(F.lit(0.0), F.lit(0.0))).alias("features"))
    noise = vector_to_array("features_perturbed")
    out = stability.perturb(df, "id", sd=2.0).select(noise[0].alias("a"), noise[1].alias("b"))
    row = out.agg(F.avg("a"), F.stddev("a"), F.stddev("b"), F.corr("a", "b")).first()
    assert row[0] == pytest.approx(0.0, abs=0.05) and row[3] == pytest.approx(0.0, abs=0.03)
    assert row[1] == pytest.approx(2.0, rel=0.03) and row[2] == pytest.approx(2.0, rel=0.03)


def test_learning_curve_and_sweep(data):
    train, test, _ = data
    curve = experiments.learning_curve(train, test, "trip_id", (0.3, 1.0), "dt", timed=True, maxDepth=3).collect()
    assert curve[0]["records"] < curve[1]["records"] == train.count()
    assert all(r["throughput"] > 0 for r in curve)
    sweep = experiments.partition_sweep(train, "trip_id", (2, 5), "dt", maxDepth=2).collect()
    assert [r["partitions"] for r in sweep] == [2, 5] and sweep[0]["records"] == sweep[1]["records"]


def test_sample_vs_full(data):
    rows = models.sample_vs_full(data[0], data[1], "trip_id", 0.3, "dt", maxDepth=3).collect()
    assert {r["model_name"] for r in rows} == {"sample", "full"}


def test_partition_counts_see_empty_partitions(spark):
    df = spark.range(0, 10, 1, 2).repartition(8, F.lit(1))
    sizes = [r["rows"] for r in partition_sizes(df).collect()]
    assert len(sizes) == 8 and sorted(sizes)[-1] == 10 and sum(sizes) == 10
    row = partition_profile(df).first()
    assert (row["partitions"], row["records"], row["min_size"], row["max_size"]) == (8, 10, 0, 10)


def test_spread_deals_rows_to_the_partitions_asked_for(spark):
    dealt = spread(spark.range(0, 100, 1, 1), 5, "id")
    assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 100


def test_no_row_of_a_partition_profile_goes_through_python(spark):
    plan = partition_profile(spark.range(100).repartition(4, "id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_too_many_labels_are_refused_where_mllib_lists_them(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("x"))
    with pytest.raises(ValueError, match="labels"):
        prep.fit_features(df, ["c"], ["x"], max_labels=500)
    assert prep.index_categories(df, df, ["c"]).agg(F.max("c_index")).first()[0] == 1999.0


def test_hashed_tuning_does_not_depend_on_the_partitions(data):
    estimator, found = models.make_regressor("lr"), []
    for n in (1, 4, 7):
        _, table = tuning.tune(estimator, {"regParam": [0.0, 1.0]}, data[0].repartition(n), id_col="trip_id")
        found.append({r["params"]: round(r["rmse"], 9) for r in table.collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 2


def test_stability_of_no_rows_is_unknown(data, fitted):
    assert tuple(stability.stability(fitted["lr"].model, data[1].limit(0), "trip_id").first()) == (0, None, None)


def test_persisted_is_released(spark):
    df = spark.range(10)
    with persisted(df) as held:
        assert held.is_cached
    assert not df.is_cached
    assert tuple(storage_report(df).first())[:2] == (10, True)


def test_layers_are_written_and_read_back(spark, sf, tmp_path):
    from catalog.trips import trips

    paths = []
    for i, cond in enumerate(("trip_id % 2 = 0", "trip_id % 2 = 1")):
        part = trips(spark, sf).filter(cond)
        if i:
            part = part.withColumn("passenger_count", F.col("passenger_count").cast("double"))
        part.write.parquet(str(tmp_path / f"raw{i}"))
        paths.append(str(tmp_path / f"raw{i}"))
    gold, features, silver, silver_rejects, gold_rejects, removals = run_layers(spark, paths, str(tmp_path / "out"), "trip_id")
    expected = featured_trips(spark, sf).count()
    assert gold.count() == expected
    assert set(gold.columns) == {"trip_id", *GOLD_COLS}
    assert [(r.step, r.records_after) for r in removals.collect()] == [("silver", expected), ("gold", expected)]
    assert silver.count() == expected and {"source_file", "data_quality_flag"} <= set(silver.columns)
    files = {r[0].rsplit("/", 2)[1] for r in silver.select("source_file").distinct().collect()}
    assert files == {"raw0", "raw1"}
    assert silver_rejects.count() == trips(spark, sf).count() - expected and gold_rejects.count() == 0
    assert {r[0] for r in silver_rejects.select("data_quality_flag").distinct().collect()} == {"rejected"}
    assert len(features.stages) == 2


def test_every_layer_is_scanned_once(spark, sf, tmp_path, monkeypatch):
    """Each written plan reads one layer, and no layer but the scaler's input is read by two."""
    from catalog.trips import trips
    from farebox.plans import layers

    trips(spark, sf).withColumn("RatecodeID", F.expr("nullif(RatecodeID, 3)")).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plans, write = [], layers.write_layer
    monkeypatch.setattr(layers, "write_layer", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1])
    built = run_layers(spark, [str(tmp_path / "raw")], str(tmp_path / "out"), "trip_id")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [[name for name in ("raw", "out/bronze", "out/silver", "out/gold_inputs") for _ in range(p.count(f"{tmp_path}/{name}]"))] for p in plans]
    assert read == [["raw"], ["out/bronze"], ["out/silver"], ["out/gold_inputs"]]
    assert all("PartitionFilters: [isnull(reject_reason" in p for p in plans[2:])
    assert built.rows.count() + built.gold_rejects.count() == built.silver.count()
    assert {r.reject_reason for r in built.gold_rejects.select("reject_reason").distinct().collect()} == {"null_RatecodeID"}


def test_removals_of_nothing(spark):
    from farebox.operators.quality import removals

    (row,) = removals(spark, {"silver": {"records": 0, "fare": 0}}).collect()
    assert tuple(row) == ("silver", 0, 0, 0, None, {})


def test_filters_and_columns_reach_the_scan(spark, sf, tmp_path):
    from catalog.trips import trips
    from farebox.operators.quality import apply_rules, bounds_rules
    from farebox.operators.reports import segment_report

    trips(spark, sf).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    clean = apply_rules(read_trips(spark, str(tmp_path / "t")), bounds_rules())
    plan = segment_report(clean, "PULocationID", "fare_amount")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for column in ("fare_amount", "trip_distance", "passenger_count", "total_amount", "tip_amount"):
        assert f"ThanOrEqual({column}," in pushed or f"GreaterThan({column}," in pushed
    assert "store_and_fwd_flag" not in plan and "partial_avg" in plan
