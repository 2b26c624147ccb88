"""Feature vectors, fits, tuning and scaling experiments."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import FEATURED_SQL, TIMED_SQL, TRIPS_SQL, featured_trips, mean_sql, trips, uniform_sql
from farebox.functions.hashing import drawn
from farebox.ml import experiments, models, prep, stability, tuning
from farebox.operators import evaluate, scaling
from farebox.operators.columns import slot_names
from farebox.operators.labels import fit_labels, index_labels
from farebox.operators.quality import complete_rules, quarantine
from farebox.operators.sampling import hash_split, with_split
from farebox.plans.layers import run_layers
from farebox.schema import FEATURES_13
from farebox.sources.model_store import load_first_model, load_model, save_model
from farebox.sources.scratch import scratch_path


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The featured trips as a written table, which is what fits read again and again."""
    path = scratch_path(spark, "featured")
    rows = featured_trips(spark, sf_dir).select("trip_id", "label", *FEATURES_13)
    scaling.spread(rows, _cores(spark), "trip_id").write.parquet(path)
    return spark.read.parquet(path)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test trips with ``features`` scaled on the training side."""
    train, test = hash_split(_featured(spark, sf_dir), "trip_id", method="md5")
    fitted = prep.feature_pipeline().fit(train)
    return fitted.transform(train), fitted.transform(test)


def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and standard deviation of the 13 inputs, fitted on the training side."""
    train, _ = hash_split(_featured(spark, sf_dir), "trip_id", method="md5")
    fitted = prep.feature_pipeline().fit(train)
    table = prep.scaler_statistics(fitted, train, FEATURES_13)
    return table.select("slot", "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


SCALER_SQL = (
    f"WITH {FEATURED_SQL}, train AS (SELECT * FROM featured WHERE {uniform_sql('trip_id')} < 0.8e0) "
    + " UNION ALL ".join(
        f"SELECT {i} AS slot, '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM train"
        for i, c in enumerate(FEATURES_13)
    )
)


def assembled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unscaled vector slots of every trip that has all inputs."""
    numeric = ("trip_distance", "passenger_count", "RatecodeID", "PULocationID")
    raw, _ = quarantine(trips(spark, sf_dir), complete_rules(numeric))
    fitted = prep.feature_pipeline(numeric=numeric, scale=False).fit(raw)
    slots = vector_to_array("features")
    return fitted.transform(raw).select("trip_id", *[slots[i].alias(f"slot_{i}") for i in range(len(numeric))])


ASSEMBLED_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, trip_distance AS slot_0, CAST(passenger_count AS DOUBLE) AS slot_1,
  CAST(RatecodeID AS DOUBLE) AS slot_2, CAST(PULocationID AS DOUBLE) AS slot_3
FROM trips WHERE passenger_count IS NOT NULL"""


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of every payment type fitted on purchases and views only, with its row count."""
    rows = trips(spark, sf_dir).withColumn("payment", F.concat(F.lit("p"), F.col("payment_type").cast("string")))
    seen = rows.filter(F.col("payment_type") <= 3)
    indexed = prep.index_categories(seen, rows, ["payment"])
    return indexed.groupBy("payment", "payment_index").agg(F.count(F.lit(1)).alias("rows"))


INDEX_SQL = f"""WITH {TRIPS_SQL}, c AS (SELECT 'p' || CAST(payment_type AS VARCHAR) AS payment, count(*) AS n
  FROM trips WHERE payment_type <= 3 GROUP BY 1),
r AS (SELECT payment, row_number() OVER (ORDER BY n DESC, payment) - 1 AS i FROM c)
SELECT 'p' || CAST(payment_type AS VARCHAR) AS payment, CAST(coalesce(any_value(i), 3) AS DOUBLE) AS payment_index,
  count(*) AS rows FROM trips LEFT JOIN r ON r.payment = 'p' || CAST(payment_type AS VARCHAR) GROUP BY payment_type"""


def string_index_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of every line item's order, the order with most items first: as many labels as orders.

    The label table is joined by shuffle, as a large one would be.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    labels = fit_labels(items, ["l_orderkey"])["l_orderkey"]
    return index_labels(items, labels, "order_index", broadcast_bytes=0, salt_cols=["l_linenumber"])


ORDER_INDEX_SQL = """WITH r AS (SELECT l_orderkey, row_number() OVER (ORDER BY n DESC, l_orderkey) - 1 AS i
  FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1))
SELECT l_orderkey, l_linenumber, CAST(i AS DOUBLE) AS order_index FROM lineitem JOIN r USING (l_orderkey)"""


def one_hot_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse vectors of all line items: scaled quantity, a slot per order and one per part, learnt from the
    items of the first year; later ones hold orders and parts not seen."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    train = items.filter(F.year("l_shipdate") < 1996)
    fitted = prep.fit_category_features(train, ["l_orderkey", "l_partkey"], ["l_quantity"])
    vector = F.unwrap_udt("features")
    return fitted.transform(items, broadcast_bytes=0, salt_cols=["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", vector["size"].alias("size"), F.round(vector["values"][0], 6).alias("quantity"),
        vector["indices"][1].alias("order_slot"), vector["indices"][2].alias("part_slot"),
        F.array_join(F.slice(vector["values"], 2, 2).cast("array<string>"), ",").alias("ones"),
    )


def _ranked_sql(col: str) -> str:
    return f"""SELECT {col}, row_number() OVER (ORDER BY n DESC, {col}) - 1 AS i FROM
  (SELECT {col}, count(*) AS n FROM train WHERE {col} IS NOT NULL GROUP BY 1)"""


ONE_HOT_PARTS_SQL = f"""WITH train AS (SELECT * FROM lineitem WHERE year(l_shipdate) < 1996),
o AS ({_ranked_sql('l_orderkey')}), p AS ({_ranked_sql('l_partkey')}),
n AS (SELECT (SELECT count(*) FROM o) AS no, (SELECT count(*) FROM p) AS np, avg(l_quantity) AS m, stddev_samp(l_quantity) AS d FROM train)
SELECT l_orderkey, l_linenumber, CAST(1 + no + 1 + np + 1 AS INT) AS size, round((l_quantity - m) / d, 6) AS quantity,
  CAST(1 + coalesce(o.i, no) AS INT) AS order_slot, CAST(no + 2 + coalesce(p.i, np) AS INT) AS part_slot, '1.0,1.0' AS ones
FROM lineitem LEFT JOIN o USING (l_orderkey) LEFT JOIN p USING (l_partkey), n"""


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows set each encoded slot of the payment type, by slot name."""
    rows = trips(spark, sf_dir).withColumn("payment", F.concat(F.lit("p"), F.col("payment_type").cast("string")))
    fitted = prep.fit_features(rows, ("payment",), ("trip_distance",), scale=False)
    encoded = fitted.transform(rows)
    names = slot_names(encoded, "features")
    slots = vector_to_array("features")
    sums = encoded.agg(*[F.count_if(slots[i] != 0).alias(f"_s{i}") for i in range(len(names))])
    return sums.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("slot"), F.col(f"_s{i}").alias("rows")) for i, n in enumerate(names)]))
    )


ONE_HOT_SQL = f"""WITH {TRIPS_SQL} SELECT 'trip_distance' AS slot, count(*) FILTER (WHERE trip_distance <> 0) AS rows FROM trips
UNION ALL SELECT 'payment_encoded_p' || CAST(payment_type AS VARCHAR), count(*) FROM trips GROUP BY payment_type
UNION ALL SELECT 'payment_encoded___unknown', count(*) FILTER (WHERE payment_type IS NULL) FROM trips"""


def _one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = featured_trips(spark, sf_dir).select("trip_distance", "label")
    return VectorAssembler(inputCols=["trip_distance"], outputCol="features").transform(rows)


def linear_fit_1f(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare on distance by the linear regressor."""
    model = models.fit("lr", _one_feature(spark, sf_dir)).model
    return _line(spark, model.coefficients[0], model.intercept, model.summary.r2)


def glm_gaussian_1f(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same line by the generalised linear regressor."""
    rows = _one_feature(spark, sf_dir)
    model = models.fit("glr", rows).model
    r2 = models.evaluate_model(model, rows).first()["r2"]
    return _line(spark, model.coefficients[0], model.intercept, r2)


def _line(spark: SparkSession, slope: float, intercept: float, r2: float) -> DataFrame:
    values = [(round(float(slope), 6), round(float(intercept), 6), round(float(r2), 6))]
    return spark.createDataFrame(values, "slope double, intercept double, r2 double")


LINE_SQL = f"""WITH {FEATURED_SQL} SELECT round(regr_slope(label, trip_distance), 6) AS slope,
  round(regr_intercept(label, trip_distance), 6) AS intercept, round(regr_r2(label, trip_distance), 6) AS r2
FROM featured"""


TRAIN_SQL = f"{FEATURED_SQL}, train AS (SELECT * FROM featured WHERE {uniform_sql('trip_id')} < 0.8e0), "
TRAIN_SQL += f"test AS (SELECT * FROM featured WHERE {uniform_sql('trip_id')} >= 0.8e0)"


def _fitted(train: DataFrame, kind: str, **params: object):
    with scaling.persisted(train.select("features", "label")) as rows:
        return models.fit(kind, rows, **params).model


def _normal_equations(kind: str, **params: object):
    """Without regularisation, training residuals add up to 0 and are orthogonal to every input."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, _ = _split(spark, sf_dir)
        error = F.col("label") - F.col("prediction")
        scored = _fitted(train, kind, **params).transform(train).withColumn("x", vector_to_array("features"))
        sums = scored.agg(
            F.count(F.lit(1)).alias("records"), F.avg(error).alias("s0"),
            *[F.avg(error * F.col("x")[i]).alias(f"s{i + 1}") for i in range(len(FEATURES_13))],
        )
        rows = [F.struct(F.lit(name).alias("input"), "records", (F.abs(F.col(f"s{i}")) < 1e-3).alias("orthogonal"))
                for i, name in enumerate(("intercept", *FEATURES_13))]
        return sums.select(F.inline(F.array(*rows)))

    return query


NORMAL_SQL = f"WITH {TRAIN_SQL} SELECT unnest([{', '.join(repr(c) for c in ('intercept', *FEATURES_13))}]) AS input, " \
    "n AS records, true AS orthogonal FROM (SELECT count(*) AS n FROM train)"


def linear_fits_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both linear regressors without regularisation: test rows, and whether they predict alike."""
    train, test = _split(spark, sf_dir)
    both = models.score({k: _fitted(train, k) for k in ("lr", "glr")}, test)
    gap = F.abs(F.col("prediction_lr") - F.col("prediction_glr"))
    return both.agg(F.count(F.lit(1)).alias("records"), (F.max(gap) < 1e-3).alias("agree"))


AGREE_SQL = f"WITH {TRAIN_SQL} SELECT count(*) AS records, true AS agree FROM test"


def fit_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction of a tree is the average label of the training rows that get it."""
    train, _ = _split(spark, sf_dir)
    scored = _fitted(train, "dt", **models.LIGHT["dt"]).transform(train)
    leaves = scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"))
    return leaves.agg(
        F.sum("n").alias("records"), F.count_if(F.abs(F.col("mean") - F.col("prediction")) > 1e-6).alias("leaves_off")
    )


TREE_SQL = f"WITH {TRAIN_SQL} SELECT count(*) AS records, 0::BIGINT AS leaves_off FROM train"


def _beats_the_mean(fitted: dict, train: DataFrame, test: DataFrame, within: bool = False) -> DataFrame:
    """Per model: test rows, whether its rmse is below that of the training mean, and, for averages of
    labels, whether all predictions lie between the smallest and the largest of them."""
    seen = train.agg(F.avg("label").alias("mean"), F.min("label").alias("low"), F.max("label").alias("high")).first()
    scored = models.score(fitted, test).withColumn("prediction_mean", F.lit(seen["mean"]))

    def mse(name: str):
        error = F.col("label") - F.col(f"prediction_{name}")
        return F.avg(error * error)

    def row(name: str):
        fields = [F.lit(name).alias("model_name"), F.col("records"), (F.col(f"m_{name}") < F.col("m_mean")).alias("beats_mean")]
        return F.struct(*fields, *([F.col(f"w_{name}").alias("within")] if within else []))

    sums = scored.agg(
        F.count(F.lit(1)).alias("records"), mse("mean").alias("m_mean"), *[mse(n).alias(f"m_{n}") for n in fitted],
        *[F.bool_and(F.col(f"prediction_{n}").between(seen["low"] - 1e-9, seen["high"] + 1e-9)).alias(f"w_{n}") for n in fitted],
    )
    return sums.select(F.inline(F.array(*map(row, fitted))))


def _beats_sql(names, extra: str = "") -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"WITH {TRAIN_SQL} SELECT unnest([{listed}]) AS model_name, n AS records, true AS beats_mean{extra} " \
        "FROM (SELECT count(*) AS n FROM test)"


def _fit_beats(kind: str, within: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = _split(spark, sf_dir)
        return _beats_the_mean({kind: _fitted(train, kind, **models.LIGHT[kind])}, train, test, within)

    return query


def fit_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five regressors with their light settings, measured on the test rows in one pass."""
    train, test = _split(spark, sf_dir)
    with scaling.persisted(train.select("features", "label")) as rows:
        fitted = {kind: models.fit(kind, rows, **params).model for kind, params in models.LIGHT.items()}
    return _beats_the_mean(fitted, train, test)


def sample_vs_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest fitted on a twentieth of the rows and on all: the rows of each, whether their errors are in
    order, and whether that of all rows beats the mean of the test labels."""
    train, test = _split(spark, sf_dir)
    table = models.sample_vs_full(train, test, "trip_id", 0.05, method="md5", **models.LIGHT["rf"])
    spread = test.agg(F.var_pop("label")).first()[0]
    r2 = F.abs(1 - F.col("mse") / spread - F.col("r2")) < 1e-9
    sound = r2 & (F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) < 1e-6) & (F.col("mae") <= F.col("rmse"))
    beats = (F.col("r2") > 0) | (F.col("model_name") == "sample")  # a twentieth of a small table may teach nothing
    return table.select("model_name", "trained_rows", sound.alias("sound"), beats.alias("full_beats_mean"))


SAMPLED_SQL = f"""WITH {TRAIN_SQL} SELECT 'sample' AS model_name, count(*) AS trained_rows, true AS sound, true AS full_beats_mean
FROM train WHERE {uniform_sql('trip_id', 'sample')} < 0.05e0
UNION ALL SELECT 'full', count(*), true, true FROM train"""


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 named inputs of a forest: none negative, together 1."""
    train, _ = _split(spark, sf_dir)
    model = _fitted(train, "rf", **models.LIGHT["rf"])
    table = models.importances(train, model, slot_names(train, "features_raw"))
    total = table.agg(F.round(F.sum("importance"), 9).alias("total")).scalar()
    # an input that does not vary can part no rows, so no tree uses it
    varies = {c: v > 0 for c, v in train.agg(*[F.var_pop(c).alias(c) for c in FEATURES_13]).first().asDict().items()}
    used = F.create_map(*[F.lit(x) for c, v in varies.items() for x in (c, v)])[F.col("feature")]
    sound = (F.col("importance") >= 0) & (used | (F.col("importance") == 0))
    return table.select("feature", used.alias("varies"), sound.alias("sound"), total.alias("total"))


IMPORTANCE_SQL = f"WITH {TRAIN_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c}) < max({c}) AS varies, true AS sound, 1e0 AS total FROM train" for c in FEATURES_13
)


def stability_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest's predictions under noise of 0.01 on all test rows: rows, and a change within the labels' range."""
    train, test = _split(spark, sf_dir)
    moved = stability.stability(_fitted(train, "rf", **models.LIGHT["rf"]), test, "trip_id")
    sound = (F.col("mean_change") >= 0) & (F.col("verdict") == F.when(F.col("mean_change") < 0.1, "STABLE").otherwise("UNSTABLE"))
    return moved.select("records", sound.alias("sound"))


STABILITY_SQL = f"WITH {TRAIN_SQL} SELECT count(*) AS records, true AS sound FROM test"


def linear_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear regressor's change is that of its coefficients times the noise, row by row."""
    train, test = _split(spark, sf_dir)
    model = _fitted(train, "lr", **models.LIGHT["lr"])
    noisy = stability.perturb(test, "trip_id")
    before, after = vector_to_array("features"), vector_to_array("features_perturbed")
    change = sum(((after[i] - before[i]) * float(c) for i, c in enumerate(model.coefficients)), F.lit(0.0))
    expected = noisy.agg(F.avg(F.abs(change)).alias("expected")).scalar()
    moved = stability.stability(model, test, "trip_id")
    return moved.select("records", (F.abs(F.col("mean_change") - expected) < 1e-9).alias("sound"))


def _tuned(kind: str, grid: dict, **how: object):
    """The table of a search: its combinations, each measured, with the best model's among the best."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, _ = _split(spark, sf_dir)
        best, table = tuning.tune(models.make_regressor(kind), grid, train, id_col="trip_id", **how)
        chosen = ", ".join(f"{name}={best.getOrDefault(name)}" for name in sorted(grid))
        lead = table.agg((F.min("rmse") == F.min(F.when(F.col("params") == chosen, F.col("rmse")))).alias("lead")).scalar()
        return table.select("params", ((F.col("rmse") > 0) & lead).alias("sound"))

    return query


def _tuned_sql(grid: dict) -> str:
    names = sorted(grid)
    combos = [", ".join(f"{n}={v}" for n, v in zip(names, values)) for values in product(*(grid[n] for n in names))]
    return " UNION ALL ".join(f"SELECT '{c}' AS params, true AS sound" for c in combos)


def tuning_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a train/validation search fits and validates on: a draw by id, not by partition."""
    train, _ = _split(spark, sf_dir)
    fits = drawn("trip_id", 0.8, 42, "md5", "validation")
    return train.agg(F.count_if(fits).alias("fitted"), F.count_if(~fits).alias("validated"))


TUNING_SPLIT_SQL = f"""WITH {TRAIN_SQL} SELECT count(*) FILTER (WHERE {uniform_sql('trip_id', 'validation')} < 0.8e0) AS fitted,
  count(*) FILTER (WHERE {uniform_sql('trip_id', 'validation')} >= 0.8e0) AS validated FROM train"""


def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest on growing samples: rows of each, and that it was measured."""
    train, test = _split(spark, sf_dir)
    curve = experiments.learning_curve(train, test, "trip_id", method="md5", **models.LIGHT["rf"])
    return curve.select("fraction", "records", (F.col("rmse") > 0).alias("measured"))


CURVE_SQL = f"WITH {TRAIN_SQL} " + " UNION ALL ".join(
    f"SELECT {f}e0 AS fraction, count(*) AS records, true AS measured FROM train WHERE {uniform_sql('trip_id', 'sample')} < {f}e0"
    for f in experiments.FRACTIONS
)


def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items hashed by their two flags: six values at most, so most of twelve partitions are empty."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    profile = scaling.partition_profile(items.repartition(12, "l_returnflag", "l_linestatus"))
    return profile.select("partitions", "records", "avg_size", "min_size")


PROFILE_SQL = "SELECT 12::BIGINT AS partitions, count(*) AS records, count(*) / 12e0 AS avg_size, 0::BIGINT AS min_size FROM lineitem"


_swept: dict[tuple[str, str], list[tuple]] = {}


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep of all partition counts: three rows, measured once for both queries on it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _swept:
        df = _featured(spark, sf_dir)
        ready = prep.feature_pipeline().fit(df).transform(df)
        swept = experiments.partition_sweep(ready, "trip_id", method="md5", **models.LIGHT["rf"])
        _swept[key] = [tuple(r) for r in swept.collect()]
    return spark.createDataFrame(_swept[key], "partitions int, records bigint, training_time double")


def partition_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows trained on per partition count; the times are left to the bench."""
    return _sweep(spark, sf_dir).select("partitions", "records", (F.col("training_time") > 0).alias("timed"))


def scaling_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best partition count of the sweep and how fits grow: that it is the fastest one tried, its gain, and
    the rows of the curve behind the growth."""
    sweep = _sweep(spark, sf_dir)
    train, test = _split(spark, sf_dir)
    curve = experiments.learning_curve(train, test, "trip_id", kind="dt", method="md5", timed=True, **models.LIGHT["dt"])
    curve = spark.createDataFrame(curve.collect(), curve.schema)  # measured once
    times = {r["partitions"]: r["training_time"] for r in sweep.collect()}
    gain = (max(times.values()) - min(times.values())) / max(times.values()) * 100
    fastest = F.create_map(*[F.lit(x) for n, t in times.items() for x in (n, t == min(times.values()))])
    return experiments.scaling_outcome(sweep, curve).select(
        F.lit(len(times)).alias("tried"), fastest[F.col("best_partitions")].alias("fastest"),
        (F.abs(F.col("gain_pct") - gain) < 1e-9).alias("gain_agrees"), F.col("time_per_records_r2").between(0, 1).alias("r2_in_range"),
        (F.col("throughput") > 0).alias("scored"), curve.agg(F.sum("records")).scalar().alias("curve_rows"),
    )


OUTCOME_SQL = f"WITH {TRAIN_SQL} SELECT 3 AS tried, true AS fastest, true AS gain_agrees, true AS r2_in_range, true AS scored, " + " + ".join(
    f"count(*) FILTER (WHERE {uniform_sql('trip_id', 'sample')} < {f}e0)" for f in experiments.FRACTIONS
) + " AS curve_rows FROM train"


SWEEP_SQL = f"""WITH {FEATURED_SQL}
SELECT CAST(unnest([50, 100, 200]) AS INT) AS partitions, n AS records, true AS timed
FROM (SELECT count(*) AS n FROM featured WHERE {uniform_sql('trip_id')} < 0.8e0)"""


def storage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.storage_report(featured_trips(spark, sf_dir).select("trip_id", "label", "trip_distance"))


STORAGE_SQL = f"""WITH {FEATURED_SQL} SELECT count(*) AS records, true AS is_cached, true AS use_memory,
  true AS use_disk, 1 AS replication FROM featured"""


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest difference between predictions before saving and after loading, for all five kinds."""
    train, test = _split(spark, sf_dir)
    scored = {}
    with scaling.persisted(train.select("features", "label")) as rows:
        for kind, params in models.LIGHT.items():
            model, path = models.fit(kind, rows, **params).model, scratch_path(spark, "model")
            save_model(model, path)
            scored |= {f"{kind}_kept": model, f"{kind}_loaded": load_model(path, kind),
                       f"{kind}_fallback": load_first_model([path + "-tuned", path], kind)}
    both = models.score(scored, test)

    def gap(kind: str, other: str):
        return F.max(F.abs(F.col(f"prediction_{kind}_kept") - F.col(f"prediction_{kind}_{other}"))).alias(f"{kind}_{other}")

    sums = both.agg(F.count(F.lit(1)).alias("records"), *[gap(k, o) for k in models.LIGHT for o in ("loaded", "fallback")])
    rows_out = [F.struct(F.lit(k).alias("kind"), "records", F.col(f"{k}_loaded").alias("loaded_diff"),
                         F.col(f"{k}_fallback").alias("fallback_diff")) for k in models.LIGHT]
    return sums.select(F.inline(F.array(*rows_out)))


ROUNDTRIP_SQL = f"""WITH {TRAIN_SQL} SELECT unnest([{', '.join(f"'{k}'" for k in models.LIGHT)}]) AS kind, n AS records,
  0e0 AS loaded_diff, 0e0 AS fallback_diff FROM (SELECT count(*) AS n FROM test)"""


def layers_of(spark: SparkSession, raw: DataFrame, root: str | None = None):
    """All layers of raw trips, written below ``root``."""
    root = root or scratch_path(spark, "layers")
    raw.write.parquet(f"{root}/raw")
    return run_layers(spark, [f"{root}/raw"], root, "trip_id", method="md5")


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files through written bronze, silver and gold layers: the stored gold rows, every scaled slot."""
    built = layers_of(spark, trips(spark, sf_dir))
    slots = vector_to_array("features")
    return built.rows.select(
        "trip_id", "label", "pickup_hour", "is_rush_hour", "data_year", "data_month",
        *[F.round(slots[i], 4).alias(f"slot_{i}") for i in range(len(FEATURES_13))],
    )


_MOMENTS = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(FEATURES_13))
_SLOTS = ", ".join(
    f"CASE WHEN s{i} > 0 THEN round(({c} - m{i}) / s{i}, 4) ELSE 0e0 END AS slot_{i}" for i, c in enumerate(FEATURES_13)
)
LAYERS_SQL = f"""WITH {TRAIN_SQL}, moments AS (SELECT {_MOMENTS} FROM train)
SELECT trip_id, label, pickup_hour, is_rush_hour, pickup_year AS data_year, pickup_month AS data_month, {_SLOTS}
FROM featured, moments"""

_NULL_RATES = "CASE WHEN trip_id % 10 = 3 THEN NULL ELSE RatecodeID END"


def layers_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every written layer and reject reason, of trips a tenth of which have no rate code."""
    root = scratch_path(spark, "layers")
    built = layers_of(spark, trips(spark, sf_dir).withColumn("RatecodeID", F.expr(_NULL_RATES)), root)

    def counted(rows: DataFrame, layer: str) -> DataFrame:
        reason = F.col("reject_reason") if "reject_reason" in rows.columns else F.lit(None).cast("string")
        return rows.groupBy(F.lit(layer).alias("layer"), reason.alias("reject_reason")).agg(F.count(F.lit(1)).alias("rows"))

    bronze = spark.read.parquet(f"{root}/bronze")
    tables = {"bronze": bronze, "silver": built.silver, "silver_rejects": built.silver_rejects, "gold": built.rows,
              "gold_rejects": built.gold_rejects}
    return reduce(DataFrame.unionByName, [counted(rows, layer) for layer, rows in tables.items()])


RECONCILED_SQL = f"""WITH {TIMED_SQL}, judged AS (
  SELECT {_NULL_RATES} IS NULL AS no_rate, CASE
    WHEN NOT coalesce(fare_amount > 0 AND fare_amount <= 500, false) THEN 'fare'
    WHEN NOT coalesce(trip_distance > 0 AND trip_distance <= 100, false) THEN 'distance'
    WHEN NOT coalesce(total_amount > 0, false) THEN 'total'
    WHEN NOT coalesce(trip_duration_minutes BETWEEN 1 AND 180, false) THEN 'duration'
    WHEN NOT (passenger_count IS NULL OR (passenger_count > 0 AND passenger_count <= 6)) THEN 'passengers' END AS reason
  FROM timed)
SELECT 'bronze' AS layer, NULL AS reject_reason, count(*) AS rows FROM judged
UNION ALL SELECT 'silver', NULL, count(*) FROM judged WHERE reason IS NULL
UNION ALL SELECT 'silver_rejects', reason, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'gold', NULL, count(*) FROM judged WHERE reason IS NULL AND NOT no_rate
UNION ALL SELECT 'gold_rejects', 'null_RatecodeID', count(*) FROM judged WHERE reason IS NULL AND no_rate HAVING count(*) > 0"""


def layers_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removal report of both cleaning steps of the same trips, from counts taken while they were written."""
    built = layers_of(spark, trips(spark, sf_dir).withColumn("RatecodeID", F.expr(_NULL_RATES)))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("reasons"), lambda e: F.concat(e.key, F.lit("="), e.value))), ",")
    return built.removals.select("step", "records_before", "records_after", "records_removed", "removal_pct", listed.alias("reasons"))


REMOVALS_SQL = f"""WITH j AS ({RECONCILED_SQL}), s AS (
  SELECT 'silver' AS step, sum(rows) FILTER (layer = 'bronze') AS b, sum(rows) FILTER (layer = 'silver') AS a,
    string_agg(reject_reason || '=' || rows, ',' ORDER BY reject_reason) FILTER (layer = 'silver_rejects') AS r FROM j
  UNION ALL SELECT 'gold', sum(rows) FILTER (layer = 'silver'), sum(rows) FILTER (layer = 'gold'),
    string_agg(reject_reason || '=' || rows, ',' ORDER BY reject_reason) FILTER (layer = 'gold_rejects') FROM j
)
SELECT step, b::BIGINT AS records_before, a::BIGINT AS records_after, (b - a)::BIGINT AS records_removed,
  (b - a)::DOUBLE / b::DOUBLE * 100e0 AS removal_pct, coalesce(r, '') AS reasons FROM s"""


def forest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested evaluation report of a forest: test rows and their average label, metrics that agree with
    the predictions summed apart, and its ten most important inputs in order."""
    train, test = _split(spark, sf_dir)
    model = _fitted(train, "rf", **models.LIGHT["rf"])
    ranked = models.importances(train, model, slot_names(train, "features_raw"))
    scored = model.transform(test)
    report = evaluate.evaluation_report(scored, "forest", importances=ranked)
    error = F.col("label") - F.col("prediction")
    own = scored.agg(
        F.count(F.lit(1)).alias("records"), F.round(F.avg("label"), 6).alias("avg_label"), F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"), F.var_pop("label").alias("spread"),
    ).first()
    metrics, top = F.col("metrics"), F.col("top_features")
    falling = F.forall(F.sequence(F.lit(0), F.size(top) - 2), lambda i: top[i]["importance"] >= top[i + 1]["importance"])
    wanted = {"mse": own.mse, "rmse": own.mse**0.5, "mae": own.mae, "r2": 1 - own.mse / own.spread}
    agree = reduce(lambda a, b: a & b, [F.abs(metrics[k] - v) < 1e-6 for k, v in wanted.items()])
    return report.select(
        "model_name", F.lit(own.records).cast("long").alias("records"), F.lit(own.avg_label).alias("avg_label"), agree.alias("agree"),
        (metrics["r2"] > 0).alias("beats_mean"), F.size(top).alias("top"), falling.alias("falling"),
    )


FOREST_REPORT_SQL = f"""WITH {TRAIN_SQL} SELECT 'forest' AS model_name, count(*) AS records, round(avg(label), 6) AS avg_label,
  true AS agree, true AS beats_mean, CAST(10 AS INT) AS top, true AS falling FROM test"""


def score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scored, with the split it belongs to: counts, average labels and errors in order."""
    labelled = with_split(_featured(spark, sf_dir), "trip_id", method="md5")
    train = labelled.filter(F.col("split") == "train")
    features = prep.feature_pipeline().fit(train)
    model = models.fit("lr", features.transform(train)).model
    table = evaluate.error_by_segment(model.transform(features.transform(labelled)), "split", per_unit=1_000_000)
    return table.select("split", "count", "avg_actual", (F.col("mae") <= F.col("rmse")).alias("in_order"))


SCORE_ALL_SQL = f"""WITH {TRAIN_SQL}, every AS (SELECT 'train' AS split, label FROM train UNION ALL SELECT 'test', label FROM test)
SELECT split, count(*) AS count, {mean_sql('label', 1_000_000)} AS avg_actual, true AS in_order FROM every GROUP BY split"""


QUERIES = {
    "scaler_stats": (scaler_stats, SCALER_SQL),
    "assembled_vectors": (assembled_vectors, ASSEMBLED_SQL),
    "string_index": (string_index, INDEX_SQL),
    "one_hot": (one_hot, ONE_HOT_SQL),
    "string_index_orders": (string_index_orders, ORDER_INDEX_SQL),
    "one_hot_parts": (one_hot_parts, ONE_HOT_PARTS_SQL),
    "linear_fit_1f": (linear_fit_1f, LINE_SQL),
    "glm_gaussian_1f": (glm_gaussian_1f, LINE_SQL),
    "fit_linear": (_normal_equations("lr"), NORMAL_SQL),
    "fit_glm": (_normal_equations("glr"), NORMAL_SQL),
    "linear_fits_agree": (linear_fits_agree, AGREE_SQL),
    "fit_tree": (fit_tree, TREE_SQL),
    "fit_forest": (_fit_beats("rf", within=True), _beats_sql(["rf"], ", true AS within")),
    "fit_gbt": (_fit_beats("gbt"), _beats_sql(["gbt"])),
    "fit_five": (fit_five, _beats_sql(models.LIGHT)),
    "score_all": (score_all, SCORE_ALL_SQL),
    "sample_vs_full": (sample_vs_full, SAMPLED_SQL),
    "feature_importance": (feature_importance, IMPORTANCE_SQL),
    "stability_test": (stability_test, STABILITY_SQL),
    "linear_stability": (linear_stability, STABILITY_SQL),
    "tune_split": (_tuned("rf", tuning.SMALL_GRIDS["rf"]), _tuned_sql(tuning.SMALL_GRIDS["rf"])),
    "tune_split_gbt": (_tuned("gbt", tuning.SMALL_GRIDS["gbt"]), _tuned_sql(tuning.SMALL_GRIDS["gbt"])),
    "tune_cv": (_tuned("lr", tuning.DEFAULT_GRIDS["lr"], method="cv"), _tuned_sql(tuning.DEFAULT_GRIDS["lr"])),
    "tuning_split": (tuning_split, TUNING_SPLIT_SQL),
    "learning_curve": (learning_curve, CURVE_SQL),
    "partition_profile": (partition_profile, PROFILE_SQL),
    "partition_sweep": (partition_sweep, SWEEP_SQL),
    "scaling_outcome": (scaling_outcome, OUTCOME_SQL),
    "storage_report": (storage_report, STORAGE_SQL),
    "model_roundtrip": (model_roundtrip, ROUNDTRIP_SQL),
    "layers_end_to_end": (layers_end_to_end, LAYERS_SQL),
    "layers_reconciled": (layers_reconciled, RECONCILED_SQL),
    "layers_removals": (layers_removals, REMOVALS_SQL),
    "forest_report": (forest_report, FOREST_REPORT_SQL),
}
