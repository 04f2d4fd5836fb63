"""Congestion model on the feature table (Q15: M1-M8, A16, A18, C17-C19, L5)."""

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.bands import congestion_status, precipitation_fraction, traffic_code
from headway.functions.times import is_peak, is_weekend, sine_time, time_grid
from headway.operators.filters import complete_columns

TRAIN_PERCENT = 70
VALIDATION_PERCENT = 10
SEED = 42


def model_table(features: DataFrame) -> DataFrame:
    """Numeric inputs and the label, next to the row key and its ``share``."""
    inputs = {name: F.col(name).cast("int") for name in K.MODEL_FLAGS}
    inputs["traffic_level"] = traffic_code(F.col("traffic_level"))
    return features.withColumns(inputs | {"share": split_share(*map(F.col, K.FEATURE_KEY))})


def split_share(*key: Column) -> Column:
    """0..99 from a hash of the row key. A row stays in its part however the data is spread over
    tasks, and when more rows come in."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def training_rows(table: DataFrame) -> DataFrame:
    return table.filter(F.col("share") < TRAIN_PERCENT)


def test_rows(table: DataFrame) -> DataFrame:
    return table.filter(F.col("share") >= TRAIN_PERCENT)


def train_boosted(
    features: DataFrame, rounds: int = 200, depth: int = 8, rate: float = 0.05
) -> PipelineModel:
    """M2: boosted trees. Rounds stop early on a part of the training rows of its own, so that the
    test rows stay unseen."""
    held_out = F.col("share") >= TRAIN_PERCENT - VALIDATION_PERCENT
    return _fit(
        model_table(features).withColumn("held_out", held_out),
        GBTRegressor(
            maxIter=rounds,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=0.8,
            maxBins=256,
            minInstancesPerNode=1,
            validationIndicatorCol="held_out",
            seed=SEED,
        ),
    )


def train_tree(features: DataFrame, depth: int = 30, bins: int = 256) -> PipelineModel:
    """M3: a single decision tree that grows out: 30 levels are the most MLlib allows."""
    learner = DecisionTreeRegressor(maxDepth=depth, maxBins=bins, minInstancesPerNode=1, seed=SEED)
    return _fit(model_table(features), learner)


def _fit(table: DataFrame, learner) -> PipelineModel:
    """inputs are the columns without a gap in the whole table, test rows included; then the
    training rows are fitted. Every round reads them again, so they are kept for that time.

    A gap in a row that is scored later counts as NaN, which every split sends to the right.
    """
    table = table.persist()
    try:
        complete = complete_columns(table)
        names = [name for name in K.MODEL_INPUTS if name in complete]
        assembler = VectorAssembler(inputCols=names, outputCol="inputs", handleInvalid="keep")
        learner = learner.setFeaturesCol("inputs").setLabelCol(K.MODEL_LABEL)
        return PipelineModel([assembler, learner.fit(assembler.transform(training_rows(table)))])
    finally:
        table.unpersist()


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """M7: rows with a ``prediction``; the model ships with the plan, rows stay where they are."""
    return model.transform(rows).drop("inputs")


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance), greatest first; one row per model input."""
    names, weights = model.stages[0].getInputCols(), model.stages[1].featureImportances.toArray()
    pairs = [(name, float(weight)) for name, weight in zip(names, weights)]
    table = rows.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def split_statistics(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """M4: per model input the number of splits on it (``weight``), their mean and total gain and
    their mean and total number of rows (``cover``). Read off the model's nodes on the driver,
    where the model is anyway."""
    names, learned = model.stages[0].getInputCols(), model.stages[1]
    found = {name: [0, 0.0, 0.0] for name in names}
    trees = getattr(learned, "trees", None)
    roots = [t._call_java("rootNode") for t in trees] if trees else [learned._call_java("rootNode")]
    while roots:
        node = roots.pop()
        if node.subtreeDepth() == 0:
            continue
        total = found[names[node.split().featureIndex()]]
        total[0] += 1
        total[1] += node.gain()
        total[2] += node.impurityStats().count()
        roots += [node.leftChild(), node.rightChild()]
    lines = [
        (name, n, gain / n if n else 0.0, float(cover) / n if n else 0.0, gain, float(cover))
        for name, (n, gain, cover) in found.items()
    ]
    return rows.sparkSession.createDataFrame(
        lines,
        "feature string, weight long, gain double, cover double, total_gain double, "
        "total_cover double",
    )


def rmse(rows: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, optionally per key."""
    error = F.col(label) - F.col(prediction)
    return rows.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def forecast_grid(
    route_flags: DataFrame,
    start: Column,
    window_minutes: int,
    interval_minutes: int,
    temperature: float,
    precipitation_percent: float,
    weather_code: int,
    traffic_level: int,
    event: bool,
    precipitation_unit: str = "fraction",
) -> DataFrame:
    """M8, C17: model inputs for every route and moment of the window.

    ``route_flags`` has the school and hospital flag of each route. The model learns precipitation
    in percent, while forecasts have always been asked for with a fraction: ``precipitation_unit``
    ("fraction" or "percent") says which one to send.
    """
    precipitation = F.lit(float(precipitation_percent))
    if precipitation_unit == "fraction":
        precipitation = precipitation_fraction(precipitation)
    ts = F.col("timestamp")
    return (
        route_flags.withColumn(
            "timestamp", F.explode(time_grid(start, window_minutes, interval_minutes))
        )
        .withColumns(
            {
                "peak_hour": is_peak(ts, "forecast").cast("int"),
                "sine_time": sine_time(ts),
                "temperature": F.lit(float(temperature)),
                "precipitation_probability": precipitation,
                "weather_code": F.lit(weather_code),
                "traffic_level": F.lit(traffic_level),
                "event_dummy": F.lit(int(event)),
                "school": F.col("school").cast("int"),
                "hospital": F.col("hospital").cast("int"),
                "weekend": is_weekend(ts).cast("int"),
            }
        )
        .select("route_short_name", "timestamp", *K.MODEL_INPUTS)
    )


def forecast_status(predictions: DataFrame) -> DataFrame:
    """Mean prediction and status per route."""
    return (
        predictions.groupBy("route_short_name")
        .agg(F.avg("prediction").alias("mean_prediction"))
        .withColumn("status", congestion_status(F.col("mean_prediction")))
    )
