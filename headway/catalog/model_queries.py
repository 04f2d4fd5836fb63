"""Model queries."""

from pyspark.sql import functions as F

from headway.catalog.registry import query
from headway.catalog.views import Views
from headway.functions import texts
from headway.operators.champion import mark_champions
from headway.operators.filters import complete_columns
from headway.plans import dashboards, model

@query(
    """SELECT name, model_key, accuracy, timestamp,
  accuracy < coalesce(min(accuracy) OVER (PARTITION BY name ORDER BY timestamp, model_key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'Infinity'::DOUBLE) AS promoted
FROM model_runs""",
    "model_runs",
)
def w7_champion_runs(v: Views):
    order = ["timestamp", "model_key"]
    day = F.to_date("timestamp")
    return mark_champions(v.model_runs, "name", "accuracy", order, day, F.col("model_key"))


@query(
    """SELECT name, model_key, accuracy FROM (SELECT *, min(accuracy) OVER (PARTITION BY name
    ORDER BY timestamp, model_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM model_runs)
WHERE timestamp >= TIMESTAMP '1995-01-01' AND accuracy < coalesce(before, 'Infinity'::DOUBLE)""",
    "model_runs",
)
def x7_next_champions(v: Views):
    """What the champion stream does: runs of a batch against the best score before it."""
    early = F.col("timestamp") < F.lit("1995-01-01").cast("timestamp_ntz")
    best = v.model_runs.filter(early).groupBy("name").agg(F.min("accuracy").alias("accuracy"))
    champion = best.select(
        "name",
        F.lit(None).cast("long").alias("model_key"),
        "accuracy",
        F.lit("1994-12-31").cast("timestamp_ntz").alias("timestamp"),
    )
    field = champion.unionByName(v.model_runs.filter(~early))
    decided = mark_champions(
        field, "name", "accuracy", ["timestamp", "model_key"], F.to_date("timestamp")
    )
    promoted = decided.filter("promoted and model_key is not null")
    return promoted.select("name", "model_key", "accuracy")


@query(
    """SELECT trip_id_x, timestamp_x,
  (('0x' || md5(trip_id_x || '|' || strftime(timestamp_x, '%Y-%m-%d %H:%M:%S'))[1:8])::BIGINT % 100)
  ::INTEGER AS share FROM feature_table""",
    "feature_table",
)
def m1_split_shares(v: Views):
    return model.model_table(v.feature_table).select("trip_id_x", "timestamp_x", "share")


@query(
    """SELECT traffic_level, round(sqrt(avg((congestion_rate - sine_time) ** 2)), 6) AS rmse
FROM feature_table GROUP BY traffic_level""",
    "feature_table",
)
def a18_rmse(v: Views):
    errors = model.rmse(v.feature_table, "congestion_rate", "sine_time", ["traffic_level"])
    return errors.withColumn("rmse", F.round("rmse", 6))


def _grid(v: Views):
    """Two hours in steps of five minutes from the last feature row of every route."""
    return model.forecast_grid(
        dashboards.forecast_starts(v.routes, v.trips, v.feature_table),
        F.col("last"),
        window_minutes=120,
        interval_minutes=5,
        temperature=20.0,
        precipitation_percent=40.0,
        weather_code=1,
        traffic_level=1,
        event=False,
    )


@query(
    """SELECT route_short_name, moment AS timestamp,
  (hour(moment) BETWEEN 7 AND 9 OR hour(moment) BETWEEN 17 AND 19)::INTEGER AS peak_hour,
  round(sin(2 * pi() * (hour(moment) * 3600 + minute(moment) * 60) / 86400), 6) AS sine_time,
  20::DOUBLE AS temperature, 4e-1 AS precipitation_probability, 1 AS weather_code,
  1 AS traffic_level, 0 AS event_dummy, school, hospital,
  (isodow(moment) >= 6)::INTEGER AS weekend
FROM (SELECT route_short_name, arg_max(f.school, (f.school, f.hospital)) AS school,
    arg_max(f.hospital, (f.school, f.hospital)) AS hospital,
    unnest(generate_series(max(timestamp_x), max(timestamp_x) + INTERVAL 115 MINUTE,
      INTERVAL 5 MINUTE)) AS moment
  FROM feature_table f JOIN trips t ON f.trip_id_x = t.trip_id JOIN routes USING (route_id)
  GROUP BY route_short_name)""",
    "feature_table",
    "trips",
    "routes",
)
def m8_forecast_grid(v: Views):
    return _grid(v).withColumn("sine_time", F.round("sine_time", 6))


@query(
    """SELECT route_short_name, floor(avg(congestion_rate) * 1e6 + 0.5000001) / 1e6 AS mean_prediction,
  CASE WHEN avg(congestion_rate) >= 8e-1 THEN 'High' WHEN avg(congestion_rate) >= 3e-1
    THEN 'Moderate' ELSE 'Low' END AS status FROM congestion GROUP BY route_short_name""",
    "congestion",
)
def a16_congestion_status(v: Views):
    rates = dashboards.congestion_by_route(v.feature_table, v.trips, v.routes)
    status = model.forecast_status(rates.withColumnRenamed("congestion_rate", "prediction"))
    # Means of 400ths often lie halfway between two millionths, where the order of a sum decides.
    halves_up = F.floor(F.col("mean_prediction") * 1e6 + 0.5000001) / 1e6
    return status.withColumn("mean_prediction", halves_up)


@query(
    """SELECT route_short_name, route_short_name[1:1] AS first_character,
  route_short_name || ' - ' || route_long_name AS label FROM routes""",
    "routes",
)
def c15_route_texts(v: Views):
    short = F.col("route_short_name")
    return v.routes.select(
        short,
        texts.first_character(short).alias("first_character"),
        texts.route_label(short, F.col("route_long_name")).alias("label"),
    )


@query(
    """SELECT trip_id_x, timestamp_x, share, peak_hour, event_dummy, school, hospital, weekend,
  round(sine_time, 6) AS sine_time, temperature, precipitation_probability, weather_code,
  round(congestion_rate, 6) AS congestion_rate, CASE traffic_level WHEN 'no traffic/low' THEN 0
    WHEN 'medium' THEN 1 WHEN 'heavy' THEN 2 WHEN 'severe/standstill' THEN 3 END AS traffic_level
FROM (SELECT *, (('0x' || md5(trip_id_x || '|' || strftime(timestamp_x, '%Y-%m-%d %H:%M:%S'))[1:8])
  ::BIGINT % 100)::INTEGER AS share FROM feature_table)""",
    "feature_table",
)
def m1_model_table(v: Views):
    table = model.model_table(v.feature_table)
    return table.withColumns({n: F.round(n, 6) for n in ("sine_time", "congestion_rate")})


@query(
    """SELECT unnest(['trip_id_x', 'timestamp_x', 'peak_hour', 'sine_time', 'temperature',
  'weather_code', 'event_dummy', 'congestion_rate', 'school', 'hospital', 'weekend']) AS column_name
FROM (SELECT count(*) AS n FROM feature_table WHERE traffic_level = 'heavy') WHERE n > 0""",
    "feature_table",
)
def f11_complete_columns(v: Views):
    """Columns without a gap, of a table with a missing level and a number that is none."""
    gaps = v.feature_table.withColumns(
        {
            "traffic_level": F.when(F.col("traffic_level") != "heavy", F.col("traffic_level")),
            "precipitation_probability": F.when(
                F.col("traffic_level") == "heavy", F.lit(float("nan"))
            ).otherwise(F.col("precipitation_probability")),
        }
    )
    names = [(name,) for name in complete_columns(gaps)]
    return v.spark.createDataFrame(names, "column_name string")


@query(
    """SELECT count(*) AS test_rows, round(sqrt(avg((congestion_rate - (SELECT avg(congestion_rate)
  FROM shared WHERE share < 70)) ** 2)), 6) AS rmse
FROM shared WHERE share >= 70""".replace(
        "shared",
        """(SELECT congestion_rate, ('0x' || md5(trip_id_x || '|' || strftime(timestamp_x,
  '%Y-%m-%d %H:%M:%S'))[1:8])::BIGINT % 100 AS share FROM feature_table)""",
    ),
    "feature_table",
)
def m5_root_tree_rmse(v: Views):
    """A tree without a split predicts the mean of the training rows, so its error is known."""
    trained = model.train_tree(v.feature_table, depth=0)
    scored = model.score(trained, model.test_rows(model.model_table(v.feature_table)))
    rmse = model.rmse(scored, "congestion_rate", "prediction")
    return scored.agg(F.count("*").alias("test_rows"), F.lit(rmse.scalar()).alias("rmse")).select(
        "test_rows", F.round("rmse", 6).alias("rmse")
    )


@query(
    """SELECT unnest(['peak_hour', 'sine_time', 'temperature', 'precipitation_probability',
  'weather_code', 'traffic_level', 'event_dummy', 'school', 'hospital', 'weekend']) AS feature,
  true AS consistent"""
)
def m4_split_statistics(v: Views):
    """Means times splits are totals, and a feature has importance just where it has splits."""
    trained = model.train_tree(v.feature_table)
    kinds = model.split_statistics(trained, v.feature_table).join(
        model.feature_importance(trained, v.feature_table), "feature"
    )
    same = [
        F.abs(F.col(mean) * F.col("weight") - F.col(f"total_{mean}")) < 1e-6
        for mean in ("gain", "cover")
    ]
    used = (F.col("importance") > 0) == (F.col("total_gain") > 0)
    return kinds.select("feature", (same[0] & same[1] & used).alias("consistent"))


# Trained models have no counterpart in SQL.


@query()
def m2_boosted_forecast(v: Views):
    trained = model.train_boosted(v.feature_table)
    return model.score(trained, _grid(v)).select("route_short_name", "timestamp", "prediction")


@query()
def m3_tree_test_rmse(v: Views):
    trained = model.train_tree(v.feature_table)
    scored = model.score(trained, model.test_rows(model.model_table(v.feature_table)))
    return model.rmse(scored, "congestion_rate", "prediction")


@query()
def m4_feature_importance(v: Views):
    return model.feature_importance(model.train_tree(v.feature_table), v.feature_table)
