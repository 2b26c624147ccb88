"""Segment reports, orderings and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import FEATURED_SQL, PER_UNIT, featured_trips, mean_sql, scored_trips
from farebox.operators.evaluate import compare
from farebox.operators.profile import value_counts
from farebox.operators.reports import best_row, segment_report, top_k


def _report(key: str, distance: bool = True):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return segment_report(
            featured_trips(spark, sf_dir), key, distance="trip_distance" if distance else None, per_unit=PER_UNIT
        )

    return query


def _report_sql(key: str, distance: bool = True) -> str:
    miles = f"{mean_sql('trip_distance', 350)} AS avg_distance," if distance else ""
    return f"""WITH {FEATURED_SQL} SELECT {key}, {mean_sql('label', 100)} AS avg_fare, {miles}
  count(*) AS trip_count FROM featured GROUP BY {key} ORDER BY {key}"""


def top_k_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten busiest pickup zones."""
    return top_k(value_counts(featured_trips(spark, sf_dir), "PULocationID"), "count", 10, tie="PULocationID")


TOP_SQL = f"""WITH {FEATURED_SQL} SELECT PULocationID, count(*) AS count FROM featured GROUP BY PULocationID
ORDER BY count DESC, PULocationID LIMIT 10"""


def best_row_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of the two fixed-formula models by rmse."""
    table = compare(
        scored_trips(spark, sf_dir), "label", {"line": "prediction", "flat": "prediction_flat"}
    )
    return best_row(table.select("model_name", F.round("rmse", 6).alias("rmse")), "rmse", "model_name")


BEST_SQL = f"""WITH {FEATURED_SQL}, e AS (
  SELECT 'line' AS model_name, label - (46e0 + 3.35e0 * trip_distance) AS err FROM featured
  UNION ALL SELECT 'flat', label - 90e0 FROM featured)
SELECT model_name, round(sqrt(avg(err * err)), 6) AS rmse FROM e GROUP BY model_name ORDER BY rmse, model_name LIMIT 1"""


def busiest_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = segment_report(featured_trips(spark, sf_dir), "pickup_hour", per_unit=PER_UNIT)
    return best_row(report, "trip_count", "pickup_hour", largest=True)


BUSIEST_SQL = _report_sql("pickup_hour").replace("ORDER BY pickup_hour", "ORDER BY trip_count DESC, pickup_hour LIMIT 1")

QUERIES = {
    "hourly_report": (_report("pickup_hour"), _report_sql("pickup_hour")),
    "rush_report": (_report("is_rush_hour"), _report_sql("is_rush_hour")),
    "rush_report_fares": (_report("is_rush_hour", distance=False), _report_sql("is_rush_hour", distance=False)),
    "weekend_report": (_report("is_weekend"), _report_sql("is_weekend")),
    "airport_report": (_report("is_airport_trip"), _report_sql("is_airport_trip")),
    "location_report": (_report("PULocationID"), _report_sql("PULocationID")),
    "top_k_groups": (top_k_groups, TOP_SQL),
    "best_row": (best_row_query, BEST_SQL),
    "busiest_hour": (busiest_hour, BUSIEST_SQL),
}
