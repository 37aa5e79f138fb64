"""Landed files and responses to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.frames import compute_once
from ..functions.scalars import nan_to_null, query_values, tolerant_float
from ..functions.times import GRID_ZONE, read_instants

REQUEST_KEY = ("source", "facility_code", "date_start", "date_end")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files, one row each: ``path``, ``body``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and an explicit schema. Empty cells are NULL, and so is NaN."""
    df = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def facility_dimension(responses: DataFrame, body: str = "body") -> DataFrame:
    """Facility code, name and place; facilities without a place keep NULLs."""
    parsed = responses.select(F.from_json(body, schemas.FACILITY_RESPONSE).alias("r"))
    one = parsed.select(F.explode("r.data").alias("f"))
    return one.select(
        F.col("f.code").alias("facility_code"),
        F.col("f.name").alias("facility_name"),
        F.col("f.location.lat").alias("lat"),
        F.col("f.location.lng").alias("lng"),
    )


def unreadable_facilities(responses: DataFrame, body: str = "body") -> DataFrame:
    """The responses that ``facility_dimension`` can read nothing from."""
    return responses.filter(F.from_json(body, schemas.FACILITY_RESPONSE)["data"].isNull())


def flatten_series(
    responses: DataFrame, body: str = "body", url: str = "url", zone: str = GRID_ZONE
) -> DataFrame:
    """One row per unit and point of each requested metric.

    Which metrics a response holds is read from its URL (``metrics=a&metrics=b``)
    and each metric's place in the response is fixed. Adds ``ts`` (instant),
    ``value`` and ``problem`` (NULL for a good row) and keeps the other input
    columns. A response that gives no rows leaves one that says why:
    ``unreadable_body``, ``no_metrics``, ``unknown_metric`` or ``no_data``.
    """
    position = F.create_map(
        *(F.lit(x) for pair in schemas.METRIC_POSITION.items() for x in pair)
    )
    kept = [c for c in responses.columns if c not in (body, url)]
    parsed = compute_once(
        responses,
        {"_data": F.from_json(body, schemas.SERIES_RESPONSE)["data"], "_metrics": query_values(F.col(url), "metrics")},
        kept,
    )
    rows = parsed.select(*kept, "_data", F.explode_outer("_metrics").alias("metric"))
    place = F.try_element_at(position, F.col("metric"))
    results = F.get("_data", place)["results"]
    why = (
        F.when(F.col("_data").isNull(), "unreadable_body")
        .when(F.col("metric").isNull(), "no_metrics")
        .when(place.isNull(), "unknown_metric")
        .when(results.isNull(), "no_data")
    )
    rows = compute_once(rows, {"_why": why, "_results": results}, [*kept, "metric"])
    rows = rows.select(*kept, "metric", "_why", F.explode_outer("_results").alias("_u"))
    rows = rows.filter(F.col("_u").isNotNull() | F.col("_why").isNotNull())
    rows = rows.withColumn("_why", F.coalesce("_why", F.when(F.col("_u.data").isNull(), "no_data")))
    rows = rows.select(*kept, "metric", "_why", F.col("_u.name").alias("unit_name"), F.explode_outer("_u.data").alias("_p"))
    rows = rows.filter(F.col("_p").isNotNull() | F.col("_why").isNotNull())
    points = compute_once(
        rows,
        {"time_text": F.get("_p", F.lit(0)), "value": tolerant_float(F.get("_p", F.lit(1)))},
        [*kept, "metric", "unit_name", "_why"],
    )
    read = read_instants(points, "time_text", zone)
    return read.withColumn("problem", F.coalesce("_why", "problem")).drop("_why")


def split_problems(rows: DataFrame, reason: str = "problem") -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows. A bad row costs only itself."""
    return rows.filter(F.col(reason).isNull()).drop(reason), rows.filter(F.col(reason).isNotNull())


def missing_requests(requested: DataFrame, held: DataFrame) -> DataFrame:
    """Requests whose (source, facility, start, end) is not held yet."""
    keys = held.select(*REQUEST_KEY).distinct()
    return requested.join(keys, list(REQUEST_KEY), "left_anti")
