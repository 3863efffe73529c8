"""Monthly revenue by pickup zone and service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.functions.calendar import month_start

_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
}
_AVERAGES = {
    "avg_monthly_passenger_count": "passenger_count",
    "avg_monthly_trip_distance": "trip_distance",
}


def monthly_revenue(trips: DataFrame) -> DataFrame:
    """Sums and averages per zone, month and service over unified trips as they came."""
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month_start("pickup_datetime").alias("revenue_month"),
        "service_type",
    ).agg(
        *[F.sum(source).alias(name) for name, source in _SUMS.items()],
        *[F.avg(source).alias(name) for name, source in _AVERAGES.items()],
    )


def monthly_revenue_sql(trips: DataFrame, view: str = "trips_data") -> DataFrame:
    """:func:`monthly_revenue` as a SQL string over a temporary view."""
    trips.createOrReplaceTempView(view)
    sums = ", ".join(f"SUM({source}) AS {name}" for name, source in _SUMS.items())
    averages = ", ".join(f"AVG({source}) AS {name}" for name, source in _AVERAGES.items())
    return trips.sparkSession.sql(
        f"""
        SELECT PULocationID AS revenue_zone,
               CAST(date_trunc('month', pickup_datetime) AS timestamp_ntz) AS revenue_month,
               service_type, {sums}, {averages}
        FROM {view}
        GROUP BY 1, 2, 3
        """
    )
