"""Monthly weather for a chart."""

from pyspark.sql import functions as F

from spokeframe.functions.calendar import month_label


def weather_monthly(weather, min_year=2014):
    """Months after ``min_year``, in order and labelled."""
    return (
        weather.where(F.col("year") > min_year)
        .withColumn("month_label", month_label("year", "month"))
        .orderBy("year", "month")
    )
