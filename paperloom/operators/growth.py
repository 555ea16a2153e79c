"""Change against the preceding calendar year."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import percentage


def with_calendar_growth(yearly: DataFrame, entity: str | None = None) -> DataFrame:
    """Add the previous year's count and the growth in percent.

    Input is one row per year (and entity), so a window holds at most as many rows as
    there are calendar years. A gap in the years leaves both results NULL.
    """
    window = Window.partitionBy(entity) if entity else Window.partitionBy()
    window = window.orderBy("publication_year")
    year, count = F.col("publication_year"), F.col("paper_count")
    adjacent = F.lag(year).over(window) == year - 1
    previous = F.when(adjacent, F.lag(count).over(window))
    return yearly.withColumn("previous_year_paper_count", previous).withColumn(
        "year_over_year_growth_percentage",
        percentage(
            F.col("paper_count") - F.col("previous_year_paper_count"), "previous_year_paper_count"
        ),
    )
