"""Gap between the last two moments of a user's last day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_gap(df: DataFrame, key: str, second: str) -> DataFrame:
    """(key, gap): seconds from the second newest distinct epoch second to the newest.

    Both must lie on the newest day of the key; keys with a single second on
    that day are absent. Seconds are made distinct by (key, second), which
    spreads a hot key; then only the two newest per key are ranked, and the rank
    filter drops the rest before the second shuffle.
    """
    moments = df.select(key, second).where(F.col(second).isNotNull()).distinct()
    newest = Window.partitionBy(key).orderBy(F.col(second).desc())
    last_two = moments.withColumn("_rank", F.row_number().over(newest)).where("_rank <= 2")
    ends = last_two.groupBy(key).agg(
        F.max(second).alias("_last"), F.min(second).alias("_before")
    )

    def day(name):
        return F.to_date(F.timestamp_seconds(name))

    return ends.where(
        (F.col("_last") > F.col("_before")) & (day("_last") == day("_before"))
    ).select(key, (F.col("_last") - F.col("_before")).alias("gap"))
