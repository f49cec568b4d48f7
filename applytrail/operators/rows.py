"""Row-level helpers shared by the jobs: ranking, caps, unions, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The whole first row per key under ``order``.

    Spark turns ``row_number() = 1`` into a window-group limit, so each map task
    sends one row per key to the shuffle however often the key repeats.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_status(mail: DataFrame, tie: str = "filename") -> DataFrame:
    """Newest mail per (company, role)."""
    order = [F.col("date").desc_nulls_last(), F.col(tie).desc()]
    return pick_one(mail, ["company_clean", "role_clean"], order)


def first_per_key(df: DataFrame, key: str = "job_id", order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """First stored record per key; records without the key are left out."""
    return pick_one(df.filter(F.col(key).isNotNull()), [key], [F.col(c).asc_nulls_last() for c in order])


def last_per_key(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The last write wins for a repeated key."""
    return pick_one(df, [key], [F.col(c).desc_nulls_last() for c in order])


def sort_by(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last())


def most_active(apps: DataFrame, n: int) -> DataFrame:
    return apps.orderBy(F.desc("mail_count"), "company_clean", "role_clean").limit(n)


def most_recent(apps: DataFrame, n: int) -> DataFrame:
    return apps.orderBy(F.col("first_applied_date").desc_nulls_last(), "company_clean", "role_clean").limit(n)


def cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """At most ``n`` records per run, in key order; the rest waits for the next run."""
    return df.orderBy(*order).limit(n)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Concatenate inputs by column name; a column one input lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_jobs(df: DataFrame) -> DataFrame:
    return df.select("company_clean", "role_clean").distinct()


def profile(df: DataFrame) -> DataFrame:
    """Row count and non-null count of every column, in one pass."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in names])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in names]
    return counts.select(F.col("_rows").alias("row_count"), F.inline(F.array(*pairs)))


def register(spark, tables: dict[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
