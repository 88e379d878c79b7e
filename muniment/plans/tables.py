"""The given tables, and the columns the queries derive from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.functions import values as V


def table(spark: SparkSession, sf_dir: str, name: str, where: Column | None = None) -> DataFrame:
    """One input table; zone-less timestamps are read as UTC instants.

    ``where`` filters the stored columns as they are, before that cast, so that it reaches the scan.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if where is not None:
        df = df.where(where)
    zoneless = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    for c in zoneless:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def created(col: str) -> Column:
    return V.iso_instant(F.col(col))


def day(col: str) -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd")


def prop_k() -> Column:
    return F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("created", created("o_orderdate"))


def events(spark, sf_dir, where: Column | None = None) -> DataFrame:
    """Events as datastream versions: object = user, datastream = event type, created = time of the event."""
    return table(spark, sf_dir, "events", where).withColumn("created", created("ts")).withColumn("k", prop_k())


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")
