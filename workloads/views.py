"""The engine's domain expressed on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from staytally.functions.scalars import wall_text

# Stay-date range requested in the event-based queries.
START, END = date(2024, 1, 6), date(2024, 1, 25)
HORIZON = (END - START).days + 1


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Natural intraday re-observations: every event is one count of one cell."""
    day = F.col("ts").cast("date")
    return read(spark, folder, "events").select(
        F.concat(F.lit("H"), "user_id").alias("hotel_id"),
        F.col("event_type").alias("room_type_id"),
        F.date_add(day, 1 + (F.col("event_id") % 2).cast("int")).alias("stay_date"),
        F.floor("value").cast("bigint").alias("available_rooms"),
        day.alias("snapshot_date"),
        F.col("ts").alias("observed_at"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same shape at scale, from lineitem and orders."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = read(spark, folder, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.concat(F.lit("S"), "l_suppkey").alias("hotel_id"),
        F.concat(F.lit("P"), F.col("l_partkey") % 3).alias("room_type_id"),
        F.col("l_shipdate").cast("date").alias("stay_date"),
        F.col("l_quantity").cast("bigint").alias("available_rooms"),
        F.col("o_orderdate").cast("date").alias("snapshot_date"),
        F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("o_orderdate")).alias("observed_at"),
        F.col("l_orderkey").alias("line_id"),
    )


def morning(rows: DataFrame) -> DataFrame:
    """Observations before noon: the batch that reaches the table first."""
    return rows.where(F.hour("observed_at") < 12)


def daytime(rows: DataFrame) -> DataFrame:
    """Observations from six o'clock on: a later batch that overlaps the first."""
    return rows.where(F.hour("observed_at") >= 6)


def supplier_hotels(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("hotel_id"),
        F.array(F.lit("single"), F.lit("double"), F.lit("suite")).alias("room_type_ids"),
    )


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """Events as API records in JSON text, with every kind of defect mixed in."""
    return read(spark, folder, "events").selectExpr(
        "event_id",
        "concat('H', user_id) AS hotel_id",
        """concat(
            '{"room_type_id": "',
            CASE WHEN event_id % 11 = 3 THEN 'attic' ELSE event_type END,
            '", "date": "',
            CASE event_id % 13 WHEN 5 THEN '2024-2-3' WHEN 7 THEN '2024-01-10T00:00:00'
                WHEN 9 THEN '2024-02-30' ELSE string(date(ts)) END,
            '", "available": ',
            CASE event_id % 17 WHEN 2 THEN '1.5' WHEN 4 THEN 'true' WHEN 6 THEN '"3"'
                WHEN 8 THEN '-1' WHEN 10 THEN 'null' WHEN 12 THEN '9223372036854775808'
                ELSE string(bigint(floor(value))) END,
            CASE event_id % 19 WHEN 1 THEN ', "hotel_id": "other"'
                WHEN 2 THEN ', "hotel_id": null'
                WHEN 3 THEN concat(', "hotel_id": "H', user_id, '"') ELSE '' END,
            '}') AS item""",
    )


def event_rooms(spark: SparkSession, folder: str) -> DataFrame:
    """Expected rooms of the event hotels; ``error`` is no room type."""
    rooms = read(spark, folder, "events").where("event_type <> 'error'")
    return rooms.select(
        F.concat(F.lit("H"), "user_id").alias("hotel_id"), F.col("event_type").alias("room_type_id")
    ).distinct()


def as_text(rows: DataFrame) -> DataFrame:
    """Dates and times in canonical text, which every engine prints alike."""
    forms = {"date": lambda c: F.col(c).cast("string"), "timestamp_ntz": wall_text}
    return rows.select(
        *(
            forms[f.dataType.typeName()](f.name).alias(f.name)
            if f.dataType.typeName() in forms
            else F.col(f.name)
            for f in rows.schema
        )
    )

