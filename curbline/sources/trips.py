"""Reading landed trip files, with lineage and a fixed zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

ZONE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)


def with_lineage(df: DataFrame) -> DataFrame:
    """File path, file time and ingestion time of each row, in batch or in a stream."""
    return df.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_source_file_modification_time": F.col("_metadata.file_modification_time"),
            "_ingested_at": F.current_timestamp(),
        }
    )


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return with_lineage(spark.read.schema(TRIP_SCHEMA).parquet(path))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The CSV dimension: header line, fixed types, conformed names."""
    raw = spark.read.schema(ZONE_FILE_SCHEMA).option("header", "true").csv(path)
    names = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    return raw.withColumnsRenamed(names)


def source_year(path: str = "_source_file"):
    """The year written into a landed file's name, '' when there is none."""
    return F.regexp_extract(path, "yellow_tripdata_([0-9]{4})-", 1)


def land_trips(trips: DataFrame, path: str) -> None:
    """Write trips below one folder per pickup month, the month in the folder's name.

    ``rebalance`` lets adaptive execution split large months and merge small ones, so the
    number of files follows the data volume instead of tasks times months.
    """
    label = F.concat(
        F.lit("yellow_tripdata_"), F.date_format("tpep_pickup_datetime", "yyyy-MM")
    )
    (
        trips.withColumn("landed", label)
        .hint("rebalance", "landed")
        .write.mode("overwrite")
        .partitionBy("landed")
        .parquet(path)
    )
