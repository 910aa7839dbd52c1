"""Fixed schemas of every input and output."""

from __future__ import annotations

from pyspark.sql import types as T

NODES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

ELEVATION = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("elevation", T.IntegerType()),
    ]
)

# An arrival as it travels in a message: milliseconds since the epoch, city and count.
EVENT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("refugees", T.LongType()),
    ]
)

UPDATE = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("refugees", T.LongType()),
        T.StructField("change", T.LongType()),
    ]
)
