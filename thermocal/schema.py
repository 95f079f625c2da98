"""Column names and schemas shared by every operator."""

from pyspark.sql import types as T

# Default feature order used by every model family.
FEATURES = ["Right_final", "Left_final", "Difference", "room_temperature"]
TARGET = "P1(uW)"
KEY = "sample_id"
CATEGORY = "category"
TEMPERATURE = "room_temperature"
RIGHT = "Right_final"
LEFT = "Left_final"
DIFFERENCE = "Difference"

READINGS_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField(CATEGORY, T.StringType()),
    T.StructField(TEMPERATURE, T.DoubleType()),
    T.StructField(RIGHT, T.DoubleType()),
    T.StructField(LEFT, T.DoubleType()),
    T.StructField(TARGET, T.DoubleType()),
    T.StructField(DIFFERENCE, T.DoubleType()),
])
