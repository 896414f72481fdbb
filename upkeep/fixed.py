"""Names and fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names used inside the library.
ASSET = "asset_id"
DAY = "day"
KEYS = [ASSET, DAY]
AVERAGE = "average"
KPIS = ["flighthours", "flightcycles", "delayedminutes"]
LABEL = "maintenance"
MONTH = "month"

# Order of the features inside the vector.
FEATURES = [*KPIS, AVERAGE]

# Label texts, listed by their index (0.0, 1.0).
NEGATIVE = "no maintenance"
POSITIVE = "unscheduled maintenance"
LABELS = [NEGATIVE, POSITIVE]

# Which interruptions count, and how far ahead one looks.
SUBSYSTEM = "3453"
UNSCHEDULED_KINDS = ["Delay", "Safety", "AircraftOnGround"]
HORIZON_DAYS = 7

# Layout of a sensor file.
READINGS_SEPARATOR = ";"
READINGS_SCHEMA = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("series", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Column names in the operational tables.
UTILIZATION_DAY = "timeid"
UTILIZATION_ASSET = "aircraftid"
INTERRUPTION_START = "starttime"
INTERRUPTION_ASSET = "aircraftregistration"

# Columns of the matrix as a keyless CSV, in stored order.
MATRIX_CSV_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in [AVERAGE, *KPIS]]
    + [T.StructField(LABEL, T.StringType())]
)

# Status of a request.
SCORED = "scored"
NO_READINGS = "no_readings"
NO_UTILIZATION = "no_utilization"
INVALID_REQUEST = "invalid_request"
