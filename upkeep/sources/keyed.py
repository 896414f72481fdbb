"""Tables that ``write_keyed`` stored."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from upkeep.fixed import KEYS
from upkeep.operators.keyed import Keyed


def read_keyed(spark: SparkSession, path: str) -> Keyed:
    """The table stored at ``path``.

    Spark knows buckets from its catalog only, so the files are entered there as an
    external table, under a name that follows from the path and the layout.
    """
    layout = json.loads(spark.read.text(f"{path}/_layout").first().value)
    schema = T.StructType.fromJson(layout["schema"])
    buckets = layout["buckets"]
    name = "keyed_" + hashlib.md5(f"{path} {json.dumps(layout)}".encode()).hexdigest()
    keys = ", ".join(KEYS)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f"{path}/buckets".replace("'", "\\'")
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet
            CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS
            LOCATION '{place}'"""
    )
    key_schema = T.StructType([schema[key] for key in KEYS])
    return Keyed(
        spark.table(name).select(*schema.names),
        spark.read.schema(schema).parquet(f"{path}/loose"),
        spark.read.schema(key_schema).parquet(f"{path}/hot"),
        buckets,
        layout["hot_keys"],
    )
