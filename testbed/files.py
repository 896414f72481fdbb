"""Sensor files with chosen names, written by Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Files of one asset.
SHARES = 2


def write_reading_files(
    readings: DataFrame,
    path: str,
    stem: Column,
    date: Column | None = None,
    value: Column | None = None,
) -> str:
    """Write readings as ``;``-separated files, named by ``stem``, into ``path``.

    Rows are dealt out by asset and one of ``SHARES`` numbers, so an asset has that many
    files at most. A task writes into a folder of its attempt and moves the files out
    when all are whole; one that is run again replaces its files. ``path`` must be
    shared by all executors.
    """
    date = F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS") if date is None else date
    value = F.col("value").cast("string") if value is None else value
    line = F.concat_ws(
        ";", *[F.coalesce(c, F.lit("")) for c in (date, F.col("series"), value)]
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, root = fs.FileSystem.from_uri(path)
        own = f"{root}/_attempt-{TaskContext.get().taskAttemptId()}"
        target.create_dir(own, recursive=True)
        current, out, names = None, None, []
        for batch in batches:
            for name, lines in batch.groupby("name", sort=False)["line"]:
                if name != current:
                    if out is not None:
                        out.close()
                    current = name
                    names.append(name)
                    out = target.open_output_stream(f"{own}/{name}")
                    out.write(b"date;series;value\n")
                out.write(("\n".join(lines) + "\n").encode())
            yield pd.DataFrame({"rows": [len(batch)]})
        if out is not None:
            out.close()
        for name in names:
            target.move(f"{own}/{name}", f"{root}/{name}")
        target.delete_dir(own)

    share = F.pmod(F.xxhash64(date, value), F.lit(SHARES))
    name = F.concat(share.cast("string"), F.lit("-"), stem, F.lit(".csv"))
    rows = readings.select(name.alias("name"), line.alias("line"))
    rows = rows.repartition("name").sortWithinPartitions("name")
    rows.mapInPandas(write, "rows bigint").agg(F.sum("rows")).collect()
    return path
