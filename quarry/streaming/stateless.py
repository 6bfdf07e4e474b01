"""Stateless operators on a streaming source.

dimension-join operators are written so that the same code runs on a
streaming DataFrame: here the daylight classification (T20 + J7), a
projection of each event's own timestamp, is applied to a file stream.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from quarry.operators.daylight import classify_daylight


def classify_daylight_stream(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str, checkpoint: str,
                             lat: float, lon: float, utc_offset_h: float, ts_col: str = "ts"):
    """Start a stream: file source -> label by local time of day -> Parquet sink.
    Days that arrive later need nothing prepared. ``availableNow`` processes
    what is there and stops; the checkpoint makes the job restartable."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    out = classify_daylight(src, ts_col, lat, lon, utc_offset_h)
    return (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
