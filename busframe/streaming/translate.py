"""Translation of a stream: the lookup join has a static side, so a streaming bus table needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from busframe.operators.translate import lookup_1553, match_1553, translate_long


def stream_long(bus: DataFrame, icd: DataFrame, bus_map: DataFrame) -> DataFrame:
    """All elements of a streaming 1553 table in tall form."""
    return translate_long(match_1553(bus, lookup_1553(icd, bus_map)), icd)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet what is there now, then stops."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
