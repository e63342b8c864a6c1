"""Recorder attributes: `CODE:value;` lines with index numbers in the codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframe.functions.text import attribute_code, attribute_value, code_pattern

TYPES = {"1553": "1553IN", "429": "429IN", "video": "VIDIN", "ethernet": "ETHIN"}


def read_tmats(packets: DataFrame) -> DataFrame:
    """(file, text): bodies of a recording's attribute packets (type 1, after their 4-byte word) in order. One text a file."""
    bodies = packets.where("data_type = 1").select("file", F.struct("offset", F.expr("substring(body, 5)").cast("string").alias("t")).alias("b"))
    return bodies.groupBy("file").agg(F.array_sort(F.collect_list("b")).alias("b")).select("file", F.array_join(F.transform("b", lambda x: x["t"]), "").alias("text"))


def lines(text: DataFrame, column: str = "text") -> DataFrame:
    """Attribute lines of texts, one a row."""
    others = [c for c in text.columns if c != column]
    rows = text.select(*others, F.explode(F.split(column, r"\r?\n")).alias("line"))
    return rows.withColumn("line", F.trim("line")).where("line <> ''")


def attributes(rows: DataFrame, line: str = "line") -> DataFrame:
    """(code, value) of the lines that are attributes."""
    out = rows.withColumns({"code": attribute_code(F.col(line)), "value": attribute_value(F.col(line))})
    return out.where("code <> ''").drop(line)


def indexed(attrs: DataFrame, template: str, names: list[str], value: str) -> DataFrame:
    """Attributes of one template: its index numbers as int columns `names`, and the value."""
    pattern = code_pattern(template)
    rows = attrs.where(F.col("code").rlike(pattern))
    return rows.select(*[F.regexp_extract("code", pattern, i + 1).cast("int").alias(n) for i, n in enumerate(names)], F.col("value").alias(value))


def map_attrs(attrs: DataFrame, key: str, value: str, shared: list[str]) -> DataFrame:
    """(key, value) of attributes whose codes share all index numbers."""
    return indexed(attrs, key, shared, "key").join(indexed(attrs, value, shared, "val"), shared).select("key", F.col("val").alias("value"))


def map_attrs_list(attrs: DataFrame, key: str, value: str, shared: list[str], extra: list[str]) -> DataFrame:
    """key -> its values in order of the value code's further index numbers, and by that number as a map."""
    rows = indexed(attrs, key, shared, "key").join(indexed(attrs, value, shared + extra, "val"), shared)
    grouped = rows.groupBy("key").agg(F.array_sort(F.collect_set(F.struct(*extra, "val"))).alias("v"))
    return grouped.select("key", F.transform("v", lambda x: x["val"]).alias("values"), F.map_from_arrays(F.transform("v", lambda x: x[extra[0]]), F.transform("v", lambda x: x["val"])).alias("by_index"))


def subchannel_names(index_to_subchannel: DataFrame, index_to_name: DataFrame) -> DataFrame:
    """(channelid, subchannel, name) from (channelid, idx, subchannel) and (channelid, idx, name)."""
    return index_to_subchannel.join(index_to_name, ["channelid", "idx"]).select("channelid", "subchannel", "name")


def of_type(sources: DataFrame, types: DataFrame, label: str) -> DataFrame:
    """Sources of the channels recorded as one type."""
    return sources.join(types.where(F.col("type") == label), "channelid", "left_semi")
