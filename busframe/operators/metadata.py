"""Summaries of parsed and translated tables, as grouped sets; and the metadata document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sets(rows: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Sorted distinct values of each group; repeats go before the groups are gathered."""
    return rows.select(*by, value).distinct().groupBy(*by).agg(F.sort_array(F.collect_set(value)).alias(out))


def remote_terminals(bus: DataFrame) -> DataFrame:
    """channelid -> addresses on both sides of RT to RT messages, else on the side in use."""
    both = (F.col("txcommwrd") != 0) & (F.col("rxcommwrd") != 0)
    sides = F.when(both, F.array("txrtaddr", "rxrtaddr")).when(F.col("txcommwrd") != 0, F.array("txrtaddr")).otherwise(F.array("rxrtaddr"))
    return _sets(bus.select("channelid", F.explode(sides).alias("addr")), ["channelid"], "addr", "addrs")


def command_pairs(bus: DataFrame) -> DataFrame:
    return bus.select("channelid", "txcommwrd", "rxcommwrd").distinct()


def first_video_times(video: DataFrame) -> DataFrame:
    """channelid -> least time of its packets' first units."""
    return video.where("unit_idx = 0").groupBy("channelid").agg(F.min("time").alias("min_time"))


def labels(words: DataFrame) -> DataFrame:
    return _sets(words, ["channelid"], "label", "labels")


def bus_numbers(words: DataFrame) -> DataFrame:
    return _sets(words, ["channelid"], "bus", "buses")


def labels_by_bus(words: DataFrame) -> DataFrame:
    """channelid -> map of bus to labels."""
    inner = _sets(words, ["channelid", "bus"], "label", "labels")
    return inner.groupBy("channelid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("bus", "labels")))).alias("labels"))


def packet_types(packets: DataFrame) -> DataFrame:
    return packets.select("data_type").distinct()


def uid(content_hash: Column, time: Column, version: Column, label: Column) -> Column:
    return F.sha2(F.concat(content_hash, time, version, label), 256)


def _mapped(rows: DataFrame, value: Column | str, name: str) -> DataFrame:
    """One row: a map of channelid (as text, as JSON's keys are) to a value, in order of the channels."""
    by_channel = lambda a, b: F.when(a["channelid"] < b["channelid"], -1).when(a["channelid"] > b["channelid"], 1).otherwise(0)
    entries = F.array_sort(F.collect_list(F.struct("channelid", (F.col(value) if isinstance(value, str) else value).alias("v"))), by_channel)
    return rows.agg(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["channelid"].cast("string"), e["v"]))).alias(name))


def runtime_1553(bus: DataFrame) -> list[DataFrame]:
    pairs = command_pairs(bus).groupBy("channelid").agg(F.array_sort(F.collect_list(F.array("txcommwrd", "rxcommwrd"))).alias("pairs"))
    return [_mapped(remote_terminals(bus), "addrs", "chanid_to_lru_addrs"), _mapped(pairs, "pairs", "chanid_to_comm_words")]


def runtime_429(words: DataFrame) -> list[DataFrame]:
    by_bus = F.transform_keys("labels", lambda k, _: k.cast("string"))
    return [_mapped(labels(words), "labels", "chanid_to_labels"), _mapped(bus_numbers(words), "buses", "chanid_to_bus_numbers"), _mapped(labels_by_bus(words), by_bus, "chanid_to_bus_numbers_to_labels")]


def runtime_video(video: DataFrame) -> list[DataFrame]:
    return [_mapped(first_video_times(video), "min_time", "chanid_to_first_timestamp")]


RUNTIME = {"1553": runtime_1553, "429": runtime_429, "video": runtime_video}


def document(kind: str, rows: DataFrame, resources: DataFrame, config: dict[str, str], *, time: str, version: str) -> DataFrame:
    """One row, the metadata document of a parsed table: type, uid, provenance, config and runtime.

    resources: type, path and uid (of a recording its content's hash, of a table its own document's uid) of what it was made
    from; the document's uid hashes these uids in order of their paths, time, version and type. runtime has the sets of the
    table by channel (RUNTIME; of other kinds none), each gathered by a job over distinct values; a row a channel is joined.
    """
    label = f"parsed_{kind}"
    listed = resources.agg(F.array_sort(F.collect_list(F.struct("path", "type", "uid"))).alias("r"))
    own = uid(F.array_join(F.transform("r", lambda x: x["uid"]), ""), F.lit(time), F.lit(version), F.lit(label))
    out = listed.select(F.lit(label).alias("type"), own.alias("uid"), F.struct(F.lit(time).alias("time"), F.lit(version).alias("version"), F.transform("r", lambda x: F.struct(x["type"].alias("type"), x["path"].alias("path"), x["uid"].alias("uid"))).alias("resource")).alias("provenance"))
    out = out.withColumn("config", F.create_map(*[F.lit(x) for pair in sorted(config.items()) for x in pair]) if config else F.create_map().cast("map<string,string>"))
    parts = RUNTIME[kind](rows) if kind in RUNTIME else []
    for part in parts:
        out = out.crossJoin(F.broadcast(part))  # one row each
    names = [p.columns[0] for p in parts]
    return out.select("type", "uid", "provenance", "config", (F.struct(*names) if names else F.create_map().cast("map<string,string>")).alias("runtime"))


def write_metadata(document: DataFrame, path: str) -> None:
    """A one-row document as one JSON file."""
    document.coalesce(1).write.mode("overwrite").json(path)
