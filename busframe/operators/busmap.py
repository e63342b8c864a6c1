"""Which recorded channel carries which bus: attributes, votes, exclusions, overrides."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a command word that a vote compares: address, direction and subaddress, not the word count.
KEY_MASK = 0xFFE0
MOST_WORDS = 10_000


def message_key(tx: Column, rx: Column) -> Column:
    """A message's unsigned 32-bit key of its two command words, word counts left out."""
    return tx.cast("long").bitwiseAND(F.lit(KEY_MASK)) * 65536 + rx.cast("long").bitwiseAND(F.lit(KEY_MASK))


def message_keys(icd: DataFrame, supplemental: DataFrame | None = None) -> DataFrame:
    """Distinct (key, bus) of all messages. icd: xmit_word, dest_word, bus_name."""
    keys = icd.select(message_key(F.col("xmit_word"), F.col("dest_word")).alias("key"), F.col("bus_name").alias("bus"))
    if supplemental is not None:
        masked = F.col("key").bitwiseAND(F.lit(KEY_MASK << 16 | KEY_MASK))
        keys = keys.unionByName(supplemental.select(masked.alias("key"), "bus"))
    return keys.distinct()


def buses_by_key(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.sort_array(F.collect_set("bus")).alias("buses"))


def lru_addresses(icd: DataFrame) -> DataFrame:
    """bus -> sorted addresses of its units."""
    addr = icd.select("bus_name", F.explode(F.array("xmit_lru_addr", "dest_lru_addr")).alias("addr"))
    return addr.groupBy("bus_name").agg(F.sort_array(F.collect_set("addr")).alias("addrs"))


def vote_counts(commwords: DataFrame, keys: DataFrame) -> DataFrame:
    """(channelid, bus, votes): one for each distinct key of the channel that the bus defines. commwords: channelid, tx, rx."""
    seen = commwords.select("channelid", message_key(F.col("tx"), F.col("rx")).alias("key")).distinct()
    return seen.join(keys.select("key", "bus").distinct(), "key").groupBy("channelid", "bus").agg(F.count("*").alias("votes"))


def arg_max(rows: DataFrame, by: list[str], score: str, value: str) -> DataFrame:
    """(by, value, score, tied): a group's greatest score, the least value that has it, and whether others have it too.

    Greatest and least value at the top differ where there is a tie, so two mergeable extremes do: one shuffle of a row a
    group and task, whatever the size of a group. Null scores and values don't count.
    """
    top = rows.where(F.col(score).isNotNull() & F.col(value).isNotNull()).groupBy(*by).agg(F.max(F.struct(score, value)).alias("__last"), F.min(F.struct((-F.col(score)).alias("down"), F.col(value).alias("value"))).alias("__first"))
    return top.select(*by, F.col("__first.value").alias(value), F.col(f"__last.{score}").alias(score), (F.col("__first.value") != F.col(f"__last.{value}")).alias("tied"))


def vote_winners(commwords: DataFrame, votes: DataFrame, threshold: int = 1) -> DataFrame:
    """(channelid, bus, reason): the bus with most votes, or the reason why there is none."""
    top = arg_max(votes, ["channelid"], "votes", "bus")
    reason = F.when(F.col("tied").isNull(), "No Votes").when(F.col("votes") < threshold, "Vote count not >= vote_threshold").when(F.col("tied"), "Tie Vote")
    out = commwords.select("channelid").distinct().join(top, "channelid", "left").withColumn("reason", reason)
    return out.select("channelid", F.when(F.col("reason").isNull(), F.col("bus")).alias("bus"), "reason")


def correct_sources(tmats: DataFrame, recorded: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """(channelid, source) of the recorded channels, names replaced by corrections (old, new)."""
    rows = tmats.select("channelid", "source").join(recorded.select("channelid").distinct(), "channelid", "left_semi")
    if corrections is None:
        return rows
    rows = rows.join(corrections.select(F.col("old").alias("source"), "new"), "source", "left")
    return rows.select("channelid", F.coalesce("new", "source").alias("source"))


def attribute_winners(sources: DataFrame, recorded: DataFrame, buses: DataFrame) -> DataFrame:
    """(channelid, bus, reason) by exact match of a channel's source with a bus name. buses: bus."""
    rows = recorded.select("channelid").distinct().join(sources, "channelid", "left").join(buses.select(F.col("bus").alias("source"), F.col("bus")).distinct(), "source", "left")
    reason = F.when(F.col("source").isNull(), "Missing From TMATS").when(F.col("bus").isNull(), "TMATS Bus Name Not in DTS File")
    return rows.select("channelid", "bus", reason.alias("reason"))


def names_agree(winners: DataFrame, sources: DataFrame) -> DataFrame:
    """Winners whose bus name holds the channel's source, or the other way round."""
    rows = winners.where("bus is not null").join(sources, "channelid")
    return rows.where(F.contains("bus", "source") | F.contains("source", "bus")).select(winners.columns)


def excluded(names: DataFrame, name_col: str, words: DataFrame) -> DataFrame:
    """(channelid, word) of the channels whose name contains an excluded word, in any case. words: MOST_WORDS at most."""
    listed = [r[0] for r in words.select("word").where("word is not null").distinct().limit(MOST_WORDS + 1).collect()]
    if len(listed) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} excluded words")
    held = F.filter(F.array(*map(F.lit, sorted(listed))).cast("array<string>"), lambda w: F.contains(F.upper(F.col(name_col)), F.upper(w)))
    return names.select("channelid", F.explode(held).alias("word")).distinct()


class BusMap(NamedTuple):
    bus_map: DataFrame  # channelid, bus, source
    excluded: DataFrame  # channelid, reason
    votes: DataFrame  # channelid, bus, votes


def resolve_bus_map(
    commwords: DataFrame, keys: DataFrame, tmats: DataFrame, *, use_tmats: bool = False, vote_threshold: int = 1, check_tmats: bool = False,
    exclusions: DataFrame | None = None, corrections: DataFrame | None = None, overrides: DataFrame | None = None,
) -> BusMap:
    """Channel to bus: by attributes or by vote (checked against attributes if asked), exclusions before and after, overrides last."""
    # A row a channel and key from here on: joins by channel move no command words, of which a channel may have all.
    commwords = commwords.select("channelid", *[F.col(c).cast("long").bitwiseAND(F.lit(KEY_MASK)).alias(c) for c in ("tx", "rx")]).distinct()
    recorded = commwords.select("channelid").distinct()
    sources = correct_sources(tmats, recorded, corrections)
    out = None
    if exclusions is not None:
        out = excluded(sources, "source", exclusions).select("channelid", F.lit("Excluded").alias("reason"))
        recorded = recorded.join(out, "channelid", "left_anti")
        commwords = commwords.join(F.broadcast(out.select("channelid")), "channelid", "left_anti")  # a row a channel
    votes = vote_counts(commwords, keys)
    if use_tmats:
        winners, label = attribute_winners(sources, recorded, keys), "TMATS"
    else:
        winners, label = vote_winners(commwords, votes, vote_threshold), "Vote Method"
        if check_tmats:
            agreed, label = names_agree(winners, sources).select("channelid", F.lit(True).alias("ok")), "Vote Method & TMATS"
            named = sources.select("channelid", F.lit(True).alias("named")).distinct()
            differ = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("named").isNull(), "Missing From TMATS").when(F.col("ok").isNull(), "TMATS Mismatch")
            winners = winners.join(agreed, "channelid", "left").join(named, "channelid", "left").withColumn("reason", differ).select("channelid", F.when(F.col("reason").isNull(), F.col("bus")).alias("bus"), "reason")
    lost = winners.where("bus is null").select("channelid", "reason")
    out = lost if out is None else out.unionByName(lost)
    bus_map = winners.where("bus is not null").select("channelid", "bus", F.lit(label).alias("source"))
    if exclusions is not None:
        residual = excluded(bus_map, "bus", exclusions).select("channelid", F.lit("Excluded").alias("reason"))
        bus_map = bus_map.join(residual, "channelid", "left_anti")
        out = out.unionByName(residual)
    if overrides is not None:
        bus_map = apply_overrides(bus_map, overrides, commwords)
        out = out.join(overrides.select("channelid"), "channelid", "left_anti")
    return BusMap(bus_map, out, votes)


def apply_overrides(bus_map: DataFrame, overrides: DataFrame, recorded: DataFrame) -> DataFrame:
    """User pairs (channelid, bus) of recorded channels win over the computed bus."""
    user = overrides.join(recorded.select("channelid").distinct(), "channelid", "left_semi").select("channelid", F.col("bus").alias("user_bus"))
    rows = bus_map.join(user, "channelid", "full")
    return rows.select("channelid", F.coalesce("user_bus", "bus").alias("bus"), F.when(F.col("user_bus").isNotNull(), "USER").otherwise(F.col("source")).alias("source"))
