"""Bus tables derived from the driver's tables, in Spark and as SQL text with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["l_orderkey", "l_linenumber"]
#: Order of words within a packet; unique together with l_orderkey.
WORD_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bus1553(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "unix_micros(cast(l_shipdate as timestamp)) * 1000 + l_linenumber AS time", "l_orderkey", "l_linenumber", "cast(l_suppkey % 4 as int) AS channelid",
        "cast(l_partkey % 3 as int) AS txrtaddr", "l_linenumber % 4 AS rxrtaddr", "cast(l_partkey % 2 as int) AS txsubaddr", "l_linenumber % 2 AS rxsubaddr",
        f"array({', '.join(f'cast((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 13 + {7919 * i}L) % 65536 as int)' for i in range(32))}) AS data",  # compiled, as a lambda isn't
    )


BUS1553 = """bus1553 AS (SELECT epoch_us(l_shipdate) * 1000 + l_linenumber AS time, l_orderkey, l_linenumber, (l_suppkey % 4)::INT AS channelid,
    (l_partkey % 3)::INT AS txrtaddr, (l_linenumber % 4)::INT AS rxrtaddr, (l_partkey % 2)::INT AS txsubaddr, (l_linenumber % 2)::INT AS rxsubaddr,
    list_transform(range(32), lambda i: ((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 13 + i * 7919) % 65536)::BIGINT) AS data FROM lineitem)"""


def commwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command words of bus1553."""
    return bus1553(spark, sf_dir).selectExpr("channelid", "txrtaddr * 2048 + 1024 + txsubaddr * 32 AS tx", "rxrtaddr * 2048 + rxsubaddr * 32 AS rx")


COMMWORDS = BUS1553 + ", commwords AS (SELECT channelid, txrtaddr * 2048 + 1024 + txsubaddr * 32 AS tx, rxrtaddr * 2048 + rxsubaddr * 32 AS rx FROM bus1553)"


def bus429(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS packet", *WORD_ORDER, "unix_micros(cast(l_shipdate as timestamp)) * 1000 AS time", "cast(l_suppkey % 2 as int) AS channelid", "cast(l_partkey % 4 as int) AS bus", "120 + l_linenumber % 3 AS label", "cast(l_partkey div 4 % 4 as int) AS SDI",
        "cast((l_orderkey * 7919 + l_partkey * 104729) % 524288 as int) AS data", "cast(l_orderkey % 4 as int) AS SSM", "l_orderkey % 2 = 1 AS parity", "cast((l_partkey * 37) % 1000 as int) AS gaptime",
    )


BUS429 = """bus429 AS (SELECT l_orderkey AS packet, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, epoch_us(l_shipdate) * 1000 AS time, (l_suppkey % 2)::INT AS channelid,
    (l_partkey % 4)::INT AS bus, 120 + l_linenumber % 3 AS label, (l_partkey // 4 % 4)::INT AS SDI, ((l_orderkey * 7919 + l_partkey * 104729) % 524288)::BIGINT AS data, (l_orderkey % 4)::BIGINT AS SSM,
    l_orderkey % 2 = 1 AS parity, ((l_partkey * 37) % 1000)::BIGINT AS gaptime FROM lineitem)"""


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr("event_id AS pkt_offset", "cast(user_id % 4 as int) AS channelid", "unix_micros(cast(ts as timestamp)) % 281474976710656 AS rtc", "event_type")


def time_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th packet; those of type error are no valid fixes."""
    return packets(spark, sf_dir).where("pkt_offset % 50 = 0").selectExpr("pkt_offset", "rtc", "rtc * 100 + 7 AS fix_time", "case when event_type = 'error' then 15 else 0 end AS src", "0 AS time_fmt")


PACKETS = "packets AS (SELECT event_id AS pkt_offset, (user_id % 4)::INT AS channelid, epoch_us(ts) % 281474976710656 AS rtc, event_type FROM events)"
FIXES = PACKETS + ", fixes AS (SELECT pkt_offset, rtc, rtc * 100 + 7 AS fix_time, event_type FROM packets WHERE pkt_offset % 50 = 0), valid AS (SELECT * FROM fixes WHERE event_type <> 'error')"

_ICD = "msg_name string, elem_name string, xmit_word int, dest_word int, bus_name string, xmit_lru_addr int, dest_lru_addr int, offset int, elem_word_count int, schema string, is_bitlevel boolean, bitmsb int, bitlsb int, bit_count int, msb_val double"


def _tx(rt: int, sub: int) -> int:
    return rt * 2048 + 1024 + sub * 32


_MESSAGES = {"NAV": (_tx(1, 1), 2 * 2048, "A"), "NAV_COPY": (_tx(1, 1), 2 * 2048, "A"), "ENG": (_tx(2, 0), 2048 + 32, "B"), "ENG_A": (_tx(2, 0), 2048 + 32, "A"), "IDLE": (_tx(5, 5), 7 * 2048, "B")}
_ELEMENTS = [
    ("NAV", "alt", 0, 1, "UNSIGNEDBITS", True, 1, 12, 12, 2048.0), ("NAV", "ok", 3, 1, "UNSIGNEDBITS", True, 5, 5, 1, 1.0), ("NAV", "turn", 4, 1, "SIGNED16", False, 0, 0, 0, 64.0), ("NAV", "vel", 1, 2, "SIGNEDBITS", True, 3, 9, 23, 512.0),
    ("NAV_COPY", "gps", 5, 2, "FLOAT32_GPS", False, 0, 0, 0, 0.0), ("ENG", "rpm", 6, 2, "UNSIGNED32", False, 0, 0, 0, 1024.0), ("ENG_A", "temp", 8, 1, "SIGNEDBITS", True, 2, 9, 8, 128.0), ("IDLE", "none", 0, 1, "UNSIGNED16", False, 0, 0, 0, 0.0),
]


def icd_1553(spark: SparkSession) -> DataFrame:
    rows = []
    for msg, elem, *rest in _ELEMENTS:
        tx, rx, bus = _MESSAGES[msg]
        rows.append((msg, elem, tx, rx, bus, tx >> 11, rx >> 11, *rest))
    return spark.createDataFrame(rows, _ICD)


ICD1553 = "icd(msg_name, elem_name, xmit_word, dest_word, bus_name) AS (VALUES " + ", ".join(f"('{m}', '{e[1]}', {_MESSAGES[m][0]}, {_MESSAGES[m][1]}, '{_MESSAGES[m][2]}')" for e in _ELEMENTS for m in [e[0]]) + ")"
BUS_MAP = [(0, "A"), (1, "B"), (2, "A")]
BUS_MAP_SQL = "bus_map(channelid, bus) AS (VALUES (0, 'A'), (1, 'B'), (2, 'A'))"


def bus_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUS_MAP, "channelid int, bus string")


ICD429_ROWS = [
    ("W120", "all", 120, "abc", -1, "UNSIGNEDBITS", 1, 12, 12, -1, 2048.0), ("W120X", "one", 120, "ABC", 2, "BCD", 4, 22, 19, -1, 0.0),
    ("W121", "temp", 121, "DEF", 2, "SIGNEDBITS", 4, 16, 13, -1, 512.0), ("W122", "mag", 122, "DEF", -1, "SIGNMAG", 4, 22, 19, -1, 256.0), ("LOST", "x", 130, "NOPE", -1, "UNSIGNEDBITS", 1, 8, 8, -1, 0.0),
]


def icd_429(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ICD429_ROWS, "word_name string, elem_name string, label int, bus string, sdi int, schema string, bitmsb int, bitlsb int, bit_count int, bcd_partial int, msb_val double")


ICD429 = "icd429(word_name, label, bus, sdi) AS (VALUES " + ", ".join(f"('{r[0]}', {r[2]}, '{r[3]}', {r[4]})" for r in ICD429_ROWS) + ")"
CHANNELS = [(0, 1, "ABC"), (0, 2, "DEF"), (1, 3, "JKL"), (1, 4, "GHI")]


def channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNELS, "channelid int, subchannel int, name string")


CHANNELS_SQL = "channels(channelid, subchannel, name) AS (VALUES " + ", ".join(map(str, CHANNELS)) + ")"


def tmats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, "BUS A LEFT", "1553IN"), (1, "B", "1553IN"), (2, "spare", "1553IN"), (9, "A", "429IN")], "channelid int, source string, type string")


TMATS_SQL = "tmats(channelid, source, type) AS (VALUES (0, 'BUS A LEFT', '1553IN'), (1, 'B', '1553IN'), (2, 'spare', '1553IN'), (9, 'A', '429IN'))"


def tmats_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Attribute lines made of `part`: each part is a channel `R-<key>\TK1-<size>` with its name, and a type line."""
    return _table(spark, sf_dir, "part").selectExpr(r"explode(array(concat('R-', p_partkey, '\\TK1-', p_size, ':', p_partkey % 16, ';'), concat('R-', p_partkey, '\\DSI-', p_size, ':', p_name, ';'), concat('R-', p_partkey, '\\CDT-', p_size, ':', if(p_size % 2 = 0, '1553IN', '429IN'), ';'))) AS line")


def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits of clock words, from order lines."""
    return _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast(l_partkey % 366 as int) AS d", "cast(l_suppkey % 24 as int) AS h", "cast(l_partkey % 60 as int) AS m", "cast(l_orderkey % 60 as int) AS s", "cast(l_orderkey % 100 as int) * 10 AS ms", "cast(1990 + l_partkey % 40 as int) AS y", "cast(1 + l_suppkey % 12 as int) AS mo", "cast(1 + l_orderkey % 28 as int) AS dd")


TIME_PARTS = "parts AS (SELECT l_orderkey, l_linenumber, l_partkey % 366 AS d, l_suppkey % 24 AS h, l_partkey % 60 AS m, l_orderkey % 60 AS s, (l_orderkey % 100) * 10 AS ms, 1990 + l_partkey % 40 AS y, 1 + l_suppkey % 12 AS mo, 1 + l_orderkey % 28 AS dd FROM lineitem)"
