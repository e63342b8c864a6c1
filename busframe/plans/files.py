"""Registered queries that write files and read them back: recordings, parsed tables, interface documents, sinks.

All are made from the driver's tables in Spark, in a folder of the shared file system.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from busframe.functions import timebase
from busframe.operators import flatten, metadata, quality, translate
from busframe.operators import tmats as attrs
from busframe.plans import fixtures as fx
from busframe.plans import parse
from busframe.plans.catalog import ORACLES, query
from busframe.sources import icd, packets
from busframe.sources.tables import read_parsed, shared_folder

#: Events of a recording, and bytes of the first range that LIM1 reads of each.
EVENTS, FIRST = 2000, 4096
_CODES = {"click": 0x19, "view": 0x38, "purchase": 0x40}


def encode(kind: int, body: bytes, rtc: int = 0, channel: int = 1, flags: int = 0, secondary: bytes = b"", seq: int = 0) -> bytes:
    """One packet. flags: bits 0-1 say that a checksum follows the body, 3 for 32 bits; bit 7 that a secondary header precedes it."""
    body += b"\0" * (-len(body) % 4)
    if flags & 3 == 3:
        body += struct.pack("<I", sum(struct.unpack(f"<{len(body) // 4}I", body)) & 0xFFFFFFFF)
    size = packets.HEADER + len(secondary) + len(body)
    data = len(body) - (4 if flags & 3 == 3 else 0)
    head = packets.SYNC + struct.pack("<HIIBBBB", channel, size, data, 1, seq, flags, kind) + rtc.to_bytes(6, "little")
    return head + struct.pack("<H", sum(struct.unpack("<11H", head)) & 0xFFFF) + secondary + body


def _clock(n: int) -> bytes:
    """A clock packet's body: n seconds after the year 2020 began, 28 days at most; of no known source if n is divisible by 350."""
    day, rest = divmod(n % 2_419_200, 86_400)
    digits = lambda x: x // 10 << 4 | x % 10
    return struct.pack("<I4H", 0x200 | (15 if n % 350 == 0 else 0), digits(rest % 60) << 8, digits(rest // 3600) << 8 | digits(rest // 60 % 60), 1 << 8 | digits(day + 1), 0x2020)


def _words(kind: str, *columns: np.ndarray | int) -> np.ndarray:
    """Bytes of rows of numbers of one type, a row a packet."""
    return np.stack(np.broadcast_arrays(*columns), axis=1).astype(kind).view("u1")


def _heads(kind: np.ndarray, size: np.ndarray, data: np.ndarray, rtc: np.ndarray, channel: np.ndarray | int = 1, flags: np.ndarray | int = 0, seq: np.ndarray | int = 0) -> np.ndarray:
    """Packet headers as encode() makes them."""
    cells = [int.from_bytes(packets.SYNC, "little"), channel, size & 0xFFFF, size >> 16, data & 0xFFFF, data >> 16, 1 | seq << 8, flags | kind << 8, rtc & 0xFFFF, rtc >> 16 & 0xFFFF, rtc >> 32 & 0xFFFF]
    return _words("<u2", *cells, sum(cells) & 0xFFFF)


def _clocks(n: np.ndarray) -> np.ndarray:
    """_clock() of many."""
    day, rest = n % 2_419_200 // 86_400, n % 2_419_200 % 86_400
    digits = lambda x: x // 10 << 4 | x % 10
    return _words("<u2", np.where(n % 350 == 0, 0x20F, 0x200), 0, digits(rest % 60) << 8, digits(rest // 3600) << 8 | digits(rest // 60 % 60), 1 << 8 | digits(day + 1), 0x2020)


def recorded(n: np.ndarray, kind: np.ndarray, channel: np.ndarray, nested: bool) -> bytes:
    """The packets of a recording's events, see write_recordings(), in the order given: a matrix of bytes, of which a packet has those of its parts."""
    if len(n) and (n.min() < 0 or n.max() >> 32):
        raise ValueError("an event's number must fit 32 bits")
    clock, second, zero = (n % 50 == 0) & nested, n % 3 == 0, np.zeros_like(n)
    body = _words("<u4", 1, n & 0xFFFFF, n)
    parts = [(body, ~clock)]
    if nested:
        inner = [_heads(zero + k, zero + packets.HEADER + 12, zero + 12, zero, 9) for k in (0x38, packets.CLOCK)]
        parts = [(np.hstack([body, inner[0], body, inner[1], _clocks(zero + 1)]), ~clock), (_clocks(n), clock)]
    lengths = sum(x.shape[1] * own for x, own in parts)
    total = sum(x.view("<u4").sum(axis=1, dtype="u8") * own for x, own in parts) & 0xFFFFFFFF
    time = [7 * n & 0xFFFF, 7 * n >> 16 & 0xFFFF, 7 * n >> 32 & 0xFFFF, zero, zero]
    time = _words("<u2", *time, (sum(time) + (n % 21 == 0)) & 0xFFFF)
    heads = _heads(np.where(clock, packets.CLOCK, kind), packets.HEADER + packets.SECONDARY * second + lengths + 4, lengths, n, channel, np.where(second, 0x83, 3), n % 256)
    checksums = _words("<u4", total ^ np.where(n % 11 == 0, 1 << 24, 0).astype("u8"))
    parts = [(heads, zero == 0), (time, second), *parts, (checksums, zero == 0)]
    return np.hstack([x for x, _ in parts])[np.hstack([np.repeat(own[:, None], x.shape[1], axis=1) for x, own in parts])].tobytes()


def write_recordings(spark: SparkSession, sf_dir: str, label: str, changed: int = 0, nested: bool = False) -> str:
    """The folder of recordings made of events, EVENTS of them to a file, written by Spark tasks. The rtc is the event's number.

    Each starts with an attribute packet. Every 11th event's body checksum is wrong, every 3rd has a secondary header with
    seven times its number as time, every 21st has a wrong one. changed: in recordings with an odd number, the channels are higher by it.
    nested: a body also holds two whole packets, and every 50th event is a clock packet.
    """
    folder = shared_folder(spark, label)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.floor(F.col("event_id") / EVENTS).alias("file"))

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number = int(key[0])
        rows = rows.sort_values("event_id")
        n, user = rows["event_id"].astype("int64").to_numpy(), rows["user_id"].astype("int64").to_numpy()
        kind = rows["event_type"].map(_CODES).fillna(0x68).astype("int64").to_numpy()
        system, path = packets.located(f"{folder}/{number:08d}.ch10")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as f:
            f.write(encode(0x01, struct.pack("<I", 0) + b"R-1\\ID:rec%08d;\n" % number) + recorded(n, kind, user % 4 + (changed if number % 2 else 0), nested))
        return pd.DataFrame({"file": [number], "packets": [len(n) + 1]})

    events.groupBy("file").applyInPandas(write, "file long, packets long").agg(F.sum("packets")).collect()
    return folder


def _recorded(spark: SparkSession, sf_dir: str, label: str, **options) -> DataFrame:
    spark.dataSource.register(packets.PacketSource)
    return spark.read.format("ch10").options(**options).load(write_recordings(spark, sf_dir, label))


_KIND = "CASE event_type WHEN 'click' THEN 25 WHEN 'view' THEN 56 WHEN 'purchase' THEN 64 ELSE 104 END"


@query("SRC8", f"SELECT event_id AS rtc, user_id % 4 AS channelid, {_KIND} AS data_type, 12 AS data_size, event_id % 256 AS seq_num, event_id % 11 <> 0 AS checksum_ok, event_id % 21 <> 0 AS sec_ok FROM events")
def _src8(spark, sf_dir):
    return _recorded(spark, sf_dir, "src8", chunk=30_000).where("data_type <> 1").select("rtc", "channelid", "data_type", "data_size", "seq_num", "checksum_ok", "sec_ok")


_NESTED_KIND = f"CASE WHEN event_id % 50 = 0 THEN 17 ELSE {_KIND} END"


def _nested(spark: SparkSession, sf_dir: str, label: str, chunk: int) -> DataFrame:
    return packets.read_recording(spark, write_recordings(spark, sf_dir, label, nested=True), chunk)


@query("SRC8_nested", f"SELECT event_id AS rtc, user_id % 4 AS channelid, {_NESTED_KIND} AS data_type, CASE WHEN event_id % 50 = 0 THEN 12 ELSE 84 END AS data_size, event_id % 11 <> 0 AS checksum_ok FROM events")
def _src8_nested(spark, sf_dir):
    """Bodies hold packets, most ranges begin within a body."""
    return _nested(spark, sf_dir, "src8", 4001).where("data_type <> 1").select("rtc", "channelid", "data_type", "data_size", "checksum_ok")


@query("SRC8_pushed", f"SELECT event_id AS rtc, user_id % 4 AS channelid, {_NESTED_KIND} AS data_type FROM events WHERE {_NESTED_KIND} IN (17, 56) AND user_id % 4 = 2")
def _src8_pushed(spark, sf_dir):
    """The reader takes the conditions over and skips what they leave out."""
    return _nested(spark, sf_dir, "src8", 30_000).where("data_type IN (17, 56) AND channelid = 2").select("rtc", "channelid", "data_type")


@query("JN1_recording", f"""WITH p AS (SELECT event_id, event_id // {EVENTS} AS file, {_NESTED_KIND} AS data_type FROM events), f AS (SELECT event_id, file FROM p WHERE event_id % 50 = 0 AND event_id % 350 <> 0 AND event_id % 11 <> 0 AND event_id % 21 <> 0)
    SELECT p.event_id AS rtc, f.event_id AS fix_rtc, (1577836800 + f.event_id % 2419200) * 1000000000 + (p.event_id - f.event_id) * 100 AS abs_time FROM p ASOF JOIN f ON p.file = f.file AND p.event_id >= f.event_id WHERE data_type <> 17""")  # fmt: skip
def _jn1_recording(spark, sf_dir):
    """The reader carries the fix from range to range."""
    rows = _nested(spark, sf_dir, "jn1", 20_000).where("data_type NOT IN (1, 17) AND fix_time IS NOT NULL")
    return rows.select("rtc", "fix_rtc", timebase.absolute(F.col("rtc"), F.col("fix_rtc"), F.col("fix_time")).alias("abs_time"))


@query("SRC9", "SELECT event_id AS rtc FROM events WHERE event_id % 11 <> 0 AND event_id % 21 <> 0")
def _src9(spark, sf_dir):
    return flatten.sound(_recorded(spark, sf_dir, "src9").where("data_type <> 1")).select("rtc")


@query("SRC10", "SELECT event_id AS rtc, 7 * event_id AS sec_time FROM events WHERE event_id % 3 = 0")
def _src10(spark, sf_dir):
    rows = _recorded(spark, sf_dir, "src10").where("secondary_hdr = 1")
    return rows.select("rtc", flatten.uint(F.col("sec_time"), 0, 6).alias("sec_time"))


@query("SRC11", f"SELECT DISTINCT 'R-1\\ID' AS code, 'rec' || printf('%08d', event_id // {EVENTS}) AS value FROM events")
def _src11(spark, sf_dir):
    return attrs.attributes(attrs.lines(attrs.read_tmats(packets.read_recording(spark, write_recordings(spark, sf_dir, "src11"), 30_000)))).select("code", "value")


@query("LIM1", f"WITH s AS (SELECT event_id, 48 + coalesce(sum(40 + CASE WHEN event_id % 3 = 0 THEN 12 ELSE 0 END) OVER (PARTITION BY event_id // {EVENTS} ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM events) SELECT event_id AS rtc, place::BIGINT AS \"offset\" FROM s WHERE place < {FIRST}")
def _lim1(spark, sf_dir):
    return _recorded(spark, sf_dir, "lim1", chunk=FIRST, maxChunks=1).where("data_type <> 1").select("rtc", "offset")


@query("QLT4", f"SELECT DISTINCT printf('%08d', event_id // {EVENTS}) || '.ch10' AS name, (event_id // {EVENTS}) % 2 = 0 AS equal, CASE WHEN (event_id // {EVENTS}) % 2 = 1 THEN 0 ELSE -1 END AS first_difference FROM events")
def _qlt4(spark, sf_dir):
    """Files of many blocks; in those that differ every event does."""
    a, b = (write_recordings(spark, sf_dir, "qlt4", x) for x in (0, 4))
    return quality.compare_files(spark, a, b, block=4096).select("name", "equal", F.coalesce("first_difference", F.lit(-1)).cast("int").alias("first_difference"))


@query("QLT1_positions", "SELECT c AS \"column\", true AS in_both, true AS same_type, n AS rows, (c = 'o_totalprice')::BIGINT AS different, c <> 'o_totalprice' AS passed FROM (SELECT count(*) AS n FROM orders), (VALUES ('o_orderkey'), ('o_custkey'), ('o_totalprice')) t(c)")
def _qlt1_positions(spark, sf_dir):
    """Two written tables in which one value differs: rows of its block alone are matched."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    least = rows.agg(F.min("o_orderkey")).first()[0]
    folders = [shared_folder(spark, f"qlt1{x}") for x in "ab"]
    for folder, more in zip(folders, (0.0, 1.0), strict=True):
        price = F.when(F.col("o_orderkey") == F.lit(least), F.col("o_totalprice") + more).otherwise(F.col("o_totalprice"))
        rows.select("o_orderkey", "o_custkey", price.alias("o_totalprice")).repartition(8, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(folder)
    return quality.compare_positions(spark, *folders)


_429 = "time, channelid, bus, label, SDI, data, SSM, parity"


def _parsed_429(spark: SparkSession, sf_dir: str, folder: str) -> None:
    parse.write_parsed(fx.bus429(spark, sf_dir).select(*_429.split(", ")), folder, ["time"])


@query("SNK1", f"WITH {fx.BUS429} SELECT {_429} FROM bus429")
def _snk1(spark, sf_dir):
    folder = shared_folder(spark, "snk1")
    _parsed_429(spark, sf_dir, f"{folder}/429.parquet")
    return read_parsed(spark, f"{folder}/429.parquet", "time long, channelid int, bus int, label int, SDI int, data int, SSM int, parity boolean")


@query("SNK1_groups", f"WITH {fx.BUS429} SELECT count(*) AS rows, true AS bounded, true AS sorted FROM bus429")
def _snk1_groups(spark, sf_dir):
    """Row groups as their footers have them: none over 10,000 rows, each with statistics that begin where the one before ends."""
    folder = shared_folder(spark, "snk1")
    _parsed_429(spark, sf_dir, folder)
    groups = parse.row_groups(spark, folder, "time")
    before = F.lag("greatest").over(Window.partitionBy("file").orderBy("row_group"))
    groups = groups.withColumn("follows", F.coalesce(F.col("least") >= before, F.col("least").isNotNull()))
    return groups.agg(F.sum("rows").alias("rows"), (F.max("rows") <= 10_000).alias("bounded"), F.min("follows").alias("sorted"))


@query("SRT1", f"WITH {fx.PACKETS} SELECT channelid, pkt_offset, rtc, row_number() OVER (ORDER BY channelid, pkt_offset) - 1 AS place FROM packets")
def _srt1(spark, sf_dir):
    """Rows as written files hold them, each with its place in all files."""
    folder = shared_folder(spark, "srt1")
    parse.write_ordered(fx.packets(spark, sf_dir).select("channelid", "pkt_offset", "rtc"), folder, ["channelid", "pkt_offset"])
    return parse.read_ordered(spark, folder)


@query("SRC3", f"WITH {fx.BUS429} SELECT {_429} FROM bus429")
def _src3(spark, sf_dir):
    """Two tables of side files lie in the same directory, and a text file."""
    folder = shared_folder(spark, "src3")
    _parsed_429(spark, sf_dir, f"{folder}/rows")
    beside = spark.read.parquet(f"{sf_dir}/region.parquet")
    beside.write.parquet(f"{folder}/_metadata.parquet")
    beside.write.parquet(f"{folder}/rec_metadata.parquet")
    beside.write.parquet(f"{folder}/rec_TMATS.parquet")
    beside.select("r_name").write.text(f"{folder}/notes")
    return read_parsed(spark, folder, columns=_429.split(", "))


# --- interface documents --------------------------------------------------------------------------------------------

_PART = "'M' || p_partkey AS msg_name, 'e' AS elem_name, p_size * 1024 AS xmit_word, p_partkey % 65536 AS dest_word, p_brand AS bus_name, p_size % 30 AS \"offset\", 1 AS elem_word_count, 'SIGNED16' AS schema, p_retailprice AS msb_val, p_name AS description"
_SHOWN = ["msg_name", "elem_name", "xmit_word", "dest_word", "bus_name", "offset", "elem_word_count", "schema", "msb_val", "description"]


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


@query("SRC4", f"SELECT {_PART} FROM part")
def _src4(spark, sf_dir):
    rows = _parts(spark, sf_dir).selectExpr(
        "concat('M', p_partkey) AS msg_name", "'e' AS elem_name", "p_size * 1024 AS xmit_word", "p_partkey % 65536 AS dest_word", "p_size AS msg_word_count", "p_brand AS bus_name", "'u' AS xmit_lru_name", "p_size % 32 AS xmit_lru_addr",
        "'v' AS dest_lru_name", "1 AS dest_lru_addr", "2 AS xmit_lru_subaddr", "3 AS dest_lru_subaddr", "1.5 AS rate", "p_size % 30 AS `offset`", "1 AS elem_word_count", "'SIGNED16' AS schema", "false AS is_bitlevel", "false AS is_multiformat",
        "0 AS bitmsb", "0 AS bitlsb", "0 AS bit_count", "0 AS classification", "p_name AS description", "p_retailprice AS msb_val", "'V' AS uom",
    )
    folder = shared_folder(spark, "src4")
    rows.write.option("header", True).csv(folder)
    good, bad = icd.read_icd_csv(spark, folder)
    return good.join(bad.limit(1), F.lit(True), "left_anti").select(*_SHOWN)  # a malformed line would leave nothing


def _documents(rows: DataFrame, head: str, folder: str) -> None:
    """YAML documents, a hundred entries of column `entry` to a file, all in one directory."""
    n = F.floor(F.col("p_partkey") / 100)
    docs = rows.groupBy(n.alias("n")).agg(F.concat(F.lit(head + "\n"), F.array_join(F.sort_array(F.collect_list("entry")), "\n")).alias("value"))
    docs.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "n").select("value").write.option("maxRecordsPerFile", 1).text(folder)


@query("SRC5", f"SELECT {_PART}, p_size % 16 + 1 AS bitlsb FROM part")
def _src5(spark, sf_dir):
    entry = F.format_string(
        '  M%d:\n    msg_data: {command: [%d, %d], lru_addr: [1, 2], lru_subaddr: [3, 4], lru_name: [u, v], wrdcnt: 2, bus: "%s", rate: 1.5}\n    word_elem: {}\n    bit_elem:\n      e: {off: %d, cnt: 1, schema: SIGNED16, msbval: %s, msb: 1, lsb: %d, bitcnt: 4, desc: "%s", uom: V, multifmt: false, class: 0}',
        "p_partkey", F.col("p_size") * 1024, F.col("p_partkey") % 65536, "p_brand", F.col("p_size") % 30, F.col("p_retailprice").cast("string"), F.col("p_size") % 16 + 1, "p_name",
    )
    folder = shared_folder(spark, "src5")
    _documents(_parts(spark, sf_dir).select("p_partkey", entry.alias("entry")), "translatable_message_definitions:", folder)
    return icd.read_icd_yaml_1553(spark, folder).select(*_SHOWN, "bitlsb")


@query("SRC6_reader", "SELECT 'W' || p_partkey AS word_name, 'e' AS elem_name, 120 + p_size % 8 AS label, upper(p_brand) AS bus, p_size % 5 - 1 AS sdi, 'BCD' AS schema, p_retailprice AS msb_val FROM part")
def _src6_reader(spark, sf_dir):
    entry = F.format_string('  W%d:\n    wrd_data: {label: %d, bus: "%s", sdi: %d, rate: 2.0}\n    elem:\n      e: {schema: BCD, msbval: %s, lsb: 11, bitcnt: 8, class: 0}', "p_partkey", F.col("p_size") % 8 + 120, F.lower("p_brand"), F.col("p_size") % 5 - 1, F.col("p_retailprice").cast("string"))
    folder = shared_folder(spark, "src6")
    _documents(_parts(spark, sf_dir).select("p_partkey", entry.alias("entry")), "translatable_word_definitions:", folder)
    return icd.read_icd_yaml_429(spark, folder).select("word_name", "elem_name", "label", "bus", "sdi", "schema", "msb_val")


@query("SRC7_reader", "SELECT p_size::BIGINT * 65536 + p_partkey % 65536 AS key, 'B' || p_partkey AS bus FROM part")
def _src7_reader(spark, sf_dir):
    entry = F.format_string("  B%d:\n    - [%d, %d]", "p_partkey", "p_size", F.col("p_partkey") % 65536)
    folder = shared_folder(spark, "src7")
    _documents(_parts(spark, sf_dir).select("p_partkey", entry.alias("entry")), "supplemental_bus_map_command_words:", folder)
    return icd.read_supplemental_keys(spark, folder)


# --- sinks ----------------------------------------------------------------------------------------------------------


@query("SNK2", ORACLES["TRN6"])
def _snk2(spark, sf_dir):
    """A directory per message; all are read back, elements as rows."""
    folder, elements = shared_folder(spark, "snk2"), translate.collect_elements(fx.icd_1553(spark), "msg_name", ["msg_name", "elem_name"])
    matched = translate.match_1553(fx.bus1553(spark, sf_dir), translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark)))
    written = {r["msg_name"] for r in translate.write_tables(matched, fx.icd_1553(spark), folder).collect()}
    elements = {n: own for n, own in elements.items() if n in written}
    out = None
    for n, own in elements.items():
        cells = F.array(*[F.struct(F.lit(e["elem_name"]).alias("elem_name"), F.col(e["elem_name"]).cast("double").alias("value")) for e in own])
        rows = spark.read.parquet(f"{folder}/{n}.parquet").select("time", F.lit(n).alias("msg_name"), F.explode(cells).alias("e")).select("time", "msg_name", "e.*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SNK3", r"SELECT 'R-' || p_partkey || '\DSI-' || p_size || ':' || p_name || ';' AS value FROM part")
def _snk3(spark, sf_dir):
    folder = shared_folder(spark, "snk3")
    parse.write_attributes(fx.tmats_lines(spark, sf_dir).where(F.col("line").contains(r"\DSI-")).select(F.col("line").alias("text")), folder)
    return spark.read.text(folder)


@query("SNK4", f"WITH {fx.BUS429} SELECT 'parsed' AS type, count(*) AS rows, min(time) AS first_time, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM bus429")
def _snk4(spark, sf_dir):
    folder = shared_folder(spark, "snk4")
    doc = fx.bus429(spark, sf_dir).agg(F.lit("parsed").alias("type"), F.count("*").alias("rows"), F.min("time").alias("first_time"), F.array_join(F.sort_array(F.collect_set(F.col("label").cast("string"))), ",").alias("labels"))
    metadata.write_metadata(doc, folder)
    return spark.read.json(folder)


_UIDS = "(SELECT sha256(string_agg(uid, '' ORDER BY path) || '2020-01-01' || '1.0' || 'parsed_429') FROM (SELECT r_name AS path, sha256(lower(r_name)) AS uid FROM region))"


@query("SNK4_document", f"""WITH {fx.BUS429}, c AS (SELECT channelid, list_sort(list(DISTINCT label)) AS labels, list_sort(list(DISTINCT bus)) AS buses FROM bus429 GROUP BY channelid), b AS (SELECT channelid, bus, list_sort(list(DISTINCT label)) AS labels FROM bus429 GROUP BY ALL)
    SELECT b.channelid::VARCHAR AS channelid, b.bus::VARCHAR AS bus, 'parsed_429' AS type, {_UIDS} AS uid, '1.0' AS version, (SELECT count(*) FROM region) AS resources, 'abc' AS setting, array_to_string(b.labels, ',') AS bus_labels, array_to_string(c.labels, ',') AS labels, array_to_string(c.buses, ',') AS buses FROM b JOIN c USING (channelid)""")  # fmt: skip
def _snk4_document(spark, sf_dir):
    """The document of a written table, read back from its JSON and laid out by channel and bus."""
    folder = shared_folder(spark, "snk4")
    _parsed_429(spark, sf_dir, f"{folder}/429.parquet")
    words = read_parsed(spark, f"{folder}/429.parquet", "channelid int, bus int, label int")
    resources = spark.read.parquet(f"{sf_dir}/region.parquet").select(F.lit("recording").alias("type"), F.col("r_name").alias("path"), F.sha2(F.lower("r_name"), 256).alias("uid"))
    metadata.write_metadata(metadata.document("429", words, resources, {"chunk": "abc"}, time="2020-01-01", version="1.0"), f"{folder}/document")
    kind = "type string, uid string, provenance struct<time: string, version: string, resource: array<struct<type: string, path: string, uid: string>>>, config map<string, string>, runtime struct<chanid_to_labels: map<string, array<int>>, chanid_to_bus_numbers: map<string, array<int>>, chanid_to_bus_numbers_to_labels: map<string, map<string, array<int>>>>"
    read = spark.read.schema(kind).json(f"{folder}/document")
    shown = lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",")
    rows = read.select("*", F.explode("runtime.chanid_to_bus_numbers_to_labels").alias("channelid", "own")).select("*", F.explode("own").alias("bus", "of_bus"))
    return rows.select(
        "channelid", "bus", "type", "uid", "provenance.version", F.size("provenance.resource").cast("long").alias("resources"), F.element_at("config", "chunk").alias("setting"), shown(F.col("of_bus")).alias("bus_labels"),
        shown(F.element_at("runtime.chanid_to_labels", F.col("channelid"))).alias("labels"), shown(F.element_at("runtime.chanid_to_bus_numbers", F.col("channelid"))).alias("buses"),
    )


@query("SNK5", f"WITH {fx.BUS1553} SELECT channelid::VARCHAR AS channelid, array_to_string(list_transform(data, lambda w: lower(printf('%04X', w))), '') AS chunk FROM bus1553")
def _snk5(spark, sf_dir):
    """The streams' files, read back as chunks of 64 bytes."""
    folder = shared_folder(spark, "snk5")
    flatten.write_video(fx.bus1553(spark, sf_dir), ["time", "l_orderkey"], folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = files.select(F.regexp_extract("path", r"channel=(\d+)/", 1).alias("channelid"), "content", F.explode(F.sequence(F.lit(0), (F.col("length") / 64).cast("int") - 1)).alias("i"))
    return rows.select("channelid", F.lower(F.hex(F.substring("content", F.col("i") * 64 + 1, F.lit(64)))).alias("chunk"))


# --- rules of a document --------------------------------------------------------------------------------------------

#: An element's fields, by its number, so that each rule is broken by some.
_ODD = """concat('M', p_partkey) AS msg_name, if(p_partkey % 13 = 1, null, 'e') AS elem_name, if(p_partkey % 17 = 1, null, 1) AS xmit_word, if(p_partkey % 19 = 1, null, 1) AS dest_word, if(p_partkey % 23 = 1, null, 'A') AS bus_name,
    p_size - 1 AS `offset`, if(p_partkey % 5 = 0, 3, 1) AS elem_word_count, element_at(array('SIGNED16', 'MODE_CODE', 'NOPE', 'UNSIGNEDBITS', 'FLOAT32_GPS', 'BCD'), cast(p_partkey % 6 as int) + 1) AS schema, p_partkey % 7 < 3 AS is_bitlevel,
    cast(p_partkey % 18 as int) AS bitmsb, cast(p_size % 18 as int) AS bitlsb, cast(p_partkey % 9 as int) AS bit_count, if(p_partkey % 29 = 1, null, 1.0D) AS msb_val"""
_ODD_SQL = """odd AS (SELECT 'M' || p_partkey AS msg_name, CASE WHEN p_partkey % 13 <> 1 THEN 'e' END AS elem_name, CASE WHEN p_partkey % 17 <> 1 THEN 1 END AS xmit_word, CASE WHEN p_partkey % 19 <> 1 THEN 1 END AS dest_word,
    CASE WHEN p_partkey % 23 <> 1 THEN 'A' END AS bus_name, p_size - 1 AS place, CASE WHEN p_partkey % 5 = 0 THEN 3 ELSE 1 END AS k, ['SIGNED16', 'MODE_CODE', 'NOPE', 'UNSIGNEDBITS', 'FLOAT32_GPS', 'BCD'][p_partkey % 6 + 1] AS schema,
    p_partkey % 7 < 3 AS bits, p_partkey % 18 AS msb, p_size % 18 AS lsb, p_partkey % 9 AS n, CASE WHEN p_partkey % 29 <> 1 THEN 1.0 END AS msb_val FROM part),
    broken AS (SELECT msg_name, elem_name, unnest(list_filter([CASE WHEN elem_name IS NULL THEN 'required elem_name' END, CASE WHEN xmit_word IS NULL THEN 'required xmit_word' END, CASE WHEN dest_word IS NULL THEN 'required dest_word' END,
    CASE WHEN bus_name IS NULL THEN 'required bus_name' END, CASE WHEN msb_val IS NULL THEN 'required msb_val' END, CASE WHEN schema = 'MODE_CODE' THEN 'not translated' END, CASE WHEN schema IN ('NOPE', 'BCD') THEN 'unknown encoding' END,
    CASE WHEN NOT bits AND (schema = 'SIGNED16' AND k <> 1 OR schema = 'FLOAT32_GPS' AND k <> 2) THEN 'word count' END, CASE WHEN bits AND schema <> 'UNSIGNEDBITS' THEN 'encoding of bit element' END,
    CASE WHEN bits AND NOT (msb BETWEEN 1 AND 16 AND lsb BETWEEN 1 AND 16) THEN 'bit positions' END, CASE WHEN bits AND (CASE WHEN k = 1 THEN lsb - msb + 1 ELSE 17 - msb + lsb + 16 END) <> n THEN 'bit count' END,
    CASE WHEN place + k > 32 THEN 'offset' END], lambda x: x IS NOT NULL)) AS rule FROM odd)"""


def _rules(name: str, *rules: str) -> None:
    wanted = f" WHERE rule IN ({', '.join(repr(r) for r in rules)})" if rules else ""

    def f(spark, sf_dir):
        found = quality.validate_icd(_parts(spark, sf_dir).selectExpr(*_select(_ODD)))
        return found.where(F.col("rule").isin(*rules)) if rules else found

    query(name, f"WITH {_ODD_SQL} SELECT * FROM broken{wanted}")(f)


def _select(text: str) -> list[str]:
    """The items of a SELECT list."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


_rules("QLT2_rules")
_rules("DEC20", "not translated")
_rules("DEC21", "word count")
_rules("DEC22", "unknown encoding", "encoding of bit element")


@query("DEC22_429", "SELECT 'W' || p_partkey AS word_name, 'e' AS elem_name, unnest(list_filter([CASE WHEN p_size % 3 = 0 THEN 'unknown encoding' END, CASE WHEN p_size % 10 > 7 THEN 'label' END, CASE WHEN p_partkey % 7 > 4 THEN 'sdi' END, CASE WHEN p_partkey % 4 = 3 THEN 'bit count' END], lambda x: x IS NOT NULL)) AS rule FROM part")
def _dec22_429(spark, sf_dir):
    rows = _parts(spark, sf_dir).selectExpr("concat('W', p_partkey) AS word_name", "'e' AS elem_name", "120 + p_size % 10 AS label", "p_brand AS bus", "cast(p_partkey % 7 as int) - 1 AS sdi", "if(p_size % 3 = 0, 'NOPE', 'BCD') AS schema", "4 AS bitmsb", "11 AS bitlsb", "if(p_partkey % 4 = 3, 7, 8) AS bit_count", "1.0D AS msb_val")
    return quality.validate_icd_429(rows)
