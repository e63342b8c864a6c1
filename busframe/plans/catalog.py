"""Registered queries of the bus engine, by operator id, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframe.functions import bits, decode, text, timebase
from busframe.operators import alignment, busmap, flatten, metadata, quality, translate
from busframe.operators import tmats as attrs
from busframe.plans import fixtures as fx
from busframe.plans import parse
from busframe.schemas import READ_1553, READ_429
from busframe.sources.icd import bit_positions_429
from busframe.sources.tables import read_parsed, require_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- decode functions over 1553 words -------------------------------------------------------------------------------

W = [f"data[{i + 1}]" for i in range(32)]
_FLOAT = "({})::FLOAT::DOUBLE"


def _decoded(name: str, sql: str, schema: str, *args, **kwargs) -> None:
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        kind = "boolean" if args[3:] and schema == "UNSIGNEDBITS" and decode.bit_count(*args[1:4]) == 1 else "double"
        return fx.bus1553(spark, sf_dir).select(*fx.KEYS, decode.decode(schema, F.col("data"), *args, **kwargs).cast(kind).alias("value"))

    query(name, f"WITH {fx.BUS1553} SELECT l_orderkey, l_linenumber, {sql} AS value FROM bus1553")(f)


def _gps(sign: str, exponent: str, terms: str, zero: str) -> str:
    value = f"(CASE WHEN {sign} = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) * pow(2.0::DOUBLE, ({exponent} - 128)::DOUBLE) * (0.5::DOUBLE + {terms})"
    return f"CASE WHEN {zero} THEN 0.0::DOUBLE WHEN {exponent} = 0 AND {sign} = 0 THEN {terms} WHEN {exponent} = 0 THEN 'nan'::DOUBLE ELSE {value} END"


def _ieee(sign: str, exponent: str, fraction: str, bias: int, width: int, special: int) -> str:
    one = f"pow(2.0::DOUBLE, {width}::DOUBLE)"
    size = f"CASE WHEN {exponent} = {special} THEN (CASE WHEN {fraction} = 0 THEN 'inf'::DOUBLE ELSE 'nan'::DOUBLE END) WHEN {exponent} = 0 THEN ({fraction})::DOUBLE / {one} * pow(2.0::DOUBLE, {1 - bias}::DOUBLE) ELSE (1 + ({fraction})::DOUBLE / {one}) * pow(2.0::DOUBLE, ({exponent} - {bias})::DOUBLE) END"
    return f"CASE WHEN {sign} = 1 THEN -({size}) ELSE {size} END"


_FIELD2 = f"(({W[1]} & 16383) * 512 + ({W[2]} >> 7))"  # bits 3 of one word to 9 of the next
_decoded("DEC1", _FLOAT.format(f"({W[0]} >> 4)::DOUBLE * (2048.0::DOUBLE / 2048)"), "UNSIGNEDBITS", 0, 1, 1, 12, 2048.0)
_decoded("DEC1_three_words", f"(({W[0]} & 255)::DOUBLE * 268435456 + {W[1]}::DOUBLE * 4096 + ({W[2]} >> 4)::DOUBLE) * (100.0::DOUBLE / 34359738368)", "UNSIGNEDBITS", 0, 3, 9, 12, 100.0)
_decoded("DEC2", f"(({W[3]} >> 11) & 1) <> 0", "UNSIGNEDBITS", 3, 1, 5, 5, 0.5)
_decoded("DEC3", _FLOAT.format(f"({_FIELD2} - CASE WHEN {_FIELD2} >= 4194304 THEN 8388608 ELSE 0 END)::DOUBLE * (512.0::DOUBLE / 2097152)"), "SIGNEDBITS", 1, 2, 3, 9, 512.0)
_decoded("DEC4", f"(({W[2]} >> 4) & 127)::DOUBLE", "ASCII", 2, 1, 6, 12)
_decoded("DEC8", _FLOAT.format(f"{W[4]}::DOUBLE * (300.0::DOUBLE / 32768)"), "UNSIGNED16", 4, 1, msb_val=300.0)
_decoded("DEC9", _FLOAT.format(f"({W[4]} - CASE WHEN {W[4]} >= 32768 THEN 65536 ELSE 0 END)::DOUBLE * (64.0::DOUBLE / 16384)"), "SIGNED16", 4, 1, msb_val=64.0)
_decoded("DEC10", f"({W[6]} * 65536 + {W[7]})::DOUBLE * (1024.0::DOUBLE / 2147483648)", "UNSIGNED32", 6, 2, msb_val=1024.0)
_decoded("DEC11", f"({W[6]} * 65536 + {W[7]} - CASE WHEN {W[6]} >= 32768 THEN 4294967296 ELSE 0 END)::DOUBLE * (1024.0::DOUBLE / 1073741824)", "SIGNED32", 6, 2, msb_val=1024.0)
_GPS32 = _FLOAT.format(_gps(f"({W[5]} >> 15)", f"(({W[5]} >> 7) & 255)", f"((({W[5]} & 127) * 65536 + {W[6]})::DOUBLE / pow(2.0::DOUBLE, 24))", f"{W[5]} + {W[6]} = 0"))
_decoded("DEC12", _GPS32, "FLOAT32_GPS", 5, 2)
_decoded("DEC13", _gps(f"({W[8]} >> 15)", f"(({W[8]} >> 7) & 255)", f"({W[8]} & 127)::DOUBLE / pow(2.0::DOUBLE, 8) + {W[9]}::DOUBLE / pow(2.0::DOUBLE, 24) + {W[10]}::DOUBLE / pow(2.0::DOUBLE, 40) + {W[11]}::DOUBLE / pow(2.0::DOUBLE, 56)", f"{W[8]} + {W[9]} + {W[10]} + {W[11]} = 0"), "FLOAT64_GPS", 8, 4)
_decoded("DEC14", _gps(f"({W[14]} >> 15)", f"({W[12]} & 255)", f"((({W[14]} & 32767) * 16777216 + {W[13]} * 256 + ({W[12]} >> 8))::DOUBLE / pow(2.0::DOUBLE, 40))", f"{W[12]} + {W[13]} + {W[14]} = 0"), "CAPS", 12, 3)
_decoded("DEC15", _FLOAT.format(f"CASE WHEN {W[15]} = 0 THEN 0.0::DOUBLE ELSE (CASE WHEN {W[15]} >= 32768 THEN -1 ELSE 1 END) * (({W[15]} >> 4) & 2047)::DOUBLE * pow(16.0::DOUBLE, ({W[15]} & 15)::DOUBLE) END"), "FLOAT16", 15, 1)
_decoded("DEC16", _ieee(f"({W[16]} >> 15)", f"(({W[16]} >> 4) & 2047)", f"(({W[16]} & 15) * 281474976710656 + {W[17]} * 4294967296 + {W[18]} * 65536 + {W[19]})", 1023, 52, 2047), "FLOAT64_IEEE", 16, 4)
_decoded("DEC16_float32", _FLOAT.format(_ieee(f"({W[20]} >> 15)", f"(({W[20]} >> 7) & 255)", f"(({W[20]} & 127) * 65536 + {W[21]})", 127, 23, 255)), "FLOAT32_IEEE", 20, 2)
_decoded("DEC17", _FLOAT.format(f"CASE WHEN {W[22]} + {W[23]} = 0 THEN 0.0::DOUBLE ELSE pow(2.0::DOUBLE, (({W[23]} & 255) - CASE WHEN ({W[23]} & 255) >= 128 THEN 256 ELSE 0 END)::DOUBLE) * ((({W[22]} & 32767) * 256 + ({W[23]} >> 8))::DOUBLE / pow(2.0::DOUBLE, 23) - CASE WHEN {W[22]} >= 32768 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) END"), "FLOAT32_1750", 22, 2)

_429 = f"WITH {fx.BUS429} SELECT packet, l_linenumber, {{}} AS value FROM bus429"


def _decoded429(name: str, sql: str, column) -> None:
    query(name, _429.format(sql))(lambda spark, sf_dir: fx.bus429(spark, sf_dir).select("packet", "l_linenumber", column().cast("double").alias("value")))


_BCD19 = "((data >> 16) & 7)::DOUBLE * 10000 + ((data >> 12) & 15)::DOUBLE * 1000 + ((data >> 8) & 15)::DOUBLE * 100 + ((data >> 4) & 15)::DOUBLE * 10 + (data & 15)::DOUBLE"
_decoded429("DEC5", _BCD19, lambda: decode.bcd(F.col("data").cast("long"), 19, -1))
_decoded429("DEC5_trailing", "((data >> 15) & 15)::DOUBLE * 10000 + ((data >> 11) & 15)::DOUBLE * 1000 + ((data >> 7) & 15)::DOUBLE * 100 + ((data >> 3) & 15)::DOUBLE * 10 + (data & 7)::DOUBLE", lambda: decode.bcd(F.col("data").cast("long"), 19, 1))
_decoded429("DEC6", f"({_BCD19}) * CASE WHEN SSM = 3 THEN -1 ELSE 1 END", lambda: decode.bcd(F.col("data").cast("long"), 19, -1) * decode.ssm_sign(F.col("SSM")))
_decoded429("DEC7", "(CASE WHEN data >= 262144 THEN -(data & 262143)::DOUBLE ELSE (data & 262143)::DOUBLE END) * (256.0::DOUBLE / 131072)", lambda: decode.sign_magnitude(F.col("data").cast("long"), 19, 256.0))
_decoded429("DEC18", "(CASE WHEN SSM = 3 THEN -1 ELSE 1 END)::DOUBLE", lambda: decode.ssm_sign(F.col("SSM")))
_decoded429("DEC19", "((data * 1024 >> 13) & 32767)::DOUBLE", lambda: decode.raw_field32(F.col("data").cast("long") * 1024, 5, 19))

# --- scans and filters ----------------------------------------------------------------------------------------------


@query("SRC1", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def _src1(spark, sf_dir):
    df = read_parsed(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey long, l_linenumber int, l_quantity double")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("SRC2", f"WITH {fx.BUS1553} SELECT time, channelid, txrtaddr, rxrtaddr, txsubaddr, rxsubaddr, data[1] AS first_word FROM bus1553")
def _src2(spark, sf_dir):
    return fx.bus1553(spark, sf_dir).select(*READ_1553).withColumn("first_word", F.get("data", F.lit(0))).drop("data")


_TYPE = "CASE event_type WHEN 'click' THEN 25 WHEN 'view' THEN 56 WHEN 'error' THEN 17 WHEN 'signup' THEN 1 ELSE 104 END"


@query("FLT1", f"WITH {fx.PACKETS} SELECT *, {_TYPE} AS data_type FROM packets WHERE event_type IN ('click', 'view', 'error', 'signup')")
def _flt1(spark, sf_dir):
    return flatten.only_types(fx.packets(spark, sf_dir).withColumn("data_type", F.expr(_TYPE)), ["1553", "429"])


@query("FLT3", "SELECT event_id, user_id % 2 AS intrapkt_ts_source, event_id % 2 AS secondary_hdr FROM events WHERE user_id % 2 = event_id % 2")
def _flt3(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "user_id % 2 AS intrapkt_ts_source", "event_id % 2 AS secondary_hdr")
    return flatten.conclusive_time(rows)


_PREFIX = "max({bad}::INT) OVER (PARTITION BY packet ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice ROWS UNBOUNDED PRECEDING)"


@query("FLT4", """WITH p AS (SELECT o_orderkey AS packet FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT packet, 0 AS msg_idx, 4 AS length FROM p UNION ALL SELECT packet, 1, 4 FROM p WHERE packet % 3 <> 0""")  # fmt: skip
def _flt4(spark, sf_dir):
    """Every 5th packet announces 10,001 messages, in every 3rd the second message is of 80 bytes."""
    message = lambda n: "00" * 12 + f"{n:02X}00" + "00" * n
    body = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "11270000").otherwise("02000000"), F.lit(message(4)), F.when(F.col("o_orderkey") % 3 == 0, message(80)).otherwise(message(4)))
    packets = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.unhex(body).alias("body"))
    return flatten.messages_1553(packets, "o_orderkey").select("packet", "msg_idx", "length")


_BAD_WORD = "(l_partkey % 50 = 0 OR l_partkey % 70 = 0 OR gaptime * 2000 > 1000000)"


@query("FLT5", f"WITH {fx.BUS429}, m AS (SELECT *, {_PREFIX.format(bad=_BAD_WORD)} AS bad FROM bus429) SELECT packet, l_linenumber, gaptime * 2000 AS gap FROM m WHERE bad = 0")
def _flt5(spark, sf_dir):
    rows = fx.bus429(spark, sf_dir).withColumns({"PE": F.col("l_partkey") % 50 == 0, "FE": F.col("l_partkey") % 70 == 0, "gap": F.col("gaptime").cast("long") * 2000})
    return parse.good_words(rows, by=["packet"], order=fx.WORD_ORDER).select("packet", "l_linenumber", "gap")


@query("FLT6", """WITH p AS (SELECT o_orderkey AS packet FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT packet, 0 AS frame_idx, 2 AS n FROM p UNION ALL SELECT packet, 1, 2 FROM p WHERE packet % 3 <> 0 AND packet % 7 <> 0""")  # fmt: skip
def _flt6(spark, sf_dir):
    """Every 5th packet announces 1,001 frames; in every 3rd the second frame is empty, in every 7th of 9,001 bytes."""
    frame = lambda n, there: "00" * 8 + (n & 255).to_bytes(1, "big").hex() + (n >> 8).to_bytes(1, "big").hex() + "0000" + "00" * there
    second = F.when(F.col("o_orderkey") % 3 == 0, frame(0, 0)).when(F.col("o_orderkey") % 7 == 0, frame(9001, 9001)).otherwise(frame(2, 2))
    body = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "E9030000").otherwise("02000000"), F.lit(frame(2, 2)), second)
    packets = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.unhex(body).alias("body"))
    return flatten.ethernet_frames(packets, "o_orderkey").select("packet", "frame_idx", F.octet_length("frame").alias("n"))


@query("FLT7", """WITH p AS (SELECT l_orderkey, l_linenumber, l_orderkey % 2 = 1 AS stamped, (l_partkey * 3) % 3000 * CASE WHEN l_orderkey % 2 = 1 THEN 196 ELSE 188 END + l_suppkey % 3 * 2 + 2 AS data_size FROM lineitem)
    SELECT * FROM p WHERE CASE WHEN stamped THEN (data_size - 4) % 196 = 0 AND (data_size - 4) / 196 BETWEEN 1 AND 2674 ELSE (data_size - 4) % 188 = 0 AND (data_size - 4) / 188 BETWEEN 1 AND 2788 END""")  # fmt: skip
def _flt7(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "l_orderkey % 2 = 1 AS stamped", "(l_partkey * 3) % 3000 * if(l_orderkey % 2 = 1, 196, 188) + l_suppkey % 3 * 2 + 2 AS data_size")
    return rows.where(flatten.whole_units(F.col("data_size"), F.col("stamped")))


@query("FLT8", f"WITH {fx.FIXES} SELECT pkt_offset, rtc, fix_time FROM valid")
def _flt8(spark, sf_dir):
    return alignment.valid_fixes(fx.time_fixes(spark, sf_dir)).select("pkt_offset", "rtc", "fix_time")


# --- header fields --------------------------------------------------------------------------------------------------


def _split(name: str, sql: str, source, columns) -> None:
    query(name, sql)(lambda spark, sf_dir: source(spark, sf_dir).select(*[c.alias(k) for k, c in columns().items()]))


_CW = lambda: {k: F.col(k) for k in ("tx", "rx")}
_WORD = lambda n: F.get("data", F.lit(n)).cast("int")
_LONG = lambda: _WORD(0).cast("long") * 65536 + _WORD(1)
_split("PRJ1", f"WITH {fx.COMMWORDS} SELECT tx, tx >> 11 AS rtaddr, (tx >> 10) & 1 AS tr, (tx >> 5) & 31 AS subaddr, tx & 31 AS wrdcnt FROM commwords", fx.commwords, lambda: {"tx": F.col("tx")} | bits.command_word(F.col("tx")))
_split("PRJ2", f"WITH {fx.COMMWORDS}, f AS (SELECT tx, rx, channelid = 0 AS rr, channelid = 1 AS t FROM commwords) SELECT tx, rx, CASE WHEN rr THEN rx WHEN t THEN tx ELSE 0 END AS txcommwrd, CASE WHEN rr OR NOT t THEN tx ELSE 0 END AS rxcommwrd FROM f", fx.commwords, lambda: _CW() | bits.transfer(F.col("tx"), F.col("rx"), F.col("channelid") == 0, F.col("channelid") == 1))
_H = f"h AS (SELECT data[1] AS a, data[1] & 31 AS sub, (data[2] & 31) AS wc, (data[3] % 73) AS len, data[4] % 2 = 1 AS rr, data[5] % 2 = 1 AS t FROM bus1553)"
_EXP = "CASE WHEN NOT rr AND sub IN (0, 31) THEN (CASE WHEN wc > 15 THEN 1 ELSE 0 END) WHEN wc = 0 THEN 32 ELSE wc END"
_P = {"sub": lambda: _WORD(0).bitwiseAND(F.lit(31)), "wc": lambda: _WORD(1).bitwiseAND(F.lit(31)), "len": lambda: _WORD(2) % 73, "rr": lambda: _WORD(3) % 2 == 1, "t": lambda: _WORD(4) % 2 == 1}
_IN = lambda: {k: f() for k, f in _P.items()}
_split("PRJ3", f"WITH {fx.BUS1553}, {_H} SELECT sub, NOT (0 < sub AND sub < 31) AS mode FROM h", fx.bus1553, lambda: {"sub": _P["sub"](), "mode": bits.is_mode_code(_P["sub"]())})
_split("PRJ4", f"WITH {fx.BUS1553}, {_H} SELECT sub, wc, rr, {_EXP} AS expected FROM h", fx.bus1553, lambda: {k: _P[k]() for k in ("sub", "wc", "rr")} | {"expected": bits.expected_words(_P["sub"](), _P["wc"](), _P["rr"]())})
_split("PRJ5", f"WITH {fx.BUS1553}, {_H}, e AS (SELECT *, {_EXP} AS expected, (len // 2) - CASE WHEN rr THEN 3 WHEN t THEN 2 ELSE 1 END AS there FROM h) SELECT sub, wc, len, rr, t, least(there, expected) AS calcwrdcnt, there < expected AS incomplete FROM e", fx.bus1553, lambda: _IN() | bits.payload_words(_P["len"](), bits.expected_words(_P["sub"](), _P["wc"](), _P["rr"]()), _P["rr"](), _P["t"]()))
_split("PRJ6", f"""WITH {fx.BUS1553}, {_H}, e AS (SELECT *, {_EXP} AS expected, len // 2 AS n FROM h)
    SELECT sub, wc, len, rr, t, CASE WHEN rr THEN (CASE WHEN n > 2 THEN 2 ELSE -1 END) WHEN sub = 31 THEN -1
        WHEN sub = 0 THEN (CASE WHEN wc > 15 AND NOT t THEN (CASE WHEN n >= 3 THEN 2 ELSE -1 END) WHEN n >= 2 THEN 1 ELSE -1 END)
        WHEN t THEN (CASE WHEN n >= 2 THEN 1 ELSE -1 END) WHEN n >= expected + 2 THEN expected + 1 ELSE -1 END AS status1,
        CASE WHEN rr AND n >= expected + 4 THEN expected + 3 ELSE -1 END AS status2 FROM e""", fx.bus1553, lambda: _IN() | bits.status_places(_P["len"](), _P["sub"](), _P["wc"](), _P["rr"](), _P["t"]()))  # fmt: skip
_bit = lambda x, at: f"(({x} >> {at}) & 1) = 1"
_split("PRJ7", f"WITH {fx.BUS1553} SELECT data[6] AS w, " + ", ".join(f"{_bit('data[6]', at)} AS {n}" for n, at in (("terminal", 0), ("dynbusctrl", 1), ("subsys", 2), ("busy", 3), ("bcastrcv", 4), ("svcreq", 8), ("instr", 9), ("msgerr", 10))) + ", data[6] >> 11 AS rtaddr FROM bus1553", fx.bus1553, lambda: {"w": _WORD(5)} | bits.status_word(_WORD(5)))
_split("PRJ8", f"WITH {fx.BUS1553} SELECT " + ", ".join(f"{_bit('data[7]', at)} AS \"{n}\"" for n, at in (("WE", 3), ("SE", 4), ("WCE", 5), ("TO", 9), ("FE", 10), ("RR", 11), ("ME", 12), ("bus_dir", 13))) + ", data[8] & 255 AS gap1, data[8] >> 8 AS gap2 FROM bus1553", fx.bus1553, lambda: bits.header_1553(_WORD(6), _WORD(7)))
_split("PRJ9", f"WITH {fx.BUS1553}, l AS (SELECT data[1] * 65536 + data[2] AS x FROM bus1553) SELECT x, x & 1048575 AS gap, {_bit('x', 21)} AS \"BS\", {_bit('x', 22)} AS \"PE\", {_bit('x', 23)} AS \"FE\", (x >> 24) & 255 AS bus, x & 255 AS label_raw, (x >> 8) & 3 AS \"SDI\", (x >> 10) & 524287 AS data, (x >> 29) & 3 AS \"SSM\", (x >> 31) & 1 AS parity FROM l", fx.bus1553, lambda: {"x": _LONG()} | bits.header_429(_LONG()) | bits.word_429(_LONG()))
_REV = " + ".join(f"((x >> {i}) & 1) * {1 << (7 - i)}" for i in range(8))
_split("PRJ10", f"WITH {fx.BUS1553}, l AS (SELECT data[1] & 255 AS x FROM bus1553), r AS (SELECT x, {_REV} AS b FROM l) SELECT x, (b >> 6) * 100 + ((b >> 3) & 7) * 10 + (b & 7) AS label FROM r", fx.bus1553, lambda: {"x": _WORD(0).bitwiseAND(F.lit(255)), "label": bits.octal_label(_WORD(0).bitwiseAND(F.lit(255)))})
_split("PRJ11", f"WITH {fx.BUS1553}, l AS (SELECT data[1] * 65536 + data[2] AS x FROM bus1553) SELECT x, {_bit('x', 23)} AS \"BA\", (x >> 24) & 15 AS \"PL\", {_bit('x', 28)} AS \"KLV\", {_bit('x', 29)} AS \"SRS\", {_bit('x', 30)} AS \"IPH\", {_bit('x', 31)} AS \"ET\" FROM l", fx.bus1553, lambda: {"x": _LONG()} | bits.video_flags(_LONG()))


@query("PRJ12", f"WITH {fx.BUS1553} SELECT time, {_FLOAT.format('(data[1] >> 8)::DOUBLE')} AS \"u@01\", {_FLOAT.format('(data[1] >> 8)::DOUBLE * 2')} AS \"u@02\" FROM bus1553")
def _prj12(spark, sf_dir):
    """The versions of a document's multi-format element, each as a column."""
    doc = spark.createDataFrame([("M", f"u@{i:02d}", 0, 1, "UNSIGNEDBITS", 1, 8, 128.0 * i) for i in (1, 2)] + [("M", "plain", 0, 1, "UNSIGNEDBITS", 1, 8, 1.0)], "msg_name string, elem_name string, offset int, elem_word_count int, schema string, bitmsb int, bitlsb int, msb_val double")
    elements = doc.join(translate.versions(doc).select("msg_name", "elem_name"), ["msg_name", "elem_name"], "left_semi").orderBy("elem_name").collect()
    return fx.bus1553(spark, sf_dir).select("time", *[translate.element_1553(e).cast("double").alias(e["elem_name"]) for e in elements])


# --- joins and translation ------------------------------------------------------------------------------------------

_LOOKUP = f"{fx.BUS1553}, {fx.ICD1553}, {fx.BUS_MAP_SQL}, lookup AS (SELECT DISTINCT channelid, msg_name, xmit_word >> 11 AS txrtaddr, (xmit_word >> 5) & 31 AS txsubaddr, dest_word >> 11 AS rxrtaddr, (dest_word >> 5) & 31 AS rxsubaddr FROM icd JOIN bus_map ON bus = bus_name), matched AS (SELECT * FROM bus1553 JOIN lookup USING (channelid, txrtaddr, txsubaddr, rxrtaddr, rxsubaddr))"


def _matched(spark, sf_dir, select_msg=None, ride_along=None):
    return translate.match_1553(fx.bus1553(spark, sf_dir), translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark), select_msg), ride_along)


@query("JN1", f"WITH {fx.FIXES} SELECT p.pkt_offset, p.channelid, p.rtc, v.pkt_offset AS fix_pkt_offset, v.fix_time + (p.rtc * 100 - v.rtc * 100) AS abs_time FROM packets p ASOF JOIN valid v ON p.pkt_offset >= v.pkt_offset")
def _jn1(spark, sf_dir):
    fixes = alignment.valid_fixes(fx.time_fixes(spark, sf_dir)).select("pkt_offset", "rtc", "fix_time")
    rows = alignment.packet_times(fx.packets(spark, sf_dir), fixes, by=[], at="pkt_offset", width=4096)
    return rows.select("pkt_offset", "channelid", "rtc", "fix_pkt_offset", "abs_time")


@query("FLT2", f"WITH {fx.FIXES} SELECT pkt_offset, rtc FROM packets WHERE pkt_offset >= (SELECT min(pkt_offset) FROM valid)")
def _flt2(spark, sf_dir):
    fixes = alignment.valid_fixes(fx.time_fixes(spark, sf_dir)).select("pkt_offset", "fix_time")
    return alignment.asof(fx.packets(spark, sf_dir), fixes, by=[], at="pkt_offset", width=4096).select("pkt_offset", "rtc")


@query("JN2", f"WITH {_LOOKUP} SELECT time, channelid, msg_name, data[1] AS first_word FROM matched")
def _jn2(spark, sf_dir):
    return _matched(spark, sf_dir).select("time", "channelid", "msg_name", F.get("data", F.lit(0)).alias("first_word"))


@query("JN3", f"WITH {_LOOKUP} SELECT b.channelid, b.time, l.msg_name FROM bus1553 b JOIN lookup l ON b.channelid = l.channelid WHERE b.txrtaddr = l.txrtaddr AND b.txsubaddr = l.txsubaddr")
def _jn3(spark, sf_dir):
    lookup = translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark)).select("channelid", "txrtaddr", "txsubaddr", "msg_name")
    return fx.bus1553(spark, sf_dir).join(translate.dimension(lookup), ["channelid", "txrtaddr", "txsubaddr"]).select("channelid", "time", "msg_name")


_LOOKUP429 = f"{fx.BUS429}, {fx.ICD429}, {fx.CHANNELS_SQL}, w AS (SELECT DISTINCT word_name, label, channelid, subchannel - 1 AS bus, sdi FROM icd429 JOIN channels ON upper(icd429.bus) = upper(name)), matched AS (SELECT b.*, w.word_name FROM bus429 b JOIN w ON w.channelid = b.channelid AND w.bus = b.bus AND w.label = b.label AND (w.sdi = b.SDI OR (w.sdi = -1 AND NOT EXISTS (SELECT 1 FROM w x WHERE x.channelid = b.channelid AND x.bus = b.bus AND x.label = b.label AND x.sdi = b.SDI))))"


@query("JN4", f"WITH {_LOOKUP429} SELECT time, channelid, bus, label, SDI, data, word_name FROM matched")
def _jn4(spark, sf_dir):
    return translate.match_429(fx.bus429(spark, sf_dir), translate.lookup_429(fx.icd_429(spark), fx.channels(spark))).select("time", "channelid", "bus", "label", "SDI", "data", "word_name")


@query("JN5", f"WITH {fx.BUS429}, {fx.CHANNELS_SQL} SELECT packet, l_linenumber, upper(name) AS name FROM bus429 b JOIN channels c ON b.channelid = c.channelid AND b.bus + 1 = c.subchannel")
def _jn5(spark, sf_dir):
    return fx.bus429(spark, sf_dir).join(translate.dimension(translate.bus_channels(fx.channels(spark))), ["channelid", "bus"]).select("packet", "l_linenumber", "name")


def _below(tables, along):
    """The tables of all messages, elements as rows, one below the other."""
    out = []
    for m, t in tables.items():
        cells = F.array(*[F.struct(F.lit(c).alias("elem_name"), F.col(c).cast("double").alias("value")) for c in t.columns if c not in along])
        out.append(t.select(*along, F.lit(m).alias("msg_name"), F.explode(cells).alias("e")).select(*along, "msg_name", "e.*"))
    return reduce(DataFrame.unionByName, out)


_WORD32 = "((CASE WHEN parity THEN 2147483648 ELSE 0 END)::BIGINT + SSM::BIGINT * 536870912 + data::BIGINT * 1024)"
_RAW13 = f"(({_WORD32} >> 16) & 8191)"
_VALUES429 = {
    "W120": ("all", f"(({_WORD32} >> 20) & 4095)::DOUBLE"), "W120X": ("one", f"(({_BCD19}) * CASE WHEN SSM = 3 THEN -1 ELSE 1 END)"), "W121": ("temp", f"({_RAW13} - CASE WHEN {_RAW13} >= 4096 THEN 8192 ELSE 0 END)::DOUBLE * (512.0::DOUBLE / 2048)"),
    "W122": ("mag", "(CASE WHEN data >= 262144 THEN -(data & 262143)::DOUBLE ELSE (data & 262143)::DOUBLE END) * (256.0::DOUBLE / 131072)"),
}
_CASES429 = " ".join(f"WHEN '{w}' THEN {{'elem_name': '{e}', 'value': {_FLOAT.format(v)}}}" for w, (e, v) in _VALUES429.items())


@query("TRN2", f"WITH {_LOOKUP429} SELECT time, word_name, e.elem_name AS elem_name, e.value AS value FROM (SELECT time, word_name, CASE word_name {_CASES429} END AS e FROM matched)")
def _trn2(spark, sf_dir):
    """The tables of all words, one below the other."""
    tables, _ = translate.translate_429(fx.bus429(spark, sf_dir), fx.icd_429(spark), fx.channels(spark))
    return reduce(DataFrame.unionByName, [t.select("time", F.lit(w).alias("word_name"), F.lit(t.columns[1]).alias("elem_name"), F.col(t.columns[1]).cast("double").alias("value")) for w, t in tables.items()])


@query("TRN4", f"WITH {_LOOKUP}, m AS (SELECT msg_name, min(elem_name) AS first_elem, count(*) AS elements FROM icd GROUP BY msg_name) SELECT matched.msg_name, elements, count(*) AS rows FROM matched JOIN m USING (msg_name) GROUP BY ALL")
def _trn4(spark, sf_dir):
    messages = translate.message_table(fx.icd_1553(spark)).select("msg_name", "elements")
    return _matched(spark, sf_dir).groupBy("msg_name").agg(F.count("*").alias("rows")).join(messages, "msg_name")


@query("TRN5", f"WITH {_LOOKUP} SELECT msg_name, count(*) AS rows FROM matched WHERE msg_name <> 'NAV_COPY' GROUP BY msg_name")
def _trn5(spark, sf_dir):
    icd = fx.icd_1553(spark).withColumn("elem_word_count", F.when(F.col("msg_name") == "NAV_COPY", 3).otherwise(F.col("elem_word_count")))
    tables, _ = translate.translate_1553(fx.bus1553(spark, sf_dir), icd, fx.bus_map(spark))
    out = None
    for name, t in tables.items():
        one = t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("msg_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out.where("rows > 0")


_TURN = f"({W[4]} - CASE WHEN {W[4]} >= 32768 THEN 65536 ELSE 0 END)::DOUBLE * (64.0::DOUBLE / 16384)"
_VEL = f"({_FIELD2} - CASE WHEN {_FIELD2} >= 4194304 THEN 8388608 ELSE 0 END)::DOUBLE * (512.0::DOUBLE / 2097152)"
_TEMP = f"((({W[8]} >> 7) & 255) - CASE WHEN (({W[8]} >> 7) & 255) >= 128 THEN 256 ELSE 0 END)::DOUBLE * (128.0::DOUBLE / 64)"
_VALUES = {
    "NAV": {"alt": f"({W[0]} >> 4)::DOUBLE", "ok": f"(({W[3]} >> 11) & 1)::DOUBLE", "turn": _FLOAT.format(_TURN), "vel": _FLOAT.format(_VEL)}, "NAV_COPY": {"gps": _GPS32},
    "ENG": {"rpm": f"({W[6]} * 65536 + {W[7]})::DOUBLE * (1024.0::DOUBLE / 2147483648)"}, "ENG_A": {"temp": _FLOAT.format(_TEMP)}, "IDLE": {"none": f"{W[0]}::DOUBLE"},
}
_CASES = " ".join(f"WHEN '{m}' THEN [" + ", ".join(f"{{'elem_name': '{e}', 'value': {v}}}" for e, v in own.items()) + "]" for m, own in _VALUES.items())


@query("TRN6", f"WITH {_LOOKUP} SELECT time, msg_name, e.elem_name AS elem_name, e.value AS value FROM (SELECT time, msg_name, unnest(CASE msg_name {_CASES} END) AS e FROM matched)")
def _trn6(spark, sf_dir):
    return translate.translate_long(_matched(spark, sf_dir), fx.icd_1553(spark))


@query("TRN1", ORACLES["TRN6"])
def _trn1(spark, sf_dir):
    tables, _ = translate.translate_1553(fx.bus1553(spark, sf_dir), fx.icd_1553(spark), fx.bus_map(spark))
    return _below(tables, ["time"])


@query("TRN3", ORACLES["TRN6"].replace("time, msg_name", "time, l_orderkey, l_linenumber, msg_name"))
def _trn3(spark, sf_dir):
    along = ("time", "l_orderkey", "l_linenumber")
    tables, _ = translate.translate_1553(fx.bus1553(spark, sf_dir), fx.icd_1553(spark), fx.bus_map(spark), ride_along=along)
    return _below(tables, list(along))


@query("TRN6_429", ORACLES["TRN2"])
def _trn6_429(spark, sf_dir):
    return translate.translate_long_429(translate.match_429(fx.bus429(spark, sf_dir), translate.lookup_429(fx.icd_429(spark), fx.channels(spark))), fx.icd_429(spark))


_FOUR = "(data[1]::HUGEINT * 281474976710656 + data[2]::HUGEINT * 4294967296 + data[3]::HUGEINT * 65536 + data[4]::HUGEINT)"


@query("TRN6_wide", f"WITH {fx.BUS1553} SELECT time, l_orderkey, l_linenumber, 'NAV' AS msg_name, u.e AS elem_name, CASE u.e WHEN 'four' THEN {_FOUR}::DOUBLE ELSE ((({_FOUR} >> 4) & 1152921504606846975::HUGEINT)::DOUBLE - CASE WHEN data[1] >= 32768 THEN 1152921504606846976.0::DOUBLE ELSE 0.0::DOUBLE END) END AS value FROM bus1553, (VALUES ('four'), ('signed')) u(e)")
def _trn6_wide(spark, sf_dir):
    """Fields of four words."""
    doc = fx.icd_1553(spark).where("elem_name = 'alt'").withColumns({"elem_word_count": F.lit(4), "msb_val": F.lit(0.0), "bitmsb": F.lit(1)})
    doc = doc.withColumns({"elem_name": F.lit("four"), "bitlsb": F.lit(16), "bit_count": F.lit(64)}).unionByName(doc.withColumns({"elem_name": F.lit("signed"), "bitlsb": F.lit(12), "bit_count": F.lit(60), "schema": F.lit("SIGNEDBITS")}))
    along = ("time", "l_orderkey", "l_linenumber")
    return translate.translate_long(fx.bus1553(spark, sf_dir).withColumn("msg_name", F.lit("NAV")), doc, ride_along=along)


@query("FLT9", f"WITH {_LOOKUP} SELECT time, msg_name FROM matched WHERE msg_name IN ('NAV', 'ENG')")
def _flt9(spark, sf_dir):
    return _matched(spark, sf_dir, ["NAV", "ENG"]).select("time", "msg_name")


@query("FLT11", f"WITH {_LOOKUP429} SELECT packet, l_linenumber FROM bus429 b WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.label = b.label AND w.bus = b.bus AND w.channelid = b.channelid)")
def _flt11(spark, sf_dir):
    icd = fx.icd_429(spark)
    lost = translate.unmatched_words(icd, fx.channels(spark))
    known = translate.lookup_429(icd.join(lost, "word_name", "left_anti"), fx.channels(spark)).select("channelid", "bus", "label").distinct()
    return fx.bus429(spark, sf_dir).join(known, ["channelid", "bus", "label"], "left_anti").select("packet", "l_linenumber")


@query("AGG12", f"WITH {_LOOKUP} SELECT msg_name, count(*) AS rows FROM matched GROUP BY msg_name")
def _agg12(spark, sf_dir):
    return translate.translated_names(_matched(spark, sf_dir))


@query("AGG12_429", f"WITH {_LOOKUP429} SELECT channelid, bus, array_to_string(list_sort(list(DISTINCT label)), ',') AS v FROM matched GROUP BY channelid, bus")
def _agg12_429(spark, sf_dir):
    """Labels that are translated, by channel and bus."""
    matched = translate.match_429(fx.bus429(spark, sf_dir), translate.lookup_429(fx.icd_429(spark), fx.channels(spark)))
    rows = metadata.labels_by_bus(matched).select("channelid", F.explode("labels").alias("bus", "labels"))
    return rows.select("channelid", "bus", F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("v"))


# --- bus map --------------------------------------------------------------------------------------------------------

_KEY = "(({tx} & 65504)::BIGINT * 65536 + ({rx} & 65504))"
_VOTES = f"{fx.COMMWORDS}, {fx.ICD1553}, keys AS (SELECT DISTINCT {_KEY.format(tx='xmit_word', rx='dest_word')} AS key, bus_name AS bus FROM icd), seen AS (SELECT DISTINCT channelid, {_KEY.format(tx='tx', rx='rx')} AS key FROM commwords), votes AS (SELECT channelid, bus, count(*) AS votes FROM seen JOIN keys USING (key) GROUP BY ALL)"
_WINNERS = _VOTES + ", top AS (SELECT channelid, count(*) AS tied, min(bus) AS bus FROM (SELECT *, rank() OVER (PARTITION BY channelid ORDER BY votes DESC) AS r FROM votes) WHERE r = 1 GROUP BY channelid), winners AS (SELECT c.channelid, CASE WHEN tied = 1 THEN bus END AS bus, CASE WHEN tied IS NULL THEN 'No Votes' WHEN tied > 1 THEN 'Tie Vote' END AS reason FROM (SELECT DISTINCT channelid FROM commwords) c LEFT JOIN top USING (channelid))"


def _keys(spark):
    return busmap.message_keys(fx.icd_1553(spark))


def _part_sources(spark, sf_dir):
    """Channel names from parts."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("channelid"), F.col("p_name").alias("source"), F.col("p_brand").alias("bus"))


@query("AGG1", f"WITH {fx.COMMWORDS}, a AS (SELECT channelid, tx >> 11 AS addr FROM commwords UNION SELECT channelid, rx >> 11 FROM commwords WHERE rx <> 0) SELECT channelid, array_to_string(list_sort(list(addr)), ',') AS addrs FROM a GROUP BY channelid")
def _agg1(spark, sf_dir):
    bus = fx.commwords(spark, sf_dir).select("channelid", F.col("tx").alias("txcommwrd"), F.col("rx").alias("rxcommwrd"), bits.command_word(F.col("tx"))["rtaddr"].alias("txrtaddr"), bits.command_word(F.col("rx"))["rtaddr"].alias("rxrtaddr"))
    return metadata.remote_terminals(bus).select("channelid", F.array_join(F.transform("addrs", lambda x: x.cast("string")), ",").alias("addrs"))


@query("AGG2", f"WITH {fx.COMMWORDS} SELECT DISTINCT channelid, tx AS txcommwrd, rx AS rxcommwrd FROM commwords")
def _agg2(spark, sf_dir):
    return metadata.command_pairs(fx.commwords(spark, sf_dir).selectExpr("channelid", "tx AS txcommwrd", "rx AS rxcommwrd"))


@query("AGG3", f"WITH {fx.BUS1553} SELECT channelid, min(time) AS min_time FROM bus1553 WHERE l_linenumber = 1 GROUP BY channelid")
def _agg3(spark, sf_dir):
    return metadata.first_video_times(fx.bus1553(spark, sf_dir).withColumn("unit_idx", F.col("l_linenumber") - 1))


def _set429(value: str, by: str) -> str:
    return f"WITH {fx.BUS429} SELECT {by}, array_to_string(list_sort(list(DISTINCT {value})), ',') AS v FROM bus429 GROUP BY {by}"


def _joined(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("v", F.array_join(F.transform(column, lambda x: x.cast("string")), ",")).drop(column)


query("AGG4", _set429("label", "channelid"))(lambda spark, sf_dir: _joined(metadata.labels(fx.bus429(spark, sf_dir)), "labels"))
query("AGG5", _set429("bus", "channelid"))(lambda spark, sf_dir: _joined(metadata.bus_numbers(fx.bus429(spark, sf_dir)), "buses"))


@query("AGG6", _set429("label", "channelid, bus"))
def _agg6(spark, sf_dir):
    rows = metadata.labels_by_bus(fx.bus429(spark, sf_dir)).select("channelid", F.explode("labels").alias("bus", "labels"))
    return _joined(rows, "labels")


@query("AGG7", f"WITH {_VOTES} SELECT channelid, bus, votes FROM votes")
def _agg7(spark, sf_dir):
    return busmap.vote_counts(fx.commwords(spark, sf_dir), _keys(spark))


@query("AGG8", f"WITH {_WINNERS} SELECT channelid, bus, reason FROM winners")
def _agg8(spark, sf_dir):
    words = fx.commwords(spark, sf_dir)
    return busmap.vote_winners(words, busmap.vote_counts(words, _keys(spark)))


@query("WIN4", "WITH t AS (SELECT l_partkey, l_suppkey, sum(l_quantity)::BIGINT AS total FROM lineitem GROUP BY ALL), r AS (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY total DESC) AS r FROM t) SELECT l_partkey, min(l_suppkey) AS l_suppkey, min(total) AS total, count(*) > 1 AS tied FROM r WHERE r = 1 GROUP BY l_partkey")
def _win4(spark, sf_dir):
    """The supplier of most pieces of each part."""
    totals = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("total"))
    return busmap.arg_max(totals, ["l_partkey"], "total", "l_suppkey")


@query("AGG9", f"WITH {_VOTES} SELECT s.channelid, s.key, array_to_string(list_sort(list(DISTINCT bus)), ',') AS v FROM seen s JOIN keys USING (key) GROUP BY ALL")
def _agg9(spark, sf_dir):
    words = fx.commwords(spark, sf_dir).select("channelid", busmap.message_key(F.col("tx"), F.col("rx")).alias("key")).distinct()
    return _joined(words.join(busmap.buses_by_key(_keys(spark)), "key"), "buses")


@query("AGG10", f"WITH {fx.BUS1553}, u AS (SELECT channelid, txrtaddr AS addr FROM bus1553 UNION SELECT channelid, rxrtaddr FROM bus1553) SELECT channelid AS bus_name, array_to_string(list_sort(list(addr)), ',') AS v FROM u GROUP BY channelid")
def _agg10(spark, sf_dir):
    icd = fx.bus1553(spark, sf_dir).select(F.col("channelid").alias("bus_name"), F.col("txrtaddr").alias("xmit_lru_addr"), F.col("rxrtaddr").alias("dest_lru_addr"))
    return _joined(busmap.lru_addresses(icd), "addrs")


@query("AGG11", "SELECT DISTINCT event_type AS data_type FROM events")
def _agg11(spark, sf_dir):
    return metadata.packet_types(fx.packets(spark, sf_dir).withColumnRenamed("event_type", "data_type"))


@query("BUS1", f"WITH {_WINNERS} SELECT channelid, bus, CASE WHEN channelid = 3 THEN 'USER' ELSE 'Vote Method' END AS source FROM (SELECT channelid, bus FROM winners WHERE bus IS NOT NULL AND channelid <> 3 UNION ALL SELECT 3, 'C')")
def _bus1(spark, sf_dir):
    overrides = spark.createDataFrame([(3, "C"), (77, "A")], "channelid int, bus string")
    return busmap.resolve_bus_map(fx.commwords(spark, sf_dir), _keys(spark), fx.tmats(spark), overrides=overrides).bus_map


@query("BUS1_checked", f"WITH {_WINNERS}, {fx.TMATS_SQL}, s AS (SELECT channelid, CASE source WHEN 'spare' THEN 'A and more' ELSE source END AS source FROM tmats) SELECT w.channelid, w.bus, CASE WHEN upper(source) LIKE '%LEFT%' THEN 'Excluded' WHEN w.bus IS NULL THEN w.reason WHEN source IS NULL THEN 'Missing From TMATS' WHEN contains(w.bus, source) OR contains(source, w.bus) THEN 'Vote Method & TMATS' ELSE 'TMATS Mismatch' END AS verdict FROM winners w LEFT JOIN s USING (channelid)")
def _bus1_checked(spark, sf_dir):
    """A vote that attributes must agree with, after corrections of their names, without excluded channels."""
    words, keys = fx.commwords(spark, sf_dir), _keys(spark)
    found = busmap.resolve_bus_map(words, keys, fx.tmats(spark), check_tmats=True, exclusions=spark.createDataFrame([("left",)], "word string"), corrections=spark.createDataFrame([("spare", "A and more")], "old string, new string"))
    verdicts = found.bus_map.select("channelid", F.col("source").alias("verdict")).unionByName(found.excluded.select("channelid", F.col("reason").alias("verdict")))
    winners = busmap.vote_winners(words, busmap.vote_counts(words, keys)).select("channelid", "bus")
    return winners.join(verdicts, "channelid").select("channelid", "bus", "verdict")


@query("BUS2", f"WITH {fx.COMMWORDS}, {fx.TMATS_SQL}, {fx.ICD1553}, r AS (SELECT DISTINCT channelid FROM commwords) SELECT r.channelid, b.bus_name AS bus, CASE WHEN source IS NULL THEN 'Missing From TMATS' WHEN b.bus_name IS NULL THEN 'TMATS Bus Name Not in DTS File' END AS reason FROM r LEFT JOIN tmats USING (channelid) LEFT JOIN (SELECT DISTINCT bus_name FROM icd) b ON source = bus_name")
def _bus2(spark, sf_dir):
    words = fx.commwords(spark, sf_dir)
    return busmap.attribute_winners(busmap.correct_sources(fx.tmats(spark), words), words, _keys(spark))


@query("BUS3", f"WITH {fx.COMMWORDS}, {fx.TMATS_SQL} SELECT DISTINCT channelid, source AS bus, 'TMATS' AS source FROM tmats JOIN commwords USING (channelid) WHERE tmats.source = 'B'")
def _bus3(spark, sf_dir):
    return busmap.resolve_bus_map(fx.commwords(spark, sf_dir), _keys(spark), fx.tmats(spark), use_tmats=True).bus_map


@query("BUS4", f"WITH {fx.COMMWORDS}, {fx.BUS_MAP_SQL}, r AS (SELECT DISTINCT channelid FROM commwords) SELECT r.channelid, CASE WHEN r.channelid = 2 THEN 'Z' WHEN r.channelid = 3 THEN 'C' ELSE bus END AS bus, CASE WHEN r.channelid IN (2, 3) THEN 'USER' ELSE 'Vote Method' END AS source FROM r LEFT JOIN bus_map USING (channelid)")
def _bus4(spark, sf_dir):
    overrides = spark.createDataFrame([(2, "Z"), (3, "C"), (77, "A")], "channelid int, bus string")
    return busmap.apply_overrides(fx.bus_map(spark).withColumn("source", F.lit("Vote Method")), overrides, fx.commwords(spark, sf_dir))


@query("JN9", "SELECT p_partkey AS channelid, CASE WHEN p_name = (SELECT min(p_name) FROM part) THEN 'renamed' ELSE p_name END AS source FROM part WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM lineitem)")
def _jn9(spark, sf_dir):
    recorded = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").alias("channelid"))
    parts = _part_sources(spark, sf_dir)
    corrections = parts.agg(F.min("source").alias("old")).withColumn("new", F.lit("renamed"))
    return busmap.correct_sources(parts, recorded, corrections)


@query("JN10", "SELECT p_partkey AS channelid, CASE WHEN p_partkey % 3 = 0 THEN substr(p_name, 1, 4) WHEN p_partkey % 3 = 1 THEN p_name || ' X' ELSE 'other' END AS bus FROM part WHERE p_partkey % 3 < 2")
def _jn10(spark, sf_dir):
    parts = _part_sources(spark, sf_dir)
    bus = F.when(F.col("channelid") % 3 == 0, F.substring("source", 1, 4)).when(F.col("channelid") % 3 == 1, F.concat("source", F.lit(" X"))).otherwise("other")
    return busmap.names_agree(parts.select("channelid", bus.alias("bus")), parts.select("channelid", "source"))


@query("JN11", "SELECT p_partkey AS channelid, p_name AS source FROM part WHERE NOT contains(upper(p_name), 'A')")
def _jn11(spark, sf_dir):
    parts = _part_sources(spark, sf_dir).select("channelid", "source")
    return parts.join(busmap.excluded(parts, "source", spark.createDataFrame([("a",)], "word string")), "channelid", "left_anti")


@query("FLT10", "SELECT p_partkey AS channelid, w AS word FROM part, (VALUES ('or'), ('e')) t(w) WHERE contains(upper(p_name), upper(w))")
def _flt10(spark, sf_dir):
    return busmap.excluded(_part_sources(spark, sf_dir), "source", spark.createDataFrame([("or",), ("e",)], "word string"))


@query("SET1", f"WITH {fx.BUS1553} SELECT channelid, txrtaddr AS addr FROM bus1553 UNION SELECT channelid, rxrtaddr FROM bus1553")
def _set1(spark, sf_dir):
    bus = fx.bus1553(spark, sf_dir)
    return bus.select("channelid", F.col("txrtaddr").alias("addr")).unionByName(bus.select("channelid", F.col("rxrtaddr").alias("addr"))).distinct()


@query("SET2", "SELECT p_partkey AS channelid FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_linenumber > 3")
def _set2(spark, sf_dir):
    mapped = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linenumber > 3").select(F.col("l_partkey").alias("channelid"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("channelid")).join(mapped, "channelid", "left_anti")


@query("SET3", "SELECT p_partkey AS channelid FROM part INTERSECT SELECT l_partkey FROM lineitem WHERE l_linenumber > 3")
def _set3(spark, sf_dir):
    recorded = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linenumber > 3").select(F.col("l_partkey").alias("channelid"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("channelid")).intersect(recorded)


# --- attributes -----------------------------------------------------------------------------------------------------


def _attrs(spark, sf_dir):
    return attrs.attributes(fx.tmats_lines(spark, sf_dir))


@query("STR1", r"SELECT 'R-' || p_partkey || '\TK1-' || p_size AS code, (p_partkey % 16)::VARCHAR AS value FROM part")
def _str1(spark, sf_dir):
    return _attrs(spark, sf_dir).where(F.col("code").rlike(text.code_pattern(r"R-x\TK1-n")))


@query("JN6", "SELECT (p_partkey % 16)::VARCHAR AS key, p_name AS value FROM part")
def _jn6(spark, sf_dir):
    return attrs.map_attrs(_attrs(spark, sf_dir), r"R-x\TK1-n", r"R-x\DSI-n", ["x", "n"])


@query("JN6_list", "SELECT (p_partkey % 16)::VARCHAR AS key, p_partkey::VARCHAR || ':' || p_name AS value FROM part")
def _jn6_list(spark, sf_dir):
    """Each key with its names by part number, a row for each entry."""
    rows = _attrs(spark, sf_dir).select(F.when(F.col("code").rlike(r"TK1"), F.concat(F.lit("K-"), F.regexp_extract("code", r"R-(\d+)", 1))).when(F.col("code").rlike("DSI"), F.concat(F.lit("V-"), F.regexp_extract("code", r"R-(\d+)", 1))).alias("code"), "value").where("code is not null")
    keyed = rows.where("code like 'K-%'").select(F.concat(F.lit("G-"), "value").alias("code"), "value").distinct()
    parts = rows.where("code like 'K-%'").select(F.substring("code", 3, 20).alias("p"), F.col("value").alias("g")).join(rows.where("code like 'V-%'").select(F.substring("code", 3, 20).alias("p"), "value"), "p")
    listed = keyed.unionByName(parts.select(F.concat(F.lit("G-"), "g", F.lit("\\N-"), "p").alias("code"), "value"))
    found = attrs.map_attrs_list(listed, r"G-x", r"G-x\N-n", ["x"], ["n"])
    return found.select("key", F.explode("by_index").alias("n", "name")).select("key", F.concat_ws(":", F.col("n").cast("string"), "name").alias("value"))


@query("JN7", "SELECT p_partkey AS channelid, p_partkey % 16 AS subchannel, p_name AS name FROM part")
def _jn7(spark, sf_dir):
    a = _attrs(spark, sf_dir)
    sub = attrs.indexed(a, r"R-x\TK1-n", ["channelid", "idx"], "subchannel").withColumn("subchannel", F.col("subchannel").cast("long"))
    return attrs.subchannel_names(sub, attrs.indexed(a, r"R-x\DSI-n", ["channelid", "idx"], "name"))


@query("JN8", "SELECT p_partkey AS channelid, p_name AS source FROM part WHERE p_size % 2 = 0")
def _jn8(spark, sf_dir):
    a = _attrs(spark, sf_dir)
    types = attrs.indexed(a, r"R-x\CDT-n", ["channelid", "n"], "type")
    return attrs.of_type(attrs.indexed(a, r"R-x\DSI-n", ["channelid", "n"], "source"), types, attrs.TYPES["1553"]).select("channelid", "source")


@query("STR2", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ''), lambda c: CASE WHEN regexp_matches(c, '^[A-Za-z0-9_.~-]$') THEN c ELSE '%' || lower(printf('%02X', ascii(c))) END), '') AS name FROM part")
def _str2(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", text.percent_encode(F.col("p_name")).alias("name"))


@query("STR3", "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, contains(p_name, 'a') AS has, replace(p_brand, '#', '-') AS rep, array_to_string(string_split(p_type, ' '), '/') AS parts, rtrim(p_name, 'ety') AS trimmed FROM part")
def _str3(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.contains("p_name", F.lit("a")).alias("has"), F.replace("p_brand", F.lit("#"), F.lit("-")).alias("rep"), F.array_join(F.split("p_type", " "), "/").alias("parts"), F.rtrim("p_name", F.lit("ety")).alias("trimmed"))


_VALUES = "(SELECT doc_id, 'text' AS kind, text AS value FROM documents UNION ALL SELECT doc_id, 'int', (-n_chars)::VARCHAR FROM documents UNION ALL SELECT doc_id, 'float', n_chars::VARCHAR || '.5e-2' FROM documents)"
_VALID = "CASE WHEN {0} IS NOT NULL THEN octet_length({0}) > 0 AND TRY(decode({0})) IS NOT NULL END"


@query("STR4", rf"SELECT doc_id, kind, regexp_matches(value, '^[+-]?[0-9]+$') AS is_int, regexp_matches(value, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') AS is_float, value <> '' AND strlen(value) = length(value) AS is_ascii, {_VALID.format('encode(value)')} AS is_utf8, {_VALID.format('encode(value)[1:50]')} AS is_utf8_cut FROM {_VALUES}")
def _str4(spark, sf_dir):
    """All predicates over whole texts and numbers as text; is_utf8_cut is that of the first 50 bytes, which may end within a character."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = F.col("n_chars").cast("string")
    kinds = {"text": F.col("text"), "int": (-F.col("n_chars")).cast("string"), "float": F.concat(number, F.lit(".5e-2"))}
    rows = docs.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])).alias("v")).select("doc_id", "v.*")
    value, data = F.col("value"), F.col("value").cast("binary")
    return rows.select("doc_id", "kind", text.is_integer(value).alias("is_int"), text.is_number(value).alias("is_float"), ((value != "") & text.is_ascii(value)).alias("is_ascii"), text.is_valid_utf8(data).alias("is_utf8"), text.is_valid_utf8(F.substring(data, 1, 50)).alias("is_utf8_cut"))


@query("STR5", "SELECT doc_id, sha256(sha256(text) || '2020-01-01' || '1.0' || source) AS uid FROM documents")
def _str5(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.uid(F.sha2("text", 256), F.lit("2020-01-01"), F.lit("1.0"), F.col("source")).alias("uid"))


@query("ARR1", f"WITH {fx.BUS1553} SELECT time, data[3] AS one, array_to_string(data[5:8], ',') AS part, array_to_string(list_concat(data[1:l_linenumber], list_transform(range(8 - l_linenumber), lambda i: 0)), ',') AS pad FROM bus1553")
def _arr1(spark, sf_dir):
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return fx.bus1553(spark, sf_dir).select("time", F.get("data", F.lit(2)).alias("one"), join(F.slice("data", 5, 4)).alias("part"), join(text.padded(F.slice("data", F.lit(1), F.col("l_linenumber")), 8)).alias("pad"))


# --- time -----------------------------------------------------------------------------------------------------------

_T = "SELECT l_orderkey, l_linenumber, {} AS t FROM parts"


def _timed(name: str, sql: str, column) -> None:
    query(name, f"WITH {fx.TIME_PARTS} " + _T.format(sql))(lambda spark, sf_dir: fx.time_parts(spark, sf_dir).select("l_orderkey", "l_linenumber", column().alias("t")))


_c = F.col
_timed("TIM1", "((greatest(d, 1) - 1) * 86400 + h * 3600 + m * 60 + s) * 1000000000 + ms * 1000000", lambda: timebase.irig_day(_c("d"), _c("h"), _c("m"), _c("s"), _c("ms")))
_timed("TIM2", "epoch_us(make_timestamp(y, mo, dd, h, m, s::DOUBLE)) * 1000 + ms * 1000000", lambda: timebase.calendar(_c("y"), _c("mo"), _c("dd"), _c("h"), _c("m"), _c("s"), _c("ms")))
_timed("TIM3", "(l_orderkey * 1000003 + l_linenumber) * 100", lambda: timebase.rtc(_c("l_orderkey") * 1000003 + _c("l_linenumber")))
_timed("TIM4", "d * 655360000000 + l_orderkey % 65536 * 10000000 + ms * 1000", lambda: timebase.binary_weighted(_c("d"), _c("l_orderkey") % 65536, _c("ms")))
_timed("TIM5", "l_orderkey * 1000000000 + ms", lambda: timebase.ieee_1588(_c("l_orderkey"), _c("ms")))
_timed("TIM6", "ms * 4294967296 + l_orderkey", lambda: timebase.ertc(_c("ms"), _c("l_orderkey")))
_timed("TIM7", "CASE WHEN s % 2 = 0 THEN l_orderkey * 100 WHEN h % 4 = 0 THEN d * 655360000000 + m * 10000000 + ms * 1000 WHEN h % 4 = 1 THEN l_orderkey * 1000000000 + ms WHEN h % 4 = 2 THEN ms * 4294967296 + l_orderkey ELSE -1 END", lambda: F.coalesce(timebase.intra_packet(_c("s") % 2, _c("h") % 4, timebase.rtc(_c("l_orderkey")), timebase.binary_weighted(_c("d"), _c("m"), _c("ms")), timebase.ieee_1588(_c("l_orderkey"), _c("ms")), timebase.ertc(_c("ms"), _c("l_orderkey"))), F.lit(-1)))
_timed("TIM9", "CASE WHEN s % 2 = 0 THEN l_orderkey * 100 ELSE d * 1000 END", lambda: timebase.unit_time(_c("s") % 2 == 0, timebase.rtc(_c("l_orderkey")), _c("d").cast("long") * 1000))

_GAP = "sum(gaptime) OVER (PARTITION BY packet ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice ROWS UNBOUNDED PRECEDING)"


@query("WIN1", f"WITH {fx.BUS429} SELECT packet, l_linenumber, l_partkey, {_GAP}::BIGINT AS gap_sum FROM bus429")
def _win1(spark, sf_dir):
    return fx.bus429(spark, sf_dir).select("packet", "l_linenumber", "l_partkey", alignment.running_sum(F.col("gaptime"), by=["packet"], order=fx.WORD_ORDER).alias("gap_sum"))


@query("TIM8", f"WITH {fx.BUS429} SELECT packet, l_linenumber, l_partkey, packet * 1000 + {_GAP}::BIGINT * 100 AS t FROM bus429")
def _tim8(spark, sf_dir):
    return fx.bus429(spark, sf_dir).select("packet", "l_linenumber", "l_partkey", (F.col("packet") * 1000 + alignment.running_sum(F.col("gaptime"), by=["packet"], order=fx.WORD_ORDER) * 100).alias("t"))


@query("WIN2", f"WITH {fx.BUS429}, m AS (SELECT *, {_PREFIX.format(bad='(data % 11 = 0)')} AS bad FROM bus429) SELECT packet, l_linenumber, data FROM m WHERE bad = 0")
def _win2(spark, sf_dir):
    return alignment.until_error(fx.bus429(spark, sf_dir), F.col("data") % 11 == 0, by=["packet"], order=fx.WORD_ORDER).select("packet", "l_linenumber", "data")


@query("WIN3", f"WITH {fx.PACKETS} SELECT channelid, pkt_offset, coalesce(last_value(CASE WHEN pkt_offset % 7 = 0 THEN rtc END IGNORE NULLS) OVER (PARTITION BY channelid ORDER BY pkt_offset ROWS UNBOUNDED PRECEDING), -1) AS fix FROM packets")
def _win3(spark, sf_dir):
    rows = fx.packets(spark, sf_dir).withColumn("fix", F.when(F.col("pkt_offset") % 7 == 0, F.col("rtc")))
    return alignment.carry_forward(rows, "fix", by=["channelid"], order=["pkt_offset"], width=4096).select("channelid", "pkt_offset", F.coalesce("fix", F.lit(-1)).alias("fix"))


@query("SRT2", "SELECT l_orderkey AS channelid, array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS labels FROM lineitem GROUP BY l_orderkey")
def _srt2(spark, sf_dir):
    """Sets of a great many groups, each sorted; repeats go before the sets are gathered."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("channelid"), F.col("l_partkey").alias("label"))
    return metadata.labels(rows).select("channelid", F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"))

# --- flattening -----------------------------------------------------------------------------------------------------

_HEX = lambda c, n: F.lpad(F.hex(c.cast("long")), 2 * n, "0")


def _little(c, n):
    """n bytes, least significant first."""
    return F.unhex(F.concat(*[_HEX(F.shiftright(c.cast("long"), 8 * i).bitwiseAND(F.lit(255)), 1) for i in range(n)]))


@query("EXP2", f"WITH {fx.BUS429} SELECT packet, gaptime AS gap, label - 120 AS label_raw, SDI AS \"SDI\", data, SSM AS \"SSM\" FROM bus429")
def _exp2(spark, sf_dir):
    word = F.col("label") - 120 + F.col("SDI") * 256 + F.col("data").cast("long") * 1024 + F.col("SSM").cast("long") * F.lit(1 << 29)
    record = F.struct(*fx.WORD_ORDER, F.concat(_little(F.col("gaptime"), 4), _little(word, 4)).alias("r"))
    packets = fx.bus429(spark, sf_dir).groupBy("packet").agg(F.array_sort(F.collect_list(record)).alias("r"))
    body = F.aggregate("r", F.unhex(F.lit("00000000")), lambda a, x: F.concat(a, x["r"]))
    return flatten.parsed_429(flatten.words_429(packets.select("packet", body.alias("body")))).select("packet", "gap", "label_raw", "SDI", "data", "SSM")


_UNIT = "'47' || lower(printf('%02X', p_partkey % 256)) || repeat('ab', 185) || '0' || u.i"


@query("EXP5", f"SELECT p_partkey, u.i AS unit_idx, p_partkey % 2 = 1 AS \"IPH\", {_UNIT} AS unit, CASE WHEN p_partkey % 2 = 1 THEN repeat('0' || u.i, 8) ELSE '' END AS stamp FROM part, (VALUES (0), (1), (2)) u(i) WHERE u.i < p_size % 3 + 1")
def _exp5(spark, sf_dir):
    """Units with and without stamps of their own, byte by byte."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", (F.col("p_size") % 3).alias("last"), (F.col("p_partkey") % 2 == 1).alias("stamped"))
    unit = lambda i: F.concat(F.when(F.col("stamped"), F.repeat(F.concat(F.lit("0"), i.cast("string")), 8)).otherwise(""), F.lit("47"), _HEX(F.col("p_partkey") % 256, 1), F.lit("AB" * 185 + "0"), i.cast("string"))
    body = F.concat(F.when(F.col("stamped"), "00000040").otherwise("00000000"), F.array_join(F.transform(F.sequence(F.lit(0), F.col("last")), unit), ""))
    units = flatten.video_units(parts.select("p_partkey", F.unhex(body).alias("body")))
    return units.select("p_partkey", "unit_idx", "IPH", F.lower(F.hex("unit")).alias("unit"), F.coalesce(F.lower(F.hex("stamp")), F.lit("")).alias("stamp"))


@query("EXP4", "SELECT l_orderkey, l_linenumber, '00:11:22:33:44:55' AS dstmac, 2048 AS ethtype, 17 AS ipproto, '10.0.' || l_partkey % 256 || '.' || l_suppkey % 256 AS srcip, (l_orderkey % 65536)::BIGINT AS srcport, (l_partkey % 65536)::BIGINT AS dstport, 6::BIGINT AS payload_sz FROM lineitem")
def _exp4(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ip = F.concat(F.lit("4500002200010000"), F.lit("4011"), F.lit("0000"), F.lit("0A00"), _HEX(F.col("l_partkey") % 256, 1), _HEX(F.col("l_suppkey") % 256, 1), F.lit("0A000001"))
    udp = F.concat(_HEX(F.col("l_orderkey") % 65536, 2), _HEX(F.col("l_partkey") % 65536, 2), F.lit("000E0000"), F.lit("AABBCCDDEEFF"))
    frames = rows.select("l_orderkey", "l_linenumber", F.unhex(F.concat(F.lit("001122334455"), F.lit("66778899AABB"), F.lit("0800"), ip, udp)).alias("frame"))
    return flatten.ethernet_headers(frames).select("l_orderkey", "l_linenumber", "dstmac", "ethtype", "ipproto", "srcip", "srcport", "dstport", "payload_sz")


@query("EXP4_kinds", """WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey + l_linenumber) % 5 AS k FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN k < 3 THEN 2048 WHEN k = 3 THEN 2054 ELSE -1 END AS ethtype, CASE WHEN k = 4 THEN 3 ELSE -1 END AS llcfmt, CASE WHEN k = 4 THEN l_partkey % 256 ELSE -1 END::INT AS llcdsap, CASE k WHEN 0 THEN 17 WHEN 1 THEN 6 WHEN 2 THEN 17 ELSE -1 END AS ipproto,
        CASE WHEN k < 3 THEN '10.0.' || l_partkey % 256 || '.' || l_suppkey % 256 ELSE '' END AS srcip, CASE k WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 100 ELSE -1 END AS ipoffset, CASE WHEN k < 2 THEN l_orderkey % 65536 ELSE -1 END::INT AS srcport,
        CASE WHEN k < 2 THEN l_partkey % 65536 ELSE -1 END::INT AS dstport, CASE k WHEN 0 THEN 6 WHEN 1 THEN 5 WHEN 2 THEN 8 WHEN 3 THEN 7 ELSE 4 END::BIGINT AS payload_sz FROM f""")  # fmt: skip
def _exp4_kinds(spark, sf_dir):
    """UDP, TCP behind IP options, a fragment without ports, another type of payload, and 802.3 with LLC."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("k", (F.col("l_orderkey") + F.col("l_linenumber")) % 5)
    ip = lambda first, offset, proto, more: F.concat(F.lit(first + "0000220001" + offset + "40" + proto + "00000A00"), _HEX(F.col("l_partkey") % 256, 1), _HEX(F.col("l_suppkey") % 256, 1), F.lit("0A000001" + more))
    ports = F.concat(_HEX(F.col("l_orderkey") % 65536, 2), _HEX(F.col("l_partkey") % 65536, 2))
    frame = F.when(F.col("k") == 0, F.concat(F.lit("0800"), ip("45", "0000", "11", ""), ports, F.lit("000E0000" + "AA" * 6)))
    frame = frame.when(F.col("k") == 1, F.concat(F.lit("0800"), ip("46", "4000", "06", "01010101"), ports, F.lit("00" * 8 + "80" + "00" * 19 + "BB" * 5)))
    frame = frame.when(F.col("k") == 2, F.concat(F.lit("0800"), ip("45", "2064", "11", ""), F.lit("CC" * 8)))
    frame = frame.when(F.col("k") == 3, F.lit("0806" + "DD" * 7)).otherwise(F.concat(F.lit("0007"), _HEX(F.col("l_partkey") % 256, 1), F.lit("AA03" + "EE" * 4)))
    found = flatten.ethernet_headers(rows.select("l_orderkey", "l_linenumber", F.unhex(F.concat(F.lit("001122334455" + "66778899AABB"), frame)).alias("frame")))
    numbers = [F.coalesce(F.col(c), F.lit(-1)).cast("int").alias(c) for c in ("ethtype", "llcfmt", "llcdsap", "ipproto", "ipoffset", "srcport", "dstport")]
    return found.select("l_orderkey", "l_linenumber", *numbers, F.coalesce("srcip", F.lit("")).alias("srcip"), "payload_sz")


def _le_sql(parts: list[tuple[str, int]]) -> str:
    return " || ".join(f"lower(printf('%02X', (({x}) >> {8 * i}) & 255))" for x, n in parts for i in range(n))


@query("EXP1", f"WITH {fx.BUS1553} SELECT l_orderkey * 8 + l_linenumber AS packet, 0 AS msg_idx, data[1] AS block_status, 4 AS length, data[2] || ',' || data[3] AS words FROM bus1553")
def _exp1(spark, sf_dir):
    body = F.concat(_little(F.lit(1), 4), F.unhex(F.lit("00" * 8)), _little(_WORD(0), 2), _little(F.lit(0), 2), _little(F.lit(4), 2), _little(_WORD(1), 2), _little(_WORD(2), 2))
    packets = fx.bus1553(spark, sf_dir).select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), body.alias("body"))
    return _joined(flatten.messages_1553(packets, "id"), "words").select("packet", "msg_idx", "block_status", "length", F.col("v").alias("words"))


@query("EXP3", f"WITH {fx.BUS1553} SELECT l_orderkey * 8 + l_linenumber AS packet, 0 AS frame_idx, {_le_sql([('data[1]', 2), ('data[2]', 2)])} AS frame FROM bus1553")
def _exp3(spark, sf_dir):
    body = F.concat(_little(F.lit(1), 4), F.unhex(F.lit("00" * 8)), _little(F.lit(4), 4), _little(_WORD(0), 2), _little(_WORD(1), 2))
    packets = fx.bus1553(spark, sf_dir).select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), body.alias("body"))
    return flatten.ethernet_frames(packets, "id").select("packet", "frame_idx", F.lower(F.hex("frame")).alias("frame"))


@query("VID1", f"WITH {fx.BUS1553} SELECT channelid, time, array_to_string(list_transform(data, lambda w: lower(printf('%04X', w))), '') AS chunk FROM bus1553")
def _vid1(spark, sf_dir):
    return flatten.extract_video(fx.bus1553(spark, sf_dir), ["time"]).select("channelid", "time", F.lower(F.hex("chunk")).alias("chunk"))


# --- quality --------------------------------------------------------------------------------------------------------


@query("QLT1", 'SELECT c AS "column", true AS in_both, true AS same_type, n AS rows, CASE c WHEN \'o_totalprice\' THEN d ELSE 0 END::BIGINT AS different, c <> \'o_totalprice\' OR d = 0 AS passed FROM (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 10 = 0) AS d FROM orders), (VALUES (\'o_custkey\'), (\'o_totalprice\')) t(c)')
def _qlt1(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    b = a.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return quality.compare_tables(a, b, ["o_orderkey"])


@query("QLT2", "SELECT 'M' || p_partkey AS msg_name, 'e' AS elem_name, unnest(list_filter([CASE WHEN p_size > 29 THEN 'offset' END, CASE WHEN p_partkey % 5 = 0 THEN 'word count' END], lambda x: x IS NOT NULL)) AS rule FROM part")
def _qlt2(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.when(F.col("p_partkey") % 5 == 0, 3).otherwise(2)
    offset = F.when(F.col("p_size") > 29, 31).otherwise(F.col("p_size") - 1)
    icd = parts.select(F.concat(F.lit("M"), "p_partkey").alias("msg_name"), F.lit("e").alias("elem_name"), F.lit(1).alias("xmit_word"), F.lit(1).alias("dest_word"), F.lit("A").alias("bus_name"), offset.alias("offset"), k.alias("elem_word_count"), F.lit("FLOAT32_GPS").alias("schema"), F.lit(False).alias("is_bitlevel"), F.lit(0).alias("bitmsb"), F.lit(0).alias("bitlsb"), F.lit(0).alias("bit_count"), F.lit(1.0).alias("msb_val"))
    return quality.validate_icd(icd)


@query("QLT3", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _qlt3(spark, sf_dir):
    return quality.duplicates(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("QLT5_words", f"WITH {fx.BUS429}, {fx.CHANNELS_SQL} SELECT channelid, bus, count(*) AS words FROM bus429 b WHERE NOT EXISTS (SELECT 1 FROM channels c WHERE c.channelid = b.channelid AND c.subchannel = b.bus + 1) GROUP BY ALL")
def _qlt5_words(spark, sf_dir):
    known = fx.channels(spark).select("channelid", (F.col("subchannel") - 1).alias("bus"))
    return fx.bus429(spark, sf_dir).groupBy("channelid", "bus").agg(F.count("*").alias("words")).join(known, ["channelid", "bus"], "left_anti")


@query("QLT5", f"""WITH {_WINNERS}, {fx.ICD429}, {fx.CHANNELS_SQL}
    SELECT DISTINCT 'unmatched bus' AS kind, upper(bus) AS name, '' AS detail, 0::BIGINT AS n FROM icd429 WHERE upper(bus) NOT IN (SELECT upper(name) FROM channels)
    UNION ALL SELECT 'excluded channel', channelid::VARCHAR, reason, 0 FROM winners WHERE reason IS NOT NULL
    UNION ALL SELECT 'votes', channelid::VARCHAR, bus, votes FROM votes""")  # fmt: skip
def _qlt5(spark, sf_dir):
    m = busmap.resolve_bus_map(fx.commwords(spark, sf_dir), _keys(spark), fx.tmats(spark))
    return quality.profile_icd_lookup(fx.icd_429(spark), fx.channels(spark), m.excluded, m.votes)


@query("QLT6", f"WITH {fx.BUS429} SELECT time, channelid, bus, label, SDI AS \"SDI\", data, SSM AS \"SSM\", parity FROM bus429")
def _qlt6(spark, sf_dir):
    rows = fx.bus429(spark, sf_dir)
    require_columns(rows, READ_429)
    return rows.select(*READ_429)


@query("SRC6", "SELECT p_partkey, (32 - (p_size % 20 + 9) + CASE WHEN p_size % 20 + 9 < 11 THEN 9 ELSE 11 END) AS bitlsb, (32 - (p_size % 20 + 9) + CASE WHEN p_size % 20 + 9 < 11 THEN 9 ELSE 11 END) - 2 + 1 AS bitmsb FROM part")
def _src6(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("cast(p_partkey as string) AS word_name", "p_name AS elem_name", "120 AS label", "p_brand AS bus", "-1 AS sdi", "1.0D AS rate", "'' AS lru_name", "'UNSIGNEDBITS' AS schema", "p_size % 20 + 9 AS lsb", "2 AS bitcnt", "1.0D AS msb_val", "'' AS description", "'' AS uom", "0 AS classification")
    return bit_positions_429(raw).select(F.col("word_name").cast("long").alias("p_partkey"), "bitlsb", "bitmsb")


@query("SRC7", f"WITH {fx.COMMWORDS} SELECT DISTINCT {_KEY.format(tx='tx', rx='rx')} AS key, 'bus' || channelid AS bus FROM commwords")
def _src7(spark, sf_dir):
    listed = fx.commwords(spark, sf_dir).select((F.col("tx").cast("long") * 65536 + F.col("rx")).alias("key"), F.concat(F.lit("bus"), "channelid").alias("bus"))
    return busmap.message_keys(fx.icd_1553(spark).limit(0), listed)
