"""Bus operators: literal cases, files, and every registered query that doesn't belong to the optional subpackage."""

import json
import math
import os
import random
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from busframe.functions import bits, decode, text, timebase
from busframe.operators import alignment, busmap, flatten, metadata, quality, tmats, translate
from busframe.plans import fixtures as fx
from busframe.sources import icd, packets, tables


def value(spark, schema, words, offset=0, *args, **kwargs):
    df = spark.createDataFrame([(words,)], "data array<int>")
    return df.select(decode.decode(schema, F.col("data"), offset, *args, **kwargs).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "schema, words, args, want",
    [
        ("SIGNEDBITS", [13 << 11], (1, 2, 5, 4.0), -3.0), ("SIGNEDBITS", [3 << 11], (1, 2, 5, 4.0), 3.0), ("SIGNEDBITS", [11 << 11], (1, 2, 5, 4.0), -5.0),
        ("SIGNEDBITS", [8 << 11], (1, 2, 5, 4.0), -8.0), ("UNSIGNEDBITS", [0xFFF0], (1, 1, 12, 0.0), 4095.0), ("UNSIGNEDBITS", [1, 0x8000], (2, 16, 1, 2.0), 3.0),
        ("UNSIGNEDBITS", [0x0800], (1, 5, 5, 0.5), True), ("UNSIGNEDBITS", [0xFFFF] * 4, (4, 1, 16, 0.0), float(2**64)), ("ASCII", [65 << 4], (1, 6, 12, 0.0), 65),
        ("UNSIGNED16", [32768], (1, 0, 0, 100.0), 100.0), ("SIGNED16", [65535], (1, 0, 0, 16384.0), -1.0), ("SIGNED32", [65535, 65534], (2, 0, 0, 0.0), -2.0), ("UNSIGNED32", [1, 2], (2, 0, 0, 0.0), 65538.0),
        ("FLOAT32_GPS", [0, 0], (2,), 0.0), ("FLOAT32_GPS", [1432, 44201], (2,), 3.58935e-36), ("FLOAT32_GPS", [32, 553], (2,), 0.12503), ("FLOAT32_GPS", [32768, 0], (2,), math.nan),
        ("FLOAT16", [0x8011 | 0x10], (1,), -16.0), ("FLOAT64_IEEE", list(struct.unpack(">4H", struct.pack(">d", -1.25e300))), (4,), -1.25e300), ("FLOAT64_IEEE", [0x7FF0, 0, 0, 0], (4,), math.inf),
        ("FLOAT32_IEEE", list(struct.unpack(">2H", struct.pack(">f", 1.5e-40))), (2,), struct.unpack(">f", struct.pack(">f", 1.5e-40))[0]), ("FLOAT32_1750", [0x4000, 2], (2,), 2.0), ("FLOAT32_1750", [0x8000, 0xFF], (2,), -0.5),
    ],
)
def test_decode(spark, schema, words, args, want):
    got = value(spark, schema, words, 0, *args)
    assert math.isnan(got) if isinstance(want, float) and math.isnan(want) else got == pytest.approx(want, rel=5e-5) and type(got) is type(want)


def test_decode_guards(spark):
    assert value(spark, "UNSIGNED16", [1], 5) is None
    with pytest.raises(ValueError):
        decode.decode("CAPS", F.col("data"), 0, 2)
    assert decode.output_type("SIGNEDBITS", 24) == "float" and decode.output_type("SIGNEDBITS", 25) == "double" and decode.output_type("UNSIGNEDBITS", 1) == "boolean"


def test_bcd_and_32_bit(spark):
    df = spark.createDataFrame([(0b10101, 0x12345)], "a long, b long")
    r = df.select(decode.bcd(F.col("a"), 5, 0).alias("drop"), decode.bcd(F.col("a"), 5, 1).alias("last"), decode.bcd(F.col("a"), 5, -1).alias("first"), decode.bcd(F.col("b"), 20).alias("whole"), decode.raw_field32(F.lit(0xABCD1234), 13, 20).alias("mid"), decode.sign_magnitude(F.lit(0b1011), 4, 4.0).alias("mag")).first()
    assert tuple(r) == (10.0, 101.0, 15.0, 12345.0, 0xD1, -3.0)


def test_headers(spark):
    r = spark.range(1).select(*[c.alias(k) for k, c in bits.command_word(F.lit(0b10101_1_00110_01000)).items()], bits.octal_label(F.lit(0b10001010)).alias("label")).first()
    assert tuple(r) == (21, 1, 6, 8, 121)
    r = spark.range(1).select(timebase.irig_day(*map(F.lit, (0, 1, 2, 3, 40))).alias("a"), timebase.calendar(*map(F.lit, (2020, 2, 29, 1, 2, 3, 10))).alias("b")).first()
    assert tuple(r) == ((3600 + 120 + 3) * 10**9 + 40 * 10**6, 1582938123 * 10**9 + 10**7)


def test_text(spark):
    d = spark.createDataFrame([("a b~é",), ("A_-.~/ z",)], "t string")
    assert [r[0] for r in d.select(text.percent_encode(F.col("t"))).collect()] == [None, "A_-.~%2f%20z"]
    assert text.code_pattern(r"R-x\TK1-n") == r"^R\-([0-9]+)\\TK1\-([0-9]+)$"
    n = spark.createDataFrame([("12",), ("-1.5e3",), ("x",)], "t string").select(text.is_integer(F.col("t")), text.is_number(F.col("t"))).collect()
    assert [tuple(r) for r in n] == [(True, True), (False, True), (False, False)]


def test_votes(spark):
    keys = spark.createDataFrame([(1 << 21 | 32, "A"), (2 << 21 | 32, "A"), (1 << 21 | 32, "B"), (0x8020 << 16, "C")], "key long, bus string")
    words = spark.createDataFrame([(0, 32, 32), (0, 64, 33), (1, 32, 35), (2, 0x8021, 3), (3, 1, 1)], "channelid int, tx int, rx int")
    votes = busmap.vote_counts(words, keys)
    got = {r.channelid: (r.bus, r.reason) for r in busmap.vote_winners(words, votes, 1).collect()}
    assert got == {0: ("A", None), 1: (None, "Tie Vote"), 2: ("C", None), 3: (None, "No Votes")}
    assert {r.channelid: r.reason for r in busmap.vote_winners(words, votes, 2).collect()}[2] == "Vote count not >= vote_threshold"
    tm = spark.createDataFrame([(0, "BUS A", "1553IN"), (2, "X", "1553IN")], "channelid int, source string, type string")
    out = busmap.resolve_bus_map(words, keys, tm, check_tmats=True, exclusions=spark.createDataFrame([("x",)], "word string"))
    assert [tuple(r) for r in out.bus_map.collect()] == [(0, "A", "Vote Method & TMATS")]
    assert {r.channelid: r.reason for r in out.excluded.collect()} == {1: "Tie Vote", 2: "Excluded", 3: "No Votes"}


def test_asof(spark):
    p = spark.createDataFrame([("f", i, i) for i in (0, 5, 10, 95, 250)] + [("g", 7, 7)], "file string, pos long, rtc long")
    f = spark.createDataFrame([("f", 5, 1000, 1), ("f", 90, 2000, 2)], "file string, pos long, fix_time long, rtc long")
    out = {r.pos: r.fix_pos for r in alignment.asof(p, f, by=["file"], at="pos", width=100).collect()}
    assert out == {5: 5, 10: 5, 95: 90, 250: 90}
    assert out == {r.pos: r.fix_pos for r in alignment.asof(p, f, by=["file"], at="pos", width=3).collect()}
    assert out == {r.pos: r.fix_pos for r in alignment.asof(p, f, by=["file"], at="pos", width=3, most=0).collect()}
    assert alignment.asof(p, f.limit(0), by=["file"], at="pos", width=3).count() == 0


def test_tmats(spark):
    lines = tmats.lines(spark.createDataFrame([("f", "R-1\\TK1-1:7;\nR-1\\DSI-1:BUS A;\r\nR-1\\TK1-2:9;\nR-1\\DSI-2:B;\njunk\nR-1\\TK1-2-3:no;")], "file string, text string"))
    a = tmats.attributes(lines)
    assert {(r.key, r.value) for r in tmats.map_attrs(a, r"R-x\TK1-n", r"R-x\DSI-n", ["x", "n"]).collect()} == {("7", "BUS A"), ("9", "B")}
    b = spark.createDataFrame([("R-1\\ID", "rec"), ("R-1\\DSI-2", "b"), ("R-1\\DSI-1", "a")], "code string, value string")
    r = tmats.map_attrs_list(b, r"R-x\ID", r"R-x\DSI-n", ["x"], ["n"]).first()
    assert r["values"] == ["a", "b"] and r.by_index == {1: "a", 2: "b"}


YAML = """
translatable_message_definitions:
  m1:
    msg_data: {command: [3104, 0], lru_addr: [1, 0], lru_subaddr: [1, 0], lru_name: [unit, bc], bus: A, wrdcnt: 2, rate: 1, desc: x}
    word_elem:
      w: {off: 0, cnt: 1, schema: SIGNED16, msbval: 16, desc: d}
    bit_elem:
      b: {offset: 1, cnt: 1, schema: UNSIGNEDBITS, msbval: 16, msb: 1, lsb: 5, bitcnt: 5}
  broken: {word_elem: {}}
supplemental_bus_map_command_words:
  A:
  - [12345, 0]
"""
YAML429 = """
translatable_word_definitions:
  w1:
    wrd_data: {label: 121, bus: abc, sdi: 1, rate: 12.5, lru_name: L}
    elem:
      e: {schema: UNSIGNEDBITS, msbval: 2048.0, lsb: 18, bitcnt: 12}
      s: {schema: UNSIGNEDBITS, msbval: 1.0, lsb: 9, bitcnt: 1}
"""


def test_documents(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(YAML)
    (tmp_path / "b.yml").write_text(YAML429)
    got = {r.elem_name: r for r in icd.read_icd_yaml_1553(spark, f"{tmp_path}/a.yaml").collect()}
    assert set(got) == {"w", "b"} and got["b"].is_bitlevel and got["b"].offset == 1 and got["w"].bus_name == "A"
    assert [tuple(r) for r in icd.read_supplemental_keys(spark, f"{tmp_path}/a.yaml").collect()] == [(12345 * 65536, "A")]
    got = {r.elem_name: r for r in icd.read_icd_yaml_429(spark, f"{tmp_path}/b.yml").collect()}
    assert (got["e"].bitmsb, got["e"].bitlsb, got["e"].bus) == (14, 25, "ABC") and (got["s"].bitmsb, got["s"].bitlsb) == (32, 32)
    header = ",".join(x.split()[0] for x in __import__("busframe.schemas", fromlist=["x"]).ICD_1553.split(", "))
    (tmp_path / "c.csv").write_text(header + "\nm,e,1,0,2,A,u,1,v,0,1,0,1.5,0,1,SIGNED16,false,false,0,0,0,0,d,16,V\nbad,line,x\n")
    good, bad = icd.read_icd_csv(spark, f"{tmp_path}/c.csv")
    assert good.count() == 1 and good.first().msb_val == 16.0 and bad.count() == 1
    (tmp_path / "d.csv").write_text("no,header\n")
    with pytest.raises(ValueError):
        icd.read_icd_csv(spark, f"{tmp_path}/d.csv")


def test_validation(spark):
    good = fx.icd_1553(spark)
    assert quality.validate_icd(good).count() == 0
    bad = good.withColumn("schema", F.when(F.col("elem_name") == "gps", "MODE_CODE").when(F.col("elem_name") == "alt", "NOPE").otherwise(F.col("schema"))).withColumn("offset", F.when(F.col("elem_name") == "rpm", 31).when(F.col("elem_name") == "ok", None).otherwise(F.col("offset")))
    assert {(r.elem_name, r.rule) for r in quality.validate_icd(bad).collect()} == {("gps", "not translated"), ("alt", "unknown encoding"), ("alt", "encoding of bit element"), ("rpm", "offset"), ("ok", "required offset")}


def test_compare(spark, tmp_path):
    a = spark.createDataFrame([(1, float("nan"), None, "x"), (2, 1.0, 1, "y")], "k long, d double, n int, s string")
    b = spark.createDataFrame([(1, float("nan"), None, 1), (2, 1.0, 2, 1), (3, 0.0, 0, 1)], "k long, d double, n int, s int")
    got = {r.column: (r.same_type, r.rows, r.different, r.passed) for r in quality.compare_tables(a, b, ["k"]).collect()}
    assert got == {"d": (True, 3, 1, False), "n": (True, 3, 2, False), "s": (False, 3, 3, False)}
    assert all(r.passed for r in quality.compare_tables(a, a, ["k"]).collect())
    assert quality.compare_unordered(a.union(a.limit(1)), a).count() == 1
    for d, x in (("p", b"1"), ("q", b"2")):
        os.makedirs(tmp_path / d)
        (tmp_path / d / "same").write_bytes(b"0")
        (tmp_path / d / "other").write_bytes(x)
    (tmp_path / "p" / "only").write_bytes(b"3")
    for d, x in (("p", b"4"), ("q", b"5")):  # one base name in two directories, and empty files
        for sub, content in (("x", b"0"), ("y", x), ("z", b"")):
            os.makedirs(tmp_path / d / sub)
            (tmp_path / d / sub / "001").write_bytes(content)
    (tmp_path / "q" / "x" / "empty").write_bytes(b"")
    want = {"same": True, "other": False, "only": False, "x/001": True, "y/001": False, "z/001": True, "x/empty": False}
    assert {r.name: r.equal for r in quality.compare_files(spark, f"{tmp_path}/p", f"{tmp_path}/q").collect()} == want


def test_compare_positions_moves_differing_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_ROWS", 100)
    rows = spark.range(1000).selectExpr("id", "id * 2 AS v", "map('k', id) AS m", "array(id) AS a")
    for name, changed in (("a", -1), ("b", 555)):
        rows.withColumn("v", F.when(F.col("id") == changed, None).otherwise(F.col("v"))).repartition(2, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/{name}")
    sides = [quality._positions(spark, f"{tmp_path}/{x}") for x in "ab"]
    blocks = quality.differing_blocks(*sides, ["id", "v", "m", "a"]).collect()
    assert len(blocks) >= 10 and sum(b.rows for b in blocks) == 1000 and sum(b.rows for b in blocks if b.differs) <= 100
    found = {r.column: (r.rows, r.different, r.passed) for r in quality.compare_positions(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()}
    assert found == {"id": (1000, 0, True), "v": (1000, 1, False), "m": (1000, 0, True), "a": (1000, 0, True)}
    rows.select("id", F.col("v").cast("string").alias("v")).coalesce(1).write.parquet(f"{tmp_path}/c")
    rows.select("id", "v", F.lit(1).alias("more")).limit(990).coalesce(1).write.parquet(f"{tmp_path}/d")
    found = {r.column: (r.in_both, r.same_type, r.rows, r.different, r.passed) for r in quality.compare_positions(spark, f"{tmp_path}/c", f"{tmp_path}/d").collect()}
    assert found == {"id": (True, True, 1000, 10, False), "v": (True, False, 1000, 1000, False), "more": (False, False, 1000, 1000, False)}


def test_compare_file_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "_FAN", 3)
    for d in "ab":
        (tmp_path / d / "sub").mkdir(parents=True)
    data = bytes(range(256)) * 40
    pairs = {"same": (data, data), "late": (data, data[:9999] + b"x" + data[10000:]), "longer": (data, data + b"y"), "empty": (b"", b""), "sub/short": (b"q", b""), "sub/one": (b"only", None)}
    for name, (a, b) in pairs.items():
        (tmp_path / "a" / name).write_bytes(a)
        if b is not None:
            (tmp_path / "b" / name).write_bytes(b)
    found = {r.name: r for r in quality.compare_files(spark, f"{tmp_path}/a", f"{tmp_path}/b", block=100).collect()}
    assert {n: (r.equal, r.first_difference) for n, r in found.items()} == {"same": (True, None), "late": (False, 9900), "longer": (False, 10200), "empty": (True, None), "sub/short": (False, 0), "sub/one": (False, None)}
    assert found["same"].sha_a == found["same"].sha_b != found["late"].sha_b and found["sub/one"].size_b is None
    lone = quality.compare_files(spark, f"{tmp_path}/a/same", f"{tmp_path}/b/same", block=1 << 20).first()
    assert lone.equal and lone.size_a == len(data)


def test_arg_max(spark):
    rows = [("a", 1.0, "x"), ("a", 3.0, "z"), ("a", 3.0, "y"), ("b", -1.0, "q"), ("b", -2.0, "p"), ("c", None, "q"), ("d", 2.0, None), ("d", 1.0, "w"), (None, 5.0, "n"), ("b", -1.0, "q")]
    df = spark.createDataFrame(rows, "g string, s double, v string").repartition(3)
    assert {tuple(r) for r in busmap.arg_max(df, ["g"], "s", "v").collect()} == {("a", "y", 3.0, True), ("b", "q", -1.0, False), ("d", "w", 1.0, False), (None, "n", 5.0, False)}
    assert busmap.arg_max(df, ["g"], "s", "v")._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_compare_repeated_keys(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (None, "z"), (None, None)], "k long, s string")
    assert [(r.rows, r.different, r.passed) for r in quality.compare_tables(a, a.repartition(3), ["k"]).collect()] == [(5, 0, True)]
    b = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (None, None)], "k long, s string")
    assert quality.compare_tables(a, b, ["k"]).first().different in (1, 2) and quality.compare_tables(a.limit(0), a.limit(0), ["k"]).first().passed
    assert {(r.side, r.k, r.n) for r in quality.repeated_keys(a, b, ["k"]).collect()} == {("a", 1, 3), ("a", None, 2), ("b", 1, 2), ("b", None, 2)}
    for name, values in (("p", [3, 1, 2]), ("q", [3, 2, 1])):
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    assert quality.compare_positions(spark, f"{tmp_path}/p", f"{tmp_path}/p").first().passed
    assert quality.compare_positions(spark, f"{tmp_path}/p", f"{tmp_path}/q").first().different == 2


def test_bad_elements(spark):
    """A bad element takes its message or word out of every kind of translation; no encoding is taken for another."""
    bus = spark.createDataFrame([(i, [i] * 32, 0, 1, 2, 1, 0) for i in range(5)], "time long, data array<int>, channelid int, txrtaddr int, rxrtaddr int, txsubaddr int, rxsubaddr int")
    bad = fx.icd_1553(spark).withColumn("schema", F.when(F.col("elem_name") == "gps", "NOPE").otherwise(F.col("schema")))
    rows = translate.translate_long(translate.match_1553(bus, translate.lookup_1553(bad, fx.bus_map(spark))), bad)
    assert {(r.msg_name, r.elem_name) for r in rows.collect()} == {("NAV", e) for e in ("alt", "ok", "turn", "vel")}
    good = translate.translate_long(translate.match_1553(bus, translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark))), fx.icd_1553(spark))
    tables_, _ = translate.translate_1553(bus, fx.icd_1553(spark), fx.bus_map(spark))
    found = {(r.time, r.msg_name, r.elem_name): r.value for r in good.collect()}
    for name in ("NAV", "NAV_COPY"):
        for r in tables_[name].collect():
            for e in tables_[name].columns[1:]:
                assert found[r.time, name, e] == pytest.approx(float(r[e]), nan_ok=True)
    words = fx.icd_429(spark).withColumn("schema", F.when(F.col("word_name") == "W121", "NOPE").otherwise(F.col("schema"))).withColumn("bit_count", F.when(F.col("word_name") == "W122", 5).otherwise(F.col("bit_count")))
    rows429 = spark.createDataFrame([(1, 0, 0, 120, 1, 7, 0, False)], "time long, channelid int, bus int, label int, SDI int, data int, SSM int, parity boolean")
    found, violations = translate.translate_429(rows429, words, fx.channels(spark))
    assert set(found) == {"W120", "W120X", "LOST"} and {(r.word_name, r.rule) for r in violations.collect()} == {("W121", "unknown encoding"), ("W122", "bit count")}
    with pytest.raises(ValueError):
        decode.decode32("NOPE", F.lit(1), 1, 4)


def test_tall_equals_wide(spark):
    """Every encoding and width by the row-wise decoder, against the expressions made for each element."""

    r, icd = random.Random(1), []
    for i in range(120):
        k = r.choice([1, 1, 2, 3, 4, 5, 7, 8, 11])
        msb, lsb = r.randrange(1, 17), r.randrange(1, 17)
        if k == 1:
            msb, lsb = sorted((msb, lsb))
        n = decode.bit_count(k, msb, lsb)
        icd.append(("M", f"b{i:03d}", 2048, 4096, "A", r.randrange(0, 33 - k), k, r.choice(["UNSIGNEDBITS", "SIGNEDBITS", "ASCII"] if n > 1 else ["UNSIGNEDBITS"]), True, msb, lsb, n, r.choice([0.0, 3.5, 100.0])))
    icd.append(("M", "four", 2048, 4096, "A", 0, 4, "UNSIGNEDBITS", True, 1, 16, 64, 0.0))
    icd += [("M", f"w{s}", 2048, 4096, "A", 3, k, s, False, 0, 0, 0, 50.0) for s, k in decode.WORD_COUNTS.items()]
    doc = spark.createDataFrame(icd, "msg_name string, elem_name string, xmit_word int, dest_word int, bus_name string, offset int, elem_word_count int, schema string, is_bitlevel boolean, bitmsb int, bitlsb int, bit_count int, msb_val double")
    assert quality.validate_icd(doc).count() == 0
    words = [[1, 2, 3, 4] + [0] * 28, [65535] * 32, [32768] + [65535] * 31, [32767] + [65535] * 31, *[[r.randrange(65536) for _ in range(32)] for _ in range(12)]]
    rows = spark.createDataFrame(list(enumerate(words)), "time long, data array<int>").withColumn("msg_name", F.lit("M"))
    wide = rows.select("time", *[translate.element_1553(e).cast("double").alias(e["elem_name"]) for e in doc.collect()]).collect()
    tall = {(x.time, x.elem_name): x.value for x in translate.translate_long(rows, doc).collect()}
    assert tall[0, "four"] == 281483566841860 and len(tall) == 16 * len(icd)
    for x in wide:
        for e, v in x.asDict().items():
            assert e == "time" or tall[x.time, e] == v or v != v and tall[x.time, e] != tall[x.time, e], (e, v, tall[x.time, e])
    for e in icd:  # and the fields as Python's numbers
        if e[8] and e[7] == "UNSIGNEDBITS" and e[11] > 24 and not e[12]:
            for t, w in enumerate(words):
                whole = int.from_bytes(b"".join(x.to_bytes(2, "big") for x in w[e[5] : e[5] + e[6]]), "big")
                assert tall[t, e[1]] == pytest.approx(float(whole >> (16 - e[10]) & (1 << e[11]) - 1), rel=1e-15)


def test_tall_429(spark):

    r, icd = random.Random(2), []
    for i in range(150):
        msb = r.randrange(1, 33)
        lsb = r.randrange(msb, 33)
        icd.append(("W", f"e{i:03d}", 120, "ABC", -1, r.choice(decode.BIT_LEVEL), msb, lsb, lsb - msb + 1, r.choice([-1, 0, 1]), r.choice([0.0, 7.5])))
    icd = [e for e in icd if e[8] > 1 or e[5] == "UNSIGNEDBITS"]
    doc = spark.createDataFrame(icd, fx.icd_429(spark).schema)
    assert quality.validate_icd_429(doc).count() == 0
    words = [(t, 0, 0, 120, r.randrange(4), r.randrange(1 << 19), r.randrange(4), r.random() < 0.5) for t in range(30)]
    rows = spark.createDataFrame(words, "time long, channelid int, bus int, label int, SDI int, data int, SSM int, parity boolean").withColumn("word_name", F.lit("W"))
    wide = rows.select("time", *[translate.element_429(e).cast("double").alias(e["elem_name"]) for e in doc.collect()]).collect()
    tall = {(x.time, x.elem_name): x.value for x in translate.translate_long_429(rows, doc).collect()}
    assert len(tall) == 30 * len(icd)
    for x in wide:
        for e, v in x.asDict().items():
            assert e == "time" or tall[x.time, e] == v, (e, v, tall[x.time, e])


def test_facts_are_not_shuffled(spark):
    """Lookup joins broadcast the counted dimension; bus rows stay where they are."""
    bus = spark.createDataFrame([(i, [i] * 32, 0, 1, 2, 1, 0) for i in range(5)], "time long, data array<int>, channelid int, txrtaddr int, rxrtaddr int, txsubaddr int, rxsubaddr int")
    matched = translate.match_1553(bus, translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark)))
    plan = translate.translate_long(matched, fx.icd_1553(spark))._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join [channelid" in x and "txrtaddr" in x or "Join [msg_name" in x and "BuildRight" in x]
    assert len(joins) == 2 and all("BroadcastHashJoin" in x and "BuildRight" in x for x in joins) and "SortMergeJoin [channelid" not in plan


def test_checked_vote(spark):
    words = spark.createDataFrame([(0, 2048 * i, 0) for i in range(1, 3)] + [(1, 2048, 0), (2, 2048, 0), (3, 9, 9)], "channelid int, tx int, rx int")
    keys = spark.createDataFrame([(i * 2048 * 65536, "A") for i in range(1, 3)], "key long, bus string")
    tmats_ = spark.createDataFrame([(0, "BUS A"), (1, "other")], "channelid int, source string")
    m = busmap.resolve_bus_map(words, keys, tmats_, check_tmats=True)
    assert {tuple(r) for r in m.bus_map.collect()} == {(0, "A", "Vote Method & TMATS")}
    assert {tuple(r) for r in m.excluded.collect()} == {(1, "TMATS Mismatch"), (2, "Missing From TMATS"), (3, "No Votes")}


def test_exclusions_move_no_command_words(spark):
    """Joins by channel take a row a channel and key: exchanges by channel come after those that make them distinct."""
    words = spark.createDataFrame([(i % 2, 2048 * (i % 3) + i % 32, 0) for i in range(3000)], "channelid int, tx int, rx int")
    keys = spark.createDataFrame([(2048 << 16, "A")], "key long, bus string")
    tmats_ = spark.createDataFrame([(0, "A"), (1, "x left")], "channelid int, source string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = busmap.resolve_bus_map(words, keys, tmats_, exclusions=spark.createDataFrame([("LEFT",)], "word string"))
        assert [tuple(r) for r in m.bus_map.collect()] == [(0, "A", "Vote Method")] and [tuple(r) for r in m.excluded.collect()] == [(1, "Excluded")]
        plan = m.votes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin [channelid" in plan and "LeftAnti" in plan and not any("SortMergeJoin" in x and "LeftAnti" in x for x in plan.split("\n"))
    assert [tuple(r) for r in m.votes.collect()] == [(0, "A", 1)]


@pytest.mark.parametrize("block, most", [(16, 0), (4096, 0), (16, 10**6)])
def test_carried_over_blocks(spark, monkeypatch, block, most):
    monkeypatch.setattr(alignment, "BLOCK", block)
    r = random.Random(block)
    p = [(r.randrange(2), r.randrange(400), i) for i in range(200)]
    f = [(r.randrange(2), x, x * 10) for x in r.sample(range(400), 12)]
    for by in ([], ["g"]):
        got = alignment.asof(spark.createDataFrame(p, "g int, at int, id int"), spark.createDataFrame(f, "g int, at int, v int").select(*by, "at", "v"), by=by, at="at", width=5, most=most)
        want = {}
        for g, at, i in p:
            if fits := [(x, v) for k, x, v in f if x <= at and (not by or k == g)]:
                want[i] = max(fits)[1]
        assert {x.id: x.v for x in got.collect()} == want
    rows = spark.createDataFrame([(g, at, i, i if i % 9 == 0 else None) for g, at, i in p] + [(0, None, 999, 5)], "g int, at int, id int, v int")
    order = ["at", "id"]
    a, b = (alignment.carry_forward(rows, "v", by=["g"], order=order, width=w).orderBy("id").collect() for w in (None, 5))
    assert a == b


def test_video_files(spark, tmp_path):
    rows = spark.createDataFrame([(c, i, [c * 100 + i] * 4) for c in (1, 2) for i in range(50)], "channelid int, seq int, data array<int>").repartition(4)
    flatten.write_video(rows, ["seq"], str(tmp_path))
    for c in (1, 2):
        names = sorted(os.listdir(tmp_path / f"channel={c}"))
        stream = b"".join((tmp_path / f"channel={c}" / n).read_bytes() for n in names)
        assert stream == b"".join(struct.pack(">H", c * 100 + i) * 4 for i in range(50))


def test_parsed_tables(spark, tmp_path):
    spark.range(3).selectExpr("id AS a", "'x' AS b").write.parquet(f"{tmp_path}/t")
    spark.range(3).selectExpr("id AS c").write.parquet(f"{tmp_path}/u")
    (tmp_path / "t" / "notes.txt").write_text("side file")
    assert tables.read_parsed(spark, f"{tmp_path}/t", "a long, b string", ["a"]).columns == ["a"]
    with pytest.raises(ValueError):
        tables.read_parsed(spark, f"{tmp_path}/t", "z long")
    with pytest.raises(TypeError):
        tables.read_parsed(spark, f"{tmp_path}/t", "a string")
    spark.range(2).selectExpr("id AS m").write.parquet(f"{tmp_path}/t/rec_metadata.parquet")
    spark.range(2).selectExpr("id AS m").write.parquet(f"{tmp_path}/t/x_TMATS.parquet")
    assert tables.read_parsed(spark, f"{tmp_path}/t").columns == ["a", "b"] and tables.read_parsed(spark, f"{tmp_path}/t").count() == 3
    assert tables.same_schema(spark, [f"{tmp_path}/t", f"{tmp_path}/t"]) and not tables.same_schema(spark, [f"{tmp_path}/t", f"{tmp_path}/u"])


def encode(kind, body, rtc=0, channel=1, flags=0, secondary=b""):
    size = 24 + len(secondary) + len(body)
    body += b"\0" * (-size % 4) + (struct.pack("<I", 0) if flags & 3 == 3 else b"")
    size = 24 + len(secondary) + len(body)
    if flags & 3 == 3:
        data = body[:-4]
        body = data + struct.pack("<I", sum(struct.unpack(f"<{len(data) // 4}I", data)) & 0xFFFFFFFF)
    head = b"\x25\xeb" + struct.pack("<HIIBBBB", channel, size, len(body), 1, 0, flags, kind) + rtc.to_bytes(6, "little")
    return head + struct.pack("<H", sum(struct.unpack("<11H", head)) & 0xFFFF) + secondary + body


def test_recording(spark, tmp_path):
    message = b"\1" * 8 + struct.pack("<3H", 0x2000, 0x0201, 6) + struct.pack("<3H", 0x0C21, 7, 8)
    frame = bytes.fromhex("001122334455" "66778899aabb" "0800" "45000020000100004011" "0000" "0a000001" "0a000002" "04d2162e000c0000" "deadbeef")
    long_message = b"\1" * 8 + struct.pack("<3H", 0, 0, 80) + b"\0" * 80
    stream = [
        encode(1, struct.pack("<I", 0) + b"R-1\\ID:rec;\n", rtc=1), encode(0x19, struct.pack("<I", 3) + message + long_message + message, rtc=2, flags=3), b"\x25\xebgarbage\x25\xeb",
        encode(0x38, struct.pack("<I", 1) + struct.pack("<II", 5, 0x51) + struct.pack("<II", 6, 0x52), rtc=3), encode(0x68, struct.pack("<I", 1) + b"\2" * 8 + struct.pack("<I", len(frame)) + frame, rtc=4),
        encode(0x40, struct.pack("<I", 1 << 30) + (b"\3" * 8 + b"\x47" * 188) * 2, rtc=5), encode(0x19, struct.pack("<I", 1) + message, rtc=6, flags=0x80, secondary=struct.pack("<II", 9, 8) + struct.pack("<HH", 0, 17)),
    ]
    stream[1] = stream[1][:-1] + bytes([stream[1][-1] ^ 1])  # its body checksum is wrong now
    path = tmp_path / "rec.ch10"
    path.write_bytes(b"".join(stream))
    spark.dataSource.register(packets.PacketSource)
    whole = None
    for chunk in (40, 64, 1 << 20):
        df = spark.read.format("ch10").option("chunk", chunk).load(str(path))
        got = sorted(map(tuple, df.select("offset", "data_type", "rtc", "checksum_ok", "sec_ok").collect()))
        whole = whole or got
        assert got == whole
    assert [(k, t, c, s) for _, k, t, c, s in whole] == [(1, 1, True, True), (0x19, 2, False, True), (0x38, 3, True, True), (0x68, 4, True, True), (0x40, 5, True, True), (0x19, 6, True, True)]
    assert [r.rtc for r in spark.read.format("ch10").option("types", "1,56").load(f"file://{path}").collect()] == [1, 3]
    assert spark.read.format("ch10").option("chunk", 40).option("maxChunks", 1).load(str(path)).count() == 1
    df = df.cache()
    assert tmats.attributes(tmats.lines(tmats.read_tmats(df))).first().value == "rec"
    assert flatten.sound(df).count() == 5 and flatten.only_types(df, ["429"]).count() == 2 and flatten.conclusive_time(df).count() == 5
    of = lambda k: df.where(F.col("data_type") == k)
    m = flatten.messages_1553(of(0x19), "rtc").orderBy("packet").collect()
    assert [(r.packet, r.msg_idx, r.words) for r in m] == [(2, 0, [0x0C21, 7, 8]), (6, 0, [0x0C21, 7, 8])]
    w = flatten.parsed_429(flatten.words_429(of(0x38))).orderBy("idx").collect()
    assert [(r.gap, r.label_raw) for r in w] == [(5, 0x51), (6, 0x52)]
    f = flatten.ethernet_headers(flatten.ethernet_frames(of(0x68), "rtc")).first()
    assert (f.dstmac, f.srcip, f.dstip, f.srcport, f.dstport, f.payload_sz) == ("00:11:22:33:44:55", "10.0.0.1", "10.0.0.2", 1234, 5678, 4)
    v = flatten.video_units(of(0x40)).collect()
    assert len(v) == 2 and v[0].stamp == b"\3" * 8 and v[0].unit == b"\x47" * 188


def _nested_file(path, n=300):
    """A recording whose bodies hold packets, some of which reach beyond the body; and garbage."""

    r, out, places = random.Random(3), [], []
    for i in range(n):
        inner = b"".join(encode(0x38, b"\1" * 4 * r.randrange(1, 30), rtc=i, channel=9) for _ in range(r.randrange(4)))
        if i % 7 == 3:  # a header whose packet ends in a later body
            inner += b"\x25\xeb" + struct.pack("<HIIBBBB", 9, 400, 8, 1, 0, 0, 0x38) + b"\0" * 6
            inner += struct.pack("<H", sum(struct.unpack("<11H", inner[-22:])) & 0xFFFF)
        junk = b"\x25\xeb" * (i % 5 == 0) + bytes(r.randrange(256) for _ in range(r.randrange(3)))
        digits = struct.pack("<I4H", 0x200, i % 60 // 10 << 12 | i % 10 << 8, 0, 0x0101, 0x2020)
        made = encode(0x11, digits, rtc=i) if i % 20 == 10 else encode((0x68, 0x19)[i % 2], struct.pack("<I", 0) + inner, rtc=i, flags=3)
        out.append(junk + made)
        places.append(sum(map(len, out)) - len(made))
    path.write_bytes(b"".join(out))
    return places


@pytest.mark.parametrize("chunk", [20, 61, 500, 7777, 1 << 20])
def test_packets_in_bodies(tmp_path, chunk):
    places = _nested_file(tmp_path / "r.ch10")
    files = packets.recordings(str(tmp_path))
    ranges = packets.resolve(files, chunk, packets._here)
    rows = [(o, t, f) for r in ranges for b in packets.packet_batches(r, fixes=True) for o, t, f in zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in ("offset", "rtc", "fix_rtc")), strict=True)]
    assert [o for o, _, _ in rows] == places and [t for _, t, _ in rows] == list(range(300))
    assert [f for _, _, f in rows] == [None if i < 10 else i - (i - 10) % 20 for i in range(300)]


@pytest.mark.parametrize("reading", [True, False])
def test_packets_by_windows(tmp_path, monkeypatch, reading):
    """Headers and bodies are taken a window at a time: Python calls grow with windows, not with packets; windows grow while the chain stays near, and skip bodies where it doesn't."""
    n = 5000
    small = b"".join(encode(0x38, struct.pack("<I", i), rtc=i, flags=3) for i in range(n))
    (tmp_path / "small.ch10").write_bytes(small)
    large = b"".join(encode(0x38, bytes(200_000), rtc=i) for i in range(20))
    (tmp_path / "large.ch10").write_bytes(large)
    seen = []
    headers, body = packets.headers, packets._body
    monkeypatch.setattr(packets, "headers", lambda data: seen.append(len(data)) or headers(data))
    monkeypatch.setattr(packets, "_body", lambda f, at, h: seen.append(0) or body(f, at, h))
    if reading:
        rows = [x for b in packets.packet_batches(packets.Range(f"{tmp_path}/small.ch10", 0, len(small), 0)) for x in zip(*(b.column(k).to_pylist() for k in ("rtc", "checksum_ok")), strict=True)]
        assert rows == [(i, True) for i in range(n)] and len(seen) < 10
    else:
        assert packets.walk(f"{tmp_path}/small.ch10", 0, len(small), None) == (0, len(small), None) and len(seen) < 10
    seen.clear()
    assert packets.walk(f"{tmp_path}/large.ch10", 0, len(large), None)[:2] == (0, len(large)) and sum(seen) <= 20 * packets._WALK


@pytest.mark.parametrize("width", [0, 1, 2, 4])
def test_body_checksums(tmp_path, width):
    """Checksums of each width, of bodies of any length and place; a packet that ends beyond its window; a body shorter than its checksum."""
    r, out, want = random.Random(width), [], []
    for i in range(400):
        data = bytes(r.randrange(256) for _ in range(r.randrange(40) if i != 200 else 3 << 20))
        padded, right = data + b"\0" * (-len(data) % width if width else 0), r.random() < 0.7
        total = sum(int.from_bytes(padded[k : k + width], "little") for k in range(0, len(padded), width)) if width else 0
        body = data + ((total + (not right)) & (1 << 8 * width) - 1).to_bytes(width, "little")
        if i % 50 == 7:
            body, data, right = b"\0" * (width // 2), b"", True
        head = b"\x25\xeb" + struct.pack("<HIIBBBB", 1, 24 + len(body), len(data), 1, 0, {0: 0, 1: 1, 2: 2, 4: 3}[width], 0x38) + i.to_bytes(6, "little")
        out.append(b"\7" * r.randrange(4) + head + struct.pack("<H", sum(struct.unpack("<11H", head)) & 0xFFFF) + body)
        want.append((i, right or not width, data))
    (tmp_path / "r.ch10").write_bytes(b"".join(out))
    rows = [x for b in packets.packet_batches(packets.Range(f"{tmp_path}/r.ch10", 0, 1 << 40, 0)) for x in zip(*(b.column(k).to_pylist() for k in ("rtc", "checksum_ok", "body")), strict=True)]
    assert rows == want


@pytest.mark.parametrize("nested", [False, True])
def test_recorded_events(nested):
    """Recordings are made a file at a time, with the bytes that packets made one by one have."""
    import numpy as np

    from busframe.plans import files

    n = np.array([*range(2100), *range(36_000_000, 36_000_700), (1 << 32) - 1])
    kind, channel, out = np.array([0x19, 0x38, 0x68])[n % 3], n % 8, b""
    for i, k, c in zip(n.tolist(), kind.tolist(), channel.tolist(), strict=True):
        second, body = struct.pack("<QH", 7 * i, 0), struct.pack("<III", 1, i & 0xFFFFF, i)
        second = second + struct.pack("<H", (sum(struct.unpack("<5H", second)) + (i % 21 == 0)) & 0xFFFF) if i % 3 == 0 else b""
        if nested:
            k, body = (packets.CLOCK, files._clock(i)) if i % 50 == 0 else (k, body + files.encode(0x38, body, channel=9) + files.encode(packets.CLOCK, files._clock(1), channel=9))
        made = files.encode(k, body, i, c, 0x83 if second else 3, second, i % 256)
        out += made[:-1] + bytes([made[-1] ^ (i % 11 == 0)])
    assert files.recorded(n, kind, channel, nested) == out and files.recorded(n[:0], n[:0], n[:0], nested) == b""
    with pytest.raises(ValueError, match="32 bits"):
        files.recorded(np.array([1 << 32]), np.array([1]), np.array([1]), nested)


def test_shares_of_small_files():
    """Thousands of small files are no task each, nor each megabyte: what a task costs by itself would be most of its time."""
    many = packets.shares([packets.Range(str(i), 0, 260_000, 0) for i in range(3000)])
    assert len(many) < 150 and sum(len(x.ranges) for x in many) == 3000 and len(packets.shares([packets.Range("", i << 26, i + 1 << 26, 0) for i in range(100)])) == 100


def test_many_documents(spark, tmp_path, monkeypatch):
    """Small documents lie in one directory, are parsed by libyaml, and their rows share batches."""
    import yaml

    from busframe.plans import files

    used = []
    monkeypatch.setattr(yaml, "load", lambda text, Loader, of=yaml.load: used.append(Loader) or of(text, Loader=Loader))
    assert icd.load("a: [off, 1e3, 012, 1_0, ~]") == yaml.safe_load("a: [off, 1e3, 012, 1_0, ~]") and icd.load("") == {}
    assert used[0] is (yaml.CSafeLoader if yaml.__with_libyaml__ else yaml.SafeLoader)
    parts = spark.range(1, 1201).selectExpr("id AS p_partkey", "format_string('  B%d:\\n    - [%d, 1]', id, id) AS entry")
    files._documents(parts, "supplemental_bus_map_command_words:", f"{tmp_path}/docs")
    assert len([x for x in (tmp_path / "docs").glob("part-*.txt") if x.stat().st_size]) == 13 and not [x for x in (tmp_path / "docs").iterdir() if x.is_dir()]
    monkeypatch.setattr(icd, "_ROWS", 150)
    got = icd.read_supplemental_keys(spark, f"{tmp_path}/docs")
    assert {tuple(r) for r in got.collect()} == {(i * 65536 + 1, f"B{i}") for i in range(1, 1201)} and got.count() == 1200


def test_swapped_bytes(spark):
    """As hex digits word by word give them, of any lists, without a lambda that Spark interprets."""
    rows = [(1, [1, -1, 65535, 65536 + 0x1234]), (2, None), (3, []), (4, [None, 7, None]), (5, [0xABCD] * 40)]
    got = spark.createDataFrame(rows, "n int, data array<int>").select("n", flatten.swap_bytes(F.col("data")).alias("chunk"))
    assert "transform" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.n: r.chunk for r in got.collect()} == {1: b"\0\1\xff\xff\xff\xff\x12\x34", 2: None, 3: b"", 4: b"\0\7", 5: b"\xab\xcd" * 40}


def test_few_ranges_and_shares(spark, tmp_path, monkeypatch):
    """However small `chunk` is: a bounded number of ranges is walked, and tasks take many of them."""
    walked = []
    many = packets.resolve([(str(i), 224_000) for i in range(3000)], packets.joined([("", 224_000)] * 3000, 4001), lambda x: walked.extend(x) or [])
    assert not walked and len(many) == 3000 and len(packets.shares(many)) <= 1000
    assert packets.joined([("", 10**6)], 4001) == 4001 and packets.joined([("", 1 << 40)], 4001) > 60 << 20 and packets.joined([("", 1 << 40)], 1 << 30) == 1 << 30
    places = _nested_file(tmp_path / "r.ch10")
    _nested_file(tmp_path / "s.ch10")
    monkeypatch.setattr(packets, "RANGES", 8)
    for most, kept in ((None, places), (100, [p for p in places if p < 2000])):
        options = {"path": str(tmp_path), "chunk": "20", "fixes": "true"} | ({"maxChunks": str(most)} if most else {})
        reader = packets.PacketSource(options).reader(None)
        dealt = reader.partitions()
        rows = [x for p in dealt for b in reader.read(p) for x in b.column(b.schema.get_field_index("offset")).to_pylist()]
        assert rows == kept + kept and len(dealt) == 1 and 2 < len(dealt[0].ranges) <= 10
    df = packets.read_recording(spark, str(tmp_path), 20)
    assert df.rdd.getNumPartitions() == 1 and df.count() == 600


def test_pushed_filters(spark, tmp_path, monkeypatch):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    _nested_file(tmp_path / "r.ch10")
    reader = packets.PacketSource({"path": str(tmp_path), "pushdown": "true"}).reader(None)
    left = GreaterThan(("rtc",), 4)
    assert list(reader.pushFilters([In(("data_type",), (0x19, 0x11)), left, EqualTo(("data_type",), 0x19), EqualTo(("channelid",), 1)])) == [left]
    assert reader.kept == {"data_type": {0x19}, "channelid": {1}}
    bodies = []
    body = packets._body
    monkeypatch.setattr(packets, "_body", lambda f, at, h: bodies.append(h["data_type"]) or body(f, at, h))
    ranges = reader.partitions()
    bodies.clear()  # clock packets of the walk
    rows = [t for r in ranges for b in reader.read(r) for t in b.column(b.schema.get_field_index("rtc")).to_pylist()]
    assert rows == [i for i in range(300) if i % 2 and i % 20 != 10] and set(bodies) == {0x19}
    df = packets.read_recording(spark, str(tmp_path), 1000)
    plan = df.where("data_type = 25 and rtc > 5")._jdf.queryExecution().toString()
    assert "rtc#" in plan and "= 25" not in plan[plan.index("Physical Plan") :]  # no such filter of Spark's is left above the scan
    assert df.where("data_type = 25 and rtc > 5").count() == 147
    assert df.where("data_type = 17").count() == 15 and df.where("file = 'x'").count() == 0
    (tmp_path / "r.ch10").write_bytes(b"")
    assert packets.read_recording(spark, str(tmp_path), 1000).count() == 0


def test_parse_reads_once(spark, tmp_path):
    """Packets of a recording are scanned once and neither joined nor shuffled."""
    from busframe.plans import parse

    _nested_file(tmp_path / "r.ch10")
    df = packets.read_recording(spark, str(tmp_path), 1000)
    for kind in ("1553", "ethernet", "video"):
        plan = parse.PARSERS[kind](df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BatchScan") == 1 and "Join" not in plan and "Exchange" not in plan
    for kind in ("1553", "429", "ethernet", "video"):  # as the join of fixes has it
        loaded = spark.read.format("ch10").load(str(tmp_path))
        rows = [sorted(map(str, parse.PARSERS[kind](x).collect())) for x in (df, loaded)]
        assert rows[0] == rows[1]


def test_sinks(spark, tmp_path):
    bus = spark.createDataFrame([(i, [i] * 32, 0, 1, 2, 1, 0) for i in range(5)], "time long, data array<int>, channelid int, txrtaddr int, rxrtaddr int, txsubaddr int, rxsubaddr int")
    tabs, violations = translate.translate_1553(bus, fx.icd_1553(spark), fx.bus_map(spark))
    assert violations.count() == 0 and tabs["NAV"].count() == 5 and dict(tabs["NAV"].dtypes) == {"time": "bigint", "alt": "float", "ok": "boolean", "turn": "float", "vel": "float"}
    matched = translate.match_1553(bus, translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark)))
    many = matched.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6000)))).drop("copy")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for _ in range(2):  # written again, each file takes its former place
        files = translate.write_tables(many, fx.icd_1553(spark), f"{tmp_path}/out")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.msg_name: r.n for r in files.groupBy("msg_name").agg(F.sum("rows").alias("n")).collect()} == {"NAV": 30_000, "NAV_COPY": 30_000} and 2 < files.count() <= 6
    for name in ("NAV", "NAV_COPY"):
        out = spark.read.parquet(f"{tmp_path}/out/{name}.parquet")
        assert out.dtypes == tabs[name].dtypes and sorted(map(str, out.distinct().collect())) == sorted(map(str, tabs[name].collect()))
        names = os.listdir(f"{tmp_path}/out/{name}.parquet")
        assert len(names) == files.where(F.col("msg_name") == name).count() and not any(x[0] == "_" for x in names)
        for x in names:
            meta = pq.ParquetFile(f"{tmp_path}/out/{name}.parquet/{x}").metadata
            assert all(meta.row_group(i).num_rows <= 10_000 and meta.row_group(i).column(0).statistics.has_min_max for i in range(meta.num_row_groups))
            times = pq.read_table(f"{tmp_path}/out/{name}.parquet/{x}")["time"].to_pylist()
            assert times == sorted(times)
    metadata.write_metadata(spark.createDataFrame([("parsed", "abc")], "type string, uid string"), f"{tmp_path}/md")
    [name] = [x for x in os.listdir(tmp_path / "md") if x.endswith(".json")]
    assert json.loads((tmp_path / "md" / name).read_text()) == {"type": "parsed", "uid": "abc"}


def test_tables_are_decoded_once(spark, tmp_path, monkeypatch):
    """Rows are dealt into ranges before they are decoded, as sampling for the ranges runs what lies below a second time; words of the bus rows are compiled, not a lambda's."""
    plans, wide = [], translate.wide_rows
    monkeypatch.setattr(translate, "wide_rows", lambda matched, icd, **k: plans.append(matched._jdf.queryExecution().executedPlan().toString()) or wide(matched, icd, **k))
    bus = fx.bus1553(spark, SF)
    assert "transform" not in bus._jdf.queryExecution().executedPlan().toString() and len(bus.first().data) == 32
    matched = translate.match_1553(bus, translate.lookup_1553(fx.icd_1553(spark), fx.bus_map(spark)))
    files = translate.write_tables(matched, fx.icd_1553(spark), f"{tmp_path}/out")
    assert len(plans) == 1 and "rangepartitioning" in plans[0]
    assert files.agg(F.sum("rows")).first()[0] == matched.count()


def test_stream(spark, tmp_path):
    from busframe.streaming.translate import stream_long, write_stream

    schema = "time long, data array<int>, channelid int, txrtaddr int, rxrtaddr int, txsubaddr int, rxsubaddr int"
    spark.createDataFrame([(i, [i] * 32, 0, 1, 2, 1, 0) for i in range(5)], schema).write.parquet(f"{tmp_path}/in")
    rows = stream_long(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), fx.icd_1553(spark), fx.bus_map(spark))
    write_stream(rows, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5 * 5


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["DEC3", "DEC13", "JN1", "JN4", "TRN1", "TRN2", "TRN6", "AGG8", "BUS1", "EXP2", "QLT1", "WIN2", "WIN3", "SRC8", "SRC8_nested", "SRC8_pushed", "JN1_recording", "SRC9", "SRC10", "SRC11", "LIM1", "QLT4", "QLT1_positions", "TRN3", "TRN6_429", "TRN6_wide", "WIN4", "SRT1", "SRT2", "EXP1", "EXP3", "EXP4", "EXP4_kinds", "EXP5", "QLT5", "BUS1_checked", "SNK1_groups", "SNK4_document", "SNK2", "SNK5", "SRC4", "SRC5", "QLT2_rules"])
def test_queries(spark, name):
    import duckdb

    import busframe.plans.files  # noqa: F401
    from busframe.plans.catalog import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("lineitem", "events", "part", "orders", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda df: sorted(df[columns].astype(str).itertuples(index=False, name=None))
    assert rows(got) == rows(want) and len(got)


@pytest.mark.parametrize("name", ["STR4", "STR5"])
def test_whole_texts(spark, tmp_path, name):
    import duckdb

    from busframe.plans.catalog import ORACLES, QUERIES

    texts = ["123 Main street", "123", "-7", "1.5e3", "1.", ".", "123\n", "é" * 40, "x" + "é" * 40, "", None, " 12", "1\n2"]
    rows = [(i, t, None if i == 1 else "s", 7 * i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLES[name])
    result = {tuple(r) for r in got.collect()}
    assert got.columns == want.columns and result == set(want.fetchall()) and len(result) == len(rows) * (3 if "4" in name else 1)
    if name == "STR4":
        by = {r[0]: r[2:] for r in result if r[1] == "text"}
        assert by[0] == (False, False, True, True, True) and by[1][:2] == (True, True) and by[3][:2] == (False, True) and by[6][0] is False
        assert by[7] == (False, False, False, True, True) and by[8] == (False, False, False, True, False) and by[10] == (None,) * 5


def test_every_query_has_sql():
    import busframe.plans.files  # noqa: F401
    from busframe.plans.catalog import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)


def test_parse(spark, tmp_path):
    from busframe.plans import parse

    digits = struct.pack("<4H", 0x0312, 0x0102, 0x0229, 0x2020)  # 120 ms, 3 s, 2 min, 1 h, 29 February 2020
    clock = encode(0x11, struct.pack("<I", 0x200) + digits, rtc=1000)
    stamp = (1500).to_bytes(6, "little") + b"\0\0"
    receive = stamp + struct.pack("<3H", 0, 0x0201, 8) + struct.pack("<4H", 0x0822, 7, 8, 0x0800)  # two words to unit 1, then its status
    transmit = stamp + struct.pack("<3H", 0x2008, 0, 6) + struct.pack("<3H", 0x1442, 0x1000, 9)
    frame = bytes.fromhex("001122334455" "66778899aabb" "0800" "45000020000100004011" "0000" "0a000001" "0a000002" "04d2162e000c0000" "deadbeef")
    word = lambda label, data: label | 1 << 8 | data << 10 | 3 << 29
    stream = [
        encode(0x19, struct.pack("<I", 1) + receive, rtc=900), clock, encode(0x19, struct.pack("<I", 2 | 1 << 30) + receive + transmit, rtc=2000),
        encode(0x38, struct.pack("<I", 3) + struct.pack("<6I", 5, word(0x51, 77), 6 | 2 << 24, word(0x51, 78), 1 << 22, word(1, 1)), rtc=2000),
        encode(0x68, struct.pack("<I", 1) + stamp + struct.pack("<I", len(frame)) + frame, rtc=2000), encode(0x40, struct.pack("<I", 1 << 28) + b"\x47\x01" * 94, rtc=2000),
    ]
    (tmp_path / "r.ch10").write_bytes(b"".join(stream))
    spark.dataSource.register(packets.PacketSource)
    df = spark.read.format("ch10").load(f"{tmp_path}/r.ch10").cache()
    at = 1582938123 * 10**9 + 120 * 10**6
    fix = parse.time_fixes(df).first()
    assert (fix.time, fix.src, fix.time_fmt, fix.date_fmt) == (at, 0, 0, True)
    m = parse.parse_1553(df).orderBy("txcommwrd").collect()
    assert len(m) == 2 and m[0].time == at + 500 * 100 and m[0].ttb == 1 and not m[0].doy
    assert (m[0].rxcommwrd, m[0].rxrtaddr, m[0].rxsubaddr, m[0].calcwrdcnt, m[0].incomplete, m[0].data[:3]) == (0x0822, 1, 1, 2, False, [7, 8, 0])
    assert (m[0].statwrd1, m[0].status_rtaddr1, m[0].statwrd2, m[0].gap1, m[0].gap2) == (0x0800, 1, -1, 1, 2)
    w = parse.parse_429(df).orderBy("time").collect()
    assert [(r.time - at - 100_000, r.bus, r.data, r.SDI, r.SSM) for r in w] == [(500, 0, 77, 1, 3), (1100, 2, 78, 1, 3)]
    e = parse.parse_ethernet(df).first()
    assert (e.time, e.dstport, e.payload_sz, e.payload[:5], len(e.payload)) == (at + 50_000, 5678, 4, [0xDE, 0xAD, 0xBE, 0xEF, 0], 1490)
    v = parse.parse_video(df).first()
    assert (v.time, v.KLV, v.IPH, v.data[0], len(v.data), v.unit_idx) == (at + 100_000, True, False, 0x0147, 94, 0)
    parse.write_parsed(parse.parse_429(df), f"{tmp_path}/out", ["time"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    parse.write_attributes(spark.createDataFrame([("a",)], "text string"), f"{tmp_path}/text")
    assert spark.read.text(f"{tmp_path}/text").first()[0] == "a"
