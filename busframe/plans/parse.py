"""Recording packets to parsed tables: clock fixes, 1553 messages, 429 words, ethernet frames, video units; and their sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from busframe.functions import bits, text, timebase
from busframe.operators import alignment, flatten
from busframe.schemas import ARINC429, ETHERNET, MILSTD1553, TIME_FIXES, VIDEO
from busframe.sources.packets import located
from busframe.sources.tables import listing

TIME_TYPE = 0x11
#: Bytes of a recording in one range of the as-of join.
RANGE = 256 << 20
MOST_PAYLOAD, VIDEO_WORDS, MOST_GAP = 1490, 94, 1_000_000


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select(*[F.col(f"`{n}`").cast(kind).alias(n) for n, kind in (x.split(" ", 1) for x in schema.split(", "))])


def time_fixes(packets: DataFrame) -> DataFrame:
    """Fixes of the time packets: file, offset, rtc and the columns of TIME_FIXES. Digits are decimal, four bits each."""
    rows = packets.where(F.col("data_type") == TIME_TYPE)
    w = [flatten.uint(F.col("body"), 4 + 2 * i, 2) for i in range(4)]
    head = flatten.uint(F.col("body"), 0, 4)
    ms = bits.bits(w[0], 0, 4) * 10 + bits.bits(w[0], 4, 4) * 100
    second = bits.bits(w[0], 8, 4) + bits.bits(w[0], 12, 3) * 10
    minute, hour = bits.bits(w[1], 0, 4) + bits.bits(w[1], 4, 3) * 10, bits.bits(w[1], 8, 4) + bits.bits(w[1], 12, 2) * 10
    day = bits.bits(w[2], 0, 4) + bits.bits(w[2], 4, 4) * 10
    year = bits.bits(w[3], 0, 4) + bits.bits(w[3], 4, 4) * 10 + bits.bits(w[3], 8, 4) * 100 + bits.bits(w[3], 12, 2) * 1000
    month = bits.bits(w[2], 8, 4) + bits.bits(w[2], 12, 1) * 10
    dated = bits.is_set(head, 9)
    time = F.when(dated, timebase.calendar(year, month, day, hour, minute, second, ms)).otherwise(timebase.irig_day(day + bits.bits(w[2], 8, 2) * 100, hour, minute, second, ms))
    found = rows.withColumns({"time": time, "src": bits.bits(head, 0, 4), "time_fmt": bits.bits(head, 4, 4), "leap_yr": bits.is_set(head, 8), "date_fmt": dated})
    return found.select("file", "offset", "rtc", *_names(TIME_FIXES))


def timed(packets: DataFrame, kind: str) -> DataFrame:
    """Sound packets of a kind with the fix that holds for them (fix_rtc, fix_time, doy), and a packet number `id`.

    Packets of read_recording() have it from the reader, so that they are read once and not shuffled; others are joined with
    the fixes among them.
    """
    rows = flatten.conclusive_time(flatten.sound(packets)).where(F.col("data_type") == flatten.TYPES[kind])
    if "fix_time" in packets.columns:
        rows = rows.where("fix_time is not null")
    else:
        fixes = alignment.valid_fixes(time_fixes(flatten.sound(packets))).select("file", "offset", F.col("rtc").alias("fix_rtc"), F.col("time").alias("fix_time"), (~F.col("date_fmt")).alias("doy"))
        rows = alignment.asof(rows, fixes, by=["file"], at="offset", width=RANGE)
    return rows.withColumn("id", F.xxhash64("file", "offset"))


def _stamp(raw: Column) -> Column:
    """Time of an 8-byte stamp that holds the relative counter."""
    return timebase.absolute(flatten.uint(raw, 0, 6), F.col("fix_rtc"), F.col("fix_time"))


#: What a message or frame needs of its packet.
_OF_PACKET = ("channelid", "doy", "fix_rtc", "fix_time", "rtc", "head")


def _with_head(packets: DataFrame) -> DataFrame:
    return packets.withColumn("head", flatten.uint(F.col("body"), 0, 4))


def parse_1553(packets: DataFrame) -> DataFrame:
    """MILSTD1553 rows of a recording's packets."""
    m = flatten.messages_1553(_with_head(timed(packets, "1553")), "id", keep=_OF_PACKET).withColumnRenamed("time", "stamp")
    m = m.withColumns(bits.header_1553(F.col("block_status"), F.col("gaps")))
    word = lambda i: F.coalesce(F.get("words", i if isinstance(i, Column) else F.lit(i)), F.lit(0))
    first = {f"__{k}": c for k, c in bits.command_word(word(0)).items()}
    m = m.withColumns(first | {"__t": bits.is_set(word(0), 10)})
    sub, wc, rr, t = F.col("__subaddr"), F.col("__wrdcnt"), F.col("RR"), F.col("__t")
    m = m.withColumns({"totwrdcnt": bits.expected_words(sub, wc, rr), "mode": bits.is_mode_code(sub)} | {f"__{k}": c for k, c in bits.status_places(F.col("length"), sub, wc, rr, t).items()} | bits.transfer(word(0), word(1), rr, t))
    m = m.withColumns(bits.payload_words(F.col("length"), F.col("totwrdcnt"), rr, t))
    for side in ("tx", "rx"):
        parts = bits.command_word(F.col(f"{side}commwrd"))
        m = m.withColumns({f"{side}rtaddr": parts["rtaddr"], f"{side}tr": parts["tr"] == 1, f"{side}subaddr": parts["subaddr"], f"{side}wrdcnt": parts["wrdcnt"]})
    for n in (1, 2):
        raw = F.when(F.col(f"__status{n}") >= 0, F.get("words", F.col(f"__status{n}"))).otherwise(-1)
        there = F.when(raw < 0, 0).otherwise(raw)
        m = m.withColumns({f"statwrd{n}": raw} | {("status_rtaddr" if k == "rtaddr" else k) + str(n): c for k, c in bits.status_word(there).items()})
    skip = F.when(rr, 3).when(t, 2).otherwise(1)
    data = F.slice("words", skip + 1, F.greatest(F.col("calcwrdcnt"), F.lit(0)))
    m = m.withColumns({"time": _stamp(F.col("stamp")), "ttb": bits.bits(F.col("head"), 30, 2), "data": text.padded(data, 32)})
    return _typed(m, MILSTD1553)


def good_words(words: DataFrame, *, by: list[str], order: list[str]) -> DataFrame:
    """Words of a packet before its first one with a parity or format error or a gap over MOST_GAP."""
    return alignment.until_error(words, F.col("PE") | F.col("FE") | (F.col("gap") > MOST_GAP), by=by, order=order)


def parse_429(packets: DataFrame) -> DataFrame:
    """ARINC429 rows: words up to a packet's first bad one; a word's time is the packet's plus the gaps so far."""
    p = timed(packets, "429")
    keep = p.select("id", "channelid", "doy", "fix_rtc", "fix_time", "rtc", "body")
    w = flatten.parsed_429(flatten.words_429(keep))
    w = good_words(w, by=["id"], order=["idx"])
    time = timebase.absolute(F.col("rtc"), F.col("fix_rtc"), F.col("fix_time")) + alignment.running_sum(F.col("gap"), by=["id"], order=["idx"]) * 100
    return _typed(w.withColumns({"time": time, "gaptime": F.col("gap"), "parity": F.col("parity") == 1}), ARINC429)


def parse_ethernet(packets: DataFrame) -> DataFrame:
    """ETHERNET rows; fields of layers that a frame lacks are null, its payload is zero-padded."""
    f = flatten.ethernet_headers(flatten.ethernet_frames(_with_head(timed(packets, "ethernet")), "id", keep=_OF_PACKET).withColumnRenamed("time", "stamp"))
    size = F.col("payload_sz").cast("int")
    data = F.expr("right(hex(frame), cast(payload_sz as int) * 2)")
    octets = F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.conv(F.substring(data, i * 2 - 1, F.lit(2)), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))
    return _typed(f.withColumns({"time": _stamp(F.col("stamp")), "payload": text.padded(octets, MOST_PAYLOAD)}), ETHERNET)


def parse_video(packets: DataFrame) -> DataFrame:
    """VIDEO rows with unit_idx: units of 94 words, timed by their own stamps or by their packet."""
    p = timed(packets, "video")
    flags = {k: c for k, c in bits.video_flags(flatten.uint(F.col("body"), 0, 4)).items() if k not in ("BA", "IPH")}
    v = flatten.video_units(p.withColumns(flags))
    words = F.transform(F.sequence(F.lit(0), F.lit(VIDEO_WORDS - 1)), lambda i: flatten.uint(F.col("unit"), i * 2, 2).cast("int"))
    time = timebase.unit_time(F.col("IPH"), _stamp(F.col("stamp")), timebase.absolute(F.col("rtc"), F.col("fix_rtc"), F.col("fix_time")))
    return _typed(v.withColumns({"time": time, "data": words}), VIDEO + ", unit_idx int")


PARSERS = {"1553": parse_1553, "429": parse_429, "ethernet": parse_ethernet, "video": parse_video}


def write_parsed(rows: DataFrame, path: str, order: list[str] | None = None, group_rows: int = 10_000) -> None:
    """A parsed table as gzip Parquet, in `order` within each file, at most so many rows in a row group."""
    rows = rows.sortWithinPartitions(*order) if order else rows
    rows.write.mode("overwrite").option("compression", "gzip").option("parquet.block.row.count.limit", group_rows).parquet(path)


def write_ordered(rows: DataFrame, path: str, order: list[str]) -> None:
    """write_parsed() in one order over all files: each holds a range, and their names are in the order of the ranges."""
    write_parsed(rows.repartitionByRange(*order), path, order)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table of write_ordered() with `place`, their number from 0 in the order of files and of rows within them. A count a file is gathered, no rows."""
    rows = spark.read.parquet(path).select("*", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("__part"), F.col("_metadata.row_index").alias("__row"))
    counts = rows.groupBy("__part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(counts.select("__part", before.alias("__before"))), "__part").withColumn("place", F.col("__before") + F.col("__row")).drop("__part", "__row", "__before")


def row_groups(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, row_group, rows, least, greatest) of a table's row groups by their footers, which tasks read; least and greatest of a column of whole numbers, null without statistics."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name in b["name"]:
                system, at = located(f"{path.rstrip('/')}/{name}")
                with system.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                for i in range(meta.num_row_groups):
                    group = meta.row_group(i)
                    own = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column)
                    known = own.statistics is not None and own.statistics.has_min_max
                    out.append((name, i, group.num_rows, own.statistics.min if known else None, own.statistics.max if known else None))
            yield pd.DataFrame(out, columns=["file", "row_group", "rows", "least", "greatest"])

    names = spark.createDataFrame([(n,) for n, _ in listing(spark, path) if n.endswith(".parquet")], "name string")
    return names.repartition("name").mapInPandas(read, "file string, row_group int, rows long, least long, greatest long")


def write_attributes(texts: DataFrame, path: str) -> None:
    """Attribute texts as text files."""
    texts.select("text").write.mode("overwrite").text(path)
