"""Bus rows to engineering units: lookup joins with the interface document, then projections generated from it.

The document is a dimension of thousands of rows at most; it is collected once to build expressions, and refused beyond
MOST_ELEMENTS. Message keys are broadcast after a count of their rows, so bus rows, the side that grows, aren't shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from busframe.functions.bits import command_word
from busframe.functions.decode import BIT_LEVEL, bit_count, decode, decode32, decode32_rows, decode_rows, output_type, ssm_sign
from busframe.operators.quality import validate_icd, validate_icd_429
from busframe.schemas import READ_1553, READ_429
from busframe.sources.packets import located
from busframe.sources.tables import shared_folder

MOST_ELEMENTS = 200_000
KEYS_1553 = ["channelid", "txrtaddr", "rxrtaddr", "txsubaddr", "rxsubaddr"]


def dimension(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most MOST_ELEMENTS rows; a larger one is joined as Spark's statistics and skew handling say."""
    return F.broadcast(df) if df.limit(MOST_ELEMENTS + 1).count() <= MOST_ELEMENTS else df


def message_table(icd: DataFrame, order: str = "elem_name") -> DataFrame:
    """One row per message: its attributes come from its first element by `order`, such as its place in the document."""
    first = Window.partitionBy("msg_name").orderBy(order)
    rows = icd.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "elem_name")
    return rows.join(icd.groupBy("msg_name").agg(F.count("*").alias("elements")), "msg_name")


def lookup_1553(icd: DataFrame, bus_map: DataFrame, select_msg: list[str] | None = None) -> DataFrame:
    """(KEYS_1553, msg_name): messages by address for every channel that carries their bus; of select_msg alone if given."""
    m = icd if not select_msg else icd.where(F.col("msg_name").isin(select_msg))
    tx, rx = command_word(F.col("xmit_word")), command_word(F.col("dest_word"))
    m = m.select("msg_name", F.col("bus_name").alias("bus"), tx["rtaddr"].alias("txrtaddr"), rx["rtaddr"].alias("rxrtaddr"), tx["subaddr"].alias("txsubaddr"), rx["subaddr"].alias("rxsubaddr")).distinct()
    return m.join(bus_map.select("channelid", "bus"), "bus").select(*KEYS_1553, "msg_name")


def match_1553(bus: DataFrame, lookup: DataFrame, ride_along: list[str] | None = None) -> DataFrame:
    """Bus rows with the messages they carry: one row may feed several, unmatched rows go. Reads the needed columns only."""
    columns = list(dict.fromkeys([*READ_1553, *(ride_along or [])]))
    return bus.select(*columns).join(dimension(lookup), KEYS_1553)


def bus_channels(channels: DataFrame) -> DataFrame:
    """(channelid, bus from 0, name in upper case) of recorded subchannels (channelid, subchannel from 1, name). A name that occurs twice is an error."""
    named = channels.select("channelid", (F.col("subchannel") - 1).alias("bus"), F.upper("name").alias("name"))
    if twice := named.where("name is not null").groupBy("name").count().where("count > 1").limit(10).collect():
        raise ValueError(f"bus names of several subchannels: {', '.join(sorted(r['name'] for r in twice))}")
    return named


def versions(icd: DataFrame) -> DataFrame:
    """(msg_name, elem_name, base, version) of multi-format elements, whose names are base@version. Each version is translated as an element of its own."""
    rows = icd.where(F.contains("elem_name", F.lit("@")))
    return rows.select("msg_name", "elem_name", F.substring_index("elem_name", "@", 1).alias("base"), F.substring_index("elem_name", "@", -1).cast("int").alias("version"))


def lookup_429(icd: DataFrame, channels: DataFrame) -> DataFrame:
    """(channelid, bus, label, SDI, word_name) with sdi -1 spread over the SDIs that no exact entry takes.

    icd: word_name, label, bus (name), sdi. channels: channelid, subchannel (from 1), name. Words in the table count buses from 0.
    """
    words = icd.select("word_name", "label", F.upper("bus").alias("name"), "sdi").distinct()
    words = words.join(bus_channels(channels), "name").drop("name")
    exact = words.where("sdi >= 0").withColumnRenamed("sdi", "SDI")
    wild = words.where("sdi = -1").drop("sdi").withColumn("SDI", F.explode(F.sequence(F.lit(0), F.lit(3))))
    wild = wild.join(exact, ["channelid", "bus", "label", "SDI"], "left_anti")
    return exact.select("channelid", "bus", "label", "SDI", "word_name").unionByName(wild)


def match_429(bus: DataFrame, lookup: DataFrame, ride_along: list[str] | None = None) -> DataFrame:
    columns = list(dict.fromkeys([*READ_429, *(ride_along or [])]))
    return bus.select(*columns).join(dimension(lookup), ["channelid", "bus", "label", "SDI"])


def unmatched_words(icd: DataFrame, channels: DataFrame) -> DataFrame:
    """(word_name, reason) of the words that can't be looked up."""
    words = icd.select("word_name", "label", "bus", "sdi").distinct().join(channels.select(F.upper("name").alias("name"), F.lit(True).alias("known")).distinct(), F.upper("bus") == F.col("name"), "left")
    reason = F.when(F.coalesce(F.col("bus"), F.lit("")) == "", "no bus").when(F.coalesce("label", F.lit(0)) <= 0, "no label").when(F.col("sdi").isNull() | ~F.col("sdi").between(-1, 3), "sdi out of range").when(F.col("known").isNull(), "unknown bus")
    return words.select("word_name", reason.alias("reason")).where("reason is not null")


def collect_elements(icd: DataFrame, name: str, order: list[str]) -> dict[str, list[Row]]:
    """Elements by message, on the driver."""
    rows = icd.limit(MOST_ELEMENTS + 1).collect()
    if len(rows) > MOST_ELEMENTS:
        raise ValueError(f"more than {MOST_ELEMENTS} elements")
    out: dict[str, list[Row]] = {}
    for r in sorted(rows, key=lambda r: tuple(r[c] for c in order)):
        out.setdefault(r[name], []).append(r)
    return out


def element_1553(e: Row):
    return decode(e["schema"], F.col("data"), e["offset"], e["elem_word_count"], e["bitmsb"], e["bitlsb"], e["msb_val"])


def element_429(e: Row):
    """An element of a 429 word; bits 9 and 10 are the SDI column, everything else lies in data and SSM."""
    n = e["bit_count"]
    if e["bitmsb"] >= 23 and e["bitlsb"] <= 24:  # the SDI, once positions count from the other end
        raw = F.shiftright(F.col("SDI"), 24 - e["bitlsb"]).bitwiseAND(F.lit((1 << n) - 1))
        return (raw != 0) if n == 1 else raw.cast(output_type(e["schema"], n))
    word = F.col("parity").cast("long") * F.lit(1 << 31) + F.col("SSM").cast("long") * F.lit(1 << 29) + F.col("data").cast("long") * F.lit(1 << 10)
    return decode32(e["schema"], word, e["bitmsb"], e["bitlsb"], e["msb_val"], e["bcd_partial"], ssm_sign(F.col("SSM")) if e["schema"] == "BCD" else None)


def staged(matched: DataFrame, name: str) -> DataFrame:
    """Matched rows written once, each message apart: a message's table reads its own rows alone, so many tables cost one scan of the bus rows.

    Rows are dealt into ranges of message and time first, so that a task writes few messages and a large one is several tasks'.
    """
    folder = shared_folder(matched.sparkSession, "staged")
    order = [name, *(["time"] if "time" in matched.columns else [])]
    matched.repartitionByRange(*order).write.option("compression", "zstd").partitionBy(name).parquet(folder)
    return matched.sparkSession.read.schema(matched.schema).parquet(folder)


def translate_1553(bus: DataFrame, icd: DataFrame, bus_map: DataFrame, *, select_msg: list[str] | None = None, ride_along: tuple[str, ...] = ("time",)) -> tuple[dict[str, DataFrame], DataFrame]:
    """({message: ride-along columns and one column per element}, violations). A message with a bad element is left out.

    Of several messages the matched rows are staged, by one job.
    """
    violations = validate_icd(icd)
    good = icd.join(violations.select("msg_name").distinct(), "msg_name", "left_anti")
    wanted = good if not select_msg else good.where(F.col("msg_name").isin(select_msg))
    elements = collect_elements(wanted, "msg_name", ["msg_name", "elem_name"])
    matched = match_1553(bus, lookup_1553(good, bus_map, select_msg), list(ride_along)).select(*dict.fromkeys([*ride_along, "data", "msg_name"]))
    matched = staged(matched, "msg_name") if len(elements) > 1 else matched
    return {m: matched.where(F.col("msg_name") == m).select(*ride_along, *[element_1553(e).alias(e["elem_name"]) for e in own]) for m, own in elements.items()}, violations


def translate_429(bus: DataFrame, icd: DataFrame, channels: DataFrame, *, ride_along: tuple[str, ...] = ("time",)) -> tuple[dict[str, DataFrame], DataFrame]:
    """({word: ride-along columns and one column per element}, violations). A word with a bad element is left out. Of several words the matched rows are staged."""
    violations = validate_icd_429(icd)
    good = icd.join(violations.select("word_name").distinct(), "word_name", "left_anti")
    elements = collect_elements(good, "word_name", ["word_name", "elem_name"])
    matched = match_429(bus, lookup_429(good, channels), list(ride_along)).select(*dict.fromkeys([*ride_along, "data", "SSM", "SDI", "parity", "word_name"]))
    matched = staged(matched, "word_name") if len(elements) > 1 else matched
    return {w: matched.where(F.col("word_name") == w).select(*ride_along, *[element_429(e).alias(e["elem_name"]) for e in own]) for w, own in elements.items()}, violations


def translate_long(matched: DataFrame, icd: DataFrame, *, ride_along: tuple[str, ...] = ("time",)) -> DataFrame:
    """All elements of all messages in one pass: ride-along columns, msg_name, elem_name, value (double).

    Elements are rows that are joined to the bus rows, so the expression doesn't grow with the document. Messages with an
    element that breaks a rule (validate_icd) are left out.
    """
    bad = validate_icd(icd).select("msg_name").distinct()
    elements = icd.join(bad, "msg_name", "left_anti").select("msg_name", "elem_name", "schema", "offset", "elem_word_count", "bitmsb", "bitlsb", "msb_val")
    rows = matched.select(*ride_along, "msg_name", "data").join(dimension(elements), "msg_name")
    return rows.select(*ride_along, "msg_name", "elem_name", decode_rows(F.col("data")).alias("value"))


def translate_long_429(matched: DataFrame, icd: DataFrame, *, ride_along: tuple[str, ...] = ("time",)) -> DataFrame:
    """All elements of all words in one pass: ride-along columns, word_name, elem_name, value (double). Words with a bad element are left out."""
    bad = validate_icd_429(icd).select("word_name").distinct()
    elements = icd.join(bad, "word_name", "left_anti").select("word_name", "elem_name", "schema", "bitmsb", "bitlsb", "msb_val", "bcd_partial")
    rows = matched.select(*dict.fromkeys([*ride_along, "word_name", "data", "SSM", "SDI", "parity"])).join(dimension(elements), "word_name")
    return rows.select(*ride_along, "word_name", "elem_name", decode32_rows().alias("value"))


_FIELDS = ["elem_name", "schema", "offset", "elem_word_count", "bitmsb", "bitlsb", "msb_val"]
_ARROW = {"boolean": pa.bool_(), "tinyint": pa.int8(), "float": pa.float32(), "double": pa.float64()}
#: Rows of a row group, at most.
GROUP_ROWS = 10_000


def element_type(e: Row) -> str:
    return output_type(e["schema"], bit_count(e["elem_word_count"], e["bitmsb"], e["bitlsb"]) if e["schema"] in BIT_LEVEL else 16 * e["elem_word_count"])


def wide_rows(matched: DataFrame, icd: DataFrame, *, ride_along: tuple[str, ...] = ("time",)) -> DataFrame:
    """Ride-along columns, msg_name and values: a message's elements by name, as an array of doubles. Messages with a bad element are left out."""
    bad = validate_icd(icd).select("msg_name").distinct()
    own = icd.join(bad, "msg_name", "left_anti").groupBy("msg_name").agg(F.sort_array(F.collect_list(F.struct(*_FIELDS))).alias("elements"))
    rows = matched.select(*ride_along, "msg_name", "data").join(dimension(own), "msg_name")
    return rows.select(*ride_along, "msg_name", F.transform("elements", lambda e: decode_rows(F.col("data"), lambda c: e[c])).alias("values"))


def write_tables(matched: DataFrame, icd: DataFrame, path: str, *, ride_along: tuple[str, ...] = ("time",)) -> DataFrame:
    """A directory `<message>.parquet` per message, of ride-along columns and one column per element: all by one job.

    Rows are dealt into ranges of message and ride-along columns, decoded and sorted within them (sampling for the ranges runs
    what lies below once more, so decoding doesn't); a task writes a file for each message that it holds, so there are at most as many files as tasks and messages together. A file gets its name, which message and
    range make, when it is whole: a task that is run again leaves no second one. Row groups hold GROUP_ROWS rows at most.
    Returns (msg_name, file, rows) of the files. The messages' directories of an earlier write go first.
    """
    bad = validate_icd(icd).select("msg_name").distinct()
    own = icd.join(bad, "msg_name", "left_anti").select("msg_name").distinct()
    dealt = matched.select(*ride_along, "msg_name", "data").join(dimension(own), "msg_name", "left_semi").repartitionByRange("msg_name", *ride_along)
    rows = wide_rows(dealt, icd, ride_along=ride_along)
    jvm, conf = matched.sparkSession._jvm, matched.sparkSession._jsc.hadoopConfiguration()
    for r in icd.select("msg_name").distinct().limit(MOST_ELEMENTS).collect():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{r['msg_name']}.parquet")
        folder.getFileSystem(conf).delete(folder, True)
    types = matched.sparkSession.sparkContext.broadcast({m: [(e["elem_name"], _ARROW[element_type(e)]) for e in own] for m, own in collect_elements(icd, "msg_name", ["msg_name", "elem_name"]).items()})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number, attempt = task.partitionId(), task.taskAttemptId()
        opened: list = []  # message, rows, file system, temporary name, stream, writer
        held: list[pa.Table] = []

        def flush(least: int) -> None:
            if opened and held and sum(map(len, held)) >= least:
                whole = pa.concat_tables(held)
                n = len(whole) if least == 1 else len(whole) // GROUP_ROWS * GROUP_ROWS
                opened[5].write_table(whole.slice(0, n), row_group_size=GROUP_ROWS)
                held[:] = [whole.slice(n)] if n < len(whole) else []

        def close() -> tuple:
            flush(1)
            opened[5].close()
            opened[4].close()
            name = opened[3].replace(f"_{attempt}-", "")
            if opened[2].get_file_info(name).type != fs.FileType.NotFound:
                opened[2].delete_file(name)
            opened[2].move(opened[3], name)
            return opened[0], name.rpartition("/")[2], opened[1]

        for b in batches:
            names, done = b.column(len(ride_along)), []
            ends = [*(np.flatnonzero(np.asarray(pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)))) + 1).tolist(), len(names)]
            for start, end in zip([0, *ends[:-1]], ends, strict=True):
                message = names[start].as_py()
                if opened and opened[0] != message:
                    done.append(close())
                    opened.clear()
                part = b.slice(start, end - start)
                values = part.column(len(ride_along) + 1)
                k = len(types.value[message])
                cells = pa.array(np.asarray(values.flatten().to_numpy(zero_copy_only=False), "f8").reshape(-1, k).T.ravel(), from_pandas=False)
                missing = values.flatten().is_null().to_numpy(zero_copy_only=False).reshape(-1, k)
                columns = [pa.array(np.asarray(cells.slice(i * len(part), len(part))), mask=missing[:, i]) for i in range(k)]
                columns = [c.cast(pa.int8()) if t == pa.int8() else pc.not_equal(c, 0.0) if t == pa.bool_() else c.cast(t, safe=False) for c, (_, t) in zip(columns, types.value[message], strict=True)]
                table = pa.Table.from_arrays([*part.columns[: len(ride_along)], *columns], names=[*ride_along, *[n for n, _ in types.value[message]]])
                if not opened:
                    system, folder = located(f"{path}/{message}.parquet")
                    system.create_dir(folder, recursive=True)
                    temporary = f"{folder}/_{attempt}-part-{number:05d}.parquet"
                    stream = system.open_output_stream(temporary)
                    opened[:] = [message, 0, system, temporary, stream, pq.ParquetWriter(stream, table.schema, compression="gzip")]
                opened[1] += len(table)
                held.append(table)
                flush(GROUP_ROWS)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["msg_name", "file", "rows"])
        if opened:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in close()], names=["msg_name", "file", "rows"])

    ordered = rows.select(*ride_along, "msg_name", "values").sortWithinPartitions("msg_name", *ride_along)
    files = ordered.mapInArrow(write, "msg_name string, file string, rows long").collect()  # a row a file
    return matched.sparkSession.createDataFrame(files, "msg_name string, file string, rows long")


def translated_names(matched: DataFrame, name: str = "msg_name") -> DataFrame:
    return matched.groupBy(name).agg(F.count("*").alias("rows"))


