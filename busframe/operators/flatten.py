"""Packets to rows: fixed-length records by slicing in expressions, variable-length ones by a walk over Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframe.functions.bits import header_429, octal_label, video_flags, word_429
from busframe.sources.packets import located

#: Enabled packet types and their codes; attributes and time packets are always read.
TYPES = {"1553": 0x19, "429": 0x38, "ethernet": 0x68, "video": 0x40}
ALWAYS = (0x01, 0x11)
MOST_MESSAGES, MOST_BYTES, MOST_FRAMES, MOST_FRAME = 10_000, 72, 1000, 9000
#: Units of 188 bytes in a video packet, without and with a time stamp each.
MOST_UNITS, MOST_STAMPED = 2788, 2674


def only_types(packets: DataFrame, types: list[str]) -> DataFrame:
    return packets.where(F.col("data_type").isin(*ALWAYS, *[TYPES[t] for t in types]))


def conclusive_time(packets: DataFrame) -> DataFrame:
    """Without packets whose time source and secondary header contradict each other."""
    return packets.where("intrapkt_ts_source = secondary_hdr")


def sound(packets: DataFrame) -> DataFrame:
    """Packets whose body checksum and secondary header are right."""
    return packets.where("checksum_ok and sec_ok")


def uint(body: Column, at: Column | int, n: int) -> Column:
    """Unsigned little-endian number of n bytes from byte `at` (0: first) of a binary column, as long."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.concat(*[F.substring(body, at + i, F.lit(1)) for i in range(n, 0, -1)])), 16, 10).cast("long")


def words_429(packets: DataFrame, body: str = "body") -> DataFrame:
    """The 8-byte records after a packet's 4-byte word: gap and word as long, with idx from 0."""
    n = F.floor((F.octet_length(body) - 4) / 8).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    rows = packets.select(*packets.columns, F.explode(starts).alias("idx"))
    return rows.withColumns({"gap_word": uint(F.col(body), F.col("idx") * 8 + 4, 4), "word": uint(F.col(body), F.col("idx") * 8 + 8, 4)}).drop(body)


def parsed_429(words: DataFrame) -> DataFrame:
    """Fields of words_429() rows."""
    head, data = header_429(F.col("gap_word")), word_429(F.col("word"))
    return words.withColumns(head | data | {"label": octal_label(data["label_raw"])})


def whole_units(size: Column, stamped: Column) -> Column:
    """Whether a video packet's body of `size` bytes holds whole units, one at least and no more than allowed."""
    unit = F.when(stamped, 196).otherwise(188)
    return ((size - 4) % unit == 0) & ((size - 4) / unit).between(F.lit(1), F.when(stamped, MOST_STAMPED).otherwise(MOST_UNITS))


def video_units(packets: DataFrame, body: str = "body") -> DataFrame:
    """188-byte units after a packet's 4-byte word, with unit_idx and, where the word says so, their own 8-byte time stamp."""
    flags = video_flags(uint(F.col(body), 0, 4))
    size = F.when(flags["IPH"], 196).otherwise(188)
    n = ((F.octet_length(body) - 4) / size).cast("int")
    rows = packets.withColumns({"__size": size, "__n": n, "IPH": flags["IPH"]}).where(whole_units(F.octet_length(body), F.col("IPH")))
    rows = rows.select(*packets.columns, "IPH", "__size", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("unit_idx"))
    at = F.col("unit_idx") * F.col("__size") + 4
    stamp = F.when(F.col("IPH"), F.substring(F.col(body), at + 1, F.lit(8)))
    return rows.withColumns({"stamp": stamp, "unit": F.substring(F.col(body), at + F.col("__size") - 188 + 1, F.lit(188))}).drop(body, "__size")


def _swapped(words: pa.Array) -> pa.Array:
    values = words.flatten()
    sizes = 2 * np.bincount(pc.list_parent_indices(words).to_numpy()[values.is_valid().to_numpy(zero_copy_only=False)], minlength=len(words))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
    data = (values.drop_null().to_numpy() & 0xFFFF).astype(">u2").tobytes()
    out = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
    return pc.if_else(words.is_valid(), out, pa.scalar(None, pa.binary()))


def swap_bytes(data: Column) -> Column:
    """array<int> of 16-bit words to bytes, each word's high byte first; missing words are left out. In Arrow batches: Spark interprets a lambda word by word."""

    def swapped(words: pa.Array) -> pa.Array:
        return _swapped(words)

    return F.arrow_udf(swapped, "binary")(data)


def extract_video(video: DataFrame, order: list[str]) -> DataFrame:
    """Transport-stream bytes of each channel in file order: (channelid, seq columns, chunk), dealt into ranges and sorted within them by channel and order."""
    rows = video.select("channelid", *order, swap_bytes(F.col("data")).alias("chunk"))
    return rows.repartitionByRange("channelid", *order).sortWithinPartitions("channelid", *order)


def write_video(video: DataFrame, order: list[str], path: str) -> None:
    """A stream for each channel: files `channel=<id>/<number>.ts` below path; in order of their names they are the stream.

    A range of a channel is a file, written by the task that holds it, so a long stream isn't one task's. A task that is run
    again writes the same files.
    """
    rows = extract_video(video, order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, opened, channel, sizes = TaskContext.get().partitionId(), None, None, {}
        for b in batches:
            for c, chunk in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if opened is None or c != channel:
                    if opened:
                        opened.close()
                    channel = c
                    system, folder = located(f"{path}/channel={c}")
                    system.create_dir(folder, recursive=True)
                    opened = system.open_output_stream(f"{folder}/{part:08d}.ts")
                opened.write(chunk)
                sizes[c] = sizes.get(c, 0) + len(chunk)
        if opened:
            opened.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), pa.array(list(sizes.values()), pa.int64())], names=["channelid", "bytes"])

    rows.select(F.col("channelid").cast("long"), "chunk").mapInArrow(write, "channelid long, bytes long").agg(F.sum("bytes")).collect()


def _walked(packets: DataFrame, packet_id: str, body: str, keep: tuple[str, ...], own: str, walk: Callable[[bytes], Iterator[tuple]]) -> DataFrame:
    """(packet, kept columns, columns `own`) of what walk() finds in each body. A packet's columns are repeated by its rows' places, so nothing is joined."""
    kept = packets.select(F.col(packet_id).cast("long").alias("packet"), *keep)
    types = [k for _, k in (x.split(" ", 1) for x in own.split(", "))]
    names = [*kept.columns, *[x.split(" ", 1)[0] for x in own.split(", ")]]
    arrow = {"int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, x in enumerate(b.column(b.num_columns - 1)):
                for row in walk(x.as_py() or b""):
                    at.append(i)
                    rows.append(row)
            if rows:
                place = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([*[c.take(place) for c in b.columns[:-1]], *[pa.array(c, arrow[k]) for c, k in zip(zip(*rows, strict=True), types, strict=True)]], names=names)

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema], own])
    return packets.select(F.col(packet_id).cast("long").alias("packet"), *keep, F.col(body).alias("__body")).mapInArrow(run, schema)


def messages_1553(packets: DataFrame, packet_id: str, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages of 1553 packets: (packet, columns `keep` of it, msg_idx, time stamp bytes, block_status, gaps, length in bytes, words).

    A packet that announces over MOST_MESSAGES messages is dropped; one ends before a message over MOST_BYTES.
    """

    def walk(x: bytes) -> Iterator[tuple]:
        count, at = struct.unpack_from("<I", x)[0] & 0xFFFFFF if len(x) >= 4 else 0, 4
        for i in range(count if count <= MOST_MESSAGES else 0):
            if at + 14 > len(x):
                break
            status, gaps, length = struct.unpack_from("<3H", x, at + 8)
            if length > MOST_BYTES or at + 14 + length > len(x):
                break
            yield i, x[at : at + 8], status, gaps, length, list(struct.unpack_from(f"<{length // 2}H", x, at + 14))
            at += 14 + length

    return _walked(packets, packet_id, body, keep, "msg_idx int, time binary, block_status int, gaps int, length int, words array<int>", walk)


def ethernet_frames(packets: DataFrame, packet_id: str, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Frames of ethernet packets: (packet, columns `keep` of it, frame_idx, time stamp bytes, frame).

    A packet with over MOST_FRAMES is dropped; one ends before a frame of 0 or over MOST_FRAME bytes.
    """

    def walk(x: bytes) -> Iterator[tuple]:
        count, at = struct.unpack_from("<I", x)[0] & 0xFFFF if len(x) >= 4 else 0, 4
        for i in range(count if count <= MOST_FRAMES else 0):
            if at + 12 > len(x):
                break
            n = struct.unpack_from("<I", x, at + 8)[0] & 0x3FFF
            if not 0 < n <= MOST_FRAME or at + 12 + n > len(x):
                break
            yield i, x[at : at + 8], x[at + 12 : at + 12 + n]
            at += 12 + n

    return _walked(packets, packet_id, body, keep, "frame_idx int, time binary, frame binary", walk)


def _big(frame: Column, at: Column | int, n: int) -> Column:
    """Unsigned big-endian number of n bytes from byte `at`."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.substring(frame, at + 1, F.lit(n))), 16, 10).cast("long")


def ethernet_headers(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """Header fields of frames: Ethernet II or 802.3 with LLC, then IPv4 with UDP or TCP. Fields of layers that aren't there are null."""
    x = F.col(frame)
    mac = lambda at: F.lower(F.regexp_replace(F.hex(F.substring(x, F.lit(at + 1), F.lit(6))), "(..)(?=.)", "$1:"))
    rows = frames.withColumns({"dstmac": mac(0), "srcmac": mac(6), "__type": _big(x, 12, 2)})
    llc = F.col("__type") <= 1500
    rows = rows.withColumns({"ethtype": F.when(~llc, F.col("__type")).cast("int"), "llcdsap": F.when(llc, _big(x, 14, 1)).cast("int"), "llcssap": F.when(llc, _big(x, 15, 1)).cast("int")})
    # Control field: information frames have both sequence numbers, supervisory ones the received one, unnumbered none.
    control = _big(x, 16, 1)
    kind = F.when(control.bitwiseAND(F.lit(1)) == 0, 0).when(control.bitwiseAND(F.lit(3)) == 1, 1).otherwise(3)
    rows = rows.withColumns({"llcfmt": F.when(llc, kind), "llcsndseqnum": F.when(llc, F.when(kind == 0, F.shiftright(control, 1)).otherwise(0)).cast("int"), "llcrcvseqnum": F.when(llc, F.when(kind < 3, F.shiftright(_big(x, 17, 1), 1)).otherwise(0)).cast("int")})
    ip = F.coalesce(F.col("ethtype") == 0x0800, F.lit(False))
    dotted = lambda at: F.when(ip, F.concat_ws(".", *[_big(x, at + i, 1).cast("string") for i in range(4)]))
    rows = rows.withColumns({"ipid": F.when(ip, _big(x, 18, 2)).cast("int"), "ipproto": F.when(ip, _big(x, 23, 1)).cast("int"), "ipoffset": F.when(ip, _big(x, 20, 2).bitwiseAND(F.lit(0x1FFF))).cast("int"), "srcip": dotted(26), "dstip": dotted(30), "__ihl": F.when(ip, _big(x, 14, 1).bitwiseAND(F.lit(15)) * 4).cast("int")})
    ported = F.coalesce(F.col("ipproto").isin(6, 17) & (F.col("ipoffset") == 0), F.lit(False))
    at = F.col("__ihl") + 14
    rows = rows.withColumns({"srcport": F.when(ported, _big(x, at, 2)).cast("int"), "dstport": F.when(ported, _big(x, at + 2, 2)).cast("int")})
    skip = F.when(F.col("ipproto") == 17, 8).when(F.col("ipproto") == 6, F.shiftright(_big(x, at + 12, 1), 4).cast("int") * 4)
    start = F.when(ported, at + skip).when(ip, at).when(llc, F.when(F.col("llcfmt") == 3, 17).otherwise(18)).otherwise(F.lit(14))
    return rows.withColumn("payload_sz", F.greatest(F.octet_length(x) - start, F.lit(0)).cast("long")).drop("__type", "__ihl")
