"""Flight recordings as packet rows, by a Python data source over byte ranges.

A file is a chain of packets: where one ends the next begins, and after what is no header the search goes on byte by byte.
Bodies may hold whole packets (recorded network streams do), so a range can't tell by itself where the chain enters it.
resolve() follows the chain through all ranges at once, each from the first header it sees, and walks a range again from
where its predecessor really leaves off if that isn't on the chain it saw. Headers alone are read for that, and the clock
packets, whose last valid fix is carried from range to range with the chain: so a row of a packet can hold the fix that is
valid for it, without a join.

A range costs a task's share and a row on the driver, so ranges that would be over RANGES are put together, neighbours of a
file; a file that is one range is entered at its beginning and not walked before it is read. A task reads as many ranges as
make up a share of all bytes.
"""

from __future__ import annotations

import datetime
import io
import struct
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from busframe.schemas import FIX, PACKETS
from busframe.sources.tables import shared_folder

SYNC = b"\x25\xeb"
HEADER, SECONDARY = 24, 12
CLOCK = 0x11
CHUNK = 64 << 20
_CHECKSUM_BYTES = (0, 1, 2, 4)
#: Bytes that a walk over headers takes at first, and that any read takes at most, at once.
_WALK, _READ = 1 << 13, 1 << 20
_ROWS, _BYTES = 4096, 4 << 20
#: Ranges that files are cut into at most, besides one a file, unless they have CHUNK bytes. Tasks that a recording is shared by, unless a share were under LEAST or over CHUNK bytes; opening a file counts as _OPEN.
RANGES, TASKS, LEAST, _OPEN = 1024, 1024, 8 << 20, 1 << 16
_DAY0 = datetime.date(1970, 1, 1).toordinal()


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def recordings(path: str) -> list[tuple[str, int]]:
    """(file, size) of a recording or of all in a directory, hidden ones left out; names only."""
    system, at = located(path)
    scheme = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(path if scheme else at, info.size)]
    found = [x for x in system.get_file_info(fs.FileSelector(at, recursive=True)) if x.type == fs.FileType.File]
    shown = [x for x in found if not any(y[0] in "._" for y in x.path[len(at) :].strip("/").split("/"))]
    return sorted((scheme + x.path, x.size) for x in shown)


#: offset, counter and time of the last valid clock packet, and whether its day is of no known year.
Fix = tuple[int, int, int, bool]


@dataclass
class Range(InputPartition):
    """Bytes of a file. entry: where the chain enters it, None if no packet begins here; fix: the one that holds there."""

    file: str
    start: int
    stop: int
    entry: int | None
    fix: Fix | None = None


@dataclass
class Share(InputPartition):
    """What one task reads."""

    ranges: list[Range]


def shares(ranges: list[Range], most: int = CHUNK) -> list[Share]:
    """Ranges in order, dealt into shares of about the same number of bytes."""
    sizes = [r.stop - r.start + _OPEN for r in ranges]
    size, out, held = min(max(LEAST, sum(sizes) // TASKS), most), [], 0
    for r, n in zip(ranges, sizes, strict=True):
        if not out or held + n > size:
            out.append(Share([]))
            held = 0
        out[-1].ranges.append(r)
        held += n
    return out


@dataclass
class Window:
    """Bytes of a file from `base` on."""

    file: io.BufferedReader
    base: int
    data: bytes


#: Fields of packets, an array each.
Headers = dict[str, np.ndarray]


def headers(data: bytes) -> tuple[np.ndarray, Headers]:
    """Places and fields of all that are packet headers by their checksum and sizes, whether on the chain or not."""
    u = np.frombuffer(data, "u1")
    last = max(0, len(u) - HEADER + 1)
    at = np.flatnonzero((u[:last] == SYNC[0]) & (u[1 : last + 1] == SYNC[1]))
    w = u[at[:, None] + np.arange(HEADER)].view("<u2").astype("i8")
    sound = w[:, :11].sum(axis=1) & 0xFFFF == w[:, 11]
    at, w = at[sound], w[sound]
    flags, size, data_size = w[:, 7] & 0xFF, w[:, 2] | w[:, 3] << 16, w[:, 4] | w[:, 5] << 16
    held = size - HEADER - SECONDARY * (flags >> 7)
    h = {"channelid": w[:, 1], "pkt_size": size, "data_size": data_size, "data_type_ver": w[:, 6] & 0xFF, "seq_num": w[:, 6] >> 8, "checksum_existence": flags & 3, "time_format": flags >> 2 & 3, "overflow_err": flags >> 4 & 1, "sync_err": flags >> 5 & 1, "intrapkt_ts_source": flags >> 6 & 1, "secondary_hdr": flags >> 7, "data_type": w[:, 7] >> 8, "rtc": w[:, 8] | w[:, 9] << 16 | w[:, 10] << 32}
    sound = (held >= 0) & (data_size <= held)
    return at[sound], {k: x[sound] for k, x in h.items()}


def chain(file: str, at: int, stop: int, least: int = _WALK) -> Iterator[tuple[Window, np.ndarray, Headers]]:
    """Packets that begin before stop, each the first at or after the end of the one before (of the first: `at`) that the file holds whole.

    A window of the file at a time, with the places in the file and the fields of its packets. Windows have `least` bytes, and
    twice as many each time, up to _READ, as long as the chain doesn't lead far beyond them.
    """
    f, size = _opened(file, _WALK)
    stop, n = min(stop, size), least
    with f:
        while at < stop:
            f.seek(at)
            w = Window(f, at, f.read(min(n, stop - at + HEADER - 1)))
            places, h = headers(w.data)
            places += at
            whole = places + h["pkt_size"] <= size
            places, h = places[whole], {k: x[whole] for k, x in h.items()}
            after, found, i = np.searchsorted(places, places + h["pkt_size"]).tolist(), [], 0
            while i < len(after):
                found.append(i)
                i = after[i]
            end = at + len(w.data)
            if found:
                at = int(places[found[-1]] + h["pkt_size"][found[-1]])
                yield w, places[found], {k: x[found] for k, x in h.items()}
            if end >= size:
                return
            at = max(at, end - HEADER + 1)
            n = min(2 * n, _READ) if at <= end + n else least


def _checksums_ok(u: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int) -> np.ndarray:
    """Whether the last n bytes are the sum of those before, as numbers of n bytes, of what lies from start to stop: payloads in order, with filler and checksum."""
    end = np.maximum(stop - n, start)
    whole = start + (end - start) // n * n
    total = np.zeros(len(start), "u8")
    if len(start) == 1:
        total[0] = u[start[0] : whole[0]].view(f"<u{n}").sum(dtype="u8")
    else:
        for phase in range(n):
            own = start % n == phase
            if own.any():
                words = u[phase : phase + (len(u) - phase) // n * n].view(f"<u{n}")
                sums = np.zeros(len(words) + 1, "u8")
                np.cumsum(words, dtype="u8", out=sums[1:])
                total[own] = sums[(whole[own] - phase) // n] - sums[(start[own] - phase) // n]
    number = lambda a, b: sum(np.where(a + k < b, u[np.minimum(a + k, len(u) - 1)], 0).astype("u8") << np.uint64(8 * k) for k in range(n))
    return (total + number(whole, end)) & np.uint64((1 << 8 * n) - 1) == number(end, stop)


def _body(f: Window, at: np.ndarray, h: dict) -> tuple[list[bytes | None], np.ndarray, np.ndarray, list[bytes]]:
    """(secondary headers' times, whether their checksums are right, whether the bodies' are, bodies) of a window's packets of one type.

    Of a chain's packets the last one alone can reach beyond the window; it is read by itself then.
    """
    if at[-1] + h["pkt_size"][-1] > f.base + len(f.data):
        f.file.seek(int(at[-1]))
        alone = Window(f.file, int(at[-1]), f.file.read(int(h["pkt_size"][-1])))
        parts = [_body(w, at[x], {k: v[x] if isinstance(v, np.ndarray) else v for k, v in h.items()}) for w, x in ((f, slice(-1)), (alone, slice(-1, None))) if len(at[x])]
        return [y for x in parts for y in x[0]], np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]), [y for x in parts for y in x[3]]
    u, start, second = np.frombuffer(f.data, "u1"), at - f.base + HEADER, h["secondary_hdr"] == 1
    secs = [f.data[a : a + 8] if s else None for a, s in zip(start.tolist(), second.tolist(), strict=True)]
    sec_ok, ok = np.ones(len(at), bool), np.ones(len(at), bool)
    w = u[start[second][:, None] + np.arange(SECONDARY)].view("<u2").astype("i8")
    sec_ok[second] = w[:, :5].sum(axis=1) & 0xFFFF == w[:, 5]
    start, stop = start + SECONDARY * second, start - HEADER + h["pkt_size"]
    for code in np.unique(h["checksum_existence"]).tolist():
        if n := _CHECKSUM_BYTES[code]:
            own = h["checksum_existence"] == code
            ok[own] = _checksums_ok(u, start[own], stop[own], n)
    return secs, sec_ok, ok, [f.data[a:b] for a, b in zip(start.tolist(), (start + h["data_size"]).tolist(), strict=True)]


def _digits(word: int, *widths: int) -> int:
    """Decimal digits of a word, lowest first, of so many bits each."""
    out, place = 0, 1
    for w in widths:
        out += (word & (1 << w) - 1) * place
        word, place = word >> w, place * 10
    return out


def clock_fix(at: int, rtc: int, body: bytes) -> Fix | None:
    """What a clock packet's body says, if its source and format are known and its date exists."""
    if len(body) < 10:
        return None
    head, *w = struct.unpack_from("<I4H", body if len(body) >= 12 else body + b"\0\0")
    if head & 15 == 15 or head >> 4 & 15 == 15:
        return None
    ms, second, minute, hour = 10 * _digits(w[0], 4, 4), _digits(w[0] >> 8, 4, 3), _digits(w[1], 4, 3), _digits(w[1] >> 8, 4, 2)
    if dated := head >> 9 & 1:
        try:
            day = datetime.date(_digits(w[3], 4, 4, 4, 2), _digits(w[2] >> 8, 4, 1), _digits(w[2], 4, 4)).toordinal() - _DAY0
        except ValueError:
            return None
    else:
        day = max(1, _digits(w[2], 4, 4, 2)) - 1
    return at, rtc, (((day * 24 + hour) * 60 + minute) * 60 + second) * 10**9 + ms * 10**6, not dated


def _opened(file: str, buffer: int) -> tuple[io.BufferedReader, int]:
    system, path = located(file)
    return io.BufferedReader(system.open_input_file(path), buffer), system.get_file_info(path).size


#: Where a walk of (file, start, stop) from an entry (None: from the start) finds its first header, where it leaves off, its last fix.
Walk = tuple[int | None, int, Fix | None]


def walk(file: str, start: int, stop: int, entry: int | None, fixes: bool = True) -> Walk:
    """fixes: whether to read clock packets."""
    first, end, fix = None, stop, None
    for f, at, h in chain(file, start if entry is None else entry, stop):
        first = int(at[0]) if first is None else first
        end = max(stop, int(at[-1] + h["pkt_size"][-1]))
        if fixes:
            fix = ([x for _, x in _fixes(f, at, h)] or [fix])[-1]
    return first, end, fix


def _of_type(at: np.ndarray, h: Headers, own: np.ndarray, kind: int) -> tuple[np.ndarray, dict]:
    return at[own], {k: x[own] for k, x in h.items()} | {"data_type": kind}


def _fixes(f: Window, at: np.ndarray, h: Headers) -> list[tuple[int, Fix]]:
    """(number among the packets, fix) of a window's valid clock packets."""
    own = np.flatnonzero(h["data_type"] == CLOCK)
    if not len(own):
        return []
    _, sec_ok, ok, bodies = _body(f, *_of_type(at, h, own, CLOCK))
    found = [(i, clock_fix(int(at[i]), int(h["rtc"][i]), b)) for i, b, s in zip(own.tolist(), bodies, (sec_ok & ok).tolist(), strict=True) if s]
    return [(i, x) for i, x in found if x]


Asked = tuple[str, int, int, int | None]


def joined(files: list[tuple[str, int]], chunk: int) -> int:
    """Bytes of a range: so many times `chunk`, up to CHUNK bytes, that files are cut into about RANGES, besides one a file."""
    n = sum(-(-size // chunk) for _, size in files if size > chunk)
    return chunk * max(1, min(-(-n // RANGES), CHUNK // chunk))


def resolve(files: list[tuple[str, int]], chunk: int, walks: Callable[[list[Asked]], list[Walk]]) -> list[Range]:
    """The ranges of the files, with the chain's entry and the fix that holds there.

    A range whose predecessor leaves off at or before the first header in it is entered there, so its first walk holds. Else
    it is walked again from that place; as chains meet soon, what follows is taken to hold meanwhile, and the next round
    asks again where it doesn't. Every round settles a file's first open range at least. A file of one range is entered at
    its beginning, unwalked.
    """
    cut = {f: [(a, min(a + chunk, size)) for a in range(0, size, chunk)] for f, size in files}
    asked: list[Asked] = [(f, a, b, None) for f, own in cut.items() if len(own) > 1 for a, b in own]
    known: dict[Asked, Walk] = {}
    while True:
        known.update(zip(asked, walks(asked) if asked else [], strict=True))
        out, asked = [], []
        for f, own in cut.items():
            if len(own) == 1:
                out.append(Range(f, *own[0], 0))
                continue
            at, fix = 0, None
            for start, stop in own:
                first, end, last = known[f, start, stop, None]
                entry = None
                if at < stop and first is not None:
                    entry = max(at, first)
                    if at > first:
                        key = (f, start, stop, at)
                        if key in known:
                            entry, end, last = known[key]
                        else:
                            asked.append(key)
                out.append(Range(f, start, stop, entry, fix))
                if entry is not None:
                    at, fix = max(at, end), last or fix
        if not asked:
            return out


def _here(asked: list[Asked], fixes: bool = True) -> list[Walk]:
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(lambda x: walk(*x, fixes), asked))


def _by_spark(spark: SparkSession) -> Callable[[list[Asked]], list[Walk]]:
    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(x.n, *walk(x.file, x.start, x.stop, None if x.entry < 0 else x.entry)) for x in b.itertuples()]
            yield pd.DataFrame([(n, -1 if first is None else first, end, *(fix or (-1, 0, 0, False))) for n, first, end, fix in rows], columns=["n", "first", "end", "at", "rtc", "time", "doy"])

    def walks(asked: list[Asked]) -> list[Walk]:
        rows = [(i, f, a, b, -1 if e is None else e) for i, (f, a, b, e) in enumerate(asked)]
        df = spark.createDataFrame(pd.DataFrame(rows, columns=["n", "file", "start", "stop", "entry"]), "n long, file string, start long, stop long, entry long")
        tasks = max(spark.sparkContext.defaultParallelism, sum(b - a for _, a, b, _ in asked) // LEAST)
        df = df.repartition(max(1, min(len(rows), tasks)), "n")
        found = df.mapInPandas(one, "n long, first long, end long, at long, rtc long, time long, doy boolean").collect()  # a row a range, as the scheduler has
        return [(None if r["first"] < 0 else r["first"], r["end"], None if r["at"] < 0 else (r["at"], r["rtc"], r["time"], r["doy"])) for r in sorted(found, key=lambda r: r["n"])]

    return walks


_ENTRIES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("entry", pa.int64()), ("at", pa.int64()), ("rtc", pa.int64()), ("time", pa.int64()), ("doy", pa.bool_())])


def write_entries(spark: SparkSession, path: str, chunk: int = CHUNK) -> str:
    """A table of a recording's ranges, found by Spark jobs, for the option `entries`; its path. Ranges have `chunk` bytes, or some times as many (joined())."""
    files = recordings(path)
    ranges = resolve(files, joined(files, chunk), _by_spark(spark))
    columns = zip(*[(r.file, r.start, r.stop, r.entry, *(r.fix or (None,) * 4)) for r in ranges], strict=True) if ranges else [[]] * 8
    out = shared_folder(spark, "entries") + "/entries.parquet"
    system, at = located(out)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    with system.open_output_stream(at) as f:
        pq.write_table(pa.Table.from_arrays([pa.array(c, k.type) for c, k in zip(columns, _ENTRIES, strict=True)], schema=_ENTRIES), f)
    return out


def read_entries(path: str) -> list[Range]:
    system, at = located(path)
    with system.open_input_file(at) as f:
        rows = pq.read_table(f).to_pylist()
    return [Range(r["file"], r["start"], r["stop"], r["entry"], None if r["at"] is None else (r["at"], r["rtc"], r["time"], r["doy"])) for r in rows]


def read_recording(spark: SparkSession, path: str, chunk: int = CHUNK, **options) -> DataFrame:
    """Packets of a recording, or of all in a directory, with the clock fix that holds for each (FIX columns; null before the first).

    Spark jobs find where the chain of packets enters each range of `chunk` bytes (of more, where there would be over RANGES). Conditions on data_type, channelid and
    file are taken over by the reader, which skips other packets' bodies.
    """
    spark.dataSource.register(PacketSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("ch10").options(entries=write_entries(spark, path, chunk), chunk=chunk, pushdown="true", fixes="true", **options).load(path)


_PACKET_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_(), pa.bool_(), *[pa.int32()] * 3, pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.binary()]
_FIX_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]


class PacketSource(DataSource):
    """spark.read.format("ch10").load(path): one row per packet, from any file system that pyarrow opens.

    Options: entries (a table of write_entries(); without it the driver's threads follow the packets' headers), chunk (bytes of
    a range; joined() puts ranges together where there are very many), maxChunks (a file's packets that begin in so many first chunks only), types (codes, with commas: only such packets),
    fixes (true: with FIX columns), pushdown (true: takes conditions over; Spark's filterPushdown setting must be on).
    """

    @classmethod
    def name(cls) -> str:
        return "ch10"

    def schema(self) -> str:
        return PACKETS + (", " + FIX if self.options.get("fixes") == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return (_PushingReader if self.options.get("pushdown") == "true" else _Reader)(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.chunk, self.entries = options["path"], int(options.get("chunk", CHUNK)), options.get("entries")
        self.kept: dict[str, set] = {"data_type": {int(x) for x in options["types"].split(",")}} if "types" in options else {}
        self.most = int(options["maxChunks"]) if "maxChunks" in options else None
        self.fixes = options.get("fixes") == "true"

    def partitions(self) -> list[Share]:
        size = lambda n: n if self.most is None else min(n, self.most * self.chunk)
        if self.entries:
            ranges = [replace(r, stop=size(r.stop)) for r in read_entries(self.entries)]
        else:
            files = [(f, size(n)) for f, n in recordings(self.path)]
            ranges = resolve(files, joined(files, self.chunk), partial(_here, fixes=self.fixes))
        files = self.kept.get("file")
        return shares([r for r in ranges if r.entry is not None and r.start < r.stop and (files is None or r.file in files)]) or [Share([])]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for r in partition.ranges:
            yield from packet_batches(r, self.kept.get("data_type"), self.kept.get("channelid"), self.fixes)


class _PushingReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for x in filters:
            name = x.attribute[0] if isinstance(x, (EqualTo, In)) and len(x.attribute) == 1 else None
            if name not in ("data_type", "channelid", "file"):
                yield x
                continue
            own = set(x.value) if isinstance(x, In) else {x.value}
            self.kept[name] = self.kept[name] & own if name in self.kept else own


def packet_batches(part: Range, types: set[int] | None = None, channels: set[int] | None = None, fixes: bool = False) -> Iterator[pa.RecordBatch]:
    """Packets that begin in a range. Of given types and channels alone the bodies are read; of clock packets too where fixes are asked for."""
    if part.entry is None:
        return
    names = [x.split()[0] for x in (PACKETS + (", " + FIX if fixes else "")).split(", ")]
    kinds = _PACKET_TYPES + (_FIX_TYPES if fixes else [])
    held, rows, size, fix = [], 0, 0, part.fix
    merged = lambda: pa.Table.from_batches(held).combine_chunks().to_batches(_ROWS)
    for f, at, h in chain(part.file, part.entry, part.stop, _READ if types is None and channels is None else _WALK):
        wanted = np.ones(len(at), bool)
        for name, own in (("data_type", types), ("channelid", channels)):
            if own is not None:
                wanted &= np.isin(h[name], [x for x in own if x is not None])
        known = [(-1, fix), *(_fixes(f, at, h) if fixes else [])]
        fix = known[-1][1]
        if not wanted.any():
            continue
        secs, bodies, sec_ok, ok = [None] * len(at), [None] * len(at), np.ones(len(at), bool), np.ones(len(at), bool)
        for kind in np.unique(h["data_type"][wanted]).tolist():
            own = np.flatnonzero(wanted & (h["data_type"] == kind))
            of_sec, sec_ok[own], ok[own], of_body = _body(f, *_of_type(at, h, own, kind))
            for i, sec, body in zip(own.tolist(), of_sec, of_body, strict=True):
                secs[i], bodies[i] = sec, body
        own = np.flatnonzero(wanted)
        taken = [[x[i] for i in own.tolist()] for x in (secs, bodies)]
        cells = [at, *h.values(), taken[0], sec_ok, ok, taken[1]]
        columns = [pa.repeat(pa.scalar(part.file, pa.string()), len(own)), *[pa.array(x if isinstance(x, list) else x[own].astype(k.to_pandas_dtype()), k) for x, k in zip(cells, _PACKET_TYPES[1:], strict=True)]]
        if fixes:
            holds = np.searchsorted([i for i, _ in known], own, "right") - 1
            columns += [pa.array([None if x is None else x[j] for _, x in known], k).take(pa.array(holds)) for j, k in enumerate(_FIX_TYPES)]
        held.append(pa.RecordBatch.from_arrays(columns, names=names))
        rows, size = rows + len(own), size + sum(map(len, taken[1]))
        if rows >= _ROWS or size >= _BYTES:
            yield from merged()
            held, rows, size = [], 0, 0
    if held:
        yield from merged()
