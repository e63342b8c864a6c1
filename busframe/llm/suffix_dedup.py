"""Removal of repeated byte strings by suffix arrays.

Every string of LENGTH bytes contains anchors: in each window the GRAM-byte string with the least hash is selected, so equal
windows select equal anchors at equal places, and each window belongs to one anchor. Windows can only be equal if their
anchors are. An anchor that occurs once is settled; so is one whose whole surroundings (all windows it owns) occur again,
which pre-aggregated counts tell. For the rest the surroundings are dealt out by anchor and compared in a suffix array of
their own, built by two-stage sorting: only suffixes smaller than their successors are sorted directly, the others are
induced by bucket scans; adjacent common prefixes of LENGTH bytes are the repeats. Suffix arrays are of bounded size: the
windows of an anchor with over HOT different surroundings are compared as rows of their own, by content.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import lean, need, whole_runs, Scratch

LENGTH, GRAM = 200, 64
HOT, BLOCK = 4096, 1 << 18
FILTER = 1 << 20
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 22
_C = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, "u8"), np.full(size - 1, c, "u8")))) for c in (_C, pow(_C, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, last window start, anchor place, anchor hash) of each anchor of a text."""
    parts = []
    for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
        b = np.frombuffer(text[at : at + CHUNK + LENGTH - 1], "u1")
        n = len(b)
        if n < LENGTH:
            continue
        up, down = _power_tables(n)
        sums = np.zeros(n + 1, "u8")
        np.cumsum(b.astype("u8") * up, out=sums[1:])
        g = (sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1]
        g ^= g >> np.uint64(32)
        g *= np.uint64(0xD6E8FEB86659FD93)
        g ^= g >> np.uint64(29)
        m, w = len(g), LENGTH - GRAM + 1
        v = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype="u8")
        # Least value of each run of w: the least to the end of its block of w, or from the start of the next.
        padded = np.full(-(-m // w) * w, np.iinfo("u8").max, "u8")
        padded[:m] = v
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(blocks, axis=1).ravel()
        q = (np.minimum(ahead[: m - w + 1], behind[w - 1 : m]) & np.uint64(0xFFFFFFFF)).astype("i8")
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        last = np.append(first[1:], len(q)) - 1
        parts.append((first + at, last + at, q[first] + at, g[q[first]].view("i8")))
    if not parts:
        none = np.empty(0, "i8")
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first LENGTH bytes at least, by two-stage sorting. words: see _words."""
    n = len(text)
    following = np.append(text[1:], 0)
    unequal = text != following
    unequal[-1] = True
    smaller = text < following
    smaller[-1] = False  # the last suffix has only the empty one after it
    # An equal byte takes the kind of the next unequal place.
    to = np.where(unequal, np.arange(n), n)
    to = np.minimum.accumulate(to[::-1])[::-1]
    smaller = smaller[to]
    direct = _sorted(np.flatnonzero(smaller), words)
    starts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        more = [x for x in waiting[c] if len(x)]
        here = list(more)
        turn = np.concatenate(more) if more else np.empty(0, "i8")
        while len(turn):  # runs of c
            before = turn[turn > 0] - 1
            turn = before[text[before] == c]
            here.append(turn)
        here.append(direct[starts[c] : starts[c + 1]])
        bucket = np.concatenate(here)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~smaller[before] & (text[before] > c)]
        if len(before):
            ch = text[before]
            order = np.argsort(ch, kind="stable")
            before, ch = before[order], ch[order]
            cut = np.flatnonzero(np.concatenate(([True], ch[1:] != ch[:-1])))
            for x, y in zip(cut, [*cut[1:], len(ch)], strict=True):
                waiting[ch[x]].append(before[x:y])
    return np.concatenate(out)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian number, zeros after the end."""
    padded = np.concatenate((text, np.zeros(LENGTH + 8, "u1"))).astype("u8")
    n = len(padded) - 7
    out = np.zeros(n, "u8")
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + n]
    return out


def _offsets() -> list[int]:
    return [*range(0, LENGTH - 7, 8), *([LENGTH - 8] if LENGTH % 8 else [])]


def _sorted(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places by the LENGTH bytes that follow them: by eight bytes, then what ties by the next eight, and so on."""
    order = np.argsort(words[places], kind="stable")
    places = places[order].copy()
    first = words[places]
    new = np.concatenate(([True], first[1:] != first[:-1])) if len(places) else np.empty(0, bool)
    group = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0)) if len(places) else places
    tied = np.arange(len(places))
    for offset in _offsets()[1:]:
        alone = np.concatenate((new[1:], [True])) & new if len(new) else new
        tied, group = tied[~alone], group[~alone]
        if not len(tied):
            break
        at = places[tied]
        key = words[np.minimum(at + offset, len(words) - 1)]
        order = np.lexsort((key, group))
        places[tied] = at[order]
        key, old = key[order], group[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])))
        group = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        group = tied[group]
    return places


def repeated(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Mask over `wanted` (places in order): whether the LENGTH bytes from there start at another of them too."""
    words = _words(text)
    mask = np.zeros(len(text), bool)
    mask[wanted] = True
    order = suffix_array(text, words)
    order = order[mask[order]]
    x, y = order[:-1], order[1:]
    same = np.arange(len(x))
    for offset in _offsets():
        same = same[words[x[same] + offset] == words[y[same] + offset]]
    found = np.zeros(len(text), bool)
    found[x[same]] = True
    found[y[same]] = True
    return found[wanted]


def _key(text: bytes) -> int:
    """As xxhash64() of the text as a string in Spark."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >> 63 else h




def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for b in batches:
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for t in b.column(0):
            text = t.as_py()
            key = _key(text)
            if key in seen:
                continue
            seen.add(key)
            first, last, _, h = anchors(text)
            if not len(first):
                continue
            c = np.fromiter((xxhash.xxh3_64_intdigest(text[x : y + LENGTH]) for x, y in zip(first.tolist(), last.tolist(), strict=True)), "u8", len(first)).view("i8")
            for part, x in zip(out, (np.full(len(first), key), first, last, h, c), strict=True):
                part.append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["key", "first", "last", "anchor", "around"])


_SEGMENT = "anchor long, hot boolean, key long, first long, segment binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, its anchors to compare) to the surroundings of each."""
    for b in batches:
        for i in range(0, b.num_rows, 200):
            rows = [(a["anchor"], a["hot"], r["key"], a["first"], r["text"][a["first"] : a["last"] + LENGTH]) for r in b.slice(i, 200).to_pylist() for a in r["found"]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["anchor", "hot", "key", "first", "segment"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of their anchors, so many whole groups at once that their surroundings are BLOCK bytes or so, however large the batches."""
    for part in whole_runs(batches, ("anchor",), BLOCK):
        anchor = part.column("anchor").to_numpy()
        ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
        sizes = np.cumsum(pc.binary_length(part.column("segment")).to_numpy().astype("i8"))
        at = done = 0
        while at < len(anchor):
            end = int(ends[min(np.searchsorted(sizes[ends - 1], done + BLOCK), len(ends) - 1)])
            yield part.slice(at, end - at)
            at, done = end, int(sizes[end - 1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings in order of their anchors to the stretches that repeat; a suffix array is of BLOCK bytes or so, and of whole groups."""
    for part in _blocks(batches):
        pieces = [x.as_py() for x in part.column("segment")]
        starts = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        text = np.frombuffer(b"".join(pieces), "u1")
        wanted = np.concatenate([np.arange(s, e - LENGTH + 1) for s, e in zip(starts[:-1], starts[1:], strict=True)])
        hits = wanted[repeated(text, wanted)]
        if not len(hits):
            continue
        piece = np.searchsorted(starts, hits, "right") - 1
        new = np.concatenate(([True], (hits[1:] != hits[:-1] + 1) | (piece[1:] != piece[:-1])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hits)) - 1
        which = piece[first]
        base = part.column("first").to_numpy()[which] - starts[which]
        yield pa.RecordBatch.from_arrays([pa.array(part.column("key").to_numpy()[which]), pa.array(base + hits[first]), pa.array(base + hits[last] + LENGTH)], names=["key", "start", "stop"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            segments = part.column("segment").to_pylist()
            counts = [len(s) - LENGTH + 1 for s in segments]
            w = np.fromiter((xxhash.xxh3_64_intdigest(s[j : j + LENGTH]) for s, n in zip(segments, counts, strict=True) for j in range(n)), "u8", sum(counts)).view("i8")
            start = np.concatenate([f + np.arange(n) for f, n in zip(part.column("first").to_pylist(), counts, strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("anchor").to_numpy(), counts)), pa.array(w), pa.array(np.repeat(part.column("key").to_numpy(), counts)), pa.array(start)], names=["anchor", "w", "key", "start"])


def _cut(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, all, spans, kept columns) to kept bytes and counts."""
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            kept, removed, runs = [], [], []
            for text, whole, spans in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                text = text or b""
                merged: list[list[int]] = [[0, len(text)]] if whole else []
                if not whole:
                    for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                edges = [0, *(x for m in merged for x in m), len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)) if merged else text)
                removed.append(len(text) - len(kept[-1]))
                runs.append(len(merged))
            yield pa.RecordBatch.from_arrays([*part.columns[3:], pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=names)


def dedup(docs: DataFrame, *, keep: list[str], text_col: str = "text") -> DataFrame:
    """Removes every byte that lies in a LENGTH-byte string which starts at another place too, in any text.

    Returns the columns `keep` of every row of `docs`, then n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (binary: the bytes that stay). Columns of `keep` with these names are replaced. Strings are judged on the input and
    don't cross texts; all their places are removed, none is spared. Null texts are empty; texts under LENGTH bytes stay.
    Repeated rows are repeated texts, so from LENGTH bytes on nothing of them stays. An empty table gives no rows.
    Places in texts are told apart by a 64-bit hash of the text; a text is taken for a copy only if a second hash and its
    length agree too.
    """
    need(docs, text_col, *keep)
    keep = [c for c in keep if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("key"), text.cast("binary").alias("text")).where(F.octet_length("text") >= LENGTH)
    found = scratch.write(texts.select("text").mapInArrow(lean(_anchor_rows), "key long, first long, last long, anchor long, around long"), "anchors")
    place = F.xxhash64("key", "first")
    around = found.groupBy("anchor", "around").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    around = scratch.write(around, "around")
    several = around.groupBy("anchor").agg(F.min("lo").alias("x"), F.max("hi").alias("y"), F.count("*").alias("n")).where("x <> y").select("anchor", "n")
    marked = around.join(several, "anchor").select("anchor", "around", (F.col("lo") != F.col("hi")).alias("whole"), "lo", "n")
    # Surroundings that occur again repeat as a whole; one of their places stays to be compared with other surroundings.
    compared = ~F.col("whole") | (F.col("n") > 1) & (place == F.col("lo"))
    marked = scratch.write(found.join(marked, ["anchor", "around"]).select("key", "first", "last", "anchor", "whole", compared.alias("compared"), (F.col("n") > HOT).alias("hot")), "marked")
    scratch.drop("anchors", "around")
    marked = marked.distinct()  # tasks repeat texts
    spans = marked.where("whole").select("key", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))

    open_ = scratch.write(marked.where("compared").groupBy("key").agg(F.collect_list(F.struct("anchor", "hot", "first", "last")).alias("found")), "open")
    hit = open_.select(F.pmod("key", F.lit(FILTER)).alias("x")).distinct().toPandas()["x"].to_numpy()  # FILTER at most
    if len(hit):
        mask = np.zeros(FILTER, bool)
        mask[hit] = True
        mask = spark.sparkContext.broadcast(np.packbits(mask))

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits, seen = np.unpackbits(mask.value).astype(bool), set()
            for b in batches:
                keys = b.column(0).to_pylist()
                take = []
                for k in keys:
                    take.append(bool(bits[k % FILTER]) and k not in seen)
                    if take[-1]:
                        seen.add(k)
                yield b.filter(pa.array(take, pa.bool_()))

        some = texts.mapInArrow(lean(sift), "key long, text binary").groupBy("key").agg(F.min("text").alias("text"))
        segments = scratch.write(some.join(open_, "key").select("key", "text", "found").mapInArrow(lean(_segments), _SEGMENT), "segments")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spans = spans.unionByName(segments.where("not hot").repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(lean(_compare), "key long, start long, stop long"))
        windows = segments.where("hot").mapInArrow(lean(_windows), "anchor long, w long, key long, start long")
        twice = windows.groupBy("anchor", "w").agg(F.min(F.xxhash64("key", "start")).alias("x"), F.max(F.xxhash64("key", "start")).alias("y")).where("x <> y").select("anchor", "w")
        spans = spans.unionByName(windows.join(twice, ["anchor", "w"], "left_semi").select("key", "start", (F.col("start") + LENGTH).alias("stop")))

    other = F.xxhash64(F.lit(9), F.col("text"))  # a text goes as a copy if both hashes and its length are another's
    copies = texts.groupBy("key", F.octet_length("text").alias("n"), other.alias("other")).count().where("count > 1")
    copies = copies.groupBy("key").agg(F.collect_set(F.struct("n", "other")).alias("copies"))
    cuts = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).join(copies, "key", "full")
    cuts = scratch.write(cuts, "cuts")
    rows = docs.select(text.cast("binary").alias("__text"), F.xxhash64(text).alias("__key"), *[docs[c].alias(f"__keep_{i}") for i, c in enumerate(keep)])
    rows = rows.join(cuts.select(F.col("key").alias("__key"), "copies", "spans"), "__key", "left")
    whole = F.array_contains("copies", F.struct(F.octet_length("__text").alias("n"), F.xxhash64(F.lit(9), F.col("__text")).alias("other")))
    rows = rows.select("__text", F.coalesce(whole, F.lit(False)).alias("whole"), "spans", *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)])
    schema = docs.select(*keep).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    return rows.mapInArrow(lean(partial(_cut, [f.name for f in schema.fields])), schema)
