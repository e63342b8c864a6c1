"""Approximate nearest neighbours by inner product: multi-index hashing of learned binary codes.

A vector gets a coordinate that makes all lengths equal, so that the largest inner product is the smallest angle; principal
axes and a rotation learned to lie close to the corners of a cube (ITQ) turn it into BITS bits. A code is cut into TABLES
substrings and each is an index: if two codes differ in at most r bits, then in one substring j they differ in at most t_j,
where the t_j + 1 add up to r + 1. So a query looks up, in each index, the substrings within t_j bits of its own, and finds
every code within r; a code that an earlier index finds as well is left to that one. What is found is scored with the
vectors themselves.

How far a query looks is learned too: a share of KEEP of the true neighbours of CALIBRATION queries, found by brute force,
lies within the common radius; a query whose neighbours in a fixed pool are nearer looks no farther than such neighbours'
codes lie. So a dense group isn't searched with the radius that sparse regions need.

An index is cut by the first bits of its substrings into cells, a cell by its rows and queries into blocks of fixed size;
queries go to the cells that they can reach. Equal vectors are one entry with its k + 1 least ids, which are all that a
result can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, lean, need, whole_runs

BITS, TABLES = 64, 4
_PART = BITS // TABLES
#: Vectors that the codes are learned from, that queries are held against for a first guess, and queries with known neighbours, at most.
SAMPLE, POOL, CALIBRATION = 16_384, 8192, 128
KEEP = 0.97
#: Numbers in a block of vectors; rows and queries of a block at most.
_NUMBERS, _ROWS = 1 << 22, 32_768
MOST_WIDTHS = 16


def whole_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, h1, h2): vectors that are neither null nor zero nor hold null or non-finite components, each named by 128 bits. Null ids go."""
    need(vectors, id_col, vector_col)
    v = F.col(vector_col)
    if "float" not in vectors.schema[vector_col].dataType.simpleString():
        v = v.cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    # A zero has two signs, which count as one.
    plain = F.transform("v", lambda x: x + F.lit(0.0).cast("float"))
    return rows.select("vec_id", "v", F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(1), plain).alias("h2"))


@dataclass
class Codes:
    """What encodes vectors of one number of components, and how far to look."""

    longest: float
    mean: np.ndarray
    axes: np.ndarray  # a column a bit
    pool: np.ndarray
    radius: int = BITS
    by_angle: np.ndarray | None = None  # radius for neighbours at most so many steps of an angle away

    def encode(self, v: np.ndarray, query: bool) -> np.ndarray:
        length = np.linalg.norm(v, axis=1)
        if query:  # of a query the direction counts alone
            x = np.column_stack([v / length[:, None], np.zeros(len(v))])
        else:
            x = np.column_stack([v, np.sqrt(np.maximum(0.0, self.longest**2 - length**2))]) / self.longest
        bits = (x - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]

    def angle(self, scores: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(scores / (np.linalg.norm(v, axis=1)[:, None] * self.longest), -1, 1))

    def looked_at(self, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Each query's radius, and a score that its k-th best of what it will find reaches (k counts what may be its own vector).

        At least k codes of the pool lie within the radius, where the pool has so many; else it is BITS.
        """
        if len(self.pool) < k:
            return np.full(len(v), BITS), np.full(len(v), -np.inf)
        scores = v @ self.pool.T
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        step = np.minimum((self.angle(least, v)[:, 0] * STEPS / np.pi).astype(int) + 1, STEPS)
        distances = np.bitwise_count(self.encode(v, True)[:, None] ^ self.encode(self.pool, False)[None, :])
        radius = np.maximum(np.minimum(self.radius, self.by_angle[step]), np.partition(distances, k - 1, axis=1)[:, k - 1])
        scores[distances > radius[:, None]] = -np.inf
        floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        # The pool's products may be rounded otherwise than those of the search.
        return radius, floor - 1e-9 * np.abs(floor)


STEPS = 90


def learn(v: np.ndarray, longest: float, seed: int = 0) -> Codes:
    """Codes from a sample: principal axes, BITS at most (taken again under another rotation where there are fewer), rotated towards the corners of a cube."""
    c = Codes(longest, np.zeros(v.shape[1] + 1), np.zeros((0, 0)), v[:POOL].copy())
    x = np.column_stack([v, np.sqrt(np.maximum(0.0, longest**2 - (v * v).sum(1)))]) / longest
    c.mean = x.mean(0)
    x = x - c.mean
    _, principal = np.linalg.eigh(x.T @ x)
    principal = principal[:, ::-1][:, : min(BITS, v.shape[1])]
    z, random, frames = x @ principal, np.random.default_rng(seed), []
    for _ in range(-(-BITS // principal.shape[1])):
        r = np.linalg.qr(random.normal(size=(principal.shape[1],) * 2))[0]
        for _ in range(50):
            u, _, vt = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
            r = (u @ vt).T
        frames.append(principal @ r)
    c.axes = np.concatenate(frames, axis=1)[:, :BITS]
    return c


def calibrate(c: Codes, queries: np.ndarray, neighbours: list[tuple[int, float, int]]) -> None:
    """Sets the radii. neighbours: (query, score, code's distance) of the queries' true neighbours among all rows."""
    where = np.array([n[0] for n in neighbours], int)
    near = np.array([n[2] for n in neighbours], int)
    angles = c.angle(np.array([n[1] for n in neighbours], float)[:, None], queries[where])[:, 0]
    c.radius = int(np.quantile(near, KEEP, method="higher")) if len(near) else BITS
    others = np.bitwise_count(c.encode(queries, True)[:, None] ^ c.encode(c.pool, False)[None, :]).ravel()
    angles = np.concatenate([angles, c.angle(queries @ c.pool.T, queries).ravel()])
    near = np.concatenate([near, others])
    angles, near = angles[angles > 2e-6], near[angles > 2e-6]  # a vector is no neighbour of its own
    step = np.minimum((angles * STEPS / np.pi).astype(int), STEPS)
    out = np.full(STEPS + 1, BITS)
    for s in range(STEPS, -1, -1):  # a step without pairs is as wide as the next one
        own = near[step == s]
        out[s] = int(np.quantile(own, KEEP, method="higher")) if len(own) >= 20 else out[min(s + 1, STEPS)]
    c.by_angle = np.maximum.accumulate(out)


def _vectors(lists: pa.Array, rows: np.ndarray, d: int) -> np.ndarray:
    return np.asarray(lists.values, "f8")[np.asarray(lists.offsets)[rows][:, None] + np.arange(d)]


def _by_width(batch: pa.RecordBatch, name: str, most: int = 4096) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, row numbers, matrix) for each number of components in a batch, at most so many rows at once."""
    lists = batch.column(batch.schema.get_field_index(name))
    widths = np.diff(np.asarray(lists.offsets))
    for d in np.unique(widths):
        at = np.flatnonzero(widths == d)
        for i in range(0, len(at), most):
            yield int(d), at[i : i + most], _vectors(lists, at[i : i + most], d)


def _coded(codes, query: bool, k: int, fields: list[str]):
    """mapInArrow: adds d and code, and for queries radius and floor, to the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, v in _by_width(batch, "v"):
                if d not in codes.value:
                    continue
                c = codes.value[d]
                more = [pa.array(np.full(len(rows), d, "i4")), pa.array(c.encode(v, query).view("i8"))]
                if query:
                    radius, least = c.looked_at(v, k)
                    more += [pa.array(radius.astype("i4")), pa.array(least)]
                yield pa.RecordBatch.from_arrays([*[x.take(pa.array(rows)) for x in batch.columns], *more], names=fields)

    return run


def _nearest(asked, k: int):
    """mapInArrow over entries: each calibration query's k best of a task, and how far their codes lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("h1", "h2")])
            code = batch.column(batch.schema.get_field_index("code")).to_numpy().view("u8")
            for d, rows, v in _by_width(batch, "v"):
                if d not in asked.value:
                    continue
                q, qcode, names = asked.value[d]
                scores = q @ v.T
                scores[(names[:, None, :] == own[rows][None, :, :]).all(2)] = -np.inf
                n = min(k, len(rows))
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                at = np.arange(len(q))[:, None]
                found = np.stack([scores[at, top], np.bitwise_count(qcode[:, None] ^ code[rows][top]).astype(float)], axis=2)
                found = np.concatenate([best[d], found], axis=1) if d in best else found
                order = np.argsort(-found[:, :, 0], axis=1)[:, :k]
                best[d] = found[at, order]
        for d, found in best.items():
            q, n, _ = found.shape
            yield pa.RecordBatch.from_arrays([pa.array(np.full(q * n, d, "i4")), pa.array(np.repeat(np.arange(q, dtype="i4"), n)), pa.array(found[:, :, 0].ravel()), pa.array(found[:, :, 1].ravel().astype("i4"))], names=["d", "query", "score", "distance"])

    return run


def thresholds(radius: np.ndarray) -> np.ndarray:
    """(queries, TABLES): bits that a substring may differ in; -1 where an index isn't asked. The values plus 1 add up to the radius plus 1."""
    share, rest = np.divmod(radius + 1, TABLES)
    return share[:, None] + (np.arange(TABLES)[None, :] < rest[:, None]) - 1


def substrings(code: np.ndarray) -> np.ndarray:
    """(codes, TABLES)"""
    return (code[:, None] >> (np.arange(TABLES, dtype="u8") * np.uint64(_PART))) & np.uint64((1 << _PART) - 1)


def _cells(batch: pa.RecordBatch, bits: int, query: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) pairs of a batch: a cell is TABLE * 2**bits + the substring's first bits."""
    code = batch.column(batch.schema.get_field_index("code")).to_numpy().view("u8")
    first = (substrings(code) >> np.uint64(_PART - bits)).astype("i8")
    if not query:
        return np.repeat(np.arange(len(code)), TABLES), (np.arange(TABLES) * (1 << bits) + first).ravel()
    far = thresholds(batch.column(batch.schema.get_field_index("radius")).to_numpy().astype("i8"))
    reached = np.bitwise_count(first[:, :, None] ^ np.arange(1 << bits)[None, None, :]) <= far[:, :, None]
    row, table, cell = np.nonzero(reached)
    return row, table * (1 << bits) + cell


def _visits(bits: int, query: bool):
    """mapInArrow: how many rows of a task each cell takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            d = batch.column(batch.schema.get_field_index("d")).to_numpy()
            row, cell = _cells(batch, bits, query)
            for w in np.unique(d):
                n = np.bincount(cell[d[row] == w], minlength=TABLES << bits)
                total[int(w)] = total.get(int(w), 0) + n
        for w, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), w, "i4")), pa.array(at.astype("i4")), pa.array(n[at].astype("i8"))], names=["d", "cell", "n"])

    return run


_DEALT = ["block", "kind", "h1", "h2", "code", "radius", "floor", "ids", "v"]


def _dealt(layout, bits: int, query: bool):
    """mapInArrow: a row a block that the row goes to. layout: by width, for each cell its first block, shares of rows and shares of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731, B023
            d, h1 = get("d").to_numpy(), get("h1").to_numpy()
            row, cell = _cells(batch, bits, query)
            for w in np.unique(d):
                if int(w) not in layout.value:
                    continue
                mine = d[row] == w
                r, c = row[mine], cell[mine]
                first, shares, turns = (x[c] for x in layout.value[int(w)])
                fixed, free = (turns, shares) if query else (shares, turns)
                times = np.where(fixed > 0, free, 0)
                at = np.repeat(np.arange(len(r)), times)
                other = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                own = (h1[r[at]] >> 8) % np.maximum(1, fixed[at])
                block = first[at] + (other * turns[at] + own if query else own * turns[at] + other)
                for i in range(0, len(at), 16_384):
                    rows, n = pa.array(r[at[i : i + 16_384]]), len(at[i : i + 16_384])
                    radius, floor = (get("radius").take(rows), get("floor").take(rows)) if query else (pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array(block[i : i + 16_384]), pa.array(np.full(n, int(query), "i4")), *[get(x).take(rows) for x in ("h1", "h2", "code")], radius, floor, get("ids").take(rows), get("v").take(rows)], names=_DEALT)

    return run


def _table_of(block: int, layout: dict, bits: int) -> int:
    """The index that a block belongs to."""
    for first, _, _ in layout.values():
        if first[0] <= block and block < first[-1]:
            return int(np.searchsorted(first, block, side="right") - 1) >> bits
    raise ValueError(block)


def _found_in(table: int, codes: np.ndarray, v: np.ndarray, qcodes: np.ndarray, q: np.ndarray, radius: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, rows, scores) of a block: codes within the radius that this index finds and no earlier one, scored; a query's best k and ties."""
    parts, qparts, far = substrings(codes), substrings(qcodes), thresholds(radius)
    order = np.argsort(parts[:, table], kind="stable")  # the index: rows by substring
    values, starts = np.unique(parts[order, table], return_index=True)
    counts = np.diff([*starts, len(order)])
    for i in range(0, len(qcodes), 128):
        s = slice(i, i + 128)
        probed = np.bitwise_count(values[None, :] ^ qparts[s, table][:, None]) <= far[s, table][:, None]
        a, b = np.nonzero(probed)
        times = counts[b]
        if not times.sum():
            continue
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        a, row = np.repeat(a, times), order[np.repeat(starts[b], times) + inside]
        near = np.bitwise_count(codes[row] ^ qcodes[s][a]) <= radius[s][a]
        for j in range(table):
            near &= np.bitwise_count(parts[row, j] ^ qparts[s, j][a]) > far[s, j][a]
        a, row = a[near], row[near]
        scores = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", q[s][a[x : x + 16_384]], v[row[x : x + 16_384]]) for x in range(0, len(a), 16_384)]])
        ok = scores >= floor[s][a]
        a, row, scores = a[ok], row[ok], scores[ok]
        by = np.lexsort((-scores, a))
        a, row, scores = a[by], row[by], scores[by]
        begin = np.searchsorted(a, np.arange(min(128, len(qcodes) - i)))
        last = np.minimum(begin + k, np.append(begin[1:], len(a))) - 1  # each query's k-th best or its last
        if len(a):
            ok = scores >= scores[np.maximum(last, 0)][a]
            yield a[ok] + i, row[ok], scores[ok]


_FOUND = "h1 long, h2 long, own boolean, vec_id long, score double"


def _searched(layout, bits: int, k: int):
    """mapInArrow over rows sorted by block and kind: each query's best k ids of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ("block",), 1):
            blocks = t.column("block").to_numpy()
            ends = [*np.flatnonzero(np.diff(blocks)) + 1, len(t)]
            for start, end in zip([0, *ends[:-1]], ends, strict=True):
                own = t.slice(start, end - start).combine_chunks()
                n = int((own.column("kind").to_numpy() == 0).sum())
                if not n or n == len(own):
                    continue
                get = lambda name: own.column(name).to_numpy()  # noqa: E731, B023
                lists = own.column("v").chunk(0)
                d = lists.offsets[1].as_py() - lists.offsets[0].as_py()
                v = _vectors(lists, np.arange(len(own)), d)
                code, h1, h2 = get("code").view("u8"), get("h1"), get("h2")
                ids = own.column("ids").chunk(0)
                offsets, flat = np.asarray(ids.offsets), np.asarray(ids.values)
                radius, floor = own.column("radius").slice(n).to_numpy().astype("i8"), own.column("floor").slice(n).to_numpy()
                for a, row, scores in _found_in(_table_of(int(blocks[start]), layout.value, bits), code[:n], v[:n], code[n:], v[n:], radius, floor, k):
                    times = offsets[row + 1] - offsets[row]
                    at = np.repeat(np.arange(len(row)), times)
                    vec = flat[np.repeat(offsets[row], times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)]
                    by = np.lexsort((vec, -scores[at], a[at]))
                    at, vec = at[by], vec[by]
                    place = np.arange(len(at)) - np.searchsorted(a[at], a[at])
                    at, vec = at[place < k], vec[place < k]
                    qa, ra = a[at] + n, row[at]
                    yield pa.RecordBatch.from_arrays([pa.array(h1[qa]), pa.array(h2[qa]), pa.array((h1[qa] == h1[ra]) & (h2[qa] == h2[ra])), pa.array(vec), pa.array(scores[at])], names=["h1", "h2", "own", "vec_id", "score"])

    return run


def _sampled(rows: DataFrame, total: int, most: int) -> DataFrame:
    """About `most` of the rows, chosen by their names, never over twice as many."""
    share = min(1.0, most / max(1, total))
    return rows.where(F.pmod(F.xxhash64(F.lit(7), "h1"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * most)


def search(vectors: DataFrame, is_query: Column, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The nearest rows found for each query row, by inner product: query_id, rank (from 1), vec_id, score.

    is_query: a condition on vec_id, which marks the query rows. Candidates are all rows but the query's own row; another row
    with its id is one. Nearest first, ties to the smaller vec_id; k rows a query, or all candidates if there are fewer. Scores are inner products of the vectors themselves in double precision. Vectors that are null or
    zero, or hold null or non-finite components, take no part, nor do null ids; vectors of another number of components
    aren't compared. Repeated rows count as often as they are there, as queries and as candidates. Other columns are ignored;
    an empty table gives no rows. Over MOST_WIDTHS different numbers of components raise ValueError.

    Codes are learned from about SAMPLE vectors (fewer of over 256 components), radii from CALIBRATION queries' true
    neighbours; every row is indexed.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hamming")
    rows = whole_vectors(vectors, id_col=id_col, vector_col=vector_col)
    # Copies beyond the k + 1 least ids of a vector can't be among anyone's k nearest.
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    entries = rows.withColumn("n", nth).where(F.col("n") <= k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    entries = scratch.write(entries, "entries")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    widths = entries.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(length).alias("longest")).limit(MOST_WIDTHS + 1).collect()
    if len(widths) > MOST_WIDTHS:
        raise ValueError(f"over {MOST_WIDTHS} different numbers of components")
    result = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], result)
    codes, asked = {}, {}
    for w in widths:
        d, most = w["d"], max(256, min(SAMPLE, _NUMBERS // w["d"]))
        own = _sampled(entries.where(F.size("v") == d), w["n"], most).select("h1", "h2", "v").toPandas().sort_values(["h1", "h2"])
        if not len(own):
            own = entries.where(F.size("v") == d).limit(1).select("h1", "h2", "v").toPandas()
        sample = np.stack(own["v"].to_numpy()).astype("f8")
        codes[d] = learn(sample, float(w["longest"]))
        first = sample[-CALIBRATION:]
        asked[d] = (first, codes[d].encode(first, True), own[["h1", "h2"]].to_numpy()[-CALIBRATION:])
    known = spark.sparkContext.broadcast(codes)
    kind = entries.schema["v"].dataType.simpleString()
    coded = entries.mapInArrow(lean(_coded(known, False, k, ["h1", "h2", "ids", "v", "d", "code"])), f"h1 long, h2 long, ids array<long>, v {kind}, d int, code long")
    coded = scratch.write(coded, "coded")
    scratch.drop("entries")
    near = coded.mapInArrow(lean(_nearest(spark.sparkContext.broadcast(asked), k)), "d int, query int, score double, distance int")
    best = Window.partitionBy("d", "query").orderBy(F.col("score").desc(), "distance")
    true: dict[int, list] = {d: [] for d in codes}
    for r in near.where(F.col("score") > float("-inf")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).collect():  # k for each of CALIBRATION queries
        true[r["d"]].append((r["query"], r["score"], r["distance"]))
    for d, c in codes.items():
        calibrate(c, asked[d][0], true[d])
    known = spark.sparkContext.broadcast(codes)
    asking = rows.where(is_query)
    each = asking.groupBy("h1", "h2").agg(F.first("v").alias("v")).select("h1", "h2", F.array().cast("array<long>").alias("ids"), "v")
    queries = each.mapInArrow(lean(_coded(known, True, k + 1, ["h1", "h2", "ids", "v", "d", "code", "radius", "floor"])), f"h1 long, h2 long, ids array<long>, v {kind}, d int, code long, radius int, floor double")
    queries = scratch.write(queries, "queries")
    total = sum(w["n"] for w in widths)
    bits = min(12, max(4, (total // _ROWS).bit_length()))
    counted = [{(r["d"], r["cell"]): r["n"] for r in x.select("d", "code", *(["radius"] if q else [])).mapInArrow(lean(_visits(bits, q)), "d int, cell int, n long").groupBy("d", "cell").agg(F.sum("n").alias("n")).collect()} for x, q in ((coded, False), (queries, True))]
    layout, block = {}, 0
    for d in codes:
        most = max(256, min(_ROWS, _NUMBERS // d))
        shares, turns = ([-(-c.get((d, cell), 0) // most) for cell in range(TABLES << bits)] for c in counted)
        starts = block + np.concatenate([[0], np.cumsum(np.array(shares) * np.array(turns))])
        layout[d] = (starts.astype("i8"), np.array([*shares, 0], "i8"), np.array([*turns, 0], "i8"))
        block = int(starts[-1])
    plan = spark.sparkContext.broadcast(layout)
    schema = f"block long, kind int, h1 long, h2 long, code long, radius int, floor double, ids array<long>, v {kind}"
    dealt = coded.mapInArrow(lean(_dealt(plan, bits, False)), schema).unionByName(queries.mapInArrow(lean(_dealt(plan, bits, True)), schema))
    found = dealt.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(lean(_searched(plan, bits, k + 1)), _FOUND)
    order = Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), "vec_id", F.col("own").desc())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    lists = found.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "own"))).alias("near"))
    mine = F.array_position(F.transform("near", lambda x: x["own"] & (x["vec_id"] == F.col("query_id"))), F.lit(True)).cast("int")
    pairs = asking.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(lists, ["h1", "h2"]).withColumn("mine", mine)
    left = F.slice(F.filter("near", lambda x, i: i + 1 != F.col("mine")), 1, k)
    return pairs.select("query_id", F.posexplode(left).alias("place", "x")).select("query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", "x.score")
