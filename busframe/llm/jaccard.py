"""N-gram Jaccard join: all links between documents whose shingle sets have a likeness of 3/4 or more, as components.

Equal sets are one node. A tile holds the nodes that share a token of their prefixes (the least n - ceil(3n/4) + 1 tokens
of a set in one global order, frequent tokens last): two sets that link must meet in a tile. Within a tile, nodes compare
only inside the band of sizes that a link allows, by hashed bitmap signatures, whose counts of differing bits bound the
overlap from above. A tile gives no pairs: it gives each node the least node that allowed pairs lead it to. So a cluster,
which is what is connected by allowed pairs, holds every link of its nodes, at a row per node and task.

Within clusters links are settled by intersecting the exact sorted arrays, which are dealt out once, by cluster. A cluster
too large for a task is cut by hash into parts: parts are settled alone, twice with other cuts, which joins most of its nodes;
then only what lies outside its largest component is compared with the rest, block by block. Here too a task gives a row per
node, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import connected_components, lean, need, whole_runs, Scratch

WORDS = 5
#: Least likeness, as a fraction.
NUM, DEN = 3, 4
#: Buckets that mark frequent tokens (only their order depends on it), and of the filter of texts whose sets are compared.
COUNTERS, FILTER = 1 << 22, 1 << 22
#: A token counts as frequent if it occurs so often in SAMPLE hashes of a task, and WIDESPREAD times over all tasks.
SAMPLE, OFTEN, WIDESPREAD = 1 << 21, 8, 64
#: Bits of a signature at most: those of longer sets allow more, but a set's rows grow with its length only.
WIDEST = 1 << 14
#: Rows of a tile from which it is cut into blocks; sets and bytes of sets from which a cluster is cut into parts; bytes taken up at once.
HOT, MANY, PART, BYTES = 1 << 14, 1 << 13, 1 << 23, 1 << 23
#: Places by size up to which all tiles are compared at once.
LAG = 4
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes; fewer words than `words` are one shingle, none give the empty set."""
    said = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not said:
        return np.empty(0, "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, said), "u8", len(said))
    k = min(words, len(said))
    out = np.full(len(h) - k + 1, k, "u8")
    for j in range(k):
        out = out * _P + h[j : j + len(out)]
    out = (out ^ (out >> np.uint64(30))) * _M1
    out = (out ^ (out >> np.uint64(27))) * _M2
    return np.unique(out ^ (out >> np.uint64(31)))


def bitmap(hashes: np.ndarray) -> bytes:
    """Signature: the parity of how many hashes fall on each of 2^k bits, at least one a hash and 64, at most WIDEST."""
    bits = min(WIDEST, 1 << max(6, int(len(hashes) - 1).bit_length()))
    return np.packbits(np.bincount((hashes >> np.uint64(20)).astype("i8") & (bits - 1), minlength=bits).astype("u1") & 1).tobytes()


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A signature of 64-bit words cut to a smaller power of two: halves are added modulo 2."""
    while len(bits) > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _node(hashes: np.ndarray) -> int | None:
    """Name of a set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of the tokens that occur often within SAMPLE hashes or so, and how often they do."""
    held: list[np.ndarray] = []

    def often() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        at = n >= OFTEN
        return pa.RecordBatch.from_arrays([pa.array((h[at] & np.uint64(COUNTERS - 1)).astype("i8")), pa.array(n[at])], names=["bucket", "n"])

    size = 0
    for b in batches:
        for t in b.column(0):
            held.append(shingles(t.as_py()))
            size += len(held[-1])
            if size >= SAMPLE:
                yield often()
                held, size = [], 0
    if held:
        yield often()


def _prefix(h: np.ndarray, late: np.ndarray | None) -> np.ndarray:
    """The tokens by one of which a set must meet any set it links with."""
    length = len(h) - -(-len(h) * NUM // DEN) + 1
    if late is None:
        return h[:length]
    is_late = late[(h & np.uint64(COUNTERS - 1)).astype("i8")]
    early = h[~is_late][:length]
    return np.concatenate((early, h[is_late][: length - len(early)]))


def _nodes(frequent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, text) to (doc_id, key, n, node, prefix, bits); a task gives a node's prefix and signature once only."""
    late = np.unpackbits(frequent.value).astype(bool) if frequent.value is not None else None
    seen: set[int] = set()
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            sizes, nodes, prefix, bits = [], [], [], []
            for text in part.column(2).to_pylist():
                s = shingles(text)
                node = _node(s)
                new = node is not None and node not in seen
                seen.add(node)
                sizes.append(len(s))
                nodes.append(node)
                prefix.append(_prefix(s, late).tobytes() if new else None)
                bits.append(bitmap(s) if new else None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(prefix, pa.binary()), pa.array(bits, pa.binary())], names=["doc_id", "key", "n", "node", "prefix", "bits"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, prefix) to (token, node, n)."""
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            tokens = [np.frombuffer(x.as_buffer(), "i8") for x in part.column(2)]
            times = [len(t) for t in tokens]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.repeat(part.column(0).to_numpy(), times)), pa.array(np.repeat(part.column(1).to_numpy(), times).astype("i4"))], names=["token", "node", "n"])


def _sift(mask, column: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose number hits a filter of fixed size."""
    bits = np.unpackbits(mask.value).astype(bool)
    for b in batches:
        yield b.filter(pa.array(bits[np.mod(b.column(column).to_numpy(), FILTER)]))


def _sets(mask, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to (node, hashes) of the texts that hit the filter, each once in a task."""
    seen: set[int] = set()
    for b in _sift(mask, 0, batches):
        for i in range(0, b.num_rows, 1000):
            sets = [shingles(t) for k, t in zip(b.column(0).slice(i, 1000).to_pylist(), b.column(1).slice(i, 1000).to_pylist(), strict=True) if not (k in seen or seen.add(k))]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "hashes"])


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return starts, np.append(starts[1:], len(key))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of token, n and node those that have another node of their tile within their band of sizes, each once."""
    last = [np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "i4")]  # token, node, n of the row before
    waits = False  # whether that row hasn't been given

    def pick(rows: list[np.ndarray]) -> pa.RecordBatch:
        nonlocal last, waits
        token, node, n = (np.concatenate((x, y)) for x, y in zip(last, rows, strict=True))
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])))  # tasks repeat nodes
        token, node, n = token[new], node[new], n[new]
        near = (token[1:] == token[:-1]) & (n[:-1].astype("i8") * DEN >= n[1:].astype("i8") * NUM)
        keep = np.concatenate((near, [False])) | np.concatenate(([False], near))
        given = bool(len(last[0])) and not waits  # the first of these rows
        last, waits = [x[-1:] for x in (token, node, n)], not (keep[-1] or len(token) == 1 and given)
        keep[0] &= not given
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, node, n)], names=["token", "node", "n"])

    for b in batches:
        if b.num_rows:
            yield pick([b.column(c).to_numpy() for c in ("token", "node", "n")])


def _allowed(x: np.ndarray, y: np.ndarray, both: np.ndarray | int) -> np.ndarray:
    """Whether signatures of one width (a row each) allow a link between sets with `both` elements together."""
    most = (both - np.bitwise_count(x ^ y).sum(axis=-1, dtype="i8")) // 2
    return most * (NUM + DEN) >= NUM * both


class _Union:
    """Disjoint sets of numbers 0 to n - 1; a set's root is its least number."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins pairs."""
        up = self.up
        while len(a):
            a, b = up[a], up[b]
            while True:
                x, y = up[a], up[b]
                if (x == a).all() and (y == b).all():
                    break
                a, b = x, y
            apart = a != b
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(up, b, a)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def roots(self) -> np.ndarray:
        while True:
            over = self.up[self.up]
            if (over == self.up).all():
                return over
            self.up = over


def _cut_to(words: list[np.ndarray], width: int) -> np.ndarray:
    """Signatures of this width or above cut to it, a row each; zeros for narrower ones."""
    return np.stack([_fold(x, width) if len(x) >= width else np.zeros(width, "u8") for x in words])


def _join_tiles(tile: np.ndarray, node: np.ndarray, n: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of tile and n to (node, least node that allowed pairs of these tiles lead to), of nodes that have one.

    Pairs a few places apart are compared for all tiles at once; in larger tiles, what is in different sets after that is.
    """
    names, at = np.unique(node, return_inverse=True)
    union = _Union(len(names))
    width = np.array([len(x) for x in bits]) // 8
    place, table = np.zeros(len(bits), "i8"), {}
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        place[own] = np.arange(len(own))
        table[w] = np.frombuffer(b"".join(bits[i] for i in own), "u8").reshape(-1, w)
    for lag in range(1, LAG + 1):
        i = np.flatnonzero((tile[lag:] == tile[:-lag]) & (n[:-lag] * DEN >= n[lag:] * NUM))
        if lag > 1:
            known = union.roots()
            i = i[known[at[i]] != known[at[i + lag]]]
        for w in np.unique(width[i]):
            for v in (w, 2 * w):
                chosen = i[(width[i] == w) & (width[i + lag] == v)]
                for x in np.array_split(chosen, 1 + len(chosen) * w // 500_000) if len(chosen) else ():
                    other = table[v][place[x + lag]]
                    ok = _allowed(table[w][place[x]], other if v == w else other[:, :w] ^ other[:, w:], n[x] + n[x + lag])
                    union.add(at[x[ok]], at[x[ok] + lag])
    for s, e in zip(*_runs(tile), strict=True):
        if e - s <= LAG + 1:
            continue
        root = np.array([union.find(i) for i in at[s:e]])
        if (root == root[0]).all():
            continue
        kinds, many = np.unique(root, return_counts=True)
        outside = root != kinds[many.argmax()]
        words = [np.frombuffer(x, "u8") for x in bits[s:e]]
        sizes, wide, cut = n[s:e], width[s:e], {}
        for i in np.flatnonzero(outside):
            low, high = np.searchsorted(sizes, [-(-sizes[i] * NUM // DEN), sizes[i] * DEN // NUM + 1])
            js = low + np.flatnonzero(root[low:high] != root[i])
            js = js[(js > i) | ~outside[js]]
            for w in np.unique(np.minimum(wide[js], wide[i])).tolist() if len(js) else ():
                mine = js[np.minimum(wide[js], wide[i]) == w]
                if w not in cut:
                    cut[w] = _cut_to(words, w)
                for r in np.unique(root[mine[_allowed(cut[w][mine], cut[w][i], sizes[i] + sizes[mine])]]).tolist():
                    x, y = union.find(root[i]), union.find(r)
                    union.up[max(x, y)] = min(x, y)
                    root[root == r] = root[i]
    root = union.roots()
    moved = root != np.arange(len(root))
    return names[moved], names[root[moved]]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of tile (token, block), n to (u, v): nodes, and the least one that allowed pairs of some tiles lead them to."""

    def joined(t: pa.Table) -> pa.RecordBatch:
        token, block, node, n = (t.column(c).to_numpy() for c in ("token", "block", "node", "n"))
        tile = np.cumsum(np.concatenate(([False], (token[1:] != token[:-1]) | (block[1:] != block[:-1]))))
        u, v = _join_tiles(tile, node, n.astype("i8"), t.column("bits").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    yield from map(joined, whole_runs(batches, ("token", "block"), BYTES))


def _common(x: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted array with others."""
    y = np.concatenate(sets)
    hit = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
    return np.add.reduceat(hit, np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])), dtype="i8")


def _links(sets: list[np.ndarray], known: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """The components of sets in order of size: the number of the first set of each. Exact, but for what `known` components are given.

    Sets that ask are compared with those that aren't in their component yet, so what is found early saves most of the work.
    """
    n = np.array([len(s) for s in sets])
    _, known = np.unique(known, return_inverse=True)
    union = _Union(len(sets))
    first = np.full(known.max() + 1, len(sets))
    np.minimum.at(first, known, np.arange(len(sets)))
    union.add(np.arange(len(sets)), first[known])
    bits = [np.frombuffer(bitmap(s), "u8") for s in sets]
    width, cut = np.array([len(b) for b in bits]), {}
    done = np.zeros(len(sets), bool)
    root = union.roots()
    waiting = np.flatnonzero(asks).tolist()[::-1]
    while waiting:
        i = waiting.pop()
        if done[i]:
            continue
        done[i] = True
        low, high = np.searchsorted(n, [-(-n[i] * NUM // DEN), n[i] * DEN // NUM + 1])
        js = low + np.flatnonzero((root[low:high] != root[i]) & ~done[low:high])
        linked = []
        for w in np.unique(np.minimum(width[js], width[i])).tolist() if len(js) else ():
            mine = js[np.minimum(width[js], width[i]) == w]
            if w not in cut:
                cut[w] = _cut_to(bits, w)
            mine = mine[_allowed(cut[w][mine], cut[w][i], n[i] + n[mine])]
            if len(mine):
                common = _common(sets[i], [sets[j] for j in mine])
                linked.append(mine[common * DEN >= NUM * (n[i] + n[mine] - common)])
        if linked and len(hit := np.concatenate(linked)):
            union.add(np.full(len(hit), i), hit)
            root = union.roots()
            waiting.extend(j for j in hit.tolist() if asks[j])  # those that it has reached come next
    return root


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, part, n, node, root, asks, hashes) in order of the first three to (u, v): nodes, and the first one that links of their part lead them to."""
    for t in whole_runs(batches, ("cluster", "part"), BYTES):
        cluster, part, node, root, asks = (t.column(c).to_numpy() for c in ("cluster", "part", "node", "root", "asks"))
        sets = [np.frombuffer(x.as_buffer(), "u8") for x in t.column("hashes")]
        key = np.cumsum(np.concatenate(([False], (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1]))))
        u, v = [], []
        for s, e in zip(*_runs(key), strict=True):
            first = _links(sets[s:e], root[s:e], asks[s:e])
            moved = np.flatnonzero(first != np.arange(e - s))
            u.append(node[s:e][moved])
            v.append(node[s:e][first[moved]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with n_shingles (size of its set) and component_id (smallest doc_id that links lead to, its own included).

    A text's words are runs of non-space ASCII-lower-cased; its set the distinct runs of 5 of them, or all of them if fewer.
    Null, empty and blank texts have the empty set and link with nothing. Sets are compared as 64-bit hashes of shingles.
    Repeated rows are linked to each other as equal texts are, and returned each. Null ids count as larger than any; a
    component of such rows only has a null id. Other columns are ignored; an empty table gives no rows.
    """
    return groups(docs, id_col=id_col, text_col=text_col).select("doc_id", "n_shingles", "component_id")


def hot_tiles(rows: DataFrame, hot_rows: int) -> DataFrame:
    """(token, parts) of the tiles of over hot_rows rows: how many parts of about so many they are cut into."""
    return rows.groupBy("token").count().where(F.col("count") > hot_rows).select("token", F.ceil(F.col("count") / hot_rows).cast("int").alias("parts"))


def cut_tiles(rows: DataFrame, hot: DataFrame, salts: int = 2) -> DataFrame:
    """Adds `block` to (token, ...): 0, and in a hot tile one of `salts` numbers for each row, by as many cuts of its nodes into parts."""
    cold = rows.join(hot, "token", "left_anti").withColumn("block", F.lit(0))
    mine = F.array(*[F.lit(i) * F.col("parts") + F.pmod(F.xxhash64("node", F.lit(i)), F.col("parts")).cast("int") for i in range(salts)])
    return cold.unionByName(rows.join(hot, "token").withColumn("block", F.explode(mine)).drop("parts"))


def open_tiles(rows: DataFrame, hot: DataFrame, roots: DataFrame, hot_rows: int) -> DataFrame:
    """Blocks in which each node outside a hot tile's largest component meets all others of the tile; roots: (node, root) as far as known.

    Where the tile is one component, as one of near copies is after its first cuts, there is none. A tile whose nodes don't link
    keeps as many rows as its nodes' pairs, divided by the size of a block.
    """
    rows = rows.join(hot, "token").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = rows.groupBy("token", "root").agg(F.count("*").alias("n"))
    outside = by_root.groupBy("token").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    outside = outside.select("token", F.col("most.root").alias("major"), F.ceil((F.col("n") - F.col("most.n")) / hot_rows).cast("int").alias("asking")).where("asking > 0")
    rows = rows.join(outside, "token")
    own, target = F.pmod(F.xxhash64("node", F.lit(2)), F.col("asking")).cast("int"), F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")
    asks = rows.where("root <> major").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("block", own * F.col("parts") + F.col("part"))
    told = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("asking") - 1))).withColumn("block", F.col("part") * F.col("parts") + target)
    return asks.unionByName(told).select("token", "block", "node", "n").distinct()


def clusters_to_links(scratch: Scratch, sets: DataFrame, part_bytes: int) -> DataFrame | None:
    """The (node, root) of linked nodes. sets: (cluster, node, n, hashes), each node once."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tasks(size: Column, nodes: Column) -> Column:
        return F.ceil(F.greatest(size / part_bytes, nodes / MANY)).cast("int")

    large = sets.groupBy("cluster").agg(tasks(F.sum(F.octet_length("hashes")), F.count("*")).alias("parts")).where("parts > 1")
    large = scratch.write(large, "large")
    split = not large.isEmpty()

    def settle(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select("cluster", "part", "n", "node", "root", "asks", "hashes")
        rows = rows.repartition(parts, "cluster", "part").sortWithinPartitions("cluster", "part", "n", "node")
        return scratch.write(rows.mapInArrow(lean(_settle), "u long, v long"), name)

    def cut(rows: DataFrame, salt: int) -> DataFrame:
        part = F.pmod(F.xxhash64("node", F.lit(salt)), F.coalesce("parts", F.lit(1))).cast("int")
        return rows.withColumns({"part": part, "root": F.col("node"), "asks": F.lit(True)})

    if not split:  # each cluster was settled whole: what it gave are the components
        found = settle(cut(sets.withColumn("parts", F.lit(1)), 0), "links-0")
        return None if found.isEmpty() else scratch.write(found.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "roots")
    found = settle(cut(sets.join(large, "cluster", "left"), 0), "links-0").unionByName(settle(cut(sets.join(large, "cluster"), 1), "links-1"))
    roots = connected_components(scratch, found, "early")
    rows = sets.join(large, "cluster").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = scratch.write(rows, "open")
    by_root = rows.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum(F.octet_length("hashes")).alias("bytes"))
    outside = by_root.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("major"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.max(F.struct("n", "root", "bytes")).alias("most"))
    outside = outside.select("cluster", "major", tasks(F.col("bytes") - F.col("most.bytes"), F.col("n") - F.col("most.n")).alias("asking")).where("asking > 0")
    rows = rows.join(outside, "cluster")
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("asking")).cast("int")
    target = F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")
    asks = rows.where("root <> major").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("part", own * F.col("parts") + F.col("part")).withColumn("asks", F.lit(True))
    told = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("asking") - 1))).withColumn("part", F.col("part") * F.col("parts") + target).withColumn("asks", F.lit(False))
    found = found.unionByName(settle(asks.unionByName(told), "links-2"))
    return None if found.isEmpty() else connected_components(scratch, found, "roots")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT, part_bytes: int = PART) -> DataFrame:
    """The rows of components() with key (xxhash64 of the text) and root: the number of the component, whether its rows have ids or not; null for an empty set, which is alone."""
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))

    counts = texts.select("text").mapInArrow(lean(_frequent), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= WIDESPREAD)
    often = counts.select("bucket").toPandas()["bucket"].to_numpy("int64")  # COUNTERS at most
    late = None
    if len(often):
        late = np.zeros(COUNTERS, bool)
        late[often] = True
        late = np.packbits(late)
    late = spark.sparkContext.broadcast(late)
    nodes = scratch.write(texts.mapInArrow(lean(partial(_nodes, late)), "doc_id long, key long, n long, node long, prefix binary, bits binary"), "nodes")
    members, own = nodes.select("doc_id", "key", "n", "node"), nodes.where("prefix is not null")
    index = own.select("node", "n", "prefix").mapInArrow(lean(_tokens), "token long, node long, n int")
    shared = scratch.write(index.repartition(parts, "token").sortWithinPartitions("token", "n", "node").mapInArrow(lean(_shared), "token long, node long, n int"), "shared")
    detail = own.groupBy("node").agg(F.min(F.struct("bits", "key")).alias("s"))
    detail = scratch.write(detail.join(shared.select("node").distinct(), "node", "left_semi").select("node", "s.*"), "detail")

    def meet(tiles: DataFrame, name: str) -> DataFrame:
        tiles = tiles.join(detail.select("node", "bits"), "node").select("token", "block", "node", "n", "bits")
        met = tiles.repartition(parts, "token", "block").sortWithinPartitions("token", "block", "n", "node").mapInArrow(lean(_met), "u long, v long")
        return scratch.write(met.distinct(), name)

    hot = scratch.write(hot_tiles(shared, hot_rows), "hot")
    if hot.isEmpty():
        met = meet(shared.withColumn("block", F.lit(0)), "met")
    else:
        met = meet(cut_tiles(shared, hot), "met")
        met = met.unionByName(meet(open_tiles(shared, hot, connected_components(scratch, met, "tiles"), hot_rows), "met-open"))
    roots = None
    if not met.isEmpty():
        clusters = connected_components(scratch, met, "clusters")
        scratch.drop("shared", "met", "met-open", "hot")
        clusters = scratch.write(clusters.join(detail.select("node", "key"), "node").select("node", "key", F.col("root").alias("cluster")), "cluster")
        mask = np.zeros(FILTER, bool)
        mask[clusters.select(F.pmod("key", F.lit(FILTER)).alias("x")).distinct().toPandas()["x"].to_numpy("int64")] = True  # FILTER at most
        mask = spark.sparkContext.broadcast(np.packbits(mask))
        sets = texts.select("key", "text").where("text is not null").mapInArrow(lean(partial(_sets, mask)), "node long, hashes binary").where("node is not null")
        sets = sets.join(clusters.select("node", "cluster"), "node").groupBy("cluster", "node").agg(F.min("hashes").alias("hashes"))
        sets = scratch.write(sets.withColumn("n", (F.octet_length("hashes") / 8).cast("int")), "sets")
        roots = clusters_to_links(scratch, sets, part_bytes)
        scratch.drop("detail", "cluster", "sets", "open", "links-0", "links-1", "links-2")

    least = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).withColumn("root", F.col("node"))
    if roots is not None:
        in_group = least.drop("root").join(roots, "node")
        group = in_group.groupBy("root").agg(F.min("least").alias("smallest"))
        moved = in_group.join(group, "root").select("node", "smallest", F.col("root").alias("r"))
        least = least.join(moved, "node", "left").select("node", F.when(F.col("r").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("least"), F.coalesce("r", "root").alias("root"))
    least = scratch.write(least, "least")
    out = members.where("node is not null").join(least, "node").select("doc_id", "key", F.col("n").alias("n_shingles"), "root", F.col("least").alias("component_id"))
    return out.unionByName(members.where("node is null").select("doc_id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id")))
