"""A trie of conversation prefixes by truncation peeling.

A conversation is its path: for each of its turns the name of the prefix that ends there (a 128-bit chained hash of roles
and texts) and the turn's length; texts themselves are never shuffled. Peeling goes from the greatest depth to the root: at
each depth the nodes that were left by the depth below lose their last turn and meet the conversations that end here,
grouped by the name of their prefix. So a node's row appears when its depth is reached, with all that its subtree adds up
to, and partial aggregation lets a prefix that a third of all conversations share travel as a row a task.

A depth is a grouped job over the nodes that deep. Below SHALLOW, the longest conversations of at most DEEP turns together
are peeled in one task by the same steps down to the depth where the others begin, so a few very long ones cost no rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, lean, need

DEEP, SHALLOW = 200_000, 8
ROOT = b""
_PATH = "array<struct<name: binary, size: int>>"
_ENDS = f"name binary, conv_id long, depth int, path {_PATH}, n long, ends_sha256 string"
_NODE = f"depth int, name binary, parent binary, path {_PATH}, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PATH_TYPE = pa.list_(pa.struct([("name", pa.binary()), ("size", pa.int32())]))
_NODE_TYPES = [pa.int32(), pa.binary(), pa.binary(), _PATH_TYPE, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
NOTHING = hashlib.sha256(b"").hexdigest()
#: Conversation ids of one block of a list that is hashed.
_IDS = 4096


def turn_lists(rows: DataFrame, by: Column, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(base, conv_id, turns: array of (name, size)) of each conversation; conversations of one `by` lie in one partition.

    A turn's name is 128 bits of the SHA-256 of its role and text; size its text's code points.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    turns = rows.select(by.alias("base"), F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), name.alias("name"), F.length(text).alias("size")).alias("t")).where("conv_id is not null")
    lists = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("base", "conv_id", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["size"].alias("size"))).alias("turns"))


def rebuilt(rows: DataFrame, *, most: int = 6, group: int = 100, **columns: str) -> DataFrame:
    """(conv_id, turns) with the first h turns of conversation c - c % group in place of each conversation's own first h; h is crc32(c) % most."""
    c = F.col(columns.get("conv_col", "conv_id")).cast("long")
    lists = turn_lists(rows, c - c % group, **columns)
    heads = lists.where("conv_id = base").select("base", F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    turns = F.concat(F.slice(F.coalesce("head", F.array().cast(lists.schema["turns"].dataType)), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return lists.join(heads, "base", "left").select("conv_id", turns.alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turns) to (name, conv_id, depth, path): each turn's name becomes that of the prefix that it ends."""
    for b in batches:
        names, paths = [], []
        for turns in b.column(1).to_pylist():
            at, path = ROOT, []
            for t in turns:
                at = hashlib.blake2b(at + t["name"], digest_size=16).digest()
                path.append((at, t["size"]))
            names.append(at)
            paths.append([{"name": n, "size": s} for n, s in path])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), b.column(0), pa.array([len(p) for p in paths], pa.int32()), pa.array(paths, _PATH_TYPE)], names=["name", "conv_id", "depth", "path"])


def _merged(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)


_BLOCK = f"name binary, conv_id long, depth int, path {_PATH}, n long, ids string, ends_sha256 string"
_BLOCK_TYPES = [pa.binary(), pa.int64(), pa.int32(), _PATH_TYPE, pa.int64(), pa.string(), pa.string()]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (name, conv_id) to a row a name with its hash of ids; a name at either end of the task, which others may hold too, to blocks of ids."""
    fields = [f.split()[0] for f in _BLOCK.replace(_PATH, "path").split(", ")]
    blocks: list[list] = []  # of the present name
    out: list[tuple] = []
    first = True

    def closed() -> None:
        nonlocal first
        if first:
            out.extend((*x[:5], ",".join(x[5]), None) for x in blocks)
        else:
            out.append((*blocks[0][:4], sum(x[4] for x in blocks), None, hashlib.sha256(",".join(",".join(x[5]) for x in blocks).encode()).hexdigest()))
        first = False
        blocks.clear()

    for b in batches:
        for name, conv, depth, path in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if blocks and blocks[0][0] != name:
                closed()
            if not blocks or len(blocks[-1][5]) == _IDS:
                if len(blocks) == 64:  # a long list: what there is goes on as blocks, and so does the rest
                    first = True
                    out.extend((*x[:5], ",".join(x[5]), None) for x in blocks)
                    blocks.clear()
                blocks.append([name, conv, depth, path, 0, []])
            blocks[-1][4] += 1
            blocks[-1][5].append(str(conv))
        if out:
            yield _merged(out, fields, _BLOCK_TYPES)
            out.clear()
    if blocks:
        first = True
        closed()
        yield _merged(out, fields, _BLOCK_TYPES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (name, conv_id) to a row a name: the hash takes block after block."""
    fields = [f.split()[0] for f in _ENDS.replace(_PATH, "path").split(", ")]
    types = [*_BLOCK_TYPES[:5], pa.string()]
    held, sha = None, None
    for b in batches:
        out = []
        for name, conv, depth, path, n, ids in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if held and held[0] == name:
                held[4] += n
                sha.update(b"," + ids.encode())
                continue
            if held:
                out.append((*held, sha.hexdigest()))
            held, sha = [name, conv, depth, path, n], hashlib.sha256(ids.encode())
        if out:
            yield _merged(out, fields, types)
    if held:
        yield _merged([(*held, sha.hexdigest())], fields, types)


def ends(scratch: Scratch, conversations: DataFrame) -> DataFrame:
    """(name, conv_id, depth, path, n, ends_sha256): equal conversations as one row, with their least id and the hash of their ids.

    Ids are put to text and blocks where ranges of (name, id) lie, so copies without number are shared out; only the hash, which
    is sequential by its nature, takes the blocks of a name one by one, without holding them.
    """
    rows = conversations.mapInArrow(lean(_chained), f"name binary, conv_id long, depth int, path {_PATH}")
    rows = scratch.write(rows, "paths")
    rows = rows.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(lean(_listed), _BLOCK)
    blocks = scratch.write(rows, "blocks")
    scratch.drop("paths")
    split = blocks.where("ids is not null").repartition("name").sortWithinPartitions("name", "conv_id").drop("ends_sha256").mapInArrow(lean(_joined), _ENDS)
    whole = blocks.where("ids is null").select(*[f.split()[0] for f in _ENDS.replace(_PATH, "path").split(", ")])
    found = scratch.write(whole.unionByName(split).sortWithinPartitions("depth"), "ends")
    scratch.drop("blocks")
    return found


def _level(rows: DataFrame, depth: int) -> DataFrame:
    """Nodes of a depth from what meets there: nodes left by the depth below (child = 1), their paths cut to this depth, and conversations that end here (child = 0)."""
    last = F.element_at("path", -1)
    name = last["name"] if depth else F.lit(ROOT)
    size = last["size"] if depth else F.lit(0)
    # The parent and the path are functions of the name, so any row's will do.
    g = rows.withColumn("name", name).groupBy("name").agg(F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
    parent = F.element_at("path", -2)["name"] if depth > 1 else F.lit(ROOT if depth else None).cast("binary")
    return g.select(
        F.lit(depth).alias("depth"), "name", parent.alias("parent"), "path", "conv_id", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * size).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def _peeled(top: int) -> Callable:
    """mapInArrow over conversations that end deeper than `top`, all in one task: the nodes deeper than top. Those at top + 1 keep their paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending: dict[int, list] = {}
        for b in batches:
            for conv, depth, path, n, sha in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                ending.setdefault(depth, []).append((conv, path, n, sha))
        left: dict[bytes, list] = {}  # name: path, least id, members, children, leaves, saved, hash of ends
        for depth in range(max(ending, default=top), top, -1):
            nodes: dict[bytes, list] = {}
            for x in left.values():
                parent = nodes.setdefault(x[0][depth - 1]["name"], [x[0], x[1], 0, 0, 0, 0, NOTHING])
                parent[1] = min(parent[1], x[1])
                for i, v in ((2, x[2]), (3, 1), (4, x[4]), (5, x[5])):
                    parent[i] += v
            for conv, path, n, sha in ending.pop(depth, ()):
                own = nodes.setdefault(path[depth - 1]["name"], [path, conv, 0, 0, 0, 0, NOTHING])
                own[1], own[2], own[6] = min(own[1], conv), own[2] + n, sha
            for x in nodes.values():
                x[4] = x[4] or 1
                x[5] += (x[2] - 1) * x[0][depth - 1]["size"]
            out = [(depth, name, x[0][depth - 2]["name"] if depth > 1 else ROOT, x[0][:depth] if depth == top + 1 else None, *x[1:]) for name, x in nodes.items()]
            if out:
                yield _merged(out, [f.split()[0] for f in _NODE.replace(_PATH, "path").split(", ")], _NODE_TYPES)
            left = nodes

    return run


def peel(scratch: Scratch, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of (conv_id, turns): depth, name, parent, conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = scratch.spark
    ended = ends(scratch, conversations)
    lengths = sorted(((r["depth"], r["count"]) for r in ended.groupBy("depth").count().collect()), reverse=True)  # a number for each different length
    if not lengths:
        return spark.createDataFrame([], _NODE).drop("path")
    # Longer conversations hold at most DEEP turns.
    top, held = min(SHALLOW, lengths[0][0]), 0
    for depth, count in lengths:
        held += depth * count
        if held > DEEP or depth <= SHALLOW:
            top = max(top, min(depth, lengths[0][0]))
            break
    written = []
    ending = lambda depth: ended.where(F.col("depth") == depth).select("path", "conv_id", F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("child"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends_sha256")
    below = None
    if lengths[0][0] > top:
        deep = ended.where(F.col("depth") > top).select("conv_id", "depth", "path", "n", "ends_sha256").repartition(1).mapInArrow(lean(_peeled(top)), _NODE)
        written.append(scratch.write(deep, "deep"))
        below = written[0].where(F.col("depth") == top + 1)
    for depth in range(top, -1, -1):
        rows = ending(depth)
        if below is not None:
            rows = rows.unionByName(below.select(F.slice("path", 1, depth).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("child"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256")))
        below = scratch.write(_level(rows, depth), f"depth-{depth}")
        written.append(below)
    nodes = written[0].drop("path")
    for w in written[1:]:
        nodes = nodes.unionByName(w.drop("path"))
    return nodes


def prefix_trie(rows: DataFrame, *, most: int = 6, group: int = 100, **columns: str) -> DataFrame:
    """The trie of rebuilt conversations (see rebuilt()): a row a node.

    conv_id (the least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (what
    storing a subtree's shared turns once saves, in code points), ends_sha256 (of the ids of the members that end here,
    ascending, with commas; of nothing where none does).

    Rows of a conversation are ordered by turn (nulls first), then role, then a hash of the text; repeated rows are turns of
    their own. Null roles and texts count as empty; rows with a null conv_id take no part; a conversation without turns ends
    at the root; an empty table has no node. Other columns are ignored. columns: conv_col, turn_col, role_col, text_col.
    A conversation's names of turns (24 bytes each, no texts) are one row: Spark's 2 GB for a value allow some 80 million turns.
    """
    need(rows, *[columns.get(f"{c}_col", d) for c, d in (("conv", "conv_id"), ("turn", "turn"), ("role", "role"), ("text", "text"))])
    scratch = Scratch(rows.sparkSession, "trie")
    nodes = peel(scratch, rebuilt(rows, most=most, group=group, **columns))
    parents = nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent", "left").select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
