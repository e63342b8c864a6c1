"""Checks of interface documents and comparison of tables and files."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from busframe.functions.decode import BIT_LEVEL, WORD_COUNTS
from busframe.sources.packets import located
from busframe.sources.tables import listing, shared_folder

WORD_SCHEMAS = sorted(WORD_COUNTS)
BIT_SCHEMAS = ["ASCII", "SIGNEDBITS", "UNSIGNEDBITS"]
REQUIRED = ["msg_name", "elem_name", "xmit_word", "dest_word", "bus_name", "offset", "elem_word_count", "schema", "msb_val"]


def icd_rules() -> dict[str, Column]:
    """Rule name to what breaks it."""
    k, schema = F.col("elem_word_count"), F.col("schema")
    words = F.create_map(*[F.lit(x) for pair in sorted(WORD_COUNTS.items()) for x in pair])
    n = F.when(k == 1, F.col("bitlsb") - F.col("bitmsb") + 1).otherwise(17 - F.col("bitmsb") + F.col("bitlsb") + 16 * (k - 2))
    rules = {f"required {c}": F.col(c).isNull() for c in REQUIRED}
    rules |= {
        "not translated": schema == "MODE_CODE",
        "unknown encoding": ~schema.isin(*WORD_SCHEMAS, *BIT_SCHEMAS, "MODE_CODE"),
        "word count": ~F.col("is_bitlevel") & (F.element_at(words, schema) != k),
        "encoding of bit element": F.col("is_bitlevel") & ~schema.isin(*BIT_SCHEMAS),
        "bit positions": F.col("is_bitlevel") & ~(F.col("bitmsb").between(1, 16) & F.col("bitlsb").between(1, 16)),
        "bit count": F.col("is_bitlevel") & (n != F.col("bit_count")),
        "offset": (F.col("offset") < 0) | (F.col("offset") + k > 32),
    }
    return rules


def _violations(icd: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]))
    return icd.select(name, "elem_name", F.explode(broken).alias("rule"))


def validate_icd(icd: DataFrame) -> DataFrame:
    """(msg_name, elem_name, rule) of every broken rule."""
    return _violations(icd, "msg_name", icd_rules())


REQUIRED_429 = ["word_name", "elem_name", "label", "bus", "sdi", "schema", "bitmsb", "bitlsb", "bit_count", "msb_val"]


def icd_rules_429() -> dict[str, Column]:
    """Rule name to what breaks it, for 429 elements. Positions count from 1 over the 32 bits of a word as stored."""
    msb, lsb = F.col("bitmsb"), F.col("bitlsb")
    rules = {f"required {c}": F.col(c).isNull() for c in REQUIRED_429}
    return rules | {
        "unknown encoding": ~F.col("schema").isin(*BIT_LEVEL),
        "label": ~F.col("label").between(0, 377) | (F.col("label") % 10 > 7) | (F.floor(F.col("label") / 10) % 10 > 7),
        "sdi": ~F.col("sdi").between(-1, 3),
        "bit positions": ~(msb.between(1, 32) & lsb.between(1, 32) & (msb <= lsb)),
        "bit count": lsb - msb + 1 != F.col("bit_count"),
    }


def validate_icd_429(icd: DataFrame) -> DataFrame:
    """(word_name, elem_name, rule) of every broken rule."""
    return _violations(icd, "word_name", icd_rules_429())


def duplicates(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def _plain(df: DataFrame, column: str) -> Column:
    """A column that can be compared: a map as its sorted entries."""
    return (F.array_sort(F.map_entries(column)) if df.schema[column].dataType.typeName() == "map" else F.col(column)).alias(column)


def compare_tables(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """A row per column of either table: whether names and types agree, rows compared, rows that differ, and the verdict.

    Rows are matched by `key`, a null with a null; rows that share a key are matched in order of their hashes (repeated_keys()
    lists them), so a table never differs from itself. A row that one side lacks counts as differing in every column. NaN
    equals NaN and null equals null.
    """
    types_a, types_b = dict(a.dtypes), dict(b.dtypes)
    names = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c not in key]
    both = [c for c in names if types_a.get(c) == types_b.get(c)]

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = [_plain(df, c) for c in both]
        hashed = [F.xxhash64(*cells)] if both else list(key)
        turn = F.row_number().over(Window.partitionBy(*key).orderBy(*hashed))
        return df.select(*[F.col(k).alias(f"__{name}_{i}") for i, k in enumerate(key)], turn.alias(f"__{name}_turn"), F.struct(F.lit(True).alias("there"), *cells).alias(f"__{name}"))

    match = [F.col(f"__a_{i}").eqNullSafe(F.col(f"__b_{i}")) for i in range(len(key))] + [F.col("__a_turn") == F.col("__b_turn")]
    rows = side(a, "a").join(side(b, "b"), match, "full")
    there = F.col("__a.there").eqNullSafe(F.col("__b.there"))
    counts = rows.agg(F.count("*").alias("n"), *[F.sum((~(there & F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}")))).cast("long")).alias(f"d_{i}") for i, c in enumerate(both)])
    place = {c: i for i, c in enumerate(both)}
    cells = [F.struct(F.lit(c).alias("column"), F.lit(c in types_a and c in types_b).alias("in_both"), F.lit(c in place).alias("same_type"), F.col("n").alias("rows"), (F.coalesce(F.col(f"d_{place[c]}"), F.lit(0)) if c in place else F.col("n")).cast("long").alias("different")) for c in names]
    out = counts.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return out.withColumn("passed", F.col("in_both") & F.col("same_type") & (F.col("different") == 0))


def profile_icd_lookup(icd_429: DataFrame, channels: DataFrame, excluded: DataFrame, votes: DataFrame) -> DataFrame:
    """(kind, name, detail, n): 429 bus names that no recorded subchannel has, excluded channels with their reason, and votes of each channel by bus."""
    names = icd_429.select(F.upper("bus").alias("name")).where("name <> ''").distinct()
    missed = names.join(channels.select(F.upper("name").alias("name")).distinct(), "name", "left_anti")
    parts = [
        missed.select(F.lit("unmatched bus").alias("kind"), "name", F.lit("").alias("detail"), F.lit(0).cast("long").alias("n")),
        excluded.select(F.lit("excluded channel").alias("kind"), F.col("channelid").cast("string").alias("name"), F.col("reason").alias("detail"), F.lit(0).cast("long").alias("n")),
        votes.select(F.lit("votes").alias("kind"), F.col("channelid").cast("string").alias("name"), F.col("bus").alias("detail"), F.col("votes").cast("long").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def repeated_keys(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(side, key, n) of the keys that a table holds more than once."""
    return duplicates(a, key).withColumn("side", F.lit("a")).unionByName(duplicates(b, key).withColumn("side", F.lit("b")))


#: Rows of a block that compare_positions() takes as one, and bytes of a block of a file.
BLOCK_ROWS, BLOCK_BYTES = 65_536, 8 << 20
#: Children of a node in a file's tree of hashes.
_FAN = 1024


def _positions(spark: SparkSession, path: str) -> DataFrame:
    """Rows with __file (its name, less the part of it that Spark makes up for each job), __block and __row. A lone file is compared whatever its name."""
    one = len(listing(spark, path)) == 1
    file = F.lit("") if one else F.regexp_replace("_metadata.file_name", r"^(part-\d+)-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "$1")
    row = F.col("_metadata.row_index")
    return spark.read.parquet(path).select("*", file.alias("__file"), F.floor(row / BLOCK_ROWS).alias("__block"), row.alias("__row"))


def differing_blocks(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """(__file, __block, rows, differs) of both sides' blocks, by digests of their rows that are summed where the rows lie."""

    def digests(df: DataFrame, side: str) -> DataFrame:
        sums = [F.sum(F.xxhash64(F.lit(seed), "__row", *[_plain(df, c) for c in columns]).cast("decimal(20,0)")) for seed in (0, 1)]
        return df.groupBy("__file", "__block").agg(F.struct(F.count("*").alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(sums)]).alias(side))

    rows = digests(a, "a").join(digests(b, "b"), ["__file", "__block"], "full")
    return rows.select("__file", "__block", F.greatest("a.n", "b.n").alias("rows"), (~F.col("a").eqNullSafe(F.col("b"))).alias("differs"))


def compare_positions(spark: SparkSession, a: str, b: str) -> DataFrame:
    """compare_tables() of two Parquet files or directories row by row in file order: rows are matched by file name and place in the file.

    Both tables are read twice: blocks of BLOCK_ROWS rows are told apart by digests, of which a few numbers a block are
    shuffled, and only rows of blocks that differ are matched.
    """
    sides = _positions(spark, a), _positions(spark, b)
    types = [dict(x.dtypes) for x in sides]
    names = [c for c in dict.fromkeys([*sides[0].columns, *sides[1].columns]) if not c.startswith("__")]
    blocks = differing_blocks(*sides, [c for c in names if types[0].get(c) == types[1].get(c)])
    folder = shared_folder(spark, "blocks")
    blocks.write.parquet(folder)
    blocks = spark.read.parquet(folder)
    same = blocks.where("not differs").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("same"))
    found = compare_tables(*[x.join(blocks.where("differs").select("__file", "__block"), ["__file", "__block"], "left_semi").drop("__block") for x in sides], ["__file", "__row"])
    rows = found.crossJoin(F.broadcast(same))  # of one row
    whole = F.when(F.col("in_both") & F.col("same_type"), 0).otherwise(F.col("same"))
    return rows.select("column", "in_both", "same_type", (F.col("rows") + F.col("same")).alias("rows"), (F.col("different") + whole).cast("long").alias("different"), (F.col("passed") & (whole == 0)).alias("passed"))


def compare_unordered(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, with the side that has them."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, start, length) to sha256 of these bytes, read a part at a time."""
    for b in batches:
        out = []
        for x in b.itertuples():
            system, path = located(x.path)
            sha, left = hashlib.sha256(), x.length
            with system.open_input_file(path) as f:
                f.seek(x.start)
                while left and (part := f.read(min(left, 1 << 20))):
                    sha.update(part)
                    left -= len(part)
            out.append(sha.hexdigest())
        yield b.assign(sha=out)[["name", "block", "sha"]]


def file_blocks(spark: SparkSession, path: str, files: list[tuple[str, int]], block: int) -> DataFrame:
    """(name, block, sha) of the blocks of files below path; a task holds a megabyte at a time, however long the files."""
    lone = len(files) == 1 and path.rstrip("/").endswith("/" + files[0][0]) and listing(spark, path) == files
    names = spark.createDataFrame([(n, path if lone else f"{path.rstrip('/')}/{n}", size) for n, size in files], "name string, path string, size long")
    parts = names.where("size > 0").select("name", "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block))).alias("block"))
    parts = parts.select("name", "path", "block", (F.col("block") * block).alias("start"), F.least(F.lit(block), F.col("size") - F.col("block") * block).alias("length"))
    return parts.repartition("name", "block").mapInPandas(_hashed, "name string, block long, sha string")


def root_hashes(blocks: DataFrame, most: int) -> DataFrame:
    """(name, sha): blocks' hashes joined in order, _FAN at a time, and hashed again until a file has one. most: blocks of the longest file."""
    rows, n = blocks, most
    while True:
        n = -(-n // _FAN)
        rows = rows.groupBy("name", F.floor(F.col("block") / _FAN).alias("parent")).agg(F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("block", "sha"))), lambda x: x["sha"])), 256).alias("sha"))
        rows = rows.withColumnRenamed("parent", "block")
        if n <= 1:
            return rows.select("name", "sha")


def compare_files(spark: SparkSession, a: str, b: str, glob: str = "*", block: int = BLOCK_BYTES) -> DataFrame:
    """(name, size_a, size_b, sha_a, sha_b, equal, first_difference) of the files under two directories, by their path below each; empty files too.

    glob: of file names. Files of any size are cut into blocks that are hashed where they are read; sha is the root of a tree
    of these hashes; first_difference is where the first block starts that differs or that one side lacks.
    """
    sides = []
    for path, side in ((a, "a"), (b, "b")):
        files = [(n, size) for n, size in listing(spark, path) if fnmatch.fnmatch(n.rpartition("/")[2], glob)]
        folder = shared_folder(spark, "hashes")
        file_blocks(spark, path, files, block).write.parquet(folder)
        blocks = spark.read.schema("name string, block long, sha string").parquet(folder)
        roots = root_hashes(blocks, max([1, *[-(-size // block) for _, size in files]]))
        names = spark.createDataFrame(files, f"name string, size_{side} long").join(roots, "name", "left")
        sides.append((names.select("name", f"size_{side}", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias(f"sha_{side}")), blocks.withColumnRenamed("sha", f"block_{side}")))
    rows = sides[0][0].join(sides[1][0], "name", "full")
    parts = sides[0][1].join(sides[1][1], ["name", "block"], "full").where("not (block_a <=> block_b)").groupBy("name").agg((F.min("block") * block).alias("first_difference"))
    equal = F.coalesce((F.col("size_a") == F.col("size_b")) & (F.col("sha_a") == F.col("sha_b")), F.lit(False))
    rows = rows.join(parts, "name", "left").withColumn("equal", equal)
    return rows.select("name", "size_a", "size_b", "sha_a", "sha_b", "equal", F.when(F.col("size_a").isNotNull() & F.col("size_b").isNotNull(), F.col("first_difference")).alias("first_difference"))
