"""Exact top-k search by inner product in three phases with a uniform threshold.

The components of the vectors are split into NODES slices; a pair's score is the sum of its slices' partial scores.
Phase 1: the first block of candidates of every task lists, for each query and slice, its best candidates by partial score;
the exact scores of these give each query a cutoff, its k-th best so far, which its true k-th best can't be below. Phase 2:
the cutoffs are broadcast; a candidate that reaches the cutoff must reach cutoff / NODES in one slice at least, and only
those that do are collected, of all rows. Phase 3: their scores are summed exactly and the best k stay.

Queries go round by round, so many at a time (NUMBERS components) that they and their cutoffs are of a fixed size; candidates
are read in blocks where they lie, once a round but for the first blocks. Each block returns at most k candidates for a query
(more only on ties at its k-th score).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframe.llm.common import lean, need, Scratch

NODES, BLOCK = 4, 4096
#: Components of the queries of a round, and queries of a round at most.
NUMBERS, QUERIES = 1 << 20, 16_384
_SCHEMA = "number int, vec_id long, own boolean, score long"


def whole_vectors(vectors: DataFrame, scale: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v: array<long> floor(scale * x)) of the vectors that are whole: not null, all components finite."""
    need(vectors, id_col, vector_col)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null").where(~bad)
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each number of components in a batch, at most BLOCK rows at once."""
    lists, ids = batch.column(1), batch.column(0).to_numpy(zero_copy_only=False)
    offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values, "int64")
    width = np.diff(offsets)
    for d in np.unique(width):
        at = np.flatnonzero(width == d)
        for i in range(0, len(at), BLOCK):
            rows = at[i : i + BLOCK]
            yield ids[rows], flat[offsets[rows][:, None] + np.arange(d)]


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can pass 2^53, else in integers."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * v.shape[1]
    return (q.astype("f8") @ v.T.astype("f8")).astype("i8") if most < 1 << 53 else q @ v.T


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's k largest, and what ties with the last of them."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    return scores >= np.partition(scores, -k, axis=1)[:, -k][:, None]


_NONE = np.iinfo("int64").min


def _scan(queries, k: int, cutoffs):
    """mapInArrow over candidates. Without cutoffs phase 1, of a task's first block; with them phases 2 and 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = queries.value
        limits = cutoffs.value if cutoffs else None
        for batch in batches:
            for ids, v in _matrix(batch):
                d = v.shape[1]
                if d not in asked:
                    continue
                for start in range(0, len(asked[d][0]), 512):
                    numbers, qids, q = (x[start : start + 512] for x in asked[d])
                    own = np.zeros((len(q), len(v)), bool)
                    same = np.nonzero(qids[:, None] == ids[None, :])
                    own[same] = (q[same[0]] == v[same[1]]).all(1)
                    partial = [_product(q[:, s], v[:, s]) for s in (slice(d * j // NODES, d * (j + 1) // NODES) for j in range(NODES))]
                    if limits is None:
                        wanted = np.zeros(own.shape, bool)
                        for p in partial:
                            wanted |= _best(p, k)
                    else:
                        limit = limits[d][start : start + 512][:, None]
                        wanted = np.repeat(limit == _NONE, len(ids), axis=1)
                        for p in partial:
                            wanted |= p * NODES >= limit
                    scores = np.where(wanted, sum(partial), _NONE)
                    if limits is not None:
                        scores[scores < limit] = _NONE
                    a, b = np.nonzero(_best(scores, k) & (scores > _NONE))
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(numbers[a]), pa.array(ids[b]), pa.array(own[a, b]), pa.array(scores[a, b])], names=["number", "vec_id", "own", "score"])
                if limits is None:
                    return

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id", "own")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, *, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows of every query row by integer inner product: query_id, rank (from 1), vec_id, score.

    is_query: a condition on vec_id, which marks the query rows; every row but the query's own row is a candidate, other rows
    with its id too. Ties go to the smaller vec_id; fewer than k candidates are all returned. Vectors that are null or hold
    null or non-finite components take no part, nor do null ids; vectors of another number of components aren't compared,
    and empty ones score 0 with each other. Repeated rows are asked, and are candidates, as often as they are there. Other
    columns are ignored; empty tables give no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = whole_vectors(vectors, scale, id_col=id_col, vector_col=vector_col)
    asked = scratch.write(rows.where(is_query).groupBy("vec_id", "v").agg(F.count("*").alias("copies")), "asked")
    total, most = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    rounds = max(1, -(-total // QUERIES), -(-total * (most or 0) // NUMBERS))
    paths = []
    for r in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(rounds)) == r).collect()  # about as many as a round takes
        part.sort(key=lambda x: (x["vec_id"], x["v"]))
        by_width: dict[int, tuple] = {}
        for d in {len(x["v"]) for x in part}:
            same = [i for i, x in enumerate(part) if len(x["v"]) == d]
            by_width[d] = (np.array(same, "i4"), np.array([part[i]["vec_id"] for i in same], "int64"), np.array([part[i]["v"] for i in same], "int64").reshape(len(same), d))
        queries = spark.sparkContext.broadcast(by_width)
        # One more than k: the query's own row may be among them.
        first = _top(rows.mapInArrow(lean(_scan(queries, k + 1, None)), _SCHEMA).distinct(), k + 1)
        reached = first.where(F.col("rank") == k + 1).select("number", "score").toPandas()  # a number a query
        limit = dict(zip(reached["number"].tolist(), reached["score"].tolist(), strict=True))
        cutoffs = spark.sparkContext.broadcast({d: np.array([limit.get(i, _NONE) for i in numbers.tolist()], "int64") for d, (numbers, _, _) in by_width.items()})
        best = _top(rows.mapInArrow(lean(_scan(queries, k + 1, cutoffs)), _SCHEMA), k + 1)
        near = best.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "own"))).alias("near"))
        known = spark.createDataFrame([(i, x["vec_id"], x["copies"]) for i, x in enumerate(part)], "number int, query_id long, copies long")
        mine = F.array_position(F.transform("near", lambda x: x["own"]), F.lit(True)).cast("int")
        found = near.join(F.broadcast(known), "number").withColumn("mine", mine)  # of a round's queries
        found = found.select("query_id", "copies", F.slice(F.filter("near", lambda x, i: i + 1 != F.col("mine")), 1, k).alias("near"))
        found = found.select("query_id", F.posexplode("near").alias("place", "x"), "copies").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        found = found.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
        if rounds == 1:
            return found
        scratch.write(found, f"round-{r}")
        paths.append(f"{scratch.root}/round-{r}")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(*paths)
