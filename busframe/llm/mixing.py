"""Mixing sources to target weights by subset sums over document lengths.

Documents are counted by source and exact length in words. For each source a bounded knapsack over these counts says how
many documents of each length to take; which ones is decided by a seeded hash, so that reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, need

#: What a word is: a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Parts of a (source, length) group; one of them at most is ranked row by row.
PARTS = 1 << 16
#: Words of the budget that are left to the knapsack: the next if the last missed, the whole budget if that is less.
WINDOWS = (1 << 14, 1 << 18, 1 << 22)
#: Sums of each half of the documents that are left to the last attempt.
HALF = 1 << 20


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their words come to `budget`, or to as much below as can be.

    The same share of every size comes first and the bounded knapsack does the rest, over a window of words that grows if it
    misses the budget. If the last window misses too, sums of two halves of the documents are matched, whatever their size.
    The sum is the best there is if it hits the budget, if that is at most the last of WINDOWS in units of the greatest
    common divisor of the sizes, or if the documents make two halves of at most HALF sums each, as any 40 do. Of more, some
    are chosen whose sums are so many (HALF squared) that a miss is as good as ruled out.
    """
    if budget >= int((sizes * counts).sum()):
        return counts.copy()
    unit = int(np.gcd.reduce(sizes[counts > 0]))
    sizes, budget = sizes // unit, budget // unit
    best, least = counts * 0, budget + 1
    for window in WINDOWS:
        taken = _fit(sizes, counts, budget, window)
        if (missed := budget - int((taken * sizes).sum())) < least:
            best, least = taken, missed
        if not least or window >= budget:
            return best
    taken = _halves(sizes, counts, budget)
    return taken if budget - int((taken * sizes).sum()) < least else best


def _sums(items: list[tuple[int, int]]) -> np.ndarray:
    """Sums of all choices of (size, documents); a sum's place says how many of each, the first item's number changing fastest."""
    out = np.zeros(1, "int64")
    for size, n in items:
        out = (np.arange(n + 1)[:, None] * size + out[None, :]).ravel()
    return out


def _halves(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """fit() by sums of two halves of as many documents as make HALF sums each, different sizes first; others are taken by size until half of these is left."""
    open_, rooms, half = np.zeros(len(sizes), "int64"), [1, 1], np.zeros(len(sizes), int)
    alive = [i for i in np.argsort(-sizes, kind="stable") if sizes[i] > 0 and counts[i] > 0 and sizes[i] <= budget]
    turn = 0
    while alive:
        left = []
        for i in alive:
            side = int(half[i]) if open_[i] else turn % 2
            if rooms[side] // (int(open_[i]) + 1) * (int(open_[i]) + 2) <= HALF:
                rooms[side] = rooms[side] // (int(open_[i]) + 1) * (int(open_[i]) + 2)
                half[i], turn = side, turn + (not open_[i])
                open_[i] += 1
                if open_[i] < min(int(counts[i]), budget // int(sizes[i])):
                    left.append(i)
        alive = left
    taken, rest = np.zeros(len(sizes), "int64"), budget
    aim = budget - int((open_ * sizes).sum()) // 2
    for i in np.argsort(-sizes, kind="stable"):
        if sizes[i] > 0 and (n := min(int(counts[i] - open_[i]), (aim - (budget - rest)) // int(sizes[i]))) > 0:
            taken[i] += n
            rest -= n * int(sizes[i])
    sides = [[i for i in range(len(sizes)) if open_[i] and half[i] == side] for side in (0, 1)]
    a, b = (_sums([(int(sizes[i]), int(open_[i])) for i in own]) for own in sides)
    order = np.argsort(b, kind="stable")
    fits = np.flatnonzero(a <= rest)
    at = np.searchsorted(b[order], rest - a[fits], side="right") - 1  # the empty choice always fits
    best = int(np.argmax(a[fits] + b[order][at]))
    for own, place in zip(sides, (int(fits[best]), int(order[at[best]])), strict=True):
        for i in own:
            place, n = divmod(place, int(open_[i]) + 1)
            taken[i] += n
    return taken


def _fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int) -> np.ndarray:
    """fit() with a knapsack over about `window` words: the same share of every size, then large sizes, until so many are left."""
    total = int((sizes * counts).sum())
    part = max(0, budget - window)
    taken = np.array([int(c) * part // total for c in counts], "int64")
    rest = budget - int((taken * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:
        if rest <= window:
            break
        if sizes[i] > 0 and (n := min(int(counts[i] - taken[i]), (rest - window) // int(sizes[i]))) > 0:
            taken[i] += n
            rest -= n * int(sizes[i])
    # The sums that the documents left can make, as the bits of one number, and for each the step that made it first.
    mask, sums, steps = (1 << (rest + 1)) - 1, 1, []
    made = np.full(rest + 1, -1, "int32")
    for i in order[::-1]:
        size, left = int(sizes[i]), int(counts[i] - taken[i])
        if not 0 < size <= rest:
            continue
        left, part = min(left, rest // size), 1
        while left:
            n = min(part, left)
            if new := (sums << (n * size)) & mask & ~sums:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(-(-(rest + 1) // 8), "little"), "u1"), count=rest + 1, bitorder="little")
                made[bits.astype(bool)] = len(steps)
                steps.append((i, n))
                sums |= new
            left, part = left - n, part * 2
        if sums >> rest & 1:
            break
    at = sums.bit_length() - 1
    while at:  # what a sum was made from was there before its step
        i, n = steps[made[at]]
        taken[i] += n
        at -= n * int(sizes[i])
    return taken


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """One source: whole copies of everything (base), and how many documents of each size are taken once more."""
    sizes, counts = group["size"].to_numpy("int64"), group["n"].to_numpy("int64")
    total, target = int((sizes * counts).sum()), int(round(float(group["target"].iloc[0])))
    base = min(target // total, 1) if total else 0
    more = fit(sizes, counts, target - base * total) if total else counts * 0
    return pd.DataFrame({"skey": group["skey"], "size": sizes, "base": base, "more": more})


def targets(scratch: Scratch, sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds `target` to (source, skey, source_size): weights by code-point order of the source, null last, repeating.

    The sum of targets is share * all sizes; none exceeds most * its source's size, and what is above goes to the others
    by weight until none is above. Only sums over all sources reach the driver.
    """
    ordered = sources.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source").sortWithinPartitions("last", "source")
    ordered = scratch.write(ordered.withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).count().collect())  # a row per partition
    before, offsets = 0, []
    for p, n in sizes:
        offsets.append((p, before))
        before += n
    offsets = ordered.sparkSession.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    ranked = scratch.write(ordered.withColumn("part", part).join(offsets, "part").withColumn("weight", weight).withColumn("cap", most * F.col("source_size")).drop("part", "place", "before", "last"), "ranked")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # ends when no more sources reach their cap; each step adds one at least
        above = F.col("cap") <= level * F.col("weight")
        capped, open_, n = ranked.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight"))), F.sum(above.cast("long"))).first()
        if not open_ or n == full:
            break
        full, level = n, (budget - (capped or 0.0)) / open_
    return ranked.withColumn("target", F.least("cap", level * F.col("weight")))


def mix(docs: DataFrame, *, keep: list[str], text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """Says for every document how often the mix takes it.

    Returns the columns `keep` of `docs` plus size (words), source_size (words of its source), target (of its source,
    double) and copies (int, 0 to 2: whole copies of the document in the mix). Columns in `keep` that have one of these
    names are replaced. Each source's taken words are its target, or the nearest sum of document sizes at or below it (as
    near as fit() says).

    Null and empty texts have size 0 and no copies' worth of words; a null source is a source of its own, ordered last.
    Repeated rows count each. The choice among documents of one source and length goes by a seeded hash of the id, ties
    by the id; rows that share an id are interchangeable. An empty table gives no rows. A source's counts by length are
    fitted in one task: as many rows as it has different lengths, however many documents. A (source, length) group is
    never ranked whole: hash parts of it are taken whole or left, and only the one where the count runs out is ranked.
    """
    need(docs, text_col, source_col, id_col, *keep)
    scratch = Scratch(docs.sparkSession, "mix")
    kept = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    part = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(PARTS))
    rows = docs.select(*kept, F.col(id_col).alias("id"), F.when(F.col(source_col).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(source_col))).alias("skey"), words(F.col(text_col)).alias("size"), part.alias("part"))
    small = docs.select(F.col(source_col).alias("source"), F.when(F.col(source_col).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(source_col))).alias("skey"), words(F.col(text_col)).alias("size"), part.alias("part"))
    parts = scratch.write(small.groupBy("source", "skey", "size", "part").agg(F.count("*").alias("n")), "parts")
    by_source = targets(scratch, parts.groupBy("source", "skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most)
    by_source = scratch.write(by_source.select("skey", "source_size", "target"), "targets")
    by_size = parts.groupBy("skey", "size").agg(F.sum("n").alias("n")).join(by_source.select("skey", "target"), "skey")
    plan = scratch.write(by_size.groupBy("skey").applyInPandas(_plan, "skey string, size long, base int, more long"), "plan")
    # Parts before the edge are taken whole, those after it not at all; at the edge `few` documents are.
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("skey", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = parts.select("skey", "size", "part", "n", earlier.alias("earlier")).join(plan, ["skey", "size"]).where("earlier < more and more <= earlier + n")
    edges = edges.select("skey", "size", F.col("part").alias("edge"), (F.col("more") - F.col("earlier")).alias("few"))
    plan = plan.join(edges, ["skey", "size"], "left").join(by_source, "skey").select("skey", "size", "base", F.coalesce("edge", F.lit(-1)).alias("edge"), "few", "source_size", "target")
    rows = rows.join(scratch.write(plan, "edges"), ["skey", "size"])
    scratch.drop("parts", "sources", "ranked", "targets", "plan")
    new = ["size", "source_size", "target", "copies"]

    def result(rows: DataFrame, more: Column) -> DataFrame:
        rows = rows.withColumn("copies", F.col("base") + more.cast("int"))
        return rows.select(*[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep) if c not in new], *new)

    place = F.row_number().over(Window.partitionBy("skey", "size").orderBy(F.xxhash64(F.lit(seed), "id"), "id"))
    return result(rows.where("part <> edge"), F.col("part") < F.col("edge")).unionByName(result(rows.where("part = edge"), place <= F.col("few")))
