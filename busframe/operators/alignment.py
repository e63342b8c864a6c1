"""Absolute times: as-of joins to clock fixes, running sums and prefixes within packets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from busframe.functions.timebase import absolute


def valid_fixes(fixes: DataFrame) -> DataFrame:
    """Fixes whose format and source are known."""
    return fixes.where("time_fmt <> 15 and src <> 15")


#: Ranges that one task carries a fix over.
BLOCK = 4096
#: Fixes that are broadcast at most.
MOST_FIXES = 200_000


def _carried(known: DataFrame, by: list[str]) -> DataFrame:
    """(by, __range, __last) to (by, __range, __before): the greatest __last of all earlier ranges.

    Up to BLOCK ranges go by one window. More are cut into blocks of so many, and what comes before a block is carried over
    the blocks in the same way.
    """
    least, most = known.agg(F.min("__range"), F.max("__range")).first()
    earlier = lambda *keys: Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    if least is None or most - least < BLOCK:
        return known.select(*by, "__range", F.max("__last").over(earlier(*by)).alias("__before"))
    known = known.withColumn("__block", F.floor((F.col("__range") - least) / BLOCK))
    near = known.select(*by, "__range", "__block", F.max("__last").over(earlier(*by, "__block")).alias("__inside"))
    tops = known.groupBy(*by, F.col("__block").alias("__range")).agg(F.max("__last").alias("__last"))
    before = _carried(tops, by).select(*by, F.col("__range").alias("__block"), F.col("__before").alias("__outside"))
    return near.join(before, [*by, "__block"]).select(*by, "__range", F.greatest("__inside", "__outside").alias("__before"))


def _asof_few(packets: DataFrame, fixes: DataFrame, by: list[str], at: str, most: int) -> DataFrame | None:
    """Packets with __use, their fix; None if there are over `most` fixes.

    The fixes' keys, sorted by group, are searched by halving in a vectorised function that sees nothing of a packet but by and
    at; the fix itself comes by its number from a broadcast table.
    """
    fixes = fixes.groupBy(*by, at).agg(F.max("__fix").alias("__fix"))
    rows = fixes.limit(most + 1).collect()
    if len(rows) > most:
        return None
    spark = packets.sparkSession
    rows = sorted(rows, key=lambda r: (tuple((r[c] is None, r[c]) for c in by), r[at]))
    places: dict[tuple, tuple[int, list]] = {}
    for i, r in enumerate(rows):
        places.setdefault(tuple(r[c] for c in by), (i, []))[1].append(r[at])
    known = spark.sparkContext.broadcast({k: (i, np.array(v)) for k, (i, v) in places.items()})

    @F.pandas_udf("long")
    def latest(*columns: pd.Series) -> pd.Series:
        place, keys = columns[0], columns[1:]
        out = np.full(len(place), -1, "int64")
        groups = [((), np.arange(len(place)))] if not keys else pd.DataFrame(dict(enumerate(keys))).groupby(list(range(len(keys))), dropna=False).indices.items()
        for key, at_rows in groups:
            key = tuple(None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,)))
            if key in known.value:
                first, own = known.value[key]
                n = np.searchsorted(own, place.to_numpy()[at_rows], side="right")
                out[at_rows] = np.where((n > 0) & place.notna().to_numpy()[at_rows], first + n - 1, -1)
        return pd.Series(out)

    numbered = spark.createDataFrame([(i, r["__fix"]) for i, r in enumerate(rows)], T.StructType([T.StructField("__number", T.LongType()), T.StructField("__use", fixes.schema["__fix"].dataType)]))
    return packets.withColumn("__number", latest(F.col(at), *by)).join(F.broadcast(numbered), "__number").drop("__number")


def asof(packets: DataFrame, fixes: DataFrame, *, by: list[str], at: str, width: int, most: int = MOST_FIXES) -> DataFrame:
    """Each packet with the latest fix at or before it, by equi joins only; packets before the first fix of their group go.

    Up to `most` fixes are broadcast, so packets stay where they are and are read once. Beyond that both sides are dealt out,
    whole rows; packets of read_recording() need no join at all.

    by: columns both sides share (may be empty); at: the order column of both (rows without it go); width: of the ranges of `at` that
    packets and fixes are dealt into. In its range a packet takes the last fix before it by a window over packets and fixes together;
    where there is none, the last fix of an earlier range, known per range from the fixes alone. So no task sees more than
    one range. Ranges are carried forward block by block, BLOCK of them at a time.
    """
    value = [c for c in fixes.columns if c not in (*by, at)]
    fix = F.struct(F.col(at), *value)
    fixes = fixes.withColumns({"__range": F.floor(F.col(at) / width), "__fix": fix}).select(*by, "__range", "__fix")
    names = [c if c not in packets.columns else f"fix_{c}" for c in value]
    if (few := _asof_few(packets, fixes.withColumn(at, F.col(f"__fix.{at}")), by, at, most)) is not None:
        return few.select(*packets.columns, F.col(f"__use.{at}").alias(f"fix_{at}"), *[F.col(f"__use.{c}").alias(n) for c, n in zip(value, names, strict=True)])
    ranges = packets.select(*by, F.floor(F.col(at) / width).alias("__range")).distinct()
    last = fixes.groupBy(*by, "__range").agg(F.max("__fix").alias("__last"))
    known = ranges.withColumn("__last", F.lit(None).cast(last.schema["__last"].dataType)).unionByName(last).groupBy(*by, "__range").agg(F.max("__last").alias("__last"))
    known = _carried(known, by)
    p = packets.withColumns({"__range": F.floor(F.col(at) / width), "__row": F.struct(*packets.columns), "__at": F.col(at), "__kind": F.lit(1), "__fix": F.lit(None).cast(fixes.schema["__fix"].dataType)})
    f = fixes.withColumns({"__row": F.lit(None).cast(p.schema["__row"].dataType), "__at": F.col(f"__fix.{at}"), "__kind": F.lit(0)})
    columns = [*by, "__range", "__row", "__at", "__kind", "__fix"]
    rows = p.select(*columns).unionByName(f.select(*columns))
    so_far = Window.partitionBy(*by, "__range").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__near", F.last("__fix", ignorenulls=True).over(so_far)).where("__kind = 1")
    rows = rows.join(known, [*by, "__range"]).withColumn("__use", F.coalesce("__near", "__before")).where("__use is not null")
    return rows.select("__row.*", F.col(f"__use.{at}").alias(f"fix_{at}"), *[F.col(f"__use.{c}").alias(n) for c, n in zip(value, names, strict=True)])


def carry_forward(rows: DataFrame, value: str, *, by: list[str], order: list[str], width: int | None = None) -> DataFrame:
    """Column `value` filled with its last known value of the group.

    width: of ranges of the first column of `order`, a number, that a group is dealt into; without it a group is one task's.
    """
    so_far = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if width is None:
        return rows.withColumn(value, F.last(value, ignorenulls=True).over(so_far(*by)))
    least = rows.agg(F.min(F.floor(F.col(order[0]) / width))).first()[0] or 0
    rows = rows.withColumn("__range", F.coalesce(F.floor(F.col(order[0]) / width), F.lit(least - 1)))  # nulls come first
    last = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("__value")))
    known = _carried(rows.groupBy(*by, "__range").agg(F.max(last).alias("__last")), by)
    rows = rows.withColumn("__near", F.last(value, ignorenulls=True).over(so_far(*by, "__range"))).join(known, [*by, "__range"])
    return rows.select(*[F.coalesce("__near", "__before.__value").alias(c) if c == value else F.col(c) for c in rows.columns if c not in ("__range", "__near", "__before")])


def packet_times(packets: DataFrame, fixes: DataFrame, *, by: list[str], at: str, width: int) -> DataFrame:
    """Packets with abs_time: the fix's time plus the counter's difference. fixes: at, rtc, fix_time."""
    rows = asof(packets, fixes, by=by, at=at, width=width)
    return rows.withColumn("abs_time", absolute(F.col("rtc"), F.col("fix_rtc"), F.col("fix_time")))


def running_sum(value: Column, *, by: list[str], order: list[str]) -> Column:
    return F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def until_error(rows: DataFrame, bad: Column, *, by: list[str], order: list[str]) -> DataFrame:
    """Rows of a group before its first bad one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__bad", F.max(bad.cast("int")).over(w)).where("__bad = 0").drop("__bad")
