"""Homomorphic multiset hash of texts, in DataFrame functions only.

A text is a multiset of paragraphs (lines). Each paragraph is hashed to a wide vector, and a text's fingerprint is the sum of
its paragraphs' vectors, lane by lane modulo 2^48. So the order of paragraphs doesn't matter, equal multisets have equal
fingerprints, and a paragraph is added or removed by adding or subtracting its vector (add, subtract).

Lanes: EQUAL lanes with hashes of the whole paragraph; the count of the paragraph's parts; GROUPS * WIDE lanes that count the
parts that fall on each; and as many for likeness. A part is a piece of a few words that ends where its own characters say so (PARTS), whatever stands before it. A
part's hash picks its group, and gives a number of a Cauchy distribution for each lane of it. A weighted sum of such numbers
is Cauchy distributed again, its scale the sum of absolute weights. So the lanes of two texts, subtracted, are spread by how
many parts the two multisets don't share, also where a part occurs many times; hence a likeness from 0 to 1 that needs the
fingerprints alone. Where the texts differ in few counts, as short texts and those of few different parts do, the counts tell what isn't shared. The hashes are not keyed; the fingerprint isn't meant to withstand forgery.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframe.llm.common import need

EQUAL, GROUPS, WIDE = 4, 16, 8
_48 = (1 << 48) - 1
#: Counts that differ, up to which they tell what isn't shared: of so many, few hold parts of both texts.
FEW = 32
#: Cuts: line ends; white space after punctuation or a letter of about half the alphabet; in unbroken runs after vowels and
#: the like, and after each character of scripts without spaces; 48 characters after the last cut at the latest. What can be
#: told from one character comes first, so that most places are passed over at once.
_WHOLE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uD7A3\uF900-\uFAFF"
PARTS = r"\n|(?=[ \t])(?<=[.,;:!?|a-mA-M0-4])[ \t]+|(?<=[aeiouAEIOU0-3" + _WHOLE + r"])(?:(?<=\S{17})|(?<=[" + _WHOLE + r"]))|(?<=\G.{48})"
#: Lane values are whole multiples of 1 / UNIT. A lane's number is the tangent of its factor times the hash as an angle.
UNIT = 256.0
_FACTORS = [float((7919 * (j + 1) * (j + 3)) % 32749 | 1) for j in range(WIDE)]


def with_lanes(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds column `out`, the fingerprint of a text: array<long> of EQUAL + 1 + 2 * GROUPS * WIDE lanes modulo 2^48.

    The steps are columns of their own, so that a text is split and hashed once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumns({"__p": F.split(text, "\n"), "__c": F.transform(F.filter(F.split(text, PARTS), lambda x: x != ""), lambda x: F.xxhash64(x, F.lit(100)))})

    def equal(column: str) -> Column:
        return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: (a + x.bitwiseAND(F.lit(_48))).bitwiseAND(F.lit(_48)))

    def angles(own: Column) -> Column:
        return F.transform(own, lambda x: F.shiftrightunsigned(x, 8).bitwiseAND(F.lit((1 << 24) - 1)).cast("double") * (math.pi / 2**24) + math.pi / 2**25)

    def spread(own: Column) -> Column:
        # An odd multiple of pi / 2^25 isn't near a pole: whole numbers below 2^32, whose sum is exact in any order.
        return F.transform(F.lit(_FACTORS), lambda k: F.aggregate(own, F.lit(0.0), lambda a, x: a + F.rint(F.tan(x * k) * F.lit(UNIT))))

    def counts(own: Column) -> Column:
        places = F.transform(own, lambda x: F.shiftright(x, 4).bitwiseAND(F.lit(WIDE - 1)))
        return F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda j: F.size(F.filter(places, lambda x: x == j)).cast("long"))

    def hashed(seed: int) -> Column:
        return F.transform("__p", lambda x: F.xxhash64(x, F.lit(seed)))

    def fourth(own: Column | str, shift: int, g: int) -> Column:
        return F.filter(own, lambda x: x.bitwiseAND(F.lit(3 << shift)) == g << shift)

    def fourths(own: Column | str, shift: int) -> Column:
        return F.array(*[fourth(own, shift, g) for g in range(4)])

    df = df.withColumns({f"__q{i}": hashed(i) for i in range(EQUAL)} | {"__h": fourths("__c", 0)})
    df = df.withColumn("__g", F.flatten(F.transform("__h", lambda x: fourths(x, 2))))  # GROUPS: by four bits
    # A group's angles are a lambda's argument, so that they are made once, not for each factor.
    lanes = F.transform(F.flatten(F.transform(F.transform("__g", angles), spread)), lambda v: v.cast("long").bitwiseAND(F.lit(_48)))
    df = df.withColumn(out, F.concat(F.array(*[equal(f"__q{i}") for i in range(EQUAL)], F.size("__c").cast("long")), F.flatten(F.transform("__g", counts)), lanes))
    return df.drop("__p", "__c", "__h", "__g", *[f"__q{i}" for i in range(EQUAL)])


def add(a: Column, b: Column) -> Column:
    """The lanes of the two multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_48)))


def subtract(a: Column, b: Column) -> Column:
    """The lanes of multiset a without the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_48)))


def text_form(fingerprint: Column) -> Column:
    """Lanes as lowercase hex."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is made once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: estimated shared parts over all parts of two texts as multisets, from their lanes; 1 for equal fingerprints.

    The counts' distances are never more than what isn't shared; they are it, but for parts that meet in one count, where up to
    FEW counts differ. Beyond, a group's share of what isn't shared is the geometric mean of its lanes' distances, made unbiased,
    but not less than its counts' distances, nor more than the parts that it holds of both.
    """
    m, n, all_ = F.element_at(a, EQUAL + 1), F.element_at(b, EQUAL + 1), GROUPS * WIDE

    def gap(x: Column, y: Column) -> Column:
        return F.abs(F.shiftright(F.shiftleft(x - y, 16), 16))  # the difference modulo 2^48, signed

    def log_gap(x: Column, y: Column) -> Column:
        return F.log(F.greatest(gap(x, y).cast("double") / UNIT, F.lit(0.5 / UNIT)))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v).cast("double")

    def unshared(g: int, gaps: Column) -> Column:
        x, y = (F.slice(v, EQUAL + 2 + all_ + g * WIDE, WIDE) for v in (a, b))
        mean = F.aggregate(F.zip_with(x, y, log_gap), F.lit(0.0), lambda s, v: s + v) / WIDE
        held = F.zip_with(*[F.slice(v, EQUAL + 2 + g * WIDE, WIDE) for v in (a, b)], lambda s, v: s + v)
        bounded = F.least(F.greatest(F.exp(mean) * math.cos(math.pi / (2 * WIDE)) ** WIDE, total(F.slice(gaps, 1 + g * WIDE, WIDE))), total(held))
        return F.when(x == y, F.lit(0.0)).otherwise(bounded)

    def apart(gaps: Column) -> Column:
        differ = F.size(F.array_remove(gaps, F.lit(0).cast("long")))
        return F.when(differ <= FEW, total(gaps)).otherwise(reduce(Column.__add__, [unshared(g, gaps) for g in range(GROUPS)]))

    gaps = F.zip_with(F.slice(a, EQUAL + 2, all_), F.slice(b, EQUAL + 2, all_), gap)
    near = _let(_let(gaps, apart), lambda x: (m + n - x) / (m + n + x))
    return F.when(a == b, F.lit(1.0)).when(m + n == 0, F.lit(0.0)).otherwise(near)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint, and that of the text with its last third replaced from the next document.

    The next document is the next by descending id (null ids last, ties by text hash); after the last comes the first. The last
    floor(n_chars / 3) code points give way to as many first ones of the next text, or to all of it.

    Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint (strings), near_edited, near_next (0 to 1). Null
    texts are empty. Repeated rows are neighbours of each other. Of one document alone the next is itself. An empty table
    gives no rows; other columns are ignored.

    Documents are dealt once, by ranges of ids of about equal counts, and ordered within them; the first row of each range
    is read apart and joined to the range before, so no task sees more than its range. Rows that share an id, as null ids do,
    are dealt by the hashes of their texts where they are many.
    """
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))  # at most 4 a shuffle partition
    # Range 0 comes first: the largest ids. A null id lies in the last range.
    place = F.lit(len(cuts))
    if cuts:
        place = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("doc_id"))))
    else:
        place = F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # The first row of each range, by its largest id.
    tops = docs.select("doc_id").groupBy(place.alias("range")).agg(F.max("doc_id").alias("top"), F.min("doc_id").alias("low"), F.count("*").alias("n")).collect()  # a row per range
    even = sum(r["n"] for r in tops) // ranges + 1
    if hot := {r["range"]: -(-r["n"] // even) for r in tops if r["top"] == r["low"] and r["n"] > 4 * even}:
        # Ranges of one id, or of null ids, that hold many rows are cut by the texts' hashes, which order their rows.
        share = F.xxhash64("text") / F.lit(2.0**64) + 0.5
        parts = F.element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), place)
        place = place * F.lit(1 << 16) + F.coalesce(F.least(F.floor(share * parts).cast("int"), parts - 1), F.lit(0))
        tops = docs.groupBy(place.alias("range")).agg(F.max("doc_id").alias("top")).collect()
    tops.sort(key=lambda r: r["range"])
    is_top = F.col("doc_id").isin([r["top"] for r in tops if r["top"] is not None])
    if any(r["top"] is None for r in tops):
        is_top = is_top | F.col("doc_id").isNull()
    heads = docs.where(is_top).withColumn("range", place)
    heads = heads.withColumn("n", F.row_number().over(Window.partitionBy("range").orderBy(*order))).where("n = 1")
    follows = [(a["range"], b["range"]) for a, b in zip(tops, tops[1:] + tops[:1], strict=True)]
    follows = spark.createDataFrame(follows, "before int, range int")
    heads = with_lanes(heads.join(follows, "range").select(F.col("before").alias("range"), F.col("text").alias("head_text")), "head_text", "head_lanes")
    window = Window.partitionBy("range").orderBy(*order)
    rows = with_lanes(docs.withColumn("range", place), "text", "own")
    rows = rows.withColumns({"next": F.lead("text").over(window), "other": F.lead("own").over(window)})
    rows = rows.join(heads, "range", "left").withColumns({"next": F.coalesce("next", "head_text"), "other": F.coalesce("other", "head_lanes")})
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third))
    rows = with_lanes(rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "other", edited.alias("edited_text")), "edited_text", "edited")
    return rows.select("doc_id", "n_chars", "edited_text", text_form(F.col("own")).alias("fingerprint"), text_form(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("other")).alias("near_next"))
