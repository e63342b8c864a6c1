"""Quality by the perplexity of an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

One model per language. Counts of the highest order and continuation counts of the lower ones are tables keyed by language
and n-gram. Documents are gathered into chunks of one language; each chunk lists its distinct n-grams, these are joined to
the counts order by order, shard by shard, and come back to their chunk as log probabilities, where whole documents are
scored. So what is joined is distinct n-grams, not occurrences. Thresholds are quantiles of each language's trusted
documents that were kept from training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import lean, need, Scratch

ORDER = 4
#: Code points of a chunk, about; a longer text is a chunk of its own. And of what is taken up in numpy at once.
CHUNK, BLOCK = 6_000_000, 300_000
FILTER = 1 << 22
#: One trusted document in FOLDS sets thresholds, the others train.
FOLDS = 5
#: A document's mean is drawn to its language's as if by so many more characters, so that a few words alone condemn none.
PRIOR_CHARS = 64
_START = 0xFFFF


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """An n-gram of ORDER characters for every UTF-16 unit of the texts (16 bits a unit, the last lowest), and how many each text has.

    A character beyond U+FFFF is two units; U+FFFF, which marks a text's start, counts as U+FFFE.
    """
    lengths = np.array([len(t) for t in texts], "i8")
    codes = np.frombuffer("".join(texts).encode("utf-16-le", "surrogatepass"), "<u2")
    if len(codes) > lengths.sum():
        lengths = np.array([len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in texts], "i8")
    pad = ORDER - 1
    full = np.full(len(codes) + pad * len(texts), _START, "u8")
    at = np.arange(len(codes)) + pad * (np.repeat(np.arange(len(texts)), lengths) + 1)
    full[at] = np.minimum(codes, _START - 1)
    g = np.zeros(len(codes), "u8")
    for j in range(pad, -1, -1):
        g = (g << np.uint64(16)) | full[at - j]
    return g.view("i8"), lengths


def _pack(texts: list[str]) -> bytes:
    said = [t.encode("utf-8", "surrogatepass") for t in texts]
    return zstandard.ZstdCompressor(level=9).compress(np.array([len(said), *map(len, said)], "<i8").tobytes() + b"".join(said))


def _unpack(blob: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:8], "little")
    ends = np.cumsum(np.frombuffer(data, "<i8", n, 8)) + 8 * (n + 1)
    return [data[x:y].decode("utf-8", "surrogatepass") for x, y in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, lang, text) to chunks of one language; a chunk's number is made of the task's and a count."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    open_: dict[str | None, tuple[list, list[str], int]] = {}
    held = 0

    def close(lang: str | None) -> pa.RecordBatch:
        nonlocal number
        ids, texts, _ = open_.pop(lang)
        number += 1
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang], pa.string()), pa.array([ids], pa.list_(pa.int64())), pa.array([_pack(texts)], pa.binary())], names=["chunk", "lang", "ids", "texts"])

    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            for doc_id, lang, text in zip(*(part.column(j).to_pylist() for j in range(3)), strict=True):
                text = text or ""
                ids, texts, size = open_.get(lang, ([], [], 0))
                ids.append(doc_id)
                texts.append(text)
                open_[lang] = (ids, texts, size + len(text))
                held += len(text)
                if size + len(text) >= CHUNK or held >= 2 * CHUNK:  # many languages: the largest goes first
                    largest = lang if size + len(text) >= CHUNK else max(open_, key=lambda x: open_[x][2])
                    held -= open_[largest][2]
                    yield close(largest)
    for lang in list(open_):
        yield close(lang)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text or packed text) to counts of n-grams, one per block of texts."""
    for b in batches:
        langs, texts = b.column(0).to_pylist(), [t if isinstance(t, str) else _unpack(t)[0] for t in b.column(1).to_pylist()]
        for lang in sorted(set(langs)):
            own = [t for x, t in zip(langs, texts, strict=True) if x == lang and t]
            while own:
                size, n = 0, 0
                while n < len(own) and size < BLOCK:
                    size, n = size + len(own[n]), n + 1
                g, c = np.unique(grams(own[:n])[0], return_counts=True)
                own = own[n:]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g), pa.array(c.astype("i8"))], names=["lang", "gram", "c"])


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK code points together."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            texts = _unpack(row["texts"])
            g = np.empty(0, "i8")
            for x, y in _blocks(texts):
                g = np.union1d(g, grams(texts[x:y])[0])
            if len(g):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), row["chunk"])), pa.array([row["lang"]] * len(g), pa.string()), pa.array(g)], names=["chunk", "lang", "gram"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the log probabilities of their n-grams to (doc_id, lang, n, log_p: sum over the text)."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            ids, known, texts = row.column(2)[0].as_py(), row.column(4)[0], _unpack(row.column(3)[0].as_py())
            lengths, log = np.array([len(t) for t in texts], "i8"), np.full(len(texts), np.nan)
            if known.is_valid:
                gram, p = known.values.field(0).to_numpy(), known.values.field(1).to_numpy()
                order = np.argsort(gram)
                gram, p = gram[order], p[order]
                for x, y in _blocks(texts):
                    g, n = grams(texts[x:y])
                    ends, sums = np.cumsum(n), np.concatenate(([0.0], np.cumsum(p[np.searchsorted(gram, g)])))
                    log[x:y] = sums[ends] - sums[ends - n]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([row.column(1)[0].as_py()] * len(ids), pa.string()), pa.array(lengths), pa.array(log, from_pandas=True)], names=["doc_id", "lang", "n", "log_p"])


def _low(column: str, order: int) -> Column:
    """The last `order` characters of an n-gram."""
    return F.col(column) if order == 4 else F.col(column).bitwiseAND(F.lit((1 << 16 * order) - 1))


def model(scratch: Scratch, text: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (lang, gram, share: discounted probability) and (lang, context, back: weight of the lower order).

    text: lang, text. Counts are exact over all of it. Discounts follow from how many n-grams of a language and order occur
    once to four times; where that leaves none or an impossible one, 3/4 stands in.
    """
    counts = scratch.write(text.mapInArrow(lean(_count), "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c")), "counts-4")
    levels = []
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            counts = scratch.write(counts.groupBy("lang", _low("gram", order).alias("gram")).agg(F.count("*").alias("c")), f"counts-{order}")
        n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        cuts = counts.groupBy("lang").agg(*n)
        for i in range(1, 4):
            d = i - (i + 1) * y * F.col(f"n{i + 1}") / F.when(F.col(f"n{i}") > 0, F.col(f"n{i}"))
            cuts = cuts.withColumn(f"d{i}", F.when((d > 0) & (d < i), d).otherwise(F.lit(0.75)))
        rows = counts.join(cuts.select("lang", "d1", "d2", "d3"), "lang").withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        rows = rows.withColumn("context", F.shiftrightunsigned("gram", 16))
        back = scratch.write(rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("back")), f"back-{order}")
        share = rows.join(back, ["lang", "context"]).select("lang", "gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("share"))
        levels.append((scratch.write(share, f"share-{order}"), back.select("lang", "context", "back")))
        if order < ORDER:
            scratch.drop(f"counts-{order + 1}")
    scratch.drop("counts-1")
    return levels[::-1]


def probabilities(scratch: Scratch, levels: list[tuple[DataFrame, DataFrame]], wanted: DataFrame) -> DataFrame:
    """(lang, gram, log_p) for distinct (lang, gram) of the highest order, in languages that have a model."""
    base = levels[0][0].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p"))
    below = None
    for order, (share, back) in enumerate(levels, 1):
        rows = wanted.select("lang", _low("gram", order).alias("gram")).distinct().withColumn("context", F.shiftrightunsigned("gram", 16))
        rows = rows.join(base, "lang") if below is None else rows.withColumn("low", _low("gram", order - 1)).join(below.select("lang", F.col("gram").alias("low"), "p"), ["lang", "low"])
        rows = rows.join(share, ["lang", "gram"], "left").join(back, ["lang", "context"], "left")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")
        below = scratch.write(rows.select("lang", "gram", p.alias("p")), f"p-{order}")
        scratch.drop(f"share-{order}", f"back-{order}", f"p-{order - 1}")
    return below.select("lang", "gram", F.log("p").alias("log_p"))


def own_bucket(chunks: DataFrame, parts: int) -> DataFrame:
    """Chunks numbered anew, so that all of a task fall into one of `parts` buckets by their numbers: a task writes one file, not one a bucket."""
    task, count = F.shiftright("chunk", 32), F.col("chunk").bitwiseAND((1 << 32) - 1)
    first = task * F.lit(1 << 40) + count * F.lit(1 << 20)
    fits = F.filter(F.sequence(first, first + F.lit(min(40 * parts, (1 << 20) - 1))), lambda x: F.pmod(F.hash(x), F.lit(parts)) == F.pmod(task, F.lit(parts)))
    return chunks.withColumn("chunk", F.coalesce(F.get(fits, F.lit(0)), first))


def classify(docs: DataFrame, trusted: DataFrame, *, quantile: float = 0.995, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Perplexity of every document under its language's model, and whether it is kept.

    trusted: a column doc_id, the documents to learn from (any rows, repeats don't matter). Returns doc_id, lang, n_chars,
    perplexity (per character), threshold (of the language) and keep. A document is kept if its perplexity, drawn to its
    language's mean by PRIOR_CHARS characters, is at most the `quantile` of those of its language's held-out trusted ones.

    A null or empty text has no perplexity and isn't kept. A null language is a language of its own. A language without
    trusted text has no model: null perplexity, kept. Without held-out trusted documents there is no threshold, and its documents are kept.
    Null ids are never trusted. Repeated rows are scored each. Other columns are ignored; an empty table gives no rows.
    """
    need(docs, id_col, lang_col, text_col)
    need(trusted, "doc_id")
    spark = docs.sparkSession
    scratch = Scratch(spark, "kneser")
    lang = F.when(F.col(lang_col).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(lang_col)))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), F.col(text_col).alias("text"))
    trusted = scratch.write(trusted.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct(), "trusted")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)) == 0
    teach = trusted.where(~held)
    slots = np.zeros(FILTER, bool)
    slots[teach.select(F.pmod("doc_id", F.lit(FILTER)).alias("x")).distinct().toPandas()["x"].to_numpy("int64")] = True  # FILTER at most
    slots = spark.sparkContext.broadcast(np.packbits(slots))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(slots.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(bits[np.mod(b.column(0).to_numpy(zero_copy_only=False).astype("i8"), FILTER)]))
            yield b.set_column(2, "text", pa.array([_pack([t]) for t in b.column(2).to_pylist()], pa.binary()))

    text = docs.where("doc_id is not null and text is not null").mapInArrow(lean(sift), "doc_id long, lang string, text binary").join(teach, "doc_id", "left_semi").select("lang", "text")
    levels = model(scratch, text)
    # Chunks hold the texts: they are joined where they lie.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = own_bucket(docs.mapInArrow(lean(_chunks), "chunk long, lang string, ids array<long>, texts binary"), parts)
    try:
        chunks = scratch.write_dealt(numbered, "chunks", "chunk", parts)
        listed = scratch.write(chunks.select("chunk", "lang", "texts").mapInArrow(lean(_listed), "chunk long, lang string, gram long"), "listed")
        p = probabilities(scratch, levels, listed.select("lang", "gram").distinct())
        values = listed.join(p, ["lang", "gram"]).groupBy("chunk").agg(F.collect_list(F.struct("gram", "log_p")).alias("known"))
        scored = chunks.join(values, "chunk", "left").select("chunk", "lang", "ids", "texts", "known").mapInArrow(lean(_scored), "doc_id long, lang string, n long, log_p double")
        scored = scratch.write(scored, "scored")
    finally:  # the session's catalog holds the buckets
        scratch.drop("chunks")
    scratch.drop("listed", f"p-{ORDER}")

    calibration = scored.join(trusted.where(held), "doc_id", "left_semi").where("n > 0")
    mean = calibration.groupBy("lang").agg((F.sum("log_p") / F.sum("n")).alias("mean"))
    drawn = F.exp(-(F.col("log_p") + PRIOR_CHARS * F.col("mean")) / (F.col("n") + PRIOR_CHARS))
    limit = calibration.join(mean, "lang").groupBy("lang").agg(F.percentile_approx(drawn, quantile, 10000).alias("threshold"), F.first("mean").alias("mean"))
    limit = scratch.write(limit, "limit")
    out = scored.join(limit, "lang", "left")
    kept = (F.col("n") > 0) & F.coalesce(drawn <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", F.when(F.col("lang") != "-", F.substring("lang", 2, 1 << 30)).alias("lang"), F.col("n").alias("n_chars"), F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n"))).alias("perplexity"), "threshold", kept.alias("keep"))
