"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else is white space; n-grams of the orders ORDERS are hashed to BUCKETS. The matrix of
log probabilities (BUCKETS x languages, 32-bit) is broadcast, and each batch of texts is scored in numpy: the matrix rows
of all its n-grams are summed by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import bound_batches, lean, need

ORDERS, BUCKETS = (1, 2, 3), 1 << 16
#: Learned from at most about so many documents a language, chosen by hash; more languages than this are refused, since the matrix is broadcast.
SAMPLE, LANGUAGES = 4000, 1000
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the joined texts, an array per order; each text's first place in them; whether it has a letter."""
    joined = np.frombuffer("".join(f" {t.lower()} " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t.lower()) + 2 for t in texts])
    letter = _is_letter()[joined]
    codes = np.where(letter, joined, 32).astype("u4")
    # White space stays where a letter precedes it, and at the first place of a text.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    starts = np.concatenate(([0], ends[:-1])).astype("i8")
    keep[starts] = True
    place = np.cumsum(keep) - 1
    has = np.add.reduceat(letter, starts, dtype="i8") > 0
    starts, codes = place[starts], codes[keep]
    # What follows a text's end is white space, whatever text stands next to it.
    after = []
    for j in range(max(ORDERS)):
        c = np.concatenate((codes[j:], np.full(min(j, len(codes)), 32, "u4")))
        for k in range(j):
            c[np.maximum(np.append(starts[1:], len(codes)) - 1 - k, starts)] = 32
        after.append(c)
    grams = []
    for order in ORDERS:
        h = np.full(len(codes), order * 0x9E3779B1 & 0xFFFFFFFF, "u4")
        for j in range(order):
            h = (h ^ after[j]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        grams.append(h & np.uint32(BUCKETS - 1))
    return grams, starts, has


def _blocks(texts: list[str], chars: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about `chars` code points, with the place of the first; a longer text stands alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    log_p: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its probability; UNKNOWN and 0 for a text that is null or has no letter."""
        names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, sure
        for first, block in _blocks([t or "" for t in texts], max(200_000, 4_000_000 // len(self.languages))):
            grams, starts, has = features(block)
            log = np.repeat(self.prior[None, :], len(block), axis=0)
            for g in grams:
                log += np.add.reduceat(self.log_p[g], starts, axis=0, dtype="f8")
            best = log.argmax(axis=1)
            p = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
            for i in np.flatnonzero(has):
                names[first + i] = self.languages[best[i]]
            sure[first : first + len(block)] = np.where(has, p, 0.0)
        return names, sure


def train(labelled: DataFrame, *, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE, smoothing: float = 0.5) -> Model:
    """Learns from the rows whose language and text aren't null.

    A language with more than `sample` documents is learned from about so many, whole, chosen by a hash of the id (rows with a
    null id are not chosen then). Counting is Spark's; one vector of BUCKETS counts per language reaches the driver.
    """
    need(labelled, lang_col, text_col, id_col)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(n) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    of_language = F.element_at(F.create_map(*[F.lit(x) for pair in n.items() for x in pair]), F.col("lang")) if n else F.lit(0)
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) * of_language < sample * (1 << 30)).select("lang", "text")
    chosen = chosen.repartition(1 + sum(min(x, sample) for x in n.values()) // 1000)  # each task returns a whole vector per language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist(), dtype=object), b.column(1).to_pylist()
            for lang in set(langs.tolist()):
                for _, block in _blocks([texts[i] for i in np.flatnonzero(langs == lang)], 1_000_000):
                    for g in features(block)[0]:
                        total[lang] = total.get(lang, 0) + np.bincount(g, minlength=BUCKETS)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.astype("<i8").tobytes() for v in total.values()], pa.binary())], names=["lang", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"][:1], "v": [sum(np.frombuffer(v, "<i8") for v in pdf["v"]).tobytes()]})

    found = chosen.mapInArrow(lean(count), "lang string, v binary").groupBy("lang").applyInPandas(add, "lang string, v binary").collect()
    vectors = {r["lang"]: np.frombuffer(r["v"], "<i8") for r in found}
    languages = sorted(vectors)
    if not languages:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), "f4"))
    m = np.stack([vectors[x] for x in languages], axis=1) + smoothing
    prior = np.log([n[x] / sum(n[y] for y in languages) for x in languages])
    return Model(languages, prior, np.log(m / m.sum(axis=0)).astype("f4"))


def predict(docs: DataFrame, model: Model, *, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of `docs`, then lang_pred and score (the model's probability of lang_pred), for every row.

    Whole texts are scored. A null text, or one without a letter, is UNKNOWN with score 0; so is everything if nothing was
    learned. Columns of `keep` with these names are replaced. Repeated rows give repeated rows, an empty table none.
    """
    need(docs, text_col, *keep)
    bound_batches(docs.sparkSession)
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                names, sure = shared.value.score(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(names, pa.string()), pa.array(sure)], names=[f.name for f in schema.fields])

    return docs.select(docs[text_col].alias("__text"), *[docs[c] for c in keep]).mapInArrow(lean(run), schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. Null ids are neither held out nor trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_fold(docs: DataFrame) -> DataFrame:
    """What may be learned from: rows with an id that are not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out())
