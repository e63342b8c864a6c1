"""A training corpus from `documents`, stage by stage; each stage's result is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, labelled by it. Learned from labelled ones; null texts and those without a letter go.

    Rows with null ids and repeated rows stay, each as it is; without labelled documents, and of an empty table, none do.
    """
    from busframe.llm.langid import UNKNOWN, predict, train, train_fold

    found = predict(docs, train(train_fold(docs)), keep=COLUMNS).where(F.col("lang_pred") != UNKNOWN)
    return found.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id (null ids last), of rows with one id the least text hash.

    Null ids and repeated ids make no difference to what is a copy of what. An empty text is a copy of none; of rows that
    repeat both its id and text one stays.
    """
    from busframe.llm.jaccard import groups

    found = groups(docs)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    chosen = found.where("root is not null").groupBy("root").agg(F.min(order).alias("s")).select("s.doc_id", "s.key")
    chosen = chosen.unionByName(found.where("root is null").select("doc_id", "key").distinct())
    chosen = chosen.select(F.col("doc_id").alias("id"), F.col("key").alias("name"))
    kept = docs.select(*COLUMNS, F.xxhash64("text").alias("key"))
    kept = kept.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("name")), "left_semi")
    rest = [c for c in COLUMNS if c != "doc_id"]
    return kept.groupBy("doc_id", "key").agg(F.min(F.struct(*rest)).alias("s")).select("doc_id", "s.*").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur at another place too; bytes of a character cut in two go."""
    from busframe.llm.suffix_dedup import dedup

    kept = dedup(docs, keep=["doc_id", "lang", "source"])
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    text = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", ""))
    return kept.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is taken, whole.

    Null and empty texts have no words and aren't taken; a null source is one of its own; repeated rows count each; an empty
    table gives none.
    """
    from busframe.llm.mixing import mix

    mixed = mix(docs, keep=COLUMNS)
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row a piece of a document, as pack() says. Null texts are empty; repeated rows are packed each; an empty table gives none."""
    import public_tokenizers

    from busframe.llm.packing import pack

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mix_sources", mix_sources), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs


#: The classifier, the knapsack's choice and the tokenizer are beyond SQL.
ORACLE_SQL = None
