"""Interface documents as element rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframe.schemas import ICD_1553, ICD_429, MESSAGE_KEYS
from busframe.sources.tables import shared_folder

_BAD = "_malformed"
#: Rows that a batch of several documents' rows has at most.
_ROWS = 5000


def read_icd_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(elements, malformed lines) of 25-column CSV files with a header that begins msg_name,elem_name."""
    head = spark.read.text(path).first()
    if not head or not head[0].startswith("msg_name,elem_name"):
        raise ValueError("the header must begin with msg_name,elem_name")
    rows = spark.read.csv(path, schema=f"{ICD_1553}, {_BAD} string", header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, enforceSchema=True)
    folder = shared_folder(spark, "icd")  # Spark can't select malformed lines alone of a file that it parses
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    return rows.where(F.col(_BAD).isNull()).drop(_BAD), rows.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def load(text: str) -> dict:
    """A YAML document, by libyaml where it is installed."""
    import yaml

    return yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader)) or {}


def _documents(spark: SparkSession, path: str, found: Callable[[dict], Iterable[tuple]], schema: str) -> DataFrame:
    """What is found in each YAML document, rows of small ones together in a batch."""
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for b in batches:
            for text in b["value"]:
                held.extend(found(load(text)))
                if len(held) >= _ROWS:
                    yield pd.DataFrame(held, columns=names)
                    held = []
        yield pd.DataFrame(held, columns=names)

    return spark.read.text(path, wholetext=True).select("value").mapInPandas(rows, schema)


def _elements_1553(doc: dict) -> Iterator[tuple]:
    for msg, body in (doc.get("translatable_message_definitions") or {}).items():
        if not isinstance(body, dict) or not {"msg_data", "word_elem", "bit_elem"} <= body.keys():
            continue
        d = body["msg_data"]
        command, addr, sub = (list(d[k]) for k in ("command", "lru_addr", "lru_subaddr"))
        names = [*(d.get("lru_name") or []), "", ""]
        for kind in ("word_elem", "bit_elem"):
            for elem, e in (body[kind] or {}).items():
                offset = e.get("offset", e.get("off", e.get(False)))  # YAML reads a bare off as false
                yield (
                    msg, elem, command[0], command[1], d["wrdcnt"], d["bus"], names[0], addr[0], names[1], addr[1], sub[0], sub[1], float(d["rate"]), offset, e["cnt"], e["schema"], kind == "bit_elem",
                    bool(e.get("multifmt")), e.get("msb", 0), e.get("lsb", 0), e.get("bitcnt", 0), e.get("class"), e.get("desc"), float(e["msbval"]), e.get("uom"),
                )


def read_icd_yaml_1553(spark: SparkSession, path: str) -> DataFrame:
    """Element rows of the messages in one or many YAML documents; a message without its three maps is skipped."""
    return _documents(spark, path, _elements_1553, ICD_1553)


def read_supplemental_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, bus) of the command words that documents list for the vote alone."""

    def listed(doc: dict) -> Iterator[tuple]:
        for bus, pairs in (doc.get("supplemental_bus_map_command_words") or {}).items():
            yield from ((tx * 65536 + rx, bus) for tx, rx in pairs)

    return _documents(spark, path, listed, MESSAGE_KEYS)


def read_icd_yaml_429(spark: SparkSession, path: str) -> DataFrame:
    """Element rows of the words in one or many YAML documents, bit positions counted from 1 at the most significant."""
    raw = "word_name string, elem_name string, label int, bus string, sdi int, rate double, lru_name string, schema string, lsb int, bitcnt int, msb_val double, description string, uom string, classification int"

    def elements(doc: dict) -> Iterator[tuple]:
        for word, body in (doc.get("translatable_word_definitions") or {}).items():
            d = body["wrd_data"]
            for elem, e in (body.get("elem") or {}).items():
                yield word, elem, d["label"], d["bus"], d.get("sdi", -1), float(d["rate"]), d.get("lru_name"), e["schema"], e["lsb"], e["bitcnt"], float(e["msbval"]), e.get("desc"), e.get("uom"), e.get("class")

    return bit_positions_429(_documents(spark, path, elements, raw))


def bit_positions_429(rows: DataFrame) -> DataFrame:
    """ICD_429 rows from the document's own lsb and bitcnt. Bits 9 and 10 (SDI) lie before the data in the word as stored."""
    lsb = F.lit(32) - F.col("lsb") + F.when(F.col("lsb") < 11, 9).otherwise(11)
    rows = rows.withColumns({"bus": F.upper("bus"), "bitlsb": lsb.cast("int"), "bit_count": F.col("bitcnt"), "bcd_partial": F.lit(-1)}).withColumn("bitmsb", F.col("bitlsb") - F.col("bit_count") + 1)
    return rows.select(*[x.split()[0] for x in ICD_429.split(", ")])
