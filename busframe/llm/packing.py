"""Harmonic packing: token sequences of one capacity, filled class by class.

A piece of length l belongs to class k when capacity / (k + 1) < l <= capacity / k, so any k pieces of class k fit into one
bin. Each Spark task keeps one open bin per class and closes it at its k-th piece; tasks need nothing from each other, so
there is no shuffle and a lost task is simply run again. Documents are cut so that pieces come close to the upper end of
their class: first whole capacities, then the largest size of the next class until what is left wastes little.

At the end of a task fewer than k pieces are open in each class (bounded by the number of classes). They are laid one after
another and cut at the capacity; the last, short remainder is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from busframe.llm.common import bound_batches, kept, lean, need

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, class int, ids binary"
#: Distinct words that a worker remembers with their ids.
WORDS_KEPT = 600_000

# Characters that normalisation leaves alone but for case; the apostrophe starts contractions and isn't among them.
_ODD = re.compile(r"[^\t\n\r -&(-~À-ÖØ-öø-ÿ]")
_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_SPACE = re.compile(r"[ \t\n\r]+")


class WordIds:
    """Ids of texts by a tokenizer that never merges across white space, nor between letters, digits and signs (word_bpe_49k).

    Words repeat, so each is encoded once per worker. Text with other characters, or with an apostrophe, is encoded in
    pieces between white space by the tokenizer as it stands.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.words: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return _RUNS.findall(text.lower())
        out: list[str] = []
        for chunk in _SPACE.split(text):
            if chunk:
                out.extend([chunk] if _ODD.search(chunk) else _RUNS.findall(chunk.lower()))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids, little-endian unsigned 32-bit."""
        import numpy as np

        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        split = [self.split(t) for t in texts]
        known = self.words
        new = list({w for words in split for w in words if w not in known})
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = np.asarray(e.ids, "<u4").tobytes()
        get = known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= capacity // 64 or rest * rest <= capacity:
            out.append((rest, k))
            break
        k += 1
        out.append((capacity // k, k))
        rest -= capacity // k
    return out


class Bins:
    """Open bins of one task; take() returns finished rows of SCHEMA."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for length, k in cuts(total, self.capacity):
            piece = (doc_id, start, length, total, ids[4 * start : 4 * (start + length)])
            start += length
            if k == 1:
                self._close([piece], k)
                continue
            waiting = self.open.setdefault(k, [])
            waiting.append(piece)
            if len(waiting) == k:
                self._close(self.open.pop(k), k)

    def _close(self, pieces: list[tuple], k: int) -> None:
        offset = 0
        for doc_id, start, length, total, ids in pieces:
            self.done.append((doc_id, start, length, total, self.next_id, offset, k, ids))
            offset += length
        self.next_id += 1

    def finish(self) -> None:
        """Packs what is still open: at most one bin per class."""
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open.clear()
        left = sum(p[2] for p in rest)
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << b for b in reversed(range(left.bit_length())) if left >> b & 1]
        sizes.reverse()
        room, bin_ = (sizes.pop() if sizes else 0), []
        for doc_id, start, length, total, ids in rest:
            at = 0
            while at < length:
                n = min(room, length - at)
                bin_.append((doc_id, start + at, n, total, ids[4 * at : 4 * (at + n)]))
                at, room = at + n, room - n
                if not room:
                    self._close(bin_, 0)
                    room, bin_ = (sizes.pop() if sizes else 0), []

    def take(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs every document into sequences of at most `capacity` ids.

    Returns a row per piece: doc_id, start (ids of its document before it), length, doc_tokens (with the end id),
    sequence_id, offset (place in its sequence, gapless from 0), class (0: made from a task's last open bins) and ids
    (binary, little-endian unsigned 32-bit). Each id of each row of `docs` lies in exactly one piece.

    Null and empty texts are the end id alone. Rows with a null or repeated id are documents of their own. An empty table
    gives no rows. Other columns of `docs` are neither read nor returned, so their names can't clash. Long texts are cut
    like any other; memory per task is bounded by one batch of rows plus one open bin per class.
    """
    need(docs, id_col, text_col)
    bound_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    words_of = f"words {tokenizer_path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(words_of, lambda: WordIds(tokenizer_path))
        bins = Bins(capacity, TaskContext.get().partitionId() << 40)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    bins.add(doc_id, ids + end)
                if rows := bins.take():
                    yield batch(rows)
        bins.finish()
        if rows := bins.take():
            yield batch(rows)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(run, words_of), SCHEMA)
