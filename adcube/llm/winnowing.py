"""Benchmark decontamination by winnowing.

A test window is ``window`` consecutive words of an item (an item with fewer is
one window).  Of every ``window - gram + 1`` consecutive ``gram``-word hashes the
smallest is kept (the last of equal ones), in items and documents alike, so each
shared run of ``window`` words leaves at least one fingerprint in common.  The
fingerprints of both sides are joined and each hit is extended word by word, the
words themselves compared, to the whole shared run around it.

The test fingerprints also fill a bitmap of fixed size, and documents only send
fingerprints that it may hold.  A full bitmap sends more; results do not change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bitmap, documents, find_words, gram_hashes, hash_words, in_bitmap, map_text, mix, rows_of, same_row, signed, slot_of, stored, whole_runs

WINDOW, GRAM, BITS = 10, 5, 26

# Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def winnow(grams: np.ndarray, runs: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest (last of equal) of ``span`` values from each of ``runs``, once each."""
    if not len(runs):
        return runs
    best, low = runs.copy(), grams[runs]
    for j in range(1, span):
        other = grams[runs + j]
        take = other <= low
        low = np.where(take, other, low)
        best = np.where(take, runs + j, best)
    return best[np.append(True, best[1:] != best[:-1])]


def _salted(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of whole short items of ``size`` words (0: of winnowed grams) do not mix."""
    return mix(h + np.uint64(size))


class Reader:
    """Words and fingerprints of a chunk of texts."""

    def __init__(self, raw, at, window, gram):
        self.window, self.gram = window, gram
        self.raw = LOWER[raw]
        self.start, self.end, self.word_at = find_words(self.raw, at, SEPARATOR)
        self.h = hash_words(self.raw, self.start, self.end)

    def winnowed(self) -> tuple[np.ndarray, np.ndarray]:
        grams = gram_hashes(self.h, self.gram)
        at = winnow(grams, whole_runs(self.word_at, self.window), self.window - self.gram + 1)
        return at, _salted(grams[at], 0)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        at = whole_runs(self.word_at, size)
        return at, _salted(gram_hashes(self.h, size)[at], size)

    def prints(self, at: np.ndarray, prints: np.ndarray, size: int):
        """``doc, print, size, word, words before, words`` of each: the words that a shared window may cover."""
        doc = np.searchsorted(self.word_at, at, "right") - 1
        around = 0 if size else self.window - self.gram
        a = np.maximum(self.word_at[doc], at - around)
        b = np.minimum(self.word_at[doc + 1], at + (size or self.gram + around))
        words = [b" ".join([self.raw[self.start[k] : self.end[k]].tobytes() for k in range(i, j)]) for i, j in zip(a.tolist(), b.tolist())]
        return doc, signed(prints), np.full(len(at), size, np.int32), (at - self.word_at[doc]).astype(np.int32), (at - a).astype(np.int32), words


PRINT = "struct<print:long,size:int,first:int,before:int,words:binary>"


def _structs(parts) -> tuple[np.ndarray, pa.Array]:
    doc = np.concatenate([p[0] for p in parts])
    order = np.argsort(doc, kind="stable")
    words = [w for p in parts for w in p[5]]
    fields = [pa.array(np.concatenate([p[i] for p in parts])[order]) for i in (1, 2, 3, 4)]
    return doc[order], pa.StructArray.from_arrays([*fields, pa.array([words[i] for i in order], pa.binary())], ["print", "size", "first", "before", "words"])


def test_prints(items: DataFrame, window: int, gram: int) -> DataFrame:
    """``item_id, print, size, first, before, words`` of whole items."""

    def run(batch, first, end, raw, at):
        r = Reader(raw, at, window, gram)
        n = np.diff(r.word_at)
        parts = [r.prints(*r.winnowed(), 0)]
        for size in range(1, window):
            whole, prints = r.runs(size)
            own = n[np.searchsorted(r.word_at, whole, "right") - 1] == size
            parts.append(r.prints(whole[own], prints[own], size))
        doc, structs = _structs(parts)
        ids = rows_of(batch, first, end, "item_id")[0].take(pa.array(doc))
        return pa.RecordBatch.from_arrays([ids, *structs.flatten()], ["item_id", "print", "size", "first", "before", "words"])

    return map_text(items, run, "item_id string, print long, size int, first int, before int, words binary")


def scan(docs: DataFrame, prints, sizes: list[int], bits: int, window: int, gram: int) -> DataFrame:
    """``doc_id, text_key, n_words, found`` of every document; found: fingerprints that the bitmap may hold."""

    def run(batch, first, end, raw, at):
        r = Reader(raw, at, window, gram)
        parts = []
        for size in [0, *sizes]:
            where, h = r.runs(size) if size else r.winnowed()
            hit = in_bitmap(prints.value, slot_of(h, bits))
            parts.append(r.prints(where[hit], h[hit], size))
        doc, structs = _structs(parts)
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(end - first + 1)).astype(np.int32)), structs)
        return pa.RecordBatch.from_arrays([*rows_of(batch, first, end, "doc_id", "text_key"), pa.array(np.diff(r.word_at)), lists], ["doc_id", "text_key", "n_words", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, run, f"doc_id {kind}, text_key long, n_words long, found array<{PRINT}>")


def extend(pairs: DataFrame, window: int, gram: int) -> DataFrame:
    """Shared runs of at least a window around each pair of equal fingerprints."""

    def run(batches):
        for batch in batches:
            keep, first, end = [], [], []
            for i, (size, at, a, d, b, t) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3, 9)))):
                if size:
                    left, n = 0, size if d == t else 0
                    whole = n > 0
                else:
                    d, t = d.split(b" "), t.split(b" ")
                    left = 0
                    while left < min(a, b) and d[a - left - 1] == t[b - left - 1]:
                        left += 1
                    n = 0
                    while n < min(len(d) - a, len(t) - b) and d[a + n] == t[b + n]:
                        n += 1
                    whole = n >= gram and left + n >= window
                if whole:
                    keep.append(i), first.append(at - left), end.append(at + n)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(3)), pa.array(first, pa.int32()), pa.array(end, pa.int32())], ["doc_id", "text_key", "item_id", "first", "end"])

    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {kind}, text_key long, item_id string, first int, end int")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM, bits: int = BITS) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, items`` (ids as text, sorted) for every row of ``docs``.

    A word counts as hit inside any occurrence of a window of an item.  Null and
    empty texts have no words and no windows; rows that repeat an item id count
    as one item, and an item without an id hits words but is not listed; repeated
    documents repeat their rows.  Without items nothing is hit.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(item_col).cast("string").alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text")).distinct()
    tests = stored(test_prints(tests, window, gram))
    sizes = sorted(r.size for r in tests.where("size > 0").select("size").distinct().collect())  # fewer than a window
    filled = bitmap(_slots(tests, bits), F.col("slot"), bits)
    found = stored(scan(documents(docs, id_col, text_col), spark.sparkContext.broadcast(filled), sizes, bits, window, gram))
    hits = found.select("doc_id", "text_key", F.explode("found").alias("f")).select("doc_id", "text_key", "f.print", "f.size", "f.first", F.col("f.before").alias("a"), F.col("f.words").alias("d"))
    pairs = hits.join(tests.select("item_id", "print", "size", F.col("before").alias("b"), F.col("words").alias("t")), ["print", "size"])
    runs = extend(pairs.select("doc_id", "text_key", "item_id", "size", "first", "a", "d", "b", "t"), window, gram)
    by_doc = runs.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "end")).alias("runs"), F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct((acc["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(acc["to"], r["first"]))).alias("n"), F.greatest(acc["to"], r["end"]).alias("to")),
        lambda acc: acc["n"].cast("long"),
    )
    by_doc = by_doc.withColumn("n_hit", covered)
    return found.join(by_doc, same_row(found, by_doc), "left").select(found["doc_id"], found["text_key"], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _slots(tests: DataFrame, bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            h = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(slot_of(h, bits)))], ["slot"])

    return tests.select("print").mapInArrow(run, "slot long")
