"""Maximal periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of words with smallest period q (words q apart are equal), of at
least max(LEAST, TIMES * q) words, that no neighbouring word extends.

*Tiles.*  The periods are cut into octaves [B, 2B).  For each, a text is exploded into
overlapping tiles, one at every B-th word ("boundary"), that reach B words back and
less than 7B ahead.  A run of 4q words matches itself q words on for at least 3B words,
so the first boundary among these has 2B matches ahead of it: a tile looks for one
period and two only, whatever the text's length.

*Boundary Z-functions.*  Z(q), how far the words from the boundary on equal those from q
words after it on, and its mirror image backwards, give the part of the run that the
tile sees: up to 3B matches ahead and B back, so the parts of neighbouring tiles meet.
Periods with Z(q) < 2B are ruled out for all tiles at once by a hash of 2B words (equal
stretches have equal hashes); the others are compared word by word.  By the periodicity
lemma two periods q1 != q2 of one octave with 2B matches at one boundary are both
multiples of a shorter one, and one that stands alone can only be twice a shorter one:
so a tile has at most one smallest period in an octave, and a text of n words at most
2n parts, in O(n log n).

*Stitching.*  Parts are dealt by (document, period) and merged where they meet or
overlap.  Parts of one task are merged before they are sent, so a text that is one long
run sends few.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, find_words, map_text, mix, rows_of, small_batches, stored

LEAST, TIMES = 6, 4  # TIMES: the tiles above are made for four
SLAB = 1 << 20  # words compared at a time

_PART = "struct<period:long,first:long,stop:long>"
_PARTS = pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("stop", pa.int64())]))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_ids(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words (exact)."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    inside = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw[inside])])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _ahead(w: np.ndarray, a: np.ndarray, q: np.ndarray, most: int, step: int) -> np.ndarray:
    """For each boundary ``a`` and period ``q``: how many words from ``a`` on (``step`` 1) or before
    it (``step`` -1) equal those ``q`` words further on, up to ``most``."""
    out = np.zeros(len(a), np.int64)
    rows = max(1, SLAB // most)
    for i in range(0, len(a), rows):
        at = a[i : i + rows, None] + (np.arange(most) if step > 0 else -1 - np.arange(most))
        to = at + q[i : i + rows, None]
        inside = (at >= 0) & (to < len(w))
        equal = inside & (w[np.where(inside, at, 0)] == w[np.where(inside, to, 0)])
        out[i : i + rows] = np.where(equal.all(1), most, np.argmin(equal, 1))
    return out


def solve(w: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of runs in ``w``: period, first word that equals the one a period on, and the one after the last.

    ``longest``: words of the longest text in ``w`` (texts are set apart by numbers that occur once).
    """
    found = []
    h, span, b = mix(w.view(np.uint64) + _ODD), 1, 1
    while TIMES * b <= longest and longest >= LEAST:
        while span < 2 * b:  # hashes of 2b words, from those of b
            if len(h) <= span:
                break
            h, span = mix(h[:-span] * _ODD + mix(h[span:])), 2 * span
        tiles = -(-(len(h) - b) // b)  # a tile's boundary k * b is compared with the words from (k + 1) * b on
        size = len(h)
        padded = np.concatenate([h, np.zeros((tiles + 1) * b - size, np.uint64)]) if tiles > 0 else h
        if span < 2 * b or tiles < 1:
            break
        rows = max(1, SLAB // b)
        a_all, q_all = [], []
        for k in range(0, tiles, rows):
            m = min(rows, tiles - k)
            ahead = padded[(k + 1) * b : (k + 1 + m) * b].reshape(m, b)
            tile, r = np.nonzero(ahead == padded[k * b : (k + m) * b : b, None])
            there = (k + 1 + tile) * b + r < size
            tile, r = tile[there], r[there]
            # The first two periods of a tile, and how many there are.
            first = np.flatnonzero(np.diff(tile, prepend=-1))
            count = np.diff(np.append(first, len(tile)))
            a, q1 = (k + tile[first]) * b, b + r[first]
            q2 = b + r[np.minimum(first + 1, max(len(r) - 1, 0))] if len(r) else q1
            one = count == 1
            a_all.append(a[one])
            q_all.append(q1[one])
            if not one.all():
                a, q1, q2 = a[~one], q1[~one], q2[~one]
                false = np.minimum(_ahead(w, a, q1, 2 * b, 1), _ahead(w, a, q2, 2 * b, 1)) < 2 * b
                for t in np.flatnonzero(false):  # equal hashes of other words: all periods of that tile, exactly
                    at = int(a[t]) // b - k
                    qs = b + r[tile == at]
                    qs = qs[_ahead(w, np.full(len(qs), a[t]), qs, 2 * b, 1) == 2 * b]
                    if len(qs) == 1:
                        a_all.append(a[t : t + 1])
                        q_all.append(qs)
        a, q = np.concatenate(a_all), np.concatenate(q_all)
        if len(a):
            z = _ahead(w, a, q, 3 * b, 1)
            half = q // 2
            twice = (q % 2 == 0) & (half > 0)
            twice[twice] = _ahead(w, a[twice], half[twice], 2 * b, 1) >= half[twice]
            keep = (z >= 2 * b) & ~twice
            a, q, z = a[keep], q[keep], z[keep]
            found.append((q, a - _ahead(w, a, q, b, -1), a + z))
        b *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def merged(group: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one group that meet or overlap, made one."""
    if not len(group):
        return group, first, stop
    order = np.lexsort((first, group))
    group, first, stop = group[order], first[order], stop[order]
    shift = (np.diff(group, prepend=group[0]) != 0).cumsum() * (stop.max() + 1)  # no group reaches into the next
    reach = np.maximum.accumulate(stop + shift)
    new = np.append(True, (np.diff(group) != 0) | (first[1:] + shift[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return group[at], first[at], np.maximum.reduceat(stop, at)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_words, words`` (joined by one space) and ``parts`` of every row."""

    def run(batch, first, end, raw, at):
        start, stop, word_at = find_words(raw, at)
        n = np.diff(word_at)
        period, low, high, doc = (np.zeros(0, np.int64),) * 4
        if len(n) and n.max() >= LEAST:
            # One number more after each text, of its own.
            shift = np.repeat(np.arange(len(n)), n)
            w = np.empty(len(start) + len(n), np.int64)
            w[np.arange(len(start)) + shift] = word_ids(raw, start, stop)
            base = word_at[:-1] + np.arange(len(n))
            w[base + n] = -1 - np.arange(len(n))
            period, low, high = solve(w, int(n.max()))
            doc = np.searchsorted(base, low, "right") - 1
            key, low, high = merged(doc * (len(w) + 1) + period, low, high)
            doc, period = np.divmod(key, len(w) + 1)
            low, high = low - base[doc], high - base[doc]
        parts = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(n) + 1)), pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (period, low, high)], ["period", "first", "stop"]))
        # The words of each text and one space after all but its last.
        keep = np.zeros(len(raw) + 1, np.int32)
        np.add.at(keep, start, 1)
        np.add.at(keep, stop, -1)
        inside = keep.cumsum()[:-1] > 0
        last = np.zeros(len(start), bool)
        last[(word_at[1:] - 1)[n > 0]] = True
        gaps = stop[~last]
        out = raw.copy()
        out[gaps] = 0x20
        inside[gaps] = True
        size = np.concatenate([[0], np.cumsum(inside)])[at]
        words = pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(out[inside])])
        return pa.RecordBatch.from_arrays([*rows_of(batch, first, end, "doc_id", "text_key"), pa.array(n, pa.int64()), words, parts], ["doc_id", "text_key", "n_words", "words", "parts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, run, f"doc_id {kind}, text_key long, n_words long, words string, parts array<{_PART}>")


def stitched(parts: DataFrame) -> DataFrame:
    """``doc_id, text_key, runs`` (start, length, period) from ``doc_id, text_key, period, first, stop``."""
    own = Window.partitionBy("doc_id", "text_key", "period").orderBy("first", "stop")
    before = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.distinct().withColumn("new", F.coalesce(F.col("first") > before, F.lit(True)).cast("long")).withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy("doc_id", "text_key", "period", "run").agg(F.min("first").alias("start"), F.max("stop").alias("stop"))
    runs = runs.withColumn("length", F.col("stop") - F.col("start") + F.col("period")).where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return runs.groupBy("doc_id", "text_key").agg(listed.alias("runs")).withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])))


RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_words, runs, kept`` of every row: its runs by start, then period, and
    its words, joined by one space, without those that a run repeats (all after its first period).

    A null or empty text has no words and no runs.  Rows that share an id are told apart by
    their text; equal rows get equal results.  Ties do not arise: two runs of one period are
    apart or overlap by less than a period, and all runs are returned.
    """
    found = stored(scan(documents(docs, id_col, text_col)))
    parts = found.where(F.size("parts") > 0).select("doc_id", "text_key", F.explode("parts").alias("p")).select("doc_id", "text_key", "p.*")
    runs = stitched(parts).select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "runs")
    some = found.where(F.size("parts") > 0).join(runs, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")), "left")
    none = F.array().cast(RUNS)
    some = some.select("doc_id", "text_key", "n_words", F.coalesce("runs", none).alias("runs"), "words")
    plain = found.where(F.size("parts") == 0).select("doc_id", "text_key", "n_words", none.alias("runs"), F.col("words").alias("kept"))
    return plain.unionByName(_kept(some))


def _kept(rows: DataFrame) -> DataFrame:
    """``words`` without the repeated ones, as ``kept``."""
    small_batches(rows.sparkSession)
    schema = T.StructType(rows.schema.fields[:-1]).add("kept", "string")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a text at a time
                row = batch.slice(i, 1)
                runs, words = row.column("runs")[0].as_py(), row.column("words")[0].as_py()
                if runs:
                    split = words.split(" ")
                    edge = np.zeros(len(split) + 1, np.int64)
                    np.add.at(edge, [r["start"] + r["period"] for r in runs], 1)
                    np.add.at(edge, [r["start"] + r["length"] for r in runs], -1)
                    words = " ".join(compress(split, (edge.cumsum()[:-1] == 0).tolist()))
                yield pa.RecordBatch.from_arrays([*row.columns[:-1], pa.array([words], pa.string())], schema.names)

    return rows.mapInArrow(run, schema)
