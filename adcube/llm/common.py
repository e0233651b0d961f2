"""Helpers shared by the text operators: Arrow text buffers, words and hashes.

Python tasks get text as Arrow buffers and work on the UTF-8 bytes with numpy;
no string object is made for a word.  A batch is cut into chunks of a few MB of
text, so a task's memory does not depend on the number or length of documents
(one document longer than a chunk is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written as stored  # small results used twice, cut off from their lineage

CHUNK_BYTES = 1 << 20
BATCH_ROWS = 2_000

# Word separators: the characters \x20 and \x09-\x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, text_key``: whole texts (null: empty), and a hash that with
    ``doc_id`` names a row, so that rows which share an id are kept apart.  Other
    columns are left behind, whatever their names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


# ------------------------------------------------------------------- Arrow text

def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows of up to ``limit`` bytes."""
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, end, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel in Arrow batches of BATCH_ROWS rows at most (results do not depend on it):
    a batch is held twice by the JVM and once by Python, for each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch, int, int, np.ndarray, np.ndarray], pa.RecordBatch | None], schema: str | T.StructType, text: str = "text", limit: int = CHUNK_BYTES) -> DataFrame:
    """Apply ``fn(batch, first, end, bytes, offsets)`` to every chunk of the text column."""
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for first, end, raw, at in chunks(batch.column(batch.schema.get_field_index(text)), limit):
                out = fn(batch, first, end, raw, at)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def rows_of(batch: pa.RecordBatch, first: int, end: int, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)).slice(first, end - first) for n in names]


# ------------------------------------------------------------------------ words

def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def find_words(raw: np.ndarray, at: np.ndarray, separator: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and where each document's words begin (one more at the end)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~separator[raw]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], before[0] = inside[:-1], False
    after[:-1], after[-1] = inside[1:], False
    edges = at[(at > 0) & (at < len(raw))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, at)


def hash_words(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, eight bytes of all of them at a time."""
    size = end - start
    h = mix(size.astype(np.uint64) * _M1)
    if not len(start):
        return h
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(raw) + 1,), np.dtype("<u8"), padded, strides=(1,))
    keep = (np.uint64(1) << (np.uint64(8) * np.arange(8, dtype=np.uint64))) - np.uint64(1)
    left = np.where(size < 8, size, 0)
    v = lanes[start]
    h = mix((h ^ np.where(left > 0, v & keep[left], v)) * _M1)
    todo = np.flatnonzero(size > 8)
    k = 8
    while len(todo) and k < 256:
        rest = size[todo] - k
        v = lanes[start[todo] + k]
        h[todo] = mix((h[todo] ^ np.where(rest < 8, v & keep[np.minimum(rest, 7)], v)) * _M1)
        todo = todo[rest > 8]
        k += 8
    for i in todo:  # rare: words of over 256 bytes
        h[i] = np.uint64(xxhash.xxh3_64_intdigest(raw[start[i] : end[i]].tobytes()))
    return h


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values (runs across documents too)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, seed, np.uint64)
    for j in range(n):
        out += h[j : len(h) - n + 1 + j] * mix(np.array([j + 1 + 1000 * (seed + 1)], np.uint64) * _M1 | np.uint64(1))
    return mix(out)


def whole_runs(word_at: np.ndarray, n: int) -> np.ndarray:
    """Positions at which ``n`` consecutive words of one document begin."""
    last = np.repeat(word_at[1:], np.diff(word_at))
    return np.flatnonzero(np.arange(len(last)) + n <= last)


def sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values, by doubling the span."""
    out, span = a, 1
    while span * 2 <= n:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return out if span == n else np.minimum(out[: len(out) - (n - span)], out[n - span :])


def doc_of(word_at: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))


# ---------------------------------------------------------- bitmaps of fixed size

def bitmap(df: DataFrame, slot: Column, bits: int) -> np.ndarray:
    """The set of ``slot`` values (0 to 2^bits - 1) as a bitmap of 2^bits / 8 bytes.
    At most 2^bits / 64 rows reach the driver, whatever the size of ``df``."""
    words = df.select(slot.alias("s")).groupBy(F.expr("s >> 6").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << max(bits - 6, 0), np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def slot_of(h: np.ndarray, bits: int) -> np.ndarray:
    return mix(h) >> np.uint64(64 - bits)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_array(at: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)
