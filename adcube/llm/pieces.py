"""SentencePiece encoding and decoding, batched over units of one length.

The pieces and scores of a model file are kept.  No piece has a space after
another character, so a text falls apart into units (spaces and the word after
them) that are segmented on their own.  Each chunk segments every different unit
once: units of one length advance together, and polynomial hashes of all their
substrings of a length are looked up among the sorted keys of the pieces at once.

The scores of a BPE model are merge ranks, so its segmentation is that of its
merges (``load(merges=True)``): in every step each unit joins its leftmost
neighbours whose piece scores highest, until no neighbours form a piece.  The
scores of a unigram model add up (``merges=False``): maxima over the lengths of
the last piece give the back pointers of a whole column.

The text is not normalised.  Spaces become the piece marker, with one more in
front; characters without a piece, and the marker itself, become bytes, so
decoding gives back every text exactly.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, hash_words, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, OTHER = 0x2581, 0x110000  # the marker for a space; what a marker in the text is taken for
CHUNK_BYTES = 1 << 20
CELLS = 1 << 16  # units of a length go together up to so many characters
ALONE = 400  # longer units are segmented one by one
MAYBE = 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    keys: list[np.ndarray]  # for each length: sorted hashes of the pieces
    maybe: list[np.ndarray]  # for each length: which first MAYBE bits of a hash some key has
    ids: list[np.ndarray]
    scores: list[np.ndarray]
    unknown: float  # score of a character without a piece
    byte_id: np.ndarray
    text: np.ndarray  # bytes of all pieces as decoded
    text_at: np.ndarray
    merges: bool = False  # segment by merges (BPE models), not by the highest sum


def load(model: str = MODEL, merges: bool = False) -> Vocabulary:
    """Read a model file; its size bounds what is sent to the tasks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    by_length: dict[int, list] = {}
    byte_id, text, least = np.full(256, -1, np.int32), [], 0.0
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            text.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text.append(b"")
        else:
            if chr(MARK) in piece.lstrip(chr(MARK)):
                raise ValueError(f"piece {i} has a space inside")
            text.append(piece.replace(chr(MARK), " ").encode())
            by_length.setdefault(len(piece), []).append((i, piece, sp.get_score(i)))
            if sp.get_score(i) > -1e8:
                least = min(least, sp.get_score(i))
    if (byte_id < 0).any():
        raise ValueError("the model has no piece for some byte")
    keys, maybe, ids, scores = [], [], [], []
    for length in range(1, max(by_length) + 1):
        rows = by_length.get(length, [])
        points = np.array([[ord(c) for c in p] for _, p, _ in rows], np.uint32).reshape(len(rows), length)
        key = substrings(points, length)[:, 0]
        order = np.argsort(key)
        maybe.append(np.zeros(1 << MAYBE, bool))
        maybe[-1][key >> np.uint64(64 - MAYBE)] = True
        keys.append(key[order]), ids.append(np.array([r[0] for r in rows], np.int32)[order]), scores.append(np.array([r[2] for r in rows], float)[order])
    return Vocabulary(keys, maybe, ids, scores, least - 10, byte_id, np.frombuffer(b"".join(text), np.uint8), np.cumsum([0, *map(len, text)]), merges)


def substrings(points: np.ndarray, length: int, prefix: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all substrings of ``length`` of each row."""
    h = prefixes(points) if prefix is None else prefix
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for _ in range(length):
            power = power * _BASE
    return h[:, length:] - h[:, : h.shape[1] - length] * power


def prefixes(points: np.ndarray) -> np.ndarray:
    h = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for j in range(points.shape[1]):
        h[:, j + 1] = h[:, j] * _BASE + points[:, j] + np.uint64(1)
    return h


def _found(points: np.ndarray, v: Vocabulary) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each length, the scores (-inf: none) and ids (-1) of the pieces that begin in each place."""
    hashes = prefixes(points)
    score, found = [], []
    for length in range(1, min(points.shape[1], len(v.keys)) + 1):
        q, key = substrings(points, length, hashes), v.keys[length - 1]
        scores, ids = np.full(q.shape, -np.inf), np.full(q.shape, -1, np.int32)
        row, column = np.nonzero(v.maybe[length - 1][q >> np.uint64(64 - MAYBE)])
        if len(row):
            q = q[row, column]
            at = np.minimum(np.searchsorted(key, q), len(key) - 1)
            hit = key[at] == q
            row, column, at = row[hit], column[hit], at[hit]
            scores[row, column], ids[row, column] = v.scores[length - 1][at], v.ids[length - 1][at]
        score.append(scores), found.append(ids)
    return score, found


def merged(points: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: a character without a piece) and their ends, for units of one length,
    rows padded with -2.  Every step joins one pair of each unit that still has one,
    so these units have the same number of symbols."""
    n, size = points.shape
    score, found = _found(points, v)
    out, ends = np.full((n, size), -2, np.int32), np.zeros((n, size), np.int32)
    longest = len(score)
    ids = np.full((longest, n, size), -1, np.int32)
    for length in range(1, longest + 1):
        ids[length - 1, :, : size - length + 1] = found[length - 1]

    def finish(rows, edge):
        begin = edge[:, :-1]
        out[rows, : begin.shape[1]] = ids[edge[:, 1:] - begin - 1, rows[:, None], begin]
        ends[rows, : begin.shape[1]] = edge[:, 1:]

    if n == 1:
        finish(np.zeros(1, np.int64), _merged_one(score, size))
        return out, ends
    value = np.full((longest + 1, n, size), -np.inf)
    for length in range(1, longest + 1):
        value[length - 1, :, : size - length + 1] = score[length - 1]
    rows, edge = np.arange(n), np.tile(np.arange(size + 1), (n, 1))
    pair = value[min(1, longest), :, : size - 1]
    for symbols in range(size, 1, -1):
        j = pair.argmax(1)
        go = pair[np.arange(len(rows)), j] > -np.inf
        if not go.all():
            finish(rows[~go], edge[~go])
            rows, edge, pair, j = rows[go], edge[go], pair[go], j[go]
        k = np.arange(len(rows))
        if not len(k):
            break
        keep = np.ones(edge.shape, bool)
        keep[k, j + 1] = False
        edge = edge[keep].reshape(len(k), symbols)
        keep = np.ones(pair.shape, bool)
        keep[k, j] = False
        pair = pair[keep].reshape(len(k), symbols - 2)
        for side, i in ((j > 0, j - 1), (j < symbols - 2, j)):
            r, i = k[side], i[side]
            begin = edge[r, i]
            pair[r, i] = value[np.minimum(edge[r, i + 2] - begin, longest + 1) - 1, rows[r], begin]
    if len(rows):
        finish(rows, edge)
    return out, ends


def _merged_one(score, size):
    """Edges of the symbols of one long unit, with a heap of the pairs instead of maxima over all."""
    lists = [s[0].tolist() for s in score]
    after, before = list(range(1, size + 1)), list(range(-1, size))
    pairs = [(-s, a, a + 1, a + 2) for a, s in enumerate(lists[1] if len(lists) > 1 else []) if s > -1e300]
    heapq.heapify(pairs)
    gone = bytearray(size + 1)
    while pairs:
        _, a, middle, end = heapq.heappop(pairs)
        if gone[a] or gone[middle] or after[a] != middle or after[middle] != end:
            continue
        gone[middle], after[a], before[end] = 1, end, a
        for left, mid, right in ((before[a], a, end), (a, end, after[end] if end < size else -1)):
            if left >= 0 and 0 <= right - left <= len(lists) and right > 0:
                s = lists[right - left - 1][left]
                if s > -1e300:
                    heapq.heappush(pairs, (-s, left, mid, right))
    return np.array([[i for i in range(size + 1) if not gone[i]]])


def viterbi(points: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: a character without a piece) and their ends, for units of one length,
    right-aligned rows padded with -2.  Of equal sums the longer last piece wins."""
    n, size = points.shape
    score, found = _found(points, v)
    longest = len(score)
    score[0] = np.where(found[0] < 0, v.unknown, score[0])
    if n == 1:
        last, piece = _one(score, found, size)
    else:
        best = np.zeros((size + 1, n))
        last, piece = np.zeros((size + 1, n), np.int32), np.full((size + 1, n), -1, np.int32)
        for end in range(1, size + 1):
            top = best[end - 1] + score[0][:, end - 1]
            step, own = np.ones(n, np.int32), found[0][:, end - 1]
            for length in range(2, min(end, longest) + 1):
                other = best[end - length] + score[length - 1][:, end - length]
                more = other >= top
                more &= other > -np.inf
                top = np.where(more, other, top)
                step = np.where(more, length, step)
                own = np.where(more, found[length - 1][:, end - length], own)
            best[end], last[end], piece[end] = top, step, own
    out, ends = np.full((n, size), -2, np.int32), np.zeros((n, size), np.int32)
    at, column, row = np.full(n, size), size - 1, np.arange(n)
    while len(row):
        out[row, column], ends[row, column] = piece[at[row], row], at[row]
        at[row] -= last[at[row], row]
        row, column = row[at[row] > 0], column - 1
    return out, ends


def _one(score, found, size):
    """The same for one long unit: the look-ups are arrays already, the maxima plain numbers."""
    lists = [s[0].tolist() for s in score]
    best, last = [0.0] * (size + 1), np.zeros((size + 1, 1), np.int32)
    for end in range(1, size + 1):
        top, step = best[end - 1] + lists[0][end - 1], 1
        for length in range(2, min(end, len(lists)) + 1):
            s = lists[length - 1][end - length]
            if s > -1e300 and best[end - length] + s >= top:
                top, step = best[end - length] + s, length
        best[end], last[end, 0] = top, step
    piece = np.full((size + 1, 1), -1, np.int32)
    for end in range(1, size + 1):
        piece[end, 0] = found[last[end, 0] - 1][0, end - last[end, 0]]
    return last, piece


def _bytes_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of each character, and how many."""
    p = np.where(points == OTHER, MARK, points).astype(np.int64)
    raw = (p >= 0xDC80) & (p <= 0xDCFF)  # a byte that is no UTF-8
    size = np.where(raw | (p < 0x80), 1, np.where(p < 0x800, 2, np.where(p < 0x10000, 3, 4)))
    out = np.zeros((len(p), 4), np.int64)
    for n in (2, 3, 4):
        for k in range(n):
            low = (p >> (6 * (n - 1 - k))) & 63
            lead = (0xF00 >> n) & 0xFF
            out[:, k] = np.where(size == n, (lead | (p >> (6 * (n - 1)))) if k == 0 else 0x80 | low, out[:, k])
    out[:, 0] = np.where(size == 1, np.where(raw, p - 0xDC00, p), out[:, 0])
    return out, size


def gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``values[begin : begin + size]`` of each, and where each starts."""
    at = np.append(0, np.cumsum(size))
    return values[np.arange(at[-1]) + np.repeat(begin - at[:-1], size)], at


def encode_chunk(raw: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's begin."""
    texts = [raw[a:b].tobytes().decode("utf-8", "surrogateescape") for a, b in zip(at[:-1], at[1:])]
    text_at = np.cumsum([0, *(len(t) + 1 if t else 0 for t in texts)])
    points = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    points = np.where(points == MARK, OTHER, np.where(points == 32, MARK, points)).astype(np.uint32)
    space = points == MARK
    new = space.copy()
    new[1:] &= ~space[:-1]
    new[text_at[:-1][text_at[:-1] < len(points)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(points))
    h = hash_words(points.view(np.uint8), start * 4, end * 4)
    _, first, of = np.unique(h, return_index=True, return_inverse=True)
    start_1, size = start[first], end[first] - start[first]

    order = np.argsort(size, kind="stable")
    unit_ids: list[np.ndarray] = []
    unit_size = np.zeros(len(first), np.int64)
    edges = np.append(np.flatnonzero(np.diff(size[order], prepend=-1)), len(order))
    for a, b in zip(edges[:-1], edges[1:]):
        length = int(size[order[a]])
        block = 1 if length > ALONE else max(1, CELLS // length)
        for c in range(a, b, block):
            units = order[c : min(b, c + block)]
            p = points[start_1[units][:, None] + np.arange(length)]
            ids, ends = (merged if v.merges else viterbi)(p, v)
            row, column = np.nonzero(ids > -2)
            piece = ids[row, column]
            char, n = _bytes_of(p[row, ends[row, column] - 1])
            n = np.where(piece < 0, n, 1)
            flat = np.repeat(piece, n)
            k = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            unknown = flat < 0
            flat[unknown] = v.byte_id[np.repeat(char, n, 0)[unknown, k[unknown]]]
            unit_ids.append(flat)
            unit_size[units] = np.bincount(row, n, len(units)).astype(np.int64)
    flat = np.concatenate(unit_ids)
    unit_at = np.zeros(len(first), np.int64)
    unit_at[order] = np.cumsum(unit_size[order]) - unit_size[order]
    ids, token_at = gather(flat, unit_at[of], unit_size[of])
    return ids, token_at[np.searchsorted(start, text_at)]


def decode_chunk(ids: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text's begin."""
    size = v.text_at[ids + 1] - v.text_at[ids]
    out, byte_at = gather(v.text, v.text_at[ids], size)
    text_at = byte_at[at]
    keep = np.ones(len(out), bool)
    front = text_at[:-1][text_at[:-1] < text_at[1:]]
    keep[front[out[front] == 32]] = False  # the space put in front
    return out[keep], np.append(0, np.cumsum(keep))[text_at]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids", carry: list[str] | None = None, check_col: str | None = None) -> DataFrame:
    """The columns ``carry`` (None: all) of every row and, last, the ids of its whole text.

    ``check_col``: one more column, whether the ids decode to the text again
    (decoded by the same task).  Null and empty texts have no ids; repeated rows
    have the same ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = docs.columns if carry is None else carry
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").cast("string").alias("text to encode"))
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for first, end, raw, at in chunks(batch.column(batch.num_columns - 1), CHUNK_BYTES):
                ids, id_at = encode_chunk(raw, at, sent.value)
                own = [batch.column(i).slice(first, end - first) for i in range(batch.num_columns - 1)]
                own.append(pa.ListArray.from_arrays(pa.array(id_at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                if check_col:
                    again, again_at = decode_chunk(ids, id_at, sent.value)
                    own.append(pa.array([raw[a:b].tobytes() == again[c:d].tobytes() for a, b, c, d in zip(at, at[1:], again_at, again_at[1:])], pa.bool_()))
                yield pa.RecordBatch.from_arrays(own, schema.names)

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    if check_col:
        schema = schema.add(check_col, T.BooleanType())
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and, last, the text of ``ids_col`` (null ids: null; an id out of range is an error)."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)
    place = rows.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(place)
            size = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            at = np.append(0, np.cumsum(size))
            raw, text_at = decode_chunk(lists.flatten().to_numpy(), at, sent.value)
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(text_at.astype(np.int64)), pa.py_buffer(raw)])
            text = pc.if_else(lists.is_valid(), data.cast(pa.binary()).cast(pa.string()), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, text_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())]))
