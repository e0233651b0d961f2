"""Conversations as token ids with loss masks.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn, turns in order and
nothing between.  Control strings all begin with ``<|``; in roles and texts a backslash is
set after the ``<`` (one more, where there are some already), so a text cannot end its own
turn and :func:`unescaped` gives back exactly what was there.

A conversation is rendered as one string and encoded once.  The control strings are
tokens of their own, so no token lies across the border of a text, and the tokenizer's
offsets (code points of the rendered string) tell which tokens belong to which turn: the
sorted spans of the turns to be learnt are looked up among the sorted token spans by
binary search.  As no token crosses a control string, a conversation that is cut between
turns has the same ids: one that lies in several ranges of the sort, or that is longer
than SEGMENT, becomes several rows, in the order of ``part``, so a task holds a bounded
string however long a conversation is (but for a single turn, which is never cut).
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

FOLDER = "/opt/tokenizers"
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNT = ("assistant",)
SEGMENT = 1 << 18  # code points of one rendered string

_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.S)
SPAN = T.StructType().add("first", "integer").add("end", "integer")


def escaped(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def rendered(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], list[str]]:
    """The string, the span of each text in it, and the roles."""
    out, spans, roles, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        roles.append(role)
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans, roles


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered string."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return turns


@lru_cache(maxsize=2)
def tokenizer(folder: str = FOLDER):
    """The byte-level BPE vocabulary with the control strings as tokens after its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    found.add_special_tokens([AddedToken(t, normalized=False, special=True) for t in (START, SEP, END)])
    return found


@lru_cache(maxsize=2)
def pieces(folder: str = FOLDER) -> list[bytes]:
    """The bytes of every id."""
    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    known = tokenizer(folder)
    return [ranks[i] if i in ranks else known.id_to_token(i).encode() for i in range(known.get_vocab_size())]


def masks(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each span of the text, the first token in it and the one after its last; tokens are
    sorted by place (tokens of one character share its place) and none crosses a span's border."""
    if not spans:
        return []
    low, high = np.array(spans, np.int64).T
    first = np.searchsorted(starts, low, "left")
    stop = np.searchsorted(ends, high, "right")
    return [(int(a), int(max(a, b))) for a, b in zip(first, stop)]


SCHEMA = [("text", T.StringType()), ("ids", T.ArrayType(T.IntegerType())), ("turns", T.ArrayType(SPAN)), ("learnt", T.ArrayType(SPAN))]
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _segments(rows: Iterator[tuple], limit: int) -> Iterator[tuple]:
    """``conv_id, turns`` of consecutive rows of one conversation, up to ``limit`` code points."""
    held, turns, size = None, [], 0
    for conv_id, role, text in rows:
        if turns and (conv_id != held or size + len(text) > limit):
            yield held, turns
            turns, size = [], 0
        held = conv_id
        turns.append((role, text))
        size += len(text)
    if turns:
        yield held, turns


def encode(conversations: DataFrame, learnt=LEARNT, folder: str = FOLDER, limit: int = SEGMENT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, part, text, ids, turns, learnt``: the rendered string, its ids, the code points
    of each turn's text, and the token spans (first, end) under the loss mask, one for each turn
    whose role is in ``learnt``.  Rows of a conversation in the order of ``part`` are the whole of it.

    Turns go by their number, nulls first, and where that is shared by role and text.  A null
    role or text is empty.  Rows without an id are one conversation.  A conversation with no
    rows has none; an empty table gives no rows.  Other columns are left behind.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    blank = F.lit("")
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), blank).alias("role"), F.coalesce(F.col(text_col).cast("string"), blank).alias("text"))
    by = ["conv_id", "turn", "role", "text"]
    # The tie cuts many equal rows into ranges too.
    ordered = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*by, "tie").sortWithinPartitions(*by)
    roles = frozenset(learnt)

    def run(batches):
        known = tokenizer(folder)

        def listed():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))

        def out(held):
            made = [rendered(turns) for _, turns in held]
            found = known.encode_batch([m[0] for m in made], add_special_tokens=False)
            ids, marks = [], []
            for e, (_, spans, of) in zip(found, made):
                places = np.array(e.offsets, np.int64).reshape(-1, 2)
                ids.append(e.ids)
                marks.append(masks(places[:, 0], places[:, 1], [s for s, r in zip(spans, of) if r in roles]))
            spans = lambda lists: pa.array([[{"first": a, "end": b} for a, b in row] for row in lists], _SPANS)
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in held], kind), pa.array([m[0] for m in made], pa.string()), pa.array(ids, pa.list_(pa.int32())), spans([m[1] for m in made]), spans(marks)], ["conv_id", *(n for n, _ in SCHEMA)])

        held, size = [], 0
        for segment in _segments(listed(), limit):
            held.append(segment)
            size += sum(len(t) for _, t in segment[1])
            if size > limit:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    schema = T.StructType([rows.schema["conv_id"]] + [T.StructField(n, t) for n, t in SCHEMA])
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema).withColumn("part", F.monotonically_increasing_id()).select("conv_id", "part", *(n for n, _ in SCHEMA))


# ------------------------------------------------------------------ reading back

def decoded(ids: Iterable[int], table: list[bytes]) -> str:
    return b"".join([table[i] for i in ids]).decode()


def read_back(encoded: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``conv_id, part, n_chars, turns, learnt``, from the ids and masks alone: the rendered
    string's length, the turns (role, text) and the texts under the loss mask, unescaped."""
    turn = T.StructType().add("role", "string").add("text", "string")
    schema = T.StructType([encoded.schema["conv_id"]]).add("part", "long").add("n_chars", "long").add("turns", T.ArrayType(turn)).add("learnt", T.ArrayType(T.StringType()))

    def run(batches):
        table = pieces(folder)
        for batch in batches:
            n_chars, turns, texts = [], [], []
            for ids, spans in zip(batch.column("ids").to_pylist(), batch.column("learnt").to_pylist()):
                whole = decoded(ids, table)
                n_chars.append(len(whole))
                turns.append([{"role": r, "text": t} for r, t in parsed(whole)])
                texts.append([unescaped(decoded(ids[s["first"] : s["end"]], table)) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(n_chars, pa.int64()), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(texts, pa.list_(pa.string()))], schema.names)

    return encoded.select("conv_id", "part", "ids", "learnt").mapInArrow(run, schema)


def digests(read: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of whole
    conversations.  A conversation's parts pass one task in order, a part at a time: the
    hashes go on from part to part, so nothing is joined to one string."""
    schema = T.StructType([read.schema["conv_id"]]).add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")

    def run(batches):
        held, state = None, None

        def ended():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (held, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])))], schema=to_arrow_schema(schema))

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != held:
                    if state is not None:
                        done.append(ended())
                    held, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += len(row["turns"])
                state[1].update("".join(f"{t['role']}\n{t['text']}\n" for t in row["turns"]).encode())
                state[2] += sum(map(len, row["learnt"]))
                state[3].update("".join(row["learnt"]).encode())
                state[4] += row["n_chars"]
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if state is not None:
            yield ended()

    from pyspark.sql.pandas.types import to_arrow_schema

    return read.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
