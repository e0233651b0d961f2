"""Personal data, and the terms that give it away.

Four kinds of protected entities are found by their patterns.  Terms near an
entity are then judged by what they reveal of it over the whole corpus: with N
different texts, n(t) that hold term t, n(e) that hold entity e and n(t, e) that
hold t beside e, the information that t gives about e is

    PMI(t; e) = log2(N * n(t, e) / (n(t) * n(e)))      and      IC(e) = log2(N / n(e))

is all there is to know.  A term whose share PMI / IC reaches GENERALISE is
replaced by its kind, one that reaches REMOVE (it occurs nearly nowhere else) is
removed.  A share counts only from SUPPORT different surroundings on, so one
document and its copies reveal nothing by having rare words beside an address.
Most entities have fewer, so terms are also judged by what entities share: the
domain of an address and the entity's kind.

Frequencies are counted for terms seen near entities only.  A share of at least
GENERALISE means n(t) <= n(t, e) * (N / n(e))^(1 - GENERALISE), so a term is out for
good once a lower bound of n(t) is above that for all its entities: first the texts
that hold it near any entity, then the count over every PART-th text.  Both leave the
common words out before all texts are counted.  A bitmap of fixed size picks the terms
out of the texts, another one the texts that may be repeated (full ones only count more).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bitmap, chunks, documents, find_words, hash_words, in_bitmap, map_text, rows_of, signed, slot_of, small_batches, stored

KINDS = ("email", "ip", "card", "phone")
AROUND = 8  # terms on each side of an entity
LEAST_LETTERS = 4
GENERALISE, REMOVE, SUPPORT = 0.8, 0.95, 3
BITS = 24
PART = 8

# Terms are runs of letters: A-Z, a-z and every non-ASCII byte.
_NO_LETTER = np.zeros(256, bool)
_NO_LETTER[:128] = [not chr(c).isalpha() for c in range(128)]

# Fixed patterns of the contract; an address is found from its "@" on.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from inside a run of digits needs what one from its head needs: only heads are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{%d,}" % LEAST_LETTERS)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: the run of local characters before each "@" and the domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """``start, kind, end, value`` of the protected entities, in order."""
    out = [(a, 0, b, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 10 <= len(digits) <= 15:
                out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def _ascii_lower(term: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def beside(text: str, found: list[tuple[int, int, int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``which entity, its surroundings, term, start, end`` of the AROUND terms on either side of each
    entity, without those inside another one; the terms are numbers in the list that comes last."""
    places = np.array([m.span() for m in _TERM.finditer(text)], np.int64).reshape(-1, 2)
    start, end = places[:, 0], places[:, 1]
    low, high = np.array([f[0] for f in found]), np.array([f[2] for f in found])
    # The terms before and after an entity by bisection, as those are in order.
    span = np.arange(AROUND)
    left = np.searchsorted(end, low, "right")[:, None] - AROUND + span
    right = np.searchsorted(start, high, "left")[:, None] + span
    index = np.concatenate([left, right], 1)
    there = (index >= 0) & (index < len(start))
    # A term is inside an entity if the entities that begin before its end reach beyond its start.
    reach = np.append(0, np.maximum.accumulate(high))
    inside = reach[np.searchsorted(low, end, "left")] > start
    index = np.where(there, index, 0)
    there &= ~inside[index] if len(inside) else False
    of, at = np.nonzero(there)
    term = index[of, at]
    used, term = np.unique(term, return_inverse=True)
    names = [_ascii_lower(text[a:b]) for a, b in places[used].tolist()]
    ends = np.searchsorted(of, np.arange(len(found) + 1)).tolist()
    numbers = term.tolist()
    around = [xxhash.xxh3_64_intdigest("\x00".join([names[t] for t in numbers[a:b]]).encode()) >> 1 for a, b in zip(ends, ends[1:])]
    return of, np.array(around, np.int64)[of], term, start[used][term], end[used][term], names


def named(found: list[tuple[int, int, int, str]]) -> np.ndarray:
    """Hashes of each entity, of what it shares (an address: its domain) and of its kind."""
    rows = []
    for _, kind, _, value in found:
        shared = value[value.index("@") :] if kind == 0 else value
        rows.append([xxhash.xxh3_64_intdigest(f"{kind}:{v}".encode()) >> 1 for v in (value, shared, "")])
    return np.array(rows, np.int64)


SPAN = "struct<start:int,kind:string,end:int,action:string>"
NEAR = "struct<entity:long,shared:long,sort:long,around:long,term:long,start:int,end:int>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans, near`` of the rows that hold an entity, and their ids alone of the others."""

    def run(batch, first, end, raw, at):
        spans, terms, columns, sizes = [], [], [[] for _ in range(7)], [0]
        for text in rows_of(batch, first, end, "text")[0].to_pylist():
            found = entities(text)
            spans.append([{"start": a, "kind": KINDS[k], "end": b, "action": "replace"} for a, k, b, _ in found])
            n = 0
            if found:
                of, around, term, start, stop, names = beside(text, found)
                n = len(of)
                for c, values in zip(columns, (*named(found)[of].T, around, term + len(terms), start, stop)):
                    c.append(values)
                terms += names
            sizes.append(sizes[-1] + n)
        values = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        values[4] = _term_hashes(terms)[values[4]] if terms else values[4]
        near = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, _NEAR.value_type)], [f.name for f in _NEAR.value_type])
        return pa.RecordBatch.from_arrays([*rows_of(batch, first, end, "doc_id", "text_key"), pa.array(spans, _SPANS), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), near)], ["doc_id", "text_key", "spans", "near"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, run, f"doc_id {kind}, text_key long, spans array<{SPAN}>, near array<{NEAR}>")


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("action", pa.string())]))
_NEAR = pa.list_(pa.struct([("entity", pa.int64()), ("shared", pa.int64()), ("sort", pa.int64()), ("around", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _term_hashes(terms: list[str]) -> np.ndarray:
    raw = [t.encode() for t in terms]
    stop = np.cumsum([len(r) for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    return signed(hash_words(np.frombuffer(b"".join(raw), np.uint8), np.append(0, stop[:-1]) if raw else stop, stop))


def _slots(values: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the slots of a column of hashes."""

    def slot(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(signed(slot_of(batch.column(0).to_numpy().view(np.uint64), bits)))], ["slot"])

    return bitmap(values.mapInArrow(slot, "slot long"), F.col("slot"), bits)


def text_frequency(docs: DataFrame, terms: DataFrame, texts: DataFrame, bits: int) -> DataFrame:
    """``term, n``: different texts that hold each of ``terms`` (and of others of their
    slots).  ``texts``: text_key, rows and the hash of one row of every text.  Texts are
    counted where they are; of one that may be repeated that row alone is, by its key."""
    context = docs.sparkSession.sparkContext
    held = context.broadcast(_slots(terms, bits))
    again = context.broadcast(_slots(texts.where("rows > 1").select("text_key"), bits))

    def maybe_repeated(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(in_bitmap(again.value, slot_of(batch.column(0).to_numpy().view(np.uint64), bits))))], ["row"])

    chosen = context.broadcast(_slots(texts.select("text_key", "row").mapInArrow(maybe_repeated, "row long"), bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, size = [], 0  # of texts that occur once: summed over the whole task
        for batch in batches:
            for first, end, raw, at in chunks(batch.column(batch.schema.get_field_index("text"))):
                low = LOWER[raw]
                start, stop, word_at = find_words(low, at, _NO_LETTER)
                h = hash_words(low, start, stop)
                hit = np.flatnonzero(in_bitmap(held.value, slot_of(h, bits)))
                doc = np.searchsorted(word_at, hit, "right") - 1
                pair = np.unique(np.stack([signed(h[hit]), doc], 1), axis=0) if len(hit) else np.zeros((0, 2), np.int64)
                key, row = (c.to_numpy() for c in rows_of(batch, first, end, "text_key", "row"))
                maybe = in_bitmap(again.value, slot_of(key.view(np.uint64), bits))
                sums.append(np.stack(np.unique(pair[~maybe[pair[:, 1]], 0], return_counts=True), 1))
                size += len(sums[-1])
                if size > SUMMED:
                    sums = [_added(sums)]
                    if len(sums[0]) > SUMMED // 2:
                        yield _counts(sums.pop())
                    size = sum(map(len, sums))
                pair = pair[(maybe & in_bitmap(chosen.value, slot_of(row.view(np.uint64), bits)))[pair[:, 1]]]
                if len(pair):
                    yield _counts(np.stack([pair[:, 0], np.ones(len(pair), np.int64)], 1), key[pair[:, 1]])
        if sums:
            yield _counts(_added(sums))

    small_batches(docs.sparkSession)
    counted = docs.select("text", "text_key", F.xxhash64("doc_id", "text_key").alias("row")).mapInArrow(count, "term long, text_key long, n long").groupBy("term", "text_key").agg(F.sum("n").alias("n"))
    return counted.groupBy("term").agg(F.sum(F.when(F.col("text_key").isNull(), F.col("n")).otherwise(1)).alias("n"))


SUMMED = 1 << 20  # terms of a task's sums: 16 MB


def _added(sums: list[np.ndarray]) -> np.ndarray:
    term, at = np.unique(np.concatenate([s[:, 0] for s in sums]), return_inverse=True)
    return np.stack([term, np.bincount(at, np.concatenate([s[:, 1] for s in sums]), len(term)).astype(np.int64)], 1)


def _counts(sums: np.ndarray, keys: np.ndarray | None = None) -> pa.RecordBatch:
    keys = pa.nulls(len(sums), pa.int64()) if keys is None else pa.array(keys)
    return pa.RecordBatch.from_arrays([pa.array(sums[:, 0]), keys, pa.array(sums[:, 1])], ["term", "text_key", "n"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """``doc_id, text_key, spans`` of every row: spans of entities and of the terms
    that disclose one (start, kind, end in code points, action), in order.

    Null and empty texts have none.  Repeated rows have the same spans and, as
    equal texts and equal surroundings count once, add nothing to what a term reveals.
    """
    whole = documents(docs, id_col, text_col)
    found = stored(scan(whole))
    near = found.select("doc_id", "text_key", F.explode("near").alias("x")).select("doc_id", "text_key", "x.*")
    near = near.withColumn("entity", F.explode(F.array_distinct(F.array("entity", "shared", "sort")))).drop("shared", "sort")
    entity = near.select("entity", "text_key").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    # Sets of texts and of surroundings, each counted after its own distinct.
    around = near.select("term", "entity", "around").distinct().groupBy("term", "entity").agg(F.count("*").alias("n_around")).where(F.col("n_around") >= support)
    held = near.select("term", "entity", "text_key").distinct().groupBy("term", "entity").agg(F.count("*").alias("n_te"))
    copies = stored(found.groupBy("text_key").agg(F.count("*").alias("rows"), F.min(F.xxhash64("doc_id", "text_key")).alias("row")))
    n = copies.count()
    # At most so many texts may hold a term that reaches the threshold (rounded up).
    most = F.col("n_te") * F.pow(F.lit(float(n)) / F.col("n_e"), F.lit(1 - generalise)) * (1 + 1e-9)
    seen = near.select("term", "text_key").distinct().groupBy("term").agg(F.count("*").alias("least"))
    both = held.join(around, ["term", "entity"]).join(entity, "entity").where(F.col("n_e") < n).withColumn("most", most)
    both = stored(both.join(seen, "term").where("least <= most").drop("least"))
    part = text_frequency(whole.where(F.pmod("text_key", F.lit(PART)) == 0), both.select("term").distinct(), copies, bits)
    both = stored(both.join(part.select("term", F.col("n").alias("least")), "term", "left").where("least is null or least <= most").drop("least"))
    frequency = text_frequency(whole, both.select("term").distinct(), copies, bits)
    share = F.log2(F.lit(float(n)) * F.col("n_te") / (F.col("n") * F.col("n_e"))) / F.log2(F.lit(float(n)) / F.col("n_e"))
    disclosing = both.join(frequency, "term").withColumn("share", share).where(F.col("share") >= generalise)
    disclosing = disclosing.select("term", "entity", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))
    term_span = F.struct("start", F.lit("term").alias("kind"), "end", "action")
    told = near.join(disclosing, ["term", "entity"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max("action").alias("action"))  # remove, if any entity asks for it
    told = told.groupBy(F.col("doc_id").alias("told_id"), F.col("text_key").alias("told_key")).agg(F.collect_list(term_span).alias("terms"))
    rows = found.join(told, F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("text_key") == F.col("told_key")), "left")
    order = [*KINDS, "term"]
    key = F.transform(F.concat("spans", F.coalesce("terms", F.array().cast(f"array<{SPAN}>"))), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, order)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["action"].alias("action")))
    return rows.select("doc_id", "text_key", F.transform(F.array_sort(key), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["action"].alias("action"))).alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def sanitised(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: entities and generalised terms replaced by their kind in brackets, removed terms cut out."""
    whole = documents(docs, id_col, text_col)
    spans = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "spans").dropDuplicates(["found_id", "found_key"])
    rows = whole.join(spans, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
    # Right to left, so that earlier offsets hold; a span inside one already replaced stays as that one is.
    cut = F.aggregate(
        F.reverse("spans"),
        F.struct(F.col("text").alias("t"), F.length("text").alias("free")),
        lambda acc, s: F.when(s["end"] <= acc["free"], F.struct(F.concat(F.substring(acc["t"], F.lit(1), s["start"]), F.when(s["action"] == "remove", F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))), F.substring(acc["t"], s["end"] + 1, F.length(acc["t"]))).alias("t"), s["start"].alias("free"))).otherwise(acc),
        lambda acc: acc["t"],
    )
    return rows.select("doc_id", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias("text"))
