"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct five-word shingles (as 64-bit hashes).  Each of
REGISTERS hash functions keeps its minimum over the set in 16 bits: the number
of leading zeros and the MANTISSA bits after the first one.  Groups of ROWS
registers are banded; documents of one band bucket are candidates.  First each
is compared with one pivot: their Jaccard similarity is estimated from equal
registers, corrected for the collisions that the short registers are expected to
have, and pairs that may reach the threshold are confirmed on their full sets.

Equal sets are one class from the start.  A shingle that no other candidate has
cannot be shared: a class with too many of them links with nothing and goes, and
the others' bound the similarity of a pair.  A bucket's pivot is the class with
the fewest lone shingles.  Confirmed links are contracted to components, and only
classes of one bucket that are in different components are then compared with
each other, on their full sets and in blocks; of the links found there, those
that join components leave the task.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bitmap, documents, find_words, gram_hashes, hash_words, in_bitmap, map_text, mix, rows_of, signed, stored

SHINGLE, PERCENT = 5, 85
REGISTERS, MANTISSA, ROWS, BANDS = 128, 10, 6, 48
MARGIN = 6.0  # standard deviations that an estimate may fall short by
BITS = 26
BLOCK = 512  # classes of a bucket that one task compares with as many others

_random = np.random.default_rng(9)
_SEED = _random.integers(1, 1 << 63, REGISTERS, np.uint64)
_ODD = _random.integers(1, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.array([np.sort(_random.choice(REGISTERS, ROWS, replace=False)) for _ in range(BANDS)])


# --------------------------------------------------------------------- sketches

def shingle_sets(raw: np.ndarray, at: np.ndarray, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words: the whole sequence as one."""
    raw = LOWER[raw]
    start, end, word_at = find_words(raw, at)
    h = hash_words(raw, start, end)
    grams = gram_hashes(h, shingle)
    out = []
    for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist()):
        if b - a >= shingle:
            s = np.sort(grams[a : b - shingle + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        else:
            out.append(gram_hashes(h[a:b], b - a, seed=b - a) if b > a else h[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of compressed registers for each (non-empty) set."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *(len(s) for s in sets[:-1])])
    low = np.empty((len(sets), REGISTERS), np.uint64)
    for j in range(REGISTERS):
        low[:, j] = np.minimum.reduceat((flat ^ _SEED[j]) * _ODD[j], begin)
    zeros = np.zeros(low.shape, np.uint16)
    for step in (32, 16, 8, 4, 2, 1):
        small = low < np.uint64(1 << (64 - step))
        low = np.where(small, low << np.uint64(step), low)
        zeros += np.where(small, step, 0).astype(np.uint16)
    mantissa = (low << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return (zeros << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, class, registers`` of every row; class: digest of the set (null: empty)."""

    def run(batch, first, end, raw, at):
        sets = shingle_sets(raw, at)
        some = [i for i, s in enumerate(sets) if len(s)]
        regs: list[bytes | None] = [None] * len(sets)
        digest: list[bytes | None] = [None] * len(sets)
        if some:
            for i, r in zip(some, registers([sets[i] for i in some])):
                regs[i], digest[i] = r.tobytes(), blake2b(sets[i].tobytes(), digest_size=16).digest()
        return pa.RecordBatch.from_arrays([*rows_of(batch, first, end, "doc_id", "text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "text_key", "n_shingles", "class", "registers"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, run, f"doc_id {kind}, text_key long, n_shingles long, class binary, registers binary")


# ------------------------------------------------------------------------ bands

def band_keys(regs: np.ndarray) -> np.ndarray:
    return np.stack([gram_hashes_of_rows(regs[:, cols], band) for band, cols in enumerate(_BAND)], 1)


def gram_hashes_of_rows(values: np.ndarray, band: int) -> np.ndarray:
    out = np.full(len(values), band, np.uint64)
    for j in range(values.shape[1]):
        out = mix(out * np.uint64(31) + values[:, j].astype(np.uint64) + np.uint64(1))
    return out


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """``bucket, class, n``: the BANDS buckets of each class."""

    def emit(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_registers(batch.column(0)))
                take = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys.ravel())), batch.column(1).take(take), batch.column(2).take(take)], ["bucket", "class", "n"])

    return classes.select("registers", "class", "n").mapInArrow(emit, "bucket long, class binary, n long")


# ------------------------------------------------------- estimates and full sets

def collisions(n, m):
    """Expected share of equal registers of disjoint sets of n and m elements (one bucket,
    MANTISSA bits; the approximation of the HyperMinHash paper)."""
    n, m = np.maximum(n, m).astype(float), np.minimum(n, m).astype(float)
    return 0.169919487159739093975315012348 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2


def may_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    chance = collisions(n, m)
    jaccard = ((a == b).mean(1) - chance) / (1 - chance)
    p = percent / 100
    return jaccard >= p - MARGIN * np.sqrt(p * (1 - p) / REGISTERS)


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose estimate may reach the threshold, with it."""
    left = classes.select(F.col("class").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    right = classes.select(F.col("class").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = _registers(batch.column(2)), _registers(batch.column(3))
                keep = pa.array(may_link(a, b, batch.column(4).to_numpy(), batch.column(5).to_numpy(), percent))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array((a == b).sum(1).astype(np.int32)).filter(keep)], ["a", "b", "equal"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a binary, b binary, equal int")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """``class, shingles`` of the ``wanted`` classes, read again from one document of each
    (a bitmap of text hashes lets the others pass; a full one sends more)."""
    sc = docs.sparkSession.sparkContext
    wanted = stored(classes.join(wanted, "class").select("class", F.col("one.doc_id").alias("doc_id"), F.col("one.text_key").alias("text_key")))
    held = sc.broadcast(bitmap(wanted, F.expr(f"shiftrightunsigned(text_key, {64 - bits})"), bits))

    def run(batch, first, end, raw, at):
        ids, keys = rows_of(batch, first, end, "doc_id", "text_key")
        rows = np.flatnonzero(in_bitmap(held.value, keys.to_numpy().view(np.uint64) >> np.uint64(64 - bits)))
        if not len(rows):
            return None
        texts = [raw[at[i] : at[i + 1]] for i in rows]
        sets = shingle_sets(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
        digest = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), keys.take(pa.array(rows)), pa.array(digest, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "text_key", "class", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = map_text(docs, run, f"doc_id {kind}, text_key long, class binary, shingles binary").alias("r")
    w = wanted.alias("w")
    same = (F.col("r.class") == F.col("w.class")) & F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.text_key") == F.col("w.text_key"))
    return read.join(w, same, "left_semi").select("class", "shingles").dropDuplicates(["class"])


def alone(sets: DataFrame) -> DataFrame:
    """``class, u``: how many shingles of a class no other of ``sets`` has (0 where two
    classes begin with the same seven bytes, by which they are told apart here)."""

    def emit(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                shingles = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                tag = np.repeat(part.column(0).to_numpy(), [len(x) for x in shingles])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles)), pa.array(tag)], ["shingle", "tag"])

    tag = F.conv(F.hex(F.substring("class", 1, 7)), 16, 10).cast("long")
    tagged = sets.select(tag.alias("tag"), "class", "shingles")
    once = tagged.select("tag", "shingles").mapInArrow(emit, "shingle long, tag long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("tag").alias("tag")).where("n = 1")
    owners = tagged.groupBy("tag").agg(F.min("class").alias("class"), F.count("*").alias("n")).where("n = 1")
    return once.groupBy("tag").agg(F.count("*").alias("u")).join(owners, "tag").select("class", "u")


def can_link(percent: int) -> str:
    """Whether the sizes (na, nb) and lone shingles (ua, ub) of two sets allow the threshold."""
    shared = "least(na - ua, nb - ub)"
    return f"100 * {shared} >= {percent} * (na + nb - {shared})"


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def links_in_buckets(rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links ``a, b`` between classes of a bucket with different labels, by their full sets.

    ``rows``: ``bucket, class, label, size``.  A bucket of more than ``block``
    classes is dealt into blocks, and each pair of blocks is compared in a task
    of its own.  Of the links found there, only those that join two labels not
    yet joined are returned.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    parts = rows.withColumn("own", F.pmod(F.xxhash64("class"), blocks.cast("long")).cast("int"))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    parts = parts.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    parts = parts.join(sets, "class").select("bucket", "i", "j", "class", "label", "shingles")

    def compare(group: pa.Table):
        labels = group["label"].to_pylist()
        if len(set(labels)) < 2:
            return
        names = group["class"].to_pylist()
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["shingles"].combine_chunks()]
        size = np.array([len(x) for x in found])
        row = np.repeat(np.arange(len(found)), size)
        _, column, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        shared = np.zeros((len(found), len(found)), np.float32)
        place = np.cumsum(times > 1) - 1
        held = times[column] > 1
        row, column = row[held], place[column[held]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            a, b = np.searchsorted(column, [first, first + 2048])
            has = np.zeros((len(found), 2048), np.float32)
            has[row[a:b], column[a:b] - first] = 1
            shared += has @ has.T
        total = size[:, None] + size[None, :] - shared
        x, y = np.nonzero(np.triu(100 * shared >= percent * total, 1))
        top = {label: label for label in labels}

        def root(label):
            while top[label] != label:
                label = top[label]
            return label

        for i, j in zip(x.tolist(), y.tolist()):
            p, q = root(labels[i]), root(labels[j])
            if p != q:
                top[p] = q
                yield names[i], names[j]

    def run(batches):
        """Sorted by group: a group is compared when the next one begins."""
        held, key = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            cuts = [0, *(r for r in range(1, len(keys)) if keys[r] != keys[r - 1]), len(keys)]
            out = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if held and keys[a] != key:
                    out += compare(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                key = keys[a]
            yield _pairs(out)
        if held:
            yield _pairs(list(compare(pa.Table.from_batches(held))))

    dealt = parts.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(run, "a binary, b binary")


def _pairs(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], ["a", "b"])


# ------------------------------------------------------------------- components

def contract(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``class, label`` after merging the labels that ``a, b`` links connect (label: the smallest).

    Each round every label takes its smallest neighbour, and that one's own,
    and links are renamed; the number of labels left with links at least halves."""
    a = links.join(labels.select(F.col("class").alias("a"), F.col("label").alias("x")), "a").join(labels.select(F.col("class").alias("b"), F.col("label").alias("y")), "b")
    edges = stored(_both_ways(a.select("x", "y")))
    while not edges.isEmpty():
        up = stored(edges.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("up")))
        over = up.select(F.col("x").alias("up"), F.col("up").alias("over"))
        up = stored(up.join(over, "up").select("x", "over"))
        labels = stored(labels.join(up.withColumnRenamed("x", "label"), "label", "left").select("class", F.coalesce("over", "label").alias("label")))
        y = up.select(F.col("x").alias("y"), F.col("over").alias("to"))
        edges = stored(_both_ways(edges.join(up, "x").join(y, "y").select(F.col("over").alias("x"), F.col("to").alias("y"))))
    return labels


def _both_ways(edges: DataFrame) -> DataFrame:
    edges = edges.where("x != y")
    return edges.union(edges.select("y", "x")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bits: int = BITS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, representative`` for every row of ``docs``.

    Documents are linked if 100 * |intersection| >= ``percent`` * |union| of
    their shingle sets; component_id is the smallest id reachable.  Null and
    empty texts have no shingles, no links and their own id.  Rows with equal
    sets, repeated rows too, are linked; null ids come after all others, and a
    component of null ids only has none.  The representative of a component is
    one text of its smallest id (all rows that repeat it), and each text without
    shingles represents itself.
    """
    whole = documents(docs, id_col, text_col)
    sketch = stored(sketches(whole))
    one = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = stored(sketch.where("class is not null").groupBy("class").agg(F.min(one).alias("one"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")))
    rows = bands(classes)
    several = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    rows = stored(rows.join(several, "bucket"))
    sets = stored(full_sets(whole, classes, rows.select("class").distinct(), bits))
    rows = rows.join(alone(sets), "class", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    rows = stored(rows.where(f"100 * (n - u) >= {percent} * n"))
    labels = classes.select("class", F.col("class").alias("label"))

    # One pivot for each bucket, the one most of which others have too, and for each class the pivot most like it.
    pivots = rows.groupBy("bucket").agg(F.min(F.struct("u", "class", "n")).alias("p"))
    pairs = rows.select("bucket", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("u").alias("ub")).join(pivots, "bucket")
    pairs = pairs.select("b", "nb", "ub", F.col("p.class").alias("a"), F.col("p.n").alias("na"), F.col("p.u").alias("ua")).where("a != b").where(can_link(percent))
    best = estimated(pairs.select("a", "b").distinct(), classes, percent).groupBy("b").agg(F.max_by("a", F.struct("equal", "a")).alias("a"))
    labels = contract(labels, confirmed(best, sets, percent))

    # Then everything else in a bucket that is not in one component by now.
    named = rows.join(labels, "class")
    mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low != high").select("bucket", "size")
    named = stored(named.join(mixed, "bucket").select("bucket", "class", "label", "size"))
    labels = contract(labels, links_in_buckets(named, sets, percent, BLOCK))

    of_class = classes.join(labels, "class").select("class", "label", "one")
    smallest = of_class.groupBy("label").agg(F.min("one").alias("first"))
    of_class = of_class.join(smallest, "label").select("class", "first")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    linked = sketch.join(of_class, "class").select("doc_id", "text_key", "n_shingles", F.col("first.doc_id").alias("component_id"), first.alias("representative"))
    empty = sketch.where("class is null").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("representative"))
    return linked.unionByName(empty)
