"""Code length per byte by context-tree weighting.

Each byte is eight binary decisions.  A node of the context tree is the last
``d`` bytes (d = 0 to ORDER) and the decisions already made on the current byte;
it counts the zeros and ones that followed.  With P_e the Krichevsky-Trofimov
probability of a node's counts, its weighted probability is

    P_w = P_e                             at depth ORDER
    P_w = (P_e + product of P_w of the longer contexts) / 2      above

and the chance of the next decision mixes the KT estimates of all depths with
the weights that follow from these.  The tree is learned from training texts
and then left as it is, so a text's score does not depend on its neighbours.

What is counted is every (ORDER + 1)-gram of bytes of all documents, with how
often it occurs in training texts: shorter contexts are sums of these, and grams
of other texts only (count 0) are the further questions the tree must answer.
So the table of log-probabilities covers every gram that any text holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, documents, find_words, hash_words, list_array, map_text, rows_of, signed, stored

ORDER = 4  # up to 6: a gram and a decision then still fit 64 bits
TOP = 2  # contexts of so many bytes are groups of their own
# A table of at most so many rows is sent to the tasks; a larger one is joined by shuffle.
SENT_ROWS = 1 << 21
# Words counted at least N / FREQUENT times: there are FREQUENT of them at most.
FREQUENT = 1 << 19


def grams(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every byte the gram of it and the ORDER bytes before; a text starts after line ends."""
    out = raw.astype(np.uint64)
    for back in range(1, ORDER + 1):
        before = np.full(len(raw), 10, np.uint8)
        before[back:] = raw[:-back]
        for k in range(back):
            edge = at[:-1] + k
            before[edge[edge < at[1:]]] = 10
        out |= before.astype(np.uint64) << np.uint64(8 * back)
    return out


# ------------------------------------------------------------------------ counts

WORD, GRAM, ALL = 0, 1, 2


def counts(docs: DataFrame) -> DataFrame:
    """``kind, key, n`` over ``docs`` (doc_id, text, held_out): training words by hash,
    grams by how often they occur in training texts, and, as kind ALL, training
    tokens (key 0) and their texts (key 1)."""

    def run(batch, first, end, raw, at):
        trained = ~rows_of(batch, first, end, "held_out")[0].to_numpy(zero_copy_only=False)
        of_byte = np.repeat(trained, np.diff(at))
        g = grams(raw, at)
        seen, n = np.unique(g[of_byte], return_counts=True)
        other = np.unique(g[~of_byte])
        low = LOWER[raw]
        start, stop, word_at = find_words(low, at)
        h = hash_words(low, start, stop)[np.repeat(trained, np.diff(word_at))]
        word, times = np.unique(signed(h), return_counts=True)
        texts = int(trained.sum())
        kind = np.repeat(np.array([WORD, GRAM, GRAM, ALL], np.int8), [len(word), len(seen), len(other), 2])
        key = np.concatenate([word, seen.astype(np.int64), other.astype(np.int64), [0, 1]])
        n = np.concatenate([times, n, np.zeros(len(other), np.int64), [len(h) + texts, texts]])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(n)], ["kind", "key", "n"])

    found = map_text(docs.select("doc_id", "text", "held_out"), run, "kind byte, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ context tree

def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """ln(Gamma(n + 1/2) / Gamma(1/2)) for whole n."""
    small = np.cumsum(np.append(0.0, np.log(np.arange(64) + 0.5)))
    x = np.maximum(n, 1).astype(float) + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 0.5 * np.log(np.pi)
    return np.where(n < 64, small[np.minimum(n, 63)], series)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.cumsum(np.append(0.0, np.log(np.arange(1, 64))))
    x = np.maximum(n, 1).astype(float) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 64, small[np.minimum(n, 63)], series)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of the counts."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_factorial(zeros + ones)


def decisions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each gram the eight prefixes (1 to 255) of its last byte, and the decisions there."""
    byte = (gram & 255).astype(np.int64)[:, None]
    shift = np.arange(8)
    return (1 << shift) | (byte >> (8 - shift)), (byte >> (7 - shift)) & 1


def subtree(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, dict]:
    """Below one context of TOP bytes: for each gram the chance of each of its eight
    decisions by the nodes of depth TOP to ORDER, and the nodes of depth TOP."""
    prefix, bit = decisions(gram)
    weight = np.repeat(n[:, None], 8, 1)
    below = chance = None
    for depth in range(ORDER, TOP - 1, -1):
        context = (gram.astype(np.int64) >> 8) & ((1 << (8 * depth)) - 1)
        node = ((context[:, None] << 8) | prefix).ravel()
        ids, at = np.unique(node, return_inverse=True)
        one = np.bincount(at, (weight * bit).ravel(), len(ids)).astype(np.int64)
        zero = np.bincount(at, (weight * (1 - bit)).ravel(), len(ids)).astype(np.int64)
        own = log_kt(zero, one)
        estimate = np.where(bit.ravel() == 1, one[at] + 0.5, zero[at] + 0.5) / (zero[at] + one[at] + 1)
        if below is None:
            weighted, chance = own, estimate
        else:
            last, of_last = below
            parent = np.empty(len(last), np.int64)
            parent[of_last] = at
            share, weighted = _mixed(own, np.bincount(parent, last, len(ids)))
            chance = share[at] * estimate + (1 - share[at]) * chance
        below = (weighted, at)
    return chance.reshape(-1, 8), {"before": ids >> 8, "prefix": ids & 255, "zeros": zero, "ones": one, "weighted": weighted}


def _mixed(own: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of a node's own estimate, and its weighted probability (ln)."""
    both = np.logaddexp(own, product)
    return np.exp(own - both), both - np.log(2)


class Top:
    """The nodes of depth 0 and 1, at most 256 * 255, as tables by context and prefix."""

    def __init__(self, nodes: pa.Table):
        self.zero, self.one, product = (np.zeros((2, 256, 256)) for _ in range(3))
        at = (1, nodes["context"].to_numpy(), nodes["prefix"].to_numpy())
        self.zero[at], self.one[at], product[at] = (nodes[c].to_numpy() for c in ("zeros", "ones", "product"))
        self.share = np.zeros((2, 256, 256))
        own = log_kt(self.zero[1].astype(np.int64), self.one[1].astype(np.int64))
        self.share[1], weighted = _mixed(own, product[1])
        here = np.zeros((256, 256), bool)
        here[at[1:]] = True
        self.zero[0, 0], self.one[0, 0] = self.zero[1].sum(0), self.one[1].sum(0)
        own = log_kt(self.zero[0, 0].astype(np.int64), self.one[0, 0].astype(np.int64))
        self.share[0, 0], _ = _mixed(own, np.where(here, weighted, 0).sum(0))

    def mix(self, gram: np.ndarray, chance: np.ndarray) -> np.ndarray:
        prefix, bit = decisions(gram)
        for depth, context in ((1, (gram >> 8 & 255)[:, None]), (0, 0)):
            zero, one, share = (t[depth, context, prefix] for t in (self.zero, self.one, self.share))
            chance = share * (np.where(bit == 1, one, zero) + 0.5) / (zero + one + 1) + (1 - share) * chance
        return chance


def log_probabilities(table: DataFrame) -> DataFrame:
    """``gram, log10`` from ``gram, n``.  The grams after one context of TOP bytes are a
    group; the shorter contexts need sums over groups only, and are few."""

    def run(rows: pa.Table) -> pa.Table:
        chance, nodes = subtree(rows["gram"].to_numpy(), rows["n"].to_numpy())
        n, m = len(chance), len(nodes["prefix"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(np.arange(n + 1) * 8, np.full(m, 8 * n)).astype(np.int32)), pa.array(chance.ravel()))
        column = {"gram": pa.concat_arrays([rows["gram"].combine_chunks(), pa.nulls(m, pa.int64())]), "chances": lists}
        column |= {c: pa.concat_arrays([pa.nulls(n, pa.array(nodes[c]).type), pa.array(nodes[c])]) for c in ("before", "prefix", "zeros", "ones", "weighted")}
        return pa.table(column)

    grouped = table.select("gram", "n").groupBy(F.expr(f"(gram >> 8) & {(1 << 8 * TOP) - 1}").alias("group"))
    parts = stored(grouped.applyInArrow(run, "gram long, chances array<double>, before long, prefix long, zeros long, ones long, weighted double"))
    nodes = parts.where("prefix is not null").groupBy(F.expr("before & 255").alias("context"), "prefix").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("product"))
    top = Top(nodes.toArrow())

    def finish(batches):
        for batch in batches:
            gram = batch.column(0).to_numpy()
            chance = top.mix(gram, batch.column(1).flatten().to_numpy().reshape(-1, 8))
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.log10(chance).sum(1))], ["gram", "log10"])

    return parts.where("gram is not null").select("gram", "chances").mapInArrow(finish, "gram long, log10 double")


# ---------------------------------------------------------------------- look-ups

class Lookup:
    """Open addressing over 64-bit keys, probed for whole arrays at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.key, self.value, self.used = np.zeros(size, np.uint64), np.zeros(size, values.dtype), np.zeros(size, bool)
        keys, slot = keys.astype(np.uint64), self._slot(keys.astype(np.uint64))
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[~self.used[slot[todo]]]
            self.key[slot[free]] = keys[free]  # the last of those that want a slot gets it
            won = free[self.key[slot[free]] == keys[free]]
            self.used[slot[won]], self.value[slot[won]] = True, values[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            todo = todo[lost[todo]]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 if absent), and which are present."""
        keys = keys.astype(np.uint64)
        slot = self._slot(keys)
        out, found = np.zeros(len(keys), self.value.dtype), np.zeros(len(keys), bool)
        hit = self.used[slot] & (self.key[slot] == keys)
        out[hit], found[hit] = self.value[slot[hit]], True
        todo = np.flatnonzero(~hit & self.used[slot])
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.key) - 1)
            s = slot[todo]
            hit = self.used[s] & (self.key[s] == keys[todo])
            out[todo[hit]], found[todo[hit]] = self.value[s[hit]], True
            todo = todo[~hit & self.used[s]]
        return out, found


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[at[1:]] - total[at[:-1]]


# ----------------------------------------------------------------------- scoring

def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", sent_rows: int = SENT_ROWS, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from the rows for which ``held_out`` (a condition on ``doc_id``) is
    false.  score: log10 probability of the whole text; bits per byte are
    -score / log10(2) / n_bytes.  base_score: add-one unigram model of lower-cased
    words and an end token.  Null and empty texts have the end token only and a
    score of 0.  Repeated rows count as often as they occur.  Without training
    rows every decision has chance 1/2.

    The table of grams is sent to the tasks up to ``sent_rows`` rows, else joined;
    the words that a share of 1 / ``frequent`` of all training tokens are, which
    are ``frequent`` words at most, are sent, all others joined by hash.
    """
    sc = docs.sparkSession.sparkContext
    whole = documents(docs, id_col, text_col).withColumn("held_out", held_out)
    table = stored(counts(whole))
    totals = {r.key: r.n for r in table.where(f"kind = {ALL}").collect()}  # two rows
    tokens, ends = totals.get(0, 0), totals.get(1, 0)
    words = table.where(f"kind = {WORD}").select("key", "n")
    vocabulary = words.count() + (1 if ends else 0)
    log_p = stored(log_probabilities(table.where(f"kind = {GRAM}").select(F.col("key").alias("gram"), "n")))
    sent = log_p.count() <= sent_rows
    least = max(1, -(-tokens // frequent))
    common = words.where(F.col("n") >= least).toArrow()
    of_word = sc.broadcast(Lookup(common["key"].to_numpy().view(np.uint64), common["n"].to_numpy()))
    if sent:
        model = log_p.toArrow()
        of_gram = sc.broadcast(Lookup(model["gram"].to_numpy(), model["log10"].to_numpy()))

    def run(batch, first, end, raw, at):
        low = LOWER[raw]
        start, stop, word_at = find_words(low, at)
        h = hash_words(low, start, stop)
        n, known = of_word.value(h)
        rare = ~known
        rare_at = np.append(0, np.cumsum(rare))[word_at]
        g = grams(raw, at)
        if sent:
            logs = _sums(of_gram.value(g)[0], at)
            own = [pa.nulls(end - first, pa.list_(pa.int64()))]
        else:
            logs = np.zeros(end - first)
            own = [list_array(at, pa.array(g.astype(np.int64)))]
        return pa.RecordBatch.from_arrays(
            [*rows_of(batch, first, end, "doc_id", "text_key", "held_out"), pa.array(np.diff(at)), pa.array(np.diff(word_at) + 1), pa.array(_sums(known.astype(np.int64), word_at)), pa.array(_sums(np.log10(n + 1.0), word_at)), pa.array(logs), list_array(rare_at, pa.array(signed(h[rare]))), *own],
            ["doc_id", "text_key", "held_out", "n_bytes", "n_tokens", "known", "base", "score", "rare", "grams"],
        )

    kind = whole.schema["doc_id"].dataType.simpleString()
    rows = map_text(whole, run, f"doc_id {kind}, text_key long, held_out boolean, n_bytes long, n_tokens long, known long, base double, score double, rare array<long>, grams array<long>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    rare = rows.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    rare = rare.join(words.where(F.col("n") < least), "key").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    out = rows.drop("rare", "grams", "text_key").join(rare, "row", "left")
    if not sent:
        parts = rows.select("row", F.explode("grams").alias("gram")).groupBy("row", "gram").agg(F.count("*").alias("times"))
        parts = parts.join(log_p, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log10")).alias("joined"))
        out = out.join(parts, "row", "left").withColumn("score", F.coalesce("joined", "score"))
    end_log = float(np.log10(ends + 1.0))
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(tokens + vocabulary + 1)))
    n_known = F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if ends else 0)
    return out.select("doc_id", "held_out", "n_bytes", "n_tokens", n_known.cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
