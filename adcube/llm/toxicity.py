"""Toxicity by a naive-Bayes-scaled linear classifier of character n-grams.

A text's features are the distinct runs of GRAMS bytes of its lower-cased text,
hashed to 2^BITS slots.  Each is scaled by its naive Bayes log-count ratio (how
much likelier in a toxic than in another training text), and a logistic
regression with an L2 penalty is fitted to the scaled features.

The classifier is fitted on at most TOXIC and OTHER labelled texts, those whose
ids have the smallest hashes.  Its features are all slots whose presence tells the
classes apart at the level that SIGNIFICANT stands for (likelihood-ratio test), how many
that be.  The fit is Spark's own (gradients are summed over the tasks that hold the
sampled texts); what reaches the driver are the chosen slots and one weight for each.
Every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, documents, list_array, map_text, mix, rows_of, stored

GRAMS, BITS = (5, 6, 7), 20
SIGNIFICANT = 10.83  # chi-squared with one degree of freedom: 1 in 1000 by chance
TOXIC, OTHER = 3_000, 5_000
PENALTY, STEPS, TOLERANCE = 1.0, 150, 1e-6
CHUNK_BYTES = 1 << 18


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # for each slot: coefficient times log-count ratio, 0 if the slot is not a feature
    bias: float


def slots(raw: np.ndarray, at: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``text, slot`` of the distinct features of each text, in order; ``keep``: only those slots."""
    low = LOWER[raw].astype(np.uint64)
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    found = []
    for n in GRAMS:
        if len(low) < n:
            continue
        size = len(low) - n + 1
        value = np.full(size, n, np.uint64)
        for j in range(n):
            value = (value << np.uint64(8)) | low[j : size + j]
        slot = (mix(value) >> np.uint64(64 - BITS)).astype(np.int64)
        whole = doc[:size] == doc[n - 1 :]
        if keep is not None:
            whole &= keep[slot]
        found.append(np.unique((doc[:size][whole] << BITS) | slot[whole]))
    key = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic: int = TOXIC, other: int = OTHER, significant: float = SIGNIFICANT) -> Model:
    """Fit on texts whose ids ``labels`` marks 1 or 0.

    Null labels, ids without a text and null ids are left out; an id with several
    labels is toxic if one of them is 1.  Without texts of both classes the model
    only knows the share of toxic labels (0 without any).
    """
    sc = docs.sparkSession.sparkContext
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = stored(marked)
    sums = marked.agg(F.sum((F.col("label") == 1).cast("long")).alias("one"), F.count("*").alias("all")).first()
    one, zero = sums.one or 0, sums.all - (sums.one or 0)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = marked.where("label = 1").orderBy(*order).limit(toxic).unionByName(marked.where("label != 1").orderBy(*order).limit(other))
    chosen = documents(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")  # toxic + other ids at most
    chosen = stored(chosen.select("doc_id", "label", "text"))

    def count(batch, first, end, raw, at):
        label = rows_of(batch, first, end, "label")[0].to_numpy()
        doc, slot = slots(raw, at)
        key, n = np.unique(slot * 2 + (label[doc] == 1), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key >> 1), pa.array(key & 1), pa.array(n)], ["slot", "label", "n"])

    seen = map_text(chosen.select("label", "text"), count, "slot long, label long, n long", limit=CHUNK_BYTES).groupBy("slot").agg(F.sum(F.expr("n * label")).alias("one"), F.sum(F.expr("n * (1 - label)")).alias("zero"))
    sizes = {r.label: r.n for r in chosen.groupBy((F.col("label") == 1).alias("label")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    prior = float(np.log((one + 0.5) / (zero + 0.5))) if one + zero else -40.0
    weights = np.zeros(1 << BITS, np.float32)
    if not n1 or not n0:
        return Model(weights, prior)
    ratio = F.log((F.col("one") + 1) / (n1 + 2)) - F.log((F.col("zero") + 1) / (n0 + 2))
    best = seen.where(2 * _deviance(n1, n0) >= significant).select("slot", ratio.alias("ratio")).orderBy("slot").toArrow()  # 2^BITS rows at most
    if not best.num_rows:
        return Model(weights, prior)
    chosen_slots, ratio = best["slot"].to_numpy(), best["ratio"].to_numpy()
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen_slots] = np.arange(len(ratio))
    sent = sc.broadcast((place, ratio))

    def features(batch, first, end, raw, at):
        place, ratio = sent.value
        doc, slot = slots(raw, at, place >= 0)
        ends, column = np.searchsorted(doc, np.arange(end - first + 1)), place[slot]
        lists = [list_array(ends, pa.array(x)) for x in (column, ratio[column])]
        return pa.RecordBatch.from_arrays([*rows_of(batch, first, end, "label"), *lists], ["label", "place", "value"])

    rows = stored(map_text(chosen.select("label", "text"), features, "label int, place array<int>, value array<double>", limit=CHUNK_BYTES))
    coefficient, bias = fit(rows, len(ratio), n1 + n0)
    sent.destroy()
    weights[chosen_slots] = coefficient * ratio
    # The sample's share of toxic texts is not that of the labels.
    return Model(weights, bias + prior - float(np.log(n1 / n0)))


def _deviance(n1: int, n0: int) -> Column:
    """Half the likelihood-ratio statistic of a feature's presence, in ``one`` and ``zero`` of
    n1 and n0 texts, against the class."""
    share, out = (F.col("one") + F.col("zero")) / (n1 + n0), F.lit(0.0)
    for seen, size in ((F.col("one"), n1), (F.col("zero"), n0)):
        for part, of in ((seen, share), (size - seen, 1 - share)):
            out = out + F.when(part > 0, part * F.log(part / (size * of))).otherwise(0.0)
    return out


def fit(rows: DataFrame, width: int, n: int, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Coefficients and bias of a logistic regression on ``label, place, value`` (``n`` rows of sparse
    features) that minimise the sum of log losses plus penalty / 2 times the squared coefficients."""
    vector = F.udf(lambda place, value: Vectors.sparse(width, place, value), VectorUDT())
    data = rows.select(F.col("label").cast("double").alias("label"), vector("place", "value").alias("features"))
    model = LogisticRegression(regParam=penalty / n, standardization=False, maxIter=steps, tol=TOLERANCE).fit(data)
    return model.coefficients.toArray(), float(model.intercept)


def classify(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """The columns ``carry`` (None: all) of every row and, last, ``score_col``: the chance that its text is toxic.

    Null and empty texts, and texts without a feature, get the chance that the
    bias gives; repeated rows get the same score.  Only the text is looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns if carry is None else carry
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").cast("string").alias("text to score"))

    def run(batch, first, end, raw, at):
        w = sent.value.weights
        doc, slot = slots(raw, at, w != 0)
        total = np.bincount(doc, w[slot], end - first) + sent.value.bias
        chance = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        own = [batch.column(i).slice(first, end - first) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*own, pa.array(chance)], [*batch.schema.names[:-1], score_col])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(score_col, T.DoubleType())])
    return map_text(rows, run, schema, "text to score", CHUNK_BYTES)
