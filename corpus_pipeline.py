"""Training-data pipeline over ``documents``: five text operators in order.

Each stage takes the rows that the one before kept, as written and read again,
and returns rows with the columns of ``documents``; the last returns token ids.
Rows are matched to an operator's findings by id and text hash, so rows that
share an id are decided one by one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcube.llm import hyperminhash, pieces, secrets, toxicity, winnowing
from adcube.llm.common import id_remainder, stored, table
from adcube.session import delete_folder, ensure_checkpoint_dir, intermediates


def _matched(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to ``verdicts`` (doc_id, text_key and more, renamed "v ...")."""
    right = verdicts.select(*(F.col(c).alias(f"v {c}") for c in verdicts.columns))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("v doc_id")) & (F.col("v key") == F.col("v text_key"))
    return docs.withColumn("v key", key).join(right, same, how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    scored = toxicity.classify(docs, toxicity.train(docs, labels), score_col="toxicity score")
    return scored.where(F.col("toxicity score") < 0.5).drop("toxicity score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, 80 %) stays: its representative, once."""
    found = hyperminhash.near_duplicates(docs, percent=80)
    stays = found.groupBy("doc_id", "text_key").agg(F.first("representative").alias("stays"), F.first("n_shingles").alias("n"), F.count("*").alias("rows"))
    stays = stored(stays.where("stays"))
    once = (F.col("rows") == 1) | (F.col("n") == 0)
    single = _matched(docs, stays.where(once).select("doc_id", "text_key"), "inner").select(*docs.columns)
    several = _matched(docs, stays.where(~once).select("doc_id", "text_key"), "inner").dropDuplicates(["v doc_id", "v text_key"]).select(*docs.columns)
    return single.unionByName(several)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _matched(docs, stored(found.where("n_hit > 0").select("doc_id", "text_key").distinct()), "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are replaced."""
    return secrets.redact(docs, secrets.scan(docs, path_col="source"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, ids`` and whether the ids decode to the whole text again."""
    out = pieces.encode(docs, pieces.load(merges=True), carry=["doc_id", "source", "lang"], check_col="round_trip")
    return out.withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

# A trained classifier and a trained forest are stages: no SQL gives these rows.
# tests/llm/test_pipeline.py runs every stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages wrote on the way is deleted when its reader is done."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        folder = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
        with intermediates(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
        if before is not None:
            delete_folder(spark, before)
        before = folder
    return docs
