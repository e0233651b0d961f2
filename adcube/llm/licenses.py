"""Licence scans: TF-IDF cosine to templates, then inheritance from directories.

A unit is a line that speaks of licences, a passage (a paragraph that does and up
to PARAGRAPHS - 1 that follow it, so wrapped notices and complete short licences are
one unit), or the whole of a licence file.  A paragraph ends at a line without a
letter or digit, which an empty comment line is too.  Units and templates are sparse
vectors of term frequency times inverse document frequency, counted over the units of
all files; a template matches from a cosine of THRESHOLD on.  Units are compared once
for each different text; from then on its digest stands for it.  Of a unit's or file's
matches the strongest counts: terms of the template times the eighth power of the
cosine, so a long text that is nearly repeated goes before a short title below it, and
among templates of like length the more similar one.

A file that is named like a licence file, or that is little else than a notice,
licenses its directory.  A file without a licence of its own takes that of the
nearest directory above it that has one: directories are joined to their
ancestors by path, and files to their directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .licence_texts import TEMPLATES

THRESHOLD, MOSTLY = 0.5, 0.5
PARAGRAPHS = 5
SPEAKS_OF = r"(?i)(licen[cs]e|copyright|copying|spdx|permission{0}is{0}hereby{0}granted|permission{0}to{0}use{0}copy|redistribution{0}and{0}use|public{0}domain)".format("[^A-Za-z0-9]+")
PRINTED = "[A-Za-z0-9]"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"
TERM = "[a-z0-9]+(?:[.][0-9]+)*"


def templates(spark: SparkSession, texts: dict[str, list[str]]) -> DataFrame:
    rows = [(name, k, t) for name in sorted(texts) for k, t in enumerate([*texts[name], f"SPDX-License-Identifier: {name}"])]
    return spark.createDataFrame(rows, "licence string, form int, text string")


def _terms(text: str):
    return F.expr(f"regexp_extract_all(lower({text}), '({TERM})', 1)")


def units(files: DataFrame) -> DataFrame:
    """``file, unit, id, words`` (id: the unit's digest, words: its share of the file's
    words, 1 in a licence file) from ``file, path, text``; a file's equal units are one."""
    named = F.col("path").rlike(LICENCE_FILE) & (F.trim("text") != "")
    rows = files.select("file", "text", F.coalesce(named, F.lit(False)).alias("named")).where(F.col("named") | F.col("text").rlike(SPEAKS_OF))
    lines = F.split("text", "\n")
    marked = F.array_join(F.transform(lines, lambda line: F.when(line.rlike(PRINTED), line).otherwise("\x01")), "\n")
    paragraphs = F.filter(F.transform(F.split(marked, "\x01"), lambda p: F.btrim(p, F.lit("\n"))), lambda p: p.rlike(PRINTED))
    rows = rows.withColumn("lines", F.filter(lines, lambda line: line.rlike(SPEAKS_OF))).withColumn("paragraphs", paragraphs)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("paragraphs"), F.lit(1))), lambda k: F.coalesce(F.get("paragraphs", k - 1).rlike(SPEAKS_OF), F.lit(False)))
    passages = F.flatten(F.transform(starts, lambda k: F.array(*(F.array_join(F.slice("paragraphs", k, F.lit(m)), "\n") for m in range(1, PARAGRAPHS + 1)))))
    whole = F.when(F.col("named"), F.array("text")).otherwise(F.array().cast("array<string>"))
    found = rows.select("file", "named", F.size(F.split(F.trim("text"), r"\s+")).alias("all"), F.explode(F.array_distinct(F.concat(whole, "lines", passages))).alias("unit"))
    share = F.when(F.col("named"), 1.0).otherwise(F.size(F.split(F.trim("unit"), r"\s+")) / F.col("all"))
    return found.select("file", "unit", F.md5("unit").alias("id"), share.alias("words"))


def matched(found: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """``id, strength, similarity, licence`` of the different units that reach the threshold."""
    different = found.groupBy("id").agg(F.first("unit").alias("unit"), F.count("*").alias("copies"))
    vectors = different.select("id", "copies", F.explode(_terms("unit")).alias("term")).groupBy("id", "copies", "term").agg(F.count("*").alias("tf"))
    vectors = stored(vectors)
    forms = known.select("licence", "form", F.explode(_terms("text")).alias("term")).groupBy("licence", "form", "term").agg(F.count("*").alias("tf"))
    n = found.count() + known.count()
    df = vectors.select("term", "copies").unionByName(forms.select("term", F.lit(1).cast("long").alias("copies"))).groupBy("term").agg(F.sum("copies").alias("df"))
    idf = df.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
    forms = forms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    lengths = forms.groupBy("licence", "form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("form_length"), F.count("*").alias("terms"))
    forms = stored(forms.join(lengths, ["licence", "form"]).select("licence", "form", "term", "terms", (F.col("w") / F.col("form_length")).alias("v")))
    weighed = vectors.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    size = weighed.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dot = weighed.join(F.broadcast(forms), "term").groupBy("id", "licence", "form", "terms").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))  # the templates are constants
    cosine = F.round(F.col("dot") / F.col("size"), 9)
    reached = dot.join(size, "id").withColumn("similarity", cosine).where(F.col("similarity") >= threshold)
    second = F.col("similarity") * F.col("similarity")
    reached = reached.withColumn("strength", F.col("terms") * (second * second) * (second * second))
    return reached.groupBy("id").agg(F.max(F.struct("strength", "similarity", "licence")).alias("b")).select("id", "b.*")


def scan(docs: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", threshold: float = THRESHOLD, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """``doc_id, path, own_licence, similarity, licence, licensed_by`` of every row.

    licensed_by: the file's path or the directory's that the licence comes from;
    null where there is none.  Null texts are empty, null paths lie nowhere and
    inherit nothing.  Of several licences the strongest counts, of equal ones
    the last by name, in a file as in a directory.  Repeated rows get one answer.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.struct("doc_id", "path", F.xxhash64("text").alias("text_key"))
    rows = rows.withColumn("file", F.xxhash64(key)).withColumn("path", F.col("path"))
    found = stored(units(rows.select("file", "path", "text")))
    licences = matched(found, templates(spark, TEMPLATES if texts is None else texts), threshold)
    own = found.join(licences, "id").groupBy("file").agg(F.max(F.struct("strength", "similarity", "licence")).alias("best"), F.max(F.when(F.col("words") >= MOSTLY, 1)).alias("mostly"))
    own = stored(own.select("file", F.col("best.licence").alias("own_licence"), F.col("best.similarity").alias("similarity"), F.col("best.strength").alias("strength"), F.coalesce("mostly", F.lit(0)).alias("mostly")))
    files = rows.select("doc_id", "path", "file").join(own, "file", "left")
    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    files = stored(files.withColumn("directory", directory))

    licensed = files.where("own_licence is not null and mostly = 1 and directory is not null").groupBy("directory").agg(F.max(F.struct("strength", "similarity", "own_licence")).alias("b")).select(F.col("directory").alias("above"), F.col("b.own_licence").alias("licence"))
    step = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(step)), lambda k: F.array_join(F.slice(step, F.lit(1), k), "/"))
    ancestors = files.where("directory is not null").select("directory").distinct().select("directory", F.explode(F.array_union(above, F.array(F.lit("")))).alias("above"))
    nearest = ancestors.join(licensed, "above").groupBy("directory").agg(F.max(F.struct(F.length("above").alias("depth"), F.col("above").alias("above"), F.col("licence").alias("licence"))).alias("b"))
    nearest = nearest.select("directory", F.col("b.above").alias("licensed_by"), F.col("b.licence").alias("inherited"))
    out = files.join(nearest, "directory", "left")
    return out.select("doc_id", "path", "own_licence", "similarity", F.coalesce("own_licence", "inherited").alias("licence"), F.when(F.col("own_licence").isNotNull(), F.col("path")).otherwise(F.col("licensed_by")).alias("licensed_by"))
