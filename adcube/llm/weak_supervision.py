"""Quality by weak supervision, in DataFrame functions only.

Rules vote for good (1), vote for bad (-1) or abstain (0) on a document.  How
often a rule votes each way on good and on bad documents is not known; it is
estimated by expectation-maximisation over the votes on all documents, which
are independent given the quality.  A document is kept by its posterior
probability of being good, instead of having to pass every rule.

The documents enter the estimation as counts of different votes (3 ^ rules rows
at most), so each round is one small aggregation that returns one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ROUNDS, SMOOTH, SUSPECT = 20, 1.0, 0.05
KEEP = 0.5

# Fixed list: common function words of English, French, German and Spanish.
FUNCTION_WORDS = ("the", "and", "of", "to", "in", "is", "that", "for", "with", "le", "la", "les", "de", "des", "et", "que", "pour", "der", "die", "das", "und", "den", "von", "mit", "zu", "el", "los", "las", "en", "por", "con", "para")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and counts over the whole text of every row (null: empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = rows.select(
        "doc_id",
        F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "").alias("words"),
        lines.alias("lines"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    rows = rows.withColumn("grams", F.expr("if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))").cast("array<bigint>"))
    # Only texts with a repeated window sort them; equal ones are then neighbours.
    sorted_grams = F.expr("if(size(array_distinct(grams)) = size(grams), array(), sort_array(transform(grams, (h, i) -> struct(h, i))))").cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn("sorted", sorted_grams)
    at = F.expr("sort_array(transform(filter(sorted, (g, k) -> (k > 0 and sorted[greatest(k - 1, 0)].h = g.h) or (k < size(sorted) - 1 and sorted[least(k + 1, size(sorted) - 1)].h = g.h)), g -> g.i))")
    rows = rows.withColumn("starts", at)
    # A repeated window covers three words, less those that the one before covers.
    repeated = F.expr("aggregate(starts, struct(0L as n, -3 as last), (a, i) -> struct(a.n + least(3, i - a.last) as n, i as last), a -> a.n)")
    n_words, n_lines = F.size("words").cast("long"), F.size("lines").cast("long")
    return rows.select(
        "doc_id",
        n_words.alias("n_words"),
        "word_chars",
        "n_symbols",
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        "n_capitals",
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_capital_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, FUNCTION_WORDS)))).cast("long").alias("n_function_words"),
    )


def rules() -> dict[str, Column]:
    """Votes from the counts; a share of nothing is null and abstains.  Each kind of
    junk is seen by two rules at least, from different sides."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    lines = F.when(F.col("n_lines") > 1, F.col("n_lines"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    size = chars / words
    enough = F.when(F.col("n_words") >= 20, F.col("n_function_words"))
    bad = {
        "word_size": (size < 2.5) | (size > 14),
        "symbols": F.col("n_symbols") / words > 0.1,
        "symbol_chars": F.col("n_symbols") / chars > 0.02,
        "copied_lines": F.col("n_dup_lines") / lines > 0.3,
        "repeats": F.col("n_repeat_words") / words > 0.4,
        "variety": F.col("n_distinct") / words < 0.2,
        "capitals": F.col("n_capitals") / chars > 0.4,
        "capital_words": F.col("n_capital_words") / words > 0.5,
        "function_words": enough == 0,
    }
    good = {"function_words": enough >= 3, "length": F.col("n_words") >= 100}
    no = F.lit(False)
    return {name: F.when(bad.get(name, no), -1).when(good.get(name, no), 1).otherwise(0) for name in [*bad, "length"]}


def log_odds(votes: list[str], model: dict) -> Column:
    """Log odds of good quality under the estimated vote shares."""
    out = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name in votes:
        weight = {v: math.log(model[name, v, 1] / model[name, v, 0]) for v in (-1, 0, 1)}
        out = out + F.when(F.col(name) == 1, weight[1]).when(F.col(name) == -1, weight[-1]).otherwise(weight[0])
    return out


def chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), odds))))


def estimate(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict:
    """Vote shares of good and bad documents.  The first guess suspects what any rule votes against."""
    patterns = stored(votes.groupBy(*names).agg(F.count("*").alias("n")))
    against = F.lit(False)
    for name in names:
        against = against | (F.col(name) == -1)
    q: Column = F.when(against, SUSPECT).otherwise(1 - SUSPECT)
    model: dict = {}
    for _ in range(rounds):
        weighed = patterns.withColumn("q", q)
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("q")).alias("good")]
        for name in names:
            for v in (-1, 0, 1):
                here = F.when(F.col(name) == v, F.col("n")).otherwise(0)
                sums += [F.sum(here * F.col("q")).alias(f"{name} {v} 1"), F.sum(here * (1 - F.col("q"))).alias(f"{name} {v} 0")]
        r = weighed.agg(*sums).first().asDict()
        n, good = float(r["n"] or 0), float(r["good"] or 0)
        model = {"good": (good + SMOOTH) / (n + 2 * SMOOTH)}
        for name in names:
            for v in (-1, 0, 1):
                model[name, v, 1] = (float(r[f"{name} {v} 1"] or 0) + SMOOTH) / (good + 3 * SMOOTH)
                model[name, v, 0] = (float(r[f"{name} {v} 0"] or 0) + SMOOTH) / (n - good + 3 * SMOOTH)
        q = chance(log_odds(names, model))
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Counts, votes and ``quality``, the posterior probability of good quality, of every row.

    Null and empty texts have no words: rules on shares abstain and the rule on
    length votes against.  Repeated rows are judged alike and each counts in the
    estimation; null ids are kept.  Without rows the result is empty.
    """
    counted = stored(features(docs, id_col, text_col))
    names = list(rules())
    voted = counted.withColumns(rules())
    return voted.withColumn("quality", chance(log_odds(names, estimate(voted, names, rounds))))
