"""Secret scans, in DataFrame functions and the DataFrame random forest only.

Candidates are all credential-like runs of characters in the words of a text.
A random forest, trained from labelled findings, removes false positives by the
candidate's length, its character classes and the transitions between them, how
like words its letter pairs are, how much of it dictionary words cover, its path
and the words around it.

The dictionary are the words that at least one in RARE of all words is, and the
pairs of letters are counted over all words: 27 x 27 logs are all that leaves the
executors for good; dictionary words are looked up by joins.

Without findings of their own users get a forest taught by :func:`examples`: lines
that are made by rule, of keys in the usual formats, in prose and as assignments,
of other credentials as assignments and, as long hexadecimal numbers, without a word on them, and of everything that looks like one and is
none (UUIDs, commit ids and checksums among their usual words, slugs, paths, names,
numbers, times, images as text).  What is a secret there is known from the making,
not from a feature.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

LEAST, RARE = 16, 1 << 16
TREES, DEPTH, SEED = 30, 8, 1
EXAMPLES, EXAMPLE_WORDS = 60, 256  # lines of each kind, and how many of the texts' words they are made with
TRAINED_ON = 10_000  # labelled findings of each class at most
SECRET = 0.5

VALUE = r"[A-Za-z0-9+/=_-]{%d,}" % LEAST
CREDENTIAL = r"(?i)(token|secret|passw|pwd|api|key|auth|credential|bearer|private)"
ASSIGN = ("=", ":", "=>", ":=")
# What stands before a value: its name, an assignment, and marks that open a value.
_OPEN = r"""["'`\\(\[{]*$"""
MARK = r"(:=|=>|[:=])" + _OPEN
NAMED = r"""(?<![A-Za-z0-9_.-])([A-Za-z0-9_.-]++)["'`\\\])]*+(?::=|=>|[:=])""" + _OPEN
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"
FEATURES = ("length", "digits", "capitals", "marks", "hexadecimal", "changes", "distinct", "letter_pairs", "dictionary", "path_depth", "test_path", "near_credential", "near_assignment", "near_words", "near_identifier", "key_prefix", "uuid", "image")

# Fixed formats: openings of well-known keys, numbered things and what is told to be one, images as text.
KEY_PREFIX = r"^(AKIA|ASIA|gh[pousr]_|[sr]k_(live|test)_|xox[abp]-|glpat-)"
UUID = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
IDENTIFIER = r"(?i)\b(commits?|committed|sha-?[0-9]*|md5|checksum|digest|hash(es)?|etag|revision|merged?|tree|blob|uuid|guid|build|integrity|parent)\b"
IMAGE = r"(?i)base64,$"


def _runs(w: Column) -> Column:
    """``place, value, context`` of the runs of a word (context: the end of what stands
    before it in the word).  A run with an inner "=" falls apart into name and values;
    it stays whole if a value would be shorter than LEAST."""

    def parts(r: Column, k: Column, runs: Column, gaps: Column) -> Column:
        context = F.concat(F.coalesce(F.get(runs, k - 1), F.lit("")), F.get(gaps, k))

        def cut(s: Column) -> Column:
            before = lambda m: F.when(m == 0, context).when(m == 1, F.concat(context, F.get(s, m - 1), F.lit("="))).otherwise(F.concat(F.get(s, m - 1), F.lit("=")))
            own = F.transform(s, lambda v, m: F.struct(k.alias("place"), v.alias("value"), before(m).alias("context")))
            whole = F.array(F.struct(k.alias("place"), r.alias("value"), context.alias("context")))
            short = F.exists(F.slice(s, F.lit(2), F.size(s)), lambda v: F.length(v) < LEAST)
            return F.when(short, whole).otherwise(F.filter(own, lambda x: F.length(x["value"]) >= LEAST))

        return F.get(F.transform(F.array(F.split(r, "=+(?=[^=])", -1)), cut), F.lit(0))

    both = F.struct(F.regexp_extract_all(w, F.lit(VALUE), F.lit(0)).alias("runs"), F.split(w, VALUE, -1).alias("gaps"))  # once for each word
    return F.get(F.transform(F.array(both), lambda z: F.flatten(F.transform(z["runs"], lambda r, k: parts(r, k, z["runs"], z["gaps"])))), F.lit(0))


def _assigned(x: Column, previous: Column) -> Column:
    """``[name, assignment]`` right before a value, in its word or at the end of the word
    before (of a quoted or a credential's name, or with "="); null: none."""
    inside = F.when(x["context"].rlike(MARK) & ~x["value"].startswith("//"), x["context"])
    name = F.regexp_extract(previous, NAMED, 1)
    tells = previous.rlike(r"""["']:$""") | previous.rlike("=>?$") | (previous.endswith(":") & name.rlike(CREDENTIAL))
    ahead = F.when(x["context"].rlike("^" + _OPEN) & (F.length(previous) > 2) & tells, previous)
    at = F.coalesce(inside, ahead)
    return F.when(at.isNotNull(), F.array(F.regexp_extract(at, NAMED, 1), F.regexp_extract(at, MARK, 1)))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``doc_id, text_key, path, word, place, value, before, after, context`` of each candidate
    (word: its word's place among the words, place: its run's place in the word, context:
    what stands between the run before and it, that included).

    A candidate is a run of at least LEAST credential characters in a word that
    has a digit or follows an assignment, in its word or before it; a word may
    hold many.  Null and empty texts have none.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), path.alias("path"), F.split(text, r"[ \t-\r]+").alias("words"))
    near = lambda i, k: F.coalesce(F.get("words", i + k), F.lit(""))

    def of_word(w: Column, i: Column) -> Column:
        previous = near(i, -1)
        with_names = F.transform(_runs(w), lambda x: F.struct(i.alias("word"), x["place"].alias("place"), x["value"].alias("value"), x["context"].alias("context"), _assigned(x, previous).alias("named")))
        told = lambda x: x["value"].rlike("[0-9]") | x["named"].isNotNull() | previous.isin(*ASSIGN)
        return F.when(F.length(w) >= LEAST, F.filter(with_names, told))

    rows = rows.withColumn("found", F.flatten(F.filter(F.transform("words", of_word), lambda x: x.isNotNull()))).where(F.size("found") > 0)
    rows = rows.select("doc_id", "text_key", "path", "words", F.explode("found").alias("x"))
    before = F.coalesce(F.col("x.named"), F.array(near(F.col("x.word"), -2), near(F.col("x.word"), -1)))
    return rows.select("doc_id", "text_key", "path", F.col("x.word").alias("word"), F.col("x.place").alias("place"), F.col("x.value").alias("value"), before.alias("before"), near(F.col("x.word"), 1).alias("after"), F.col("x.context").alias("context"))


def dictionary(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[float]]:
    """``word``: the words of 3 to 20 letters that one in RARE of them all is at least (of any
    language), and the log shares of the pairs of letters a-z in all of them (27 x 27; the last
    row and column: anything else)."""
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    words = docs.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where("length(word) between 3 and 20")
    counted = stored(words.groupBy("word").agg(F.count("*").alias("n")))
    pairs = counted.select("n", F.explode(F.expr("transform(sequence(1, length(word) - 1), k -> substr(word, k, 2))")).alias("pair")).where(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = [1.0] * (27 * 27)
    for r in pairs.collect():  # 26 x 26 rows at most
        counts[(ord(r.pair[0]) - 97) * 27 + ord(r.pair[1]) - 97] += r.n
    total = sum(counts)
    known = counted.where(F.col("n") * RARE >= (counted.agg(F.sum("n")).first()[0] or 0)).select("word")
    return stored(known.unionByName(docs.sparkSession.createDataFrame([(w,) for w in COMMON], "word string")).distinct()), [math.log(c / total) for c in counts]


# Words of the lines below, in any dictionary.
COMMON = ("the", "and", "for", "with", "from", "this", "that", "new", "best", "house", "summer", "winter", "correct", "horse", "hunter", "green", "river", "data", "user", "file", "test", "main", "server", "order")
CREDENTIAL_NAMES = ("token", "api_key", "secret", "password", "auth_token", "client_secret", "aws_secret_access_key", "DB_PASSWORD", "private_key", "apikey", "passwd", "Authorization_Bearer")
IDENTIFIER_WORDS = ("commit", "sha1", "revision", "checksum", "sha256", "digest", "md5", "etag", "hash", "merge", "tree", "parent")
OTHER_NAMES = ("name", "order", "path", "slug", "ref", "title", "number", "next", "id", "label")


def examples(spark: SparkSession, words: list[str], each: int = EXAMPLES) -> DataFrame:
    """``doc_id, path, text, secret``: lines by rule, ``each`` of every kind; ``secret`` is the
    credential in it, null for none.  ``words``: of the texts, for prose, slugs and passwords."""
    letters, base64 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    code = lambda alphabet, n: f"array_join(transform(sequence(1, {n}), k -> substr('{alphabet}', cast(conv(substr(r, 2 * k - 1, 2), 16, 10) as int) % {len(alphabet)} + 1, 1)), '')"
    nth = lambda j, of: f"cast(pmod(xxhash64(id, {j}), {of}) as int)"
    word = lambda j: f"words[{nth(j, 'size(words)')}]"
    one = lambda j, *options: f"array({', '.join(repr(o) for o in options)})[{nth(j, len(options))}]"
    digits = lambda n: f"translate(substr(r, 1, {n}), 'abcdef', '123456')"
    prose, quote = lambda v: f"concat_ws(' ', {word(1)}, {word(2)}, {v}, {word(3)}, {word(4)})", one(9, '"', "", "'")
    assigned = lambda name, v: f"concat({word(1)}, ' ', {name}, {one(8, ' = ', '=', ': ', ':', ' := ')}, {quote}, {v}, {quote}, ' ', {word(2)})"
    listed = lambda v: f"concat({one(3, 'a,', '', 'x;1;')}, {quote}, {v}, {quote}, {one(4, ',b', '', ';')})"
    credential = lambda v: assigned(one(7, *CREDENTIAL_NAMES), v)
    told = lambda v: f"concat({word(1)}, ' ', {one(7, *IDENTIFIER_WORDS)}, {one(8, ' ', ': ', ' = ', ':', ' of ')}, {v}, ' ', {word(2)})"
    hexadecimal = lambda n: f"substr(r, 1, {n})"
    uuid = "concat_ws('-', substr(r, 1, 8), substr(r, 9, 4), substr(r, 13, 4), substr(r, 17, 4), substr(r, 21, 12))"
    slug = f"concat_ws({one(6, '-', '-', '_')}, {word(5)}, {word(6)}, {digits(4)}, {word(7)}, {word(8)})"
    path = f"concat_ws('/', {one(6, '', 'src', 'usr')}, {word(5)}, {word(6)}, concat({word(7)}, {digits(2)}), {word(8)})"
    camel = f"concat({word(5)}, initcap({word(6)}), initcap({word(7)}), initcap({word(8)}), {digits(1)})"
    time = "concat('20', substr(translate(r, 'abcdef', '123456'), 1, 2), '-0', substr(translate(r, 'abcdef', '123456'), 3, 1), '-12T10-', substr(translate(r, 'abcdef', '123456'), 5, 2), '-33Z')"
    password = f"concat({word(5)}, {digits(1)}, {word(6)}, {word(7)}, {digits(2)})"
    keys = [f"concat('AKIA', upper({code(letters[:26] + letters[52:], 16)}))", f"concat({one(5, 'ghp_', 'gho_', 'ghs_')}, {code(letters, 36)})", f"concat({one(5, 'sk_live_', 'rk_live_')}, {code(letters, 24)})", f"concat('glpat-', {code(letters, 20)})"]
    kinds = [(v, line(v)) for v in keys for line in (prose, prose, listed, listed, credential)]
    kinds += [(v, line(v)) for v in (hexadecimal(40), hexadecimal(64)) for line in (prose, listed)]  # nothing says that they are harmless
    kinds += [(v, credential(v)) for v in (hexadecimal(40), hexadecimal(64), hexadecimal(32), code(letters, 32), code(letters, 20), code(base64, 40), password, password)]
    kinds += [(None, line(v)) for v in (hexadecimal(40), hexadecimal(64), hexadecimal(32)) for line in (told, told)]
    other = lambda v: assigned(one(7, *OTHER_NAMES), v)
    kinds += [(None, line(v)) for v in (uuid, slug, path, camel, time, digits(16)) for line in (prose, listed, other)]
    kinds += [(None, told(uuid)), (None, f"concat({word(1)}, ' ', {one(7, 'src=', 'url(', '')}, {quote}, 'data:image/png;base64,', {code(base64, 64)}, {quote}, ' ', {word(2)})")]
    rows = spark.range(each * len(kinds)).withColumn("kind", F.col("id") % len(kinds)).withColumn("r", F.sha2(F.col("id").cast("string"), 512))
    rows = rows.withColumn("words", F.array(*map(F.lit, [*COMMON, *words])))
    chosen = lambda i: "CASE kind " + " ".join(f"WHEN {k} THEN {kind[i] or 'cast(null as string)'}" for k, kind in enumerate(kinds)) + " END"
    return rows.select(F.col("id").alias("doc_id"), F.expr(one(11, "", "src/app.py", "docs/guide.md", "src/web/a/b.js")).alias("path"), F.expr(chosen(1)).alias("text"), F.expr(chosen(0)).alias("secret"))


def with_features(found: DataFrame, words: DataFrame, pairs: list[float]) -> DataFrame:
    """``found`` (written, with ``id``, a number for each row) and its features, ``f_...``."""
    n = F.length("value")
    without = lambda pattern: F.length(F.regexp_replace("value", pattern, ""))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"), "[^aA9]", "-")
    # Letter pairs in one pass: the last letter goes along.
    letter = lambda c: F.when(c.between("a", "z"), F.ascii(c) - 97).otherwise(26)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    step = lambda a, c: F.struct(letter(c).alias("last"), (a["sum"] + F.when(a["last"] < 0, 0.0).otherwise(F.get("pair_table", a["last"] * 27 + letter(c)))).alias("sum"))
    found = found.withColumn("pair_table", F.array(*map(F.lit, pairs)))
    pair_logs = F.aggregate(F.split(F.lower("value"), ""), start, step, lambda a: a["sum"])
    near = F.concat("before", F.array("after"))
    columns: dict[str, Column] = {
        "length": n,
        "digits": 1 - without("[0-9]") / n,
        "capitals": 1 - without("[A-Z]") / n,
        "marks": 1 - without("[^A-Za-z0-9]") / n,
        "hexadecimal": F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("int"),
        "changes": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "letter_pairs": pair_logs / n,
        "dictionary": F.coalesce("covered", F.lit(0)) / n,
        "path_depth": F.size(F.split("path", "/")),
        "test_path": F.col("path").rlike(TEST_PATH).cast("int"),
        "near_credential": F.concat_ws(" ", "before").rlike(CREDENTIAL).cast("int"),
        "near_assignment": F.element_at("before", -1).isin(*ASSIGN).cast("int"),
        "near_words": F.coalesce("known", F.lit(0)),
        "near_identifier": F.regexp_replace(F.concat_ws(" ", near, "context"), "_", " ").rlike(IDENTIFIER).cast("int"),
        "key_prefix": F.col("value").rlike(KEY_PREFIX).cast("int"),
        "uuid": F.col("value").rlike(UUID).cast("int"),
        "image": F.col("context").rlike(IMAGE).cast("int"),
    }
    # Runs of letters of a value, cut where capitals begin, and the words around it, in the dictionary.
    inside = F.transform(F.regexp_extract_all("value", F.lit("([A-Z]?[a-z]+|[A-Z]+)"), F.lit(1)), F.lower)
    inside = found.select("id", F.explode(F.filter(inside, lambda w: F.length(w).between(3, 20))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("times"))
    around = found.select("id", F.explode(F.array_distinct(F.transform(near, lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}]", ""))))).alias("word"))
    inside = inside.join(words, "word").groupBy("id").agg(F.sum(F.length("word") * F.col("times")).alias("covered"))
    around = around.join(words, "word").groupBy("id").agg(F.count("*").alias("known"))
    found = found.join(inside, "id", "left").join(around, "id", "left")
    return found.withColumns({f"f_{k}": c.cast("double") for k, c in columns.items()}).drop("pair_table", "covered", "known", "id")


def labelled_examples(spark: SparkSession, words: DataFrame, pairs: list[float]) -> DataFrame:
    """The candidates of :func:`examples` with their features and whether they are its secret."""
    some = [r.word for r in words.orderBy(F.xxhash64("word"), "word").limit(EXAMPLE_WORDS).collect()]
    lines = stored(examples(spark, some))
    found = candidates(lines, path_col="path").join(lines.select("doc_id", "secret"), "doc_id")
    label = F.coalesce(F.col("value") == F.col("secret"), F.lit(False)).cast("double")
    found = stored(found.withColumn("label", label).drop("secret").withColumn("id", F.monotonically_increasing_id()))
    return with_features(found, words, pairs)


def train(labelled: DataFrame, limit: int = TRAINED_ON):
    """The forest, from at most ``limit`` findings of each class (those with the smallest
    hashes); None if a class is missing."""
    order = [F.xxhash64("value", "doc_id", "word"), F.col("value"), F.col("doc_id"), F.col("word"), F.col("place")]
    kept = [*(f"f_{k}" for k in FEATURES), "label"]
    sample = stored(labelled.where("label = 1").orderBy(*order).limit(limit).select(*kept).unionByName(labelled.where("label = 0").orderBy(*order).limit(limit).select(*kept)))
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=kept[:-1], outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """``doc_id, text_key, path, word, place, value, probability, secret`` of every candidate.

    ``labelled``: findings as of :func:`with_features` with a ``label`` (1 secret,
    0 not; None: :func:`labelled_examples`).  If a class is missing nothing is
    removed: every candidate has probability 1.  Repeated rows repeat their
    candidates, each with the same probability.
    """
    words, pairs = dictionary(docs, text_col)
    held = stored(candidates(docs, id_col, text_col, path_col).withColumn("id", F.monotonically_increasing_id()))
    found = with_features(held, words, pairs)
    forest = train(labelled if labelled is not None else labelled_examples(docs.sparkSession, words, pairs))
    if forest is None:
        judged = found.withColumn("probability", F.lit(1.0))
    else:
        rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(found)
        judged = forest.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    return judged.select("doc_id", "text_key", "path", "word", "place", "value", "probability", (F.col("probability") >= SECRET).alias("secret"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found secret in its text replaced; all other rows and columns as they are."""
    secrets = found.where("secret").groupBy(F.col("doc_id").alias("secret id"), F.col("text_key").alias("secret text")).agg(F.collect_set("value").alias("secret values"))
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    # Only texts that may hold a candidate are joined, so the others are not shuffled.
    may = F.coalesce(F.col(f"`{text_col}`").rlike(VALUE), F.lit(False))
    held = docs.where(may).withColumn("secret key", key)
    held = held.join(secrets, F.col(f"`{id_col}`").eqNullSafe(F.col("secret id")) & (F.col("secret key") == F.col("secret text")), "left")
    longest_first = F.expr("array_sort(`secret values`, (a, b) -> length(b) - length(a))")
    text = F.aggregate(longest_first, F.col(f"`{text_col}`"), lambda t, s: F.replace(t, s, F.lit(mask)))
    held = held.withColumn(text_col, F.when(F.col("secret values").isNull(), F.col(f"`{text_col}`")).otherwise(text))
    return held.select(*(f"`{c}`" for c in docs.columns)).unionByName(docs.where(~may))
