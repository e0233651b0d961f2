"""DuckDB SQL for the text operators whose whole result SQL can express.

The others have a trained or estimated part (op1, op2, op3, op6, op8) or a
tokenizer (op7); ``tests/llm`` holds them against plain versions instead.  Ids
of documents are unique in the test tables.
"""

from __future__ import annotations

from .licenses import LICENCE_FILE, MOSTLY, PARAGRAPHS, PRINTED, SPEAKS_OF, TEMPLATES, TERM, THRESHOLD

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x20\x09-\x0D]+"
TEST_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, pattern: str, key: str = "doc_id", lower: bool = True) -> str:
    text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')" if lower else "coalesce(text, '')"
    return f"SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"


SUPERKMER = f"""
WITH d AS ({_words("documents", WORDS, lower=False)}),
win AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 34], ' ')) AS key
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)),
again AS (SELECT key FROM win GROUP BY key HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM win JOIN again USING (key)),
pos AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

WINNOWING = f"""
WITH d AS ({_words("documents", TEST_WORDS)}),
b AS ({_words("benchmark", TEST_WORDS, "CAST(item_id AS VARCHAR) AS item_id")}),
win AS (SELECT DISTINCT item_id, 10 AS n, array_to_string(w[k:k + 9], ' ') AS key
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM b WHERE len(w) >= 10)
        UNION ALL SELECT DISTINCT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9),
here AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS key
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
               FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, n, k FROM here JOIN win USING (n, key)),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id"""

HYPERMINHASH = f"""
WITH RECURSIVE d AS ({_words("documents", WORDS)}),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)
            UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
         FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
smallest AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, smallest.c AS component_id, d.doc_id = smallest.c AS kept
FROM d LEFT JOIN size ON size.doc_id = d.doc_id JOIN smallest ON smallest.a = d.doc_id"""


_FORMS = ", ".join(
    "('{}', {}, '{}')".format(name, k, t.replace("'", "''"))
    for name in sorted(TEMPLATES) for k, t in enumerate([*TEMPLATES[name], f"SPDX-License-Identifier: {name}"]))
_WHITE = r"[ \t\n\x0B\f\r]+"

LICENSES = f"""
WITH templates(licence, form, text) AS (VALUES {_FORMS}),
files AS (SELECT doc_id, coalesce(text, '') AS text,
                 concat_ws('/', source, lang, CAST(doc_id // 100 AS VARCHAR),
                           CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) END) AS path FROM documents),
spoken AS (SELECT doc_id, text, regexp_matches(path, '{LICENCE_FILE}') AND trim(text) <> '' AS named,
                  string_split(text, chr(10)) AS lines FROM files
           WHERE (regexp_matches(path, '{LICENCE_FILE}') AND trim(text) <> '') OR regexp_matches(text, '{SPEAKS_OF}')),
cut AS (SELECT *, list_filter(list_transform(string_split(array_to_string(list_transform(lines,
                      lambda l: CASE WHEN regexp_matches(l, '{PRINTED}') THEN l ELSE chr(1) END), chr(10)), chr(1)),
                  lambda p: trim(p, chr(10))), lambda p: regexp_matches(p, '{PRINTED}')) AS ps FROM spoken),
start AS (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS k FROM cut),
unit AS (SELECT doc_id, text AS unit FROM spoken WHERE named
         UNION SELECT doc_id, unit FROM (SELECT doc_id, unnest(lines) AS unit FROM spoken) WHERE regexp_matches(unit, '{SPEAKS_OF}')
         UNION SELECT doc_id, array_to_string(ps[k:k + m], chr(10)) FROM start, range({PARAGRAPHS}) r(m) WHERE regexp_matches(ps[k], '{SPEAKS_OF}')),
found AS (SELECT doc_id, unit, CASE WHEN named THEN 1.0::DOUBLE
                 ELSE len(regexp_split_to_array(trim(unit), '{_WHITE}')) / len(regexp_split_to_array(trim(text), '{_WHITE}')) END AS words
          FROM unit JOIN spoken USING (doc_id)),
total AS (SELECT (SELECT count(*) FROM found) + (SELECT count(*) FROM templates) AS n),
different AS (SELECT unit, count(*) AS copies FROM found GROUP BY unit),
vec AS (SELECT unit, copies, term, count(*) AS tf
        FROM (SELECT unit, copies, unnest(regexp_extract_all(lower(unit), '{TERM}')) AS term FROM different) GROUP BY ALL),
form AS (SELECT licence, form, term, count(*) AS tf
         FROM (SELECT licence, form, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM templates) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM total)) / (1 + sum(c))) + 1 AS idf
        FROM (SELECT term, copies AS c FROM vec UNION ALL SELECT term, 1 FROM form) GROUP BY term),
fw AS (SELECT licence, form, term, tf * idf AS w FROM form JOIN idf USING (term)),
fs AS (SELECT licence, form, sqrt(sum(w * w)) AS size, count(*) AS terms FROM fw GROUP BY 1, 2),
uw AS (SELECT unit, term, tf * idf AS w FROM vec JOIN idf USING (term)),
us AS (SELECT unit, sqrt(sum(w * w)) AS size FROM uw GROUP BY 1),
cosine AS (SELECT unit, licence, round(sum(uw.w * fw.w) / min(us.size) / min(fs.size), 9) AS s, min(terms) AS terms
           FROM uw JOIN fw USING (term) JOIN us USING (unit) JOIN fs USING (licence, form) GROUP BY unit, licence, form),
best AS (SELECT unit, licence, s, terms * ((s * s) * (s * s)) * ((s * s) * (s * s)) AS strength FROM cosine WHERE s >= {THRESHOLD}
         QUALIFY row_number() OVER (PARTITION BY unit ORDER BY strength DESC, s DESC, licence DESC) = 1),
own AS (SELECT doc_id, first(licence ORDER BY strength DESC, s DESC, licence DESC) AS own_licence,
               first(s ORDER BY strength DESC, s DESC, licence DESC) AS s, max(strength) AS strength, bool_or(words >= {MOSTLY}) AS mostly FROM found JOIN best USING (unit) GROUP BY doc_id),
placed AS (SELECT f.doc_id, f.path, regexp_replace(f.path, '/[^/]*$', '') AS directory, own_licence, s, strength, mostly
           FROM files f LEFT JOIN own ON f.doc_id = own.doc_id),
licensed AS (SELECT directory AS above, first(own_licence ORDER BY strength DESC, s DESC, own_licence DESC) AS licence
             FROM placed WHERE mostly GROUP BY 1),
nearest AS (SELECT directory, above, licence FROM (SELECT DISTINCT directory FROM placed) d
            JOIN licensed l ON d.directory = l.above OR starts_with(d.directory, l.above || '/') OR l.above = ''
            QUALIFY row_number() OVER (PARTITION BY directory ORDER BY length(above) DESC) = 1)
SELECT doc_id, path, own_licence, round(s, 6) AS similarity, coalesce(own_licence, licence) AS licence,
       CASE WHEN own_licence IS NOT NULL THEN path ELSE above END AS licensed_by
FROM placed LEFT JOIN nearest USING (directory)"""


# crc32 of the decimal id: bytes folded one by one, eight shifts each.
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
             lambda a, c: xor(a >> 8, list_extract(crcs, CAST(xor(a & 255::UBIGINT, c) AS BIGINT) + 1))), 4294967295::UBIGINT)"""
_CRC_TABLE = """crc_step(i, k, v) AS (SELECT i, 0, CAST(i AS UBIGINT) FROM range(256) r(i)
    UNION ALL SELECT i, k + 1, xor(v >> 1, 3988292384::UBIGINT * (v & 1::UBIGINT)) FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS crcs FROM crc_step WHERE k = 8)"""


# A stretch in which words q apart are equal; where two have the same ends, the smaller q is its period.
RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents, crc_table),
e AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, CAST((h // 10) % greatest(len(w), 1) AS BIGINT) AS a, CAST((h // 10) % 8 AS BIGINT) AS g FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g) AS p FROM e),
pos AS (SELECT doc_id, n, i, CASE WHEN made AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
        FROM (SELECT *, unnest(range(n)) AS i FROM f)),
pair AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM pos x JOIN pos y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair) GROUP BY doc_id, q, island),
run AS (SELECT doc_id, start, length, min(q) AS q FROM stretch WHERE length >= 6 AND length >= 4 * q GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM run GROUP BY doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, start, q) = 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told ON told.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

# A turn is <|im_start|>role<|im_sep|>text<|im_end|>: 32 characters and one more for each "<|"
# (after any backslashes) in its role and text.
CHAT = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -1, k, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)),
told AS (SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
                sum(32 + length(role) + length(text) + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS formatted_chars
         FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told"""

def _field(column: str, more: str = "") -> str:
    return f"coalesce(CAST(strlen(CAST({column}{more} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column}{more} AS VARCHAR), '-')"


_LEAF = "sha256({})".format(" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))))
_TAMPERED = "sha256({})".format(" || ".join(_field(c, " + 1" if c == "n_chars" else "") for c in ("doc_id", "source", "lang", "n_chars", "text")))

# Trees of the languages (t = 1 and up) and the tree over their roots (t = 0); a node's level
# counts from its leaves.
MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaf AS (SELECT doc_id, lang, {_LEAF} AS leaf, {_CRC} % 7 = 0 AS tampered, {_TAMPERED} AS changed FROM documents, crc_table),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS t,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaf),
node(t, level, pos, n, h) AS (
    SELECT t, 0, pos, n, leaf FROM placed
    UNION ALL
    SELECT t, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY t, level, pos // 2, n),
subroot AS (SELECT t, h, level FROM node WHERE n = 1),
high(level, pos, n, h) AS (
    SELECT 0, row_number() OVER (ORDER BY t) - 1, count(*) OVER (), h FROM subroot
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 2, n),
way(t, start, level, h) AS (
    SELECT p.t, p.pos, x.level, s.h FROM placed p JOIN node x ON x.t = p.t AND x.n > 1 AND x.pos = p.pos >> x.level
    LEFT JOIN node s ON s.t = x.t AND s.level = x.level AND s.pos = xor(x.pos, 1)),
high_way AS (SELECT r.t, x.level, s.h FROM subroot r JOIN high x ON x.n > 1 AND x.pos = (r.t - 1) >> x.level
    LEFT JOIN high s ON s.level = x.level AND s.pos = xor(x.pos, 1)),
low_proof AS (SELECT t, start, string_agg(h, '' ORDER BY level) AS s, list(coalesce(h, '') ORDER BY level) AS steps FROM way GROUP BY 1, 2),
high_proof AS (SELECT t, string_agg(h, '' ORDER BY level) AS s, list(coalesce(h, '') ORDER BY level) AS steps FROM high_way GROUP BY 1),
proof AS (SELECT p.*, coalesce(l.s, '') || coalesce(g.s, '') AS siblings,
                 list_concat(list_transform(coalesce(l.steps, []), lambda s, k: [s, CAST((p.pos >> (k - 1)) % 2 AS VARCHAR)]),
                             list_transform(coalesce(g.steps, []), lambda s, k: [s, CAST(((p.t - 1) >> (k - 1)) % 2 AS VARCHAR)])) AS steps
          FROM placed p LEFT JOIN low_proof l ON l.t = p.t AND l.start = p.pos LEFT JOIN high_proof g ON g.t = p.t),
told AS (SELECT *, list_reduce(list_concat([[CASE WHEN tampered AND n_changed THEN changed ELSE leaf END, '']], steps),
                               lambda a, s: [sha256(CASE WHEN s[2] = '1' THEN s[1] || a[1] ELSE a[1] || s[1] END), ''])[1] AS folded_root
         FROM (SELECT *, changed IS NOT NULL AS n_changed FROM proof))
SELECT doc_id, leaf, subroot.h AS subroot, high.h AS root, sha256(siblings) AS proof_sha256, folded_root, folded_root = high.h AS verified
FROM told JOIN subroot USING (t) JOIN high ON high.n = 1"""


def oracle_sql() -> dict[str, str]:
    return {"op4_superkmer": SUPERKMER, "op5_winnowing": WINNOWING, "op9_hyperminhash": HYPERMINHASH, "op10_licenses": LICENSES, "op11_runs": RUNS, "op12_chat": CHAT, "op13_merkle": MERKLE}
