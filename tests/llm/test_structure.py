"""Periodic runs, conversations and Merkle manifests against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import data
import numpy as np
import pytest
from plain import sha, words
from pyspark.sql import functions as F

from adcube.llm import chat, merkle, queries, runs


# -------------------------------------------------------------------- 11 runs

def plain_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def plain_kept(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def solved(texts):
    """Runs of lists of numbers, by the tiles alone."""
    base = np.cumsum([0, *(len(t) + 1 for t in texts)])
    w = np.array([x for k, t in enumerate(texts) for x in [*t, -1 - k]], np.int64)
    q, a, b = runs.solve(w, max(map(len, texts)))
    doc = np.searchsorted(base, a, "right") - 1
    key, a, b = runs.merged(doc * (len(w) + 1) + q, a, b)
    out = [[] for _ in texts]
    for (d, q), a, b in zip((divmod(int(k), len(w) + 1) for k in key), a, b):
        if b - a + q >= max(6, 4 * q):
            out[d].append((int(a - base[d]), int(b - a + q), q))
    return [sorted(o) for o in out]


def with_repeats(r):
    t = [r.randint(0, r.choice([0, 1, 2, 4, 30])) for _ in range(r.randint(0, 150))]
    for _ in range(r.randint(0, 4)):
        if len(t) > 3:
            a = r.randrange(len(t))
            p = r.randint(1, max(1, (len(t) - a) // 3))
            for i in range(a + p, r.randint(a, len(t))):
                t[i] = t[i - p]
    return t


def test_tiles_find_the_runs_of_random_texts():
    r = random.Random(11)
    for _ in range(300):
        texts = [with_repeats(r) for _ in range(r.randint(1, 5))]
        assert solved(texts) == [plain_runs(t) for t in texts]


def test_false_hash_hits_are_compared(monkeypatch):
    """Hashes of one bit let nearly everything through; results stay."""
    monkeypatch.setattr(runs, "mix", lambda x: x & np.uint64(1))
    r = random.Random(12)
    for _ in range(60):
        texts = [with_repeats(r) for _ in range(3)]
        assert solved(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("period", [1, 3, 100_000])
def test_long_periodic_texts_make_few_parts(period):
    w = np.append(np.random.default_rng(1).integers(0, 1 << 40, period)[np.arange(1_000_000) % period], -1)
    q, a, b = runs.solve(w, len(w) - 1)
    assert set(q.tolist()) == {period} and len(q) <= 2 * len(w)
    _, a, b = runs.merged(q, a, b)
    assert (a.tolist(), b.tolist()) == ([0], [1_000_000 - period])


def test_collapse_of_awkward_rows(llm):
    more = [(30, "a b " * 40), (30, "a b " * 40), (31, " ".join("a a a a a a b".split() * 9)), (None, "x " * 7), (32, "x\x0by\tx y x y x y"), (33, "é é é é é é ü")]
    docs = data.documents(llm).select("doc_id", "text", "lang", "n_words").unionByName(llm.createDataFrame([(i, t, None, "clash") for i, t in more], "doc_id long, text string, lang string, n_words string"))
    found = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept) for r in runs.collapse(docs).collect())
    expected = Counter()
    for i, t in [*data.texts(), *more]:
        w = words(t)
        of = plain_runs(w) if len(w) < 5000 else solved([np.unique(w, return_inverse=True)[1].tolist()])[0]
        expected[i, len(w), tuple(of), plain_kept(w, of)] += 1
    assert found == expected
    assert runs.collapse(data.no_documents(llm)).collect() == []


def test_parts_of_many_slabs_are_stitched(llm):
    rows = [(1, 7, 2, 0, 5), (1, 7, 2, 5, 9), (1, 7, 2, 4, 6), (1, 7, 2, 11, 13), (1, 7, 3, 0, 9), (None, 7, 1, 3, 8), (None, 7, 1, 8, 20)]
    parts = llm.createDataFrame(rows, "doc_id long, text_key long, period long, first long, stop long").repartition(4)
    assert {(r.doc_id, tuple(map(tuple, r.runs))) for r in runs.stitched(parts).collect()} == {(1, ((0, 11, 2), (0, 12, 3))), (None, ((3, 18, 1),))}


def test_op11(llm, whole):
    expected = {}
    for i, t in whole[0]:
        g, rest = divmod(zlib.crc32(str(i).encode()), 10)
        w = words(t)
        if not rest and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        found = plain_runs(w) if len(w) < 3000 else solved([np.unique(w, return_inverse=True)[1].tolist()])[0]
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        expected[i] = (len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(plain_kept(w, found)))
    got = {r[0]: tuple(r)[1:] for r in queries.op11_runs(llm, data.SF).collect()}
    assert got == expected and sum(r[0] > 0 for r in got.values()) > 5


# -------------------------------------------------------------------- 12 chat

AWKWARD = ["", " ", "\n\nx \n", "<|im_end|>", "<\\|im_sep|><\\\\|x", "<", "|im_end|>", "<|endoftext|>", "a<|im_start|", "é日本🎈 naïve", "\\<|\\|", "x" * 5000, "tab\t  end "]


def test_escaping_is_reversible():
    r = random.Random(3)
    for _ in range(3000):
        t = "".join(r.choice(["<", "|", "\\", "im_end", "|>", "<|", "a", " "]) for _ in range(r.randint(0, 12)))
        assert chat.unescaped(chat.escaped(t)) == t and "<|" not in chat.escaped(t)


def conversations(llm):
    rows = [(1, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(AWKWARD)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", "same turn"), (2, None, "system", "first"), (3, 5, None, "no role"), (3, 6, "<|im_sep|>", "odd role"), (None, 0, "user", "no id"), (None, 1, "assistant", "either"), (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice")]
    rows += [(5, k, ["user", "assistant"][k % 2], f"turn {k} " + data.prose(20, k)) for k in range(300)]
    return rows, llm.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, ids string, part string").repartition(5)


def plain_chat(rows):
    out = {}
    for i in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == i))
        pairs = [t[2:] for t in turns]
        loss = "".join(t for r, t in pairs if r == "assistant")
        size = sum(32 + len(chat.escaped(r)) + len(chat.escaped(t)) for r, t in pairs)
        out[i] = (len(pairs), sha("".join(f"{r}\n{t}\n" for r, t in pairs)), len(loss), sha(loss), size)
    return out


@pytest.mark.parametrize("limit", [100, chat.SEGMENT])
def test_conversations_are_read_back_whatever_the_segments(llm, limit):
    rows, table = conversations(llm)
    encoded = chat.encode(table, limit=limit)
    found = {r[0]: tuple(r)[1:] for r in chat.digests(chat.read_back(encoded)).collect()}
    assert found == plain_chat(rows)
    parts = {}
    for r in encoded.orderBy("part").collect():
        parts.setdefault(r.conv_id, []).append(r)
        assert [r.text[s.first : s.end] for s in r.turns] == [chat.escaped(t) for _, t in chat.parsed(r.text)]
    assert (len(parts[5]) > 50) == (limit == 100)
    # Cut or not, a conversation has the ids of its whole string.
    for held in parts.values():
        assert [i for r in held for i in r.ids] == chat.tokenizer().encode("".join(r.text for r in held), add_special_tokens=False).ids


def test_masks_are_the_tokens_inside_the_spans():
    known = chat.tokenizer()
    for turns in ([("assistant", t) for t in AWKWARD], [("user", "a"), ("assistant", ""), ("assistant", "é é")]):
        text, spans, _ = chat.rendered(turns)
        e = known.encode(text, add_special_tokens=False)
        places = np.array(e.offsets)
        for (a, b), (first, end) in zip(spans, chat.masks(places[:, 0], places[:, 1], spans)):
            assert [k for k, (x, y) in enumerate(e.offsets) if a <= x and y <= b and x < y] == list(range(first, end))


def test_no_conversations(llm):
    empty = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.read_back(chat.encode(empty))).collect() == []


def test_one_very_long_turn(llm):
    long = data.prose(200_000, 9)
    table = llm.createDataFrame([(1, 0, "assistant", long), (1, 1, "assistant", "y" * 300_000)], "conv_id long, turn long, role string, text string")
    r = chat.digests(chat.read_back(chat.encode(table))).first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(long) + 300_000, sha(long + "y" * 300_000))


# ------------------------------------------------------------------ 13 merkle

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root, and each leaf's siblings."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            if i ^ 1 < len(nodes):
                ways[k].append(nodes[i ^ 1])
        nodes, at = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return (nodes or [None])[0], ways


def plain_manifest(rows):
    """``(key, id, digest)`` to ``(key, id, digest, subroot, root, siblings)``."""
    groups = {}
    for key, i, d in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(key, []).append((i, d))
    trees = {k: plain_tree([d for _, d in g]) for k, g in groups.items()}
    root, up = plain_tree([t[0] for t in trees.values()])
    return [(k, i, d, trees[k][0], root, tuple(w + u)) for (k, g), u in zip(groups.items(), up) for (i, d), w in zip(g, trees[k][1])]


@pytest.mark.parametrize("every", [1, 3, merkle.EVERY])
def test_proofs_by_kept_levels(llm, every):
    rows = [(None, 1), (None, None), ("a", 5), ("b", 1), ("b", 1), ("b", None)] + [("c", k * 7 % 101) for k in range(101)] + [("d", k) for k in range(64)] + [("é", 3), ("zz", 2)]
    rows = [(k, i, h(str(i)) if i != 1 else h("one")) for k, i in rows]
    table = llm.createDataFrame([(*r, "x", "y") for r in rows], "lang string, doc_id long, digest string, path string, key string").repartition(5)
    m = merkle.manifest(table, every=every)
    found = merkle.proofs(m).withColumn("again", merkle.folded(F.col("digest"), "path")).collect()
    assert Counter((r.key, r.row.doc_id, r.digest, r.subroot, r.root, tuple(s.digest for s in r.path if s.digest)) for r in found) == Counter(plain_manifest(rows))
    assert all(r.again == r.root and r.row.path == "x" for r in found)
    # Only every few levels are kept, in blocks of bounded size.
    assert len(m.groups.levels) == max(1, -(-7 // every))
    assert max(r.n for level in m.groups.levels for r in level.select(F.size("nodes").alias("n")).collect()) <= 2**every


def test_one_leaf_and_none(llm):
    schema = "lang string, doc_id long, digest string"
    r = merkle.proofs(merkle.manifest(llm.createDataFrame([("en", 1, h("x"))], schema))).first()
    assert (r.subroot, r.root, r.path) == (h("x"), h("x"), [])
    empty = merkle.manifest(llm.createDataFrame([], schema))
    assert merkle.proofs(empty).collect() == [] and empty.root.collect() == []


def test_leaf_text_of_nulls(llm):
    r = llm.createDataFrame([(1, None, "é")], "a long, b string, c string").select(merkle.leaf(F.col("a"), F.col("b"), F.col("c"))).first()
    assert r[0] == h("1:1", "-", "2:é")


def test_op13_tampering_shows(llm):
    found = queries.op13_merkle(llm, data.SF).collect()
    docs = {r.doc_id: r for r in llm.read.parquet(f"{data.SF}/documents.parquet").collect()}
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    rows = [(r.lang, i, h(*(field(r[c]) for c in merkle.FIELDS))) for i, r in docs.items()]
    expected = {i: (d, sub, root, h(*way)) for _, i, d, sub, root, way in plain_manifest(rows)}
    assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256) for r in found} == expected
    for r in found:
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and docs[r.doc_id].n_chars is not None
        assert r.verified == (not tampered) == (r.folded_root == r.root)
    assert re.fullmatch("[0-9a-f]{64}", found[0].folded_root)
