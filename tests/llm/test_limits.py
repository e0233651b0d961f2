"""Texts that are long in awkward ways, and buckets of one key."""

import collections
import random
import time

import data
import numpy as np
import plain
import pyarrow as pa
import pytest

from adcube.llm import personal, superkmer, toxicity
from adcube.llm.common import gram_hashes


@pytest.mark.parametrize("text, n", [
    (" ".join(f"user{i}@host{i}.example ask him now" for i in range(50_000)), 50_000),
    ("1" * 1_000_000, 0),
    ("1.2.3." * 100_000, 75_000),
    ("+1((((" * 100_000, 0),
    ("a@" * 300_000, 0),
    ("x" * 1_000_000 + " a@b.cc " + "y" * 1_000_000, 1),
])
def test_personal_data_of_long_texts_in_linear_time(text, n):
    begin = time.monotonic()
    found = personal.entities(text)
    assert len(found) == n
    if found:
        personal.beside(text, found)
    assert time.monotonic() - begin < 5


def test_terms_beside_entities_by_definition():
    text = "one a@b.cc two c@d.ee x@y.zz three " + "w" * 300 + " four 10.0.0.1 Five five@x.yy"
    found = personal.entities(text)
    of, _, term, start, end, names = personal.beside(text, found)
    words = [(m.start(), m.end()) for m in personal._TERM.finditer(text)]
    inside = lambda a, b: any(s < b and a < e for s, _, e, _ in found)
    expected = []
    for k, (s, _, e, _) in enumerate(found):
        left, right = [w for w in words if w[1] <= s][-personal.AROUND:], [w for w in words if w[0] >= e][: personal.AROUND]
        expected += [(k, *w) for w in left + right if not inside(*w)]
    assert list(zip(of.tolist(), start.tolist(), end.tolist())) == expected
    assert [names[t] for t in term] == [text[a:b].lower() for _, a, b in expected]


@pytest.mark.parametrize("hot", [superkmer.HOT, 50])
def test_long_periodic_texts_are_cut_into_pieces(llm, monkeypatch, hot):
    prose = data.prose(400, 5)
    rows = [(1, "ab cd " * 150_000), (2, prose), (3, data.prose(30, 6) + " " + prose[:900] + " tail"), (4, "q " * 5000 + prose)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in superkmer.remove_repeats(docs, hot=hot).select("doc_id", "n_words", "n_removed").collect()}
    assert found == {r[:3] for r in plain.repeats(rows)}
    bits = np.full(1 << 20, ~np.uint64(0))
    sc = llm.sparkContext
    whole = superkmer.documents(docs)
    packed = superkmer.packed(whole, sc.broadcast(bits), sc.broadcast(bits), 35, 5, 26)
    assert packed.selectExpr("max(n)").first()[0] <= superkmer.PIECE + 34


def test_single_passages_stay_where_the_corpus_outgrows_the_bitmap(llm, monkeypatch):
    """Only repeated minimisers are in the bitmap, however many others share its bits."""
    prose = data.prose(60, 7)
    rows = [(i, data.prose(300, 100 + i) + (" " + prose if i < 2 else "")) for i in range(40)]
    kept, stored = [], superkmer.stored
    monkeypatch.setattr(superkmer, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in superkmer.remove_repeats(docs, bits=8).select("doc_id", "n_words", "n_removed").collect()}
    assert found == {r[:3] for r in plain.repeats(rows)}
    every = superkmer.slots(superkmer.documents(docs), 35, 5)
    sent = kept[1].count()
    assert 0 < sent < 0.1 * every.count()


def test_bitmaps_grow_with_the_repeated_minimisers():
    assert superkmer.bits_for(0) == superkmer.bits_for(1_000_000) == superkmer.BITS
    assert superkmer.bits_for(10_000_000) == 27
    assert superkmer.bits_for(10**12) == superkmer.MOST


@pytest.mark.parametrize("values", [0, 3])
def test_repeated_windows_by_definition(values):
    """Also where different windows have equal hashes (``values`` of them only)."""
    digest = (lambda h, n: gram_hashes(h, n) % np.uint64(values)) if values else gram_hashes
    for seed in range(60):
        r = random.Random(seed)
        window = r.choice([2, 3, 5])
        texts = sorted({" ".join(r.choice("abcd") for _ in range(r.randint(window, 12))) for _ in range(r.randint(1, 12))})
        copies = np.array([r.choice([1, 1, 2]) for _ in texts])
        cut = [[tuple(t.split()[k : k + window]) for k in range(len(t.split()) - window + 1)] for t in texts]
        times = collections.Counter(w for ws, n in zip(cut, copies) for w in ws for _ in range(n))
        expected = [(i, k) for i, ws in enumerate(cut) for k, w in enumerate(ws) if times[w] > 1]
        runs = superkmer.repeated_runs(pa.array([t.encode() for t in texts], pa.binary()), copies, window, digest)
        assert [(i, k) for i, a, b in zip(*runs) for k in range(a, b + 1)] == expected


def test_features_are_those_that_tell_the_classes_apart(llm):
    """All of them, whatever their number; those of both classes are none."""
    bad = [(i, f"{data.prose(20, i)} zorkian {i}") for i in range(60)]
    good = [(100 + i, f"{data.prose(20, 100 + i)} pleasant {i}") for i in range(60)]
    docs = llm.createDataFrame(bad + good, "doc_id long, text string")
    labels = llm.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good], "doc_id long, toxic int")
    few, many = toxicity.train(docs, labels), toxicity.train(docs, labels, significant=0.5)
    slots = toxicity.slots(np.frombuffer(b" zorkian ", np.uint8), np.array([0, 9]))[1]
    assert (few.weights[slots] > 0).all()
    assert (many.weights != 0).sum() > (few.weights != 0).sum() > 5
    new = llm.createDataFrame([(1, "so zorkian it is"), (2, "so pleasant it is")], "doc_id long, text string")
    assert [r.score > 0.5 for r in toxicity.classify(new, few).orderBy("doc_id").collect()] == [True, False]


def test_fit_is_the_minimum(llm):
    """At the fitted weights the gradient of the sum of log losses and the penalty is 0."""
    r = np.random.default_rng(1)
    x = np.where(r.random((60, 9)) < 0.3, r.normal(size=9), 0)
    y = (r.random(60) < 1 / (1 + np.exp(-x.sum(1)))).astype(int)
    rows = [(int(t), np.nonzero(v)[0].tolist(), v[np.nonzero(v)].tolist()) for t, v in zip(y, x)]
    w, b = toxicity.fit(llm.createDataFrame(rows, "label int, place array<int>, value array<double>"), 9, 60)
    error = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(x.T @ error + toxicity.PENALTY * w).max() < 1e-2 and abs(error.sum()) < 1e-2
    assert np.abs(w).max() > 0.1
