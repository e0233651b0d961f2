"""The registered queries over the smallest test tables, against plain versions."""

from collections import Counter

import plain
import pytest
from data import SF

from adcube.llm import queries


def result(llm, n):
    name = next(q for q in queries.QUERIES if q.startswith(f"op{n}_"))
    return queries.QUERIES[name](llm, SF)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_op2(llm, whole):
    found = result(llm, 2).collect()
    base = {i: plain.personal(t) for i, t in whole[0]}
    assert Counter((r.doc_id, r.base_sha256) for r in found) == Counter((i, plain.sha(s)) for i, s in base.items())
    for r in found:
        assert [x for x in r.spans.split(",") if not x.startswith("term")] == base[r.doc_id].split(",")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(base[r.doc_id].count(f"{k}:") for k in ("email", "ip", "card", "phone"))


def test_op3(llm, whole):
    found = result(llm, 3).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == Counter(plain.unigram(whole[0]))
    bits = -sum(r.score for r in found if r.held_out) / 0.30103 / sum(r.n_bytes for r in found if r.held_out)
    assert 1.5 < bits < 3


def test_op4(llm, whole):
    assert rows(result(llm, 4)) == Counter(plain.repeats(whole[0]))


def test_op5(llm, whole):
    assert rows(result(llm, 5)) == Counter(plain.contaminated(*whole))


def test_op6_held_out(llm):
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    found = [r for r in result(llm, 6).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert sum(r.predicted == labels[r.doc_id] for r in found) >= 0.85 * len(found)


def test_op7(llm, whole):
    found = result(llm, 7).collect()
    assert len(found) == len(whole[0]) and all(r.round_trip and r.n_ids == len(r.ids) for r in found)


def test_op8(llm, whole):
    found = result(llm, 8).collect()
    assert Counter(tuple(r)[:7] for r in found) == Counter((i, *plain.quality_counts(t)) for i, t in whole[0])
    assert not any(r.kept and r.base_failed for r in found)
    assert sum(r.kept for r in found) > 0.6 * len(found)


def test_op9(llm, whole):
    assert rows(result(llm, 9)) == Counter(plain.near(whole[0]))


@pytest.mark.parametrize("n", [1, 10])
def test_rows_of_scans(llm, whole, n):
    found = result(llm, n)
    ids = {i for i, _ in whole[0]}
    assert {r.doc_id for r in found.select("doc_id").collect()} <= ids
    assert n == 1 or found.count() == len(whole[0])
