"""Fast forms against their plain definitions, on generated texts."""

import re

import numpy as np
import plain
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adcube.llm import common, hyperminhash, personal, pieces, winnowing

settings.register_profile("llm", max_examples=200, deadline=None)
settings.load_profile("llm")

mail = st.text(alphabet="ab.-@_ \n%é", max_size=40)
wordy = st.text(alphabet=" \t\n\x0b\x0c\r abAB9é日.\x00\x1f", max_size=60)


@given(mail)
def test_emails_as_the_pattern_finds_them(text):
    expected = [m.span() for m in re.finditer(plain.PATTERNS[0][1], text)]
    assert personal.emails(text) == expected


@given(st.text(alphabet="0123456789 -.+()", max_size=60))
def test_numbers_as_the_patterns_find_them(text):
    found = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b, _ in personal.entities(text))
    assert found == plain.personal(text)


@given(st.lists(st.one_of(st.none(), wordy), max_size=6), st.integers(1, 64))
def test_words_of_chunks(texts, limit):
    found = []
    for _, _, raw, at in common.chunks(pa.array(texts, pa.string()), limit):
        start, end, word_at = common.find_words(raw, at)
        words = [raw[a:b].tobytes().decode() for a, b in zip(start, end)]
        found += [words[a:b] for a, b in zip(word_at[:-1], word_at[1:])]
        by_hash = {}
        for w, h in zip(words, common.hash_words(raw, start, end).tolist()):
            assert by_hash.setdefault(w, h) == h
        assert len(set(by_hash.values())) == len(by_hash)
    assert found == [plain.words(t) for t in texts]


@given(st.lists(wordy, min_size=1, max_size=4))
def test_test_words(texts):
    for text in texts:
        r = winnowing.Reader(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), 10, 5)
        assert [r.raw[a:b].tobytes().decode() for a, b in zip(r.start, r.end)] == plain.test_words(text)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_min(values, n):
    a = np.array(values, np.uint64)
    if len(a) >= n:
        assert common.sliding_min(a, n).tolist() == [min(values[k : k + n]) for k in range(len(values) - n + 1)]


@given(st.lists(st.integers(0, 3), min_size=10, max_size=60))
def test_every_window_keeps_a_fingerprint(values):
    grams, span = np.array(values, np.uint64), 6
    kept = set(winnowing.winnow(grams, np.arange(len(values) - span + 1), span).tolist())
    assert all(kept & set(range(k, k + span)) for k in range(len(values) - span + 1))


@given(wordy)
def test_shingle_counts(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    assert len(hyperminhash.shingle_sets(raw, np.array([0, len(raw)]))[0]) == len(plain.shingles(text))


VOCABULARY = pieces.load()


@given(st.lists(st.text(max_size=30), max_size=4))
def test_ids_decode_to_the_text(texts):
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, id_at = pieces.encode_chunk(data, at, VOCABULARY)
    again, again_at = pieces.decode_chunk(ids, id_at, VOCABULARY)
    assert again.tobytes() == data.tobytes() and again_at.tolist() == at.tolist()
