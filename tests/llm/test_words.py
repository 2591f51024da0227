import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm.words import grams, shingles, split_words, text_slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab A\t\n\x0b\x85 é.", max_size=40)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_follow_the_pattern(texts):
    words = split_words(texts, lower=False)
    for t, text in enumerate(texts):
        found = [words.word(i).decode() for i in range(words.first[t], words.first[t + 1])]
        assert found == re.findall("[^\\x20\\x09-\\x0D]+", text or "")


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingles_are_the_distinct_sequences(texts):
    values, first = shingles(split_words(texts, lower=True), 3)
    known = {}
    for t, text in enumerate(texts):
        w = [x.encode().lower() for x in re.findall("[^\\x20\\x09-\\x0D]+", text or "")]
        want = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}
        got = set(values[first[t] : first[t + 1]].tolist())
        assert len(got) == len(want) == first[t + 1] - first[t]
        for other, (hashes, sets) in known.items():
            assert len(hashes & got) == len(sets & want)
        known[t] = (got, want)


def test_equal_words_have_equal_hashes_wherever_they_stand():
    long = "x" * 3_000_000
    words = split_words([f"alpha {long} alpha", None, "alpha beta", long], lower=False)
    hashes = words.hashes
    assert hashes[0] == hashes[2] == hashes[3] and hashes[1] == hashes[5]
    assert len(np.unique(hashes)) == 3
    whole = grams(words, 2)[1]
    assert whole.tolist() == [True, True, False, True, False, False]


def test_slices_cover_all_texts():
    texts = ["a" * n for n in (5, 0, 100, 1, 1)] + [None]
    parts = [i for s in text_slices(texts, 20) for i in range(s.start, s.stop)]
    assert parts == list(range(6)) and list(text_slices([])) == []
