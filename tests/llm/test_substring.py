import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from corpus_support import make_docs, rows_of, words_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import repeats, substring


def brute(rows):
    """Result by doc_id and text, from all windows."""
    low = {}
    for doc_id, text in rows:
        w = words_of(text)
        for i in range(len(w) - 12 if doc_id is not None else 0):
            key = tuple(w[i : i + 13])
            low[key] = min(low.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - 12 if doc_id is not None else 0):
            if low[tuple(w[i : i + 13])] < doc_id:
                gone.update(range(i, i + 13))
        kept = [x for i, x in enumerate(w) if i not in gone]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        out.append((str(doc_id), len(w), len(gone), digest))
    return sorted(out)


def check(make_docs, rows):
    got = rows_of(substring.without_repeats(make_docs(rows)))
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)
    assert found == brute(rows)


SEQUENCES = st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=5)


@settings(max_examples=200, deadline=None)
@given(SEQUENCES, st.lists(st.integers(0, 2), max_size=12), st.integers(1, 4))
def test_matches(known, asked, least):
    """The longest match at every word, and the smallest document of its end."""
    automaton = substring.SuffixAutomaton()
    docs = [(7 * i) % 5 for i in range(len(known))]
    for sequence, doc in zip(known, docs):
        automaton.add(sequence, doc)
    automaton.finish()
    low = {(): 0}
    for s, doc in zip(known, docs):
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                low[tuple(s[i:j])] = min(low.get(tuple(s[i:j]), substring.NO_DOC), doc)
    want = []
    for end in range(1, len(asked) + 1):
        longest = max(n for n in range(end + 1) if tuple(asked[end - n : end]) in low)
        doc = low[tuple(asked[end - least : end])] if longest >= least else substring.NO_DOC
        want.append((longest, doc))
    assert automaton.matches(asked, least) == want


def corpus():
    """Passages in several surroundings and lengths, copies, near copies, a common line."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(60)}"
    passages = [[word() for _ in range(n)] for n in (12, 13, 14, 30, 60, 200)]
    line = [f"line{i}" for i in range(15)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(30))]
            source = rng.choice(passages)
            begin = rng.randrange(max(1, len(source) - 10))
            text += source[begin : begin + rng.randrange(1, 80)]
        if i % 3 == 0:
            text += line + [f"own{i}"]
        rows.append((rng.randrange(400), " ".join(text)))
    base = [word() for _ in range(150)]
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(150)] = f"edit{i}"
        rows.append((1000 + i, " \n".join(copy)))
    rows += [(2000 + i, rows[3][1]) for i in range(5)]
    return rows


@pytest.mark.parametrize("common", [8, 1, 10_000])
def test_equals_all_windows(make_docs, monkeypatch, common):
    """Over several shards, with common grams, all grams and none told apart."""
    monkeypatch.setattr(substring, "SHARD_TEXT_BYTES", 20_000)
    monkeypatch.setattr(substring, "COMMON", common)
    check(make_docs, corpus())


def test_a_small_filter_changes_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_BITS", 9)
    monkeypatch.setattr(repeats, "LEAST_BITS", 9)
    monkeypatch.setattr(repeats, "BLOCK_BITS", 4)
    check(make_docs, corpus())


def test_common_lines_are_no_anchors_of_their_surroundings(make_docs):
    """A line in all documents has as many different segments as places in it, not as
    there are documents around it."""
    line = " ".join(f"line{i}" for i in range(12))
    rows = [(i, f"a{i} b{i} c{i} {line} d{i} e{i} f{i} g{i}") for i in range(200)]
    texts = make_docs(rows).select("text").coalesce(1)
    heat = substring._heat(texts)
    batch = pa.RecordBatch.from_arrays([pa.array([text for _, text in rows])], names=["text"])
    counts = Counter(substring._anchors(heat)(batch).tolist())
    assert max(counts.values()) == 1


def test_edge_cases(make_docs):
    text = " ".join(f"w{i % 50}" for i in range(100))
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, text), (5, text), (6, text + " End"),
        (7, text.upper()), (None, text), (None, None), (8, long), (9, "x " + long),
        (10, "a " * 40), (11, "a " * 13),
    ]
    check(make_docs, rows)


def test_empty_table(make_docs):
    assert rows_of(substring.without_repeats(make_docs([]))) == []
