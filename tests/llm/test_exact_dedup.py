import hashlib
import random
import re

import pytest
from corpus_support import make_docs, rows_of  # noqa: F401

from martloom.llm import exact_dedup, repeats


def brute(rows):
    groups = {}
    for at, (doc_id, text, *_) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        rank = (-len(text or ""), doc_id is None, doc_id or 0, at)
        groups.setdefault(plain, []).append((rank, doc_id))
    out = []
    for plain, members in groups.items():
        best = min(members)
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(str(d), str(best[1]), len(members), (r, d) == best, digest) for r, d in members]
    return sorted(out)


def check(make_docs, rows):
    got = rows_of(exact_dedup.copies(make_docs(rows)))
    names = ("group_size", "kept", "text_sha256")
    found = [(str(r["doc_id"]), str(r["keep_id"]), *(r[n] for n in names)) for r in got]
    assert sorted(found) == brute(rows)


def corpus():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(6))) for _ in range(300)]
    rows = []
    for _ in range(900):
        text = rng.choice(texts)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(" \t\n\x0b\x0c\r") + text[at:]
        rows.append((rng.randrange(5000), text))
    return rows


def test_equals_brute_force(make_docs):
    check(make_docs, corpus())


def test_a_third_of_all_rows_is_one_text(make_docs):
    check(make_docs, corpus() + [(9000 - i, "same\ttext" + " " * (i % 3)) for i in range(450)])


def test_edge_cases(make_docs):
    long = "word " * 100_000
    rows = [
        (1, None), (2, ""), (3, " \t\r\n"), (None, None), (None, "a b"), (4, "ab"), (4, "ab"),
        (4, "a b"), (5, "AB"), (6, "a b"), (7, "été"), (8, "é té"),
        (9, "été"), (10, long), (11, long.replace(" ", "")), (12, "a\x1cb"), (13, "\U0001f600 x"),
        (14, "\U0001f600x"), (None, "q"), (None, "q"),
    ]
    check(make_docs, rows)


def test_empty_table(make_docs):
    assert rows_of(exact_dedup.copies(make_docs([]))) == []
    assert rows_of(exact_dedup.without_copies(make_docs([]))) == []


def test_rows_that_stay_keep_all_columns(make_docs):
    rows = corpus() + [(None, None), (None, ""), (7, "x y"), (7, "x y")]
    docs = make_docs(rows)
    kept = exact_dedup.without_copies(docs)
    assert kept.schema == docs.schema
    got = sorted((str(r["doc_id"]), hashlib.sha256(re.sub(r"\s", "", r["text"] or "").encode()).hexdigest())
                 for r in rows_of(kept))
    assert got == sorted((d, sha) for d, _, _, stays, sha in brute(rows) if stays)


@pytest.mark.parametrize("most_bits", [29, 16, 10])
def test_filter_misses_no_repeated_key(spark, monkeypatch, most_bits):
    """A smaller filter only takes more single keys for repeated ones."""
    monkeypatch.setattr(repeats, "MOST_BITS", most_bits)
    monkeypatch.setattr(repeats, "LEAST_BITS", min(most_bits, 16))
    monkeypatch.setattr(repeats, "BLOCK_BITS", min(8, most_bits - 4))
    keys = [random.Random(i).getrandbits(64) - 2**63 for i in range(6000)] + [5] * 2000
    keys += keys[:300]
    rows = spark.createDataFrame([(k,) for k in keys], "key bigint").repartition(5)
    known = repeats.repeated_filter(rows, len(keys))
    told = rows.withColumn("repeated", repeats.may_repeat(known, "key")).collect()
    repeated = {k for k in keys[:300]} | {5}
    assert all(r["repeated"] for r in told if r["key"] in repeated)
    wrong = sum(r["repeated"] for r in told if r["key"] not in repeated)
    assert most_bits < 16 or wrong < (60 if most_bits == 29 else 600)


def test_filter_size_is_bounded():
    assert repeats.filter_bits(0) == repeats.LEAST_BITS
    assert repeats.filter_bits(10**12) == repeats.MOST_BITS
    assert 1 << repeats.filter_bits(10**6) >= repeats.BITS_PER_KEY * 10**6
