import hashlib
import random
import zlib

import pytest
from corpus_support import rows_of

from martloom.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string, node string, depth string, place string"


def make(spark, rows):
    full = [(*row, "x", "y", "z") for row in rows]
    return spark.createDataFrame(full, TURNS).repartition(3)


def brute(rows):
    given = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            key = (turn is not None, turn or 0, digest)
            given.setdefault(conv_id, []).append((key, role, text))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in given.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        sequence = tuple(own.get(donor, [])[:h] + turns[h:])
        for d in range(len(sequence) + 1):
            members.setdefault(sequence[:d], []).append(c)
        ends.setdefault(sequence, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saved + sum(saved[x] for x in below)
    out = []
    for node, convs in members.items():
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ids.encode()).hexdigest()
        out.append((min(convs), len(node), str(parent), len(convs), len(children.get(node, [])),
                    leaves[node], saved[node], digest))
    return sorted(out)


def check(spark, rows):
    got = rows_of(prefix_trie.prefix_trie(make(spark, rows)))
    names = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    found = [(r["conv_id"], r["depth"], str(r["parent_conv_id"]), *(r[n] for n in names)) for r in got]
    assert sorted(found) == brute(rows)


def conversations():
    """Few different turns, so that prefixes are shared at all depths; some are deep."""
    rng = random.Random(4)
    rows = []
    deep = [rng.choice("ab") for _ in range(60)]
    for c in range(260):
        n = rng.choice([1, 2, 3, 6, 9, 17])
        texts = [rng.choice("ab") * (1 + i % 3) for i in range(n)]
        if c % 9 == 0:
            texts = deep[: rng.randrange(5, 60)] + texts[:2]
        if c % 3 == 0:
            texts = ["same", "first", "turns"] * 4
        if c not in (100, 101):
            rows += [(c, t, rng.choice(["user", "user", None]), x) for t, x in enumerate(texts)]
    return rows


@pytest.mark.parametrize("piece", [16, 2, 3])
def test_equals_brute_force(spark, monkeypatch, piece):
    """With pieces of several sizes, so that the recursion has up to six levels."""
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "JOINED", 4)
    check(spark, conversations())


def test_edge_cases(spark):
    rows = [
        (None, 0, "user", "no conversation"), (5, None, None, None), (5, None, "user", ""),
        (5, 0, "", "user"), (5, 0, "user", "x"), (5, 0, "user", "x"), (6, 7, "a", "b" * 100_000),
        (-3, 1, "user", "x"), (-103, 1, "user", "x"), (-100, 0, "user", "x"), (100, 0, "us", "er1"),
        (101, 0, "user", "1"), (101, 1, "user", "1"), (102, 0, "q", "\U0001f600é"),
        (2**62, 0, "user", "x"), (7, -1, "user", "x"),
    ]
    check(spark, rows)


def test_conversations_left_without_turns(spark):
    """Their first one is absent and takes more turns than they have."""
    short = [c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 > 2 and c % 100][:4]
    check(spark, [(c, t, "user", "x") for c in short for t in range(2)])


def test_one_turn(spark):
    check(spark, [(6, 0, "user", "x")])


def test_empty_table(spark):
    assert rows_of(prefix_trie.prefix_trie(make(spark, []))) == []
