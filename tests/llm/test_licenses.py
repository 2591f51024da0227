import random
import textwrap

import numpy as np
from corpus_support import TESTDATA, make_docs, rows_of  # noqa: F401

from martloom.llm import licenses


def test_template_fit_is_the_longest_common_order():
    one = dict.fromkeys(range(10), 1.0)
    assert licenses._in_order([1, 2, 3, 4], [9, 1, 3, 8, 4], one) == 0.75
    assert licenses._in_order([1, 2], [2, 1], one) == 0.5
    assert licenses._in_order([1], [], one) == 0.0
    assert licenses._in_order([1, 2], [2], {1: 1.0, 2: 3.0}) == 0.75


def prose(rng, n=12):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def test_licences_unknown_ones_and_ordinary_text(make_docs):
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng) for _ in range(5))) for i in range(200)]
    planted = {
        1000: ("Released under the MIT License.", "MIT"),
        1001: ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!!", "Apache"),
        1002: ("w1 This work is licensed under the GNU General Public License version 3 w2", "GPL"),
        1003: ("All rights reserved.", "Proprietary"),
        1004: ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    }
    rows += [(i, f"{prose(rng)}\n{line}\n{prose(rng)}") for i, (line, _) in planted.items()]
    rows += [(1100, prose(rng) + "\nThis work is licensed under the terms of the Strange Zebra Pact")]
    rows += [(1, None), (1, ""), (1, "\n\n \n"), (None, "Released under the MIT License.")]
    rows += [(1200, "\n".join([prose(rng, 30)] * 3000 + ["Released under the MIT License."]))]
    got = rows_of(licenses.scan(make_docs(rows)))
    families = {(r["doc_id"], r["paragraph"]): r["family"] for r in got}
    want = {(i, 1): family for i, (_, family) in planted.items()}
    want |= {(None, 0): "MIT", (1200, 3000): "MIT"}
    assert {k: v for k, v in families.items() if v != licenses.UNKNOWN} == want
    assert families.keys() - want.keys() <= {(1100, 1)}
    assert all(0 <= r["probability"] <= 1 and 0 <= r["template_fit"] <= 1 for r in got)


NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software"
    " without restriction, including without limitation the rights to use, copy, and sell",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met: 1. Redistributions of source",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the"
    " terms of the GNU General Public License as published by the Free Software Foundation,"
    " either version 3 of the License, or (at your option) any later version.",
}
OTHERS = (
    "ISC License",
    "This file is in the public domain",
    "Licensed under the Artistic License 2.0.",
    "This project is licensed under the Academic Free License.",
    "Distributed under the Open Software License, version 3.0.",
)


def test_wrapped_notices_and_licences_without_a_template(make_docs):
    """Each wrapped notice carries its family, in lines of comments and of any width; other
    licences are unknown ones; ordinary text stays unreported."""
    rng = random.Random(5)
    rows = [(i, "\n".join(prose(rng) for _ in range(6))) for i in range(200)]
    want, at = {}, 1000
    for family, text in NOTICES.items():
        for width in (50, 60, 66, 72):
            for mark in ("", "// ", " * ", "# "):
                lines = [mark + line for line in textwrap.wrap(text, width)]
                rows.append((at, "\n".join([prose(rng), mark.strip(), *lines, "", prose(rng)])))
                want[at] = family
                at += 1
    rows += [(2000 + i, f"{prose(rng)}\n\n{line}\n\n{prose(rng)}") for i, line in enumerate(OTHERS)]
    # A notice within one very long line.
    rows.append((3000, prose(rng, 900) + " " + NOTICES["BSD"] + " " + prose(rng, 900)))
    want[3000] = "BSD"
    got = rows_of(licenses.scan(make_docs(rows)))
    named = {(r["doc_id"], r["family"]) for r in got if r["family"] != licenses.UNKNOWN}
    assert named == set(want.items())
    unknown = {r["doc_id"] for r in got if r["family"] == licenses.UNKNOWN}
    assert {2000 + i for i in range(len(OTHERS))} <= unknown <= {*want, *range(2000, 2010)}
    assert all(r["paragraph"] <= r["last_line"] for r in got)
    spans = sorted((r["doc_id"], r["paragraph"], r["last_line"]) for r in got)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_features_are_words_and_pairs_of_several_texts(monkeypatch):
    """Against plain counting; what is no feature still counts in a text's length."""
    monkeypatch.setattr(licenses, "LEAST_TEXTS", 2)
    texts = ["a b a b", "b a, c", "C", "", "z"]
    features = licenses.Features.of(texts)
    feature, owner, values = features.vectors(licenses._split([*texts, "b a new"]))
    assert len(features) == 4  # a, b, c and "b a"
    sums = np.bincount(owner, values**2, 6)
    # Of "a b a b": a and b twice and "b a" once; "a b" stands twice, in this text alone.
    assert np.allclose(sums, [9 / 13, 4 / 5, 1, 0, 0, 3 / 5])
    assert len(set(zip(feature.tolist(), owner.tolist()))) == len(feature)


def test_many_copies_of_a_line_do_not_shrink_the_sample(make_docs, monkeypatch):
    """99 % of the rows are one text; the sample still holds nearly all different lines."""
    rng = random.Random(6)
    other = [prose(rng) for _ in range(300)]
    seen = []
    altered = licenses.altered
    monkeypatch.setattr(
        licenses, "altered", lambda t, ordinary, seed: seen.extend(ordinary) or altered(t, ordinary, seed)
    )
    monkeypatch.setattr(licenses, "SAMPLE", 400)
    rows = [(i, line) for i, line in enumerate(other)] + [(9, "the same line again")] * 29_700
    licenses.train(make_docs(rows))
    assert len(set(seen) & set(other)) >= 280


def test_windows_cover_every_run_of_lines():
    """Against a plain account: lines, and windows of at most 48 words within a paragraph."""
    rng = random.Random(8)
    for _ in range(30):
        texts = [
            [" ".join(["w"] * rng.choice([0, 3, 8, 8, 20, 48, 130])) for _ in range(rng.randrange(1, 12))]
            for _ in range(3)
        ]
        lines = [line for text in texts for line in text]
        ends = np.cumsum([len(t) for t in texts])
        words = licenses._split(lines)
        found = licenses.windows(words, np.repeat(ends, [len(t) for t in texts]))
        got = list(zip(*(part.tolist() for part in found)))
        assert len(set(got)) == len(got)
        covered = set()
        for a, b, start, end in got:
            assert 0 < end - start <= licenses.WINDOW
            assert words.first[a] <= start and end <= words.first[b + 1]
            assert all(lines[a : b + 1]) and sum(ends <= a) == sum(ends <= b)
            covered.update(range(start, end))
        assert covered == set(range(len(words)))
        # Two neighbouring lines of a paragraph with few words are seen together.
        together = {(i, i + 1) for a, b, _, _ in got for i in range(a, b)}
        for i in range(len(lines) - 1):
            size = words.first[i + 2] - words.first[i]
            if lines[i] and lines[i + 1] and i + 1 not in ends and size <= licenses.WINDOW // 3:
                assert (i, i + 1) in together


def test_empty_table(make_docs):
    assert rows_of(licenses.scan(make_docs([]))) == []


def test_calibration_lowers_the_log_loss():
    rng = np.random.default_rng(0)
    texts = [f"word{i} other{i}" for i in range(60)]
    features = licenses.Features.of(texts * licenses.LEAST_TEXTS)
    weights = rng.normal(size=(2, len(features)))
    scanner = licenses.Scanner([licenses.ORDINARY, "MIT"], features, weights, np.zeros(2))
    labels = [licenses.ORDINARY if i % 2 else "MIT" for i in range(60)]
    truth = np.array([scanner.classes.index(x) for x in labels])

    def loss():
        p = scanner.probabilities(scanner.logits(licenses._split(texts), len(texts)))
        return -np.log(p[np.arange(60), truth]).mean()

    before = loss()
    scanner.calibrate(texts, labels)
    assert loss() <= before and 0.5 <= scanner.threshold <= 1


def test_every_licence_line_of_the_table_and_no_other(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()
    got = {(r["doc_id"], r["paragraph"]) for r in rows_of(licenses.op1_license_scan(spark, f"{TESTDATA}/sf0.01"))}
    want = {
        (r["doc_id"], n)
        for r in docs
        for n, line in enumerate((r["text"] or "").split("\n"))
        if "licen" in line.lower().split(" ")[-2:][0] or "rights reserved" in line.lower()
        or " license" in line.lower() or line.lower().startswith("licensed")
    }
    assert got == want
