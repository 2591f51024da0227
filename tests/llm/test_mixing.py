from collections import defaultdict

from pyspark.sql import functions as F

from corpus_support import make_docs, rows_of  # noqa: F401

from martloom.llm import mixing

def test_raking_reaches_the_targets(spark):
    cells = [("a", "x", 900), ("a", "y", 100), ("b", "x", 50), ("b", "y", 950), ("c", "y", 0)]
    frame = spark.createDataFrame(cells, "mix_s string, mix_l string, tokens long")
    targets = {
        "mix_s": spark.createDataFrame([("a", 0.7), ("b", 0.3)], "mix_s string, share double"),
        "mix_l": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "mix_l string, share double"),
    }
    got = rows_of(mixing.rake(frame, targets, sweeps=30))
    for name, want in (("mix_s", {"a": 0.7, "b": 0.3, "c": 0}), ("mix_l", {"x": 0.5, "y": 0.5})):
        sums = defaultdict(float)
        for row in got:
            sums[row[name]] += row["fitted"]
        assert all(abs(sums[k] - v) < 1e-6 for k, v in want.items())


def documents(make_docs):
    rows = [(i, f"w{i} " * (1 + i % 9), ["en", "fr", None][i // 3 % 3], "hot" if i % 3 else f"s{i % 4}")
            for i in range(300)]
    rows += [(900, None, "en", "s1"), (901, "", None, None), (None, "a b", "en", "s1")] * 2
    return make_docs(rows)


def test_probabilities_are_calibrated(make_docs):
    docs = documents(make_docs)
    mixed = mixing.mix(docs, mixing.document_dimensions()).cache()
    got = rows_of(mixed)
    assert len(got) == docs.count()
    assert max(r["probability"] for r in got) == 1.0 and min(r["probability"] for r in got) >= 0
    counted, expected = defaultdict(float), defaultdict(float)
    for row in got:
        counted[row["mix_source"]] += row["n_tokens"]
        expected[row["mix_source"]] += row["n_tokens"] * row["probability"]
    want = {k: v**0.6 for k, v in counted.items() if v}
    for source, share in want.items():
        assert abs(expected[source] / sum(expected.values()) - share / sum(want.values())) < 0.02
    kept = {(r["doc_id"], r["sampled"]) for r in got}
    assert len({k for k, _ in kept}) <= len(kept)
    assert set(docs.columns) <= set(mixed.columns)


def test_plan_is_native(make_docs):
    mixed = mixing.mix(documents(make_docs), mixing.document_dimensions())
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_empty_table_and_texts_without_words(make_docs):
    dims = mixing.document_dimensions()
    assert rows_of(mixing.mix(make_docs([]), dims)) == []
    got = rows_of(mixing.mix(make_docs([(1, None), (2, ""), (3, " ")]), dims))
    assert [(r["probability"], r["sampled"]) for r in got] == [(0.0, False)] * 3


def test_draws_are_uniform(spark):
    ids = spark.range(4000).select(mixing.draw("id", "seed").alias("u"))
    low, mean, high = ids.agg(F.min("u"), F.avg("u"), F.max("u")).first()
    assert 0 <= low < 0.01 and 0.97 < high < 1 and abs(mean - 0.5) < 0.02


def test_one_rare_document_does_not_shrink_the_sample(make_docs):
    """A cell of four words of a new source and language, next to 3,000 documents."""
    rows = [(i, "w " * (20 + i % 9), ["en", "en", "fr"][i % 3], "hot" if i % 4 else f"s{i % 12}")
            for i in range(3000)]
    rows += [(9000, "four words of it", "xx", "new")]
    docs, dims = make_docs(rows), mixing.document_dimensions()
    part = lambda m: m.agg(F.sum(F.expr("n_tokens * probability")) / F.sum("n_tokens")).first()[0]
    assert part(mixing.mix(docs, dims)) < 0.1
    mixed = mixing.mix(docs, dims, size=0.3).cache()
    assert abs(part(mixed) - 0.3) < 0.003
    assert abs(mixed.where("sampled").count() - 900) < 90
    assert mixed.where("doc_id = 9000").first()["probability"] == 1.0
    cells = mixed.groupBy("mix_source", "mix_lang", "mix_topic").agg(F.sum("n_tokens").alias("tokens"))
    targets = {f"mix_{d}": mixing.power_targets(cells, f"mix_{d}", mixing.POWERS[d]) for d in dims}
    missing = {(r["dimension"], r["value"]): r for r in rows_of(mixing.lacks(mixed, targets))}
    new = missing["mix_source", "=new"]
    assert new["expected"] == 4 and new["lacking"] > 8 * new["expected"]
    # What the rare values lack is spread over the others in proportion.
    for name, rare in (("mix_source", "=new"), ("mix_lang", "=xx")):
        spread = [r["expected"] / r["wanted"] for (n, v), r in missing.items() if n == name and v != rare]
        assert max(spread) - min(spread) < 0.02 and min(spread) >= 1


def plain_rates(cells, targets, total):
    """Capped raking in plain Python: dict of cell to tokens; targets by dimension."""
    needs = []
    for d, target in enumerate(targets):
        held = defaultdict(float)
        for cell, tokens in cells.items():
            held[cell[d]] += tokens
        need, open_values = {}, {v for v in target if v in held}
        while True:
            rest = total - sum(need.values())
            share = sum(target[v] for v in open_values)
            full = {v for v in open_values if held[v] <= rest * target[v] / share + 1e-9}
            if not full:
                need.update({v: rest * target[v] / share for v in open_values})
                break
            need.update({v: held[v] for v in full})
            open_values -= full
            if not open_values:
                break
        needs.append(need)
    fitted = {c: float(t) for c, t in cells.items()}
    for _ in range(mixing.SWEEPS):
        for d, need in enumerate(needs):
            now = defaultdict(float)
            for cell, value in fitted.items():
                now[cell[d]] += value
            for cell in fitted:
                fitted[cell] *= need.get(cell[d], 0.0) / now[cell[d]] if now[cell[d]] else 0.0
        fitted = {c: min(v, cells[c]) for c, v in fitted.items()}
    return {c: min(1.0, fitted[c] / t) if t else 0.0 for c, t in cells.items()}


def test_capped_raking_equals_the_plain_one(make_docs):
    """For sizes at which no cell, some cells and all cells are drawn whole."""
    docs, dims = documents(make_docs), mixing.document_dimensions()
    names = [f"mix_{d}" for d in dims]
    for size in (0.05, 0.5, 0.9, 1.0):
        rates, targets = mixing.cell_rates(docs, dims, size=size)
        got = {tuple(r[n] for n in names): r for r in rows_of(rates)}
        cells = {c: r["n_tokens"] for c, r in got.items()}
        shares = [{r[n]: r["share"] for r in rows_of(targets[n])} for n in names]
        want = plain_rates(cells, shares, size * sum(cells.values()))
        assert all(abs(got[c]["probability"] - p) < 1e-6 for c, p in want.items()), size


def test_a_size_without_whole_cells_has_the_exact_shares(make_docs):
    docs, dims = documents(make_docs), mixing.document_dimensions()
    exact = {r["doc_id"]: r["probability"] for r in rows_of(mixing.mix(docs, dims))}
    small = {r["doc_id"]: r["probability"] for r in rows_of(mixing.mix(docs, dims, size=0.01))}
    ratio = {small[i] / p for i, p in exact.items() if p > 0}
    assert max(ratio) - min(ratio) < 1e-3 * max(ratio)


def test_missing_values_of_a_dimension(make_docs):
    """A caller's dimension may have none; every row comes back."""
    docs = documents(make_docs)
    dims = {"lang": F.col("lang"), "source": F.col("source")}
    powers = {"lang": 0.5, "source": 0.5}
    for size in (None, 0.5):
        got = rows_of(mixing.mix(docs, dims, powers=powers, size=size))
        assert len(got) == docs.count()
        assert {r["probability"] > 0 for r in got if r["mix_lang"] is None and r["n_tokens"]} == {True}


def test_a_step_holds_nothing_of_the_steps_before(spark, monkeypatch):
    """One sum and one join in each plan, however many dimensions and sweeps there are."""
    plans, written = [], mixing.keep

    def noted(df, name="kept"):
        if name.startswith("sweep"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(mixing, "keep", noted)
    cells = spark.createDataFrame(
        [("a", "x", 30), ("a", "y", 10), ("b", "x", 5), (None, "y", 5)], "s string, l string, tokens long"
    )
    targets = {
        n: spark.createDataFrame(rows, f"{n} string, share double")
        for n, rows in {"s": [("a", 0.5), ("b", 0.5)], "l": [("x", 0.3), ("y", 0.7)]}.items()
    }
    for fitted in (mixing.rake(cells, targets, 2), mixing.rake_within(cells, targets, 10.0, 2)):
        assert fitted.columns == ["s", "l", "tokens", "fitted"]
        assert {r["s"]: r["fitted"] for r in fitted.where("s IS NULL").collect()} == {None: 0.0}
    assert len(plans) == 8
    assert all(p.count("Join ") == 1 and p.count("Aggregate ") == 1 for p in plans)
