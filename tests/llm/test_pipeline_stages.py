"""The pipeline against plain versions of its stages, each over its own input."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from corpus_support import TESTDATA, make_docs  # noqa: F401
from test_mixing import plain_rates
from test_neardup import brute

import corpus_pipeline
from martloom.llm import decontamination, mixing, sharding
from martloom.session import keep

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, FOLDER), name)
        out.append(docs.toPandas().sort_values("doc_id").reset_index(drop=True))
    return out


def test_columns_and_rows(stages):
    columns = list(stages[0].columns)
    assert all(list(s.columns) == columns for s in stages[1:-1])
    assert list(stages[-1].columns) == [*columns, "shard", "slot"]
    for before, after in zip(stages, stages[1:]):
        both = before.merge(after[columns], on=columns)
        assert len(both) == len(after) > 0


def test_language_keeps_clean_texts(stages):
    assert len(stages[1]) >= 0.98 * len(stages[0])


def test_one_of_each_group_stays(stages):
    _, low = brute(list(zip(stages[1].doc_id, stages[1].text)))
    assert sorted(stages[2].doc_id) == sorted(i for i, c in low.items() if i == c)


def test_no_benchmark_passage_stays(stages):
    tests = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    items = decontamination.Items(tests.item_id.tolist(), tests.text.tolist())
    words = decontamination.split_words(stages[2].text.tolist(), lower=True, marks=False)
    clean = [
        doc_id
        for doc_id, a, b in zip(stages[2].doc_id, words.first[:-1], words.first[1:])
        if not any(
            decontamination.align(item, words.hashes[a:b])[0] >= decontamination.needed(len(item))
            for item in items.words
        )
    ]
    assert sorted(stages[3].doc_id) == sorted(clean)


def test_mixture_equals_the_plain_one(spark, stages):
    """Cells by the query's SQL, rates by plain raking, draws by MD5."""
    con = duckdb.connect()
    con.register("clean", stages[3])
    rows = con.execute(mixing.sampled_sql("clean")).fetchdf()
    names = ["mix_source", "mix_lang", "mix_topic"]
    cells = rows.groupby(names)["n_tokens"].sum().to_dict()
    shares = []
    for name in names:
        raw = rows.groupby(name)["n_tokens"].sum() ** mixing.POWERS[name.removeprefix("mix_")]
        shares.append((raw / raw.sum()).to_dict())
    rates = plain_rates(cells, shares, corpus_pipeline.SAMPLE * sum(cells.values()))
    drawn = []
    for row in rows.itertuples():
        digest = hashlib.md5(f"{mixing.SEED}:{row.doc_id}".encode()).hexdigest()
        if int(digest[:13], 16) / 2**52 < rates[tuple(getattr(row, n) for n in names)]:
            drawn.append(row.doc_id)
    assert sorted(stages[4].doc_id) == sorted(drawn)


def test_shards_follow_the_permutation(stages):
    n = len(stages[4])
    place = sharding.permute(np.arange(n), n, sharding.KEY)
    assert (stages[5].doc_id.to_numpy() == stages[4].doc_id.to_numpy()).all()
    assert (stages[5].shard.to_numpy() == place % 24).all()
    assert (stages[5].slot.to_numpy() == place // 24).all()


def test_odd_rows_go_through_every_stage(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "123"), (None, "the text of a page"), (4, "the text of a page"),
            (4, "the text of a page"), (5, "the other text of another page, and more of it")]
    docs = make_docs(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, FOLDER))
    left = docs.select("doc_id", "text").collect()
    assert len(left) == len({(r[0], r[1]) for r in left}) and all(r["text"] for r in left)
    empty = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        empty = keep(stage(spark, empty, FOLDER))
    assert empty.count() == 0


def test_unlike_texts_of_one_id_stay(spark, make_docs):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six seven"),
            (1, "one two three four five six seven"), (2, "ALPHA beta gamma delta epsilon zeta")]
    left = corpus_pipeline.deduplicated(spark, make_docs(rows), FOLDER).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [rows[0], rows[1]]
