import zlib

import numpy as np
import pytest

from corpus_support import make_docs, rows_of  # noqa: F401

from martloom.llm import sharding

@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 24, 25, 99, 1000, 4097])
def test_permutation(n):
    image = sharding.permute(np.arange(n), n, 7)
    assert sorted(image.tolist()) == list(range(n))
    if n > 50:
        other = sharding.permute(np.arange(n), n, 8)
        assert (image != other).mean() > 0.9 and abs(np.corrcoef(np.arange(n), image)[0, 1]) < 0.4


def test_laws_hold_and_do_not_depend_on_partitions(make_docs):
    rows = [(i % 40 or None, [None, "", "é", "same"][i % 4]) for i in range(130)]
    rows += [(7, "x" * 100_000), (7, "x" * 100_000)]
    found = []
    for partitions in (1, 6):
        got = rows_of(sharding.shard_rows(make_docs(rows, partitions), ["doc_id"], shards=24))
        assert len(got) == len(rows)
        slots = {}
        for row in got:
            slots.setdefault(row["shard"], []).append(row["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots.get(s, [])) for s in range(24)]
        assert max(sizes) - min(sizes) <= 1
        found.append(sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in got))
    assert found[0] == found[1]
    assert set(got[0]) == set(make_docs([]).columns) - {"row_number"}


def test_empty_table(make_docs):
    assert rows_of(sharding.shard_rows(make_docs([]), ["doc_id"])) == []


def test_query_columns(spark):
    got = rows_of(sharding.op3_feistel_sharding(spark, "/root/testdata/sf0.001"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").collect()}
    for row in got:
        data = (docs[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert row["law"] == "rows" and row["grown_shard"] is None
