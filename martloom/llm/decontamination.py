"""Benchmark passages in training documents: rare n-gram seeds, then local alignment.

Seeds are the three-word n-grams of the test items. A filter of all of them passes over
the documents once and leaves the places that may hold one; from these every n-gram's
number of documents is counted. An n-gram of few items is a seed of each; one of many
items is a seed of those for which it is among the rarer half. Places and seeds are
joined, which opens regions of a document around a test item, and only the documents
with such regions are shuffled and read again.

Regions are aligned with their item by Smith-Waterman on words, many at a time; the
score is the part of the item's full score that the best local alignment reaches, so
that edited copies are found as well. A passage of an item is found, too, whatever the
item's length, if ``PASSAGE_MATCHES`` words match at half of the score that the passage
could reach.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.tables import carried, read_table, restored
from martloom.llm.words import Words, grams, split_words, text_slices
from martloom.session import keep

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
# An alignment of fewer matches is a copy only if it covers its whole item.
LEAST_MATCHES = 8
# So many matched words are a copy of a part of their item, too.
PASSAGE_MATCHES = 13
# N-grams of at most so many items are seeds of all of them.
FEW_ITEMS = 8
# Words of items are broadcast in slices of at most this many bytes of text; a slice
# reads the documents that its own seeds opened.
SLICE_BYTES = 16 * 1024 * 1024
# Regions are aligned so many at a time.
REGIONS = 256

_GRAM = "gram long, item long, word int"
_HIT = "doc_id long, print long, gram long, place int"
_TEXT = "doc_id long, print long, text string"
_FOUND = "doc_id long, print long, item_id long, score double, first_word long, last_word long"

# Quotation marks, dashes and other marks beyond ASCII, fixed ranges of Unicode.
_MARKS = re.compile("[\u00ab\u00bb\u2010-\u205e]")


def _split(texts: list[str | None]) -> Words:
    """Words without case and punctuation."""
    plain = [t if t is None or t.isascii() else _MARKS.sub(" ", t.lower()) for t in texts]
    return split_words(plain, lower=True, marks=False)


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences and where it ends in ``region``."""
    steps = np.arange(len(region) + 1) * -GAP
    above = np.zeros(len(region) + 1, dtype=np.int64)
    best, end = 0, -1
    for word in item:
        here = np.zeros_like(above)
        here[1:] = np.maximum(above[:-1] + np.where(region == word, MATCH, MISMATCH), 0)
        here = np.maximum(here, above + GAP)
        # A gap along the region costs the same per word: a running maximum.
        here = np.maximum.accumulate(here + steps) - steps
        top = int(here.argmax())
        if here[top] > best:
            best, end = int(here[top]), top - 1
        above = here
    return best, end


def align_many(items: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``align`` for every row of two arrays of words; 0 fills up items and 1 regions."""
    count, width = regions.shape
    steps = np.arange(width + 1, dtype=np.int32) * -GAP
    above = np.zeros((count, width + 1), dtype=np.int32)
    best, end = np.zeros(count, dtype=np.int32), np.full(count, -1)
    rows = np.arange(count)
    for word in items.T:
        here = np.where(regions == word[:, None], np.int32(MATCH), np.int32(MISMATCH))
        here += above[:, :-1]
        np.maximum(here, 0, out=here)
        np.maximum(here, above[:, 1:] + GAP, out=here)
        here += steps[1:]
        np.maximum.accumulate(here, axis=1, out=here)
        here -= steps[1:]
        top = here.argmax(axis=1)
        value = here[rows, top]
        higher = value > best
        best[higher], end[higher] = value[higher], top[higher]
        above[:, 1:] = here
    return best, end


def needed(words: int) -> float:
    return max(LEAST_SCORE * MATCH * words, min(MATCH * words, MATCH * LEAST_MATCHES))


def passage(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Where the best passage ends in ``item`` and ``region``; -1 and -1 without one.

    A passage has ``PASSAGE_MATCHES`` matches and ``LEAST_SCORE`` of the score of its own
    words of the item. Each of them therefore costs that part of a match, and a passage
    is an alignment of 0 or more, kept apart by its number of matches.
    """
    own = LEAST_SCORE * MATCH
    steps = np.arange(len(region) + 1) * -GAP
    above = np.full((PASSAGE_MATCHES + 1, len(region) + 1), -np.inf)
    above[0] = 0
    best, ends = -0.5, (-1, -1)
    for at, word in enumerate(item):
        here = above + (GAP - own)
        same = region == word
        np.maximum(here[:, 1:], above[:, :-1] + np.where(same, -np.inf, MISMATCH - own), out=here[:, 1:])
        matched = above[:, :-1] + np.where(same, MATCH - own, -np.inf)
        np.maximum(here[1:, 1:], matched[:-1], out=here[1:, 1:])
        np.maximum(here[-1, 1:], matched[-1], out=here[-1, 1:])
        here = np.maximum.accumulate(here + steps, axis=1) - steps
        here[0] = 0
        top = int(here[-1].argmax())
        if here[-1, top] > best:
            best, ends = float(here[-1, top]), (at, top - 1)
        above = here
    return ends


class Items:
    """Words of test items as hashes."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words = _split(texts)
        self.ids = ids
        self.words = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Numbers from each ``begin`` on, as many as ``length`` says, end to end."""
    before = np.cumsum(length) - length
    return np.repeat(begin - before, length) + np.arange(int(length.sum()))


def _common(items: list[np.ndarray], own: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many words of each item occur in its region ``own[low:high]``."""
    sizes = np.array([len(item) for item in items])
    numbers = np.arange(len(items), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    there = own[_ranges(low, high - low)] ^ np.repeat(numbers, high - low)
    asked = np.concatenate(items) ^ np.repeat(numbers, sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return np.add.reduceat(np.isin(asked, there).astype(np.int64), first)


def _regions(begins: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches of a text in which an item of ``length`` words can lie around its seeds."""
    slack = length // 2 + 4
    out: list[tuple[int, int]] = []
    for begin in np.unique(begins).tolist():
        low, high = begin - slack, begin + length + slack
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _scores(items: list[np.ndarray], own: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Score and end of the best alignment of every item and its region."""
    score, end = np.zeros(len(items), dtype=np.int64), np.full(len(items), -1)
    sizes, widths = np.array([len(item) for item in items]), high - low
    order = np.lexsort((widths, sizes))
    for at in range(0, len(order), REGIONS):
        some = order[at : at + REGIONS]
        asked = np.zeros((len(some), sizes[some].max()), dtype=np.uint64)
        there = np.ones((len(some), widths[some].max()), dtype=np.uint64)
        for i, r in enumerate(some.tolist()):
            asked[i, : sizes[r]] = items[r]
            there[i, : widths[r]] = own[low[r] : high[r]]
        score[some], end[some] = align_many(asked, there)
    return score, end


def _alignments(words: Words, opened, items: Items) -> Iterator[tuple]:
    """Text, item, score, first and last word of every item that a text holds.

    ``opened`` has the text, the item and where the item would begin, by text and item.
    The best alignment counts; of items that no region holds as far as needed, those of
    the first passage of them.
    """
    text, item, begin = opened
    groups = np.flatnonzero(np.diff(text, prepend=-1) | np.diff(item, prepend=-1))
    regions = []
    for a, b in zip(groups, np.append(groups[1:], len(text))):
        first, last = words.first[text[a]], words.first[text[a] + 1]
        for low, high in _regions(begin[a:b], len(items.words[item[a]])):
            low, high = max(first + low, first), min(first + high, last)
            if low < high:
                regions.append((text[a], item[a], low, high))
    if not regions:
        return
    text, item, low, high = (np.array(c) for c in zip(*regions))
    asked = [items.words[i] for i in item]
    need = np.array([needed(len(words)) for words in asked])
    # No alignment has more matches than the item has words in common.
    common = _common(asked, words.hashes, low, high)
    some = np.flatnonzero((MATCH * common >= need) | (common >= PASSAGE_MATCHES))
    asked = [asked[i] for i in some]
    text, item, low, high, need, common = (c[some] for c in (text, item, low, high, need, common))
    if not len(some):
        return
    score, end = _scores(asked, words.hashes, low, high)
    best: dict[tuple[int, int], int] = {}
    best_spans: dict[tuple[int, int], tuple[int, int]] = {}
    # A passage scores as many points as it has matches, at least.
    worth = (score >= need) | ((common >= PASSAGE_MATCHES) & (score >= PASSAGE_MATCHES))
    for r in np.flatnonzero(worth).tolist():
        pair = (int(text[r]), int(item[r]))
        known = best.get(pair)
        if known is None or (score[r] >= need[r] and score[r] > score[known]):
            if score[r] < need[r]:
                region = words.hashes[low[r] : high[r]]
                last, stop = passage(asked[r], region)
                if stop < 0:
                    continue
                _, length = passage(asked[r][: last + 1][::-1], region[: stop + 1][::-1])
                end[r] = stop
            else:
                back = words.hashes[low[r] : low[r] + end[r] + 1][::-1]
                _, length = align(asked[r][::-1], back)
            best[pair] = r
            first = low[r] + end[r] - length - words.first[text[r]]
            best_spans[pair] = (int(first), int(first + length))
    for (t, i), r in best.items():
        full = MATCH * len(items.words[i])
        yield t, items.ids[i], round(int(score[r]) / full, 6), *best_spans.pop((t, i))


def _small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in text_slices(frame["text"]):
            yield frame.iloc[part]


def _item_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in _small(frames):
        words = _split(frame["text"].tolist())
        hashes, whole = grams(words, SEED_WORDS)
        at = np.flatnonzero(whole)
        text = words.text_of_word()[at]
        yield pd.DataFrame(
            {
                "gram": hashes[at].view(np.int64),
                "item": frame["item"].to_numpy(np.int64)[text],
                "word": (at - words.first[text]).astype(np.int32),
            }
        )


def _hits(known):
    """Places of n-grams that the filter knows."""

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _small(frames):
            words = _split(frame["text"].tolist())
            hashes, whole = grams(words, SEED_WORDS)
            at = np.flatnonzero(whole)
            at = at[repeats.told(known.value, hashes[at].view(np.int64))]
            text = np.searchsorted(words.first, at, side="right") - 1
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].to_numpy(np.int64)[text],
                    "print": frame["print"].to_numpy(np.int64)[text],
                    "gram": hashes[at].view(np.int64),
                    "place": (at - words.first[text]).astype(np.int32),
                }
            )

    return hits


def _members(known):
    """Rows whose ``key`` the filter knows, without it."""

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            told = repeats.told(known.value, frame["key"].to_numpy(np.int64))
            yield frame.loc[told, ["doc_id", "print", "text"]]

    return members


def _aligned(known):
    def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, items = known.value
        for frame in _small(frames):
            words = _split(frame["text"].tolist())
            sizes = frame["places"].map(len).to_numpy()
            text = np.repeat(np.arange(len(frame)), sizes)
            places = [p for own in frame["places"] for p in own]
            item = np.array([numbers[p["item"]] for p in places])
            begin = np.array([p["begin"] for p in places])
            order = np.lexsort((begin, item, text))
            opened = (text[order], item[order], begin[order])
            doc_id, prints = frame["doc_id"].to_numpy(), frame["print"].to_numpy()
            rows = [(doc_id[t], prints[t], *rest) for t, *rest in _alignments(words, opened, items)]
            names = [c.split()[0] for c in _FOUND.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    return aligned


def _seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """The n-grams of items (gram, item, word) that open regions of documents."""
    listed = keep(items.select("item", "text").mapInPandas(_item_grams, _GRAM), "grams")
    held = listed.groupBy("gram").agg(F.countDistinct("item").alias("items"))
    seen = hits.groupBy("gram").agg(F.count("*").alias("times"))
    rarity = F.percent_rank().over(Window.partitionBy("item").orderBy("times", "gram"))
    return (
        listed.join(held, "gram")
        .join(seen, "gram")
        .withColumn("rarity", rarity)
        .where((F.col("items") <= FEW_ITEMS) | (F.col("rarity") <= 0.5))
        .select("gram", "item", "word")
    )


def _found(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaks of ``texts`` (doc_id, print, text), one row per text and test item, written once."""
    spark = texts.sparkSession
    key = F.xxhash64("doc_id", "print").alias("key")
    tests = benchmark.select(carried("item_id"), "text").where("text IS NOT NULL").distinct()
    items = keep(tests.withColumn("item", F.xxhash64("item_id", "text")), "items")
    count = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    all_grams = items.select("item", "text").mapInPandas(_item_grams, _GRAM)
    known = repeats.member_filter(all_grams.select(F.col("gram").alias("key")), count // 4)
    hits = keep(texts.mapInPandas(_hits(known), _HIT), "hits")
    opened = keep(
        hits.join(_seeds(items, hits), "gram")
        .select("doc_id", "print", "item", (F.col("place") - F.col("word")).alias("begin"))
        .distinct(),
        "opened",
    )
    slices = max(1, -(-count // SLICE_BYTES))
    part = F.pmod("item", F.lit(slices))
    found = spark.createDataFrame([], _FOUND)
    for number in range(slices):
        rows = items.where(part == number).orderBy("item_id", "text").collect()
        numbers = {row["item"]: at for at, row in enumerate(rows)}
        words = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        sent = spark.sparkContext.broadcast((numbers, words))
        places = keep(
            opened.where(part == number)
            .groupBy("doc_id", "print")
            .agg(F.collect_list(F.struct("item", "begin")).alias("places")),
            "places",
        )
        members = repeats.member_filter(places.select(key), places.count())
        found = found.unionAll(
            texts.withColumn("key", key)
            .mapInPandas(_members(members), _TEXT)
            .join(places, ["doc_id", "print"])
            .mapInPandas(_aligned(sent), _FOUND)
        )
    return keep(found, "leaks")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        carried(), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), "text"
    ).where("text IS NOT NULL")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and test item that it holds: doc_id, item_id, score, span.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Words are compared
    without case and punctuation; ``first_word`` and ``last_word`` count them from 0. The
    score of a passage of an item is a part of the whole item's, too, and may be small.
    Missing texts, texts without words, and items of fewer than three words are never
    found. Documents without doc_id are searched and reported with none; repeated rows
    are reported once each. An empty table on either side gives no row.
    """
    found = _found(_texts(docs), benchmark).drop("print")
    return restored(restored(found), "item_id")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no test item.

    Only rows that may hold one are shuffled, to be compared with those found.
    """
    found = _found(_texts(docs), benchmark).select("doc_id", "print").distinct()
    leaked = found.select(
        F.xxhash64("doc_id", "print").alias("key"),
        F.col("doc_id").alias("__doc_id"), F.col("print").alias("__print"),
    )
    known = repeats.member_filter(leaked.select("key"), leaked.count())
    told = docs.withColumns(
        {"__doc_id": carried(), "__print": F.xxhash64(F.coalesce("text", F.lit("")))}
    )
    told = told.withColumn("__key", F.xxhash64("__doc_id", "__print"))
    told = told.withColumn("__found", repeats.may_repeat(known, "__key"))
    cleared = told.where("__found").join(leaked, ["__doc_id", "__print"], "left_anti")
    return told.where("NOT __found").select(*docs.columns).unionAll(cleared.select(*docs.columns))


def op5_seed_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return leaks(docs, read_table(spark, folder, "benchmark"))
