"""Substring deduplication by suffix automata of reference shards.

Every window of 13 words has an anchor: the five-word n-gram of the lowest rank in it.
Grams that are common lines come last in rank, so that one of them is an anchor only
where all grams of a window are common; the others are ordered by hash. Consecutive
windows with the same anchor form a segment of at most 21 words. Equal windows have equal
anchors, so a window can only recur among the segments of its anchor, and only anchors
that occur more than once matter: a Bloom filter passes over the rest.

The different segments of these anchors are the reference text, each of them once, with
the smallest doc_id that holds it. It is cut by anchor into shards of bounded size, and a
shard's suffix automaton knows the smallest document of every factor. The documents'
segments are streamed through the automaton of their shard: at every word the shortest
match above the threshold tells in which document the window before it comes first.
What a document shares with smaller ones is then looked up by segment, and the spans of
a document are cut out of its text. Matches are decided on words, hashes only tell what
has to be compared. An automaton of the whole corpus would grow with it; every shard
therefore meets its segments in one place instead of being sent to all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.tables import NO_ID, carried, read_table, restored
from martloom.llm.words import Words, grams, mixed, split_words, text_slices
from martloom.session import keep

WINDOW = 13
ANCHOR = 5
# Text per reference shard. Its different segments are at most a few times as long.
SHARD_TEXT_BYTES = 2 * 1024 * 1024
# Grams are counted in so many cells; a task reports those it saw so often, and so many
# times as often as the mean cell.
HEAT_BITS = 22
COMMON = 8
# Bytes of text that have about one anchor or two.
BYTES_PER_ANCHOR = 64
# Texts go through in slices of about so many characters.
SLICE = 2_000_000

_CELL = "cell int, times long"
_SEGMENT = "anchor long, segment long, low long, high long, words binary"
_PLACE = "anchor long, segment long, doc_id long, print long, start int"
_FIRST = "anchor long, segment long, least long, windows int, lows binary"
_CUTS = "doc_id long, print long, cuts binary"
_OPEN = "doc_id long, print long, text string"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_MIX = np.random.default_rng(9).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - HEAT_BITS)).astype(np.int64)


class Segments:
    """Segments of a batch: text, first and last window, anchor and identity of each.

    ``heat`` has a level from 0 to 63 for every cell of grams, the common ones high.
    """

    def __init__(self, words: Words, heat: np.ndarray | None = None):
        self.words = words
        window_hash, whole = grams(words, WINDOW)
        small, _ = grams(words, ANCHOR)
        rank = small >> np.uint64(6)
        if heat is not None:
            rank |= heat[_cells(small)].astype(np.uint64) << np.uint64(58)
        reach = WINDOW - ANCHOR + 1
        n = max(0, len(words) - reach + 1)
        best = rank[:n].copy()
        place = np.zeros(n, dtype=np.int8)
        for j in range(1, reach):
            other = rank[j : j + n]
            lower = other < best
            best[lower] = other[lower]
            place[lower] = j
        at = np.flatnonzero(whole)
        anchors = at + place[at]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1] + 1) | (anchors[1:] != anchors[:-1])
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(at))[: len(begin)] - 1
        self.first, self.last = at[begin], at[end]
        self.anchor = small[anchors[begin]]
        self.text = np.searchsorted(words.first, self.first, side="right") - 1
        # First and last window overlap, so together they are all words of the segment.
        self.identity = mixed(
            window_hash[self.first] * _MIX[0]
            + window_hash[self.last] * _MIX[1]
            + (self.last - self.first).astype(np.uint64) * _MIX[2]
        )

    def __len__(self) -> int:
        return len(self.first)

    def words_of(self, i: int) -> bytes:
        begin, end = self.words.start[self.first[i]], self.words.end[self.last[i] + WINDOW - 1]
        return b" ".join(self.words.data[begin:end].split())


def _small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in text_slices(frame["text"], SLICE):
            yield frame.iloc[part]


def _common_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells of grams that this task saw often; what it saw less of is no hot key anywhere."""
    seen = np.zeros(1 << HEAT_BITS, dtype=np.int64)
    for frame in _small(frames):
        hashes, whole = grams(split_words(frame["text"].tolist(), lower=False), ANCHOR)
        seen += np.bincount(_cells(hashes[whole]), minlength=len(seen))
    cells = np.flatnonzero(seen >= COMMON * max(1.0, seen.mean()))
    yield pd.DataFrame({"cell": cells.astype(np.int32), "times": seen[cells]})


def _heat(named: DataFrame):
    """Broadcast of a level for every cell: the binary logarithm of how often it was seen."""
    cells = named.select("text").mapInPandas(_common_cells, _CELL)
    level = F.floor(F.log2(F.sum("times"))).cast("int").alias("level")
    levels = np.zeros(1 << HEAT_BITS, dtype=np.uint8)
    # At most as many rows as there are cells.
    for row in cells.groupBy("cell").agg(level).collect():
        levels[row["cell"]] = row["level"]
    return named.sparkSession.sparkContext.broadcast(levels)


def _anchors(heat):
    """Every anchor of every document of a batch, once by document."""

    def anchors(batch: pa.RecordBatch) -> np.ndarray:
        texts = batch.column("text").to_pylist()
        out = [np.array([], dtype=np.uint64)]
        for part in text_slices(texts, SLICE):
            cut = Segments(split_words(texts[part], lower=False), heat.value)
            order = np.lexsort((cut.anchor, cut.text))
            text, anchor = cut.text[order], cut.anchor[order]
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            out.append(anchor[fresh])
        return np.concatenate(out).view(np.int64)

    return anchors


def _recurring(frame: pd.DataFrame, heat, known) -> tuple[Segments, np.ndarray]:
    """Segments of a batch, and which of them have an anchor that may occur again."""
    cut = Segments(split_words(frame["text"].tolist(), lower=False), heat.value)
    return cut, np.flatnonzero(repeats.told(known.value, cut.anchor.view(np.int64)))


def _different(heat, known):
    """Words of the different segments of a batch, with the smallest and largest doc_id."""

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _small(frames):
            cut, some = _recurring(frame, heat, known)
            doc = frame["doc_id"].to_numpy(np.int64)[cut.text[some]]
            anchor, segment = cut.anchor[some], cut.identity[some]
            order = np.lexsort((doc, segment, anchor))
            anchor, segment, doc, some = anchor[order], segment[order], doc[order], some[order]
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(order))[: len(first)] - 1
            yield pd.DataFrame(
                {
                    "anchor": anchor[first].view(np.int64),
                    "segment": segment[first].view(np.int64),
                    "low": doc[first],
                    "high": doc[last],
                    "words": [cut.words_of(i) for i in some[first]],
                }
            )

    return segments


def _places(heat, known):
    """Where the segments of recurring anchors are."""

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _small(frames):
            cut, some = _recurring(frame, heat, known)
            text = cut.text[some]
            yield pd.DataFrame(
                {
                    "anchor": cut.anchor[some].view(np.int64),
                    "segment": cut.identity[some].view(np.int64),
                    "doc_id": frame["doc_id"].to_numpy(np.int64)[text],
                    "print": frame["print"].to_numpy(np.int64)[text],
                    "start": (cut.first[some] - cut.words.first[text]).astype(np.int32),
                }
            )

    return places


class SuffixAutomaton:
    """All factors of the word sequences added, and the smallest document of each.

    A state stands for the factors that end at the same places: ``length`` of the
    longest, and ``link`` to the state of their longest suffix that ends at more places.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.low = [NO_DOC]

    def add(self, sequence: list[int], doc: int) -> None:
        moves, link, length, low = self.next, self.link, self.length, self.low
        last = 0
        for word in sequence:
            state = moves[last].get(word)
            if state is not None:
                if length[state] != length[last] + 1:
                    state = self._split(last, state, word)
            else:
                state = len(link)
                moves.append({})
                length.append(length[last] + 1)
                link.append(0)
                low.append(NO_DOC)
                at = last
                while at != -1 and word not in moves[at]:
                    moves[at][word] = state
                    at = link[at]
                if at != -1:
                    target = moves[at][word]
                    if length[target] != length[at] + 1:
                        target = self._split(at, target, word)
                    link[state] = target
            last = state
            if doc < low[last]:
                low[last] = doc

    def _split(self, at: int, target: int, word: int) -> int:
        """A copy of ``target`` for the shorter factors that are reached from ``at``."""
        moves, link = self.next, self.link
        copy = len(link)
        moves.append(dict(moves[target]))
        self.length.append(self.length[at] + 1)
        link.append(link[target])
        self.low.append(NO_DOC)
        link[target] = copy
        while at != -1 and moves[at].get(word) == target:
            moves[at][word] = copy
            at = link[at]
        return copy

    def finish(self) -> None:
        """Hand the smallest documents down to the suffixes, the longest factors first."""
        low, link = np.array(self.low), np.array(self.link)
        length = np.array(self.length)
        order = np.argsort(-length, kind="stable")
        bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
        for begin, end in zip(bounds[:-1], bounds[1:]):
            level = order[begin:end]
            level = level[link[level] >= 0]
            np.minimum.at(low, link[level], low[level])
        self.low = low.tolist()

    def matches(self, sequence: list[int], least: int) -> list[tuple[int, int]]:
        """At every word, the length of the longest match, and the smallest document of
        its last ``least`` words (``NO_DOC`` if the match is shorter)."""
        moves, link, length, low = self.next, self.link, self.length, self.low
        state = matched = 0
        out = []
        for word in sequence:
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state = moves[state][word]
                matched += 1
            else:
                matched = 0
            if matched < least:
                out.append((matched, NO_DOC))
                continue
            shortest = state
            while length[link[shortest]] >= least:
                shortest = link[shortest]
            out.append((matched, low[shortest]))
        return out


NO_DOC = 2**63 - 1


def _first_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """Where each window of a shard's segments comes first, for those that recur.

    The segments of anchors in more than one document are streamed through the automaton
    of them all.
    """
    by_anchor = rows.groupby("anchor")
    low, high = by_anchor["low"].transform("min"), by_anchor["high"].transform("max")
    rows = rows[(low < high).to_numpy()]
    numbers: dict[bytes, int] = {}
    sequences = [
        [numbers.setdefault(word, len(numbers)) for word in words.split(b" ")]
        for words in rows["words"]
    ]
    automaton = SuffixAutomaton()
    for sequence, doc in zip(sequences, rows["low"].tolist()):
        automaton.add(sequence, doc)
    automaton.finish()
    out = []
    names = zip(rows["anchor"].tolist(), rows["segment"].tolist(), rows["high"].tolist(), sequences)
    for anchor, segment, high, sequence in names:
        lows = [doc for _, doc in automaton.matches(sequence, WINDOW)[WINDOW - 1 :]]
        least = min(lows)
        if least < high:
            windows = len(lows)
            # Most often one document is the first of all windows.
            lows = lows[:1] if max(lows) == least else lows
            out.append((anchor, segment, least, windows, np.array(lows, dtype=np.int64).tobytes()))
    return pd.DataFrame(out, columns=["anchor", "segment", "least", "windows", "lows"])


def kept_digest(words: list[bytes], removed: np.ndarray | None = None) -> str:
    if removed is not None:
        words = [w for w, r in zip(words, removed) if not r]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _cuts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maximal spans of words, as starts and ends, in windows that come first in a smaller
    document."""
    for frame in frames:
        rows = []
        for row in frame.itertuples():
            starts = []
            for span in row.spans:
                lows = np.frombuffer(span["lows"], dtype=np.int64)
                if len(lows) == 1:
                    starts.append(span["start"] + np.arange(span["windows"]))
                else:
                    starts.append(span["start"] + np.flatnonzero(lows < row.doc_id))
            at = np.unique(np.concatenate(starts))
            apart = np.flatnonzero(np.diff(at) > WINDOW)
            begin = at[np.concatenate([[0], apart + 1])]
            end = at[np.append(apart, len(at) - 1)] + WINDOW
            rows.append((row.doc_id, row.print, np.stack([begin, end]).astype(np.int32).tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "print", "cuts"])


def _result(frame: pd.DataFrame, cuts) -> pd.DataFrame:
    rows = []
    for doc_id, text, own in zip(frame["doc_id"], frame["text"], cuts):
        raw = _bytes(text).split()
        removed = np.zeros(len(raw), dtype=bool)
        if own is not None:
            for begin, end in np.frombuffer(own, dtype=np.int32).reshape(2, -1).T:
                removed[begin:end] = True
        rows.append((doc_id, len(raw), int(removed.sum()), kept_digest(raw, removed)))
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _has_cuts(frame: pd.DataFrame, known) -> np.ndarray:
    return repeats.told(known.value, frame["key"].to_numpy(np.int64))


def _whole(known):
    """Results of documents of which nothing goes."""

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _small(frames):
            some = frame[~_has_cuts(frame, known)]
            yield _result(some, [None] * len(some))

    return whole


def _open(known):
    """The other documents; a few of which nothing goes are among them."""

    def open_docs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _small(frames):
            yield frame.loc[_has_cuts(frame, known), ["doc_id", "print", "text"]]

    return open_docs


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in _small(frames):
        yield _result(frame, frame["cuts"])


def repeated_segments(texts: DataFrame) -> DataFrame:
    """Where segments of ``texts`` (doc_id, print, text) hold windows of smaller documents.

    doc_id, print, start, the number of windows and, for every one, the smallest doc_id
    that holds it (one for all if they agree). One row for every such segment of every
    document.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_TEXT_BYTES))
    heat = _heat(texts)
    known = repeats.repeated_filter(
        texts.select("text"), size // BYTES_PER_ANCHOR, _anchors(heat)
    )
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    first = keep(
        texts.select("doc_id", "text")
        .mapInPandas(_different(heat, known), _SEGMENT)
        # One shuffle for both groupings. A segment is a row per batch by now.
        .select(shard, "*")
        .repartition("shard")
        .groupBy("shard", "anchor", "segment")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.first("words").alias("words"))
        .groupBy("shard")
        .applyInPandas(lambda rows: _first_documents(rows), _FIRST),
        "first",
    )
    places = texts.select("doc_id", "print", "text").mapInPandas(_places(heat, known), _PLACE)
    return (
        places.join(first, ["anchor", "segment"])
        .where("least < doc_id")
        .select("doc_id", "print", "start", "windows", "lows")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """n_words, n_removed and the digest of the kept words for every row of ``docs``.

    ``docs`` has doc_id and text. A word goes if a window of 13 words around it also
    occurs in a document with a smaller doc_id. Missing and empty texts have no words.
    Documents without doc_id keep all words and remove none elsewhere; rows that share a
    doc_id remove nothing from each other. An empty table gives an empty result.
    """
    texts = docs.select(
        carried(),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"),
        "text",
    )
    named = texts.where((F.col("doc_id") != NO_ID) & F.col("text").isNotNull())
    # A row that stands twice has its spans twice.
    spans = (
        repeated_segments(named)
        .groupBy("doc_id", "print")
        .agg(F.collect_list(F.struct("start", "windows", "lows")).alias("spans"))
    )
    cuts = keep(spans.mapInPandas(_cuts, _CUTS), "cuts")
    key = F.xxhash64("doc_id", "print").alias("key")
    known = repeats.member_filter(cuts.select(key), cuts.count())
    keyed = texts.withColumn("key", key)
    whole = keyed.select("doc_id", "text", "key").mapInPandas(_whole(known), _RESULT)
    cut = (
        keyed.mapInPandas(_open(known), _OPEN)
        .join(cuts, ["doc_id", "print"], "left")
        .mapInPandas(_finish, _RESULT)
    )
    return restored(whole.unionAll(cut))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(read_table(spark, folder, "documents"))


def oracle_sql() -> str:
    return r"""
WITH worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
    unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM worded WHERE len(w) >= 13
), repeated AS MATERIALIZED (
  SELECT doc_id, i FROM windows
  JOIN (SELECT s, min(doc_id) AS low FROM windows GROUP BY s) USING (s) WHERE low < doc_id
), removed AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM repeated
), placed AS MATERIALIZED (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM worded
), left_over AS MATERIALIZED (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept, count(*) AS n
  FROM placed p ANTI JOIN removed r ON p.doc_id = r.doc_id AND p.i = r.i GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN left_over USING (doc_id)
"""
