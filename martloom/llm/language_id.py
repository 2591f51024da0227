"""Language identification: the family first, then one-versus-one machines within it.

A text is the relative frequencies of its hashed letter n-grams. One linear support
vector machine per family tells it from all other families. Within the winning family,
one machine per pair of languages votes; the language with most votes wins, ties go to
the larger sum of margins.

The machines are trained on at most ``SAMPLE`` labelled texts of each language, chosen
by hash. Each of them is scored by a look-up and a running sum over the n-grams, so that
whole texts of any length take one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.tables import carried, filtered, read_table, restored
from martloom.llm.words import text_slices
from martloom.session import keep

SAMPLE = 500
SIZES = (3, 4)
BUCKET_BITS = 14
REGULARISATION, STEPS, TOLERANCE = 1e-4, 15, 1e-3
# N-grams of four bytes that a language's sample holds are remembered in so many cells. A
# text is of the language if it has this part of the share that the sample's own texts
# have among the others', all but the strangest hundredth of them.
KNOWN_BITS = 20
KNOWN_PART, STRANGEST = 0.5, 0.01
# The share asked for where a sample is too small to tell.
LEAST_KNOWN = 0.3
# n-gram frequencies are small: scaled up, margins are of the order of 1.
SCALE = 100.0

# Families of ISO 639-1 codes; an unlisted language is its own family.
FAMILIES = {
    "Germanic": "de en nl sv da no is af yi lb fy",
    "Romance": "fr es it pt ro ca gl oc",
    "Slavic": "ru uk be pl cs sk sl hr sr bg mk bs",
    "Baltic": "lt lv",
    "Celtic": "ga gd cy br",
    "Uralic": "fi et hu",
    "Turkic": "tr az kk uz",
    "Indic": "hi ur bn mr gu pa ne",
    "Semitic": "ar he mt am",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_LETTER = re.compile(r"[^\W\d_]")
# Digits, punctuation and control characters count as spaces.
_AS_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)

_KNOWN = "lang string, cells binary, least double"
_PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double"


def family(language: str) -> str:
    return _FAMILY_OF.get(language.lower().split("-")[0], language)


def in_training(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 != 2


def _letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in lower case, set apart by spaces, and where each begins."""
    encoded = [
        b" " + (t or "").lower().encode("utf-8", "surrogatepass").translate(_AS_SPACE) + b"   "
        for t in texts
    ]
    lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
    return np.frombuffer(b"".join(encoded), dtype=np.uint8), np.concatenate(
        [[0], np.cumsum(lengths)]
    )


def _buckets(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the ``size`` bytes from each place, and whether the first two hold a letter.

    Runs of spaces thus add nothing, and neither does an empty text.
    """
    n = len(data) - 3
    hashed = np.full(n, size, dtype=np.uint32)
    for j in range(size):
        hashed = (hashed ^ data[j : n + j]) * _FACTORS[j]
        hashed ^= hashed >> np.uint32(15)
    useful = (data[:n] != 32) | (data[1 : n + 1] != 32)
    return (hashed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), useful


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a batch, the text of each of them, and their number by text."""
    data, first = _letters(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))[: len(data) - 3]
    buckets, owners = [], []
    for size in SIZES:
        bucket, useful = _buckets(data, size)
        buckets.append(bucket[useful])
        owners.append(owner[useful])
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    return bucket, owner, np.bincount(owner, minlength=len(texts))


def _cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every n-gram of four bytes, and its text."""
    data, first = _letters(texts)
    n = len(data) - 3
    hashed = np.full(n, 4, dtype=np.uint32)
    for j in range(4):
        hashed = (hashed ^ data[j : n + j]) * _FACTORS[j]
        hashed ^= hashed >> np.uint32(15)
    useful = (data[:n] != 32) | (data[1 : n + 1] != 32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))[:n]
    return (hashed >> np.uint32(32 - KNOWN_BITS)).astype(np.int64)[useful], owner[useful]


def _known_shares(texts: list[str | None], known: np.ndarray) -> np.ndarray:
    """Share of each text's n-grams that ``known``, a flag for every cell, has."""
    cell, owner = _cells(texts)
    total = np.bincount(owner, minlength=len(texts))
    return np.bincount(owner, weights=known[cell], minlength=len(texts)) / np.maximum(total, 1)


def _known_ngrams(rows: pd.DataFrame) -> pd.DataFrame:
    """Cells of one language's sample, and the share that one of its texts has at least.

    A fifth of the texts is kept apart and compared with the others' cells.
    """
    texts = rows["text"].tolist()
    apart, others = texts[::5], [t for i, t in enumerate(texts) if i % 5]

    def cells(some: list[str]) -> np.ndarray:
        known = np.zeros(1 << KNOWN_BITS, dtype=bool)
        for part in text_slices(some, 1_000_000):
            known[_cells(some[part])[0]] = True
        return known

    least = LEAST_KNOWN
    if len(apart) >= 20:
        learned = cells(others)
        shares = [_known_shares(apart[part], learned) for part in text_slices(apart, 1_000_000)]
        least = KNOWN_PART * float(np.quantile(np.concatenate(shares), STRANGEST))
    packed = np.packbits(cells(texts)).tobytes()
    return pd.DataFrame([(rows["lang"].iloc[0], packed, least)], columns=["lang", "cells", "least"])


@F.udf(VectorUDT())
def _vector(text: str | None) -> SparseVector:
    """For training only: texts of the bounded sample."""
    bucket, _, total = features([text])
    some, counts = np.unique(bucket, return_counts=True)
    return SparseVector(1 << BUCKET_BITS, some, counts * (SCALE / max(1, total[0])))


class Machines:
    """Weights of the linear machines and how they decide."""

    def __init__(self):
        self.families: dict[str, list[str]] = {}
        self.names: list[tuple] = []
        self.weights: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.known: dict[str, tuple[bytes, float]] = {}

    def add(self, name: tuple, weights: np.ndarray, offset: float) -> None:
        self.names.append(name)
        self.weights.append(np.asarray(weights, dtype=np.float32) * SCALE)
        self.offsets.append(float(offset))

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Margin of every machine for every text, and the number of n-grams."""
        out = np.zeros((len(self.names), len(texts)))
        counts = np.zeros(len(texts), dtype=np.int64)
        for some in text_slices(texts, 1_000_000):
            bucket, owner, total = features(texts[some])
            counts[some] = total
            for row, (weights, offset) in enumerate(zip(self.weights, self.offsets)):
                sums = np.bincount(owner, weights=weights[bucket], minlength=len(total))
                out[row, some] = sums / np.maximum(total, 1) + offset
        return out, counts

    def familiar(self, texts: list[str | None], languages: np.ndarray) -> np.ndarray:
        """Which texts are made of n-grams that are known from their language."""
        out = np.zeros(len(texts), dtype=bool)
        for language, (packed, least) in self.known.items():
            own = np.flatnonzero(languages == language)
            if len(own):
                known = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
                some = [texts[i] for i in own]
                shares = [_known_shares(some[p], known) for p in text_slices(some, 1_000_000)]
                out[own] = np.concatenate(shares) >= least
        return out

    def decide(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Language of every text that has a letter, and a score from 0 to 1."""
        margins, _ = self.margins(texts)
        row = {name: at for at, name in enumerate(self.names)}
        kinds = sorted(self.families)
        size = len(texts)
        if len(kinds) == 1:
            best, sure = np.zeros(size, dtype=int), np.ones(size)
        elif len(kinds) == 2:
            own = margins[row["family", kinds[0]]]
            best, sure = (own < 0).astype(int), _chance(np.abs(own))
        else:
            table = np.stack([margins[row["family", k]] for k in kinds])
            best, sure = table.argmax(0), _chance(table.max(0))
        languages = np.empty(size, dtype=object)
        scores = np.zeros(size)
        for at, kind in enumerate(kinds):
            members = self.families[kind]
            votes = np.zeros((len(members), size))
            for i, j in combinations(range(len(members)), 2):
                own = margins[row["pair", members[i], members[j]]]
                # A bounded margin breaks ties of whole votes and never outweighs one.
                tie = np.tanh(own) / (4 * len(members))
                votes[i] += (own >= 0) + tie
                votes[j] += (own < 0) - tie
            winner = votes.argmax(0)
            least = np.full(size, np.inf)
            for i, j in combinations(range(len(members)), 2):
                own = margins[row["pair", members[i], members[j]]]
                least = np.where(winner == i, np.minimum(least, own), least)
                least = np.where(winner == j, np.minimum(least, -own), least)
            here = best == at
            languages[here] = np.array(members, dtype=object)[winner[here]]
            scores[here] = sure[here] * _chance(least[here])
        return languages, scores


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-2.0 * np.clip(margin, -50, 50)))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Machines | None:
    """Machines learned from ``labelled`` (text, lang); none without labelled texts.

    Of each language the texts of the smallest hashes are taken, about ``sample`` of
    them: the share that this is of all its different texts is the bound on the hash, so
    that copies neither shrink the sample nor leave a language out.
    """
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").where(
        F.col("text").rlike(r"\p{L}")
    )
    texts = usable.select("lang", F.xxhash64("text").alias("text")).distinct()
    counts = texts.groupBy("lang").count().collect()
    if not counts:
        return None
    languages = sorted(row["lang"] for row in counts)
    share = {row["lang"]: min(1.0, sample / row["count"]) for row in counts}
    share_of = F.create_map(*[F.lit(v) for item in share.items() for v in item])
    place = F.pmod(F.xxhash64("text"), F.lit(10**15)) / F.lit(1e15)
    sampled = keep(
        usable.where(place < share_of[F.col("lang")]).dropDuplicates(["lang", "text"]).select("lang", "text"),
        "sampled",
    )
    chosen = keep(sampled.select("lang", _vector("text").alias("features")), "labelled")
    # A bounded sample: in two partitions a step of the learner is one short stage.
    chosen = chosen.repartition(2).cache()
    machines = Machines()
    # One bounded sample is one group.
    for row in sampled.groupBy("lang").applyInPandas(_known_ngrams, _KNOWN).collect():
        machines.known[row["lang"]] = (row["cells"], row["least"])
    for language in languages:
        machines.families.setdefault(family(language), []).append(language)
    learner = LinearSVC(maxIter=STEPS, tol=TOLERANCE, regParam=REGULARISATION, standardization=False)

    def fit(name: tuple, rows: DataFrame, positive: list[str]) -> None:
        target = F.col("lang").isin(positive).cast("double")
        data = rows.select(target.alias("label"), "features")
        if data.agg(F.countDistinct("label")).first()[0] < 2:
            # Its texts were not in the sample: the side with texts wins.
            only = data.first()
            sign = 1.0 if only is not None and only["label"] == 1.0 else -1.0
            machines.add(name, np.zeros(1 << BUCKET_BITS), sign)
            return
        model = learner.fit(data)
        machines.add(name, model.coefficients.toArray(), model.intercept)

    kinds = sorted(machines.families)
    for kind in kinds[:1] if len(kinds) == 2 else kinds if len(kinds) > 2 else []:
        fit(("family", kind), chosen, machines.families[kind])
    for members in machines.families.values():
        for one, two in combinations(members, 2):
            fit(("pair", one, two), chosen.where(F.col("lang").isin(one, two)), [one])
    chosen.unpersist()
    return machines


def predict(docs: DataFrame, machines: Machines | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (also held_out).

    ``und`` with score 0 if the text is missing or has no letter, or if nothing was
    learned. Only the text decides.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machines)

    def predicted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            languages, scores = _decided(frame["text"].tolist(), sent.value)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "held_out": frame["held_out"],
                    "lang_pred": languages,
                    "score": scores,
                }
            )

    rows = docs.select(carried(), "held_out", "text")
    return restored(rows.mapInPandas(predicted, _PREDICTION))


def _decided(texts: list[str | None], machines: Machines | None) -> tuple[np.ndarray, np.ndarray]:
    spoken = np.array([bool(t and _LETTER.search(t)) for t in texts], dtype=bool)
    languages = np.full(len(texts), "und", dtype=object)
    scores = np.zeros(len(texts))
    if machines is not None and spoken.any():
        some = [t for t, s in zip(texts, spoken) if s]
        languages[spoken], scores[spoken] = machines.decide(some)
    return languages, scores


def in_a_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose language is told.

    Texts that are missing or without a letter go, and those made of n-grams that the
    language which they are nearest to does not have: other scripts, other languages and
    junk. The share asked for is set by texts of the sample that were kept apart, and
    means the same for any number of families.
    """
    sent = docs.sparkSession.sparkContext.broadcast(
        train(docs.where(in_training()).select("text", "lang"), sample)
    )

    def told(texts: list[str | None]) -> list[bool]:
        languages, _ = _decided(texts, sent.value)
        if sent.value is None:
            return [False] * len(texts)
        return sent.value.familiar(texts, languages).tolist()

    return filtered(docs, told)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Predictions for all rows of ``docs`` (doc_id, text, lang), learned from its training part.

    A missing doc_id counts as the empty text in the split.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"
    ).withColumn("held_out", ~in_training())
    return predict(rows, train(rows.where("NOT held_out"), sample))


def op8_hierarchical_langid(spark: SparkSession, folder: str) -> DataFrame:
    return identify(read_table(spark, folder, "documents"))
