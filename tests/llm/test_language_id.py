import zlib

import pytest

from corpus_support import TESTDATA, make_docs, rows_of  # noqa: F401

from martloom.llm import language_id

SENTENCES = {
    "en": "the weather of this morning was better than that of the night before",
    "de": "das wetter an diesem morgen war besser als das der nacht davor und schön",
    "fr": "le temps de ce matin était meilleur que celui de la nuit précédente",
    "es": "el tiempo de esta mañana fue mejor que el de la noche anterior y más",
    "xx": "qpx zzkw xqpv wkzz pqxx kzwq vvxp qqzk xwpk zqvx",
}


def texts(language, n):
    words = SENTENCES[language].split()
    return [" ".join(words[(i * 7 + j * 3) % len(words)] for j in range(20)) for i in range(n)]


def test_families():
    assert language_id.family("de") == language_id.family("EN") == "Germanic"
    assert language_id.family("pt-BR") == "Romance" and language_id.family("xx") == "xx"


def test_three_families_and_texts_without_letters(make_docs):
    """A language without relatives is its own family; labels of held-out rows are not read."""
    rows = []
    for n, language in enumerate(SENTENCES):
        rows += [(n * 100 + i, t, language, "s") for i, t in enumerate(texts(language, 40))]
    held = [zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    hidden = [(i, t, "zz" if h else lang, s) for (i, t, lang, s), h in zip(rows, held)]
    odd = [(900, None, "en", "s"), (901, "", "en", "s"), (902, "12 !! \n", None, "s"),
           (903, texts("fr", 1)[0] * 3000, None, "s"), (None, texts("de", 1)[0], None, None),
           (904, "Ünïcödé é", None, None)]
    got = rows_of(language_id.identify(make_docs(hidden + odd + odd[:1])))
    assert len(got) == len(rows) + 7
    found = {r["doc_id"]: r for r in got}
    right = [found[i]["lang_pred"] == lang for i, _, lang, _ in rows]
    assert sum(right) / len(right) > 0.97
    assert [found[i]["held_out"] for i, *_ in rows] == held
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (900, 901, 902))
    assert found[903]["lang_pred"] == "fr" and found[904]["lang_pred"] in SENTENCES
    assert found[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got)


def test_copies_do_not_shrink_the_sample(make_docs):
    """A language of copies of one text, and one with a hundred copies of each other text."""
    rows = [(0, texts("xx", 1)[0], "xx", "s")] * 1500 + [(1, "mira " * 20, "es", "s")] * 2000
    for language in ("en", "de", "es"):
        rows += [(2, t, language, "s") for t in texts(language, 20)]
    machines = language_id.train(make_docs(rows), sample=25)
    for language in ("en", "de", "es", "xx"):
        found, _ = machines.decide(texts(language, 12))
        assert [x == language for x in found].count(True) >= 11


def test_one_language_and_none(make_docs):
    one = make_docs([(i, t, "en", "s") for i, t in enumerate(texts("en", 12))])
    assert {r["lang_pred"] for r in rows_of(language_id.identify(one))} == {"en"}
    none = make_docs([(1, "some text", None, "s"), (2, None, "en", "s")])
    assert {r["lang_pred"] for r in rows_of(language_id.identify(none))} == {"und"}
    assert rows_of(language_id.identify(make_docs([]))) == []
    assert language_id.in_a_language(make_docs([])).count() == 0


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(
        f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    got = rows_of(language_id.op8_hierarchical_langid(spark, f"{TESTDATA}/sf0.01"))
    held = [r["lang_pred"] == docs[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(held) / len(held) >= 0.98


OTHERS = {
    "ru": "погода этим утром была лучше чем прошлой ночью и мы пошли гулять",
    "zh": "今天早上的天气比昨天晚上好我们出去散步了",
    "junk": "asdf qwerty zxcvbnm lkjh poiu qqqq wwxx zzyy vbnm hjkl fdsa",
    "el": "ο καιρός σήμερα το πρωί ήταν καλύτερος από χθες το βράδυ",
}


@pytest.mark.parametrize("languages", [("en", "de", "fr", "es"), ("en", "de", "fr", "es", "xx")])
def test_foreign_scripts_and_junk_go(make_docs, languages):
    """With two families and with three; short clean texts stay."""
    rows = []
    for n, language in enumerate(languages):
        rows += [(n * 1000 + i, t, language, "s") for i, t in enumerate(texts(language, 200))]
    clean = [(9000 + n, " ".join(SENTENCES[language].split()[:4]), None, "s") for n, language in enumerate(languages)]
    odd = [(9500 + n, text, lang, "s") for n, text in enumerate(OTHERS.values()) for lang in (None,)]
    odd += [(9600, None, "en", "s"), (9601, "123 !!", "en", "s")]
    left = {r["doc_id"] for r in rows_of(language_id.in_a_language(make_docs(rows + clean + odd)))}
    assert left == {r[0] for r in rows + clean}


def test_all_of_the_given_documents_that_are_prose_stay(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    left = language_id.in_a_language(docs)
    assert left.count() >= 0.99 * docs.where("text RLIKE '[a-z]{3}'").count()
