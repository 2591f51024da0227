import datetime as dt

import pytest
from corpus_support import make_docs, rows_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import pii

KEY = b"a key for tests"


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 10**20), st.integers(0, 10**20))
def test_feistel_is_a_permutation(size, value):
    feistel = pii.Feistel(KEY)
    value %= size
    image = feistel.permute(value, size, "x")
    assert 0 <= image < size and feistel.restore(image, size, "x") == value


def test_small_domains_are_permuted():
    for size in (1, 2, 7, 10, 100):
        images = {pii.Feistel(KEY).permute(v, size, "x") for v in range(size)}
        assert images == set(range(size))


VALUES = {
    "number": ["4539 1488 0343 6467", "4539148803436467", "1234-5678-9012-3456", "9380942693487180"],
    "phone": ["+1 (961) 555-6946", "(073) 555-8658", "555-123-4567", "+49 30 1234567"],
    "social": ["123-45-6789"],
    "address": ["43.21.141.162", "0.0.0.0"],
    "date": ["2024-02-29", "31/12/1999", "12/31/1999", "01.02.2003"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "email": ["jo.99@mail9.example.com", "a@b.org"],
    "secret": ["04dbebab91ab85687d33eeaaf9ac699e1188f962", "9233A8ECF7C5B09FE5949719B6B82BC4"],
}
KEPT = ["999-45-6789", "300.1.1.1", "2023-02-30", "DE88370400440532013000", "v1.2.3", "12345",
        "1799-01-01", "mail at example"]


@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_values_keep_their_form_and_come_back(kind, value):
    names, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, undo=True)
    text = f"before {value}, after."
    new, counts = pii.pseudonymised(text, names)
    assert counts == {kind: 1} and new != text
    found = new[len("before ") : -len(", after.")]
    assert len(found) == len(value) or kind == "address"
    shape = lambda s: "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in s)
    assert shape(found) == shape(value) or kind in ("address", "secret")
    assert pii.pseudonymised(new, back)[0] == text
    assert pii.pseudonymised(f"x {value}", names)[0] == f"x {found}"
    if kind == "number":
        digits = "".join(filter(str.isdigit, value)), "".join(filter(str.isdigit, found))
        assert pii.is_luhn(digits[0]) == pii.is_luhn(digits[1])


def test_separators_do_not_unlink_equal_numbers():
    names = pii.Pseudonyms(KEY)
    one, two = names.number("4539 1488 0343 6467"), names.number("4539148803436467")
    assert one.replace(" ", "") == two
    assert pii.Pseudonyms(b"other").number("4539148803436467") != two


IBANS = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034",
         "BE68539007547034", "AT611904300234573201", "NO9386011117947"]
AFTER = ["EUR", "USD", "PAID", "PAID EUR", "2024", "12345678", "A", "AB12", "XYZW 1234 ABCD", "PAID 43.21.141.162",
         "IBAN BE68 5390 0754 7034 EUR"]


@pytest.mark.parametrize("after", AFTER)
@pytest.mark.parametrize("value", IBANS)
def test_account_numbers_end_before_words(value, after):
    """Words of capitals or digits that follow are no part of a number, and stay searched."""
    names, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, undo=True)
    text = f"FROM ACCOUNT {value} {after} TO"
    new, counts = pii.pseudonymised(text, names)
    assert counts["iban"] == 1 + after.count("BE68") and value not in new
    assert counts.get("address", 0) == after.count("141")
    assert pii.pseudonymised(new, back) == (text, counts)


def test_dates_with_a_time_and_after_other_words():
    names, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, undo=True)
    for text in ("at 2024-01-15T10:00:00Z", "AB12 CDEF GHIJ 2024-01-15 KLMN"):
        new, counts = pii.pseudonymised(text, names)
        assert counts == {"date": 1} and "2024-01-15" not in new
        assert pii.pseudonymised(new, back)[0] == text


@pytest.mark.parametrize("value", KEPT)
def test_values_that_fail_their_check_stay(value):
    assert pii.pseudonymised(f"a {value} b", pii.Pseudonyms(KEY)) == (f"a {value} b", {})


@settings(max_examples=60, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d/%m/%Y"]))
def test_dates_come_back(day, form):
    text = day.strftime(form)
    new = pii.Pseudonyms(KEY).date(text)
    assert dt.datetime.strptime(new, form) and pii.Pseudonyms(KEY, undo=True).date(new) == text


CARD = "4539 1488 0343 6467"


def test_neighbouring_values_are_told_apart():
    names, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, undo=True)
    day, social = names.date("2024-01-15"), names.social("123-45-6789")
    for text, kinds, part in [
        ("2024-01-15 2024-01-16", {"date": 2}, day),
        ("1990-02-03 2024-01-15", {"date": 2}, day),
        ("2024-01-15 1234", {"date": 1}, f"{day} 1234"),
        ("123-45-6789 987-65-4321", {"social": 1}, f"{social} 987-65-4321"),
        ("123-45-6789 123-45-6789", {"social": 2}, f"{social} {social}"),
        (f"{CARD} 2024-01-15", {"number": 1, "date": 1}, day),
        (f"123-45-6789 {CARD}", {"number": 1, "social": 1}, social),
        (f"{CARD} {CARD}", {"number": 2}, names.number(CARD)),
        (f"{CARD} 12/27", {"number": 1}, names.number(CARD)),
        ("1234-5678-9012-3456, 4539-1488-0343-6467", {"number": 2}, names.number("1234-5678-9012-3456")),
    ]:
        new, counts = pii.pseudonymised(text, names)
        assert counts == kinds and part in new
        assert pii.pseudonymised(new, back)[0] == text


@pytest.mark.parametrize("text", [
    "12 13 14 15 16 17", "1 2 3 4 5 6 7 8 9 10 11 12 13", "2019 2020 2021 2022", "12-13-14-15-16-17",
    "100 200 300 400 500", "1234 5678-9012 3456", "3-4-5 6-7-8 9-10-11 12",
])
def test_rows_of_figures_stay(text):
    assert pii.pseudonymised(f"a {text} b", pii.Pseudonyms(KEY)) == (f"a {text} b", {})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([4, 4, 4, 6, 5, 3]).flatmap(
    lambda n: st.text("0123456789", min_size=n, max_size=n)) | st.just(CARD), min_size=3, max_size=9))
def test_rows_with_numbers_come_back(groups):
    text = " ".join(groups)
    new, counts = pii.pseudonymised(text, pii.Pseudonyms(KEY))
    assert pii.pseudonymised(new, pii.Pseudonyms(KEY, undo=True)) == (text, counts)
    assert CARD not in groups or counts


def test_tables(make_docs):
    long = "word " * 40_000 + "a@b.org " + "9" * 30 + " 4539148803436467"
    rows = [(1, None), (2, ""), (3, "none"), (4, "a@b.org 43.21.141.162 a@b.org"), (4, "a@b.org"),
            (None, "a@b.org"), (9, long)]
    docs = make_docs(rows)
    got = rows_of(pii.protect(docs, KEY))
    found = {(r["doc_id"], r["n_found"], r["kinds"]) for r in got}
    assert found == {(1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 3, "address:1,email:2"),
                     (4, 1, "email:1"), (None, 1, "email:1"), (9, 2, "email:1,number:1")}
    back = pii.protect(pii.protect(docs, KEY).select("doc_id", "text"), KEY, undo=True)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in rows_of(back)), key=key) == sorted(rows, key=key)
    assert rows_of(pii.protect(make_docs([]))) == []
