"""Permutations, formats, links and the way back."""

import re

import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import pseudonyms as ps
from cartwheel.llm.queries import op2_pseudonyms
from tests.conftest import SF01

F = ps.Feistel("k")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_of_any_domain(n):
    seen = [F.permute("t", n, x) for x in range(n)]
    assert sorted(seen) == list(range(n)) and [F.unpermute("t", n, y) for y in seen] == list(range(n))
    moved = [F.shift("t", n, x, 1) for x in range(n)]
    assert sorted(moved) == list(range(n)) and (n == 1 or all(a != b for a, b in enumerate(moved)))
    assert [F.shift("t", n, y, -1) for y in moved] == list(range(n))


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 10 ** 40), st.integers(0, 10 ** 40))
def test_large_domains(n, x):
    assert F.unpermute("t", n, F.permute("t", n, x % n)) == x % n


VALUES = {
    "card": ["4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1486", "371449635398431"],
    "phone": ["+1 (132) 555-1352", "+49 30 123456", "(415) 555-2671", "415-555-2671", "+14155552671"],
    "ipv4": ["233.254.104.120", "1.0.0.9"],
    "ssn": ["123-45-6789"],
    "date": ["1987-02-28", "28.02.1987", "28/2/1987", "02/28/1987"],
    "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"],
    "email": ["jo.98@mail5.example.com", "A.Bc-1@Example.org"],
    "secret": ["token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "password: Abcdefgh12345678_x"],
}


@pytest.mark.parametrize("kind", VALUES)
def test_values_change_within_their_format_and_come_back(kind):
    for value in VALUES[kind]:
        text = f"see {value} there, then {value}."
        new, found = ps.replace(F, text)
        assert [f[2] for f in found] == [kind, kind], value
        assert value not in new and len(new) == len(text) or kind in ("ipv4", "date")
        assert found[0][3] == found[1][3]
        shape = lambda s: re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", s)))
        if kind not in ("ipv4", "secret", "date"):
            assert shape(new) == shape(text)
        back, again = ps.replace(F, new, -1)
        assert [f[2] for f in again] == [kind, kind]
        assert back == text or kind == "date"
        assert ps.replace(ps.Feistel("other"), text)[0] != new


def test_spellings_of_one_value_stay_linked():
    one, two, three = (ps._digits(ps.card(F, v, 1)) for v in VALUES["card"][:3])
    assert one == two == three and ps.luhn_digit(one[:-1]) == one[-1]
    iso, dotted = ps.iso_date(F, "1987-02-28", 1), ps.dotted_date(F, "28.02.1987", 1)
    assert iso.split("-") == dotted.split(".")[::-1]
    assert ps.email(F, "Jo@x.org", 1).lower() == ps.email(F, "jo@X.org", 1).lower()


def test_what_is_not_valid_stays():
    text = ("4539578763621487 and 0000000000000000, 999.1.1.1, 1.2.3.4.5, 000-12-3456, 2023-02-30, 31.02.2020, DE00370400440532013000, "
            "version 2.0, 12345, a@b, @x.org, x1987-02-28, token = \"short\", 1/2/3")
    assert ps.replace(F, text) == (text, [])


NUMBERS = {"card": ["4111111111111111", "4539 5787 6362 1486", "4539-5787-6362-1486", "371449635398431", "3714 496353 98431"],
           "phone": ["+1 (826) 555-4081", "+33 1 23 45 67 89", "+14155552671", "(415) 555-2671", "415-555-2671"],
           "ipv4": ["190.137.223.204", "97.51.17.173"], "ssn": ["123-45-6789"], "date": ["1987-02-28", "28.02.1987"],
           "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"]}


@pytest.mark.parametrize("gap", [" ", ", ", "\n", " / "])
def test_adjacent_values_in_all_orders(gap):
    values = [(kind, v) for kind, vs in NUMBERS.items() for v in vs]
    alone = {v: ps.replace(F, v)[0] for _, v in values}
    for kind, one in values:
        for other, two in values:
            text = f"on {one}{gap}{two} there"
            new, found = ps.replace(F, text)
            assert new == f"on {alone[one]}{gap}{alone[two]} there", text
            assert [f[2] for f in found] == [kind, other]
            assert ps.replace(F, new, -1)[0] == text


@pytest.mark.parametrize("text, value", [
    ("call +1 (826) 555-4081 then 190.137.223.204.5", "+1 (826) 555-4081"), ("+1 (826) 555-4081 2024", "+1 (826) 555-4081"),
    ("4111111111111111 97.51.17.300", "4111111111111111"), ("4111111111111111 12/25", "4111111111111111"), ("4111111111111111 125", "4111111111111111"),
    ("on 12 4111111111111111", "4111111111111111"), ("12 4111 1111 1111 1111 12/25 123", "4111 1111 1111 1111"), ("7 41 111111 11111111 99", "41 111111 11111111"),
    ("at 1987-02-28T10:20:30Z", "1987-02-28"), ("+33 1 23 45 67 89.", "+33 1 23 45 67 89"), ("+49 30 123456 2 of 3", "+49 30 123456")])
def test_value_next_to_numbers_is_replaced_as_alone(text, value):
    new, found = ps.replace(F, text)
    start = text.index(value)
    assert (start, start + len(value)) in [f[:2] for f in found]
    assert text.replace(value, ps.replace(F, value)[0]) == new


def test_defined_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "mail jo@x.org", 0), (3, "mail jo@x.org", 0), (None, "x" * 300_000 + " 10.0.0.1", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found int")
    got = ps.pseudonymise(df, "key").collect()
    assert [r.text for r in got if r.doc_id in (1, 2)] == [None, ""] and len(got) == 5
    a, b = [r.text for r in got if r.doc_id == 3]
    assert a == b != "mail jo@x.org"
    assert [f.kind for r in got if r.doc_id is None for f in r.found] == ["ipv4"]
    back = ps.pseudonymise(ps.pseudonymise(df, "key", found=None), "key", back=True).collect()
    assert sorted(str(r.text) for r in back) == sorted(str(t) for _, t, _ in rows)
    assert ps.pseudonymise(df.limit(0), "key").collect() == []
    with pytest.raises(ValueError):
        ps.pseudonymise(df, "key", keep=["found"])


def test_query_leaves_no_value_and_keeps_links(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op2_pseudonyms(spark, SF01).collect()}
    assert set(rows) == set(docs)
    pattern = re.compile(r"(?<!\w)\d{16}(?!\w)|[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w)", re.ASCII)
    links, n = {}, 0
    for i, text in docs.items():
        values = pattern.findall(text)
        invalid = [v for v in values if v.isdigit() and ps.luhn_digit(v[:-1]) != v[-1]]
        assert all(v in rows[i].text for v in invalid)
        n += len(values)
        assert not any(v in rows[i].text for v in values if v not in invalid)
        assert len(values) - len(invalid) <= rows[i].n_found
        new = [m for m in re.findall(r"(?<!\w)\d{16}(?!\w)", rows[i].text)]
        for old, now in zip([v for v in values if v.isdigit()], new):
            assert links.setdefault(old, now) == now and (old == now) == (old in invalid)
        if not rows[i].n_found:
            assert rows[i].text == text
    assert n > 50 and len(set(links.values())) == len(links)
