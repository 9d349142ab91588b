"""Myers distance, pigeonhole search and planted passages against brute force."""

import random
import unicodedata

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from cartwheel.llm import decontaminate as dc
from cartwheel.llm.queries import op8_decontamination
from tests.conftest import SF01


def sellers(pattern, text):
    """Least edit distance of the pattern to any part of the text, and its first end."""
    row = list(range(len(pattern) + 1))
    best = None
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        if best is None or row[-1] < best[0]:
            best = (row[-1], j)
    return best


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=12).map(lambda b: bytes(97 + x % 3 for x in b)), st.binary(max_size=30).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_myers_equals_dynamic_programming(pattern, text):
    want = sellers(pattern, text)
    got = dc.myers(pattern, text, len(pattern))
    if want is None or want[0] > len(pattern):
        assert got is None
    elif want[0] < len(pattern):
        assert got == want


def test_normalised_places():
    texts = ["Héllo,  World!", "", "--", "a", " b.c "]
    data, offsets, place = dc.normalised(pa.array(texts))
    got = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
    assert [g.split() for g in got] == [["héllo".encode(), b"world"], [], [], [b"a"], [b"b", b"c"]]
    assert all(g.startswith(b" ") and g.endswith(b" ") for g in got)
    raw = b"".join(t.lower().encode() for t in texts)
    assert all(raw[p] == c for p, c in zip(place, data) if c != 32)
    assert dc.normal_text("A--b") == b"a b" and dc.normal_text(None) == b""


def test_unicode_signs_are_blanks():
    assert dc.normal_text("\u201cDon\u2019t\u201d\u2014he\u00a0said\u2026\u3000\uff0cso\uff01") == b"don t he said so"
    assert dc.normal_text("na\u00efve cafe\u0301 \u4e2d\u6587 \u0967\u0968 \U0001d7d8 \U0001f600") == "na\u00efve cafe\u0301 \u4e2d\u6587 \u0967\u0968 \U0001d7d8".encode()
    for c in range(0x80, 0x110000, 7):
        if not 0xD800 <= c < 0xE000 and chr(c).lower() == chr(c):
            assert (dc.normal_text(chr(c)) == chr(c).encode()) == (unicodedata.category(chr(c))[0] in "LNM"), hex(c)


def test_typographic_copies(spark):
    plain = '"Who," he asked, "has seen it?" - "Nobody," they said - "nobody at all," and the "old house" stood empty.'
    curly, n = "", 0
    for c in plain:
        n += c == '"'
        curly += {'"': "\u201c\u201d"[(n + 1) % 2], "-": "\u2014", " ": "\u00a0", ",": "\uff0c", ".": "\u2026"}.get(c, c)
    docs = spark.createDataFrame([(1, f"\u2026before\u3000{curly}\u201d after"), (2, plain), (3, "\u201cnothing\u201d")], "doc_id long, text string")
    for item in (plain, curly):
        bench = spark.createDataFrame([(7, item)], "item_id long, text string")
        got = {r.doc_id: r.matches for r in dc.find(docs, bench).collect()}
        assert [(m.item_id, m.errors) for i in (1, 2) for m in got[i]] == [(7, 0), (7, 0)] and got[3] == []
        text = f"\u2026before\u3000{curly}\u201d after".lower().encode()
        assert dc.normal_text(text[got[1][0].start:got[1][0].end].decode()) == dc.normal_text(plain)
        assert [r.doc_id for r in dc.without_matches(docs, bench).collect()] == [3]


def edited(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        k = rng.randrange(len(t))
        t[k:k + 1] = rng.choice([[], [t[k], "q"], ["q"]])
    return "".join(t)


def test_planted_items(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(25)) for i in range(20)] + [(20, "Tiny"), (21, "..."), (22, None), (0, None)]
    items += [items[3]]
    docs, want = [], set()
    for d in range(120):
        i = rng.randrange(20)
        n = len(dc.normal_text(items[i][1]))
        kind = d % 4
        inside = {0: items[i][1].upper().replace(" ", ",\n"), 1: edited(rng, items[i][1], int(n * dc.ERROR_RATE) // 2), 2: edited(rng, items[i][1], n // 3), 3: prose(5)}[kind]
        if kind < 2:
            want.add((d, i))
        docs.append((d, f"{prose(rng.randrange(0, 30))} {inside} {prose(rng.randrange(0, 30))}", "m"))
    docs += [(500, None, "m"), (501, "", "m"), (502, "the tiny thing", "m"), (503, "tinyish", "m"), (504, items[1][1], "m"), (504, items[1][1], "m")]
    want |= {(502, 20), (504, 1)}
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find(df, bench, keep=["doc_id", "item_id", "text"]).collect()
    assert len(found) == len(docs)
    got = {(r.doc_id, m.item_id) for r in found for m in r.matches}
    rates = dict(items[:21])
    for d, t, _ in docs:
        for i, item in rates.items():
            p, s = dc.normal_text(item), b" " + dc.normal_text(t) + b" "
            near = sellers(p, s)[0] if t else 99
            budget = int(len(p) * dc.ERROR_RATE)
            held = near <= budget if budget else (b" " + p + b" ") in s
            assert held == ((d, i) in got), (d, i, near)
    assert want <= got
    for r in found:
        for m in r.matches:
            assert len({(x.item_id) for x in r.matches}) == len(r.matches)
            piece = r.text.lower().encode()[m.start:m.end].decode()
            p = dc.normal_text(rates[m.item_id])
            assert sellers(p, dc.normal_text(piece))[0] <= m.errors + 1 and abs(len(dc.normal_text(piece)) - len(p)) <= m.errors + 1
    kept = dc.without_matches(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in found if not r.matches)
    assert len(dc.without_matches(df, bench.limit(0)).collect()) == len(docs) and dc.find(df.limit(0), bench).collect() == []


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300)
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    one = sorted(map(repr, dc.find(docs, bench).selectExpr("doc_id", "inline(matches)").collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    assert sorted(map(repr, dc.find(docs, bench).selectExpr("doc_id", "inline(matches)").collect())) == one


def test_query_finds_all_exact_passages(spark):
    docs = {r.doc_id: dc.normal_text(r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    items = {r.item_id: dc.normal_text(r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, p in items.items() if p in t}
    rows = op8_decontamination(spark, SF01).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.errors == 0} == want
    assert all(sellers(items[r.item_id], docs[r.doc_id][:40_000])[0] <= r.errors for r in rows if r.errors)
