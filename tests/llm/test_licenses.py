"""Licence families, look-alikes, and the column form against the plain form."""

import math
import textwrap

import pytest

from cartwheel.llm import licenses as lc
from cartwheel.llm.queries import op5_licenses
from tests.conftest import SF01


@pytest.fixture(scope="module")
def model(spark):
    return lc.fit(spark.read.parquet(f"{SF01}/documents.parquet"))


def brute(model, rows):
    out = []
    for i, text in rows:
        for k, p in enumerate(lc.paragraphs(text) if text is not None else []):
            best = {}
            for at, w in lc.windows(lc.tokens(p)):
                g = lc.ngrams(w)
                pr = model.probabilities(g)[:-1]
                if not set(w) & set(model.words) or round(pr.max(), lc.DIGITS) < model.threshold:
                    continue
                family = model.families[int(pr.argmax())]
                shares = [(len(set(g) & set(t)) / min(len(g), len(t)), -j, len(set(g) & set(t))) for j, t in enumerate(lc.ngrams(lc.tokens(x)) for x in lc.TEMPLATES[family])]
                share, j, both = max(shares)
                found = (share >= lc.CONFIRMING and both >= lc.CONFIRMING_GRAMS, round(float(pr.max()), lc.DIGITS), -at, share, j)
                best[family] = max(best.get(family, found), found)
            for family, (confirmed, pr, at, share, j) in best.items():
                out.append((i, k, family, -at, round(pr, 6), -j if share else None, round(share, 9), confirmed))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.paragraph, r.family, r.word, round(r.probability, 6), r.template, round(r.share, 9), r.confirmed) for r in df.collect()), key=repr)


def embedded(spark, words):
    """Every template among corpus words, plain and wrapped at 60 columns behind comment marks: (text, family)."""
    pool = [t for r in spark.read.parquet(f"{SF01}/documents.parquet").orderBy("doc_id").select("text").limit(40).collect() for t in r.text.split()]
    pool = [w for w in pool if not any(x in w.lower() for x in ("licen", "copyright", "rights"))]
    out = []
    for k, f in enumerate(lc.TEMPLATES):
        for j, t in enumerate(lc.TEMPLATES[f]):
            at = 37 * (7 * k + j) % 3000
            text = " ".join([*pool[at:at + words], t, *pool[at + words:at + 2 * words]])
            out += [(text, f), ("\n".join("# " + line for line in textwrap.wrap(text, 60)), f)]
    return out


@pytest.mark.parametrize("words", [0, 50, 200, 1000])
def test_embedded_and_wrapped_notices_are_told(spark, model, words):
    cases = embedded(spark, words)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    told = {(r.doc_id, r.family) for r in lc.scan(df, model).collect() if r.confirmed}
    missed = [f for i, (_, f) in enumerate(cases) if (i, f) not in told]
    assert len(missed) <= 0.05 * len(cases), missed


def test_paragraphs_and_late_notices(spark, model):
    notice = lc.TEMPLATES["MIT"][1]
    text = "\n".join(f"line {i} of the tale" for i in range(500)) + "\n#\n# " + notice.replace(" to ", " to\n# ") + "\n \r\n" + lc.TEMPLATES["ISC"][1]
    assert len(lc.paragraphs(text)) == 3 and len(lc.paragraphs("a" + "\n" * 50_000 + "b")) == 2
    df = spark.createDataFrame([(1, text), (2, "a" + "\n" * 50_000 + "Released under the MIT License.")], "doc_id long, text string")
    got = {(r.doc_id, r.paragraph, r.family) for r in lc.scan(df, model).collect() if r.confirmed}
    assert got == {(1, 1, "MIT"), (1, 2, "ISC"), (2, 1, "MIT")}


def test_templates_are_told_and_lookalikes_are_not(model):
    right = wrong = 0
    for k, f in enumerate(model.families):
        for t in lc.TEMPLATES[f]:
            p = model.probabilities(lc.ngrams(lc.tokens(t)))
            right += int(p[:-1].argmax() == k and p[:-1].max() >= model.threshold)
            wrong += 1
    assert right / wrong > 0.95
    for t in lc.LOOKALIKES:
        p = model.probabilities(lc.ngrams(lc.tokens(t)))
        assert p[:-1].max() < model.threshold, t
    assert model.probabilities([])[-1] == model.probabilities([]).max()


def test_unseen_notices(model):
    cases = {"Code is licensed under the Apache License Version 2.0 by the team.": "Apache-2.0", "Distributed under the MIT license.": "MIT",
             "This work is licensed under the GNU General Public License, version 2.": "GPL", "Content licensed under CC BY-NC 4.0": "CC-BY-NC",
             "Licensed under a Creative Commons Attribution ShareAlike 4.0 license": "CC-BY-SA"}
    told = {t: model.families[int(model.probabilities(lc.ngrams(lc.tokens(t)))[:-1].argmax())] for t in cases}
    assert told == cases


def test_columns_equal_plain_form(spark, model):
    texts = ["Prose.\n" + t + "\nMore prose of the day." for f in model.families for t in lc.TEMPLATES[f]]
    texts += lc.LOOKALIKES + [None, "", "\n\n", "Line one of a wrapped\nMIT License notice, released under the MIT License.\n\nnext"]
    rows = [(i, t, "f") for i, t in enumerate(texts)] + [(0, texts[0], "f"), (0, texts[0], "f"), (None, texts[1], "f"), (99_000, "x y " * 50_000 + ". \n" + texts[4], "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = lc.scan(df, model)
    assert rows_of(got) == brute(model, [r[:2] for r in rows])
    assert lc.scan(df.limit(0), model).collect() == []
    assert not any("Python" in line or "Arrow" in line for line in got._jdf.queryExecution().toString().splitlines())
    with pytest.raises(ValueError):
        lc.scan(df, model, keep=["family"])
    assert lc.scan(df, lc.fit(df.limit(0))).count() >= 1  # trained without a corpus


def test_query_finds_every_notice(spark):
    notices = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
               "All rights reserved.": "Proprietary"}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    want = {(i, 0, f) for i, t in docs for n, f in notices.items() if n in t}
    rows = op5_licenses(spark, SF01).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in rows if r.confirmed} == want
    assert all(math.isfinite(r.probability) for r in rows) and len(rows) <= len(want) * 1.1
