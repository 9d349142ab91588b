"""Vectorised words and shingles against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from cartwheel.llm.words import Words
from cartwheel.llm.worker import slices, text_buffers

TEXT = st.text(st.sampled_from(list("ab é\n\t\x0b\x0c\r \xa0日")), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_shingles(texts):
    column = pa.array(texts, pa.string())
    data, offsets = text_buffers(column)
    words = Words(data, offsets)
    plain = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert [data[s:e].tobytes() for s, e in zip(words.start, words.end)] == [w for p in plain for w in p]
    assert words.count.tolist() == [len(p) for p in plain]
    for seed in (0, 1):
        h = words.hashes(seed)
        assert len({(w, x) for w, x in zip([w for p in plain for w in p], h.tolist())}) == len({w for p in plain for w in p})
        at, g = words.shingles(h, 3, seed)
        want = [tuple(p[i:i + 3]) for p in plain for i in range(len(p) - 2)]
        assert len(at) == len(want) and len(set(zip(want, g.tolist()))) == len(set(want)) == len(set(g.tolist()))


def test_slices_keep_all_rows_and_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 900, 3, 2000, 1)] + [None])], names=["t"])
    parts = list(slices([batch, batch.slice(0, 0)], "t", 904))
    assert sum((p.column("t").to_pylist() for p in parts), []) == batch.column("t").to_pylist()
    assert [p.num_rows for p in parts] == [2, 2, 1, 2] or all(p.num_rows >= 1 for p in parts)
    assert np.array_equal(text_buffers(parts[1].column("t"))[1][:1], [0])
