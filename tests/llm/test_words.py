"""Vectorised word helpers against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strataward.llm import words as w

TEXT = st.text(alphabet="ab \t\n\x0bé ", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_word_hashes_follow_words(texts):
    data = [t.encode() for t in texts]
    hashes, offsets = w.word_hashes(data)
    said = [t.split() for t in data]
    assert np.diff(offsets).tolist() == [len(s) for s in said]
    flat = [x for s in said for x in s]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert len({(x, h) for x, h in zip(flat, hashes.tolist())}) == len(set(flat))


def test_long_texts_are_cut_at_words(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(500)) + b" " + b"x" * 300
    whole = w.word_hashes([text, b"", b"tail"])
    monkeypatch.setattr(w, "SLICE_BYTES", 16)
    cut = w.word_hashes([text, b"", b"tail"])
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_runs_and_minima():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 3, 400).astype(np.uint64)
    for k in (1, 5, 8, 9, 50):
        h = w.run_hashes(v, k)
        runs = [tuple(v[i : i + k]) for i in range(len(v) - k + 1)]
        assert len(set(runs)) == len(set(h.tolist())) and len({(r, x) for r, x in zip(runs, h.tolist())}) == len(set(runs))
    for k in (1, 2, 31, 400, 401):
        want = [v[i : i + k].min() for i in range(len(v) - k + 1)]
        assert w.window_minima(v, k).tolist() == want


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 100, "", "c"])], names=["text"])
    parts = [t for _, texts in w.slices(batch, limit=12) for t in texts]
    assert parts == [b"a" * 10, b"", b"b" * 100, b"", b"c"]
