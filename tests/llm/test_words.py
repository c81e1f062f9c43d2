import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from aerostar.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZé\t \n\x0b\x1f x", max_size=30)), max_size=8)


def plain(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_and_hashes_follow_the_bytes(texts, chunk):
    names, seen = {}, []
    for i, j, w in W.batches(pa.array(texts, pa.string()), lower=True, chunk=chunk):
        for k in range(j - i):
            a, b = w.docs[k], w.docs[k + 1]
            seen.append(w.text(a, b))
            for word, h in zip(w.text(a, b), w.hash[a:b].tolist()):
                low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), word)
                assert names.setdefault(low, h) == h
    assert seen == [plain(t) for t in texts]
    assert len(set(names.values())) == len(names)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 9))
def test_grams_and_sliding_minimum(values, n):
    h = W.stream(1, 4)[np.array(values, dtype=int)] if values else np.zeros(0, np.uint64)
    g = W.grams(h, n)
    own = [tuple(values[k:k + n]) for k in range(len(values) - n + 1)]
    assert len(g) == len(own)
    assert len(set(g.tolist())) == len(set(own))
    assert len({(a, b) for a, b in zip(own, g.tolist())}) == len(set(own))
    assert W.sliding_min(h, n).tolist() == [min(h[k:k + n].tolist()) for k in range(len(own))]


def test_slices_of_arrow_arrays():
    texts = pa.array(["a b", None, "c", "d e f"]).slice(1)
    parts = [w.text(w.docs[k], w.docs[k + 1]) for i, j, w in W.batches(texts) for k in range(j - i)]
    assert parts == [[], [b"c"], [b"d", b"e", b"f"]]
