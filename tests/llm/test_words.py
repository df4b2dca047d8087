from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewright.llm.batches import cut_keys, join_keys, slices, text_batch
from tidewright.llm.words import LOWER, Batch, windows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b\x1c 中'", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_of_a_batch(texts):
    data, offsets = text_batch(pa.array(texts, pa.string()))
    b = Batch(data, offsets)
    want = [WORD.findall((t or "").encode()) for t in texts]
    assert [[data[s:e] for s, e in zip(b.starts[x:y], b.ends[x:y], strict=True)] for x, y in zip(b.first[:-1], b.first[1:], strict=True)] == want
    h = b.hashes()
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))
    keys, at = windows(h, b.counts, 3)
    grams = [tuple(ws[i : i + 3]) for ws in want for i in range(len(ws) - 2)]
    assert len(keys) == len(grams) and len(set(zip(grams, keys.tolist(), strict=True))) == len(set(grams)) == len(set(keys.tolist()))


def test_long_words():
    texts = ["x" * 5000, "x" * 5001, "y" * 9, "x" * 5000]
    h = Batch(*text_batch(pa.array(texts))).hashes().tolist()
    assert h[0] == h[3] and len(set(h)) == 3


def test_lower_is_ascii():
    assert "AbÉZ[@".encode().translate(LOWER) == "abÉz[@".encode()


def test_keys_without_leading_bytes():
    import numpy as np

    keys = np.array([0x0102030405060708, 0x01FFFFFFFFFFFFFF], dtype=np.uint64)
    for lead in (1, 2, 3):
        assert (join_keys(cut_keys(keys, lead), lead) == keys & np.uint64((1 << (64 - 8 * lead)) - 1)).all()


def test_slices_are_bounded():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 10, None, "b" * 100, "", "c" * 10])})
    assert [s.num_rows for s in slices(iter([batch]), "text", 50)] == [2, 1, 2]
