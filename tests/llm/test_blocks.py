"""Long texts are handled in blocks; their figures do not depend on the blocks."""

import numpy as np
import pyarrow as pa
import pytest

from adlake.llm import quality, words

TEXTS = ["", "one", "one two", None, "a, b! c " * 900, "", "été x9 " * 400, "..."]


class Rows:
    def select(self, *_):
        return self


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_blocks_of_a_text(monkeypatch, block):
    data, at = words.text_buffers(pa.array(TEXTS))
    vectors = np.random.default_rng(1).normal(size=(1 << quality.BUCKET_BITS, quality.DIMS)).astype(np.float32)
    monkeypatch.setattr(quality, "summed", lambda _, add, __: add(iter([pa.RecordBatch.from_pydict({"text": TEXTS})])))
    whole, sums = quality.features(vectors, data, at), quality.context_sums(Rows())
    monkeypatch.setattr(quality, "BLOCK_TOKENS", block)
    assert np.allclose(quality.features(vectors, data, at), whole, rtol=0, atol=1e-12)
    assert np.array_equal(quality.context_sums(Rows()), sums)


def test_hashes_of_a_text_in_blocks(monkeypatch):
    data, at = words.text_buffers(pa.array(TEXTS))
    whole = words.split_words(data, at).hashes
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    assert np.array_equal(words.split_words(data, at).hashes, whole)
