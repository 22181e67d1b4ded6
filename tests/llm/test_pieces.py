"""Remembered pieces of the encoder, postings of documents that are used up."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tagloom.llm import bpe
from tagloom.llm.packing import VOCABULARY, Index
from tagloom.llm.textcols import slices


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def test_pieces_that_want_one_place(coder):
    coder._forget()
    coder._empty(16)
    hashes = np.array([1, 3, 5, 7, (1 << 64) - 1, (1 << 64) - 3, 9], dtype=np.uint64)  # the last place and on from the first
    coder._put(hashes, np.arange(7) * 10, np.arange(7))
    place = coder._places(hashes)
    assert len(set(place.tolist())) == 7 and coder.at[place].tolist() == [0, 10, 20, 30, 40, 50, 60]
    assert coder.sizes[place].tolist() == list(range(7))
    other = np.array([11, (1 << 64) - 5], dtype=np.uint64)
    assert (coder.table[coder._places(other)] == 0).all()


@pytest.mark.parametrize("remembered", [1_000_000, 100])
def test_ids_while_the_table_grows_and_is_emptied(coder, monkeypatch, remembered):
    monkeypatch.setattr(bpe, "REMEMBERED", remembered)
    coder._forget()
    coder._empty(16)
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(1, 30, 900)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(80)] + [None, "", "x" * 3000]
    for _ in range(2):
        for part in slices(pa.array(texts, pa.string()), 2000):
            for k, ids in enumerate(coder.rows(part)):
                assert ids.tolist() == coder.tokenizer.encode(part.text(k), add_special_tokens=False).ids
    assert coder.known <= max(remembered, 100) + 900 and 2 * coder.known <= len(coder.table)


def test_neighbours_are_the_same_when_others_are_used_up():
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 300, rng.integers(1, 80)).astype(np.uint16) for _ in range(60)]
    idf, unused = np.linspace(1, 9, 1 << 16), np.ones(60, dtype=bool)
    index = Index(docs, idf, 40.0)
    at_first = len(index.docs)
    for seed in rng.permutation(60):
        unused[seed] = False
        assert index.neighbours(seed, unused).tolist() == Index(docs, idf, 40.0).neighbours(seed, unused).tolist()
    assert len(index.docs) < at_first and not len(index.neighbours(0, unused))
