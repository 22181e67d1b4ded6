"""What a worker holds beside the executor's heap."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tagloom.llm import bpe, lsh
from tagloom.llm.packing import VOCABULARY
from tagloom.llm.textcols import slices


class Caught:
    """In the place of a table: keeps the function that would run in its tasks."""

    def __getattr__(self, name):
        return lambda *_: self

    def count(self):
        return 1 << 18

    def mapInArrow(self, task, _):
        self.task = task
        return self


def test_keys_become_blocks_a_part_at_a_time(spark):
    items, bands = 1 << 15, 32
    rng = np.random.default_rng(4)
    keys = rng.integers(-(2**63), 2**63, items * bands)
    keys[:: 3 * bands] = 77  # one key in many items
    ids = np.arange(items)
    column = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, bands, dtype=np.int32)), pa.array(keys))
    batches = pa.table({"id": ids, "bands": column}).to_batches(max_chunksize=1 << 12)
    items_of = Caught()
    lsh.shared_buckets(items_of)
    got, entries = {}, 0
    tracemalloc.start()
    for batch in items_of.task(iter(batches)):
        most = tracemalloc.get_traced_memory()[1]
        for k, i in zip(batch.column(1), batch.column(2)):
            k, i = np.frombuffer(k.as_buffer(), dtype="<i8"), np.frombuffer(i.as_buffer(), dtype="<i8")
            entries += len(k)
            got[int(k[0])] = int(i[0])
            if 77 in k:
                assert set(i[k == 77].tolist()) == {0, int(ids[::3][-1])}
    tracemalloc.stop()
    assert entries == len(np.unique(keys)) + 2 and all(keys.reshape(-1, bands)[i].tolist().count(k) for k, i in got.items())
    # Keys and ids, their order and what is sorted by it, and little more.
    assert most < 7 * keys.nbytes


def test_remembered_pieces_take_little_room():
    coder = bpe.Encoder(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    rng = np.random.default_rng(8)
    texts = [" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (200, 9))) for _ in range(150)]
    for part in slices(pa.array(texts)):
        coder.rows(part)
    held = sum(x.nbytes for x in (coder.table, coder.at, coder.sizes))
    assert coder.known > 25_000 and held <= 64 * coder.known
    # Of texts without special tokens none needs the vocabulary's own tokenizer.
    assert "tokenizer" not in vars(coder)
    assert coder.rows(next(slices(pa.array(["a <|x|> b"]))))[0].tolist() == coder.tokenizer.encode("a <|x|> b", add_special_tokens=False).ids


def test_ids_of_very_many_pieces_are_forgotten(monkeypatch):
    coder = bpe.Encoder(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "REMEMBERED_IDS", 1000)
    rng = np.random.default_rng(9)
    for _ in range(20):
        (part,) = slices(pa.array([" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (3, 400)))]))
        assert coder.rows(part)[0].tolist() == coder.tokenizer.encode(part.text(0), add_special_tokens=False).ids
    assert coder.used < 3000
