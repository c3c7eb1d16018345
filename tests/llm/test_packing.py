import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cratelight.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def test_ids_are_those_of_whole_texts(tokenizer):
    encode = packing.encoder(packing.default_tokenizer())
    texts = ["", " \n", "<|endoftext|>x <|ENDOFTEXT|> a.b,, c.", "É é Ǆ İ ẞ e\u0301 a\u00a0b \x1c \x85 it's don't 1234 $$$ a", "ΑΣ ΑΣ. x y", "thing. thing, THING!!! tête tête-à-tête", "naïve* <|startoftext|> don't. rock'n'roll,"]
    for text in texts:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip(edges, tokenizer):
    docs = edges.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    places = packing.pack_documents(docs).cache()
    rows = places.collect()
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    whole = {r.sequence_id: r.ids for r in packing.sequences(docs, places).collect()}
    total = 0
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    for key, members in by_sequence.items():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length <= packing.CAPACITY
            part = want[r.doc_id][r.start : r.start + r.length]
            assert len(part) == r.length and whole[key][at : at + r.length] == part
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at <= packing.CAPACITY
        total += at
    assert total == sum(map(len, want.values()))
    pieces = collections.Counter(r.doc_id for r in rows)
    assert all(pieces[i] == -(-len(ids) // packing.CAPACITY) for i, ids in want.items())


def test_search_empties_a_bin_that_best_fit_leaves():
    sizes = np.array([6, 5, 4, 4, 3, 3, 3, 2])  # 30 fill three bins of 10
    rng = np.random.default_rng(1)
    won = 0
    for _ in range(60):
        sizes = rng.integers(150, 700, 60)
        bins = packing.best_fit(sizes, 1000)
        better = packing.local_search(sizes, bins, 1000)
        assert np.bincount(better, sizes).max() <= 1000 and len(better) == len(sizes)
        assert len(np.unique(better)) <= len(np.unique(bins))
        won += len(np.unique(better)) < len(np.unique(bins))
    assert won
