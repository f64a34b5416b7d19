"""Token files and packing against plain loops over the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from docflow.llm import packing, tokens
from docflow.llm.queries import tokenizer_path
from docflow.session import scratch_dir

END = 2


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [END]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library):
    rng = random.Random(3)
    signs = "aZé'ß’<|> \n\t\x1c\xa0́ İıµª·×÷5٣日本&*-sStrǅ\x85​"
    encode = tokens.Encoder(tokenizer_path())
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["don't we'll 'tis 's x's5's", "a<|endoftext|>b", "Word, word. WORD!"]
    for text in texts:
        assert np.frombuffer(encode(text), encode.dtype).tolist() == ids_of(library, text)[:-1], text


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 3)
    monkeypatch.setattr(tokens, "MAX_WORDS", 2)
    encode = tokens.Encoder(tokenizer_path())
    text = "one two three, four five one two three! six seven one"
    assert np.frombuffer(encode(text), encode.dtype).tolist() == ids_of(library, text)[:-1]


def test_files_round_trip(docs, corpus, library):
    found = tokens.token_file_digest(docs, tokenizer_path()).orderBy("position").collect()
    order = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert [r.doc_id for r in found] == [i for i, _ in order]
    for row, (_, text) in zip(found, order, strict=True):
        ids = ids_of(library, text)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_uncommitted_files_are_not_read(spark, docs):
    folder = scratch_dir(spark, "tokens")
    tokens.write_token_files(docs, tokenizer_path(), folder)
    before = sorted(tokens.read_token_files(spark, folder).collect(), key=lambda r: r.position)
    # What a task that was lost half way leaves behind.
    store, at = tokens._store(folder)
    with store.open_output_stream(f"{at}/parts/000000-lost.ids") as file:
        file.write(b"\x01\x02")
    assert sorted(tokens.read_token_files(spark, folder).collect(), key=lambda r: r.position) == before


def test_no_documents(nothing):
    assert tokens.token_file_digest(nothing, tokenizer_path()).count() == 0
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_is_whole_and_gapless(docs, corpus, library, window):
    pieces = packing.pack_documents(docs, tokenizer_path(), window=window).collect()
    texts = defaultdict(list)
    for i, t in corpus:
        texts[i].append(ids_of(library, t))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert by_doc.keys() == texts.keys()
    for i, some in by_doc.items():
        if len(texts[i]) > 1:  # a repeated row is packed as often as it occurs
            assert sum(p.length for p in some) == sum(map(len, texts[i]))
            continue
        at = 0
        for p in sorted(some, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(texts[i][0]))
            assert p.ids_crc32 == crc(texts[i][0][at : at + p.length])
            at += p.length
        assert at == len(texts[i][0])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for some in by_seq.values():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_level_by_sum_of_squares():
    rng = random.Random(1)
    for _ in range(300):
        window = 12
        counts = np.zeros(window + 1, np.int64)
        for level in range(1, window):
            counts[level] = rng.choice([0, 0, 1, 2, 5])
        size = rng.randint(1, window - 1)

        def after(level):
            new = counts.copy()
            if level:
                new[level] -= 1
            if level + size < window:
                new[level + size] += 1
            return int((new[1:window] ** 2).sum())

        choices = [0, *[h for h in range(1, window - size + 1) if counts[h]]]
        best = min(map(after, choices))
        assert packing.best_level(counts, size) == max(h for h in choices if after(h) == best)


def test_open_windows_are_bounded():
    packer = packing.Packer(window=100, max_open=5)
    for k in range(400):
        packer.add(k, np.full(51 + k % 7, k))
        assert packer.n_open <= 6
    packer.finish()
    assert sum(len(p[2]) for w in packer.done for p in w) == sum(51 + k % 7 for k in range(400))
