import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helixframe.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("which", ["odd", "documents", "none"])
def test_every_id_lies_in_one_piece(which, request):
    docs = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(FILE)
    expected = defaultdict(int)
    for r in docs.collect():
        expected[r.doc_id, np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()] += 1
    pieces = packing.pack(docs, FILE).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32 and p.length > 0
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for (doc_id, ids), times in expected.items():
        own = [p for p in by_doc[doc_id] if p.doc_tokens == len(ids) // 4]
        cover = np.zeros(len(ids) // 4, int)
        for p in own:
            if ids[4 * p.start : 4 * (p.start + p.length)] == p.ids:
                cover[p.start : p.start + p.length] += 1
        assert (cover == times).all()
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH
    if which == "documents":
        used = sum(p.length for p in pieces)
        assert used / (packing.LENGTH * len(by_sequence)) > 0.98


def test_without_ids_digests_are_the_same(documents):
    full = packing.pack(documents, FILE).drop("ids").collect()
    assert sorted(full) == sorted(packing.pack(documents, FILE, with_ids=False).drop("ids").collect())


def test_online_windows_stay_bounded_and_merge_fills():
    rnd = random.Random(3)
    packer, closed = packing.Packer(64, 4, 4), []
    sizes = [rnd.randint(1, 150) for _ in range(500)]
    for i, n in enumerate(sizes):
        closed += packer.put(i, bytes(4 * n))
        assert len(packer.open) <= 4
    assert all(64 - 4 < w.fill <= 64 for w in closed)
    left = packing.merge(packer.open + [w for w in (packing.Window(),)], 64)
    assert sum(w.fill for w in closed + left) == sum(sizes)
    assert sum(w.fill < 64 for w in left) <= 1


def test_any_text():
    tokenizer, known = Tokenizer.from_file(FILE), packing.ChunkIds(FILE, 1000)
    rnd = random.Random(11)
    parts = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOfText|>", "x<|startoftext|>.", "<|STARTOFTEXT|>!?", "<|", "|>", "don't", "It's", "WORD", "word.", "İx", "ß", "Σας", "e\u0301", "12.5", "...", " ", "\n", "\x1c", "漢字"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6)))
        assert np.frombuffer(known.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
