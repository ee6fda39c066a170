"""Packing and token ids against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame  # noqa: F401

from salesmart.llm import arrays, packing
from salesmart.llm.fixed import tokenizer_path
from salesmart.llm.tokens import END_ID, PieceTokenizer

ODD = [None, "", "   ", "It's a 'test' ''s <|endoftext|>x <|ENDOFTEXT|> 12a3,4. déjÀ ×÷ ßÞ é ≠ 中文 a b", "don't WE'LL i'm 'sat x\x1cy \x00",
       "!" * 300, "a" * 5000, "a1b22..c–.d", "ÉTÉ OK!!", "İIΣ Σσ", "cafe\u0301 =\u0338 x", "one\ttwo\nthree\r\nfour\x0bfive\x85six"]


@pytest.fixture(scope="module")
def pieces():
    return PieceTokenizer(tokenizer_path())


def whole(pieces, text):
    return [*pieces.whole.encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("again", [1, 2])
def test_ids_are_the_tokenizers(pieces, again):
    ids, bounds = pieces.encode(*arrays.texts(pa.array(ODD, pa.string())))
    for k, text in enumerate(ODD):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == whole(pieces, text)


def test_levels_follow_the_squares():
    rng = np.random.default_rng(1)
    packer = packing.Packer(16, 0)
    for _ in range(300):
        size = int(rng.integers(1, 16))
        levels = packer.levels.copy()
        options = {}
        for level in range(16 - size + 1):
            if level and not levels[level]:
                continue
            after = levels.copy()
            if level:
                after[level] -= 1
            if level + size < 16:
                after[level + size] += 1
            options[level] = (after[:16] ** 2).sum()
        best = packer.level_for(size)
        assert options[best] == min(options.values())
        assert best == max(k for k, v in options.items() if v == min(options.values()))
        packer.add("d", np.zeros(size, np.uint32))
    packer.finish()
    assert all(p[6] & (p[6] - 1) == 0 for p in packer.done)


def test_pieces_cover_all_ids_once(frame, pieces):
    texts = ["", None, "word " * 3000, "a b c", "a b c", *(f"t{k} " * (k * 7 % 900) for k in range(60)), *ODD]
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, "no id", "x", 1)]
    out = packing.pack(frame(rows, "doc_id long, text string, Length string, start int"), tokenizer_path()).toPandas()
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in out.itertuples():
        by_doc[None if r.doc_id != r.doc_id else int(r.doc_id)].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by_doc) == {r[0] for r in rows}
    for key, text, *_ in rows:
        ids, at = np.array(whole(pieces, text), "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == held[0].sequence_length <= 2048
        assert at & (at - 1) == 0


def test_no_rows(frame):
    assert packing.pack(frame([]), tokenizer_path()).count() == 0
