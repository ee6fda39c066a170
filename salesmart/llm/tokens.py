"""Token ids of whole texts by a public tokenizer, with the ids of frequent pieces remembered.

The tokenizer (lower case, white space dropped, words split from digits and marks) never joins pieces across white
space, so a text's ids are those of its white-space-free chunks in turn. Chunks of ASCII and Latin-1 letters, digits and
marks are cut into the tokenizer's own pieces here; chunks with anything else (apostrophes, other scripts,
control characters, special-token brackets) go to the tokenizer as they are. Each distinct piece is tokenized once
while it stays in a table of fixed size, whose entries newer pieces replace.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from salesmart.llm import arrays

#: End-of-document id that follows each text.
END_ID = 1
#: A worker keeps 24 bytes per slot and 4 per id: 28 MB in all.
_SLOTS = 1 << 19
_KEPT_IDS = 1 << 22
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)

_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _MARK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[39] = _OTHER  # an apostrophe may begin a contraction


class PieceTokenizer:
    """Ids of many texts at once; see the module."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for pieces that are lower case and split already
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        self.ends_piece = np.zeros(self.whole.get_vocab_size(), bool)
        self.ends_piece[[i for token, i in self.whole.get_vocab().items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(_SLOTS, np.uint64)
        self.start = np.zeros(_SLOTS, np.int64)
        self.length = np.zeros(_SLOTS, np.int64)
        self.ids = np.zeros(_KEPT_IDS, np.uint32)
        self.used = 0

    def _plain_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many pieces to a call; each gives one token that ends a piece."""
        joined = [" ".join(pieces[i : i + 1000]) for i in range(0, len(pieces), 1000)]
        flat = np.concatenate([np.array(x.ids, np.uint32) for x in self.plain.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends_piece[flat])
        return flat, np.diff(ends, prepend=-1)

    def _whole_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.whole.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, keys: np.ndarray, flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(_KEPT_IDS, len(flat)), np.uint32)])
        start = self.used + np.cumsum(length) - length
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        slot = (keys & np.uint64(_SLOTS - 1)).astype(np.int64)
        self.key[slot], self.start[slot], self.length[slot] = keys, start, length
        # two new pieces may share a slot: the last one written owns it
        mine = self.key[slot] == keys
        lost = slot[~mine]
        self.key[lost] = 0  # then none does, and both are learnt again when they come back
        return start, length

    def _pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes in lower case, piece starts and ends, whether a piece goes to the whole tokenizer, its row."""
        kind = _KIND[data]
        low = arrays.LOWER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        letter = (tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)
        lead, tail = lead[letter], tail[letter]
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead + 1] = np.where((tail >= 0x80) & (tail <= 0x9E), tail + 0x20, tail)
        starts, ends, rows = arrays.words(data, at, arrays.SPACES)
        if not len(starts):
            return low, starts, ends, np.zeros(0, bool), rows
        odd = kind == _OTHER
        odd[np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))] = True  # "<|"
        seen = np.concatenate([[0], np.cumsum(odd)])
        strange = seen[ends] > seen[starts]
        # pieces of the other chunks: runs of letters, runs of marks, single digits
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, starts[strange], 1)
        np.add.at(inside, ends[strange], -1)
        cut &= np.cumsum(inside) == 0
        cut[starts] = True
        cut[ends] = True
        first = np.flatnonzero(cut[:-1] & (kind != _SPACE))
        edges = np.flatnonzero(cut)
        last = edges[np.searchsorted(edges, first, "right")]
        chunk = np.searchsorted(starts, first, "right") - 1
        return low, first, last, strange[chunk], rows[chunk]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows with ``END_ID`` after each, and where each row's ids start (one more for the end)."""
        if self.used > _KEPT_IDS // 2:
            self.forget()
        n = len(at) - 1
        low, first, last, strange, rows = self._pieces(data, at)
        keys = np.where(strange, 0, arrays.span_hashes(arrays.running(low), first, last)) if len(first) else np.zeros(0, np.uint64)
        if strange.any():
            keys[strange] = arrays.span_hashes(arrays.running(data), first[strange], last[strange]) ^ np.uint64(0x5851F42D4C957F2D)
        keys = np.where(keys == 0, np.uint64(1), keys)
        slot = (keys & np.uint64(_SLOTS - 1)).astype(np.int64)
        new = np.flatnonzero(self.key[slot] != keys)
        start, length = self.start[slot], self.length[slot]
        if len(new):
            fresh, pick, back = np.unique(keys[new], return_index=True, return_inverse=True)
            pick = new[pick]
            odd = strange[pick]
            s, w = np.empty(len(pick), np.int64), np.empty(len(pick), np.int64)
            for which, source, ids_of in ((odd, data, self._whole_ids), (~odd, low, self._plain_ids)):
                if which.any():
                    held = source.tobytes()
                    pieces = [held[a:b].decode("utf-8", "replace") for a, b in zip(first[pick[which]].tolist(), last[pick[which]].tolist(), strict=True)]
                    s[which], w[which] = self._learn(fresh[which], *ids_of(pieces))
            start[new], length[new] = s[back], w[back]
        per_row = np.bincount(rows, weights=length, minlength=n).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_row + 1)])
        out = np.full(int(bounds[-1]), END_ID, np.uint32)
        total = int(length.sum())
        if total:
            before = np.cumsum(length) - length
            source = np.arange(total) + np.repeat(start - before, length)
            out[np.arange(total) + np.repeat(rows, length)] = self.ids[source]
        return out, bounds


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer for each worker process."""
    return PieceTokenizer(path)
