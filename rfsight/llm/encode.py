"""Token ids of whole texts by a byte-level tokenizer file of the tokenizers library.

The library encodes each distinct word once per worker, as far as memory allows; texts are put together from
the ids of their words. That is exact: no pre-token of these tokenizers reaches from a word into the blank behind
it, nor from a run of letters into the punctuation behind it. Texts that aren't plainly of that form (double
blanks, other white space) are given to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from rfsight.llm.arrow import BYTE_VALUES, prefix_sums, slice_hashes, utf8

_CODES = np.arange(256)
BLANK = np.isin(_CODES, [10, 32])
ASCII_LETTER = ((_CODES | 32) >= ord("a")) & ((_CODES | 32) <= ord("z")) & (_CODES < 128)
PUNCTUATION = (_CODES > 32) & (_CODES < 127) & ~ASCII_LETTER & ~((_CODES >= ord("0")) & (_CODES <= ord("9")))
OTHER_SPACE = np.isin(_CODES, [9, 11, 12, 13, 28, 29, 30, 31])
#: Lead bytes of U+00C0 to U+023F, all letters but the two signs below.
LATIN_LEAD = (_CODES >= 0xC3) & (_CODES <= 0xC8)
#: UTF-8 of white space and of the signs of multiplication and division.
WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F)]
WIDE_SPACE += [chr(0x3000).encode()]
SIGNS = [chr(0xD7).encode(), chr(0xF7).encode()]
#: A character that no merge joins to its neighbours; it parts words that are encoded in one call.
PARTING = "\x00"


def _at(data: np.ndarray, pattern: bytes) -> np.ndarray:
    """Positions where ``pattern`` starts."""
    found = np.flatnonzero(data[: max(0, len(data) - len(pattern) + 1)] == pattern[0])
    for k, byte in enumerate(pattern[1:], 1):
        found = found[data[found + k] == byte]
    return found


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, stops, rows given whole): words with the blank before them, letters and punctuation apart."""
    n = len(data)
    blank = BLANK[data]
    row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first = np.zeros(n + 1, bool)
    first[row_starts] = True
    first[n] = True
    # a blank before a blank or at the end of its row
    odd = np.flatnonzero(blank & (np.append(blank[1:], True) | first[1:]))
    odd = [odd, np.flatnonzero(OTHER_SPACE[data])]
    if (data >= 0xC2).any():
        leads = np.unique(data[data >= 0xC2])
        odd += [_at(data, x) for x in WIDE_SPACE if x[0] in leads]
    whole = np.zeros(len(offsets) - 1, bool)
    whole[np.searchsorted(offsets, np.concatenate(odd), side="right") - 1] = True
    starts = np.flatnonzero(blank | first[:n])
    keep = ~whole[np.searchsorted(offsets, starts, side="right") - 1]
    stops = np.append(starts[1:], n)[keep]
    starts = starts[keep]
    # a word of the form blank, letters, punctuation is cut before the punctuation
    mark = PUNCTUATION[data]
    letter = ASCII_LETTER[data]
    lead = np.flatnonzero(LATIN_LEAD[data])
    letter[lead] = letter[lead + 1] = True  # UTF-8: a continuation byte follows
    for sign in SIGNS:
        letter[_at(data, sign)] = False
    run = mark.copy()
    run[1:] &= ~mark[:-1]
    run[starts] = mark[starts]
    letters, marks, runs = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (letter, mark, run))
    size = stops - starts - blank[starts]
    n_marks = marks[stops] - marks[starts]
    both = (n_marks > 0) & (n_marks < size) & (letters[stops] - letters[starts] + n_marks == size)
    both &= (runs[stops] - runs[starts] == 1) & mark[stops - 1]
    cuts = (stops - n_marks)[both]
    order = np.argsort(np.concatenate([starts, cuts]), kind="stable")
    all_starts = np.concatenate([starts, cuts])[order]
    ends = stops.copy()
    ends[both] = cuts
    all_stops = np.concatenate([ends, stops[both]])[order]
    return all_starts, all_stops, whole


class Memo:
    """Ids by word hash: a table of four places per word, overwritten where they are taken; bounded memory."""

    PROBES = 4

    def __init__(self, bits: int = 21) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros((1 << bits) + self.PROBES, np.uint64)
        self.where = np.zeros((1 << bits) + self.PROBES, np.int32)
        self.clear()

    def clear(self) -> None:
        self.keys[:] = 0
        self.places, self.count, self.used = np.zeros((1024, 2), np.int64), 0, 0
        self.pool = np.zeros(4096, np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index into ``places`` of each hash, -1 where it isn't known."""
        slots = (hashes & self.mask).astype(np.int64)
        found = np.where(self.keys[slots] == hashes, self.where[slots], -1)
        left = np.flatnonzero(found < 0)
        for k in range(1, self.PROBES):
            if not len(left):
                break
            there = slots[left] + k
            hit = self.keys[there] == hashes[left]
            found[left[hit]] = self.where[there[hit]]
            left = left[~hit]
        return found

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Words not yet known, with their ids one after another."""
        while self.count + len(hashes) > len(self.places):
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        index = self.count + np.arange(len(hashes))
        self.places[index, 0] = self.used + np.cumsum(lengths) - lengths
        self.places[index, 1] = lengths
        self.pool[self.used : self.used + len(ids)] = ids
        self.count, self.used = self.count + len(hashes), self.used + len(ids)
        left = np.arange(len(hashes))
        for k in range(self.PROBES):
            slots = (hashes[left] & self.mask).astype(np.int64) + k
            free = self.keys[slots] == 0
            self.keys[slots[free]], self.where[slots[free]] = hashes[left[free]], index[left[free]]
            left = left[self.keys[slots] != hashes[left]]
        slots = (hashes[left] & self.mask).astype(np.int64)
        self.keys[slots], self.where[slots] = hashes[left], index[left]


class Encoder:
    """Encodes Arrow columns of texts."""

    #: Words kept at most; each takes some 40 bytes.
    MOST = 1_000_000

    def __init__(self, path: str, end_id: int | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([] if end_id is None else [end_id], np.uint32)
        self.id_bytes = 2 if max(self.tokenizer.get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else 4
        self.parting = self.tokenizer.encode(PARTING, add_special_tokens=False).ids
        self.memo = Memo()

    def _fresh(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        """As _fresh for runs of letters: one call over all, parted by a character that joins nothing."""
        if texts and len(self.parting) == 1:
            ids = np.array(self._fresh([PARTING.join(texts)])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.parting[0])
            if len(cuts) == len(texts) - 1:
                bounds = [0, *(cuts + 1).tolist()]
                return [ids[a:b] for a, b in zip(bounds, [*cuts.tolist(), len(ids)], strict=True)]
        return [np.array(x, np.uint32) for x in self._fresh(texts)]

    def _learn(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, hashes: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        plain = [(t[1:] if t[0] in " \n" else t).isalpha() and max(t) < chr(0x240) for t in texts]
        ids = {True: iter(self._together([t for t, p in zip(texts, plain, strict=True) if p]))}
        ids[False] = iter(self._fresh([t for t, p in zip(texts, plain, strict=True) if not p]))
        found = [next(ids[p]) for p in plain]
        lengths = np.array([len(x) for x in found], np.int64)
        self.memo.add(hashes, np.concatenate([np.asarray(x, np.uint32) for x in found]), lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): row i is ids[offsets[i]:offsets[i + 1]], the end id last. A null is an empty text."""
        data, offsets = utf8(texts)
        rows = len(offsets) - 1
        starts, stops, whole = words(data, offsets)
        hashes = slice_hashes(prefix_sums(BYTE_VALUES[data]), starts, stops) | np.uint64(1)
        found = self.memo.find(hashes)
        if (found < 0).any():
            if self.memo.count > self.MOST:
                self.memo.clear()
                found[:] = -1
            new, at = np.unique(hashes[found < 0], return_index=True)
            at = np.flatnonzero(found < 0)[at]
            known = self.memo.count
            self._learn(data, starts[at], stops[at], new)
            # words of this batch by their order in it; the table itself may have overwritten some
            missing = found < 0
            found[missing] = known + np.searchsorted(new, hashes[missing])
        places = self.memo.places[found]
        lengths = places[:, 1]
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = self.memo.pool[np.repeat(places[:, 0] - before, lengths) + np.arange(total)]
        word_offsets = np.searchsorted(starts, offsets)
        cuts = np.append(before, total)[word_offsets]
        given: dict[int, list[int]] = {}
        if whole.any():
            odd = self._fresh(texts.filter(pa.array(whole)).to_pylist())
            given = dict(zip(np.flatnonzero(whole).tolist(), odd, strict=True))
        parts, sizes = [], np.diff(cuts) + len(self.end)
        for i in range(rows):
            if i in given:
                parts.append(np.array(given[i], np.uint32))
                sizes[i] = len(given[i]) + len(self.end)
            else:
                parts.append(ids[cuts[i] : cuts[i + 1]])
            parts.append(self.end)
        out = np.concatenate(parts) if parts else ids
        return out, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, end_id: int | None) -> Encoder:
    """The encoder of this worker process; it outlives a task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]
