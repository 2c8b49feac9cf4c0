"""Token ids of whole texts, with one call to the tokenizer for each distinct word a Python worker meets."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from lumenforge.llm.text import LOWER, span_hashes, text_bytes, word_spans

#: Distinct words a worker keeps; past it the memory starts anew and the ids stay the same.
KEPT_WORDS = 2_000_000

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True
_POINT = np.zeros(256, bool)
_POINT[[ord(c) for c in ".,;:!?"]] = True


def _without_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """Splits a final point off a word that ends in a Latin letter before it: fewer distinct words, the same ids."""
    long = ends - starts >= 3
    last = np.where(long, ends - 1, 0)
    a, b = data[last - 1 * long], data[last - 2 * long]
    letter = _LETTER[a] | ((b == 0xC3) & (a >= 0x80) & (a != 0x97) & (a != 0xB7))
    cut = (long & _POINT[data[last]] & letter) if len(data) else long
    at = np.concatenate([[0], np.cumsum(1 + cut)])
    low, high = np.repeat(starts, 1 + cut), np.repeat(ends, 1 + cut)
    second = at[1:][cut] - 1
    low[second] = ends[cut] - 1
    high[second - 1] = ends[cut] - 1
    return low, high, at[first]


class WordTokenizer:
    """Encodes texts word by white-space word.

    Right for tokenizers whose normaliser and pre-tokenizer never look across ASCII white space, which drop it, fold
    case and part letters from points, as word_bpe_49k.json does: the ids of a text are then those of its words.
    Words are told apart by a 64-bit hash.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.places = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids, counts = [self.ids], []
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            counts.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)) if got.ids else np.zeros(len(part), np.int64))
        places = len(self.first) - 1 + np.arange(len(words))
        self.ids = np.concatenate(ids)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.places = np.insert(self.hashes, at, hashes), np.insert(self.places, at, places)

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets by row); null is an empty text; `end` follows each row's ids."""
        if len(self.hashes) > KEPT_WORDS:
            self.clear()
        data, offsets = text_bytes(texts)
        # Folding case first is safe but beside special tokens and marks that compose with a letter.
        if b"<|" not in data.tobytes() and not ((data == 0xCC) | (data == 0xCD)).any():
            data = LOWER[data]
        starts, ends, rows = _without_points(data, *word_spans(data, offsets))
        words = span_hashes(data, starts, ends)
        codes, distinct = pd.factorize(words)
        at = np.searchsorted(self.hashes, distinct)
        new = at == len(self.hashes)
        new[~new] = self.hashes[at[~new]] != distinct[~new]
        if new.any():
            raw = data.tobytes()
            where = np.empty(len(distinct), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            order = np.argsort(distinct[new])
            where = where[new][order]
            self._learn(distinct[new][order], [raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            at = np.searchsorted(self.hashes, distinct)
        places = self.places[at]
        first, count = self.first[places], self.first[places + 1] - self.first[places]
        counts = count[codes]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(first[codes] - upto[:-1], counts) + np.arange(upto[-1])]
        row_ends = upto[rows]
        if end is None:
            return ids, row_ends
        out = np.full(len(ids) + len(texts), end, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(row_ends))] = ids
        return out, row_ends + np.arange(len(texts) + 1)


_made: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each path and Python worker."""
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
