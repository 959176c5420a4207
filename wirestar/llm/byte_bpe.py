"""Token ids of a byte-level BPE of the tokenizers library, with chunks remembered.

The vocabulary's pattern ends a pre-token wherever white space begins after something else, and
wherever plain letters and plain punctuation meet (but for apostrophes). Texts are cut at
those places, and a chunk has the same ids wherever it stands. Each worker lets the library
encode a chunk once. Finding a text's chunks and their ids again is array work: bytes are
classed, chunks hashed by differences of a running sum, and the hashes looked up in an open
table. Two chunks with one 64-bit hash would be confused; for a million different chunks that
has a chance below 10^-7.

Texts with strings of special tokens go to the library whole. The memory has a fixed size; when
full it is emptied.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

import numpy as np

from wirestar.llm.common import kept_by_worker

SLOTS = 1 << 21
#: Longer chunks, in bytes, are encoded each time.
LONGEST = 64
#: New chunks in one text for the library, which is slower on longer ones.
LINES = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)

_LETTER, _MARK, _OTHER_VISIBLE = 1, 2, 3


def _classes() -> np.ndarray:
    """0: white space, controls and bytes above 127; else plain letters, marks and the rest."""
    kinds = np.zeros(256, dtype=np.uint8)
    for b in range(33, 127):
        c = chr(b)
        kinds[b] = _LETTER if c.isalpha() else _OTHER_VISIBLE if c.isdigit() or c == "'" else _MARK
    return kinds


_KINDS = _classes()


@kept_by_worker
@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for the vocabulary file, made once."""
    return ChunkEncoder(path)


class ChunkEncoder:
    def __init__(self, path: str, slots: int = SLOTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 65_536 else "<u4")
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # one character stands for one byte
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.slots, self.shift = slots, np.uint64(64 - (slots.bit_length() - 1))
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(self.slots, dtype=np.uint64)
        self.entry = np.zeros(self.slots, dtype=np.int32)
        self.begins, self.counts = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int32)
        self.pool = np.zeros(4096, dtype=self.dtype)
        self.entries = self.pooled = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian integers of ``dtype``."""
        found = [b""] * len(texts)
        split = []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                found[i] = self._whole(text)
            elif text:
                split.append(i)
        if split:
            for i, ids in zip(split, self._encode_split([texts[i].encode() for i in split])):
                found[i] = ids
        return found

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _encode_split(self, data: list[bytes]) -> list[bytes]:
        joined = b"".join(data)
        text_ends = np.cumsum([len(d) for d in data])
        begins = self._cuts(np.frombuffer(joined, np.uint8), text_ends)
        ends = np.append(begins[1:], len(joined))
        entry = self._entries(joined, begins, ends)
        counts = self.counts[entry]
        upto = np.cumsum(counts)
        places = np.repeat(self.begins[entry] - (upto - counts), counts) + np.arange(upto[-1])
        ids = self.pool[places].tobytes()
        last_chunk = np.searchsorted(ends, text_ends)
        cuts = (upto[last_chunk] * self.dtype.itemsize).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    @staticmethod
    def _cuts(data: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
        """Where chunks begin. In UTF-8, 0xC3 and a second byte are a Latin letter, but for
        the two signs of multiplication and division."""
        kind = _KINDS[data]
        second = np.zeros(len(data), dtype=bool)
        second[1:] = data[:-1] == 0xC3
        letter = (kind == _LETTER) | (second & (data != 0x97) & (data != 0xB7))
        visible = (kind > 0) | second
        cut = np.zeros(len(data), dtype=bool)
        blank = (data == 32) | (data == 10)
        cut[1:] = visible[:-1] & blank[1:]
        cut[1:] |= letter[:-1] & (kind[1:] == _MARK)
        cut[1:] |= (kind[:-1] == _MARK) & (kind[1:] == _LETTER)
        cut[0] = True
        cut[text_ends[:-1]] = True
        return np.flatnonzero(cut)

    def _hashes(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            n = 2 * len(data) + 1
            self.powers = np.cumprod(np.full(n, _STEP)) * _INVERSE
            self.inverses = np.cumprod(np.full(n, _INVERSE)) * _STEP
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        hashed = (sums[ends] - sums[begins]) * self.inverses[begins]
        hashed = (hashed ^ (hashed >> np.uint64(31)) ^ (ends - begins).astype(np.uint64)) * _MIX
        return (hashed ^ (hashed >> np.uint64(29))) * _STEP | np.uint64(1)

    def _entries(self, joined: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The memory's entry for every chunk, after learning the new ones."""
        hashed = self._hashes(np.frombuffer(joined, np.uint8), begins, ends)
        entry = self._look_up(hashed)
        missing = np.flatnonzero(entry < 0)
        new, first = np.unique(hashed[missing], return_index=True)
        if 2 * (self.entries + len(new)) > self.slots:
            self._forget()
            while self.slots < 4 * len(new):  # one run alone fills it
                self.slots *= 2
                self.shift -= np.uint64(1)
                self._forget()
            missing = np.arange(len(hashed))
            new, first = np.unique(hashed, return_index=True)
        if len(new):
            places = missing[first]
            chunks = [joined[a:b] for a, b in zip(begins[places].tolist(), ends[places].tolist())]
            entry_of = self._learn(chunks)
            short = (ends - begins)[places] <= LONGEST
            self._insert(new[short], entry_of[short])
            entry[missing] = entry_of[np.searchsorted(new, hashed[missing])]
        return entry

    def _look_up(self, hashed: np.ndarray) -> np.ndarray:
        found = np.full(len(hashed), -1, dtype=np.int64)
        slot, open_ = (hashed >> self.shift).astype(np.int64), np.arange(len(hashed))
        while len(open_):
            keys, wanted = self.keys[slot], hashed[open_]
            same = keys == wanted
            found[open_[same]] = self.entry[slot[same]]
            on = ~same & (keys != 0)
            open_, slot = open_[on], (slot[on] + 1) & (self.slots - 1)
        return found

    def _insert(self, hashed: np.ndarray, entry: np.ndarray) -> None:
        slot = (hashed >> self.shift).astype(np.int64)
        while len(hashed):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashed[free]  # of several for one slot, one gets it
            self.entry[slot[free]] = entry[free]
            done = self.keys[slot] == hashed
            hashed, entry, slot = hashed[~done], entry[~done], (slot[~done] + 1) & (self.slots - 1)

    def _learn(self, chunks: list[bytes]) -> np.ndarray:
        """Encode new chunks and note their ids. Chunks without white space but a first blank
        go to the library many in a text, a line feed after each, and the ids' byte lengths
        tell where each ends. Chunks of white space alone would join that around them."""
        texts = [c.decode() for c in chunks]
        plain = [not any(map(str.isspace, t[1:])) and not t.isspace() for t in texts]
        simple = [t for t, p in zip(texts, plain) if p]
        found: list[np.ndarray] = []
        if simple:
            lines = ["\n".join(simple[i : i + LINES]) + "\n" for i in range(0, len(simple), LINES)]
            encoded = self.library.encode_batch(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=self.dtype) for e in encoded])
            sizes = np.fromiter((len(c) + 1 for c, p in zip(chunks, plain) if p), np.int64, len(simple))
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes))
            found = [ids[a:b] for a, b in zip([0, *(cuts + 1).tolist()], cuts.tolist())]
        odd = [t for t, p in zip(texts, plain) if not p]
        encoded = iter(self.library.encode_batch(odd, add_special_tokens=False))
        simple_ids = iter(found)
        ids_of = [
            next(simple_ids) if p else np.array(next(encoded).ids, dtype=self.dtype) for p in plain
        ]
        counts = np.fromiter(map(len, ids_of), np.int64, len(ids_of))
        return self._store(np.concatenate(ids_of), counts)

    def _store(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        entry = np.arange(self.entries, self.entries + len(counts))
        self.begins = _grown(self.begins, self.entries + len(counts))
        self.counts = _grown(self.counts, self.entries + len(counts))
        self.pool = _grown(self.pool, self.pooled + len(ids))
        self.begins[entry] = self.pooled + np.cumsum(counts) - counts
        self.counts[entry] = counts
        self.pool[self.pooled : self.pooled + len(ids)] = ids
        self.entries, self.pooled = self.entries + len(counts), self.pooled + len(ids)
        return entry


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(2 * size, dtype=array.dtype)
    grown[: len(array)] = array
    return grown


def in_pieces(texts: Iterable[str], at_once: int = 1 << 18):
    """Runs of texts of about ``at_once`` characters, or of one longer text."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > at_once:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
