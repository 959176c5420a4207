"""BPE encoding and decoding by a pair occurrence index.

All new words of a run of texts are encoded together. Their symbols stand in one linked
sequence, and an index maps each mergeable pair, named by its rank, to all its positions.
The active ranks are applied in ascending order: a rank's merges are made at all its places,
from left to right, and each merge puts the two pairs it creates into the index. Places that
an earlier merge has changed are recognised and passed over. A merge may create a pair of a
lower rank than the one at work; that one then comes first, as in a word-by-word encoder.

Words that a worker has met are looked up; its memory of them has a fixed size.

Nulls: a null text counts as empty and has no ids and the empty decoded text. Rows with null
ids and repeated rows are encoded like others. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wirestar.llm.byte_bpe import in_pieces
from wirestar.llm.common import text_or_empty

REMEMBERED = 600_000
RUN_CHARS = 1 << 21

Chunk = str | tuple[str]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> WordBpe:
    """The worker's codec for the vocabulary file, made once."""
    return WordBpe(path)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for letters from 256 on, in order."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(itself)]
    return {b: chr(b) for b in itself} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordBpe:
    """Encoder and decoder for a vocabulary with word ends, lower case, and white space
    dropped between words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (self.vocabulary | self.special).items()}
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[tuple[int, int, int]] = []
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.vocabulary[a], self.vocabulary[b]
            self.ranks[pair] = rank
            self.merged.append((*pair, self.vocabulary[a + b]))
        letters = byte_letters()
        self.inner = [self.vocabulary[letters[b]] for b in range(256)]
        self.last = [self.vocabulary[letters[b] + self.suffix] for b in range(256)]
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len)[::-1])) + ")")
        self.remembered = remembered
        self.recent: dict[Chunk, tuple[bytes, str]] = {}
        self.older: dict[Chunk, tuple[bytes, str]] = {}

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian, 32 bits) and decoded text of each text."""
        parts = [self._chunks(text) for text in texts]
        known = self._known(set().union(*parts))
        found = []
        for chunks in parts:
            pieces = list(map(known.__getitem__, chunks))
            ids = b"".join([ids for ids, _ in pieces])
            found.append((ids, " ".join([text for _, text in pieces if text])))
        return found

    def _chunks(self, text: str) -> list[Chunk]:
        """Stretches between white space, normalised; a special token is a tuple, as other
        text may become like it when lowered."""
        if not any(s in text for s in self.special):
            return self._normal(text)
        chunks: list[Chunk] = []
        for i, part in enumerate(self.cut.split(text)):
            chunks += [(part,)] if i % 2 else self._normal(part)
        return chunks

    @staticmethod
    def _normal(text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # Each letter is lowered by itself, so a final sigma has no form of its own.
        text = text.replace("Σ", "σ").lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space only to Python
            return re.split(r"[^\S\x1c-\x1f]+", text)
        return text.split()

    def _known(self, chunks: set[Chunk]) -> dict[Chunk, tuple[bytes, str]]:
        known = {c: found for c in chunks if (found := self.recent.get(c)) is not None}
        new = [c for c in chunks if c not in known]
        again = {c: found for c in new if (found := self.older.get(c)) is not None}
        learned = self._learn([c for c in new if c not in again])
        for found in (again, learned):
            known.update(found)
            self.recent.update(found)
        if len(self.recent) > self.remembered // 2:
            self.older, self.recent = self.recent, {}
        return known

    def _learn(self, chunks: list[Chunk]) -> dict[Chunk, tuple[bytes, str]]:
        split = {c: [] if isinstance(c, tuple) else self.words.findall(c) for c in chunks}
        words = list({w for found in split.values() for w in found})
        ids_of = dict(zip(words, self.merge_words(words)))
        learned = {}
        for chunk, found in split.items():
            ids = [i for w in found for i in ids_of[w]]
            if isinstance(chunk, tuple):
                ids = [self.special[chunk[0]]]
            learned[chunk] = np.array(ids, dtype="<u4").tobytes(), self.decode(ids)
        return learned

    def decode(self, ids) -> str:
        return " ".join([self.token[i] for i in ids])

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by the pair occurrence index over all of them."""
        symbols, bounds = [], [0]
        for word in words:
            data = word.encode()
            symbols += [self.inner[b] for b in data[:-1]]
            symbols.append(self.last[data[-1]])
            bounds.append(len(symbols))
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for begin, end in zip(bounds, bounds[1:]):
            before[begin] = -1
            after[end - 1] = -1
        ranks, places = self.ranks, defaultdict(list)
        for at, (pair, following) in enumerate(zip(zip(symbols, symbols[1:]), after)):
            if following >= 0 and (rank := ranks.get(pair)) is not None:
                places[rank].append(at)
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right, joined = self.merged[rank]
            todo = sorted(places.pop(rank, ()))
            for done, at in enumerate(todo, 1):
                following = after[at]
                if symbols[at] != left or following < 0 or symbols[following] != right:
                    continue  # an earlier merge has changed this place
                symbols[at], symbols[following] = joined, -1
                beyond, earlier = after[following], before[at]
                after[at] = beyond
                made = []
                if beyond >= 0:
                    before[beyond] = at
                    made.append((ranks.get((joined, symbols[beyond])), at))
                if earlier >= 0:
                    made.append((ranks.get((symbols[earlier], joined)), earlier))
                lower = False
                for new, place in made:
                    if new is None:
                        continue
                    if new not in places:
                        heapq.heappush(active, new)
                    places[new].append(place)
                    lower = lower or new < rank
                if lower and done < len(todo):
                    if rank not in places:
                        heapq.heappush(active, rank)
                    places[rank] += todo[done:]
                    break
        return [[s for s in symbols[a:b] if s >= 0] for a, b in zip(bounds, bounds[1:])]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (binary, little-endian 32-bit integers) and
    decoded, the text that the ids decode to."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, found in _encoded(batches, vocabulary):
            ids, decoded = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.mapInArrow(encode, "doc_id long, ids binary, decoded string")


def digest_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of what ``encode_documents`` returns, made where it is
    encoded, so that ids and decoded texts need not leave their task."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, found in _encoded(batches, vocabulary):
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids,
                    pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in found]),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for _, text in found]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(digest, schema)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str):
    """The ids column and the encoded texts of every run of texts."""
    words = codec(vocabulary)
    for batch in batches:
        at = 0
        for texts in in_pieces(batch["text"].to_pylist(), RUN_CHARS):
            yield batch["doc_id"].slice(at, len(texts)), words.encode(texts)
            at += len(texts)
