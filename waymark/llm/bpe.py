"""Byte-level BPE ids through the tokenizers library, with a bounded cache of words.

The pre-tokeniser's pattern always starts a new pre-token at a lone space between two other characters, and
before and after a lone newline between two other characters. So in a text whose white space is only such
spaces and newlines, each word with the space before it can be encoded on its own. A word of Latin letters,
with or without punctuation after them, is one or two pre-tokens and goes to the library's model as such.
Other words are joined by spaces and encoded in one call; as a space can only begin a pre-token, the ids that
begin with a space mark where words begin. A text with other white space, or that holds an added token's
string, is encoded whole.
"""

from __future__ import annotations

import os
import string
from functools import lru_cache
from itertools import islice

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of a worker's cache, and how many of the oldest (the most common words) outlive a purge.
CACHE_WORDS, CACHE_KEPT = 600_000, 300_000
#: Characters of joined unknown words that are encoded in one call.
JOIN_CHARS = 1 << 16
#: Letters below this are letters in every Unicode version.
LATIN_END = "\u0250"


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(0x100 + k) for k, byte in enumerate(others)}


class ByteBpe:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, number in vocabulary.items():
            self.begins[number] = piece.startswith("Ġ")
        self.newline = self._ids("\n")
        self.raw = [int(number).to_bytes(4, "little") for number in range(len(self.begins))]
        self.model, self.alphabet = self.tokenizer.model, _byte_alphabet()
        self.endings: dict[str, bytes] = {"": b""}
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _latin(self, word: str, space: str) -> bytes | None:
        """The ids of letters with punctuation after them; None for any other word."""
        letters = word.rstrip(string.punctuation)
        if not letters.isalpha():
            return None
        shown = letters
        if not letters.isascii():
            if max(letters) >= LATIN_END:
                return None
            shown = letters.encode().decode("latin-1").translate(self.alphabet)
        ending = word[len(letters) :]
        last = self.endings.get(ending)
        if last is None:
            last = self._ids(ending)
            if len(self.endings) < CACHE_WORDS:
                self.endings[ending] = last
        raw = self.raw
        return b"".join([raw[token.id] for token in self.model.tokenize(space + shown)]) + last

    def _learn(self, fresh: set[str]) -> None:
        """Puts words, each taken with a space before it, into the cache."""
        words, spaced = [], self.spaced
        for word in fresh:
            ids = self._latin(word, "Ġ")
            if ids is None:
                words.append(word)
            else:
                spaced[word] = ids
        at = 0
        while at < len(words):
            size, upto = 0, at
            while upto < len(words) and size < JOIN_CHARS:
                size += len(words[upto]) + 1
                upto += 1
            group = words[at:upto]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(group)], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(group):
                joined, ends = ids.tobytes(), np.append(starts[1:], len(ids)) * 4
                for word, a, b in zip(group, (starts * 4).tolist(), ends.tolist(), strict=True):
                    spaced[word] = joined[a:b]
            else:
                for word in group:
                    spaced[word] = self._ids(" " + word)
            at = upto

    def _purge(self) -> None:
        for name in ("spaced", "bare"):
            cache = getattr(self, name)
            if len(cache) > CACHE_WORDS:
                setattr(self, name, dict(islice(cache.items(), CACHE_KEPT)))

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text; a null text has none."""
        self._purge()
        plans: list[list[list[str]] | None] = []
        fresh: set[str] = set()
        known = self.spaced
        for text in texts:
            if not text:
                plans.append([])
                continue
            words = text.replace("\n", " ").split(" ")
            if text.split() != words or any(mark in text for mark in self.added):
                plans.append(None)
                continue
            fresh.update(set(words).difference(known))
            plans.append([line.split(" ") for line in text.split("\n")])
        if fresh:
            self._learn(fresh)
        look, bare = self.spaced.__getitem__, self.bare
        out = []
        for text, lines in zip(texts, plans, strict=True):
            if lines is None:
                out.append(self._ids(text))
                continue
            parts: list[bytes] = []
            for number, line in enumerate(lines):
                first = line[0]
                if number:
                    parts.append(self.newline)
                ids = bare.get(first)
                if ids is None:
                    ids = self._latin(first, "")
                    bare[first] = ids = self._ids(first) if ids is None else ids
                parts.append(ids)
                parts.extend(map(look, islice(line, 1, None)))
            out.append(b"".join(parts))
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each Python worker and file."""
    return ByteBpe(path)
