"""Token ids of texts with a file of the tokenizers library.

Most words of a corpus repeat, so each worker encodes a word once and remembers
its ids. That gives the ids of the whole text only if the tokenizer drops white
space and never joins across it; the class tries this out on a sample text and
encodes whole texts where it does not hold.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What ends a document's ids in the registered queries.
END_ID = 1
#: Words a worker remembers before it sets them aside, where they stay until the next
#: so many are full, and words per library call.
REMEMBERED = 250_000
TOGETHER = 512
#: Bytes of text whose words are looked up together; a longer text is taken whole.
AT_ONCE = 2_000_000

_PROBE = "Aa bb, it's\n don't\t12 3rd  (x) co-op é ÉÉ. \x0b ß\x0c\r\nend"
_MARKS = bytes(c for c in string.punctuation.encode() if c not in b"'")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the package that has it is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as bytes: little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known: dict[bytes, bytes] = {}
        self.aside: dict[bytes, bytes] = {}
        whole = self._ids(_PROBE)
        self.by_words = whole == b"".join(self._ids(w) for w in _PROBE.encode().decode().split())
        self.marks_apart = self.by_words and self._ids("co.") == self._ids("co") + self._ids(".")
        ends = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = None
        if ends:
            self.closes = np.zeros(self.size, dtype=bool)
            for piece, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.closes[number] = piece.endswith(ends)

    def _ids(self, text: str) -> bytes:
        return self._numbers([text])[0].tobytes()

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn(self, words: Iterable[bytes]) -> None:
        """Remember the ids of these words."""
        simple, rest = set(), []
        for word in words:
            if word.isalpha():  # letters of ASCII alone, which most are
                simple.add(word)
                continue
            letters = word.rstrip(_MARKS) if self.marks_apart else word
            if letters and letters.decode().isalpha():
                simple.add(letters)
                if letters != word:
                    rest.append((word, letters, word[len(letters) :]))
            else:
                rest.append((word, b"", b""))
        letters_new = list(simple.difference(self.known))
        for i in range(0, len(letters_new), TOGETHER):
            self._learn_letters(letters_new[i : i + TOGETHER])
        alone = [w for w, letters, _ in rest if not letters]
        alone += {marks for _, letters, marks in rest if letters}.difference(self.known)
        for word, ids in zip(alone, self._numbers([w.decode() for w in alone])):
            self.known[word] = ids.tobytes()
        for word, letters, marks in rest:
            if letters:
                self.known[word] = self.known[letters] + self.known[marks]

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of letters alone are one unit each, so one call can take many
        and the pieces that close a word tell them apart."""
        if self.closes is not None:
            ids = self._numbers([b" ".join(words).decode()])[0]
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                raw, places = ids.tobytes(), (4 * ends).tolist()
                self.known.update(zip(words, map(raw.__getitem__, map(slice, [0, *places], places))))
                return
        for word in words:
            self.known[word] = self._ids(word.decode())

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each whole text; none for null."""
        if not self.by_words:
            return [self._ids((t or b"").decode()) for t in texts]
        out: list[bytes] = []
        part: list[bytes | None] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text or b"")
            if size > AT_ONCE:
                out += self._encode_words(part)
                part, size = [], 0
        return out + self._encode_words(part)

    def _encode_words(self, texts: list[bytes | None]) -> list[bytes]:
        """Each different word of these texts is looked up once; the ids of all its
        places are then copied from there."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self._remember(set(words))
        ids = [self.known[word] for word in words]
        pool = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        place = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[place])])
        copied = np.repeat(starts[place] - ends[:-1], sizes[place])
        copied += np.arange(len(copied))
        raw = pool[copied].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _remember(self, words: set[bytes]) -> None:
        # A set less a dict looks up what is in the set; less its keys it would go
        # through all that is known.
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.aside, new = {}, self.known, words
        again = new.intersection(self.aside)
        self.known.update((word, self.aside[word]) for word in again)
        self._learn(new.difference(again))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
