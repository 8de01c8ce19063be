"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a trie over bytes. Each node has a failure link: when no edge
goes on, the longest pieces that the matched bytes must start with are popped at
once, and the link leads to the node of what remains. Only how many are popped
is stored, so counting never builds a piece and never looks back.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from guestlens.llm.tables import ship

#: Words remembered per worker before it starts anew.
REMEMBERED = 500_000


class LongestMatch:
    """Counts pieces of words. A word that cannot be cut has one, the unknown."""

    def __init__(self, vocabulary: Iterable[bytes], prefix: bytes = b""):
        self.prefix = prefix
        self.edges: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                if byte not in self.edges[node]:
                    self.edges[node][byte] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = self.edges[node][byte]
            whole[node] = node > 0
        self.link = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, child in self.edges[node].items():
                if whole[child]:
                    self.link[child], self.popped[child] = 0, 1
                else:
                    back, popped = self.link[node], self.popped[node]
                    while back >= 0 and byte not in self.edges[back]:
                        popped += self.popped[back]
                        back = self.link[back]
                    if back >= 0:
                        self.link[child], self.popped[child] = self.edges[back][byte], popped
                queue.append(child)

    def count(self, word: bytes) -> int:
        node = pieces = 0
        for byte in self.prefix + word:
            while byte not in self.edges[node]:
                pieces += self.popped[node]
                node = self.link[node]
                if node < 0:
                    return 1
            node = self.edges[node][byte]
        while node:
            pieces += self.popped[node]
            node = self.link[node]
            if node < 0:
                return 1
        return pieces


class _Counts(dict):
    """Counts by word, filled as words are asked for."""

    def __init__(self, match: LongestMatch):
        super().__init__()
        self.match = match

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n = self.match.count(word)
        return n


@lru_cache(maxsize=4)
def piece_counts(path: str) -> _Counts:
    """For a vocabulary file of the sentencepiece library: words start with its
    mark for a space, and every single byte is a piece."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    vocabulary = [p.encode() for p in pieces] + [bytes([b]) for b in range(256)]
    return _Counts(LongestMatch(vocabulary, "▁".encode()))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_pieces: a row per document, over its whole text.

    Words are what ASCII white space separates, unchanged. Defined cases: a null
    or empty text has none of both; repeated rows are counted alike; null doc_ids
    stay null; no rows give no rows.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = piece_counts(vocabulary).__getitem__
        for batch in batches:
            n_words, n_pieces = [], []
            for text in batch.column("text").cast(pa.binary()):
                words = (text.as_py() or b"").split()
                n_words.append(len(words))
                n_pieces.append(sum(map(find, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_pieces, pa.int64())],
                names=["doc_id", "n_words", "n_pieces"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_words long, n_pieces long")
