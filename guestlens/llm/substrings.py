"""Removing passages that repeat, by fixed-block anchors.

A window of `WINDOW` words always holds one whole block of BLOCK words that
starts at a multiple of BLOCK in its document, as long as WINDOW >= 2 BLOCK - 1.
So the blocks of all documents are the index, and every rolling window of BLOCK
words of every document is a probe. Where a block is met by another window, the
hit is extended: the whole windows around it are compared, and the runs of
windows that occur elsewhere are the maximal repeats.

Probes travel packed. Documents are dealt to shards of bounded size. A shard
sends the sorted set of its hashes, cut by hash range into buckets, with two
bits each: met more than once here, and met as a block. A hash that is on every
page of the corpus is therefore sent once per shard, and no bucket ever holds
all its places. A bucket answers with one bit per hash, in the order sent, and
the shard, which works out the same sorted set again, knows what its places
are. Nothing but bits goes back, and no pair is ever made.

Rows equal in doc_id and text are one row with a number of copies, if there are
any: all of its windows start more than once, and it gives out a row per copy.

Anchors are compared by 32 bits within their bucket, as a false hit only costs a
comparison later. Whole windows are compared by 96 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored, text_bytes

WINDOW = 35
#: Bytes of text per shard, which bounds what a task holds.
SHARD_BYTES = 8_000_000

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_LANES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of x."""
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLY
    x = (x ^ (x >> np.uint64(29))) * _LANES[0]
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """Hashes of all runs of `size` word hashes, by joining runs of doubling length."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    run, length, offset = _mixed(words ^ _LANES[lane]), 1, 0
    whole: np.ndarray | None = None
    n = len(words) - size + 1
    while True:
        if size & length:
            part = run[offset : offset + n]
            whole = part if whole is None else _mixed(whole * _MULTIPLY + part)
            offset += length
        if 2 * length > size:
            return whole
        run = _mixed(run[: len(run) - length] * _MULTIPLY + run[length:] * _LANES[1])
        length *= 2


@dataclass
class Text:
    """The documents of a shard, one after the other."""

    words: list[list[bytes]]
    hashes: np.ndarray
    starts: np.ndarray  # of documents of at least one window
    ends: np.ndarray
    copied: np.ndarray  # documents that are several rows

    @staticmethod
    def of(texts: list[bytes | None], window: int, copies: list[int] | None = None) -> Text:
        from xxhash import xxh3_64_intdigest

        words = [t.split() if t else [] for t in texts]
        long = [w for w in words if len(w) >= window]
        many = [n > 1 for w, n in zip(words, copies or [1] * len(words)) if len(w) >= window]
        sizes = np.array([len(w) for w in long], dtype=np.int64)
        ends = np.cumsum(sizes)
        flat = (xxh3_64_intdigest(w) for doc in long for w in doc)
        return Text(words, np.fromiter(flat, np.uint64, count=int(sizes.sum())), ends - sizes, ends, np.array(many, dtype=bool))

    def owners(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.starts)), self.ends - self.starts)

    def places(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of this many words start, and how far into their document."""
        owner = self.owners()
        place = np.arange(len(self.hashes))
        inside = place + size <= self.ends[owner]
        return place[inside], (place - self.starts[owner])[inside]


@dataclass
class Sent:
    """The sorted set of a shard's hashes; `group` is each place's position in it."""

    key: np.ndarray
    more: np.ndarray
    group: np.ndarray
    many: np.ndarray
    block: np.ndarray

    @staticmethod
    def of(key: np.ndarray, more: np.ndarray, block: np.ndarray, copied: np.ndarray | None = None) -> Sent:
        order = np.lexsort((more, key)) if more.any() else np.argsort(key, kind="stable")
        k, m = key[order], more[order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        first = np.flatnonzero(new)
        group = np.empty(len(k), np.int64)
        group[order] = np.cumsum(new) - 1
        if not len(k):
            return Sent(k, m, group, new, new)
        counts = np.diff(np.append(first, len(k)))
        many = counts > 1
        if copied is not None:
            many |= np.logical_or.reduceat(copied[order], first)
        return Sent(k[first], m[first], group, many, np.logical_or.reduceat(block[order], first))

    def cuts(self, buckets: int) -> np.ndarray:
        """Where the buckets, ranges of the hash, begin and end in the set."""
        bounds = [min(2**64 - 1, -(-b * 2**64 // buckets)) for b in range(buckets)]
        return np.append(np.searchsorted(self.key, np.array(bounds, dtype=np.uint64)), len(self.key))

    def rows(self, shard: int, buckets: int, whole: bool) -> pa.Table:
        cuts = self.cuts(buckets)
        full = np.flatnonzero(np.diff(cuts))
        # Within a bucket the low bits tell anchors apart; windows are sent whole.
        key = self.key if whole else self.key.astype("<u4")
        parts = [slice(int(cuts[b]), int(cuts[b + 1])) for b in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "shard": pa.array([shard] * len(full), pa.int64()),
                "n": pa.array([p.stop - p.start for p in parts], pa.int64()),
                "keys": pa.array([key[p].tobytes() for p in parts], pa.binary()),
                "more": pa.array([self.more[p].astype("<u4").tobytes() if whole else b"" for p in parts], pa.binary()),
                "many": pa.array([np.packbits(self.many[p]).tobytes() for p in parts], pa.binary()),
                "block": pa.array([np.packbits(self.block[p]).tobytes() for p in parts], pa.binary()),
            }
        )


_SENT = "bucket long, shard long, n long, keys binary, more binary, many binary, block binary"
_ANSWER = "shard long, bucket long, n long, hits binary, round int"


def _answers(round_: int, whole: bool):
    """A bucket's rows -> one bit per hash sent: it also occurs elsewhere."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bits = lambda name: np.concatenate(
            [np.unpackbits(np.frombuffer(r[name], np.uint8), count=r["n"]) for r in rows]
        ).astype(bool)
        keys = np.frombuffer(b"".join(r["keys"] for r in rows), "<u8" if whole else "<u4").astype(np.uint64)
        more = np.frombuffer(b"".join(r["more"] for r in rows), "<u4") if whole else np.zeros(len(keys), np.uint32)
        many, block = bits("many"), bits("block")
        met = Sent.of(keys, more, block)
        times = np.bincount(met.group, weights=1 + many, minlength=len(met.key))
        hit = ((times > 1) & met.block)[met.group]
        ends = np.cumsum([r["n"] for r in rows])
        parts = np.split(hit, ends[:-1])
        return pa.table(
            {
                "shard": pa.array([r["shard"] for r in rows], pa.int64()),
                "bucket": pa.array([r["bucket"] for r in rows], pa.int64()),
                "n": pa.array([r["n"] for r in rows], pa.int64()),
                "hits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
                "round": pa.array([round_] * len(rows), pa.int32()),
            }
        )

    return answer


def _hits(sent: Sent, answers: pa.Table, round_: int) -> np.ndarray:
    """The answers to a shard's set, per place."""
    rows = sorted((r for r in answers.to_pylist() if r["round"] == round_), key=lambda r: r["bucket"])
    if not rows:
        return np.zeros(len(sent.group), dtype=bool)
    bits = [np.unpackbits(np.frombuffer(r["hits"], np.uint8), count=r["n"]) for r in rows]
    return np.concatenate(bits).astype(bool)[sent.group]


def _anchors(text: Text, block: int) -> tuple[Sent, np.ndarray, np.ndarray]:
    place, inside = text.places(block)
    key = window_hashes(text.hashes, block)[place]
    copied = text.copied[text.owners()[place]]
    return Sent.of(key, np.zeros(len(key), np.uint32), inside % block == 0, copied), place, inside


def _extended(text: Text, answers: pa.Table, window: int, block: int) -> tuple[Sent, np.ndarray]:
    """The whole windows around anchors that were met, and their places.

    A window that occurs elsewhere holds a block, at the next multiple of its
    length, and the same words there make that block a hit.
    """
    sent, place, _ = _anchors(text, block)
    hit = np.zeros(len(text.hashes) + 1, dtype=bool)
    hit[place] = _hits(sent, answers, 1)
    start, inside = text.places(window)
    start = start[hit[start + -inside % block]]
    key = window_hashes(text.hashes, window)[start]
    more = window_hashes(text.hashes, window, 1)[start].astype(np.uint32)
    return Sent.of(key, more, np.ones(len(key), dtype=bool), text.copied[text.owners()[start]]), start


def _different(docs: DataFrame) -> DataFrame:
    """doc_id, text and copies, the rows that are equal in both. Texts are moved for it
    only if hashes, counted in each task first, say that there are such rows."""
    rows = docs.select("doc_id", "text")
    hashes = rows.groupBy("doc_id", F.xxhash64("text")).agg(F.count("*").alias("copies"))
    if hashes.where("copies > 1").isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long"))
    return stored(rows.groupBy("doc_id", "text").agg(F.count("*").alias("copies")), "repeat-rows")


def without_repeats(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: a row per document.

    A word goes if it is covered by a window whose words start anywhere else too,
    in the same document or another. kept_text is the words that stay, joined by
    one space.

    Defined cases: a null or empty text has no words and an empty kept_text; rows
    that repeat are documents of their own, so their windows repeat; null doc_ids
    stay null; no rows give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    block = (window + 1) // 2
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(partitions, -(-text_bytes(docs) // shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    rows = _different(docs).select("doc_id", "text", "copies", shard.alias("shard")).groupBy("shard")

    def read(table: pa.Table) -> Text:
        copies = table.column("copies").to_pylist()
        return Text.of(table.column("text").cast(pa.binary()).to_pylist(), window, copies)

    def probe(table: pa.Table) -> pa.Table:
        return _anchors(read(table), block)[0].rows(table.column("shard")[0].as_py(), shards, False)

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        sent, _ = _extended(read(table), answers, window, block)
        return sent.rows(table.column("shard")[0].as_py(), shards, True)

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        text = read(table)
        sent, start = _extended(text, answers, window, block)
        edges = np.zeros(len(text.hashes) + window + 1, dtype=np.int64)
        start = start[_hits(sent, answers, 2)]
        np.add.at(edges, start, 1)
        np.add.at(edges, start + window, -1)
        gone = np.cumsum(edges) > 0
        kept, place = [], 0
        for words in text.words:
            if len(words) < window:
                kept.append(words)
                continue
            own = gone[place : place + len(words)]
            kept.append([w for w, g in zip(words, own.tolist()) if not g] if own.any() else words)
            place += len(words)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "copies": table.column("copies"),
                "n_words": pa.array([len(w) for w in text.words], pa.int64()),
                "n_removed": pa.array([len(w) - len(k) for w, k in zip(text.words, kept)], pa.int64()),
                "kept_text": pa.array([b" ".join(k).decode() for k in kept], pa.string()),
            }
        )

    probes = rows.applyInArrow(probe, _SENT)
    first = stored(probes.groupBy("bucket").applyInArrow(_answers(1, False), _ANSWER), "repeat-anchors")
    windows = rows.cogroup(first.groupBy("shard")).applyInArrow(extend, _SENT)
    second = stored(windows.groupBy("bucket").applyInArrow(_answers(2, True), _ANSWER), "repeat-windows")
    answers = first.unionByName(second).groupBy("shard")
    kept = rows.cogroup(answers).applyInArrow(cut, "doc_id long, copies long, n_words long, n_removed long, kept_text string")
    each = kept.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)")))
    return each.select("doc_id", "n_words", "n_removed", "kept_text")
