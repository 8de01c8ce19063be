"""Which ids of two tokenizers cover the same bytes of a text.

The work is done on Arrow tables, a few megabytes of text at a time: lists of ids
are flattened with the indices of their parents, sums of token sizes within each
document give the places where tokens end, and a hash join on document and end
finds the ends that both have. Counts of linked ids are grouped per task and
merged by Spark.

Most stretches of text repeat, so each worker encodes a stretch once. A text is
cut before a space or a line break that follows anything but white space, which
neither tokenizer looks or merges across; that is read off the vocabulary, and
texts are encoded whole where it does not hold.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored

#: Stretches remembered per worker, twice so many at most, and their longest.
REMEMBERED, LONGEST = 200_000, 64
#: Characters of text in one Arrow table; a longer text is a table of its own.
TOGETHER = 1_000_000
#: Pairs counted in a task before they are passed on, and in one row.
COUNTED, IN_A_ROW = 1_000_000, 50_000
#: Most frequent pairs whose counts are broadcast.
HOT_PAIRS = 1 << 19
#: A document and an end in one number; an id pair in one number.
END_BITS, ID_BITS = 40, 32

_STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:\s*\Z)?")
_SPACE = "▁"


def stretches(text: str) -> list[str]:
    """Cuts of a text, which joined give the text again."""
    return _STRETCH.findall(text) or [text]


def _bytes_of_signs() -> dict[str, int]:
    """The sign a byte-level vocabulary writes for each byte: itself if it can be
    seen, else the next one beyond the first 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class TokenPair:
    """Ids of both tokenizers for texts, and the bytes of every id."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_file)
        signs = _bytes_of_signs()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for piece, number in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[number] = bytes(signs[c] for c in piece) if all(c in signs for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.lone = self.b.piece_to_id(_SPACE)
        self.cuts = not any(
            "\n" in p[1:] or any(x != _SPACE and y == _SPACE for x, y in zip(p, p[1:]))
            for i, p in enumerate(pieces)
            if not self.b.is_byte(i)
        )
        self.a_table, self.b_table = (pa.array(x, pa.binary()) for x in (self.a_bytes, self.b_bytes))
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.older: dict[str, tuple[bytes, bytes, bool]] = {}

    def _b_ids(self, texts: list[str]) -> list[list[int]]:
        """The model puts a space before a text, so one that a text starts with is
        left to it, and one before a line break is taken away again."""
        out = self.b.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        return [ids if t[:1] == " " else ids[1:] for t, ids in zip(texts, out)]

    def _encode(self, texts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids of both for each stretch, and whether their bytes are those of it."""
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        raw = [t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        same, parts = np.ones(len(texts), bool), []
        for ids, table, sizes in ((a, self.a_table, self.a_size), (self._b_ids(texts), self.b_table, self.b_size)):
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(count.sum()))
            end = np.cumsum(count)
            ends = np.concatenate([[0], np.cumsum(sizes[flat])])
            same &= np.diff(ends[np.concatenate([[0], end])]) == size
            joined = _data(table.take(pa.array(flat)))
            if joined != b"".join(raw):
                start = ends[np.concatenate([[0], end[:-1]])].tolist()
                same &= np.array([joined[s : s + len(r)] == r for s, r in zip(start, raw)])
            ids_raw, cut = flat.tobytes(), (4 * end).tolist()
            parts.append([ids_raw[s:e] for s, e in zip([0, *cut], cut)])
        return list(zip(*parts, same.tolist()))

    def of(self, texts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """The same for these different stretches, from memory where it has them.
        What was asked for lately outlives what was not."""
        found = {}
        for text in texts:
            ids = self.known.get(text) or self.older.get(text)
            if ids:
                found[text] = ids
        new = [t for t in texts if t not in found]
        found.update(zip(new, self._encode(new)))
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        self.known.update((t, ids) for t, ids in found.items() if len(t) <= LONGEST)
        return [found[t] for t in texts]


def _data(values: pa.BinaryArray) -> bytes:
    """The bytes of all values, one behind the other."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return values.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(values) else b""


@lru_cache(maxsize=2)
def token_pair(byte_file: str, piece_file: str) -> TokenPair:
    """One pair per worker process and files."""
    return TokenPair(byte_file, piece_file)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as lists of so many each."""
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), values)


def _ends(ids: pa.ListArray, of_stretch: pa.Array, size: np.ndarray) -> pa.Table:
    """The ids of all documents with the document and the place where each ends."""
    flat = pc.list_flatten(ids)
    doc = of_stretch.take(pc.list_parent_indices(ids)).to_numpy()
    end = pc.cumulative_sum(pa.array(size).take(flat)).to_numpy()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    before = np.concatenate([[0], end])[first]
    within = end - np.repeat(before, np.diff(np.append(first, len(doc))))
    return pa.table({"key": (doc.astype(np.int64) << END_BITS) | within, "id": flat})


def align(pair: TokenPair, texts: list[str]) -> dict[str, pa.Array]:
    """For texts that are neither null nor empty: n_a, n_b, groups as text, and
    the linked pairs with how often each is linked."""
    whole = [" " + t for t in texts]
    cuts = [stretches(t) if pair.cuts else [t] for t in whole]
    n_cuts = np.array([len(c) for c in cuts], np.int64)
    codes = pa.array([s for c in cuts for s in c]).dictionary_encode()
    lexicon = pair.of(codes.dictionary.to_pylist())
    number = codes.indices.to_numpy()
    starts = np.concatenate([[0], np.cumsum(n_cuts)])[:-1]
    same = np.logical_and.reduceat(np.array([x[2] for x in lexicon])[number], starts)
    for d in np.flatnonzero(~same):
        # Bytes that differ in one stretch could be made up for by the next one.
        own = [lexicon[k] for k in number[starts[d] : starts[d] + n_cuts[d]]]
        joined = [b"".join(table[i] for x in own for i in np.frombuffer(x[k], "<i4")) for k, table in ((0, pair.a_bytes), (1, pair.b_bytes))]
        same[d] = joined[0] == joined[1] == whole[d].encode()
    of_stretch = np.repeat(np.arange(len(texts)), n_cuts)
    chosen = same[of_stretch]
    number, of_stretch = pa.array(number[chosen]), pa.array(of_stretch[chosen], pa.int64())

    tables = []
    for k, size in ((0, pair.a_size), (1, pair.b_size)):
        flat = pa.array(np.frombuffer(b"".join([x[k] for x in lexicon]), "<i4"))
        ids = _lists(flat, np.array([len(x[k]) // 4 for x in lexicon])).take(number)
        tables.append(_ends(ids, of_stretch, size))
    both = tables[0].rename_columns(["key", "a"]).join(
        tables[1].rename_columns(["key", "b"]), "key", join_type="full outer", use_threads=False
    )
    both = both.take(pc.sort_indices(both["key"])).combine_chunks()
    key, a, b = (both[c].combine_chunks() if both.num_rows else pa.array([], both[c].type) for c in ("key", "a", "b"))
    doc = key.to_numpy() >> END_BITS
    has_a, has_b = (pc.is_valid(x).to_numpy(zero_copy_only=False) for x in (a, b))
    common = has_a & has_b

    # Groups end where both end; ids stand in the order of their ends.
    group = np.cumsum(common) - common
    n_groups = int(common.sum())
    sides = [
        pc.binary_join(_lists(x.drop_null().cast(pa.string()), np.bincount(group[has], minlength=n_groups)), ",")
        for x, has in ((a, has_a), (b, has_b))
    ]
    per_doc = lambda has: np.bincount(doc[has], minlength=len(texts))
    groups = pc.binary_join(_lists(pc.binary_join_element_wise(*sides, "|"), per_doc(common)), ";")

    # Between two ends that follow each other lies one id of each side.
    number = lambda x: pc.fill_null_backward(x).cast(pa.int64()).to_numpy()
    links = pa.table({"doc": doc, "pair": (number(a) << ID_BITS) | number(b)})
    links = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc").combine_chunks()
    n_pairs = np.bincount(links["doc"].to_numpy(), minlength=len(texts))
    flat = lambda c: links[c].combine_chunks() if links.num_rows else pa.array([], pa.int64())
    return {
        "n_a": pa.array(per_doc(has_a), pa.int64()),
        "n_b": pa.array(per_doc(has_b), pa.int64()),
        "n_groups": pa.array(per_doc(common), pa.int64()),
        "groups": groups,
        "pairs": _lists(flat("pair"), n_pairs),
        "times": _lists(flat("count_all").cast(pa.int32()), n_pairs),
    }


class _Counts:
    """In how many documents of a task each pair is linked."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []

    def add(self, pairs: pa.ListArray) -> bool:
        """Whether it is time to pass the counts on."""
        self._merge([pa.table({"pair": pc.list_flatten(pairs)}).group_by("pair", use_threads=False).aggregate([([], "count_all")])])
        return self.parts[0].num_rows > COUNTED

    def _merge(self, more: list[pa.Table]) -> None:
        found = pa.concat_tables(self.parts + [t.rename_columns(["pair", "n"]) for t in more])
        merged = found.group_by("pair", use_threads=False).aggregate([("n", "sum")])
        self.parts = [merged.rename_columns(["pair", "n"])]

    def taken(self) -> pa.Table | None:
        found, self.parts = self.parts, []
        return found[0].combine_chunks() if found and found[0].num_rows else None


def alignments(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """A row per document: ``row`` (a number of its own), ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``groups`` (``a1,a2|b1;a3|b2,b3``), ``pairs`` (one number
    per linked id pair, the first id in the high 32 bits) and ``times``.

    Besides these there are rows without a ``row``, in which ``pairs`` and ``times``
    say in how many documents of a task each pair is linked; ``pair_counts`` adds
    them up.

    A null or empty text, and one whose ids do not give its bytes again, has no
    tokens: zeros, no groups and no pairs. Repeated rows are rows of their own;
    null doc_ids stay null; no rows give no rows; other columns are not read. A
    text is aligned whole, so memory follows the longest one.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>"

    def count_rows(counts: pa.Table | None, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for start in range(0, counts.num_rows if counts else 0, IN_A_ROW):
            part = counts.slice(start, IN_A_ROW).combine_chunks()
            empty = [pa.nulls(1, t) for t in (pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.string())]
            lists = [_lists(part[c].combine_chunks().cast(t), np.array([part.num_rows])) for c, t in (("pair", pa.int64()), ("n", pa.int32()))]
            yield pa.RecordBatch.from_arrays(empty + lists, names=_NAMES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, counts, id_type = token_pair(byte_file, piece_file), _Counts(), pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            length = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy()
            table = (np.cumsum(length) - length) // TOGETHER
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(table)) + 1):
                rows = batch.slice(part[0], len(part)) if len(part) else batch
                filled = np.flatnonzero(length[part] > 0)
                place = np.full(rows.num_rows, -1)
                place[filled] = np.arange(len(filled))
                spot = pa.array(place, mask=place < 0)
                found = align(pair, rows.column("text").take(pa.array(filled)).to_pylist()) if len(filled) else None
                if found is not None and counts.add(found["pairs"]):
                    yield from count_rows(counts.taken(), id_type)
                columns = [rows.column("row"), rows.column("doc_id")]
                for name, kind in zip(_NAMES[2:], _KINDS[2:]):
                    values = found[name].take(spot) if found is not None else pa.nulls(rows.num_rows, kind)
                    if not pa.types.is_list(kind):
                        values = pc.fill_null(values, "" if pa.types.is_string(kind) else 0)
                    columns.append(values)
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        yield from count_rows(counts.taken(), id_type)

    return rows.mapInArrow(work, schema)


_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n, best: the documents that hold a pair linked, and whether no other
    pair of its first id is in more. The greatest counts are a row per id of the
    first vocabulary, and broadcast."""
    partial = found.where("row IS NULL").selectExpr("inline(arrays_zip(pairs, times))")
    counts = stored(partial.groupBy("pairs").agg(F.sum(F.col("times").cast("long")).alias("n")), "pair-counts")
    first = F.shiftright("pairs", ID_BITS).alias("first")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    judged = counts.withColumn("first", first).join(F.broadcast(most), "first")
    return judged.select(F.col("pairs").alias("pair"), "n", (F.col("n") == F.col("most")).alias("best"))


def _threshold(counts: DataFrame, hot_pairs: int) -> int:
    """The least power of two such that at most so many pairs are in as many documents."""
    size = F.length(F.bin("n"))
    found = sorted(((r.size, r.n) for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = 1 << 63, 0
    for bits, n in found:
        held += n
        if held > hot_pairs:
            break
        least = 1 << (bits - 1)
    return least


def scored(found: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """row, n_links, n_best, count_sum for every document that has links.

    ``found`` is a stored result of ``alignments``. The most frequent pairs, which
    most links are of, are broadcast, ``hot_pairs`` at most. Links of the others
    are shuffled; such a pair is in fewer documents than any of the frequent ones,
    so that no pair is hot there.
    """
    counts = stored(pair_counts(found), "scored-pairs")
    least = _threshold(counts, hot_pairs)
    hot = F.broadcast(counts.where(F.col("n") >= F.lit(least - 1) + 1)) if least < 1 << 63 else None
    links = found.where("row IS NOT NULL").selectExpr("row", "inline(arrays_zip(pairs, times)) AS (pair, times)")
    sums: list[Column] = [
        F.sum(F.col("times").cast("long")).alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("long")).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    ]
    parts = [links.join(hot, "pair").groupBy("row").agg(*sums)] if hot is not None else []
    rare = counts.where(F.col("n") < least) if hot is not None else counts
    if hot is None or not rare.isEmpty():
        left = links.join(hot, "pair", "left_anti") if hot is not None else links
        parts.append(left.join(rare.hint("shuffle_hash"), "pair").groupBy("row").agg(*sums))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])
