"""Packing token sequences into as few rooms of fixed size as possible.

What matters for a packing is how many pieces there are of each length, and that
table has at most as many rows as a sequence has tokens, however large the
corpus. The packing is made on that table: bin completion takes the largest
length left, enumerates the undominated ways to fill the room beside it, and tries
each as often as its lengths last. Best-fit decreasing, and descents that take the
least waste or little enough, give the solution to beat; a branch is given up when
its waste cannot beat it. The pieces themselves
are then dealt to the places by their rank within their length, on Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored
from guestlens.llm.tokens import encoder

ROOM = 4096
#: Budgets of the search, none of which depends on the number of pieces: steps in
#: enumerating the fillings beside one piece, fillings tried beside it, and fillings
#: placed in all, per distinct filling of the solution to beat and besides. When one
#: is used up the best solution found stays, which is never worse than best fit.
STEPS, CHOICES, PLACED_PER_FILLING, PLACED = 3_000, 12, 3, 6_000
#: Shares of the room that are little enough to waste in the first descents.
DESCENTS = (ROOM + 1, 128, 64, 32, 16, 8)

Filling = list[tuple[int, int]]  # (length, how many)


def _largest_below(counts: np.ndarray) -> np.ndarray:
    """For each size the largest length that is left and no longer, or 0."""
    there = np.where(counts > 0, np.arange(len(counts)), 0)
    return np.maximum.accumulate(there)


def fillings(left: np.ndarray, room: int, most: int, steps: int = STEPS, enough: int = -1) -> list[Filling]:
    """Undominated ways to fill a sequence with the largest length left that waste
    at most so much, least waste first, of equal ones larger pieces first.

    Lengths are tried from large to small until nothing more fits. A filling is
    dominated if a piece that is left could take the place of one of its pieces, or
    of two, and fill the sequence better or as well with one piece in place of two.
    A filling that wastes no more than ``enough`` ends the search.
    """
    largest = int(np.flatnonzero(left)[-1])
    rest = left.copy()
    rest[largest] -= 1
    below = _largest_below(rest).tolist()
    totals = np.cumsum(rest * np.arange(len(rest))).tolist()
    many_left = rest.tolist()
    found: list[tuple[int, Filling]] = []

    def extend(space: int, limit: int, chosen: Filling) -> None:
        nonlocal steps, most
        length = below[min(space, limit)]
        if length == 0:
            if space <= most and whole(space, chosen):
                # From here on only as little waste is of use; what came before stays.
                found.append((space, chosen))
                most = space
                if space <= enough or (space == 0 and sum(w == 0 for w, _ in found) >= CHOICES):
                    steps = 0
            return
        # What is left below must be able to bring the waste down far enough.
        while length and totals[length] >= space - most and steps > 0:
            for many in range(min(many_left[length], space // length), 0, -1):
                steps -= 1
                many_left[length] -= many
                extend(space - many * length, length - 1, [*chosen, (length, many)])
                many_left[length] += many
            length = below[length - 1]

    def dominated(space: int, filling: Filling) -> bool:
        single = [x for x, _ in filling]
        own = [x for x, many in filling for _ in range(min(many, 2))]
        pairs = {x + y for i, x in enumerate(own) for y in own[i + 1 :]} if len(own) < 12 else set()
        taken = dict(filling)

        def spare(least: int, size: int) -> bool:
            # The largest piece that would fit in place of these, if it is not all used.
            other = below[min(size, room)]
            return other >= least and many_left[other] > taken.get(other, 0)

        return any(spare(x + 1, x + space) for x in single) or any(spare(x, x + space) for x in pairs)

    def whole(space: int, filling: Filling) -> bool:
        # A longer piece than the last may fit, if it is not all used.
        size = below[space]
        while size and many_left[size] == 0:
            size = below[size - 1]
        return size == 0

    extend(room - largest, room - largest, [])
    found.sort(key=lambda x: x[0])
    # What dominates the best one may lie beyond the steps, so that one always stays.
    good = found[:1] + [(w, f) for w, f in found[1:] if not dominated(w, f)]
    out = []
    for _, filling in good[:CHOICES]:
        if filling and filling[0][0] == largest:
            out.append([(largest, filling[0][1] + 1), *filling[1:]])
        else:
            out.append([(largest, 1), *filling])
    return out


def best_fit(counts: np.ndarray, room: int) -> list[tuple[int, Filling]]:
    """(how often, filling): each piece, largest first, into the fullest
    sequence that has space for it."""
    groups: dict[int, list[tuple[int, Filling]]] = {}
    spaces = np.zeros(room + 1, dtype=np.int64)
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            fits = np.flatnonzero(spaces[length:])
            if not len(fits):
                per = room // length
                for many, often in ((per, n // per), (n % per, 1)):
                    if many and often:
                        space = room - many * length
                        groups.setdefault(space, []).append((often, [(length, many)]))
                        spaces[space] += often
                break
            space = int(fits[0]) + length
            often, filling = groups[space].pop()
            take = min(often, n)
            if often > take:
                groups[space].append((often - take, filling))
            spaces[space] -= take
            groups.setdefault(space - length, []).append((take, _with(filling, length)))
            spaces[space - length] += take
            n -= take
    return [g for many in groups.values() for g in many]


def _with(filling: Filling, length: int) -> Filling:
    if filling[-1][0] == length:
        return [*filling[:-1], (length, filling[-1][1] + 1)]
    return [*filling, (length, 1)]


def completed(counts: np.ndarray, room: int) -> list[tuple[int, Filling]]:
    """(how often, filling) by bin completion, the best solution found.

    Depth first: beside the largest length left every undominated filling is tried,
    as often as its lengths last and, where that is more than once, once. What a
    filling may waste is what the solution to beat leaves over, so a branch ends as
    soon as it could only be as good.
    """
    best = best_fit(counts, room)
    fewest = sum(n for n, _ in best)
    sizes = np.arange(len(counts))
    total = int(counts @ sizes)
    least = -(-total // room)
    placed = PLACED + PLACED_PER_FILLING * len(best)
    left, used, filled = counts.copy(), 0, 0
    chosen: list[tuple[int, Filling]] = []
    # Per depth what is still to be tried there, the next one last.
    todo: list[list[tuple[int, Filling]]] = []

    def place(n: int, filling: Filling) -> None:
        nonlocal used, filled
        for length, many in filling:
            left[length] -= n * many
            filled += n * many * length
        used += n

    def choices() -> list[tuple[int, Filling]]:
        slack = (fewest - 1 - used) * room - (total - filled)
        if slack < 0:
            return []
        out = []
        for filling in fillings(left, room, slack):
            often = min(int(left[length]) // many for length, many in filling)
            out += [(often, filling)] + ([(1, filling)] if often > 1 else [])
        return out[::-1]

    # Solutions to beat: one descent each with the least waste, or with the first
    # filling that wastes little enough, which leaves small pieces for later.
    for enough in DESCENTS:
        while fewest > least and filled < total:
            found = fillings(left, room, room, STEPS, room // enough)[0]
            n = min(int(left[length]) // many for length, many in found)
            place(n, found)
            chosen.append((n, found))
        if filled == total and used < fewest:
            best, fewest = list(chosen), used
        left, used, filled, chosen = counts.copy(), 0, 0, []

    if fewest > least:
        todo.append(choices())
    while todo and placed > 0 and fewest > least:
        if not todo[-1]:
            todo.pop()
            if chosen:
                n, filling = chosen.pop()
                place(-n, filling)
            continue
        n, filling = todo[-1].pop()
        place(n, filling)
        chosen.append((n, filling))
        placed -= 1
        if filled == total:
            if used < fewest:
                best, fewest = list(chosen), used
            todo.append([])
        else:
            todo.append(choices())
    return best


def places(counts: np.ndarray, room: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, per, offset): pieces of a length by rank.

    Piece first + k of the length goes into sequence + k // per, at
    offset + (k % per) * length. A few rows per filling, so their number is
    bounded by the room and not by the corpus.
    """
    dealt = np.zeros(len(counts), dtype=np.int64)
    out, sequence = [], 0
    for n, filling in completed(counts, room):
        offset = 0
        for length, many in filling:
            first = int(dealt[length])
            out.append((length, first, first + n * many, sequence, many, offset))
            dealt[length] += n * many
            offset += many * length
        sequence += n
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int, room: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), and its place in the
    stored table: part and number. No shuffle."""
    ship(docs.sparkSession)
    columns = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    columns += [("ids_crc32", pa.int64()), ("part", pa.int32()), ("number", pa.int64())]
    columns += [("ids", pa.binary())] if with_ids else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        end = np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for low in range(0, len(ids), 500):
                rows = []
                for doc_id, raw in zip(ids[low : low + 500], encode.encode(texts[low : low + 500])):
                    raw += end
                    for k, start in enumerate(range(0, len(raw) // 4, room)):
                        own = raw[4 * start : 4 * (start + room)]
                        rows.append((doc_id, k, start, len(own) // 4, zlib.crc32(own), part, number, own)[: len(columns)])
                        number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, (_, t) in zip(zip(*rows), columns)], names=[c for c, _ in columns]
                )

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    schema = ", ".join(f"{c} {kinds[t]}" for c, t in columns)
    return stored(docs.select("doc_id", "text").mapInArrow(cut, schema), "packing-pieces")


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each document is its ids and the end id. Only documents longer than the room
    are cut, into pieces of it and a rest. Offsets in a sequence have no gaps.

    Defined cases: a null or empty text is its end id alone; rows that repeat are
    documents of their own; null doc_ids stay null; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = pieces(docs, tokenizer, end_id, room, with_ids)
    # Ranks within a length, without gathering a length: counts per part of the
    # stored table first, then places within the part.
    counts = stored(rows.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-counts")
    totals = np.zeros(room + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `room` rows
        totals[row["length"]] = row["n"]
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("number")) - 1
    ranked = rows.withColumn("inside", inside).join(before, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside"))
    schema = "its_length long, first long, last long, sequence long, per long, base long"
    dealt = spark.createDataFrame(places(totals, room), schema)
    fits = (F.col("length") == F.col("its_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    joined = ranked.join(F.broadcast(dealt), fits)  # bounded by the room, see places()
    step = F.col("rank") - F.col("first")
    return joined.select(
        *("doc_id", "piece", "start", "length", "ids_crc32"),
        (F.col("sequence") + F.floor(step / F.col("per"))).alias("sequence_id"),
        (F.col("base") + step % F.col("per") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
