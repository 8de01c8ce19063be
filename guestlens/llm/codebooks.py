"""Short codes for vectors: one codebook for each of their equal parts.

All arithmetic is on whole numbers. Parts and entries, padded with zeros to a
power of two, go through the integer Walsh-Hadamard transform; the squared
differences of the transforms add up to the squared distance times the padded
size. They are added in order of sequency, slow changes first, and an entry is
left out as soon as its sum is above that of an entry known in full. So no
rounding ever decides which entry is nearest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored
from guestlens.operators.rows import lookup

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts compared at a time, which bounds the memory of a task.
TOGETHER = 8192
#: Integers beyond this size are held to it, errors to the greatest long.
GREATEST = 10.0**30
_LONG = (1 << 63) - 1


def walsh(size: int) -> np.ndarray:
    """The Hadamard matrix of a power of two, rows by number of sign changes."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """The transform of each row, padded with zeros; whole numbers throughout."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    padded = np.zeros((len(parts), size), parts.dtype)
    padded[:, : parts.shape[1]] = parts
    return padded @ walsh(size).astype(parts.dtype).T


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, the lower of equal ones, and the
    squared distance to it."""
    x, e = transformed(parts), transformed(entries)
    size = x.shape[1]
    found = np.zeros(len(x), np.int64)
    least = np.zeros(len(x), x.dtype)
    for start in range(0, len(x), TOGETHER):
        own = x[start : start + TOGETHER]
        sums = (own[:, :1] - e[None, :, 0]) ** 2
        # The sum of the entry that looks best so far, in full, is the bound.
        guess = np.argmin(sums, axis=1)
        bound = ((own - e[guess]) ** 2).sum(1)
        row, entry = np.nonzero(sums <= bound[:, None])
        sums = sums[row, entry]
        for k in range(1, size):
            sums = sums + (own[row, k] - e[entry, k]) ** 2
            if k + 1 < size:
                stay = sums <= bound[row]
                row, entry, sums = row[stay], entry[stay], sums[stay]
        # Entries stand in ascending order, so the first of the least is the lower.
        first = np.flatnonzero(np.diff(row, prepend=-1))
        best = np.minimum.reduceat(sums, first)
        hit = np.flatnonzero(sums == np.repeat(best, np.diff(np.append(first, len(row)))))
        hit = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
        found[start : start + TOGETHER] = entry[hit]
        least[start : start + TOGETHER] = best // size
    return found, least


def _wide(numbers: np.ndarray, dims: int) -> bool:
    """Whether squared distances of such numbers may not fit 64 bits. A difference
    of transforms is at most 2 * size * greatest, and size squares are added."""
    size = 2 * max(1, dims)
    return bool(numbers.size) and 4 * size**3 * float(np.abs(numbers).max()) ** 2 >= 2.0**62


def whole_numbers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: 64-bit where all sums fit, else Python's
    whole numbers, with which the same arithmetic is exact at any size."""
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
    values = np.clip(np.floor(values * scale), -GREATEST, GREATEST)
    if _wide(values, dims):
        return np.array([[int(v) for v in row] for row in values.tolist()], object).reshape(-1, dims)
    return values.astype(np.int64)


def kept_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding of rows whose vector has only finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return vectors.where(F.col("embedding").isNotNull() & finite)


class Codebooks:
    """The entries of every part, as whole numbers."""

    def __init__(self, books: list[np.ndarray], dims: int, scale: int):
        self.books, self.dims, self.scale = books, dims, scale

    def listed(self) -> list[list[list[int]]]:
        """Components by part, entry and place."""
        return [[[int(v) for v in entry] for entry in book] for book in self.books]

    def digest(self) -> str:
        text = ",".join(str(v) for book in self.listed() for entry in book for v in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def _first(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """Books made of the smallest ids, equal ids by their vectors."""
    smallest = vectors.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries)
    chosen = [r.embedding for r in smallest.collect()]
    dims = len(chosen[0]) if chosen else 0
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    chosen = [v for v in chosen if len(v) == dims]
    numbers = whole_numbers(pa.array(chosen, pa.list_(pa.float64())), dims, scale) if chosen else np.zeros((0, 0), np.int64)
    return Codebooks(np.split(numbers, parts, axis=1) if dims else [numbers] * parts, dims, scale)


def _of_size(vectors: DataFrame, dims: int) -> DataFrame:
    return vectors.where(F.size("embedding") == dims)


def _assigned(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per part: the numbers of the batch, the entries they go to, the distances."""
    numbers = whole_numbers(batch.column("embedding"), books.dims, books.scale)
    kind = np.result_type(numbers, *books.books)  # Python's numbers if either has them
    for part, book in zip(np.split(numbers, len(books.books), axis=1), books.books):
        yield part, *nearest(part.astype(kind), book.astype(kind))


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry becomes the floor of the mean of its parts. A task adds up
    its own vectors; what meets in Spark and on the driver is a row per component
    of an entry, so entries times dimensions however many vectors there are."""
    entries = len(books.books[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books.dims // len(books.books)
        counts = np.zeros((len(books.books), entries), np.int64)
        sums = np.zeros((len(books.books), entries, width), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (part, entry, _) in enumerate(_assigned(batch, books)):
                counts[p] += np.bincount(entry, minlength=entries)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                # Sums of a batch are small where numbers are 64-bit ones, else exact.
                sums[p, used] += np.add.reduceat(part[order], first, axis=0).astype(object)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p.astype(np.int32)),
                pa.array(e.astype(np.int32)),
                pa.array(counts[p, e]),
                pa.array([[str(v) for v in row] for row in sums[p, e]], pa.list_(pa.string())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    partial = vectors.select("embedding").mapInArrow(add, "part int, entry int, n long, sums array<string>")
    places = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "sum"))
    added = places.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    )
    new = [b.astype(object) for b in books.books]
    for r in added.collect():
        new[r.part][r.entry, r.place] = int(r.sum) // r.n
    return Codebooks([b if _wide(b, books.dims) else b.astype(np.int64) for b in new], books.dims, books.scale)


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of all vectors, by rounds of assigning and averaging."""
    ship(vectors.sparkSession)
    books = _first(vectors, parts, entries, scale)
    for _ in range(rounds if books.dims else 0):
        books = _moved(_of_size(vectors, books.dims), books)
    return books


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, codes (an entry per part) and error, the squared distances
    summed over the parts."""
    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error long"
    if not books.dims:
        return vectors.where("false").select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [(entry, far) for _, entry, far in _assigned(batch, books)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.int32)
            errors = sum(far.astype(object) for _, far in found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.ListArray.from_arrays(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32), pa.array(codes.ravel())),
                    pa.array([min(v, _LONG) for v in errors], pa.int64()),
                ],
                names=["vec_id", "label", "codes", "error"],
            )

    return _of_size(vectors, books.dims).mapInArrow(code, schema)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors of all rows of a label, nulls together. The
    rows of a label that many have are spread, as ``lookup`` does."""
    name = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    kept = stored(rows.withColumn("label_name", name), "coded-vectors")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = kept.groupBy("label_name").agg(F.least(total, F.lit(_LONG)).cast("long").alias("label_error"))
    return lookup(kept, sums, "label_name", "left").drop("label_name")


def compressed(rows: DataFrame, **settings: int) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, codes, error, label_error of every kept vector, and the
    codebooks.

    Left out: vectors that are null or hold null or non-finite components, and
    those of another size than the vector of the smallest id. Defined cases: equal
    ids are ordered by their vectors, null ids come last; with fewer vectors than
    entries the books are shorter; without vectors there are no rows and the books
    are empty. Repeated rows are rows of their own. Integers beyond 1e30 count as
    1e30, errors beyond a long as the greatest long. Vectors that cannot be cut
    into equal parts raise ValueError. Other columns are not read.
    """
    vectors = kept_vectors(rows)
    books = trained(vectors, **settings)
    return with_label_errors(coded(vectors, books)), books
