"""Near-duplicate groups by fast similarity sketching.

A document is its set of word shingles. Its sketch has `COORDINATES` bins, filled
in rounds: in each of the first rounds every shingle is hashed to a bin with a
value that lies in that round's range, and bins keep their least value; the
rounds after those give bin i to its round alone, so every bin fills, after few
rounds for large sets and after at most twice as many as there are bins for
any. Two sets agree in a coordinate with the probability of their similarity,
and the number that agree is concentrated like that of independent draws.

Bands of `ROWS` coordinates propose candidates, and links are confirmed on full
sets:

1. Documents with equal sets are one class from the start, so copies cost
   nothing, however many there are.
2. Within a bucket of a band, a task proposes a tree of the most similar sketches
   that joins all members similar enough to be linked. Trees are confirmed, and
   confirmed links make components.
3. The proposed trees also say which classes could be linked at all: those of one
   cluster. Where a cluster still holds more than one component, the full sets of
   its members are compared across components, and each comparison that joins two
   ends them being two. So no link that the bands propose is lost, and pairs
   within a component are never made.

Buckets and clusters beyond `TOGETHER` members are cut into blocks, and each pair
of blocks is a group of its own, so a task never holds an unbounded one. Blocks of
a cluster's largest component are not paired with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.components import components
from guestlens.llm.tables import ship, stored

COORDINATES = 128
#: 32 bands of 4: a pair of similarity 0.85 is missed with probability
#: (1 - 0.85 ** 4) ** 32 < 1e-10, one of 0.8 with less than 1e-7.
ROWS = 4
#: Members of a bucket that one task compares at once.
TOGETHER = 2048
#: Standard deviations that an estimate may lie below the similarity asked for.
MARGIN = 6

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLY
    x = (x ^ (x >> np.uint64(29))) * _OTHER
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z in lower case."""
    from xxhash import xxh3_64_intdigest

    out = []
    for text in texts:
        words = text.lower().split() if text else []  # of bytes, so ASCII alone
        n = len(words) - size + 1
        if not words:
            out.append(np.empty(0, np.uint64))
        elif n < 1:
            # Joined by a space, which no word holds.
            out.append(np.array([xxh3_64_intdigest(b" ".join(words), 1)], np.uint64))
        else:
            own = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, count=len(words))
            run = own[:n]
            for k in range(1, size):
                run = _mixed(run) * _MULTIPLY + own[k : k + n]
            out.append(np.unique(_mixed(run)))
    return out


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row of 16-bit coordinates for each nonempty set, all sets at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    best = np.full((len(sets), coordinates), np.iinfo(np.uint64).max, np.uint64)
    flat = best.reshape(-1)
    for round_ in range(2 * coordinates):
        if not len(items):
            break
        hashed = _mixed(items + np.uint64((round_ + 1) * int(_OTHER) % 2**64))
        # The round comes first, so an earlier round's value is always less.
        value = (np.uint64(round_) << np.uint64(48)) | (hashed >> np.uint64(16))
        if round_ < coordinates:
            bins = ((_mixed(hashed) >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        else:
            bins = np.full(len(items), round_ - coordinates, np.uint64)
        np.minimum.at(flat, owner * coordinates + bins.astype(np.int64), value)
        open_ = (best == np.iinfo(np.uint64).max).any(axis=1)
        if not open_.all():
            stay = open_[owner]
            owner, items = owner[stay], items[stay]
    return (_mixed(best) >> np.uint64(48)).astype("<u2")


def described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, class (of equal sets) and sketch per row."""
    ship(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for low in range(0, len(texts), 256):
                sets = shingle_sets(texts[low : low + 256], size)
                full = [s for s in sets if len(s)]
                rows = iter(sketches(full))
                part = batch.slice(low, 256)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "class", "sketch"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = "doc_id long, text_hash long, n_shingles long, class binary, sketch binary"
    return rows.mapInArrow(describe, schema)


def buckets(classes: DataFrame) -> DataFrame:
    """key, class, n: buckets of two or more; of buckets with equal members, one."""
    width = 2 * ROWS
    cut = F.array(*[F.concat(F.lit(bytes([b])), F.expr(f"substring(sketch, {b * width + 1}, {width})")) for b in range(COORDINATES // ROWS)])
    members = stored(classes.select("class", F.explode(cut).alias("key")), "bands")
    # Summed per task before they are shuffled, so a bucket of any size is a row.
    sums = members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("x"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    chosen = sums.where("n > 1").groupBy("n", "x", "low", "high").agg(F.min("key").alias("key"))
    return members.join(chosen.select("key", "n"), "key")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members dealt to groups of bounded size: pairs of blocks of a bucket.

    Needs key, class, n (members of the key) and alike (how many of them need no
    comparison with each other), and whether the member is `bulk`, one of those.
    `side` is 0 and 1 for the two blocks of a pair, and 2 where they are one.
    """
    few = F.ceil((F.col("n") - F.col("alike")) / TOGETHER).cast("int")
    many = F.ceil(F.col("alike") / TOGETHER).cast("int")
    place = F.xxhash64("class", "key")
    together = F.col("n") <= TOGETHER
    rows = members.withColumn("few", F.when(together, 1).otherwise(few)).withColumn("many", F.when(together, 0).otherwise(many))
    own = F.when(F.col("bulk") & ~together, F.col("few") + F.pmod(place, F.col("many"))).otherwise(F.pmod(place, F.col("few")))
    rows = rows.withColumn("own", own.cast("int"))
    others = F.when(F.col("own") < F.col("few"), F.col("few") + F.col("many")).otherwise(F.col("few"))
    rows = rows.withColumn("others", others).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    pair = F.encode(F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")), "utf-8")
    used = ("key", "class", "n", "alike", "bulk", "few", "many", "own", "others", "other")
    return rows.select(F.concat("key", pair).alias("group"), "class", side.alias("side"), *[c for c in rows.columns if c not in used])


def _per_group(rows: DataFrame, work: Callable[[list[dict]], list[tuple[bytes, bytes]]]) -> DataFrame:
    """a, b: what `work` makes of the rows of each group, distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            found = []
            for row in _rows(batch):
                if group and row["group"] != group[0]["group"]:
                    found += work(group)
                    group = []
                group.append(row)
            yield _pairs(found)
        if group:
            yield _pairs(work(group))

    ship(rows.sparkSession)
    dealt = rows.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _rows(batch: pa.RecordBatch) -> list[dict]:
    """The rows of a batch, with lists of numbers as numpy views."""
    columns = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_list(column.type):
            ends, values = column.offsets.to_numpy(), column.values.to_numpy()
            columns[name] = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
        else:
            columns[name] = column.to_pylist()
    return [dict(zip(columns, row)) for row in zip(*columns.values())]


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    found = [(min(p), max(p)) for p in found]
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"]
    )


def _agreements(group: list[dict]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """classes, sides, sketches, and a place per member."""
    names = [r["class"] for r in group]
    sides = np.array([r["side"] for r in group])
    marks = np.frombuffer(b"".join(r["sketch"] for r in group), "<u2").reshape(len(group), -1)
    return names, sides, marks, np.arange(len(group))


def _tree(least: int) -> Callable[[list[dict]], list[tuple[bytes, bytes]]]:
    """Links of a tree of greatest agreement, of at least `least` coordinates.

    Prim's method, a row of agreements at a time. In a pair of blocks only
    members of different blocks are compared.
    """

    def work(group: list[dict]) -> list[tuple[bytes, bytes]]:
        names, sides, marks, place = _agreements(group)
        best = np.full(len(group), -1)
        via = np.zeros(len(group), dtype=np.int64)
        inside = np.zeros(len(group), dtype=bool)
        found, last = [], 0
        for _ in range(len(group) - 1):
            inside[last] = True
            agree = (marks == marks[last]).sum(axis=1)
            agree[(sides == sides[last]) & (sides != 2)] = -1
            better = (agree > best) & ~inside
            best[better], via[better] = agree[better], last
            rest = place[~inside]
            last = int(rest[best[rest].argmax()])
            if best[last] >= least:
                found.append((names[via[last]], names[last]))
        return found

    return work


def _across(least: int, percent: int) -> Callable[[list[dict]], list[tuple[bytes, bytes]]]:
    """Confirmed links that join the components of a group, on full sets.

    Each member is compared with those of other components that agree in `least`
    coordinates. Components joined count as one from then on.
    """

    def work(group: list[dict]) -> list[tuple[bytes, bytes]]:
        names, sides, marks, place = _agreements(group)
        _, root = np.unique([r["root"] for r in group], return_inverse=True)
        if root.max() == 0:
            return []
        sizes = np.array([len(r["shingles"]) for r in group])
        _, items = np.unique(np.concatenate([r["shingles"] for r in group]), return_inverse=True)
        ends = np.cumsum(sizes)
        own = [items[e - n : e] for e, n in zip(ends, sizes)]
        has = np.zeros(int(items.max()) + 1, dtype=np.int64)
        found = []
        # Members of small components first: they have most to be compared with.
        for k in np.argsort(np.bincount(root)[root], kind="stable").tolist():
            other = place[(root != root[k]) & ((sides != sides[k]) | (sides[k] == 2))]
            other = other[(marks[other] == marks[k]).sum(axis=1) >= least]
            if not len(other):
                continue
            has[own[k]] = 1
            starts = np.cumsum([0, *sizes[other][:-1]])
            shared = np.add.reduceat(has[np.concatenate([own[j] for j in other.tolist()])], starts)
            has[own[k]] = 0
            for j in other[100 * shared >= percent * (sizes[other] + sizes[k] - shared)].tolist():
                if root[j] != root[k]:
                    found.append((names[k], names[j]))
                    root[root == root[j]] = root[k]
        return found

    return work


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of a, b those with 100 * shared >= percent * united, on full sets."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("of_b"))
    rows = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    rows = rows.select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("total"))
    return rows.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("a", "b")


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """class, shingles of the wanted (class, doc_id, text_hash)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for low in range(0, len(texts), 256):
                sets = [s.view(np.int64) for s in shingle_sets(texts[low : low + 256], size)]
                ends = np.cumsum([0, *map(len, sets)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("class").slice(low, 256), lists], names=["class", "shingles"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    keys = wanted.select(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash"), "class")
    found = rows.join(keys, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash")))
    made = found.select("class", "text").mapInArrow(make, "class binary, shingles array<bigint>")
    return made.dropDuplicates(["class"])  # rows that repeat


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, root, component_id, kept: a row per document.

    Sets are of `size`-word shingles; a text of fewer words is one shingle.
    Documents are linked if 100 * shared >= percent * united. component_id is the
    smallest doc_id reachable, kept tells whether it is the document's own; root
    names the component, and is null for a text without words.

    Defined cases: texts without words are linked with nothing, and kept; among
    rows of equal doc_id all are kept if one is; a null doc_id is never the
    smallest, and is kept if its component has no other; no rows give no rows.
    """
    rows = stored(described(docs, size), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = rows.where("n_shingles > 0").groupBy("class").agg(first.alias("first"), F.max("sketch").alias("sketch"))
    classes = stored(classes.select("class", "first.doc_id", "first.text_hash", "sketch"), "classes")
    members = stored(buckets(classes), "buckets")
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi")
    sets = stored(_full_sets(docs, wanted, size), "full-sets")

    p = percent / 100
    least = int(COORDINATES * p - MARGIN * (COORDINATES * p * (1 - p)) ** 0.5)
    marks = wanted.select("class", "sketch")
    whole = members.withColumn("alike", F.lit(0)).withColumn("bulk", F.lit(False))
    tried = stored(_per_group(_in_blocks(whole.join(marks, "class")), _tree(least)), "tree-pairs")
    links = stored(confirmed(tried, sets, percent), "tree-links")
    roots = components(links).select(F.col("node").alias("class"), "root")

    # Clusters that still hold several components, by sums before the shuffle.
    clusters = components(tried).select(F.col("node").alias("class"), F.col("root").alias("key"))
    labelled = clusters.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    labelled = stored(labelled, "clusters")
    parts = labelled.groupBy("key", "root").agg(F.count("*").alias("n"))
    several = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts")
    )
    several = several.where("parts > 1").select("key", "n", F.col("top.n").alias("alike"), F.col("top.root").alias("top"))
    open_ = labelled.join(several, "key").withColumn("bulk", F.col("root") == F.col("top")).drop("top")
    open_ = open_.join(marks, "class").join(sets, "class")
    more = stored(_per_group(_in_blocks(open_), _across(least, percent)), "other-links")
    links = links.unionByName(more)
    roots = stored(components(links), "components") if not more.isEmpty() else roots.withColumnRenamed("class", "node")

    names = classes.select("class", "doc_id").join(roots, F.col("class") == F.col("node"), "left")
    names = names.select("class", "doc_id", F.coalesce("root", "class").alias("root"))
    smallest = names.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = names.join(smallest, "root").select(F.col("class").alias("its_class"), "root", "component_id")
    out = rows.join(labels, F.col("class") == F.col("its_class"), "left")
    out = out.withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_hash", "n_shingles", "root", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, with one row of each component.

    That is the row of the smallest doc_id, null last; of rows that repeat, one.
    Texts without words all stay.
    """
    found = near_duplicates(docs, size, percent)
    identity = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    firsts = found.where("root is not null").groupBy("root").agg(F.min(identity).alias("first"), F.count("*").alias("n"))
    # A row repeats only within its component; where that has one row, nothing does.
    firsts = firsts.select("first.doc_id", "first.text_hash", (F.col("n") > 1).alias("among"))
    bare = found.where("root is null").select("doc_id", "text_hash", F.lit(False).alias("among")).distinct()
    stay = firsts.unionByName(bare).select(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash"), "among")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash"))
    rows = stored(rows.join(stored(stay, "stay"), same).select("doc", "doc_id", "text_hash", "among"), "one-per-group")
    alone = rows.where("not among").select("doc.*")
    return alone.unionByName(rows.where("among").dropDuplicates(["doc_id", "text_hash"]).select("doc.*"))
