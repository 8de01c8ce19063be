"""Secret scans: fixed kinds of secrets, and weak parts linked to each other.

The base kinds are reported wherever they occur. Weak parts (user names, opaque
strings, short assigned secrets, endpoints) occur in harmless text too, so each is reported only if parts
that complete a credential lie within `SCOPE` characters of it. That interval
join is a sweep: parts of a document are ordered by place, and each weak part
looks at the nearest part of every other kind before and after it. It never
builds pairs, and only documents with weak parts take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import only, stored

_SIGNS = "[A-Za-z0-9+/_.=-]"
_VALUE = rf"({_SIGNS}+)"
_SECRET_NAMES = "(?i:(password|passwd|secret|token|api_?key))"
_SETS = r"""["']?\x20*[:=]\x20*["']?"""

#: Kind, pattern, and what a match needs: the group measured and
#: its least length. The kinds' order settles spans that start together.
BASE_KINDS = (
    ("assign", rf"{_SECRET_NAMES}{_SETS}{_VALUE}", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
_HOST = r"[A-Za-z0-9_.-]+(?::[0-9]+)?"
#: Any scheme, with user and password inside or not. The scheme is bounded, so that
#: a long run of letters is not walked from each of its places to its end.
_URL = rf"""[A-Za-z][A-Za-z0-9+.-]{{0,30}}://(?:[^\x00-\x20/@"'<>]*@)?(?:\[[0-9A-Fa-f:.]+\]|{_HOST})"""
#: Without a scheme, a dot, a port or brackets tell a host from a word.
_BARE = r"(?:[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+(?::[0-9]+)?|[A-Za-z0-9_-]+:[0-9]+|\[[0-9A-Fa-f:.]+\])"
_IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_HOST_NAMES = r"(?:[Hh][Oo][Ss][Tt](?:[Nn][Aa][Mm][Ee])?|[Ss][Ee][Rr][Vv][Ee][Rr]|[Aa][Dd][Dd][Rr](?:[Ee][Ss][Ss])?)"
_SSH = r"[Ss][Ss][Hh]\x20+[A-Za-z0-9_.-]+@[A-Za-z0-9_.-]+"
_JDBC = rf"jdbc:[a-z0-9:]+:@(?://)?{_HOST}"

#: Reported only with complementary parts in scope.
WEAK_KINDS = (
    ("user", rf"(?i:(user|username|login|account|client_?id)){_SETS}([A-Za-z0-9_.@-]{{3,}})", 0, 0),
    ("opaque", r"[A-Za-z0-9+/_-]{24,}={0,2}", 0, 0),
    ("endpoint", rf"{_URL}|{_IPV4}|{_JDBC}|{_SSH}|{_HOST_NAMES}{_SETS}(?:{_URL}|{_BARE})", 0, 0),
    # Three characters in quotes, or with a digit, plus or underscore: words alone are
    # prose. Long assignments match too, and are dropped as the base span covers them.
    ("short", rf"""{_SECRET_NAMES}["']?\x20*[:=]\x20*(?:["']{_SIGNS}{{3,}}|[A-Za-z/.=-]*[0-9+_]{_SIGNS}{{2,}}|[A-Za-z/.=-]+[0-9+_]{_SIGNS}|[A-Za-z/.=-]{{2,}}[0-9+_])""", 0, 0),
)
KINDS = tuple(k[0] for k in BASE_KINDS + WEAK_KINDS)

#: Most characters between parts of one credential.
SCOPE = 200
MASK = "[REDACTED]"

_SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: str, kind: int) -> tuple[Column, Column]:
    """Matches and the pieces of text between them; then `_placed` adds them up."""
    _, pattern, _, _ = (BASE_KINDS + WEAK_KINDS)[kind]
    hit = F.col(text).rlike(pattern)
    none = F.expr("cast(array() as array<string>)")
    found = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    between = F.when(hit, F.split(text, pattern, -1)).otherwise(none)
    return found, between


def _placed(kind: int) -> Column:
    """array<struct<start, kind, end>> in code points, end exclusive."""
    _, pattern, group, least = (BASE_KINDS + WEAK_KINDS)[kind]
    found, between = F.col(f"found{kind}"), f"between{kind}"
    sized = F.transform(
        found,
        lambda x, i: F.struct(
            F.length(F.get(F.col(between), i)).alias("gap"),
            F.length(x).alias("long"),
            (F.length(F.regexp_extract(x, pattern, group)) >= least).alias("fits"),
        ),
    )
    start = F.struct(F.lit(0).alias("place"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("spans"))

    def step(seen, x):
        begin = seen["place"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + x["long"]).alias("end"))
        spans = F.when(x["fits"], F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct((begin + x["long"]).alias("place"), spans.alias("spans"))

    return F.aggregate(sized, start, step)["spans"]


def parts(docs: DataFrame) -> DataFrame:
    """doc (all columns), base and weak: sorted spans of both sorts of kinds."""
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    columns = []
    for kind in range(len(KINDS)):
        found, between = _spans("t", kind)
        columns += [found.alias(f"found{kind}"), between.alias(f"between{kind}")]
    rows = rows.select("doc", *columns)
    strong = range(len(BASE_KINDS))
    weak = range(len(BASE_KINDS), len(KINDS))
    return rows.select(
        "doc",
        F.sort_array(F.concat(*[_placed(k) for k in strong])).alias("base"),
        F.sort_array(F.concat(*[_placed(k) for k in weak])).alias("weak"),
    )


def _linked(rows: DataFrame) -> DataFrame:
    """row, weak parts -> row, linked: the weak spans that are reported."""
    places = rows.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.start", "p.kind", "p.end")
    up = Window.partitionBy("row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"), F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1
    )

    def gap(of: Column) -> Column:
        """Characters to the nearest part of these kinds, null if there is none."""
        back = F.col("start") - F.max(F.when(of, F.col("end"))).over(up)
        ahead = F.min(F.when(of, F.col("start"))).over(down) - F.col("end")
        return F.least(back, ahead)

    kind = F.col("kind")
    code = {name: KINDS.index(name) for name in KINDS}
    # A weak part that overlaps a base span is that secret, or a part of it.
    clear = places.withColumn("to_base", gap(kind < len(BASE_KINDS)))
    clear = clear.where((kind < len(BASE_KINDS)) | F.col("to_base").isNull() | (F.col("to_base") >= 0))
    near = {
        "access": gap(kind == code["access"]),
        "user": gap(kind == code["user"]),
        "secret": gap(kind.isin(code["assign"], code["hex"], code["opaque"], code["short"])),
        "endpoint": gap(kind == code["endpoint"]),
    }
    seen = clear.select("row", "start", "kind", "end", *[(c <= SCOPE).alias(n) for n, c in near.items()])
    for name in near:
        seen = seen.withColumn(name, F.coalesce(name, F.lit(False)))
    complete = (
        F.when(kind.isin(code["opaque"], code["short"]), F.col("access") | (F.col("user") & F.col("endpoint")))
        .when(kind == code["user"], F.col("secret") & F.col("endpoint"))
        .when(kind == code["endpoint"], (F.col("access") | F.col("user")) & F.col("secret"))
        .otherwise(F.lit(False))
    )
    reported = seen.where(complete)
    # One row per document; the list is no longer than the document's own parts.
    return reported.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def scanned(docs: DataFrame) -> DataFrame:
    """doc (all columns), base (array of spans) and spans (base and linked ones).

    A span is a struct of start, kind (its place in KINDS) and end, in code
    points, end exclusive; arrays are in order of start, then kind.

    Defined cases: a null or empty text has no spans; repeated rows each get
    their own; overlapping spans of different kinds all stay; weak parts that
    overlap a base span are dropped, as that is reported; no rows give no rows.
    """
    rows = parts(docs)
    alone = only(rows, F.size("weak") == 0, "doc", "base").withColumn("spans", F.col("base"))
    some = only(rows, F.size("weak") > 0, "doc", "base", "weak")
    some = stored(some.withColumn("row", F.monotonically_increasing_id()), "secret-parts")
    linked = _linked(some.select("row", "base", "weak")).withColumnRenamed("row", "linked_row")
    joined = some.join(linked, F.col("row") == F.col("linked_row"), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("linked", F.expr(f"cast(array() as array<{_SPAN}>)"))))
    return alone.unionByName(joined.select("doc", "base", spans.alias("spans")))


def described(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    name = lambda x: F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by MASK."""
    start = F.struct(F.lit(0).alias("place"), F.expr("cast(array() as array<string>)").alias("pieces"))

    def step(seen, x):
        piece = F.concat(F.substring(text, seen["place"] + 1, x["start"] - seen["place"]), F.lit(MASK))
        pieces = F.when(x["start"] >= seen["place"], F.concat(seen["pieces"], F.array(piece))).otherwise(seen["pieces"])
        return F.struct(F.greatest(seen["place"], x["end"]).alias("place"), pieces.alias("pieces"))

    def finish(seen):
        tail = F.substring(text, seen["place"] + 1, F.length(text))
        return F.concat(F.array_join(seen["pieces"], ""), tail)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))
