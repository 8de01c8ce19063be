"""DuckDB SQL for the queries that SQL can express, over whole tables.

Written from the definitions, not from the Spark plans: windows are compared as
texts, sets as rows, and components by walking all links.
"""

from __future__ import annotations

from guestlens.llm import codebooks, mixing, quality, secrets

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
    coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '') AS identity,
    0.1::DOUBLE + 0.9::DOUBLE * (length(regexp_replace(coalesce(text, ''), '{mixing.POOR}', '', 'g'))
      / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS weight
  FROM documents),
keyed AS (
  SELECT *, least(greatest(floor((1 - exp(-(-ln((('0x' || substr(md5(identity), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE)
    / weight))) * 281474976710656::DOUBLE), 0), 281474976710655) AS key
  FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM keyed GROUP BY source),
caps AS (
  SELECT *, 2::DOUBLE * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(weight) OVER () AS all_weight
  FROM sources),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER earlier, 0)) / (all_weight - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM caps
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap <= level * weight THEN cap ELSE max(CASE WHEN cap > level * weight THEN level END) OVER () * weight END AS target
  FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.identity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND 2 * (through - size) + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""

PASSAGES = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM texts)),
twice AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, place FROM (SELECT r, unnest(range(i, i + 35)) AS place FROM windows JOIN twice USING (s))),
stay AS (
  SELECT r, array_to_string(list(word ORDER BY place), ' ') AS kept, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts) x
  ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN stay USING (r)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 2), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT x.r AS a, x.q AS b
  FROM (SELECT p.r AS r, q.r AS q, count(*) AS shared FROM shingles p JOIN shingles q ON p.s = q.s AND p.r <> q.r GROUP BY ALL) x
  JOIN sizes m ON m.r = x.r JOIN sizes n ON n.r = x.q
  WHERE 100 * shared >= 85 * (m.n + n.n - shared)),
reached AS (
  SELECT r AS a, r AS b FROM texts UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
smallest AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN texts ON reached.b = texts.r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM texts JOIN smallest USING (r) LEFT JOIN sizes USING (r)
"""

_FIRST = quality.COMMON
_CLASSES = ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[!-/:-@\[-`{-~\x00-\x08\x0E-\x1F\x7F]", r"[^\x00-\x7F]")


def _divergence(p: str, q: str) -> str:
    """Of two columns of shares, as an aggregate over their rows."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
    return f"sqrt(greatest(0, 0.5 * sum({part.format(p, q)} + {part.format(q, p)})))"


_COUNTS = ", ".join(
    f"length(t) - length(regexp_replace(t, '{c.replace(chr(39), chr(39) * 2)}', '', 'g'))" for c in _CLASSES
)

QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w,
    regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS lowered
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM texts)),
twice AS (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM windows JOIN twice USING (r, s)) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
taught AS (
  SELECT min(r) AS r, lang FROM texts LEFT JOIN covered USING (r)
  WHERE lang IS NOT NULL AND len(w) >= {quality.LEAST_WORDS} AND 100 * coalesce(n, 0) <= {quality.MOST_REPEATED_PERCENT} * len(w)
  GROUP BY lang, t),
languages AS (SELECT DISTINCT lang FROM taught),
chars AS (
  SELECT r, lang, unnest(range(0, {len(_CLASSES)})) AS k, unnest([{_COUNTS}]) AS n, length(t) AS total FROM texts JOIN languages USING (lang)),
char_reference AS (SELECT lang, k, sum(n) / sum(total) AS q FROM chars WHERE r IN (SELECT r FROM taught) GROUP BY lang, k),
char_distance AS (
  SELECT r, {_divergence('p', 'q')} AS d
  FROM (SELECT r, lang, k, n / total::DOUBLE AS p FROM chars WHERE total >= {quality.LEAST_CHARS_JUDGED}) JOIN char_reference USING (lang, k)
  GROUP BY r),
words AS (SELECT r, lang, unnest(lowered) AS word FROM texts JOIN languages USING (lang)),
taught_words AS (SELECT lang, word FROM words WHERE r IN (SELECT r FROM taught)),
common AS (
  SELECT lang, word, n FROM (SELECT lang, word, count(*) AS n FROM taught_words GROUP BY lang, word)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {_FIRST}),
totals AS (SELECT lang, count(*) AS total FROM taught_words GROUP BY lang),
word_reference AS (
  SELECT lang, word, n / total::DOUBLE AS q FROM common JOIN totals USING (lang)
  UNION ALL SELECT lang, NULL, (any_value(total) - sum(n)) / any_value(total)::DOUBLE FROM common JOIN totals USING (lang) GROUP BY lang),
own AS (
  SELECT x.r, c.word, count(*) AS n FROM words x LEFT JOIN common c ON c.lang = x.lang AND c.word = x.word GROUP BY x.r, c.word),
judged AS (SELECT r, lang, len(lowered) AS total FROM texts JOIN languages USING (lang) WHERE len(w) >= {quality.LEAST_WORDS_JUDGED}),
word_distance AS (
  SELECT r, {_divergence('p', 'q')} AS d
  FROM (SELECT j.r, coalesce(o.n, 0) / j.total::DOUBLE AS p, f.q AS q
    FROM judged j JOIN word_reference f ON f.lang = j.lang LEFT JOIN own o ON o.r = j.r AND o.word IS NOT DISTINCT FROM f.word)
  GROUP BY r),
counted AS (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(c.d, 0) AS char_d, coalesce(x.d, 0) AS word_d
  FROM texts LEFT JOIN lines USING (r) LEFT JOIN covered USING (r) LEFT JOIN char_distance c USING (r) LEFT JOIN word_distance x USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words)
    AND char_d <= {quality.MOST_CHAR_DISTANCE} AND word_d <= {quality.MOST_WORD_DISTANCE} AS kept
FROM counted
"""


def _any_case(words: str) -> str:
    """RE2 folds case beyond ASCII, so both cases are spelled out."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _pattern(kind: int) -> str:
    pattern = (secrets.BASE_KINDS + secrets.WEAK_KINDS)[kind][1]
    if pattern.startswith("(?i:"):
        words, rest = pattern[4:].split("))", 1)
        pattern = _any_case(words + ")") + rest
    return pattern.replace("'", "''")


def _matches(kind: int) -> str:
    _, _, group, least = (secrets.BASE_KINDS + secrets.WEAK_KINDS)[kind]
    pattern = _pattern(kind)
    return f"""
  SELECT r, {kind} AS kind, length(regexp_extract(m, '{pattern}', {group})) >= {least} AS fits,
    sum(length(gap)) OVER upto + coalesce(sum(length(m)) OVER earlier, 0) AS start, length(m) AS n
  FROM (SELECT r, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(list_slice(s, 1, len(m))) AS gap
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS s FROM texts))
  WINDOW upto AS (PARTITION BY r ORDER BY i), earlier AS (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


_KIND = {name: k for k, name in enumerate(secrets.KINDS)}
_LAST_BASE = len(secrets.BASE_KINDS) - 1
_NAMES = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
_LOOSE = f"{_KIND['opaque']}, {_KIND['short']}"
_SECRET_KINDS = f"{_KIND['assign']}, {_KIND['hex']}, {_LOOSE}"


def _near(kinds: str) -> str:
    return (
        "EXISTS (SELECT 1 FROM clear o WHERE o.r = c.r AND NOT (o.kind = c.kind AND o.start = c.start)"
        f" AND o.kind IN ({kinds}) AND o.start - c.finish <= {secrets.SCOPE} AND c.start - o.finish <= {secrets.SCOPE})"
    )


SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(_matches(k) for k in range(len(secrets.KINDS)))}),
spans AS (SELECT r, kind, start::BIGINT AS start, (start + n)::BIGINT AS finish FROM found WHERE fits),
clear AS (
  SELECT * FROM spans s WHERE kind <= {_LAST_BASE} OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.r = s.r AND b.kind <= {_LAST_BASE} AND b.start < s.finish AND s.start < b.finish)),
reported AS (
  SELECT * FROM clear c WHERE kind <= {_LAST_BASE}
    OR kind IN ({_LOOSE}) AND ({_near(str(_KIND['access']))} OR ({_near(str(_KIND['user']))} AND {_near(str(_KIND['endpoint']))}))
    OR kind = {_KIND['user']} AND {_near(_SECRET_KINDS)} AND {_near(str(_KIND['endpoint']))}
    OR kind = {_KIND['endpoint']} AND ({_near(str(_KIND['access']))} OR {_near(str(_KIND['user']))}) AND {_near(_SECRET_KINDS)}),
listed AS (
  SELECT r, string_agg({_NAMES}[kind + 1] || ':' || start || ':' || finish, ',' ORDER BY start, kind) AS spans,
    string_agg(CASE WHEN kind <= {_LAST_BASE} THEN {_NAMES}[kind + 1] || ':' || start || ':' || finish END, ',' ORDER BY start, kind) AS base,
    count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex
  FROM reported GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (r)
"""


_PARTS, _ENTRIES = codebooks.PARTS, codebooks.ENTRIES
_FAR = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _assign(book: str) -> str:
    """Each part with its entry and the distance to it; the lower of equal ones."""
    return f"""
  SELECT r, part, any_value(x) AS x, min_by(e, far * {_ENTRIES} + e) AS e, min(far) AS far
  FROM (SELECT p.r, p.part, p.x, b.e, {_FAR}::BIGINT AS far FROM parts p JOIN {book} b USING (part)) GROUP BY r, part"""


def _move(assigned: str, book: str) -> str:
    return f"""
  SELECT b.part, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
    SELECT part, e, list(v ORDER BY i) AS x FROM (
      SELECT part, e, i, ((sum(c) - (((sum(c) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS v
      FROM (SELECT part, e, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS i FROM {assigned}) GROUP BY part, e, i)
    GROUP BY part, e) m ON m.part = b.part AND m.e = b.e"""


CODEBOOKS = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r,
    list_transform(embedding, lambda c: floor({codebooks.SCALE} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (
  SELECT r, part, list_slice(v, part * (len(v) // {_PARTS}) + 1, (part + 1) * (len(v) // {_PARTS})) AS x
  FROM (SELECT r, v, unnest(range(0, {_PARTS})) AS part FROM kept)),
book0 AS MATERIALIZED (SELECT part, r AS e, x FROM parts WHERE r < {_ENTRIES}),
assigned0 AS MATERIALIZED ({_assign('book0')}),
book1 AS MATERIALIZED ({_move('assigned0', 'book0')}),
assigned1 AS MATERIALIZED ({_assign('book1')}),
book2 AS MATERIALIZED ({_move('assigned1', 'book1')}),
assigned2 AS MATERIALIZED ({_assign('book2')}),
coded AS (
  SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM assigned2 GROUP BY r),
digest AS (
  SELECT sha256(string_agg(v, ',' ORDER BY part, e, i)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(x)::VARCHAR AS v, unnest(range(1, len(x) + 1)) AS i FROM book2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN digest
"""
