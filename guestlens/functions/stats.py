"""Exact means, deviations and correlations from sums that can be merged.

Ratings have two decimals, so they are held as whole hundredths. Sums of whole
numbers do not depend on the order of rows, and a sum per lodging can be added
up to a sum per group. One pass over the reviews therefore serves every
statistic at every level.
"""

from __future__ import annotations


def hundredths(c: str) -> str:
    """A two-decimal number as a whole number of hundredths."""
    return f"CAST(rint(CAST({c} AS DOUBLE) * 100) AS BIGINT)"


def from_hundredths(c: str) -> str:
    """Whole hundredths as ``DECIMAL(18,2)``."""
    return f"CAST(CAST({c} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(18,2))"


def rounded_mean(total: str, n: str) -> str:
    """``total / n`` rounded half away from zero, in whole-number arithmetic.

    Null when ``n`` is zero. With ``total`` in hundredths this is the mean
    rounded to two decimals, without the second rounding that an average over
    decimals of limited scale would add.
    """
    size = f"(abs({total}) * 2 + {n}) div ({n} * 2)"
    return f"CASE WHEN {n} > 0 THEN CASE WHEN {total} < 0 THEN -({size}) ELSE {size} END END"


def sample_deviation(n: str, total: str, squares: str, digits: int = 2) -> str:
    """Sample deviation of hundredths, in original units; null below two rows."""
    spread = f"greatest({n} * {squares} - CAST({total} AS DOUBLE) * {total}, 0D)"
    deviation = f"sqrt({spread} / (CAST({n} AS DOUBLE) * ({n} - 1))) / 100"
    rounded = f"round(CAST({deviation} AS DECIMAL(28,10)), {digits})"
    return f"CASE WHEN {n} > 1 THEN CAST({rounded} AS DECIMAL(18,{digits})) END"


# --- sums that describe the pairs of two columns ------------------------------

# Each part with the aggregate that merges it.
_PAIR_PARTS = {
    "n": "sum", "x": "sum", "y": "sum", "xx": "sum", "yy": "sum", "xy": "sum",
    "xmin": "min", "xmax": "max", "ymin": "min", "ymax": "max",
}


def pair_sums(x: str, y: str) -> list[str]:
    """Aggregates over the rows where both whole-number columns are present.

    ``y`` must not be null where ``x`` is not. Squares and products are summed
    as doubles, which stay exact up to 2^53 and never overflow.
    """
    y_if = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    xd, yd = f"CAST({x} AS DOUBLE)", f"CAST({y_if} AS DOUBLE)"
    parts = {
        "n": f"count({x})", "x": f"sum({x})", "y": f"sum({y_if})",
        "xx": f"sum({xd} * {xd})", "yy": f"sum({yd} * {yd})", "xy": f"sum({xd} * {yd})",
        "xmin": f"min({x})", "xmax": f"max({x})", "ymin": f"min({y_if})", "ymax": f"max({y_if})",
    }
    return [f"{text} AS {x}_{part}" for part, text in parts.items()]


def merged_pair_sums(x: str) -> list[str]:
    """Aggregates that add up the ``pair_sums`` of finer groups."""
    return [f"{merge}({x}_{part}) AS {x}_{part}" for part, merge in _PAIR_PARTS.items()]


def pair_correlation(x: str) -> str:
    """Pearson's r from ``pair_sums``; null if either side is constant."""
    n, sx, sy = (f"CAST({x}_{part} AS DOUBLE)" for part in ("n", "x", "y"))
    vx = f"({n} * {x}_xx - {sx} * {sx})"
    vy = f"({n} * {x}_yy - {sy} * {sy})"
    r = f"({n} * {x}_xy - {sx} * {sy}) / (sqrt({vx}) * sqrt({vy}))"
    varies = f"{x}_xmin < {x}_xmax AND {x}_ymin < {x}_ymax AND {vx} > 0 AND {vy} > 0"
    return f"CASE WHEN {varies} THEN greatest(-1D, least(1D, {r})) END"


def correlation(x: str, y: str) -> str:
    """Pearson's r as an aggregate; pairs with a null are left out.

    ``corr`` itself raises on a constant column under ANSI rules, so the parts
    are combined only when both sides vary.
    """
    both = f"({x}) IS NOT NULL AND ({y}) IS NOT NULL"
    xx, yy = (f"CASE WHEN {both} THEN CAST({c} AS DOUBLE) END" for c in (x, y))
    varies = f"min({xx}) < max({xx}) AND min({yy}) < max({yy})"
    spread = f"stddev_samp({xx}) * stddev_samp({yy})"
    return f"CASE WHEN {varies} THEN try_divide(covar_samp({xx}, {yy}), {spread}) END"


def rounded_correlation(r: str) -> str:
    return f"CAST(round(CAST({r} AS DECIMAL(28,12)), 4) AS DECIMAL(5,4))"


def strongest(correlations: dict[str, str], default_first: bool = True) -> str:
    """Name of the largest absolute correlation.

    Compared at ten decimals, so float noise does not decide between equals;
    the first listed wins a tie. Nulls never win; when all are null the first
    name is returned, or null with ``default_first=False``.
    """
    first = next(iter(correlations))
    # Structs compare field by field, so the earlier of equal sizes is greater.
    known = ", ".join(
        f"CASE WHEN {r} IS NOT NULL THEN struct(round(abs({r}), 10) AS size, {-i} AS place, '{n}' AS name) END"
        for i, (n, r) in enumerate(correlations.items())
    )
    name = f"greatest({known}).name"
    return f"coalesce({name}, '{first}')" if default_first else name
