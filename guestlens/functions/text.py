"""Text to typed values: null tokens, numbers, flags and composite keys."""

from __future__ import annotations

from guestlens.schemas import NULL_TOKENS

_NUMBER = r"^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"
_INTEGER = r"^\\s*[+-]?\\d+\\s*$"


def literal(text: str) -> str:
    """Text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def null_tokens(c: str) -> str:
    """The text, or null where it is one of the tokens that mean missing."""
    return f"CASE WHEN {c} NOT IN ({', '.join(map(literal, NULL_TOKENS))}) THEN {c} END"


def whole_number(c: str, kind: str = "BIGINT") -> str:
    """Text to an integer, cut toward zero.

    Digits are cast straight to the integer type, so long ids keep every digit;
    only text such as ``4.9`` goes through a double. Other text raises.
    """
    return (
        f"CASE WHEN {c} RLIKE '{_INTEGER}' THEN CAST({c} AS {kind}) "
        f"ELSE CAST(CAST({c} AS DOUBLE) AS {kind}) END"
    )


def lenient_decimal(c: str, kind: str = "DECIMAL(5,2)") -> str:
    """Text to a decimal rounded half up; text that is no number becomes null.

    The pattern comes first because a cast alone also reads ``8.5d`` and ``NaN``.
    A number too big for the type still raises.
    """
    return f"CASE WHEN {c} RLIKE '{_NUMBER}' THEN CAST({c} AS {kind}) END"


def flag(c: str) -> str:
    """Text to a boolean: null and ``false`` are false, a number is true unless
    zero, any other text is true."""
    return (
        f"CASE WHEN {c} IS NULL OR lower(trim({c})) = 'false' THEN false "
        f"WHEN {c} RLIKE '{_NUMBER}' THEN CAST({c} AS DOUBLE) <> 0 ELSE true END"
    )


def odd_flag(c: str) -> str:
    """Whether text is read as a flag that says neither true nor false, nor a number."""
    return f"coalesce(lower(trim({c})) NOT IN ('true', 'false') AND NOT {c} RLIKE '{_NUMBER}', false)"


def text_key(*parts: str) -> str:
    """Parts joined by ``|``; null if any part is null (``concat_ws`` would
    skip it)."""
    return "concat(" + ", '|', ".join(parts) + ")"
