"""Scalar cleansing as SQL text; every one is a plain Catalyst expression."""

from __future__ import annotations


def utf16_length(text: str) -> str:
    """Length in UTF-16 units, which is how declared text widths are counted."""
    return (
        f"CASE WHEN octet_length({text}) = length({text}) THEN length({text}) "
        f"ELSE CAST(octet_length(encode({text}, 'UTF-16BE')) / 2 AS INT) END"
    )


def is_text(text: str, value: str) -> str:
    """Equality that ignores case and trailing blanks, but not leading ones."""
    return f"lower(rtrim({text})) = '{value.lower()}'"


def yes_no(text: str) -> str:
    """The usual spellings are told by their bytes; only others are folded."""
    return (
        f"CASE WHEN {text} = 'Yes' THEN true WHEN {text} = 'No' THEN false "
        f"WHEN {is_text(text, 'Yes')} THEN true WHEN {is_text(text, 'No')} THEN false END"
    )


def safe_int(text: str, kind: str) -> str:
    """``tinyint`` is the unsigned 0-255 kind and lands in a smallint."""
    if kind != "tinyint":
        return f"try_cast({text} AS {kind})"
    value = f"try_cast({text} AS smallint)"
    return f"CASE WHEN {value} BETWEEN 0 AND 255 THEN {value} END"


def safe_decimal(text: str, precision: int, scale: int) -> str:
    """Plain decimal notation only: exponents and grouping marks become NULL."""
    plain = f"{text} RLIKE r'^\\s*[+-]?\\d*\\.?\\d*\\s*$'"
    return f"CASE WHEN {plain} THEN try_cast({text} AS decimal({precision},{scale})) END"


def blank_to_null(text: str) -> str:
    return f"nullif(trim({text}), '')"


def one_line(text: str) -> str:
    """Line feed and tab become blanks, carriage returns vanish. Most text has none of
    them, and a byte search is much cheaper than rebuilding the string."""
    needed = " OR ".join(f"contains({text}, '{mark}')" for mark in (r"\n", r"\t", r"\r"))
    return rf"CASE WHEN {needed} THEN translate({text}, '\n\t\r', '  ') ELSE {text} END"


def bit(flag: str) -> str:
    return f"coalesce(CAST({flag} AS INT), 0)"
