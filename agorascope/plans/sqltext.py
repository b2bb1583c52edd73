"""Small builders for the SQL counterparts."""

from __future__ import annotations

from collections.abc import Sequence


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def has_any(column: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(t)})" for t in terms) + ")"


def has_word(column: str, terms: Sequence[str]) -> str:
    return f"regexp_matches({column}, '\\b(?:{'|'.join(terms)})\\b')"


def hits(column: str, term: str) -> str:
    """Non-overlapping occurrences of a literal."""
    return f"CAST((length({column}) - length(replace({column}, {quoted(term)}, ''))) // {len(term)} AS BIGINT)"


def word_hits(column: str, term: str) -> str:
    return f"len(regexp_extract_all({column}, '\\b{term}\\b'))"


def values_table(name: str, columns: str, rows: Sequence[Sequence]) -> str:
    def cell(v) -> str:
        return quoted(v) if isinstance(v, str) else f"CAST({v} AS DOUBLE)"

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def long_flags(table: str, keep: str, column: str, dictionary: dict[str, Sequence[str]], name: str) -> str:
    """One row per (row, dictionary entry mentioned)."""
    return " UNION ALL ".join(
        f"SELECT {keep}, {quoted(entry)} AS {name} FROM {table} WHERE {has_any(column, terms)}"
        for entry, terms in dictionary.items()
    )


def normalized(column: str) -> str:
    lowered = f"lower(coalesce({column}, ''))"
    unlinked = rf"regexp_replace({lowered}, 'http\S+|www\S+', '', 'g')"
    letters = rf"regexp_replace({unlinked}, '[^a-z\s]', ' ', 'g')"
    return rf"trim(regexp_replace({letters}, '\s+', ' ', 'g'))"


def utc(column: str) -> str:
    return f"(to_timestamp({column}) AT TIME ZONE 'UTC')"


def key_fraction(key: str, seed: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"
