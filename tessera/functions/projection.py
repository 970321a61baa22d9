"""Failing-row projection (P17) and literal helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ", "


def split_names(text: str | None) -> list[str]:
    """Split a comma-separated column list, trimming blanks (``a,b`` and ``a, b`` agree)."""
    if text is None:
        return []
    return [part.strip() for part in str(text).split(",") if part.strip()]


def joined_text(columns: list[Column | str]) -> Column:
    """Cast each part to string and join with ``", "``.

    A NULL part makes the whole value NULL, as SQL ``CONCAT`` does; the row is
    still reported (its PK or value is simply NULL).
    """
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(SEPARATOR))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    if not parts:
        return F.lit(None).cast("string")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A SQL string literal for any text, read the same under every parser setting.

    Text without backslashes or quotes is quoted as is; other text is given as
    its UTF-8 bytes in hex (``decode(unhex(...))``), which holds no character the
    parser could treat as an escape. Both forms are constant-folded.
    """
    if "\\" not in value and "'" not in value:
        return f"'{value}'"
    return f"decode(unhex('{value.encode('utf-8').hex()}'), 'UTF-8')"


def joined_text_sql(columns: list[str]) -> str:
    """SQL text of ``joined_text`` for plain column names."""
    parts = [f"CAST({quote_name(c)} AS STRING)" for c in columns]
    if not parts:
        return "CAST(NULL AS STRING)"
    if len(parts) == 1:
        return parts[0]
    return "concat(" + f", {sql_string(SEPARATOR)}, ".join(parts) + ")"


def label_text(names: list[str]) -> str:
    return SEPARATOR.join(names)


def ts_text(value: dt.datetime | dt.date) -> str:
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S") + (f".{value.microsecond:06d}" if value.microsecond else "")
    return value.strftime("%Y-%m-%d")


def ts_lit(value: dt.datetime | dt.date | str | None, ntz: bool = False) -> Column:
    """Timestamp literal built from text, so it means the same under any Python TZ.

    The session time zone is UTC (see ``session.ENGINE_CONF``).
    """
    target = "timestamp_ntz" if ntz else "timestamp"
    if value is None:
        return F.lit(None).cast(target)
    text = value if isinstance(value, str) else ts_text(value)
    return F.lit(text).cast(target)


def date_lit(value: dt.date | str) -> Column:
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d")
    return F.lit(text).cast("date")
