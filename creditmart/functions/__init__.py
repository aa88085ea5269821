"""Expression functions.

Each takes and returns Spark SQL expression text, for ``selectExpr``, ``where`` and
``expr``. Text composes freely and crosses to the JVM once per column, where a chain of
Column calls would cross once per literal. None of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def exprs(texts: Iterable[str]) -> list[Column]:
    """Columns for ``agg``, which unlike ``selectExpr`` takes no text."""
    return [F.expr(t) for t in texts]


def quote(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def in_list(expression: str, values: Iterable[str]) -> str:
    return f"{expression} IN ({', '.join(quote(v) for v in values)})"


def array_of(values: Iterable[str | None]) -> str:
    return f"array({', '.join('NULL' if v is None else quote(v) for v in values)})"


def lookup(mapping: dict[str, object], key: str) -> str:
    """Value of ``key`` in a literal map; a key not in it, or NULL, gives NULL."""
    pairs = (f"{quote(k)}, {quote(v) if isinstance(v, str) else f'{v}D'}" for k, v in mapping.items())
    return f"map({', '.join(pairs)})[{key}]"


def rows_of(*rows: dict[str, str]) -> str:
    """A generator turning one row into several: each mapping is name -> expression."""
    structs = (
        f"named_struct({', '.join(f'{quote(name)}, {text}' for name, text in row.items())})" for row in rows
    )
    return f"inline(array({', '.join(structs)}))"


def field_rows(fields: dict[str, str]) -> str:
    """Generator of ``(field, value)`` rows, one per entry."""
    return rows_of(*({"field": quote(name), "value": text} for name, text in fields.items()))
