"""The search language of the map: terms with & and |, parentheses, & binding tighter.

A query is parsed once, on the driver, and compiled to one boolean column expression.
Dangling operators and stray parentheses are tolerated; an empty query takes every row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLTAGE_KEYS = ("voltage_kv", "voltage_bus0_kv", "voltage_bus1_kv")
HIDDEN = ("geometry", "tooltip", "path", "polygon", "color")


@dataclass(frozen=True)
class Term:
    text: str


@dataclass(frozen=True)
class Both:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


def tokens(query: str) -> list[str]:
    """Operators, parentheses and trimmed terms between them."""
    return [t for t in (x.strip() for x in re.split(r"([()&|])", query)) if t]


def parse(query: str) -> Term | Both | Any:
    todo = tokens(query)[::-1]

    def either():
        parts = [both()]
        while todo and todo[-1] == "|":
            todo.pop()
            parts.append(both())
        parts = [p for p in parts if p is not None]
        return None if not parts else parts[0] if len(parts) == 1 else Any(tuple(parts))

    def both():
        parts = [one()]
        while todo and todo[-1] not in ("|", ")"):
            if todo[-1] == "&":
                todo.pop()
            parts.append(one())
        parts = [p for p in parts if p is not None]
        return None if not parts else parts[0] if len(parts) == 1 else Both(tuple(parts))

    def one():
        if not todo or todo[-1] in ("&", "|", ")"):
            return None
        token = todo.pop()
        if token != "(":
            return Term(token)
        inner = either()
        if todo and todo[-1] == ")":
            todo.pop()
        return inner

    found = []
    while todo:
        part = either()
        if part is not None:
            found.append(part)
        if todo and todo[-1] == ")":
            todo.pop()
    return Term("") if not found else found[0] if len(found) == 1 else Both(tuple(found))


def compiled(node: Term | Both | Any, columns: list[Column]) -> Column:
    """A parsed query as a test of rows: a term must occur in some column's text, in whatever case; null reads "null"."""
    if isinstance(node, Term):
        if not node.text:
            return F.lit(True)
        texts = [F.lower(F.coalesce(c.cast("string"), F.lit("null"))) for c in columns]
        return reduce(lambda a, b: a | b, (F.contains(t, F.lit(node.text.lower())) for t in texts), F.lit(False))
    parts = [compiled(p, columns) for p in node.parts]
    return reduce((lambda a, b: a & b) if isinstance(node, Both) else (lambda a, b: a | b), parts)


def searched(df: DataFrame, query: str, hidden: tuple[str, ...] = HIDDEN) -> DataFrame:
    return df.where(compiled(parse(query), [F.col(c) for c in df.columns if c not in hidden]))


def with_voltage(df: DataFrame, wanted: list[int]) -> DataFrame:
    """Rows with a wanted voltage in any voltage column; tables without such a column, and empty wishes, keep all rows."""
    keys = [c for c in VOLTAGE_KEYS if c in df.columns]
    if not keys or not wanted:
        return df
    none = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in keys))
    return df.where(none | reduce(lambda a, b: a | b, (F.coalesce(F.col(c).isin(*wanted), F.lit(False)) for c in keys)))


def voltages(*layers: DataFrame) -> DataFrame:
    """(voltage_kv): the distinct voltages of all layers, highest first."""
    found = [layer.select(F.col(c).cast("int").alias("voltage_kv")) for layer in layers for c in VOLTAGE_KEYS if c in layer.columns]
    return reduce(DataFrame.unionByName, found).where("voltage_kv is not null").distinct().orderBy(F.desc("voltage_kv"))


def circuit_rows(df: DataFrame) -> DataFrame:
    """A row for each circuit, at least one: circuit_index from 0, and circuit_count."""
    n = F.greatest(F.coalesce(F.col("circuits").cast("int"), F.lit(1)), F.lit(1))
    return df.select("*", n.alias("circuit_count"), F.explode(F.sequence(F.lit(0), n - 1)).alias("circuit_index"))
