"""The grammar of identifiers: way/1, way/1-2, way/1-220, way/1:b-220, virtual_way/1:0-220, merged_way/1+2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base(col: Column) -> Column:
    """An identifier without what follows its first dash."""
    return F.substring_index(col, "-", 1)


def osm_id(col: Column) -> Column:
    """The first way or relation inside an identifier; empty if there is none."""
    return F.regexp_extract(col, r"((?:way|relation)/\d+)", 1)


def number(col: Column) -> Column:
    """The number of the first typed id inside an identifier; null if there is none."""
    return F.regexp_extract(col, r"/(\d+)", 1).try_cast("bigint")


def with_kv(col: Column, volts: Column) -> Column:
    """An identifier with its voltage in kV."""
    return F.concat(col, F.lit("-"), F.floor(volts / 1000).cast("string"))


def without_kv(col: Column) -> Column:
    """An identifier without what follows its last dash."""
    return F.regexp_extract(col, r"^(.*)-[^-]*$", 1)


def kv_of(col: Column) -> Column:
    return F.regexp_extract(col, r"-([^-]*)$", 1)


def letters(index: Column) -> Column:
    """0 is a, 25 is z, 26 is aa: one or two letters."""
    letter = lambda n: F.chr(n + 97)
    return F.when(index < 26, letter(index)).otherwise(F.concat(letter((F.floor(index / 26) - 1).cast("int")), letter(index % 26)))


def osm_ids(contains: Column) -> Column:
    """The distinct base identifiers of a list, sorted and joined with ;."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(contains, base))), ";")
