"""Splitting lists of voltages, inferring circuits, and joining rows that describe one feature.

Rows are ordered by a column _row that is unique, so that every "first" is a fixed one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmesh.functions import ids, tags
from voltmesh.operators import graph


#: Combinations of tag values that are cleaned by themselves and broadcast: about 30 MB.
MOST_VALUES = 200_000

CLEANERS = {"voltage": tags.clean_voltage, "circuits": tags.clean_circuits, "cables": tags.clean_cables, "frequency": tags.clean_frequency}


def cleaned_tags(df: DataFrame, names: tuple[str, ...] = tuple(CLEANERS), most: int = MOST_VALUES) -> DataFrame:
    """df with the named tags cleaned. Features repeat a few combinations of values; each is cleaned once and joined back.

    Beyond most combinations every row is cleaned by itself. df is read twice, so it should be stored.
    """
    clean = {n: CLEANERS[n](F.col(n)) for n in names}
    # Settled, or the optimizer would move later filters on clean values, and with them the cleaning, to all rows again.
    found = graph.settled(df.select(*names).distinct().limit(most + 1))
    if found.count() > most:
        return df.withColumns(clean)
    table = graph.settled(found.select(*(F.col(n).alias(f"_raw_{n}") for n in names), *(c.alias(f"_clean_{n}") for n, c in clean.items())))
    same = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"_raw_{n}")) for n in names))
    return df.join(F.broadcast(table), same).select(*(F.col(f"_clean_{c}").alias(c) if c in names else F.col(f"`{c}`") for c in df.columns))


def exploded_voltages(df: DataFrame, key: str = "id") -> DataFrame:
    """A row for each part of the ;-list voltage: adds pos, n_parts (rows that share the key), and suffixes -1 to -n where there are several.

    Rows that share a key are numbered on in the order of _row.
    """
    rows = df.select("*", F.posexplode(F.split("voltage", ";")).alias("pos", "part")).drop("voltage").withColumnRenamed("part", "voltage")
    same = Window.partitionBy(key)
    rows = rows.withColumn("n_parts", F.count("*").over(same)).withColumn("nth", F.row_number().over(same.orderBy("_row", "pos")))
    name = F.when(F.col("n_parts") > 1, F.concat(key, F.lit("-"), F.col("nth").cast("string"))).otherwise(F.col(key).cast("string"))
    return rows.withColumn(key, name)


def unique_voltages(df: DataFrame, key: str = "id") -> DataFrame:
    """exploded_voltages() for a key that is unique already, which needs no shuffle."""
    parts = F.split("voltage", ";")
    rows = df.withColumn("n_parts", F.size(parts)).select("*", F.posexplode(parts).alias("pos", "part")).drop("voltage").withColumnRenamed("part", "voltage")
    name = F.when(F.col("n_parts") > 1, F.concat(key, F.lit("-"), (F.col("pos") + 1).cast("string"))).otherwise(F.col(key).cast("string"))
    return rows.withColumn("nth", F.col("pos") + 1).withColumn(key, name)


def is_volts(volts: int) -> Column:
    """Whether a single voltage is a plain number of at least volts."""
    return tags.voltage_at_least(F.col("voltage"), volts)


def inferred_circuits(df: DataFrame, dc_hz: str, ac_hz: Column) -> DataFrame:
    """circuits and frequency of the rows of exploded_voltages() by the first of eight rules that fits.

    Reads voltage parts, cables, circuits, frequency, n_parts and nth. A part that is no number counts as 1.
    """
    cables, circuits, frequency, n, nth = (F.col(x) for x in ("cables", "circuits", "frequency", "n_parts", "nth"))
    ac = frequency != dc_hz
    known = frequency.isin(dc_hz) | (frequency == ac_hz)
    one = lambda c: ~F.contains(c, F.lit(";"))
    number = lambda c: F.coalesce(c.try_cast("bigint"), F.lit(1))
    text = lambda c: F.greatest(F.lit(1), c).cast("string")
    part = lambda c: F.get(F.split(c, ";"), (nth - 1).cast("int"))
    length = lambda c: F.size(F.split(c, ";"))
    given_cables, given_circuits = ~cables.isin("", "0"), ~circuits.isin("", "0")
    by_type = F.when(ac, ac_hz).otherwise(F.lit(dc_hz))
    spread = F.floor(F.when(circuits != "", number(circuits)).otherwise(number(cables) / 3) / n)
    rules = [
        ((cables == "") & (circuits == ""), F.lit("1"), F.when(known, frequency).otherwise(ac_hz)),
        (given_cables & one(cables) & (n == 1) & (circuits == "") & ac, text(F.floor(number(cables) / 3)), ac_hz),
        (given_cables & one(cables) & (n == 1) & (circuits == "") & ~ac, text(F.floor(number(cables) / 2)), F.lit(dc_hz)),
        (given_circuits & one(circuits) & (n == 1), circuits, by_type),
        ((n > 1) & one(circuits) & one(cables), text(spread), by_type),
        (~one(circuits) & (length(circuits) == n), number(part(circuits)).cast("string"), by_type),
        (~one(cables) & (length(cables) == n), text(F.floor(number(part(cables)) / 3)), by_type),
    ]
    new_circuits, new_frequency = F.lit("1"), by_type
    for test, c, f in reversed(rules):
        new_circuits, new_frequency = F.when(test, c).otherwise(new_circuits), F.when(test, f).otherwise(new_frequency)
    return df.withColumns({"circuits": new_circuits, "frequency": new_frequency})


def substation_frequencies(df: DataFrame, dc_hz: str, ac_hz: Column) -> DataFrame:
    """Rows of exploded voltages with one frequency each: the matching part of a list as long as the voltages', else all parts; unknown ones become ac_hz."""
    parts = F.split("frequency", ";")
    matched = F.when(F.size(parts) == F.col("n_parts"), F.array(F.get(parts, (F.col("nth") - 1).cast("int")))).otherwise(parts)
    rows = df.withColumn("_n", F.size(matched)).select("*", F.posexplode(matched).alias("fpos", "_f")).drop("frequency")
    rows = rows.withColumn("id", F.when(F.col("_n") > 1, F.concat("id", F.lit("-"), (F.col("fpos") + 1).cast("string"))).otherwise(F.col("id")))
    valid = (F.col("_f") == dc_hz) | (F.col("_f") == ac_hz)
    return rows.withColumn("frequency", F.when(valid, F.col("_f")).otherwise(ac_hz)).drop("_f", "_n")


def first_known(column: str, order: str = "_row") -> Column:
    """The first value in order that is not null."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def without_duplicates(df: DataFrame, key: str = "id") -> DataFrame:
    """One row for each key: the first by _row, with the countries of all joined by ; in order. Rows with a null key go."""
    rest = [c for c in df.columns if c not in (key, "country", "_row")]
    seen = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(F.struct(*rest), "_row").alias("_first"),
        F.array_sort(F.collect_list(F.struct("_row", "country"))).alias("_all"),
        F.min("_row").alias("_row"),
    )
    country = F.array_join(F.transform("_all", lambda x: x["country"]), ";")
    return seen.select(key, "_row", "_first.*", country.alias("country"))


def aggregated_substations(df: DataFrame) -> DataFrame:
    """One row for each base id, voltage and country with the first known value of each column, and the first id."""
    keys = ("base_id", "voltage", "country")
    rows = df.withColumn("base_id", ids.base(F.col("id"))).where("voltage is not null and country is not null")
    rest = [c for c in df.columns if c not in (*keys, "_row")]
    return rows.groupBy(*keys).agg(*(first_known(c).alias(c) for c in rest), F.min("_row").alias("_row"))


def aggregated_lines(df: DataFrame) -> DataFrame:
    """One row for each base id and voltage: circuits add up, other columns have their first known value."""
    rows = df.withColumn("base_id", ids.base(F.col("line_id"))).where("voltage is not null")
    rest = [c for c in df.columns if c not in ("voltage", "circuits", "_row")]
    return rows.groupBy("base_id", "voltage").agg(
        F.sum("circuits").cast("int").alias("circuits"), *(first_known(c).alias(c) for c in rest), F.min("_row").alias("_row")
    ).drop("base_id")


def merged_identical(df: DataFrame) -> DataFrame:
    """Lines of one voltage with the same geometry become the first of them with all their circuits; ids get their kV."""
    rest = [c for c in df.columns if c not in ("voltage", "circuits", "geometry", "_row")]
    same = df.groupBy("voltage", "geometry").agg(
        F.sum("circuits").cast("int").alias("circuits"), *(F.min_by(c, "_row").alias(c) for c in rest), F.min("_row").alias("_row")
    )
    return same.withColumn("line_id", ids.with_kv(F.col("line_id"), F.col("voltage")))


def in_service(df: DataFrame, remove_under_construction: bool, remove_after: str | None) -> DataFrame:
    """Without rows under construction, if so asked, and without those that start later than a date; unknown dates stay."""
    if remove_under_construction:
        df = df.where(~F.coalesce("under_construction", F.lit(False)))
    if remove_after is not None:
        df = df.where(F.col("start_date").isNull() | (F.col("start_date") <= F.lit(remove_after).cast("date")))
    return df
