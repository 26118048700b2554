"""Free-text tags to clean values, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltmesh import rules


def as_text(col: Column) -> Column:
    """Strings; null becomes empty, so cleaned tags are never null."""
    return F.coalesce(col.cast("string"), F.lit(""))


def _quoted(text: str) -> str:
    """A replacement that stands for itself."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def corrected(col: Column, steps: list[tuple]) -> Column:
    """Applies the steps of a rule list in order. Each step names the value before it once, so that the plan grows with the number of steps."""

    def apply(value: Column, step: tuple) -> Column:
        if step[0] == "lower":
            return F.lower(value)
        if step[0] == "exact":
            return F.regexp_replace(value, rf"\A\Q{step[1]}\E\z", _quoted(step[2]))
        return F.replace(value, F.lit(step[1]), F.lit(step[2]))

    return reduce(apply, steps, as_text(col))


def _only(col: Column, steps: list[tuple], kept: str) -> Column:
    return F.regexp_replace(corrected(col, steps), f"[^{kept}]", "")


def clean_voltage(col: Column) -> Column:
    return _only(col, rules.VOLTAGE, "0-9;")


def clean_circuits(col: Column) -> Column:
    return _only(col, rules.CIRCUITS, "0-9;")


def clean_cables(col: Column) -> Column:
    return _only(col, rules.CABLES, "0-9;")


def clean_wires(col: Column) -> Column:
    return _only(col, rules.WIRES, "0-9;")


def clean_frequency(col: Column) -> Column:
    return _only(col, rules.FREQUENCY, "0-9;.")


def clean_date(col: Column) -> Column:
    """A date from whatever of year, month and day a tag gives; null where it gives none."""
    text = F.regexp_replace(F.trim(corrected(col, rules.DATE)), "[^0-9-]", "")

    def built(pattern: str, year: int, month: int, day: int) -> Column:
        part = lambda k: F.regexp_extract(text, pattern, k) if k else F.lit("1")
        joined = F.concat_ws("-", F.lpad(part(year), 4, "0"), F.lpad(part(month), 2, "0"), F.lpad(part(day), 2, "0"))
        return F.when(text.rlike(pattern) & (part(year) != "0000"), F.try_to_date(joined, "yyyy-MM-dd"))

    return F.coalesce(
        built(r"^(\d{4})-?$", 1, 0, 0),
        built(r"^(\d{4})-(\d{1,2})$", 1, 2, 0),
        built(r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3),
        built(r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3),
        built(r"^(\d{1,2})-(\d{4})$", 2, 1, 0),
        built(r"^(\d{1,2})-(\d{1,2})-(\d{4})$", 3, 1, 2),  # month first where both readings are dates
        built(r"^(\d{1,2})-(\d{1,2})-(\d{4})$", 3, 2, 1),
    )


def hz(value: float) -> str:
    """A frequency as tags write it: 50.0 is "50", 16.7 is "16.7"."""
    return f"{value:g}"


def under_construction(power: Column, construction: Column, construction_power: Column, features: tuple[str, ...]) -> Column:
    """Whether a feature is tagged as being built, in any of the usual ways."""
    power, construction, construction_power = as_text(power), as_text(construction), as_text(construction_power)
    return (power == "construction") | construction.isin(*features) | construction_power.isin(*features)


def feature_of(power: Column, construction: Column, construction_power: Column) -> Column:
    """line, cable or substation, the first that the tags name; null if they name none."""
    tests = [(f, (power == f) | (construction_power == f) | ((power == "construction") & (construction == f))) for f in rules.FEATURES]
    return F.coalesce(*(F.when(F.coalesce(test, F.lit(False)), F.lit(f)) for f, test in tests))


def is_route(power: Column, route: Column, construction_power: Column) -> Column:
    """A relation that groups the ways of a circuit."""
    yes = F.lit(False)
    return F.coalesce(route == "power", yes) | F.coalesce(power.isin("circuit", "construction"), yes) | F.coalesce(construction_power.isin("line", "cable"), yes)


def is_substation_relation(power: Column, construction: Column, construction_power: Column) -> Column:
    """A relation that is a substation, standing or being built, whatever else its tags name."""
    tests = (power == "substation", construction_power == "substation", (power == "construction") & (construction == "substation"))
    return reduce(lambda x, y: x | y, (F.coalesce(test, F.lit(False)) for test in tests))


def voltage_at_least(voltage: Column, volts: int) -> Column:
    """Whether any part of a ;-list is a plain number of up to nine digits, without leading zeros, of at least volts."""
    return F.exists(F.split(voltage, ";"), lambda x: x.rlike("^(0|[1-9][0-9]{0,8})$") & (x.try_cast("int") >= volts))


def by_region(country: Column, values: dict[str, float | str], default) -> Column:
    """The value of a row's country, else the default; countries joined with ; match no region."""
    out = F.lit(default)
    for region, value in values.items():
        out = F.when(country == region, F.lit(value)).otherwise(out)
    return out
