"""Settings: closed models with defaults, regional overrides, and their files."""

from __future__ import annotations

import contextlib
import functools
import json
import re
import unicodedata
from collections.abc import Iterator, Mapping
from datetime import date, datetime
from importlib import resources
from pathlib import Path
from typing import Any, Literal

import yaml
from pydantic import BaseModel, ConfigDict, Field, field_validator

from voltmesh import rules

#: Codes in use that ISO 3166 does not list, with their names.
MORE_COUNTRIES = {"XK": "Kosovo"}


@functools.cache
def countries() -> dict[str, str]:
    """Code of each country by its code and by its name, both in lower case with dashes for all that is no letter.

    From the table of ISO 3166 codes and names that comes with the time zone data.
    """
    for text in _zone_tables():
        rows = [x.split("\t") for x in text.splitlines() if x and not x.startswith("#")]
        named = {code: name for code, name, *_ in rows} | MORE_COUNTRIES
        return {_plain(x): code for code, name in named.items() for x in (code, name, re.sub(r"\s*\(.*\)", "", name))}
    raise FileNotFoundError("no iso3166.tab: install tzdata")


def _zone_tables() -> Iterator[str]:
    with contextlib.suppress(ModuleNotFoundError, FileNotFoundError):
        yield (resources.files("tzdata") / "zoneinfo" / "iso3166.tab").read_text(encoding="utf-8")
    with contextlib.suppress(FileNotFoundError):
        yield Path("/usr/share/zoneinfo/iso3166.tab").read_text(encoding="utf-8")


def _plain(name: str) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^a-z]+", "-", bare).strip("-")


def country_code(name: str) -> str:
    """The code of a country given by code or name; raises ValueError for others."""
    code = countries().get(_plain(name))
    if code is None:
        raise ValueError(f"no such country: {name!r}")
    return code


class Settings(BaseModel, Mapping):
    """A closed model, unknown keys being errors, that reads as a mapping of its fields too."""

    model_config = ConfigDict(extra="forbid")

    def __getitem__(self, key: str) -> Any:
        if key not in type(self).model_fields:
            raise KeyError(key)
        return self.__dict__[key]

    def __iter__(self) -> Iterator[str]:
        return iter(type(self).model_fields)

    def __len__(self) -> int:
        return len(type(self).model_fields)


class UserAgent(Settings):
    project_name: str = "voltmesh"
    email: str = ""
    website: str = ""


class OverpassApi(Settings):
    url: str = "https://overpass-api.de/api/interpreter"
    max_tries: int = Field(5, ge=1)
    timeout: int = Field(600, gt=0)
    user_agent: UserAgent = UserAgent()


class Retrieve(Settings):
    source: Literal["geofabrik", "overpass"] = "geofabrik"
    force_redownload: bool = False
    target_date: datetime | None = None
    overpass_api: OverpassApi = OverpassApi()


class Frequency(Settings):
    AC: float = Field(50.0, gt=0)
    DC: float = Field(0.0, ge=0)


class Network(Settings):
    include_relations: bool = True
    minimum_voltage_kv: float = Field(220.0, gt=0)
    frequency_hz: Frequency = Frequency()
    station_merge_radius_m: float = Field(500.0, gt=0)
    remove_under_construction: bool = True
    remove_after: date | None = date(2026, 12, 31)


class Simplify(Settings):
    enable: bool = True
    stations_m: float = Field(100.0, ge=0)
    buses_polygon_m: float = Field(5.0, ge=0)
    lines_m: float = Field(30.0, ge=0)


class InteractiveMap(Settings):
    coordinate_decimals: int = Field(5, ge=0)
    simplify_geometries: Simplify = Simplify()


class RegionalFrequency(Settings):
    AC: float | None = Field(None, gt=0)
    DC: float | None = Field(None, ge=0)


class RegionalNetwork(Settings):
    minimum_voltage_kv: float | None = Field(None, gt=0)
    frequency_hz: RegionalFrequency | None = None


class Crs(Settings):
    """Coordinates are degrees, and distances those of the European equal-area projection; others are refused."""

    geo: Literal["EPSG:4326"] = "EPSG:4326"
    distance: Literal["EPSG:3035"] = "EPSG:3035"


class Config(Settings):
    countries: list[str] = Field(["BE"], min_length=1)
    retrieve: Retrieve = Retrieve()
    network: Network = Network()
    interactive_map: InteractiveMap = InteractiveMap()
    regions: dict[str, RegionalNetwork] = {}
    crs: Crs = Crs()

    @field_validator("countries")
    @classmethod
    def known(cls, names: list[str]) -> list[str]:
        for name in names:
            country_code(name)
        return names


def validated(config: dict[str, Any]) -> Config:
    """The settings of a nested dict; raises pydantic's ValidationError for what doesn't fit."""
    return Config.model_validate(config)


def merged(under: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """Nested dicts together; where both have a value, over wins."""
    out = dict(under)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def with_regions(config: dict[str, Any], folder: str | Path) -> dict[str, Any]:
    """config with the settings in folder/config.CODE.yaml of its own countries; config's regions win."""
    found: dict[str, Any] = {}
    for name in config.get("countries", ["BE"]):
        code = country_code(name)
        path = Path(folder) / f"config.{code}.yaml"
        if path.exists():
            found[code] = (yaml.safe_load(path.read_text()) or {}).get("network") or {}
    return {**config, "regions": merged(found, config.get("regions") or {})}


def shipped_regions() -> dict[str, RegionalNetwork]:
    """The regional settings that come with the library."""
    return {
        code: RegionalNetwork(minimum_voltage_kv=kv, frequency_hz=RegionalFrequency(AC=hz) if hz else None)
        for code, (kv, hz) in rules.REGIONS.items()
    }


def minimum_volts(config: Config) -> tuple[int, dict[str, float]]:
    """The general minimum in volts, and that of each region that has its own."""
    own = {k: v.minimum_voltage_kv * 1000 for k, v in config.regions.items() if v.minimum_voltage_kv is not None}
    return int(config.network.minimum_voltage_kv * 1000), own


def ac_hz(config: Config) -> tuple[float, dict[str, float]]:
    """The general AC frequency, and that of each region that has its own."""
    own = {k: v.frequency_hz.AC for k, v in config.regions.items() if v.frequency_hz is not None and v.frequency_hz.AC is not None}
    return config.network.frequency_hz.AC, own


def write_defaults(path: str | Path) -> dict[str, Any]:
    """Writes and returns the default settings as YAML."""
    data = json.loads(Config().model_dump_json())
    Path(path).write_text(yaml.safe_dump(data, sort_keys=False))
    return data


def write_schema(path: str | Path) -> dict[str, Any]:
    """Writes and returns the JSON schema with references inlined and without titles."""
    raw = Config.model_json_schema()
    shared = raw.pop("$defs", {})

    def plain(node: Any) -> Any:
        if isinstance(node, list):
            return [plain(x) for x in node]
        if not isinstance(node, dict):
            return node
        if "$ref" in node:
            target = plain(shared[node["$ref"].rpartition("/")[2]])
            return {**target, **{k: plain(v) for k, v in node.items() if k != "$ref"}}
        return {k: plain(v) for k, v in node.items() if not (k == "title" and isinstance(v, str))}

    data = plain(raw)
    Path(path).write_text(json.dumps(data, indent=2))
    return data
