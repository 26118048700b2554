"""Settings from the side of the schema: each bound, each type, each closed level."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pydantic import ValidationError

from voltmesh import config as C
from voltmesh.functions import tags


def nested(path, value):
    for key in reversed(path.split(".")):
        value = {key: value}
    return value


#: A value at the edge of what each numeric field takes, and one just beyond.
EDGES = {
    "network.minimum_voltage_kv": (0.001, 0),
    "network.station_merge_radius_m": (0.5, -0.5),
    "network.frequency_hz.DC": (0, -0.1),
    "interactive_map.coordinate_decimals": (0, -1),
    "interactive_map.simplify_geometries.lines_m": (0, -3),
    "interactive_map.simplify_geometries.buses_polygon_m": (0.0, -0.01),
    "retrieve.overpass_api.timeout": (1, -20),
    "retrieve.overpass_api.max_tries": (1, -4),
    "regions.PH.minimum_voltage_kv": (1, 0),
    "regions.PH.frequency_hz.AC": (60.5, 0),
}


@pytest.mark.parametrize("path", EDGES)
def test_bounds_of_numbers(path):
    inside, beyond = EDGES[path]
    found = C.validated(nested(path, inside))
    for key in path.split("."):
        found = found[key]
    assert found == inside
    for bad in (beyond, "many", None if not path.startswith("regions") else [1]):
        with pytest.raises(ValidationError):
            C.validated(nested(path, bad))


@pytest.mark.parametrize("level", ["", "network", "interactive_map", "interactive_map.simplify_geometries", "retrieve.overpass_api", "regions.MX", "network.frequency_hz"])
def test_every_level_is_closed(level):
    with pytest.raises(ValidationError):
        C.validated(nested(f"{level}.colour".strip("."), "blue"))


def test_values_of_other_kinds():
    for bad in (nested("network.include_relations", "both"), nested("network.remove_after", "next year"), nested("countries", "BE"), nested("crs.distance", "EPSG:25832"), nested("crs.geo", "EPSG:3857")):
        with pytest.raises(ValidationError):
            C.validated(bad)
    assert C.validated(nested("network.remove_after", None)).network.remove_after is None


@given(st.sampled_from([("de", "DE"), ("Germany", "DE"), ("czech-republic", "CZ"), ("South Africa", "ZA"), ("curaçao", "CW"), (" xk ", "XK"), ("cote-d-ivoire", "CI")]))
def test_countries_by_code_and_name(pair):
    given_, code = pair
    assert C.country_code(given_) == code and C.validated({"countries": [given_]}).countries == [given_]


def test_unknown_countries():
    for name in ("atlantis", "", "EU1"):
        with pytest.raises(ValueError):
            C.country_code(name)


def test_files_of_regions_fill_what_the_caller_leaves_open(tmp_path):
    for code, text in {"BR": "network:\n  minimum_voltage_kv: 60\n  frequency_hz:\n    AC: 60\n", "PH": "network:\n", "JP": "network:\n  minimum_voltage_kv: 66\n"}.items():
        (tmp_path / f"config.{code}.yaml").write_text(text)
    got = C.with_regions({"countries": ["brazil", "ph"], "regions": {"BR": {"minimum_voltage_kv": 88}, "MX": {"minimum_voltage_kv": 115}}}, tmp_path)
    assert got["regions"] == {"BR": {"minimum_voltage_kv": 88, "frequency_hz": {"AC": 60}}, "PH": {}, "MX": {"minimum_voltage_kv": 115}}
    config = C.validated(got)
    assert C.minimum_volts(config) == (220_000, {"BR": 88_000, "MX": 115_000}) and C.ac_hz(config) == (50.0, {"BR": 60.0})


def test_regions_without_a_frequency_take_the_general_one():
    config = C.validated({"network": {"frequency_hz": {"AC": 16.7}}, "regions": {"CH": {"frequency_hz": {"DC": 0}}, "AT": {"minimum_voltage_kv": 110}, "KR": {"frequency_hz": {"AC": 60}}}})
    general, own = C.ac_hz(config)
    assert (tags.hz(general), {k: tags.hz(v) for k, v in own.items()}) == ("16.7", {"KR": "60"}) and config.network.frequency_hz.DC == 0


def test_settings_read_as_mappings():
    net = C.Network(minimum_voltage_kv=110)
    assert "minimum_voltage_kv" in net and "colour" not in net and net.get("colour", 3) == 3
    assert dict(net)["frequency_hz"]["AC"] == 50.0 and len(net) == len(list(net.values())) == len(net.keys())
    with pytest.raises(KeyError):
        net["colour"]


def test_written_files(tmp_path):
    assert C.validated(C.write_defaults(tmp_path / "c.yaml")) == C.Config()
    text = str(C.write_schema(tmp_path / "s.json"))
    assert "$ref" not in text and "title" not in text


def test_messages_go_to_a_file(tmp_path):
    from voltmesh.plans import logs

    for _ in range(2):
        logs.configured("warning", tmp_path / "a" / "run.log").warning("three lines dropped")
    logs.configured().info("console")
    text = (tmp_path / "a" / "run.log").read_text()
    assert text.count("WARNING voltmesh: three lines dropped") == 2 and "console" not in text
