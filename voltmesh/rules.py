"""Tables whose entries decide results. Order matters within each list.

A step is ("lower",), ("exact", value, new) for a whole value, or ("replace", part, new) for
every occurrence of a literal part. Some steps cannot match after those before them; they stay.
"""

from __future__ import annotations

# Corrections of tags, in the order in which they apply.
VOLTAGE = [
    ("lower",),
    ("replace", "400/220/110 kV'", "400000;220000;110000"),
    ("replace", "400/220/110/20_kv", "400000;220000;110000;20000"),
    ("replace", "2x25000", "25000;25000"),
    ("replace", "é", ";"),
    ("replace", "kvv/", ""),
    ("replace", "11000l400", "11000"),
    ("replace", "(temp 150000)", ""),
    ("exact", "low", "1000"),
    ("exact", "minor", "1000"),
    ("exact", "medium", "33000"),
    ("exact", "med", "33000"),
    ("exact", "m", "33000"),
    ("exact", "high", "150000"),
    ("replace", "23000-109000", "109000"),
    ("replace", "380000>220000", "380000;220000"),
    ("replace", ":", ";"),
    ("replace", "<", ";"),
    ("replace", ",", ";"),
    ("replace", "kv", "000"),
    ("replace", "kva", "000"),
    ("replace", "/", ";"),
]
CIRCUITS = [
    ("replace", "partial", ""),
    ("replace", "1operator=RTE operator:wikidata=Q2178795", ""),
    ("lower",),
    ("replace", "1,5", "3"),
    ("replace", "1/3", "1"),
]
CABLES = [("lower",), ("replace", "1/3", "1"), ("replace", "3x2;2", "3")]
WIRES = [
    ("lower",),
    ("replace", "?", ""),
    ("replace", "trzyprzewodowe", "3"),
    ("replace", "pojedyńcze", "1"),
    ("replace", "single", "1"),
    ("replace", "double", "2"),
    ("replace", "triple", "3"),
    ("replace", "quad", "4"),
    ("replace", "fivefold", "5"),
    ("replace", "yes", "3"),
    ("replace", "1/3", "1"),
    ("replace", "3x2;2", "3"),
    ("replace", "_", ""),
]
FREQUENCY = [
    ("lower",),
    ("replace", "16.67", "16.7"),
    ("replace", "16,7", "16.7"),
    ("replace", "?", ""),
    ("replace", "hz", ""),
    ("replace", " ", ""),
]
DATE = [
    ("lower",),
    ("replace", "unknown", ""),
    ("replace", "approx", ""),
    ("replace", "c.", ""),
    ("replace", "circa", ""),
    ("replace", "about", ""),
    ("replace", "?", ""),
]

# Colours of lines by voltage in kV, both bounds inclusive.
PALETTE = [
    (0, 150, "#ffff00"),
    (151, 240, "#00fa00"),
    (241, 330, "#ffa500"),
    (331, 420, "#ff2800"),
    (421, None, "#ff00ff"),
]

# Shipped regional settings, (minimum kV, AC Hz).
REGIONS = {
    "BE": (None, None),
    "BR": (60.0, 60.0),
    "MX": (100.0, 60.0),
    "NL": (None, None),
    "PH": (120.0, 60.0),
    "US": (100.0, 60.0),
}

# Tags kept from raw elements.
LINE_TAGS = ("power", "cables", "circuits", "frequency", "voltage", "wires", "construction", "construction:power", "start_date")
SUBSTATION_TAGS = ("power", "substation", "voltage", "frequency", "construction", "construction:power", "start_date")
RELATION_TAGS = ("power", "circuits", "cables", "frequency", "voltage", "construction", "construction:power", "start_date")
FEATURES = ("line", "cable", "substation")
IGNORED_ROLES = ("", "incoming_line", "substation", "inner")
