"""The interactive map: colours, tooltips, layers and a page that holds them."""

from __future__ import annotations

import base64
import gzip
import html
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmesh import rules
from voltmesh.functions import geometry as G
from voltmesh.operators import shapes
from voltmesh.plans import search
from voltmesh.sources import sinks


def line_color(kv: Column) -> Column:
    """The palette's colour of a voltage in kV; raises where no band holds it."""
    out = F.raise_error(F.concat(F.lit("no colour for voltage "), F.coalesce(kv.cast("string"), F.lit("null"))))
    for low, high, color in reversed(rules.PALETTE):
        out = F.when((kv >= low) & (F.lit(True) if high is None else kv <= high), F.lit(color)).otherwise(out)
    return out


def rgba(color: Column, alpha: int = 150) -> Column:
    """A #rrggbb colour as four numbers."""
    part = lambda i: F.conv(F.substring(color, i, 2), 16, 10).cast("int")
    return F.array(part(2), part(4), part(6), F.lit(alpha))


def escaped(value: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        value = F.replace(value, F.lit(plain), F.lit(safe))
    return value


def linked(value: Column) -> Column:
    """References to ways and relations as links."""
    return F.regexp_replace(value, r"(?<![a-zA-Z])((?:way|relation)/\d+)", '<a href="https://www.openstreetmap.org/$1" target="_blank">$1</a>')


def tooltip(df: DataFrame, geometry: str = "geometry") -> Column:
    """A table of a row's columns without its geometry; null shows as empty, lists are joined, osm_ids become links."""
    rows = []
    for field in df.schema:
        if field.name == geometry:
            continue
        kind = field.dataType.simpleString()
        text = F.array_join(F.col(field.name).cast("array<string>"), ", ") if kind.startswith("array") else F.col(field.name).cast("string")
        text = escaped(F.coalesce(text, F.lit("")))
        rows.append(F.concat(F.lit(f"<tr><th>{html.escape(field.name)}</th><td>"), linked(text) if field.name == "osm_ids" else text, F.lit("</td></tr>")))
    return F.concat(F.lit("<table>"), *rows, F.lit("</table>"))


def path_layer(lines: DataFrame, decimals: int = 5, tolerance_m: float | None = 30.0) -> DataFrame:
    """Lines as (properties, path, color, width): simplified in metres and rounded."""
    g = shapes.simplified_m("geometry", F.lit(tolerance_m)) if tolerance_m else F.col("geometry")
    rows = lines.withColumn("tooltip", tooltip(lines)).withColumn("path", G.rounded(g, decimals))
    return rows.withColumn("color", rgba(line_color(F.col("voltage_kv")))).drop("geometry")


def polygon_layer(polygons: DataFrame, decimals: int = 5, tolerance_m: float | None = 100.0) -> DataFrame:
    """A row for each outline of each polygon."""
    rows = polygons.withColumn("tooltip", tooltip(polygons)).select("*", F.explode("geometry").alias("ring")).drop("geometry")
    g = shapes.simplified_m("ring", F.lit(tolerance_m)) if tolerance_m else F.col("ring")
    return rows.withColumn("polygon", G.rounded(g, decimals)).drop("ring")


def centre(*layers: DataFrame) -> DataFrame:
    """(lon, lat): the mean of all points of geometry columns."""
    kinds = {G.POINT: lambda g: F.array(g), G.LINE: lambda g: g, G.POLYGON: F.flatten}
    points = [x.select(F.explode(kinds[x.schema["geometry"].dataType.simpleString()](F.col("geometry"))).alias("p")) for x in layers]
    whole = points[0]
    for p in points[1:]:
        whole = whole.unionByName(p)
    return whole.agg(F.avg("p.lon").alias("lon"), F.avg("p.lat").alias("lat"))


def circuit_layer(lines: DataFrame, decimals: int = 5) -> DataFrame:
    """A row for each circuit of each line, its path beside those of the others."""
    rows = shapes.pathway_offsets(search.circuit_rows(lines.withColumn("tooltip", tooltip(lines))))
    rows = rows.withColumn("path", G.rounded(F.col("offset_path"), decimals)).drop("offset_path", "geometry")
    return rows.withColumn("color", rgba(line_color(F.col("voltage_kv"))))


_PAGE = """<!doctype html><html><head><meta charset="utf-8"><title>Network</title>
<style>body{margin:0;font-family:sans-serif}svg{width:100vw;height:90vh}path{fill:none;vector-effect:non-scaling-stroke}path.area{fill:rgba(90,90,90,.35);stroke:#555}input#q{width:30em}#tip{position:fixed;background:#fff;border:1px solid #999;font-size:.8em}</style></head>
<body><input id="q" placeholder="terms with &amp; | ( )"> <span id="kv"></span> <span id="layers"></span> <span id="n"></span><svg id="m"></svg><div id="tip" hidden></div>
<script id="data" type="text/plain">DATA</script>
<script>
(async () => {
  const raw = Uint8Array.from(atob(document.getElementById("data").textContent), c => c.charCodeAt(0));
  const data = JSON.parse(await new Response(new Blob([raw]).stream().pipeThrough(new DecompressionStream("gzip"))).text());
  const by = id => document.getElementById(id), svg = by("m"), keys = data.voltage_keys, shape = r => r.polygon || r.path;
  for (const rows of Object.values(data.layers)) for (const r of rows)
    r.texts = Object.entries(r).filter(([k]) => !data.hidden.includes(k)).map(([, v]) => String(v).toLowerCase());

  const parse = query => {  // a query as a test of rows: & binds tighter than |, what dangles is passed over
    const todo = query.split(/([()&|])/).map(x => x.trim()).filter(x => x).reverse(), next = () => todo[todo.length - 1];
    const joined = (parts, how) => { const all = parts.filter(x => x); return all.length < 2 ? all[0] : r => all[how](t => t(r)); };
    const either = () => { const parts = [both()]; while (next() === "|") { todo.pop(); parts.push(both()); } return joined(parts, "some"); };
    const both = () => { const parts = [one()]; while (todo.length && next() !== "|" && next() !== ")") { if (next() === "&") todo.pop(); parts.push(one()); } return joined(parts, "every"); };
    const one = () => {
      if (!todo.length || ["&", "|", ")"].includes(next())) return;
      const token = todo.pop();
      if (token !== "(") { const word = token.toLowerCase(); return r => r.texts.some(x => x.includes(word)); }
      const inner = either();
      if (next() === ")") todo.pop();
      return inner;
    };
    const parts = [];
    while (todo.length) { parts.push(either()); if (next() === ")") todo.pop(); }
    return joined(parts, "every") || (() => true);
  };

  const box = (kind, id, label, on) => { const e = document.createElement("label"); e.innerHTML = "<input type=checkbox>"; e.append(label); e.firstChild.checked = on; e.firstChild.value = label; e.firstChild.onchange = () => draw(); by(kind).append(e); };
  const all = Object.values(data.layers).flat(), kvs = [...new Set(all.flatMap(r => keys.map(k => r[k]).filter(x => x != null)))].sort((a, b) => b - a);
  kvs.forEach(v => box("kv", v, v, false));
  Object.keys(data.layers).filter(x => x !== "circuits").forEach(x => box("layers", x, x, true));
  const chosen = kind => [...by(kind).querySelectorAll("input:checked")].map(e => e.value);
  const points = all.flatMap(shape), edge = (f, pick) => points.reduce((m, p) => f(m, pick(p)), f === Math.min ? Infinity : -Infinity);
  let view = points.length ? [edge(Math.min, p => p.lon), edge(Math.min, p => -p.lat), 0, 0] : [0, 0, 1, 1];
  if (points.length) { view[2] = edge(Math.max, p => p.lon) - view[0] || 1; view[3] = edge(Math.max, p => -p.lat) - view[1] || 1; }

  const draw = () => {
    const test = parse(by("q").value), wanted = chosen("kv").map(Number), layers = chosen("layers"), near = Math.log2(360 / view[2]) >= data.circuit_zoom;
    const kept = r => { const own = keys.map(k => r[k]).filter(x => x != null); return test(r) && (!wanted.length || !own.length || own.some(x => wanted.includes(x))); };
    svg.innerHTML = ""; svg.setAttribute("viewBox", view.join(" ")); let n = 0;
    for (const layer of layers) for (const r of data.layers[layer === "lines" && near ? "circuits" : layer]) if (kept(r)) {
      const e = document.createElementNS("http://www.w3.org/2000/svg", "path"); n++;
      e.setAttribute("d", "M" + shape(r).map(p => p.lon + " " + -p.lat).join("L") + (r.polygon ? "Z" : ""));
      if (r.color) e.setAttribute("stroke", "rgba(" + r.color.slice(0, 3) + ",.7)"); else e.setAttribute("class", "area");
      e.onmousemove = m => { const t = by("tip"); t.innerHTML = r.tooltip; t.hidden = false; t.style.left = m.clientX + 9 + "px"; t.style.top = m.clientY + 9 + "px"; };
      e.onmouseleave = () => { by("tip").hidden = true; };
      svg.append(e);
    }
    by("n").textContent = n + " shapes";
  };
  svg.onwheel = w => { w.preventDefault(); const f = w.deltaY > 0 ? 1.25 : 0.8, b = svg.getBoundingClientRect(), x = (w.clientX - b.left) / b.width, y = (w.clientY - b.top) / b.height;
    view = [view[0] + view[2] * x * (1 - f), view[1] + view[3] * y * (1 - f), view[2] * f, view[3] * f]; draw(); };
  by("q").oninput = draw; draw();
})();
</script></body></html>"""

#: Zoom from which each circuit of a line is drawn by itself.
CIRCUIT_ZOOM = 11.5


def write_map(network: dict[str, DataFrame], path: str, decimals: int = 5, tolerance_m: float | None = 30.0, circuit_zoom: float = CIRCUIT_ZOOM, most: int = 200_000) -> int:
    """A page with the lines, circuits, stations and substations of a network, its data compressed inside; returns its size.

    The page searches and filters by voltage as search.searched() and search.with_voltage() do. Layers of more than
    most rows are refused: a browser could not hold them.
    """
    layers = {"stations": polygon_layer(network["stations_polygon"], decimals), "buses": polygon_layer(network["buses_polygon"], decimals, 5.0), "lines": path_layer(network["lines"], decimals, tolerance_m), "circuits": circuit_layer(network["lines"], decimals)}
    rows = {name: [json.loads(r[0]) for r in sinks.held(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})), most).collect()] for name, df in layers.items()}
    whole = {"layers": rows, "circuit_zoom": circuit_zoom, "hidden": [*search.HIDDEN, "texts"], "voltage_keys": search.VOLTAGE_KEYS}
    data = base64.b64encode(gzip.compress(json.dumps(whole).encode())).decode()
    return Path(path).write_text(_PAGE.replace("DATA", data, 1), encoding="utf-8")


def filtered_layers(layers: dict[str, DataFrame], query: str, kv: list[int]) -> dict[str, DataFrame]:
    """All layers under one search and one choice of voltages."""
    parsed = search.parse(query)
    out = {}
    for name, df in layers.items():
        columns = [F.col(c) for c in df.columns if c not in search.HIDDEN]
        out[name] = search.with_voltage(df.where(search.compiled(parsed, columns)), kv)
    return out
