"""DuckDB SQL twins of the registered queries, written by other methods where possible.

Occupancy cuts edges by parameter and joins the cuts, hulls test every directed
edge against every point, and rasters pair crossings by parity.
"""

from __future__ import annotations

from ecoledger.catalog.derive import COUNTRY, PROJECT, SHAPES
from ecoledger.catalog.queries import (
    CHOSEN_CLASS, COUNTRY_CONFIG, ECOSYSTEM_COLUMNS, OVERLAP_METRES, RASTER_METRES,
)
from ecoledger.functions.projection import _E, _E2, SEMI_MAJOR
from ecoledger.operators.criteria import CATEGORIES, CRITERIA, THRESHOLDS

_SQL: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_SQL)


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# --- shared pieces -----------------------------------------------------------


def _natural(code: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all(lower({code}), '[0-9]+|[^0-9]+'),
      lambda t: CASE WHEN regexp_matches(t, '^[0-9]+$') THEN chr(1) ||
        lpad(CAST(greatest(length(ltrim(t, '0')), 1) AS VARCHAR), 4, '0') ||
        CASE WHEN ltrim(t, '0') = '' THEN '0' ELSE ltrim(t, '0') END ELSE t END), '')"""


PARTS = """parts AS (SELECT p_partkey AS ord, p_brand AS code,
  CASE WHEN p_partkey % 5 <> 0 THEN p_type || ' ' || p_name END AS name,
  CASE WHEN p_size % 3 <> 0 THEN 'G' || (p_size % 7) END AS fg FROM part)"""

FIRSTS = """firsts AS (SELECT code, name, fg FROM (SELECT *, row_number() OVER
  (PARTITION BY code ORDER BY ord) AS rn FROM parts) WHERE rn = 1)"""

INDEX = f"""class_index AS (SELECT CAST(row_number() OVER (ORDER BY {_natural('code')}, code) AS INTEGER)
  AS idx, code, coalesce(name, code) AS name FROM firsts)"""

MAP_INDEX = f"""map_index AS (SELECT CAST(row_number() OVER (ORDER BY {_natural('code')}, code) AS INTEGER)
  AS idx, code, name FROM (SELECT 'N' || c_nationkey AS code, min(n_name) AS name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1))"""


CUSTOMER_SHAPES = "SELECT c_custkey AS k, 'N' || c_nationkey AS code, c_custkey AS slot FROM customer"


def _corners(stretch: float = 1.0, shapes: str = CUSTOMER_SHAPES) -> str:
    """Vertices of the polygons laid out for (k, code, slot)."""
    rows = ", ".join(
        f"({shape}, {ring}, {i}, {dx * stretch!r}::DOUBLE, {dy * stretch!r}::DOUBLE)"
        for shape, rings in SHAPES.items()
        for ring, points in enumerate(rings)
        for i, (dx, dy) in enumerate(points)
    )
    return f"""corners(shape, ring, i, dx, dy) AS (VALUES {rows}),
slots AS (SELECT k, code, slot, (slot % 400) * 0.4::DOUBLE - 80 AS lon0,
  ((slot // 400) % 225) * 0.4::DOUBLE - 30 AS lat0 FROM ({shapes})),
verts AS (SELECT k, code, ring, i, lon0 + dx AS lon, lat0 + dy AS lat
  FROM slots JOIN corners ON slot % 3 = shape)"""


_EASTING = f"radians(lon) * {SEMI_MAJOR!r}::DOUBLE"
_NORTHING = (
    f"{SEMI_MAJOR / 2.0 * (1.0 - _E2)!r}::DOUBLE * (sin(radians(lat)) / "
    f"(1 - {_E2!r}::DOUBLE * sin(radians(lat)) * sin(radians(lat))) - "
    f"ln((1 - {_E!r}::DOUBLE * sin(radians(lat))) / (1 + {_E!r}::DOUBLE * sin(radians(lat)))) / {2 * _E!r}::DOUBLE)"
)


def _lines(unit: float) -> str:
    """Signed edges of the projected rings in units of ``unit`` metres."""
    return f"""planar AS (SELECT k, code, ring, i, {_EASTING} / {unit!r}::DOUBLE AS x,
  {_NORTHING} / {unit!r}::DOUBLE AS y FROM verts),
paired AS (SELECT k, code, ring, i, x AS x0, y AS y0,
  coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1,
  coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1
  FROM planar WINDOW w AS (PARTITION BY k, ring ORDER BY i)),
lines AS (SELECT *, row_number() OVER () AS eid,
  sign(sum(x0 * y1 - x1 * y0) OVER (PARTITION BY k, ring)) *
  CASE WHEN ring = 0 THEN 1 ELSE -1 END AS sgn FROM paired)"""


OVERLAY = (
    _lines(10000.0) + """,
cuts AS (
  SELECT eid, 0::DOUBLE AS t FROM lines UNION SELECT eid, 1::DOUBLE FROM lines
  UNION SELECT eid, (g - x0) / (x1 - x0) FROM (SELECT eid, x0, x1,
    unnest(generate_series(CAST(floor(least(x0, x1)) AS BIGINT), CAST(ceil(greatest(x0, x1)) AS BIGINT))) AS g
    FROM lines WHERE x0 <> x1) WHERE (g - x0) / (x1 - x0) BETWEEN 0 AND 1
  UNION SELECT eid, (g - y0) / (y1 - y0) FROM (SELECT eid, y0, y1,
    unnest(generate_series(CAST(floor(least(y0, y1)) AS BIGINT), CAST(ceil(greatest(y0, y1)) AS BIGINT))) AS g
    FROM lines WHERE y0 <> y1) WHERE (g - y0) / (y1 - y0) BETWEEN 0 AND 1),
runs AS (SELECT eid, t AS t0, lead(t) OVER (PARTITION BY eid ORDER BY t) AS t1 FROM cuts),
pieces AS (SELECT code, x0 + (x1 - x0) * (t0 + t1) / 2 AS mx, y0 + (y1 - y0) * (t0 + t1) / 2 AS my,
  sgn * (y1 - y0) * (t1 - t0) AS dy FROM runs JOIN lines USING (eid) WHERE t1 IS NOT NULL),
touched AS (SELECT code, CAST(floor(mx) AS BIGINT) AS cx, CAST(floor(my) AS BIGINT) AS cy,
  sum((mx - floor(mx)) * dy) AS part, sum(dy) AS cov, sum(abs(dy)) AS size FROM pieces GROUP BY ALL),
swept AS (SELECT code, cx, cy, part, size AS own,
  coalesce(sum(cov) OVER (PARTITION BY code, cy ORDER BY cx DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rc,
  sum(size) OVER (PARTITION BY code, cy ORDER BY cx DESC ROWS UNBOUNDED PRECEDING) AS size,
  lag(cx) OVER (PARTITION BY code, cy ORDER BY cx DESC) AS upper FROM touched),
parts AS (SELECT code, cx, cy, part + CASE WHEN abs(rc) > 1e-12 * size THEN rc ELSE 0 END AS share, own AS size FROM swept
  UNION ALL SELECT code, unnest(generate_series(cx + 1, upper - 1)), cy, rc, size FROM swept WHERE upper - cx > 1),
shares AS (SELECT code, cx, cy, CASE WHEN share < 1e-6 THEN share ELSE round(share, 9) END AS share
  FROM parts WHERE share > 1e-12 * size),
cells AS (SELECT code, cx AS grid_col, cy AS grid_row, least(share, 1) AS frac, share > 1 AS overlap FROM shares)"""
)
CELLS = _corners() + ",\n" + OVERLAY

CUMULATIVE = """cumulative AS (SELECT *, sum(frac) OVER (PARTITION BY code ORDER BY frac, grid_row, grid_col
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_area,
  sum(frac) OVER (PARTITION BY code) AS total_area FROM cells)"""

AOO = """aoo AS (SELECT code, count(*) FILTER (cum_area / total_area > 0.01) AS aoo_cells,
  count(*) AS n_cells, sum(frac) * 100 AS area_km2, count(*) FILTER (overlap) AS overlap_cells
  FROM cumulative GROUP BY code)"""


def _hull(points: str) -> str:
    """EOO of points(code, lon, lat): directed edges with every point on their left.

    Only the westmost and eastmost point of each latitude can be a corner.
    """
    return f"""spots AS (SELECT DISTINCT code, lat, unnest([lo, hi]) AS lon FROM
  (SELECT code, lat, min(lon) AS lo, max(lon) AS hi FROM {points} GROUP BY code, lat)),
sides AS (SELECT a.code, a.lon AS px, a.lat AS py, b.lon AS qx, b.lat AS qy
  FROM spots a JOIN spots b ON a.code = b.code AND (a.lon <> b.lon OR a.lat <> b.lat)),
rejected AS (SELECT DISTINCT s.code, px, py, qx, qy FROM sides s JOIN spots c ON c.code = s.code
  WHERE (qx - px) * (c.lat - py) - (qy - py) * (c.lon - px) < 0
  OR ((qx - px) * (c.lat - py) - (qy - py) * (c.lon - px) = 0
    AND (c.lon - px) * (c.lon - qx) + (c.lat - py) * (c.lat - qy) > 0)),
rim AS (SELECT * FROM sides ANTI JOIN rejected USING (code, px, py, qx, qy)),
rim_xy AS (SELECT code, {_EASTING.replace('lon', 'px')} AS x0, {_NORTHING.replace('lat', 'py')} AS y0,
  {_EASTING.replace('lon', 'qx')} AS x1, {_NORTHING.replace('lat', 'qy')} AS y1 FROM rim),
eoo AS (SELECT code, abs(sum(x0 * y1 - x1 * y0)) / 2e6 AS eoo_km2, count(*) AS n_corners
  FROM rim_xy GROUP BY code)"""


def _limit(metric: str, key: str) -> str:
    chain = "".join(f" WHEN {metric} <= {limit} THEN '{abbr}'" for limit, abbr in THRESHOLDS[key])
    return f"CASE WHEN {metric} IS NULL THEN NULL{chain} ELSE 'LC' END"


_SEVERITY = "CASE {} " + "".join(
    f"WHEN '{a}' THEN {s} " for a, _, s, _ in CATEGORIES if s is not None
) + "ELSE 0 END"
_NAME = "CASE {} " + "".join(f"WHEN '{a}' THEN '{n}' " for a, n, _, _ in CATEGORIES) + "END"
_FILL = "CASE {} " + "".join(f"WHEN '{a}' THEN '{f}' " for a, _, _, f in CATEGORIES) + "END"


def _label(abbr: str) -> str:
    return f"coalesce({_NAME.format(abbr)} || ' (' || {abbr} || ')', {abbr}, 'N/A')"


def _worse(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} "
        f"WHEN {_SEVERITY.format(a)} >= {_SEVERITY.format(b)} THEN {a} ELSE {b} END"
    )


GRADED = ",\n".join(
    [
        CELLS, CUMULATIVE, AOO, "outer_verts AS (SELECT code, lon, lat FROM verts WHERE ring = 0)",
        _hull("outer_verts"), MAP_INDEX,
        f"""graded AS (SELECT m.code, m.idx, m.name, eoo_km2, aoo_cells, n_cells, area_km2, overlap_cells,
  {_limit('eoo_km2', 'B1')} AS b1, {_limit('aoo_cells', 'B2')} AS b2
  FROM map_index m LEFT JOIN eoo ON m.code = eoo.code LEFT JOIN aoo ON m.code = aoo.code)""",
    ]
)


def _parity_pixels(metres: float, stretch: float) -> str:
    """Pixel spans of each polygon: crossings of a row sorted and paired."""
    return ",\n".join(
        [
            _corners(stretch), _lines(metres),
            """crossed AS (SELECT k, code, r, x0 + (r + 0.5 - y0) * (x1 - x0) / (y1 - y0) AS xc
  FROM (SELECT *, unnest(generate_series(CAST(ceil(least(y0, y1) - 0.5) AS BIGINT),
    CAST(ceil(greatest(y0, y1) - 0.5) AS BIGINT) - 1)) AS r FROM lines WHERE y0 <> y1)),
ranked AS (SELECT *, row_number() OVER w AS rn, lead(xc) OVER w AS xd FROM crossed
  WINDOW w AS (PARTITION BY k, r ORDER BY xc)),
spans AS (SELECT k, code, r, CAST(ceil(xc - 0.5) AS BIGINT) AS c0, CAST(ceil(xd - 0.5) AS BIGINT) - 1 AS c1
  FROM ranked WHERE rn % 2 = 1)""",
        ]
    )


# hue rank to RGB; sectors of the colour wheel
_HUE = "(rank * 0.6180339887498949::DOUBLE - floor(rank * 0.6180339887498949::DOUBLE)) * 6"
_WHEEL = {
    "r": ("v", "q", "p", "p", "t", "v"),
    "g": ("t", "v", "v", "q", "p", "p"),
    "b": ("p", "p", "t", "v", "v", "q"),
}
COLOURS = f"""hues AS (SELECT *, {_HUE} AS h6 FROM ranks),
tones AS (SELECT *, floor(h6) AS s, 0.95::DOUBLE AS v, 0.95::DOUBLE * (1 - 0.65::DOUBLE) AS p,
  0.95::DOUBLE * (1 - (h6 - floor(h6)) * 0.65::DOUBLE) AS q,
  0.95::DOUBLE * (1 - (1 - (h6 - floor(h6))) * 0.65::DOUBLE) AS t FROM hues),
colours AS (SELECT *, {", ".join(
    "CAST(round_even(255 * CASE s " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(names))
    + f" END, 0) AS INTEGER) AS {channel}" for channel, names in _WHEEL.items())}, 200 AS a FROM tones)"""

RANKS = """grouped AS (SELECT idx, class_index.code, class_index.name, {group} AS colour_group
  FROM class_index LEFT JOIN firsts USING (code)),
ranks AS (SELECT colour_group, min(idx) AS first_index,
  row_number() OVER (ORDER BY min(idx)) - 1 AS rank FROM grouped GROUP BY colour_group)"""

PALETTE = """SELECT CAST(slot AS INTEGER) AS index, CAST(coalesce(r, 0) AS INTEGER) AS r,
  CAST(coalesce(c.g, 0) AS INTEGER) AS g, CAST(coalesce(b, 0) AS INTEGER) AS b,
  CAST(coalesce(a, 0) AS INTEGER) AS a
  FROM (SELECT unnest(generate_series(0, (SELECT max(idx) FROM grouped))) AS slot) slots
  LEFT JOIN grouped ON idx = slot LEFT JOIN colours c USING (colour_group)"""

# --- class index and lookups -------------------------------------------------

_CLASS_INDEX = _with(PARTS, FIRSTS, INDEX) + "SELECT idx AS index, code, name FROM class_index"
_SQL["class_index"] = _CLASS_INDEX
_SQL["index_file"] = _CLASS_INDEX
_SQL["index_round_trip"] = """SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS index,
list_extract([' A1 ', '"q"', 'a,b', '007', ''], c_custkey % 5 + 1) || c_custkey AS code,
list_extract(['', ' lead', 'line' || chr(10) || 'break', 'say "hi", bye', 'tab' || chr(9), 'back' || chr(92) || 'slash'], c_custkey % 6 + 1)
AS name FROM customer"""
_SQL["first_classes"] = _CLASS_INDEX + " WHERE idx <= 10"
_SQL["feature_index"] = _with(MAP_INDEX) + """SELECT c_custkey AS fid, code, idx AS index
FROM customer LEFT JOIN map_index ON code = 'N' || c_nationkey"""
_SQL["over_capacity"] = f"""SELECT * FROM (SELECT CAST(row_number() OVER
(ORDER BY {_natural("'C' || c_custkey")}) AS INTEGER) AS index, 'C' || c_custkey AS code, c_name AS name
FROM customer) WHERE index > 254"""
_SQL["first_values"] = _with(PARTS, FIRSTS) + """SELECT code, coalesce(name, '') AS record_name,
coalesce(fg, 'N/A') AS record_group, coalesce(fg, code) AS colour_group FROM firsts"""
_SQL["class_sizes"] = "SELECT 'N' || c_nationkey AS code, count(*) AS n_features FROM customer GROUP BY 1"
_SQL["type_list"] = _with(PARTS) + "SELECT DISTINCT code, name FROM parts"
_SQL["typology"] = """SELECT DISTINCT 'N' || c_nationkey AS code, n_name AS name, r_name AS fg,
'Grupo ' || r_name AS fg_name, 'B' || (r_regionkey % 3) AS biome,
CASE WHEN r_regionkey % 2 = 0 THEN 'T' ELSE 'M' END AS realm
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
_SQL["overview_counts"] = _with(PARTS) + f"""SELECT '{COUNTRY}' AS country, count(*) AS n_features,
count(DISTINCT code) AS ecosystem_types, count(DISTINCT fg) AS functional_groups, true AS has_groups,
'The {COUNTRY} ecosystem typology includes ' || count(DISTINCT code) || ' ecosystem types across ' ||
count(DISTINCT fg) || ' functional groups.' AS sentence, 'functional-group column ''functional_group'' not found, typology left out ' ||
'(columns: p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)' AS note FROM parts"""
_SQL["rejected_features"] = (
    "SELECT c_custkey AS fid, CAST(NULL AS VARCHAR) AS code FROM customer WHERE c_acctbal < 0"
)

# --- sources -----------------------------------------------------------------

_SQL["attribute_scan"] = """SELECT p_brand AS code, p_type AS name, CAST(NULL AS VARCHAR) AS fg,
count(*) AS n FROM part GROUP BY ALL"""
_SQL["one_class"] = (
    "SELECT p_brand AS code, count(*) AS n_features FROM part WHERE p_brand = 'Brand#7' GROUP BY 1"
)
_VERTICES = _with(_corners()) + """SELECT k AS fid, code, 0 AS part, ring, i,
round(lon, 6) AS lon, round(lat, 6) AS lat FROM verts"""
for _name in ("vertices", "geojson_vertices", "wkb_vertices"):
    _SQL[_name] = _VERTICES
_ORDER_SHAPES = """SELECT o_orderpriority AS code, o_custkey AS slot, min(o_orderkey) AS k
  FROM orders GROUP BY ALL"""
_SQL["without_copies"] = f"SELECT k AS fid, code FROM ({_ORDER_SHAPES})"
_SQL["aoo_of_repeated_shapes"] = _with(
    _corners(shapes=_ORDER_SHAPES), OVERLAY, CUMULATIVE, AOO
) + """SELECT code, aoo_cells, n_cells, round(area_km2, 3) AS area_km2, overlap_cells FROM aoo"""
_SQL["map_bounds"] = _with(_corners()) + """SELECT round(min(lon), 6) AS west, round(min(lat), 6) AS south,
round(max(lon), 6) AS east, round(max(lat), 6) AS north FROM verts"""
_SQL["sorted_copy"] = """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity,
true AS sorted, true AS small_groups FROM lineitem GROUP BY 1"""
_SQL["source_addresses"] = f"""WITH a AS (SELECT page_id,
  CASE WHEN page_id % 3 = 0 THEN 'gs://bucket/' ELSE '' END || split_part(split_part(url, '#', 1), '?', 1) ||
  list_extract(['.tif', '.TIFF?token=a', '.parquet', '.parquet/', '/'], page_id % 5 + 1) AS address FROM pages),
b AS (SELECT *, rtrim(split_part(address, '?', 1), '/') AS bare FROM a),
c AS (SELECT *, list_extract(string_split(bare, '/'), -1) AS last FROM b),
d AS (SELECT *, CASE WHEN last = '' THEN 'ecosystems'
  WHEN regexp_matches(last, '^.+[.][^.]+$') THEN regexp_replace(last, '[.][^.]+$', '') ELSE last END AS stem FROM c)
SELECT page_id, address, lower(bare) LIKE '%.tif' OR lower(bare) LIKE '%.tiff' AS is_raster,
lower(bare) LIKE '%.parquet' AS is_parquet,
regexp_matches(address, '^(http|https|gs|s3|az)://') AS is_remote,
CASE WHEN starts_with(address, 'gs://') THEN 'https://storage.googleapis.com/' || address[6:] ELSE address END
  AS public_address, stem,
'gs://{PROJECT}-caches/' || stem || '_sorted.parquet' AS optimized_data,
'gs://{PROJECT}-caches/' || stem || '_aoo_grid.parquet' AS aoo_grid_cache_url FROM d"""

_SQL["geojson_rejects"] = """SELECT c_custkey AS fid, list_extract(['unsupported geometry type Point',
'not a JSON feature', 'no geometry', 'coordinates cannot be read'], c_custkey % 5) AS reason
FROM customer WHERE c_custkey % 5 > 0"""
_SQL["geojson_accepted"] = """SELECT c_custkey AS fid, 'C' || c_custkey AS code, CAST(4 AS INTEGER) AS points
FROM customer WHERE c_custkey % 5 = 0"""

# --- extent and occupancy ----------------------------------------------------

_SQL["eoo_points"] = _with(
    """pts AS (SELECT 'N' || c_nationkey AS code, ((c_custkey * 7919) % 20000) / 100::DOUBLE - 100 AS lon,
  ((c_custkey * 104729) % 12000) / 100::DOUBLE - 60 AS lat FROM customer)""",
    _hull("pts"),
) + "SELECT code, round(eoo_km2, 3) AS eoo_km2, CAST(n_corners AS INTEGER) AS n_corners FROM eoo"
_SQL["eoo_by_class"] = _with(
    _corners(), "outer_verts AS (SELECT code, lon, lat FROM verts WHERE ring = 0)", _hull("outer_verts")
) + "SELECT code, round(eoo_km2, 3) AS eoo_km2 FROM eoo"
_SQL["aoo_cells"] = _with(CELLS) + (
    "SELECT code, grid_col, grid_row, round(frac, 6) AS frac, overlap FROM cells"
)
_SQL["cells_of_one_class"] = _with(CELLS) + "SELECT grid_col, grid_row, round(frac, 6) AS frac FROM cells WHERE code = 'N3'"
_SQL["aoo_cumulative"] = _with(CELLS, CUMULATIVE) + """SELECT code, grid_col, grid_row,
round(cum_area, 3) AS cum_area, round(cum_area / total_area, 6) AS cum_prop,
round(total_area, 3) AS total_area FROM cumulative"""
for _name in ("aoo_by_class", "aoo_from_cell_table"):
    _SQL[_name] = _with(CELLS, CUMULATIVE, AOO) + """SELECT code, aoo_cells, n_cells,
round(area_km2, 3) AS area_km2, overlap_cells FROM aoo"""
_SQL["grid_cell_count"] = _with(CELLS) + """SELECT count(*) AS cell_count, max(n) AS max_classes
FROM (SELECT grid_col, grid_row, count(*) AS n FROM cells GROUP BY ALL)"""
_SQL["cell_ramp"] = _with(CELLS) + """SELECT code, grid_col, grid_row,
round(coalesce((frac - min(frac) OVER w) / nullif(max(frac) OVER w - min(frac) OVER w, 0), 0), 5) AS ramp
FROM cells WINDOW w AS (PARTITION BY code)"""

_SQL["cell_colours"] = _with(CELLS, """ramps AS (SELECT code,
coalesce((frac - min(frac) OVER w) / nullif(max(frac) OVER w - min(frac) OVER w, 0), 0) AS ramp FROM cells WINDOW w AS (PARTITION BY code)),
faded AS (SELECT code, 255 - least(CAST(floor(ramp * 256) AS INTEGER), 255) AS fade FROM ramps)""") + """SELECT code,
255 AS r, fade AS g, fade AS b, 255 AS a, count(*) AS cells FROM faded GROUP BY code, fade"""

# --- categories --------------------------------------------------------------

_SQL["assessed_classes"] = """SELECT 'C' || c_custkey AS code, c_custkey % 3 <> 1 AS has_data,
CASE WHEN c_custkey % 3 <> 1 THEN true END AS measured, c_custkey % 3 <> 1 AS graded,
c_custkey % 3 = 1 AS unknown_overlap FROM customer"""
_SQL["criterion_b_assessment"] = _with(GRADED) + f"""SELECT code, idx AS index, name,
round(eoo_km2, 3) AS eoo_km2, aoo_cells, n_cells, round(area_km2, 3) AS area_km2, overlap_cells, b1, b2,
{_worse('b1', 'b2')} AS overall, 'spatial' AS basis, eoo_km2 IS NOT NULL AS has_data,
overlap_cells > 0 OR area_km2 > eoo_km2 * 1.000001 AS overlap,
{_label('(' + _worse('b1', 'b2') + ')')} AS overall_label FROM graded"""
_SQL["assessment_from_sorted_copy"] = _with(GRADED) + """SELECT code, round(eoo_km2, 3) AS eoo_km2,
aoo_cells, n_cells, round(area_km2, 3) AS area_km2, overlap_cells FROM graded"""
_SQL["overlap_flags"] = """WITH m AS (SELECT o_orderkey AS code, floor(o_totalprice / 10) AS eoo,
  o_custkey * 7 AS area, o_orderkey % 5 AS cells FROM orders)
SELECT code, (cells = 1) OR (area > eoo * 1.000001) AS overlap FROM m"""
_SQL["criterion_b_summary"] = _with(
    GRADED,
    f"""report AS (SELECT code, 1 AS line, 'B1' AS sub_criterion, 'EOO' AS metric,
  printf('%.0f', eoo_km2) || ' km²' AS value, b1 AS abbr FROM graded
  UNION ALL SELECT code, 2, 'B2', 'AOO', aoo_cells || ' cells', b2 FROM graded
  UNION ALL SELECT code, 3, 'Overall B', '—', '—', {_worse('b1', 'b2')} FROM graded)""",
) + f"""SELECT code, line, sub_criterion, metric, value, {_label('abbr')} AS category,
coalesce({_FILL.format('abbr')}, 'transparent') AS fill,
CASE WHEN {_FILL.format('abbr')} IN ('yellow', 'green', 'lightgray', 'white') THEN '#000' ELSE '#fff' END AS text_colour
FROM report"""
_SQL["criterion_b_limits"] = f"""WITH m AS (SELECT o_orderkey AS code,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice / 10) AS BIGINT) END AS eoo_km2,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey % 60 END AS aoo_cells FROM orders),
g AS (SELECT *, {_limit('eoo_km2', 'B1')} AS b1, {_limit('aoo_cells', 'B2')} AS b2 FROM m)
SELECT *, {_worse('b1', 'b2')} AS overall, 'spatial' AS basis FROM g"""

_ROWS = [(n, c, s) for n, (c, s) in enumerate(((c, s) for c, subs in CRITERIA.items() for s in subs), 1)]
_GRADE = (
    "list_extract([" + ", ".join(f"'{c[0]}'" for c in CATEGORIES) + ", 'TODO'], "
    "CAST(substr(code, 2) AS INTEGER) % 9 + 1)"
)
_SQL["criteria_table"] = _with(
    GRADED,
    "lines17(line, criterion, sub) AS (VALUES " + ", ".join(f"({n}, '{c}', '{s}')" for n, c, s in _ROWS) + ")",
    f"""statuses AS (SELECT code, line, criterion, sub, CASE sub WHEN 'A1' THEN {_GRADE} WHEN 'A3' THEN 'VU'
  WHEN 'B1' THEN coalesce(b1, 'NE') WHEN 'B2' THEN coalesce(b2, 'DD') WHEN 'B3' THEN {_GRADE} ELSE 'NE' END AS status
  FROM graded, lines17)""",
) + f"""SELECT code, line, criterion, sub AS sub_criterion, status, {_FILL.format('status')} AS fill,
CASE WHEN {_FILL.format('status')} IN ('yellow', 'green', 'lightgray', 'white') THEN '#000'
WHEN {_FILL.format('status')} IS NOT NULL THEN '#fff' END AS text_colour FROM statuses"""

# --- raster and colours ------------------------------------------------------

_SQL["raster_area"] = _with(_parity_pixels(RASTER_METRES, 1.0)) + f"""SELECT code,
CAST(sum(c1 - c0 + 1) AS BIGINT) AS pixels,
round(sum(c1 - c0 + 1) * {(RASTER_METRES / 1000) ** 2!r}::DOUBLE, 3) AS raster_km2
FROM spans WHERE c1 >= c0 GROUP BY code"""
_SQL["raster_overlap"] = _with(
    _parity_pixels(OVERLAP_METRES, 2.0),
    """burnt AS (SELECT r, c, arg_max(code, k) AS code FROM
  (SELECT k, code, r, unnest(generate_series(c0, c1)) AS c FROM spans WHERE c1 >= c0) GROUP BY r, c)""",
) + f"""SELECT code, count(*) AS pixels,
round(count(*) * {(OVERLAP_METRES / 1000) ** 2!r}::DOUBLE, 3) AS raster_km2 FROM burnt GROUP BY code"""
_SQL["cover_by_class"] = _with(
    _corners(1.3), _lines(OVERLAP_METRES),
    """crossed AS (SELECT k, code, r, x0 + (r + 0.5 - y0) * (x1 - x0) / (y1 - y0) AS xc
  FROM (SELECT *, unnest(generate_series(CAST(ceil(least(y0, y1) - 0.5) AS BIGINT),
    CAST(ceil(greatest(y0, y1) - 0.5) AS BIGINT) - 1)) AS r FROM lines WHERE y0 <> y1)),
paired_up AS (SELECT *, row_number() OVER w AS rn, lead(xc) OVER w AS xd FROM crossed WINDOW w AS (PARTITION BY k, r ORDER BY xc)),
stretches AS (SELECT code, r, xc AS a, xd AS b FROM paired_up WHERE rn % 2 = 1),
ends AS (SELECT DISTINCT code, r, unnest([a, b]) AS x FROM stretches),
steps AS (SELECT code, r, x, lead(x) OVER (PARTITION BY code, r ORDER BY x) - x AS len FROM ends),
depths AS (SELECT s.code, s.r, s.x, s.len, count(*) AS depth FROM steps s JOIN stretches t
  ON s.code = t.code AND s.r = t.r AND t.a <= s.x AND t.b > s.x WHERE s.len IS NOT NULL GROUP BY ALL),
areas AS (SELECT code, sum(depth * len) AS summed, sum(len) AS covered, coalesce(sum(len) FILTER (depth > 1), 0) AS twice
  FROM depths GROUP BY code)""",
) + """SELECT code, round(summed * 4::DOUBLE, 3) AS summed_km2, round(covered * 4::DOUBLE, 3) AS covered_km2,
round(twice * 4::DOUBLE, 3) AS twice_km2, twice > covered * 1e-6 AS overlap FROM areas"""
_SQL["overlap_inside"] = """SELECT 'S' || s_suppkey AS code, CAST(0 AS BIGINT) AS overlap_cells, s_suppkey % 2 = 1 AS overlap FROM supplier"""
_SQL["one_class_unsorted"] = """SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_custkey IN (7, 70, 700) GROUP BY o_custkey"""
_SQL["built_caches"] = _with(CELLS) + """SELECT code, features, cells, area_km2 FROM
(SELECT code, count(*) AS cells, round(sum(frac) * 100, 3) AS area_km2 FROM cells GROUP BY code)
JOIN (SELECT 'N' || c_nationkey AS code, count(*) AS features FROM customer GROUP BY 1) USING (code)"""
_SQL["geojson_split"] = _with(_corners()) + """SELECT code, n_name AS name, count(DISTINCT k) AS features,
count(*) AS points, round(sum(lon) FILTER (ring = 0 AND i = 0), 3) AS west_sum
FROM verts JOIN nation ON code = 'N' || n_nationkey GROUP BY code, n_name"""
_SQL["highlighted_pixels"] = _with(_parity_pixels(RASTER_METRES, 1.0), MAP_INDEX) + f"""SELECT
CASE WHEN idx = {CHOSEN_CLASS} THEN 220 ELSE 200 END AS r, CASE WHEN idx = {CHOSEN_CLASS} THEN 20 ELSE 200 END AS g,
CASE WHEN idx = {CHOSEN_CLASS} THEN 60 ELSE 200 END AS b, CASE WHEN idx = {CHOSEN_CLASS} THEN 235 ELSE 130 END AS a,
CAST(sum(c1 - c0 + 1) AS BIGINT) AS pixels FROM spans JOIN map_index USING (code) WHERE c1 >= c0 GROUP BY 1, 2, 3, 4"""
_SQL["categorical_pixels"] = _with(
    _parity_pixels(RASTER_METRES, 1.0), MAP_INDEX,
    """group_of AS (SELECT DISTINCT 'N' || c_nationkey AS code, r_name AS colour_group FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
ranks AS (SELECT colour_group, row_number() OVER (ORDER BY min(idx)) - 1 AS rank
  FROM group_of JOIN map_index USING (code) GROUP BY colour_group)""",
    COLOURS,
) + """SELECT colours.r, g, b, a, CAST(sum(c1 - c0 + 1) AS BIGINT) AS pixels FROM spans
JOIN group_of USING (code) JOIN colours USING (colour_group) WHERE c1 >= c0 GROUP BY ALL"""
_BY_CLASS = (PARTS, FIRSTS, INDEX, RANKS.format(group="class_index.code"), COLOURS)
_BY_GROUP = (PARTS, FIRSTS, INDEX, RANKS.format(group="coalesce(fg, class_index.code)"), COLOURS)
_SQL["palette_by_class"] = _with(*_BY_CLASS) + PALETTE
_SQL["palette_by_group"] = _with(*_BY_GROUP) + PALETTE
_SQL["map_colouring"] = _with(PARTS, FIRSTS, INDEX) + """SELECT way, code,
CASE WHEN way = 'functional_group, True' THEN coalesce(fg, code) ELSE code END AS colour_group,
CASE WHEN way = 'functional_group, False' THEN 'no functional-group column: coloured by ecosystem' END AS note
FROM class_index JOIN firsts USING (code), (VALUES ('functional_group, True'), ('functional_group, False'), ('ecosystem, True')) v(way)"""
_SQL["legend_by_class"] = _with(*_BY_CLASS) + """SELECT idx AS position, code || ' — ' || name AS label,
r, g, b, a FROM grouped JOIN colours USING (colour_group)"""
_SQL["legend_by_group"] = _with(*_BY_GROUP) + (
    "SELECT first_index AS position, colour_group AS label, r, g, b, a FROM colours"
)

# --- records and pages -------------------------------------------------------

_STATUS = "{" + ",".join(
    f'"{c}":{{' + ",".join(f'"{s}":"NE"' for s in subs) + "}" for c, subs in CRITERIA.items()
) + "}"
_TODO = ", ".join(
    f"'TODO' AS {f}" for f in (
        "biome", "iucn_status", "description", "distribution", "characteristic_native_biota",
        "abiotic_environment", "key_processes_and_interactions", "major_threats",
        "ecosystem_collapse_definition", "assessment_summary", "assessment_outcome", "year_published",
        "date_assessed", "assessed_by", "reviewed_by", "contributions_by",
        "criterion_a_description", "criterion_b_description", "criterion_c_description",
        "criterion_d_description", "criterion_e_description",
    )
)
_SQL["scaffold_records"] = _with(PARTS, FIRSTS, INDEX) + f"""SELECT coalesce(firsts.name, '') AS ecosystem_name,
'{COUNTRY}' AS country_name, 'John Smith, Jane Smith' AS authors, coalesce(fg, 'N/A') AS functional_group,
code AS global_classification, idx AS index, '{_STATUS}' AS criteria_status, {_TODO}
FROM class_index JOIN firsts USING (code)"""

_SQL["rendered_pages"] = f"""WITH r AS (SELECT 'C' || c_custkey AS code, c_name AS name,
  sha256(c_name || '|' || c_mktsegment || '{COUNTRY_CONFIG.strip()}' || chr(10)) AS h FROM customer)
SELECT code || '/' || code || '.qmd' AS path, code,
'# ' || name || ' (' || code || ')' || chr(10) || 'ecosystem_code = ''' || code || '''  # source-config sha256: ' ||
h || chr(10) || 'print(ecosystem_code)' || chr(10) AS text FROM r
UNION ALL SELECT code || '/' || code || '_crit_b.qmd', code,
'## ' || code || ' Criterion B' || chr(10) || 'ecosystem_code = ''' || code || '''' || chr(10) ||
'print(ecosystem_code)' || chr(10) FROM r"""
_SQL["page_changes"] = """WITH r AS (SELECT 'C' || c_custkey AS code, c_acctbal AS bal FROM customer)
SELECT code || '/' || code || '.qmd' AS path, code, CASE WHEN bal < 0 THEN 'new'
WHEN bal < 5000 THEN 'unchanged' ELSE 'changed' END AS change FROM r
UNION ALL SELECT code || '/' || code || '_crit_b.qmd', code,
CASE WHEN bal < 0 THEN 'new' ELSE 'unchanged' END FROM r"""
_SQL["chapter_list"] = """WITH r AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS idx,
  'C' || c_custkey AS code, coalesce(CASE WHEN c_nationkey <> 3 THEN c_name END, 'C' || c_custkey) AS name FROM customer)
SELECT CAST(row_number() OVER (ORDER BY idx NULLS LAST, name, code) AS BIGINT) AS position, code,
CASE WHEN idx IS NULL THEN '' ELSE idx || ' · ' END ||
CASE WHEN code = name THEN name ELSE code || ' - ' || name END AS label,
code || '/' || code || '.qmd ' || code || '/' || code || '_crit_b.qmd' AS pages FROM r"""

# the script text holds a backslash and an n, not a line break
_SCRIPT = r"""'bundle ' || (page_id % 7) || repeat('; call("</script>", ''\n'')', 200)"""
BUNDLES = f"""scripts AS (SELECT page_id, {_SCRIPT} AS script, html FROM pages),
bundles AS (SELECT page_id, 'js' AS ext, script AS body FROM scripts
  UNION ALL SELECT page_id, 'js', script FROM scripts
  UNION ALL SELECT page_id, 'css', html FROM scripts WHERE length(html) >= 4096),
hashed AS (SELECT *, substr(sha256(body), 1, 32) AS digest FROM bundles)"""
_SQL["bundle_usage"] = _with(BUNDLES) + """SELECT digest, ext, CAST(max(length(body)) AS INTEGER) AS n_chars,
count(*) AS uses, count(DISTINCT page_id) AS n_pages FROM hashed GROUP BY digest, ext"""
_SQL["shared_bundles"] = _with(BUNDLES) + """SELECT DISTINCT digest, ext,
'site_libs/anywidget-assets/' || digest || '.' || ext AS path, body FROM hashed"""
_SQL["rewritten_pages"] = _with(BUNDLES) + """SELECT page_id,
repeat('d/', page_id % 4) || 'p' || page_id || '.html' AS path, true AS changed,
'anywidget-ref:' || repeat('../', page_id % 4) || 'site_libs/anywidget-assets/' ||
substr(sha256(script), 1, 32) || '.js' AS script_reference, 'p{}' AS small_style, true AS marked FROM scripts"""

_SQL["page_problems"] = """SELECT page_id, page_id % 6 NOT IN (2, 3) AS changed,
CASE page_id % 6 WHEN 2 THEN 'a bundle is not valid Unicode' WHEN 3 THEN 'the state block is not JSON' END AS problem
FROM pages"""
_SQL["reference_integrity"] = """WITH used AS (SELECT page_id % 5 AS body, CASE WHEN page_id % 6 = 4 THEN 'css' ELSE 'js' END AS ext
  FROM pages WHERE page_id % 6 NOT IN (2, 3))
SELECT count(*) AS "references", count(DISTINCT body || ext) AS assets, CAST(0 AS BIGINT) AS dangling,
CAST(0 AS BIGINT) AS unused FROM used"""

_SQL["asset_store"] = """WITH used AS (SELECT page_id % 5 AS body, CASE WHEN page_id % 6 = 4 THEN 'css' ELSE 'js' END AS ext
  FROM pages WHERE page_id % 6 NOT IN (2, 3)),
told AS (SELECT count(*) AS refs, count(DISTINCT body || ext) AS files, count(DISTINCT body) AS contents FROM used)
SELECT unnest(['references', 'assets', 'dangling', 'unused', 'files', 'contents', 'bytes']) AS measure,
unnest([refs, files, 0, 0, files, contents, files * length('bundle 0' || repeat(' x', 3000))]) AS value FROM told"""

# --- checks ------------------------------------------------------------------

_SQL["orphan_pages"] = """SELECT DISTINCT 'C' || o_custkey AS code FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""
_CACHES = """named AS (SELECT c_custkey AS source, 'gs://b/cache/C' || c_custkey || '_sorted.parquet' AS path
  FROM customer WHERE c_acctbal > 4000 UNION ALL
  SELECT c_custkey, 'gs://b/cache/C' || c_custkey || '_aoo_grid.parquet' FROM customer WHERE c_acctbal > 6000),
listing AS (SELECT 'gs://b/cache/C' || o_custkey || '_sorted.parquet' AS path FROM orders UNION
  SELECT 'gs://b/cache/C' || o_custkey || '_aoo_grid.parquet' FROM orders WHERE o_orderstatus = 'F')"""
_SQL["missing_caches"] = _with(_CACHES) + (
    "SELECT DISTINCT path FROM named WHERE path NOT IN (SELECT path FROM listing)"
)


def _customer_index(where: str) -> str:
    return f"""(SELECT CAST(row_number() OVER (ORDER BY {_natural("'C' || c_custkey")}) AS INTEGER) AS index,
  'C' || c_custkey AS code FROM customer {where})"""


_SQL["legend_mismatches"] = f"""SELECT coalesce(l.index, r.index) AS index, l.code AS legend_code, r.code AS index_code
FROM {_customer_index('WHERE c_acctbal >= 0')} l FULL JOIN {_customer_index('')} r ON l.index = r.index
WHERE l.code IS DISTINCT FROM r.code"""
_BACKFILL = _with(
    MAP_INDEX,
    """records AS (SELECT 'N' || (n_nationkey * 2) AS code,
  CASE WHEN n_regionkey <> 0 THEN n_nationkey * n_regionkey + 1 END AS old FROM nation),
filled AS (SELECT records.code, CAST(coalesce(idx, old) AS INTEGER) AS index, CASE WHEN idx IS NULL THEN 'unmatched'
  WHEN idx IS NOT DISTINCT FROM old THEN 'unchanged' ELSE 'set' END AS change
  FROM records LEFT JOIN map_index USING (code))""",
)
_SQL["index_backfill"] = _BACKFILL + "SELECT * FROM filled"
_SQL["index_change_count"] = _BACKFILL + "SELECT change, count(*) AS n_records FROM filled GROUP BY change"
_SQL["unindexed_records"] = """SELECT DISTINCT 'N' || (o_custkey % 40) AS code FROM orders
WHERE (o_custkey % 40) NOT IN (SELECT c_nationkey FROM customer)"""
_DRIFT = """drift AS (SELECT c_custkey AS source, c_mktsegment || '.parquet' AS data,
  CASE WHEN c_nationkey % 4 <> 0 THEN 'EFG1' END AS group_column,
  c_acctbal < 0 OR c_acctbal > 8000 OR (c_acctbal >= 7000 AND c_nationkey % 4 <> 0) AS drifted FROM customer)"""
_SQL["source_drift"] = _with(_DRIFT) + "SELECT * FROM drift"
_GATE = """n AS (SELECT count(*) AS n_records, count(*) FILTER (c_acctbal < 0) AS bad, count(*) FILTER (c_acctbal >= 0) AS good
  FROM customer),
d AS (SELECT count(*) FILTER (drifted) AS drifted FROM drift),
p AS (SELECT count(DISTINCT o_custkey) AS pages, count(DISTINCT o_custkey) FILTER (o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS orphans FROM orders),
rows AS (SELECT 'as recorded' AS scenario, n_records, drifted AS drifted_sources, orphans AS orphan_pages, bad AS invalid_records FROM n, d, p
  UNION ALL SELECT 'no drift', n_records, 0, orphans, bad FROM n, p
  UNION ALL SELECT 'no orphans', n_records, 0, 0, bad FROM n
  UNION ALL SELECT 'all well', good, 0, 0, 0 FROM n
  UNION ALL SELECT 'no records', 0, 0, pages, 0 FROM p),
judged AS (SELECT *, CASE WHEN n_records = 0 THEN 'scaffold' WHEN drifted_sources > 0 THEN 'source drift'
  WHEN orphan_pages > 0 THEN 'orphan pages' WHEN invalid_records > 0 THEN 'invalid records' ELSE 'regenerate' END AS action FROM rows)"""
_SQL["build_gate_actions"] = _with(_DRIFT, _GATE) + """SELECT scenario, CAST(n_records AS BIGINT) AS n_records,
CAST(drifted_sources AS BIGINT) AS drifted_sources, CAST(orphan_pages AS BIGINT) AS orphan_pages,
CAST(invalid_records AS BIGINT) AS invalid_records, action FROM judged"""
_SQL["build_gate_status"] = _with(_DRIFT, _GATE) + """SELECT n_records, drifted_sources, orphan_pages, invalid_records, action
FROM judged WHERE scenario = 'as recorded'"""
_SQL["invalid_records"] = "SELECT c_name AS name FROM customer WHERE c_acctbal < 0"

# --- layout and readiness ----------------------------------------------------

_SQL["footer_ranges"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS num_rows, "
    f"CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM {t}"
    for t, c in ECOSYSTEM_COLUMNS.items()
)
_SQL["footer_verdicts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS num_rows, false AS refuse_load, CAST(0 AS BIGINT) AS problems, "
    f"true AS has_bytes, false AS inconsistent FROM {t}"
    for t in ECOSYSTEM_COLUMNS
)
_SQL["unreadable_footers"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(3 AS BIGINT) AS files, CAST(2 AS BIGINT) AS unreadable, count(*) AS num_rows FROM {t}"
    for t in ECOSYSTEM_COLUMNS
)
_SQL["layout_verdicts"] = """WITH o AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'gs://b/C' ELSE '/data/C' END || o_custkey
  AS path, o_custkey, o_orderkey, CAST(trunc(o_totalprice / 5) AS BIGINT) AS rows,
  strftime(o_orderdate, '%Y-%m') AS month, o_orderkey % 29 <> 0 AS ranged,
  CAST(trunc(o_totalprice * 4000) AS BIGINT) AS geom, CAST(trunc(o_totalprice * 5000) AS BIGINT) AS note FROM orders),
s AS (SELECT *, month < lag(month) OVER (PARTITION BY path ORDER BY o_orderkey) AS back FROM o),
f AS (SELECT path, CAST(NULL AS VARCHAR) AS problem, count(*) AS num_row_groups, CAST(sum(rows) AS BIGINT) AS num_rows, max(rows) AS max_rows_per_group,
  CAST(CASE WHEN any_value(o_custkey) % 3 = 0 THEN sum(geom) ELSE sum(note) END AS BIGINT) AS geometry_bytes,
  CASE WHEN any_value(o_custkey) % 3 = 0 THEN 'geom' ELSE 'note' END AS geometry_column,
  CASE WHEN bool_and(ranged) THEN NOT coalesce(bool_or(back), false) END AS ranges_sorted FROM s GROUP BY path),
v AS (SELECT *, coalesce(ranges_sorted, false) AND num_row_groups >= 2 AND max_rows_per_group <= 50000 AS optimized FROM f),
w AS (SELECT *, NOT optimized AND starts_with(path, 'gs://') AND geometry_bytes >= 1073741824 AS refuse_load FROM v)
SELECT *, CASE WHEN refuse_load THEN 'large remote file that is not optimized: ' ||
printf('%.1f', geometry_bytes / 1073741824) || ' GB geometry in ' || num_row_groups ||
' row groups; write a sorted copy first' END AS refusal FROM w"""
_SQL["source_readiness"] = " UNION ALL ".join(
    f"SELECT '{t}' AS source, count(*) >= 1000 AS refused, count(*) >= 1000 AS named_rows, CAST(NULL AS VARCHAR) AS problem FROM {t}"
    for t in ECOSYSTEM_COLUMNS
) + """ UNION ALL SELECT 'cached', false, false, NULL UNION ALL SELECT 'half cached', true, false, NULL
UNION ALL SELECT 'absent', false, false, 'the source is not in the listing'"""
_SQL["cache_readiness"] = _with(
    _CACHES,
    """counts AS (SELECT source, count(*) AS n_configured, count(*) FILTER (path NOT IN (SELECT path FROM listing))
  AS n_missing FROM named GROUP BY source),
totals AS (SELECT o_custkey AS source, count(*) AS groups, sum(o_totalprice) AS price FROM orders GROUP BY 1),
s AS (SELECT c_custkey AS source, coalesce(n_configured, 0) AS n_configured, coalesce(n_missing, 0) AS n_missing,
  floor(price * 2000) AS size,
  CASE WHEN c_custkey % 5 <> 0 THEN floor(price * 1000) END AS geom,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(floor(price / 10) AS BIGINT) END AS rows,
  CASE WHEN c_custkey % 5 <> 0 THEN groups END AS groups
  FROM customer LEFT JOIN counts ON counts.source = c_custkey LEFT JOIN totals ON totals.source = c_custkey),
heavy AS (SELECT *, concat_ws('; ',
  CASE WHEN geom >= 1073741824 THEN 'geometry is ' || printf('%.1f', geom / 1073741824) || ' GB uncompressed' END,
  CASE WHEN rows >= 200000 THEN format('{:,}', rows) || ' features' END,
  CASE WHEN groups < 3 AND geom >= 536870912 THEN 'only ' || groups || ' row groups' END) AS why FROM s),
judged AS (SELECT source, n_configured, n_missing, CASE
  WHEN n_configured > 0 THEN CASE WHEN n_missing > 0 THEN n_missing || ' configured caches do not exist' ELSE '' END
  WHEN why <> '' THEN why
  WHEN geom IS NULL AND size >= 2147483648 THEN 'file is ' || printf('%.1f', size / 1073741824) || ' GB'
  ELSE '' END AS reasons FROM heavy)""",
) + "SELECT source, n_configured, n_missing, reasons = '' AS ok, reasons FROM judged"
