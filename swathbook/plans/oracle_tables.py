"""The derived tables of ``fixtures`` in DuckDB SQL, as common table expressions."""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["prod"] = """
SELECT *, 'S1' || CASE g % 2 WHEN 0 THEN 'A' ELSE 'B' END || '_' || mode || '_' || kind || '_'
    || CASE k WHEN 2 THEN '2' ELSE '1' END || 'S'
    || CASE g % 4 WHEN 0 THEN 'DV' WHEN 1 THEN 'SV' WHEN 2 THEN 'SH' ELSE 'DH' END
    || '_' || strftime(start, '%Y%m%dT%H%M%S') || '_' || strftime(stop, '%Y%m%dT%H%M%S')
    || '_' || printf('%06d', g) || '_' || printf('%06X', g) || '_' || printf('%04X', event_id * 3 + k) || '.SAFE' AS Name
FROM (
  SELECT *, start + to_seconds(25) AS stop FROM (
    SELECT event_id, user_id, event_type, value, g, k,
      t + to_seconds(CASE k WHEN 1 THEN event_id % 12 ELSE 0 END) AS start,
      CASE g % 3 WHEN 0 THEN 'IW' WHEN 1 THEN 'EW' ELSE 'WV' END AS mode,
      CASE k WHEN 0 THEN 'SLC_' WHEN 1 THEN 'GRDH' ELSE 'OCN_' END AS kind
    FROM (SELECT *, date_trunc('second', ts) AS t, event_id // 4 AS g, unnest(range(0, 3)) AS k FROM events)
  )
)"""

CTES["cat"] = """
SELECT p.event_id || '-' || k || CASE v WHEN 1 THEN '-v2' ELSE '' END AS Id, Name, 'SENTINEL-1' AS collection,
  event_id, event_type, value, start AS content_start, stop AS content_end,
  start + to_days(CAST(v + 1 AS INTEGER)) AS modified, start + to_hours(6) AS published,
  CAST(floor(value * 1000000) AS BIGINT) AS size, mode, substr(Name, 5, 10) AS ptype,
  CASE WHEN event_id % 2 = 1 THEN 'ASCENDING' ELSE 'DESCENDING' END AS direction, value % 100 AS cloud,
  (user_id * 37) % 340 - 170 AS x0, (event_id * 17) % 140 - 70 AS y0,
  (user_id * 37) % 340 - 170 + 2 + event_id % 5 AS x1, (event_id * 17) % 140 - 70 + 2 AS y1,
  '/eodata/' || CASE WHEN value < 5 THEN 'Sentinel-1/SAR/OTHER/' || Name
     ELSE 'Sentinel-1/SAR/' || substr(Name, 5, 10) || '/' || strftime(start, '%Y/%m/%d') || '/' || Name END AS S3Path
FROM (SELECT *, unnest(CASE WHEN event_type = 'purchase' THEN [0, 1] ELSE [0] END) AS v FROM prod) p"""

CTES["req"] = """
SELECT CAST(k AS VARCHAR) AS request_key, CASE WHEN k % 100 <> 99 THEN 'R' || k END AS id_query,
  coalesce(CASE WHEN k % 100 <> 99 THEN 'R' || k END, CAST(k AS VARCHAR)) AS id_original_query,
  'N' || n AS nation_query,
  CASE WHEN k % 13 <> 12 THEN s0 END AS s,
  CASE WHEN k % 11 <> 10 THEN s0 + to_days(CAST(CASE WHEN k % 9 = 4 THEN 60 ELSE 1 + k % 10 END AS INTEGER)) END AS e,
  CASE WHEN k % 7 = 0 THEN 'point' WHEN k % 2 = 0 THEN 'polygon' END AS area_kind,
  n * 12 - 160 AS ax, n * 4 - 60 AS ay,
  n * 12 - 160 + CASE WHEN k % 7 = 0 THEN 0 ELSE 40 END AS bx, n * 4 - 60 + CASE WHEN k % 7 = 0 THEN 0 ELSE 40 END AS by_,
  CASE WHEN k % 4 <> 3 THEN 'SENTINEL-1' END AS collection, CASE WHEN k % 6 = 1 THEN 'GRDH' END AS name_part,
  CASE k % 3 WHEN 1 THEN 'IW' WHEN 2 THEN 'EW' END AS sensormode,
  CASE WHEN k % 8 = 2 THEN 'EW_SLC__1S' END AS producttype, CASE WHEN k % 5 = 0 THEN 40.0 END AS cloud_max
FROM (SELECT s_suppkey AS k, s_nationkey AS n, TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 25 AS INTEGER)) AS s0
      FROM supplier)"""

CTES["hits"] = """
SELECT r.id_original_query, r.request_key, r.s, r.e, c.*
FROM req r JOIN cat c ON (r.s IS NULL OR c.content_start > r.s) AND (r.e IS NULL OR c.content_start < r.e)
  AND (r.collection IS NULL OR c.collection = r.collection) AND (r.name_part IS NULL OR contains(c.Name, r.name_part))
  AND (r.sensormode IS NULL OR c.mode = r.sensormode) AND (r.producttype IS NULL OR c.ptype = r.producttype)
  AND (r.cloud_max IS NULL OR c.cloud <= r.cloud_max)
  AND (r.area_kind IS NULL OR (c.x0 <= r.bx AND r.ax <= c.x1 AND c.y0 <= r.by_ AND r.ay <= c.y1))"""

CTES["latest"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_original_query, Name ORDER BY modified DESC, Id) AS rn FROM hits)
WHERE rn = 1"""

CTES["land"] = """
SELECT n_nationkey AS land_id, (n_nationkey % 5) * 72 - 180 AS lx0, (n_nationkey // 5) * 36 - 90 AS ly0,
  (n_nationkey % 5) * 72 - 180 + 36 AS lx1, (n_nationkey // 5) * 36 - 90 + 18 AS ly1 FROM nation"""

CTES["sea"] = """
SELECT c.Id, any_value(c.Name) AS Name, any_value(c.event_id) AS event_id,
  (any_value((c.x1 - c.x0) * (c.y1 - c.y0)) - sum(CASE WHEN l.land_id IS NULL THEN 0 ELSE
     (least(c.x1, l.lx1) - greatest(c.x0, l.lx0)) * (least(c.y1, l.ly1) - greatest(c.y0, l.ly0)) END))
  / CAST(any_value((c.x1 - c.x0) * (c.y1 - c.y0)) AS DOUBLE) * 100 AS sea_percent
FROM cat c LEFT JOIN land l ON c.x0 < l.lx1 AND l.lx0 < c.x1 AND c.y0 < l.ly1 AND l.ly0 < c.y1
GROUP BY c.Id"""

CTES["file"] = """
SELECT tier, root, CASE event_id % 3 WHEN 0 THEN full_path WHEN 1 THEN full_path || '.zip'
   ELSE replace(full_path, '.SAFE', '.zip') END AS path, CAST(floor(value * 1000000) AS BIGINT) AS size
FROM (
  SELECT *, CASE WHEN tier = 'archive' THEN root || '/sentinel-1' || lower(substr(Name, 3, 1)) || '/L' || substr(Name, 13, 1)
     || '/' || mode || '/' || substr(Name, 1, 3) || '_' || mode || substr(Name, 7, 8) || strftime(start, '/%Y/%j') ELSE root END
     || '/' || Name AS full_path
  FROM (
    SELECT *, 'archive' AS tier, '/home/data/archive' AS root FROM prod WHERE event_type = 'click' AND value <= 10
    UNION ALL SELECT *, 'archive', '/home/old/archive' FROM prod WHERE event_type = 'click' AND value > 8
    UNION ALL SELECT *, 'spool', '/home/spool' FROM prod WHERE event_type IN ('view', 'click') AND value > 30
    UNION ALL SELECT *, 'outdir', '/home/out' FROM prod WHERE event_type IN ('error', 'view') AND value > 15
  )
)"""

CTES["listing"] = """
SELECT event_id * 2 + c AS line_no, safename FROM (
  SELECT event_id, unnest(CASE WHEN event_type = 'purchase' THEN [0, 1] ELSE [0] END) AS c,
    CASE WHEN event_type = 'signup' AND value < 10 THEN 'S1C' || substr(Name, 4)
      WHEN event_type = 'error' AND value < 5 THEN 'S1A_IW_SLC__BAD_' || event_id || '.SAFE'
      WHEN event_type = 'error' AND value < 10 THEN '/data/' || Name
      WHEN event_type = 'view' AND value < 2 THEN replace(Name, '.SAFE', '.CORRUPTED') ELSE Name END AS safename
  FROM prod WHERE k = 0)"""

_TIME = "try_strptime(substr(safename, {at}, 15), '%Y%m%dT%H%M%S')"
CTES["src"] = f"""
SELECT line_no, safename AS source_id, ok, CASE WHEN ok THEN substr(safename, 1, 3) END AS unit,
  CASE WHEN ok THEN substr(safename, 50, 13) END AS orbit_take, CASE WHEN ok THEN substr(safename, 57, 6) END AS take,
  CASE WHEN ok THEN '1S' || substr(safename, 15, 2) END AS level_pol, CASE WHEN ok THEN st END AS st,
  CASE WHEN contains(safename, '/') THEN 'full path instead of a name' WHEN NOT ok THEN 'unreadable time' END AS err
FROM (SELECT *, {_TIME.format(at=18)} AS st, NOT contains(safename, '/') AND safename LIKE 'S1%'
        AND {_TIME.format(at=18)} IS NOT NULL AND {_TIME.format(at=34)} IS NOT NULL AS ok FROM listing)"""

def matched(target: str, level: str, catalog: str = "cat") -> str:
    """The sibling match of the listing with products of one type and level."""
    return f"""
SELECT line_no, source_id, CASE WHEN hit THEN Id END AS target_id, CASE WHEN hit THEN cand END AS target_name,
  CASE WHEN hit THEN '{target}' END AS target_type,
  CASE WHEN hit THEN CASE WHEN exact THEN 'exact_timestamp' ELSE 'closest_in_time' END END AS match_method,
  CASE WHEN hit THEN round(size / 1048576.0, 2) END AS size_mb,
  CASE WHEN hit THEN 'https://download.dataspace.copernicus.eu/odata/v1/Products(' || Id || ')/$value' END AS download_url,
  CASE WHEN NOT ok THEN 'error' WHEN hit THEN 'found' ELSE 'not_found' END AS status,
  CASE WHEN NOT ok THEN err WHEN hit THEN NULL WHEN Id IS NULL THEN 'No {target} product found for DataTake ' || take
    ELSE 'Closest {target} product is ' || delta || 's away (>8s threshold): ' || cand END AS note,
  CASE WHEN exact THEN 0 ELSE delta END AS delta_seconds
FROM (
  SELECT *, coalesce(exact OR delta <= 8, false) AS hit FROM (
    SELECT s.*, c.Id, c.Name AS cand, c.size, contains(c.Name, strftime(s.st, '%Y%m%dT%H%M%S')) AS exact,
      abs(CAST(epoch(c.content_start) AS BIGINT) - CAST(epoch(s.st) AS BIGINT)) AS delta,
      row_number() OVER (PARTITION BY s.line_no ORDER BY
        CASE WHEN contains(c.Name, strftime(s.st, '%Y%m%dT%H%M%S')) THEN 0 ELSE 1 END,
        CASE WHEN contains(c.Name, strftime(s.st, '%Y%m%dT%H%M%S')) THEN 0
             ELSE abs(epoch(c.content_start) - epoch(s.st)) END, c.Name, c.Id) AS rn
    FROM src s LEFT JOIN (SELECT * FROM {catalog} WHERE substr(Name, 7, 5) = '_{target}' AND NOT contains(Name, '_COG')) c
      ON substr(c.Name, 1, 3) = s.unit AND substr(c.Name, 50, 13) = s.orbit_take AND substr(c.Name, 13, 4) = '{level}' || substr(s.level_pol, 2)
  ) WHERE rn = 1
)"""


CTES["matched"] = matched("GRDH", "1")

_DIR = (
    "'/sentinel-1' || lower(substr(split_part(safename, '_', 1), 3)) || '/L' || substr(safename, 13, 1) || '/' || md || '/' "
    "|| split_part(safename, '_', 1) || '_' || md || substr(safename, 7, 8) || strftime(st, '/%Y/%j') || '/' || safename"
)
CTES["spots"] = f"""
SELECT safename, tier, rank + v AS rank,
  CASE v WHEN 0 THEN base WHEN 1 THEN base || '.zip' ELSE replace(base, '.SAFE', '.zip') END AS path
FROM (
  SELECT *, unnest(range(0, 3)) AS v FROM (
    SELECT safename, 'archive' AS tier, 0 AS rank, '/home/data/archive' || {_DIR} AS base FROM nm WHERE contains(safename, 'S1')
    UNION ALL SELECT safename, 'archive', 3, '/home/old/archive' || {_DIR} FROM nm WHERE contains(safename, 'S1')
    UNION ALL SELECT safename, 'spool', 6, '/home/spool/' || safename FROM nm
    UNION ALL SELECT safename, 'outdir', 9, '/home/out/' || safename FROM nm
  )
)"""
CTES["nm"] = f"""
SELECT DISTINCT safename, {_TIME.format(at=18)} AS st,
  CASE WHEN split_part(safename, '_', 2) LIKE 'S%' THEN 'SM' ELSE split_part(safename, '_', 2) END AS md FROM listing"""
CTES["located"] = """
SELECT l.line_no, l.safename, coalesce(h.tier, 'absent') AS tier, h.path AS found_path, h.tier IS NULL AS to_download,
  '/home/out/' || l.safename || '.zip' AS output_path
FROM listing l LEFT JOIN (
  SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY safename ORDER BY rank) AS rn
    FROM spots s JOIN (SELECT DISTINCT path FROM file) f ON f.path = s.path) WHERE rn = 1
) h ON h.safename = l.safename"""

CTES["xfer"] = """
SELECT 'P' || o_orderkey AS safename, 'acc' || (o_custkey % 6) AS login, o_orderkey % 50 AS batch,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN 2 WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END AS status,
  CAST(1 + o_orderkey % 60 AS DOUBLE) AS elapsed_time, o_totalprice / 1000.0 AS total_mb,
  o_totalprice / 1000.0 / CAST(1 + o_orderkey % 60 AS DOUBLE) AS speed,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN
    CASE o_orderstatus WHEN 'F' THEN 'Downloaded' WHEN 'O' THEN 'S3Error' ELSE 'NotFound' END END AS status_meaning
FROM orders"""

CTES["obj"] = """
SELECT base || part AS key, Name, part, size FROM (
  SELECT Name, 'Sentinel-1/SAR/' || substr(Name, 5, 10) || '/' || strftime(start, '%Y/%m/%d') || '/' || Name || '/' AS base,
    unnest(CASE event_type WHEN 'click' THEN [{'part': 'product.zip', 'size': CAST(floor(value * 1000) AS BIGINT)}]
      WHEN 'view' THEN [{'part': '', 'size': CAST(0 AS BIGINT)}, {'part': 'manifest.safe', 'size': CAST(1000 AS BIGINT)},
        {'part': 'measurement/data.tiff', 'size': CAST(floor(value * 1000) AS BIGINT)},
        {'part': 'preview/quick-look.png', 'size': CAST(500 AS BIGINT)}] END, recursive := true)
  FROM prod)"""

CTES["other"] = """
SELECT event_id, g, t,
  'S2' || CASE g % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END || '_MSIL' || CASE g % 2 WHEN 0 THEN '1C' ELSE '2A' END || '_'
  || strftime(t, '%Y%m%dT%H%M%S') || '_N0204_R' || printf('%03d', g % 143) || '_T' || printf('%02d', event_id % 60 + 1) || 'NMJ_'
  || strftime(t + to_seconds(1), '%Y%m%dT%H%M%S') || '.SAFE' AS s2_name,
  'S3' || CASE g % 2 WHEN 0 THEN 'A' ELSE 'B' END || '_SR_2_WAT____' || strftime(t, '%Y%m%dT%H%M%S') || '_'
  || strftime(t + to_seconds(600), '%Y%m%dT%H%M%S') || '_' || strftime(t + to_seconds(7490), '%Y%m%dT%H%M%S') || '_0600_'
  || printf('%03d', g % 100) || '_' || printf('%03d', event_id % 385) || '______MAR_'
  || CASE g % 4 WHEN 0 THEN 'O' WHEN 1 THEN 'F' WHEN 2 THEN 'D' ELSE 'R' END || '_NR_002.SEN3' AS s3_name
FROM (SELECT *, date_trunc('second', ts) AS t, event_id // 4 AS g FROM events)"""

#: Starts a common table expression whose long expressions must not be copied into its readers.
ONCE = "/* once */ "


def _skew_ring(dx: float) -> list[tuple[str, str]]:
    return [(f"(x0 + {dx})", "(y0 + 0.5)"), (f"(x1 + {dx})", "y0"), (f"(x1 + {dx} + 0.5)", "y1"), (f"(x0 + {dx} + 0.25)", "(y1 + 0.5)")]


def points(ring: list[tuple[str, str]]) -> str:
    return "[" + ", ".join(f"{{'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}" for x, y in ring) + "]"


def left_of(ring: list[tuple[str, str]]) -> list[str]:
    """Half-planes of a convex counter-clockwise ring, as expressions of the point q that are 0 or more inside."""
    pairs = zip(ring, ring[1:] + ring[:1], strict=True)
    return [f"({bx} - {ax}) * (q.y - {ay}) - ({by} - {ay}) * (q.x - {ax})" for (ax, ay), (bx, by) in pairs]


def clipped(source: str, half_planes: list[str], name: str) -> tuple[dict[str, str], str]:
    """CTEs that cut the convex ring p (open list of points) of each row of ``source`` by half-planes, and the last one's name."""
    out, last = {}, source
    for k, plane in enumerate(half_planes):
        nxt = "p[i % len(p) + 1]"
        t = "(d[i] / (d[i] - d[i % len(p) + 1]))"
        cut = f"{{'x': p[i].x + {t} * ({nxt}.x - p[i].x), 'y': p[i].y + {t} * ({nxt}.y - p[i].y)}}"
        out[f"{name}{k}d"] = f"{ONCE}SELECT *, list_transform(p, lambda q: {plane}) AS d FROM {last}"
        out[f"{name}{k}"] = f"""{ONCE}SELECT * EXCLUDE (d) REPLACE (flatten(list_transform(range(1, len(p) + 1), lambda i:
          CASE WHEN d[i] >= 0 AND d[i % len(p) + 1] >= 0 THEN [{nxt}] WHEN d[i] >= 0 THEN [{cut}]
            WHEN d[i % len(p) + 1] >= 0 THEN [{cut}, {nxt}] ELSE [] END)) AS p) FROM {name}{k}d"""
        last = f"{name}{k}"
    return out, last


AREA = "abs(coalesce(list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i].x * p[i % len(p) + 1].y - p[i % len(p) + 1].x * p[i].y)), 0)) / 2"

CTES["skew"] = f"""
SELECT Id, x0, y0, x1, y1, ends_with(Id, '-v2') AS two, 1 AS sign, {points(_skew_ring(0.0))} AS p FROM cat"""
_BOTH, _last = clipped("skew_two", left_of(_skew_ring(1.0)), "both")
#: Signed convex shapes that make up each slanted footprint; two-part ones are both parts less what they share.
SHAPES = {
    "skew_two": "SELECT * FROM skew WHERE two",
    **_BOTH,
    "shape": f"""SELECT * FROM skew UNION ALL SELECT * REPLACE ({points(_skew_ring(1.0))} AS p) FROM skew WHERE two
      UNION ALL SELECT * REPLACE (-1 AS sign) FROM {_last}""",
}
LAND_SIDES = ["q.x - lx0", "lx1 - q.x", "q.y - ly0", "ly1 - q.y"]

#: The catalog with its GRDH products as RAW_ ones, of level 0 for even events and of level 1 for odd ones.
CTES["raw_cat"] = "SELECT * REPLACE (replace(Name, 'GRDH_1S', CASE WHEN event_id % 2 = 0 THEN 'RAW__0S' ELSE 'RAW__1S' END) AS Name) FROM cat"

_ORDER = [
    "prod", "cat", "raw_cat", "req", "hits", "latest", "land", "skew", "sea", "file", "listing", "src", "matched", "nm", "spots", "located",
    "xfer", "obj", "other",
]
_NEEDS = {
    "cat": ["prod"], "raw_cat": ["cat"], "hits": ["req", "cat"], "latest": ["hits"], "sea": ["cat", "land"], "skew": ["cat"], "file": ["prod"],
    "listing": ["prod"], "src": ["listing"], "matched": ["src", "cat"], "nm": ["listing"], "spots": ["nm"],
    "located": ["listing", "spots", "file"], "obj": ["prod"],
}


def _closure(names: list[str]) -> set[str]:
    wanted, queue = set(), list(names)
    while queue:
        n = queue.pop()
        if n not in wanted:
            wanted.add(n)
            queue += _NEEDS.get(n, [])
    return wanted


def sql(needs: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the derived tables it needs in front, then its own extra tables."""
    wanted = _closure(needs)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _ORDER if n in wanted]
    kept = lambda text: "MATERIALIZED " if text.startswith(ONCE) else ""
    parts += [f"{n} AS {kept(text)}({text}\n)" for n, text in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body
