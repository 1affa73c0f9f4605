"""Planar geometry as Column expressions.

A geometry is ``STRUCT<kind, rings ARRAY<STRUCT<hole, pts ARRAY<STRUCT<x, y>>>>>``.
Rings keep their closing point. Coordinates are plain degrees: areas are square
degrees and the antimeridian is not special.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from swathbook.functions.names import _col


def built_once(fn):
    """Keep the expression of each set of column names: large ones take long to assemble."""
    cache: dict[tuple, Column] = {}

    @functools.wraps(fn)
    def wrapper(*args):
        if any(isinstance(a, Column) for a in args):
            return fn(*args)
        if args not in cache:
            cache[args] = fn(*args)
        return cache[args]

    return wrapper


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` may use it many times."""
    return F.get(F.transform(F.array(value), body), 0)


# --------------------------------------------------------------------- text
@built_once
def footprint_wkt(footprint: str | Column) -> Column:
    """Geometry text of a catalog footprint: after ';', trimmed, closing quote dropped."""
    text = F.trim(F.get(F.split(_col(footprint), ";"), 1))
    return F.regexp_replace(text, ".$", "")


def wkt_kind(wkt: str | Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(_col(wkt), r"^\s*([A-Za-z]+)\s*\(", 1)), F.lit(""))


def _point(text: Column) -> Column:
    return let(
        F.split(F.trim(text), r"\s+"),
        lambda xy: F.struct(
            F.get(xy, 0).try_cast("double").alias("x"), F.get(xy, 1).try_cast("double").alias("y")
        ),
    )


@built_once
def geometry_from_wkt(wkt: str | Column) -> Column:
    """Parse WKT; null when the text is no geometry.

    A ring opened by a single parenthesis follows another ring of the same
    polygon and is therefore a hole.
    """

    def parse(text: Column) -> Column:
        opening = F.regexp_extract_all(text, F.lit(r"(\(+)[^()]+\)"), F.lit(1))
        body = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
        rings = F.zip_with(
            opening,
            body,
            lambda o, b: F.struct((F.length(o) < 2).alias("hole"), F.transform(F.split(b, ","), _point).alias("pts")),
        )
        return let(F.struct(wkt_kind(text).alias("kind"), rings.alias("rings")), checked)

    def checked(g: Column) -> Column:
        areal = g["kind"].isin("POLYGON", "MULTIPOLYGON")
        outlines = F.when(areal, g["rings"]).otherwise(
            F.transform(g["rings"], lambda r: F.struct(F.lit(False).alias("hole"), r["pts"].alias("pts")))
        )
        bad = F.exists(g["rings"], lambda r: F.exists(r["pts"], lambda p: p["x"].isNull() | p["y"].isNull()))
        good = g["kind"].isNotNull() & (F.size(g["rings"]) > 0) & ~bad
        return F.when(good, F.struct(g["kind"].alias("kind"), outlines.alias("rings")))

    return let(_col(wkt), parse)


def ring_text(pts: Column) -> Column:
    return F.concat(
        F.lit("("),
        F.array_join(
            F.transform(pts, lambda p: F.concat_ws(" ", _number(p["x"]), _number(p["y"]))), ", "
        ),
        F.lit(")"),
    )


def _number(v: Column) -> Column:
    return F.regexp_replace(v.cast("string"), r"\.0$", "")


@built_once
def geometry_to_wkt(geom: str | Column) -> Column:
    """WKT of a POINT, POLYGON or MULTIPOLYGON geometry."""
    geom = _col(geom)
    rings = geom["rings"]
    joined = F.array_join(
        F.transform(
            rings,
            lambda r, i: F.concat(
                F.when(i == 0, "").when(r["hole"], ", ").otherwise("), ("), ring_text(r["pts"])
            ),
        ),
        "",
    )
    return (
        F.when(geom["kind"] == "POINT", F.concat(F.lit("POINT "), ring_text(rings[0]["pts"])))
        .when(geom["kind"] == "POLYGON", F.concat(F.lit("POLYGON ("), joined, F.lit(")")))
        .when(geom["kind"] == "MULTIPOLYGON", F.concat(F.lit("MULTIPOLYGON (("), joined, F.lit("))")))
    )


# --------------------------------------------------------------------- boxes
def all_points(geom: Column) -> Column:
    return F.flatten(F.transform(geom["rings"], lambda r: r["pts"]))


@built_once
def bbox(geom: str | Column) -> Column:
    """``STRUCT<x0, y0, x1, y1>`` of a geometry."""

    def limits(pts: Column) -> Column:
        xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
        return F.when(
            F.size(pts) > 0,
            F.struct(
                F.array_min(xs).alias("x0"),
                F.array_min(ys).alias("y0"),
                F.array_max(xs).alias("x1"),
                F.array_max(ys).alias("y1"),
            ),
        )

    return let(all_points(_col(geom)), limits)


def box_wkt(x0, y0, x1, y1) -> Column:
    """WKT of an axis-parallel rectangle."""
    c = {k: _number(_col(v)) for k, v in dict(x0=x0, y0=y0, x1=x1, y1=y1).items()}
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    pts = [F.concat(c[a], F.lit(" "), c[b]) for a, b in corners]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *pts), F.lit("))"))


def boxes_overlap(a: Column, b: Column) -> Column:
    """Boxes share at least a boundary point."""
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


@built_once
def is_box(geom: str | Column) -> Column:
    """The geometry is one axis-parallel rectangle without holes."""

    def test(g: Column) -> Column:
        pts = F.get(g["rings"], 0)["pts"]

        def square(box: Column) -> Column:
            corners = F.forall(
                pts,
                lambda p: ((p["x"] == box["x0"]) | (p["x"] == box["x1"]))
                & ((p["y"] == box["y0"]) | (p["y"] == box["y1"])),
            )
            whole = F.abs(ring_area(pts)) == (box["x1"] - box["x0"]) * (box["y1"] - box["y0"])
            return corners & whole

        return F.when((F.size(g["rings"]) == 1) & (F.size(pts) == 5), let(bbox(g), square)).otherwise(False)

    return let(_col(geom), lambda g: F.when(g.isNotNull(), test(g)))


def cells(box: Column, degrees: float) -> Column:
    """Grid cells ``STRUCT<cx, cy>`` touched by a box."""

    def span(lo: str, hi: str) -> Column:
        return F.sequence(_cell(box[lo], degrees), _cell(box[hi], degrees))

    grid = F.flatten(
        F.transform(
            span("x0", "x1"),
            lambda cx: F.transform(
                span("y0", "y1"), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))
            ),
        )
    )
    return F.when(box.isNotNull(), grid)


def _cell(v: Column, degrees: float) -> Column:
    return F.floor(v / F.lit(float(degrees))).cast("int")


def shared_cell(a: Column, b: Column, degrees: float) -> Column:
    """The one cell in which a pair of overlapping boxes is reported.

    It holds the lower left corner of the common box, so a pair met in several
    cells is kept exactly once and no distinct is needed afterwards.
    """
    return F.struct(
        _cell(F.greatest(a["x0"], b["x0"]), degrees).alias("cx"),
        _cell(F.greatest(a["y0"], b["y0"]), degrees).alias("cy"),
    )


@built_once
def footprint_geometry(footprint: str) -> Column:
    """``STRUCT<geom, box>`` of a catalog footprint."""
    geom = geometry_from_wkt(footprint_wkt(footprint))
    return let(geom, lambda g: F.struct(g.alias("geom"), bbox(g).alias("box")))


@built_once
def repaired_geometry(column: str, is_footprint: bool) -> Column:
    """``STRUCT<geom, box, is_box>`` of the mended geometry in a WKT or footprint column."""
    geom = geometry_from_wkt(footprint_wkt(column) if is_footprint else F.col(column))
    return let(
        repair(geom)["geom"],
        lambda g: F.struct(g.alias("geom"), bbox(g).alias("box"), is_box(g).alias("is_box")),
    )


# --------------------------------------------------------------------- rings
def _edge_indices(pts: Column) -> Column:
    """Indices 0..n-2 of the edges of a closed ring (empty below two points)."""
    return F.when(F.size(pts) >= 2, F.sequence(F.lit(0), F.size(pts) - 2)).otherwise(
        F.array().cast("array<int>")
    )


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def ring_area(pts: Column) -> Column:
    """Signed area (counter-clockwise positive) of a closed or open ring."""

    def add(acc: Column, i: Column) -> Column:
        p, q = F.get(pts, i), F.get(pts, (i + 1) % F.size(pts))
        o = F.get(pts, F.lit(0))
        return acc + _cross(o, p, q) / 2.0

    return F.aggregate(_edge_indices(pts), F.lit(0.0), add)


@built_once
def area(geom: str | Column) -> Column:
    """Exteriors minus holes. Parts of a MULTIPOLYGON are taken as non-overlapping here."""
    return F.aggregate(
        _col(geom)["rings"],
        F.lit(0.0),
        lambda acc, r: acc + F.when(r["hole"], -1.0).otherwise(1.0) * F.abs(ring_area(r["pts"])),
    )


def _on_segment(p: Column, a: Column, b: Column) -> Column:
    return (
        (_cross(a, b, p) == 0.0)
        & p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
        & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
    )


def _on_boundary(p: Column, pts: Column) -> Column:
    return F.exists(_edge_indices(pts), lambda i: _on_segment(p, F.get(pts, i), F.get(pts, i + 1)))


def _encloses(p: Column, pts: Column) -> Column:
    """Even-odd crossing test, boundary undefined."""

    def flip(inside: Column, i: Column) -> Column:
        a, b = F.get(pts, i), F.get(pts, i + 1)
        straddles = (a["y"] > p["y"]) != (b["y"] > p["y"])
        at_x = a["x"] + (p["y"] - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) * (b["x"] - a["x"])
        return F.when(straddles & (p["x"] < at_x), ~inside).otherwise(inside)

    return F.aggregate(_edge_indices(pts), F.lit(False), flip)


def covers_point(geom: Column, p: Column) -> Column:
    """The point lies inside the polygon geometry or on its boundary."""
    boundary = F.exists(geom["rings"], lambda r: _on_boundary(p, r["pts"]))
    depth = F.aggregate(
        geom["rings"],
        F.lit(0),
        lambda acc, r: acc
        + F.when(_encloses(p, r["pts"]), F.when(r["hole"], -1).otherwise(1)).otherwise(0),
    )
    return boundary | (depth > 0)


def _segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Closed segments ab and cd share a point."""
    boxes = (
        (F.least(a["x"], b["x"]) <= F.greatest(c["x"], d["x"]))
        & (F.least(c["x"], d["x"]) <= F.greatest(a["x"], b["x"]))
        & (F.least(a["y"], b["y"]) <= F.greatest(c["y"], d["y"]))
        & (F.least(c["y"], d["y"]) <= F.greatest(a["y"], b["y"]))
    )
    return (
        boxes
        & (F.signum(_cross(a, b, c)) * F.signum(_cross(a, b, d)) <= 0)
        & (F.signum(_cross(c, d, a)) * F.signum(_cross(c, d, b)) <= 0)
    )


def _rings_meet(p: Column, q: Column) -> Column:
    return F.exists(
        _edge_indices(p),
        lambda i: F.exists(
            _edge_indices(q),
            lambda j: _segments_meet(F.get(p, i), F.get(p, i + 1), F.get(q, j), F.get(q, j + 1)),
        ),
    )


@built_once
def intersects(a: str | Column, b: str | Column) -> Column:
    """Polygon or point geometries share at least one point."""
    a, b = _col(a), _col(b)
    meet = F.exists(a["rings"], lambda r: F.exists(b["rings"], lambda s: _rings_meet(r["pts"], s["pts"])))
    b_in_a = F.exists(b["rings"], lambda s: covers_point(a, F.get(s["pts"], 0)))
    a_in_b = F.exists(a["rings"], lambda r: covers_point(b, F.get(r["pts"], 0)))
    return (
        F.when(b["kind"] == "POINT", covers_point(a, b["rings"][0]["pts"][0]))
        .when(a["kind"] == "POINT", covers_point(b, a["rings"][0]["pts"][0]))
        .otherwise(meet | b_in_a | a_in_b)
    )


@built_once
def exterior_only(geom: str | Column) -> Column:
    """The geometry without its holes."""
    geom = _col(geom)
    return F.when(
        geom.isNotNull(),
        F.struct(
            geom["kind"].alias("kind"), F.filter(geom["rings"], lambda r: ~r["hole"]).alias("rings")
        ),
    )


# --------------------------------------------------------------------- validity and repair
def _self_crossing(pts: Column) -> Column:
    """Two edges that are not neighbours share a point."""
    n = F.size(pts) - 1
    return F.exists(
        _edge_indices(pts),
        lambda i: F.exists(
            _edge_indices(pts),
            lambda j: (j > i + 1)
            & ~((i == 0) & (j == n - 1))
            & _segments_meet(F.get(pts, i), F.get(pts, i + 1), F.get(pts, j), F.get(pts, j + 1)),
        ),
    )


@built_once
def is_valid(geom: str | Column) -> Column:
    """Every polygon ring is closed, has four points or more, an area, and does not cross itself."""
    geom = _col(geom)

    def good(r: Column) -> Column:
        pts = r["pts"]
        return (
            (F.size(pts) >= 4)
            & (F.get(pts, 0) == F.element_at(pts, -1))
            & (ring_area(pts) != 0.0)
            & ~_self_crossing(pts)
        )

    areal = geom["kind"].isin("POLYGON", "MULTIPOLYGON")
    return F.when(geom.isNotNull(), F.when(areal, F.forall(geom["rings"], good)).otherwise(True))


@built_once
def repair(geom: str | Column) -> Column:
    """``STRUCT<geom, repaired>``: repeated points dropped, rings closed, exteriors counter-clockwise.

    Rings without area disappear. A ring that crosses itself cannot be mended by
    these steps and leaves ``repaired`` false.
    """

    def clean(r: Column) -> Column:
        pts = F.filter(
            r["pts"], lambda p, i: (i == 0) | (p != F.get(r["pts"], F.greatest(i - 1, F.lit(0))))
        )
        closed = let(
            pts,
            lambda c: F.when(F.get(c, 0) == F.element_at(c, -1), c).otherwise(F.concat(c, F.slice(c, 1, 1))),
        )
        turned = let(
            closed, lambda c: F.when((ring_area(c) < 0) != r["hole"], F.reverse(c)).otherwise(c)
        )
        return F.struct(r["hole"].alias("hole"), turned.alias("pts"))

    def mend(g: Column) -> Column:
        rings = F.filter(
            F.transform(g["rings"], clean), lambda r: (F.size(r["pts"]) >= 4) & (ring_area(r["pts"]) != 0.0)
        )
        fixed = F.struct(g["kind"].alias("kind"), rings.alias("rings"))
        judged = let(
            fixed,
            lambda f: F.struct(f.alias("geom"), ((F.size(f["rings"]) > 0) & is_valid(f)).alias("repaired")),
        )
        return F.when(g.isNotNull(), judged)

    return let(_col(geom), mend)


# --------------------------------------------------------------------- common area
def box_overlap_area(a: Column, b: Column) -> Column:
    width = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    height = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def _clip(poly: Column, a: Column, b: Column) -> Column:
    """Part of an open ring on the left of the line a to b."""

    def step(i: Column) -> Column:
        p, q = F.get(poly, i), F.get(poly, (i + 1) % F.size(poly))
        side = F.struct(p.alias("p"), q.alias("q"), _cross(a, b, p).alias("dp"), _cross(a, b, q).alias("dq"))

        def emit(s: Column) -> Column:
            t = s["dp"] / F.nullif(s["dp"] - s["dq"], F.lit(0.0))
            at = F.struct(
                (s["p"]["x"] + t * (s["q"]["x"] - s["p"]["x"])).alias("x"),
                (s["p"]["y"] + t * (s["q"]["y"] - s["p"]["y"])).alias("y"),
            )
            here, there = s["dp"] >= 0, s["dq"] >= 0
            return (
                F.when(here & there, F.array(s["q"]))
                .when(here, F.array(at))
                .when(there, F.array(at, s["q"]))
                .otherwise(F.slice(F.array(s["q"]), 1, 0))
            )

        return let(side, emit)

    steps = F.when(F.size(poly) > 0, F.sequence(F.lit(0), F.size(poly) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.flatten(F.transform(steps, step))


def ring_overlap_area(p: Column, q: Column) -> Column:
    """Common area of two simple closed rings.

    The first ring is split into the signed triangles of a fan; the second is
    clipped by each triangle, and the signed areas add up.
    """
    open_q = F.slice(q, F.lit(1), F.size(q) - 1)
    fan = F.when(F.size(p) >= 4, F.sequence(F.lit(1), F.size(p) - 3)).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, i: Column) -> Column:
        o, a, b = F.get(p, F.lit(0)), F.get(p, i), F.get(p, i + 1)
        turn = F.signum(_cross(o, a, b))
        left = lambda u, v: F.struct(u.alias("a"), v.alias("b"))
        sides = F.when(turn > 0, F.array(left(o, a), left(a, b), left(b, o))).otherwise(
            F.array(left(o, b), left(b, a), left(a, o))
        )
        clipped = F.aggregate(sides, open_q, lambda poly, s: _clip(poly, s["a"], s["b"]))
        return acc + F.when(turn == 0, 0.0).otherwise(turn * let(clipped, ring_area))

    return F.abs(F.aggregate(fan, F.lit(0.0), add))


@built_once
def overlap_area(a: str | Column, b: str | Column) -> Column:
    """Common area of two polygon geometries whose own parts do not overlap."""
    a, b = _col(a), _col(b)

    def sign(r: Column) -> Column:
        return F.when(r["hole"], -1.0).otherwise(1.0)

    return F.aggregate(
        a["rings"],
        F.lit(0.0),
        lambda acc, r: acc
        + F.aggregate(
            b["rings"],
            F.lit(0.0),
            lambda sub, s: sub + sign(r) * sign(s) * ring_overlap_area(r["pts"], s["pts"]),
        ),
    )
