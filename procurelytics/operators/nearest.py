"""Nearest site of every point out of a table of sites, exact and without pairs of all rows.

Places are points of the unit sphere; straight-line distance orders them as distance along the ground
does, and space has neither poles nor a date line.  The sites are indexed by cubes, coarse to fine: a
cube keeps the box of its sites and one of them.  Every distinct place goes down the levels with the
cubes that may still hold its nearest site: those whose box is no farther than the nearest site seen so
far.  What is left at the finest level is compared site by site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.functions.geo import haversine_km
from procurelytics.session import cut_lineage

#: Halvings of the unit cube's sides per level: 3,200 km at first, 3 km at last.
LEVELS = (2, 4, 6, 8, 10, 12)
#: Straight-line distances (in radii of the earth) this near each other may be equal: both stay.
SLACK = 1e-9
AXES = ("x", "y", "z")


def _on_sphere(lat: str, lon: str) -> list[Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    return [(F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z")]


def _known(lat: Column, lon: Column) -> Column:
    finite = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in (lat, lon)]
    return finite[0] & finite[1]


def _cube(level: int) -> Column:
    """Number of the cube that holds (x, y, z); sides of 2 / 2**level."""
    at = [F.least(F.floor((F.col(a) + 1) * 2.0 ** (level - 1)), F.lit(2**level - 1)).cast("long") for a in AXES]
    return (at[0] * F.lit(2 ** (2 * level)) + at[1] * F.lit(2**level) + at[2]).cast("long")


def _apart(*differences: Column) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, (d * d for d in differences)))


def _nearest_possible(box: Column | None = None) -> Column:
    """Distance of the place (px, py, pz) to a box."""
    at = (lambda name: F.col(name)) if box is None else (lambda name: box[name])
    return _apart(*[F.greatest(at(f"lo_{a}") - F.col(f"p{a}"), F.col(f"p{a}") - at(f"hi_{a}"), F.lit(0.0)) for a in AXES])


def _nearest_seen(box: Column | None = None) -> Column:
    at = (lambda name: F.col(name)) if box is None else (lambda name: box[name])
    return _apart(*[at(f"rep_{a}") - F.col(f"p{a}") for a in AXES])


def _index(places: DataFrame, levels) -> DataFrame:
    """(level, parent, cube, box, one site) of every cube that holds a site: at most one row per place and level."""
    parts = []
    for parent, level in zip((0, *levels), levels):
        above = _cube(parent) if parent else F.lit(0).cast("long")
        parts.append(places.groupBy(F.lit(level).alias("level"), above.alias("parent"), _cube(level).alias("cube")).agg(
            *[F.min(a).alias(f"lo_{a}") for a in AXES], *[F.max(a).alias(f"hi_{a}") for a in AXES],
            F.min_by(F.struct(*AXES), F.struct(*AXES)).alias("rep"),
        ).select("level", "parent", "cube", *[f"{e}_{a}" for e in ("lo", "hi") for a in AXES], *[F.col(f"rep.{a}").alias(f"rep_{a}") for a in AXES]))
    return reduce(DataFrame.unionByName, parts)


def nearest_site(points: DataFrame, sites: DataFrame, *, lat="lat", lon="lon", site="site", site_lat="lat", site_lon="lon", levels=LEVELS) -> DataFrame:
    """``points`` with nearest_site and nearest_km, the great-circle distance to it.

    Sites at equal distances: the least name.  A point without finite coordinates, and every point when
    there is no site, has NULL in both; sites without name or finite coordinates take no part.  Other
    columns pass through, apart from columns with the two added names, which are replaced; repeated
    points and sites are looked up once.

    Work follows the distinct places of the points times the few cubes a place still has to look at, not
    points times sites; many sites within one of the finest cubes (3 km) are compared one by one, so a
    denser table wants more ``levels``.  Joins are by cube; Spark broadcasts an index it finds small, and
    splits a hot cube otherwise."""
    if not levels or list(levels) != sorted(set(levels)) or not 1 <= levels[0] <= levels[-1] <= 20:
        raise ValueError(f"levels must rise from 1 or more to 20 at most, not {levels!r}")
    named = sites.select(F.col(f"`{site}`").alias("site"), F.col(f"`{site_lat}`").cast("double").alias("slat"), F.col(f"`{site_lon}`").cast("double").alias("slon"))
    places = cut_lineage(named.where(F.col("site").isNotNull() & _known(F.col("slat"), F.col("slon"))).groupBy("slat", "slon").agg(F.min("site").alias("site"))
                         .select("*", *_on_sphere("slat", "slon")))
    index = cut_lineage(_index(places, levels))

    names = [c for c in points.columns if c not in ("nearest_site", "nearest_km")]
    rows = points.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{lat}`").cast("double").alias("plat"), F.col(f"`{lon}`").cast("double").alias("plon"))
    asked = rows.select("plat", "plon").where(_known(F.col("plat"), F.col("plon"))).distinct()
    asked = asked.select("plat", "plon", *[c.alias(f"p{a}") for c, a in zip(_on_sphere("plat", "plon"), AXES)])

    # the first level is one array of at most 8**levels[0] cubes, so every place meets it inside its own row
    first = index.where(F.col("level") == levels[0]).agg(F.collect_list(F.struct("cube", *[f"{e}_{a}" for e in ("lo", "hi", "rep") for a in AXES])).alias("cubes"))
    seen = asked.withColumn("boxes", first.scalar()).withColumn(
        "boxes", F.transform("boxes", lambda b: F.struct(b["cube"].alias("cube"), _nearest_possible(b).alias("least"), _nearest_seen(b).alias("most"))))
    seen = seen.withColumn("bound", F.array_min(F.transform("boxes", lambda b: b["most"])))
    key = ["plat", "plon", "px", "py", "pz"]
    for level in levels[1:]:
        below = index.where(F.col("level") == level).drop("level").withColumnRenamed("cube", "child")
        seen = (_left(seen, key).join(below, F.col("cube") == F.col("parent"))
                .groupBy(*key).agg(F.min(_nearest_seen()).alias("bound"),
                                   F.collect_list(F.struct(F.col("child").alias("cube"), _nearest_possible().alias("least"))).alias("boxes")))
    leaves = places.select("site", "slat", "slon", _cube(levels[-1]).alias("leaf"))
    found = (_left(seen, key).join(leaves, F.col("cube") == F.col("leaf"))
             .groupBy("plat", "plon").agg(F.min(F.struct(haversine_km(F.col("plat"), F.col("plon"), F.col("slat"), F.col("slon")).alias("km"), "site")).alias("best")))
    return rows.join(found, ["plat", "plon"], "left").select("_row.*", F.col("best.site").alias("nearest_site"), F.col("best.km").alias("nearest_km"))


def _left(seen: DataFrame, key) -> DataFrame:
    """One row per place and cube that may hold its nearest site."""
    return seen.select(*key, F.explode(F.filter("boxes", lambda b: b["least"] <= F.col("bound") + SLACK)).alias("box")).select(*key, "box.cube")
