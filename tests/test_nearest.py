"""Nearest sites against all pairs."""

import math
import random

import numpy as np
import pytest

from procurelytics import constants as K
from procurelytics.operators import nearest

POINT, SITE = "id long, lat double, lon double, nearest_km string", "site string, lat double, lon double"


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    c = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((math.radians(b[1]) - math.radians(a[1])) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(c))) * K.EARTH_RADIUS_KM


def run(spark, points, sites, **options):
    out = nearest.nearest_site(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), **options)
    assert out.columns == ["id", "lat", "lon", "nearest_site", "nearest_km"]
    return sorted(((r["id"], r["nearest_site"], r["nearest_km"]) for r in out.collect()), key=repr)


def check(spark, points, sites, **options):
    got = run(spark, points, sites, **options)
    assert len(got) == len(points)
    at, where = {}, {i: (lat, lon) for i, lat, lon, _ in points}
    for name, lat, lon in sites:
        at.setdefault(name, []).append((lat, lon))
    for i, name, found in got:
        distances = [km(where[i], (lat, lon)) for _, lat, lon in sites]
        assert abs(found - min(distances)) < 1e-6 and any(abs(km(where[i], p) - found) < 1e-6 for p in at[name]), (i, name)


def test_equals_all_pairs_over_the_globe_and_in_clusters(spark):
    rng = random.Random(1)
    sites = [(f"s{i}", math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(150)]
    sites += [(f"t{i}", 48 + rng.gauss(0, 0.01), 2 + rng.gauss(0, 0.01)) for i in range(150)]  # one town
    sites += [("n", 90.0, 17.0), ("w", 0.0, -180.0), ("v", 10.0, 179.99)]
    points = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180), "") for i in range(300)]
    points += [(1000 + i, 48 + rng.gauss(0, 0.5), 2 + rng.gauss(0, 0.5), "") for i in range(200)]
    points += [(2000, 90.0, 0.0, ""), (2001, -90.0, 0.0, ""), (2002, 0.0, 180.0, ""), (2003, 10.0, -180.0, ""), (2004, 0.0, 540.0, "")]
    check(spark, points, sites)
    check(spark, points, sites[:1])
    check(spark, points[:50], sites, levels=(3,))


def test_ties_repeats_and_missing_values(spark):
    nan, inf = float("nan"), float("inf")
    sites = [("b", 1.0, 1.0), ("a", 1.0, 1.0), ("a", 1.0, 1.0), (None, 0.0, 0.0), ("c", None, 0.0), ("c", nan, 0.0), ("c", 0.0, inf), ("d", 0.0, 10.0), ("e", 0.0, -10.0)]
    points = [(1, 1.0, 1.0, "x"), (1, 1.0, 1.0, "x"), (2, None, 1.0, None), (3, nan, 1.0, None), (None, 0.0, 9.0, None), (4, -inf, 0.0, None), (5, -60.0, 0.0, None)]
    got = {i: n for i, n, _ in run(spark, points, [s for s in sites if s[0] not in ("a", "b")])}
    assert got == {1: "d", 2: None, 3: None, None: "d", 4: None, 5: "d"}  # d and e lie equally far from the fifth
    got = dict((i, (n, d)) for i, n, d in run(spark, points, sites))
    assert got[1] == ("a", 0.0) and got[2] == got[3] == got[4] == (None, None) and got[None][0] == "d"
    assert len(run(spark, points, sites)) == 7
    assert run(spark, points[:2], []) == [(1, None, None)] * 2 and run(spark, [], sites) == []
    with pytest.raises(ValueError):
        nearest.nearest_site(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), levels=(4, 2))


def test_hot_place_is_looked_up_once_and_no_pairs_are_formed(spark, capsys):
    rng = np.random.default_rng(2)
    sites = [(f"s{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(-60, 60, 2000), rng.uniform(-180, 180, 2000)))]
    points = [(i, 5.0, 5.0, "") for i in range(5000)] + [(9000 + i, float(a), float(o), "") for i, (a, o) in enumerate(zip(rng.uniform(-60, 60, 500), rng.uniform(-180, 180, 500)))]
    out = nearest.nearest_site(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE))
    out.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    best = min((km((5.0, 5.0), s[1:]), s[0]) for s in sites)
    got = {(r["nearest_site"], round(r["nearest_km"], 6)) for r in out.where("id < 5000").collect()}
    assert got == {(best[1], round(best[0], 6))}
