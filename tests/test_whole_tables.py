"""Queries over whole tables, for which SQL would be too slow, against brute force."""

import numpy as np

from habitra.plans import catalog


def places(spark, sf):
    rows = catalog.projected(spark, sf).select("id", "species", "x", "y").collect()
    return rows, np.array([r.x for r in rows]), np.array([r.y for r in rows])


def test_a_chip_for_every_point(spark, sf):
    rows, x, y = places(spark, sf)
    ids = np.array([r.id for r in rows])
    want = {}
    for r in rows:
        near = (x >= r.x - 1500) & (x <= r.x + 1500) & (y >= r.y - 1500) & (y <= r.y + 1500)
        want[r.id] = (int(near.sum()), int(ids[near].sum()))
    assert len(want) == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert {r.point: (r.n, r.total) for r in catalog.QUERIES["chip_range_join"](spark, sf).collect()} == want


def test_mean_distance_of_every_point(spark, sf):
    rows, x, y = places(spark, sf)
    species = np.array([r.species for r in rows])
    got = {r.id: (r.species, r.mean_euclidean_dist) for r in catalog.QUERIES["pairwise_mean_distance_all"](spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own = species == r.species
        assert got[r.id][0] == r.species and abs(got[r.id][1] - np.hypot(x[own] - r.x, y[own] - r.y).mean()) < 0.006


def test_sampled_places_are_reckoned_once(spark, sf):
    plan = catalog.sampled_distances(spark, sf)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "parquet" in plan and "atanh" not in plan  # they are read from files, not projected again by every reader


def test_presence_and_absence_share_the_candidates(spark, sf, monkeypatch):
    calls, plain = [], catalog.candidate_table
    monkeypatch.setattr(catalog, "candidate_table", lambda s, d: calls.append(d) or plain(s, d))
    catalog.QUERIES["union_presence_absence"](spark, sf)
    assert calls == [sf]


def test_absences_join_observations_once(spark, sf, monkeypatch):
    calls, plain = [], catalog.S.obs
    monkeypatch.setattr(catalog.S, "obs", lambda s, d: calls.append(d) or plain(s, d))
    catalog.QUERIES["pseudo_absence"](spark, sf)
    assert calls == [sf]


def test_candidates_ask_one_distance_of_a_group(spark, sf, monkeypatch):
    def each(*_, **__):
        raise AssertionError("every point looks for its own mean")

    monkeypatch.setattr(catalog.occurrences, "mean_distance", each)
    assert catalog.QUERIES["sample_per_group"](spark, sf).count() > 0
