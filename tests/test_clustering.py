"""Duration clusters against a plain fold."""

import random

import pytest

from dupelens.operators import clustering


def fold(durations, tolerance, anchored):
    clusters, current = [], []
    for d in sorted(durations):
        if current and d <= (current[0] if anchored else current[-1]) + tolerance:
            current.append(d)
        else:
            clusters.append(current)
            current = [d]
    clusters.append(current)
    return {(c[0], len(c)) for c in clusters if len(c) > 1}


def sample(kind, n=400, seed=7):
    rnd = random.Random(seed)
    if kind == "sparse":
        return [float(rnd.randrange(1, 6000)) for _ in range(n)]
    if kind == "dense":
        return [float(rnd.randrange(1, 300)) for _ in range(n)]
    if kind == "doubles":
        return [rnd.uniform(1, 900) for _ in range(n)]
    if kind == "hot":
        return [30.0] * (n // 3) + [float(rnd.randrange(1, 900)) for _ in range(n)]
    return [rnd.randrange(1, 40000) / 8 for _ in range(n)]


@pytest.mark.parametrize("kind", ["sparse", "dense", "hot", "eighths", "doubles"])
def test_clusters_equal_a_plain_fold(spark, kind):
    values = sample(kind)
    records = spark.createDataFrame([(v,) for v in values], "duration double")
    durations = clustering.Durations(records)
    for anchored, build in ((True, clustering.anchored_clusters), (False, clustering.gap_clusters)):
        rows = build(durations, 5.0).collect()
        found = {(r["cluster_start"], r["cluster_size"]) for r in rows}
        assert found == fold(values, 5.0, anchored)
        if anchored:
            assert all(r["duration"] - r["cluster_start"] <= 5.0 for r in rows)


def test_anchored_and_chained_differ_as_described(spark):
    durations = clustering.Durations(spark.createDataFrame([(0.0,), (4.0,), (8.0,)], "duration double"))
    anchored = {(r["duration"], r["cluster_start"]) for r in clustering.anchored_clusters(durations).collect()}
    chained = {(r["duration"], r["cluster_start"]) for r in clustering.gap_clusters(durations).collect()}
    assert anchored == {(0.0, 0.0), (4.0, 0.0)}
    assert chained == {(0.0, 0.0), (4.0, 0.0), (8.0, 0.0)}


def test_empty_input(spark):
    durations = clustering.Durations(spark.createDataFrame([], "duration double"))
    assert clustering.anchored_clusters(durations).count() == 0
    assert clustering.blocking_reduction(durations, [5]).collect()[0]["comparisons"] == 0


@pytest.mark.parametrize(("kind", "rows"), [("sparse", 9), ("dense", 7), ("hot", 60), ("eighths", 20), ("doubles", 1)])
def test_clusters_do_not_depend_on_the_cells(spark, monkeypatch, kind, rows):
    monkeypatch.setattr(clustering, "CELL_ROWS", rows)
    monkeypatch.setattr(clustering, "MOST_CELLS", 80)
    values = sample(kind, 150)
    durations = clustering.Durations(spark.createDataFrame([(v,) for v in values], "duration double"))
    assert durations.cells > 1
    for anchored, build in ((True, clustering.anchored_clusters), (False, clustering.gap_clusters)):
        found = {(r["cluster_start"], r["cluster_size"]) for r in build(durations, 5.0).collect()}
        assert found == fold(values, 5.0, anchored)


def test_one_long_island_takes_few_rounds(spark, monkeypatch):
    """Every duration is within the tolerance of the next, so that all cells belong to one island."""
    monkeypatch.setattr(clustering, "CELL_ROWS", 20)
    written = []
    plain = clustering.materialize
    monkeypatch.setattr(clustering, "materialize", lambda df, name: (written.append(name), plain(df, name))[1])
    values = [i * 1.5 for i in range(300)]
    durations = clustering.Durations(spark.createDataFrame([(v,) for v in values], "duration double"))
    found = {(r["cluster_start"], r["cluster_size"]) for r in clustering.anchored_clusters(durations, 5.0).collect()}
    assert found == fold(values, 5.0, True)
    # Fifteen cells: four rounds, of which the last needs no further jump table.
    assert written.count("cell-entries") == 5 and written.count("cell-jumps") == 4


def test_several_tolerances_in_one_pass(spark):
    values = sample("eighths", 300)
    durations = clustering.Durations(spark.createDataFrame([(v,) for v in values], "duration double"))
    rows = {r["tolerance"]: (r["clusters"], r["comparisons"]) for r in clustering.blocking_reduction(durations, [1, 5, 50]).collect()}
    for tolerance, found in rows.items():
        clusters = [n for _, n in fold(values, tolerance, False)]
        assert found == (len(clusters), sum(n * (n - 1) // 2 for n in clusters))
