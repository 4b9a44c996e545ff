"""Neighbours and synthetic rows against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from loanlark.operators import neighbours, resampling


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 10, (6, 4))
    rows = []
    for i in range(400):
        v = centres[i % 6] + rng.normal(0, 0.5, 4)
        rows.append((i, int(i % 9 == 0), [float(x) for x in v]))
    # a third of the minority are copies of one row
    rows += [(1000 + i, 1, rows[0][2]) for i in range(15)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame(points, "id long, y int, v array<double>")


def brute(queries, candidates, k):
    out = {}
    for i, _, v in queries:
        ds = sorted(
            (float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j)
            for j, _, w in candidates
            if j != i
        )
        out[i] = [(j, d) for d, j in ds[:k]]
    return out


def check(got, want):
    found = {}
    for r in got.orderBy("id", "rank").collect():
        found.setdefault(r["id"], []).append((r["neighbour"], r["distance"]))
    assert found.keys() == want.keys()
    for i, rows in want.items():
        assert [j for j, _ in found[i]] == [j for j, _ in rows]
        assert [d for _, d in found[i]] == pytest.approx([d for _, d in rows], abs=1e-9)


@pytest.mark.parametrize("pivot_rows,block", [(2000, 4096), (20, 4096), (20, 16)])
def test_neighbours_are_exact(frame, points, monkeypatch, pivot_rows, block):
    monkeypatch.setattr(neighbours, "ROWS_PER_LEAF", pivot_rows)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    minority = [p for p in points if p[1] == 1]
    near = neighbours.nearest_neighbours(frame.filter("y = 1"), frame, "id", "v", 5)
    check(near, brute(minority, points, 5))


def test_leaves_prune_candidates(frame, points, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_LEAF", 20)
    rows = neighbours._pairs_of(frame, "id", "v")
    tree = neighbours.plant(rows, len(points))
    sizes, radii = neighbours.leaf_table(neighbours.placed(rows, tree), len(tree.centres))
    asked = neighbours.placed(neighbours._pairs_of(frame.filter("y = 1"), "id", "v"), tree)
    # the distances of the k-th neighbours are not known: sizes and far ends of leaves bound them
    sent = neighbours.sent_on(asked.selectExpr("*", "double('inf') as far"), tree, sizes, radii, 5)
    assert len(tree.centres) > 5
    assert sent.count() < 0.5 * asked.count() * len(tree.centres)


def test_smote_rows_lie_between_parents(frame, points):
    made = resampling.smote(frame, "y", "id", "v", ratio=0.5)
    rows = made.collect()
    majority = sum(1 for p in points if p[1] == 0)
    minority = len(points) - majority
    assert len(rows) == int(0.5 * majority - minority)
    vectors = {i: np.array(v) for i, _, v in points}
    near = brute([p for p in points if p[1] == 1], [p for p in points if p[1] == 1], 5)
    for r in rows:
        assert r["neighbour"] in [j for j, _ in near[r["parent"]]] and 0 <= r["step"] < 1
        a, b = vectors[r["parent"]], vectors[r["neighbour"]]
        assert np.allclose(r["vector"], a + r["step"] * (b - a))
    assert len({r["parent"] for r in rows}) > minority / 2
    again = resampling.smote(frame.repartition(5), "y", "id", "v", ratio=0.5)
    assert made.select("draw", "parent", "neighbour").exceptAll(
        again.select("draw", "parent", "neighbour")
    ).count() == 0


def test_adasyn_makes_more_where_the_other_class_is_near(spark, frame, points):
    minority = [p for p in points if p[1] == 1]
    labels = {i: y for i, y, _ in points}
    near = brute(minority, points, 5)
    share = {i: np.mean([labels[j] == 0 for j, _ in rows]) for i, rows in near.items()}
    got = {r["id"]: r["majority_share"] for r in resampling.adasyn_weights(frame, "y", "id", "v").collect()}
    assert got == pytest.approx(share)
    majority = len(points) - len(minority)
    wanted = int(0.5 * majority - len(minority))
    total = sum(share.values())
    made = resampling.adasyn(frame, "y", "id", "v", ratio=0.5).groupBy("parent").count().collect()
    counts = {i: int(np.rint(s / total * wanted)) for i, s in share.items()}
    assert {r["parent"]: r["count"] for r in made} == {i: c for i, c in counts.items() if c}


def test_adasyn_portions_cover_all_copies(frame, monkeypatch):
    whole = resampling.adasyn(frame, "y", "id", "v", ratio=0.5)
    monkeypatch.setattr(resampling, "COPIES_AT_ONCE", 2)
    parts = resampling.adasyn(frame, "y", "id", "v", ratio=0.5)
    assert sorted(map(tuple, whole.select("parent", "draw").collect())) == sorted(
        map(tuple, parts.select("parent", "draw").collect())
    )


def test_other_methods_change_nothing(frame, points):
    assert resampling.resample(frame, "y", "id", "v", "none").count() == len(points)


def test_impossible_requests_are_refused(frame):
    with pytest.raises(ValueError):
        resampling.smote(frame, "y", "id", "v", ratio=0.01)
    with pytest.raises(ValueError):
        resampling.smote(frame.filter("id in (0, 1, 2)"), "y", "id", "v")


@pytest.mark.parametrize("dims", [4, 64])
def test_neighbours_over_many_leaves(spark, monkeypatch, dims):
    """Exact in few and in many dimensions, and most pairs are never compared where groups exist."""
    monkeypatch.setattr(neighbours, "ROWS_PER_LEAF", 60)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    draw = np.random.default_rng(dims)
    centres = draw.normal(size=(25, dims)) * 12
    points = centres[draw.integers(0, 25, 1500)] + draw.normal(size=(1500, dims))
    points[::10] = points[0]  # copies
    points[3] = 500.0  # far from all
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vec array<double>")
    got = neighbours.nearest_neighbours(df, df, "id", "vec", 5).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.id, []).append((r.neighbour, round(r.distance, 6)))
    assert len(found) == 1500
    for i in range(1500):
        d = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        wanted = [j for j in np.lexsort((np.arange(1500), d)) if j != i][:5]
        assert [j for j, _ in found[i]] == wanted
        assert np.allclose([x for _, x in found[i]], d[wanted], atol=1e-6)

    tree = neighbours.plant(df, 1500)
    rows = neighbours.placed(df, tree)
    sizes, radii = neighbours.leaf_table(rows, len(tree.centres))
    assert len(tree.centres) > 10 and sizes.sum() == 1500
    own = np.array([sorted(np.sqrt(((points - p) ** 2).sum(axis=1)))[5] for p in points])
    asked = rows.join(spark.createDataFrame([(i, float(x)) for i, x in enumerate(own)], "id long, far double"), "id")
    sent = {r.leaf: r["count"] for r in neighbours.sent_on(asked, tree, sizes, radii, 6).groupBy("leaf").count().collect()}
    compared = int((sizes**2).sum()) + sum(n * int(sizes[leaf]) for leaf, n in sent.items())
    assert compared < 0.35 * 1500**2


def test_neighbours_of_few_and_none(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 2.0])], "id long, vec array<double>")
    got = neighbours.nearest_neighbours(df, df, "id", "vec", 5).collect()
    assert sorted((r.id, r["rank"], r.neighbour, r.distance) for r in got) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]
    assert neighbours.nearest_neighbours(df, df.limit(0), "id", "vec", 5).collect() == []


def test_adasyn_searches_twice(spark, monkeypatch):
    calls = []
    search = neighbours._nearest_to_vectors
    monkeypatch.setattr(neighbours, "_nearest_to_vectors", lambda *a: calls.append(1) or search(*a))
    draw = np.random.default_rng(5)
    rows = [(i, int(i % 9 == 0), draw.normal(size=3).tolist()) for i in range(300)]
    made = resampling.adasyn(spark.createDataFrame(rows, "id long, y int, vec array<double>"), "y", "id", "vec")
    assert made.count() > 0 and len(calls) == 2


def test_queries_are_sent_on_in_bounded_parts(spark):
    """A query that no leaf can be ruled out for goes to all of them, in batches of some MB."""

    class Rows:
        sparkSession = spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    draw = np.random.default_rng(6)
    points, centres = draw.normal(size=(2000, 64)), draw.normal(size=(100, 64))
    tree = neighbours.BallTree(centres[:1], 1, 1)
    tree.centres = centres
    run = neighbours.sent_on(Rows(), tree, np.full(100, 50), np.full(100, 99.0), 5)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(2000, np.int32)), pa.array(np.arange(2000)), pa.array(points.tolist()), pa.array(np.full(2000, 9.0))],
        names=["leaf", "id", "vec", "far"],
    )
    made = list(run(iter([batch])))
    assert max(b.nbytes for b in made) < 16 << 20
    pairs = {(i, leaf) for b in made for i, leaf in zip(b["id"].to_pylist(), b["leaf"].to_pylist())}
    assert pairs == {(i, leaf) for i in range(2000) for leaf in range(1, 100)} and sum(b.num_rows for b in made) == len(pairs)
    assert all(v == points[i].tolist() for b in made[:1] for i, v in zip(b["id"].to_pylist()[:50], b["vec"].to_pylist()[:50]))
