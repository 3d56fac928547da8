"""Predictions of saved tree models compared with routes through their node tables."""

import random

import pytest

from tripspark.operators import ml, tree_check


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(2000):
        a, b, c = rng.uniform(0, 10), float(rng.randrange(5)), rng.gauss(0, 1)
        rows.append((a, b, c, 2 * a + (3 if b > 2 else -1) * c + rng.gauss(0, 0.1)))
    rows += [(1.0, 2.0, 0.5, 7.0)] * 20  # repeated rows
    return ml.assemble_features(spark.createDataFrame(rows, "a double, b double, c double, label double"), ["a", "b", "c"])


def test_boosted_trees_and_their_first_leaves(spark, frame, tmp_path):
    model = ml.gbt_regressor("label", maxIter=5).fit(frame)
    path = ml.save_model(model, str(tmp_path / "gbt"))
    trees = tree_check.read_trees(spark, path)
    assert len(trees) == 5 and [t.weight for t in trees] == list(model.treeWeights) and max(t.depth() for t in trees) <= 5
    r = tree_check.compare_routes(model.transform(frame), trees, mean=False).collect()[0]
    assert (r.n, r.n_equal) == (2020, 2020)
    leaves = tree_check.first_tree_leaves(frame, trees, "label").collect()
    assert len(leaves) > 8 and sum(x.n for x in leaves) == 2020
    assert all(x.n == x.counted and abs(x.value - x.mean_label) < 1e-9 for x in leaves)


def test_forest_is_the_mean_of_its_trees(spark, frame, tmp_path):
    model = ml.random_forest("label", numTrees=7).fit(frame)
    trees = tree_check.read_trees(spark, ml.save_model(model, str(tmp_path / "rf")))
    r = tree_check.compare_routes(model.transform(frame), trees, mean=True).collect()[0]
    assert (r.n, r.n_equal) == (2020, 2020)
    # a wrong value is seen: the sum instead of the mean
    assert tree_check.compare_routes(model.transform(frame), trees, mean=False).collect()[0].n_equal < 100


def test_a_wrong_split_is_seen(spark, frame, tmp_path):
    model = ml.gbt_regressor("label", maxIter=2).fit(frame)
    trees = tree_check.read_trees(spark, ml.save_model(model, str(tmp_path / "gbt")))
    root = trees[0].nodes[0]
    moved = tree_check.Node(root.value, root.feature, root.threshold + 1.0, root.left, root.right, root.n_rows)
    wrong = [tree_check.Tree(trees[0].weight, (moved, *trees[0].nodes[1:])), trees[1]]
    r = tree_check.compare_routes(model.transform(frame), wrong, mean=False).collect()[0]
    assert r.n_equal < r.n


def test_a_tree_of_one_leaf_and_no_rows(spark, frame, tmp_path):
    model = ml.gbt_regressor("label", maxIter=1, maxDepth=0).fit(frame)
    trees = tree_check.read_trees(spark, ml.save_model(model, str(tmp_path / "leaf")))
    assert trees[0].depth() == 0
    r = tree_check.compare_routes(model.transform(frame), trees, mean=False).collect()[0]
    assert r.n == r.n_equal == 2020
    r = tree_check.compare_routes(model.transform(frame.limit(0)), trees, mean=False).collect()[0]
    assert (r.n, r.n_equal) == (0, 0)


def test_routing_needs_no_shuffle(spark, frame, tmp_path):
    model = ml.gbt_regressor("label", maxIter=2).fit(frame)
    trees = tree_check.read_trees(spark, ml.save_model(model, str(tmp_path / "gbt")))
    plan = tree_check.routed(frame, trees, mean=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
