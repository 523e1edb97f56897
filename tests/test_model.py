"""M1..M7 and O2: row counts, columns, totals, fixed seed."""

import math
import re
from collections import Counter

import pytest

from couponlens.operators import model as M
from couponlens.operators.features import FEATURES
from couponlens.plans import registry as R
from couponlens.plans.stage import new_folder
from couponlens.sources import importance as SI

from conftest import SMALL


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: R.QUERIES[name](spark, SMALL)


def test_train_set_has_label_and_features(q):
    df = q("train_set")
    assert df.columns[-1] == "label" and len(df.columns) == 4 + 56 + 1
    assert df.count() == 920


def test_assemble_fills_missing(q):
    row = M.assemble(q("train_set")).first()
    assert len(row.features) == 56 and all(v == v for v in row.features.toArray())
    df = q("assemble")
    assert df.columns == [*M.KEYS, *FEATURES, "label"] and df.where(" or ".join(f"{f} is null" for f in FEATURES)).count() == 0


def test_split_importance(q):
    imp = q("importance_splits")
    rows = imp.collect()
    assert sorted(r.feature for r in rows) == sorted(FEATURES)
    total = sum(r.importance for r in rows)
    assert total > 0 and all(float(r.importance).is_integer() for r in rows)
    trees = q("fit_trees").collect()
    assert len(trees) == M.TreeParams().max_iter
    assert sum(t.splits for t in trees) == total


def test_sorted_importance_and_family(q):
    splits = q("importance_splits")
    rows = M.sort_by_importance(splits).collect()
    keys = [(-r.importance, r.feature) for r in rows]
    assert keys == sorted(keys) and len(rows) == 56
    fam = {r.family: r for r in M.importance_by_family(splits).collect()}
    assert sum(r.features for r in fam.values()) == 56
    assert fam["raw"].features == 4 and fam["m_l"].features == 10 and fam["um_h"].features == 5
    assert sum(r.importance for r in fam.values()) == sum(r.importance for r in rows)


def test_splits_recounted_from_the_model_text(spark, q):
    model, _ = R._model(spark, SMALL)
    text = Counter(int(i) for i in re.findall(r"If \(feature (\d+) ", model.toDebugString))
    assert {r.feature: r.importance for r in q("importance_splits").collect()} == {f: float(text[i]) for i, f in enumerate(FEATURES)}


def test_scores_rebuilt_from_the_saved_trees(spark, q):
    """Each score again: walk the stored nodes, weigh the trees, pass the margin through the logistic."""
    _, path = R._model(spark, SMALL)
    trees = {}
    for n in M.tree_nodes(spark, path).collect():
        trees.setdefault(n.tree_id, {})[n.id] = n
    weight = {r.tree_id: r.weight for r in M.tree_summary(spark, path).collect()}

    def walk(nodes, x):
        n = nodes[0]
        while n.leftChild >= 0:
            n = nodes[n.leftChild if x[n.split.featureIndex] <= n.split.leftCategoriesOrThreshold[0] else n.rightChild]
        return n.prediction

    wanted = Counter()
    for r in M.assemble(q("features_wide")).collect():
        x = r.features.toArray()
        margin = sum(weight[t] * walk(nodes, x) for t, nodes in trees.items())
        wanted[(*[r[k] for k in M.KEYS], round(1 / (1 + math.exp(-2 * margin)), 9), int(margin > 0))] += 1
    assert Counter((*[r[k] for k in M.KEYS], round(r.probability, 9), r.prediction) for r in q("score").collect()) == wanted


def test_one_seed_gives_one_importance_table(spark, q):
    model, _ = R._model(spark, SMALL)
    again = M.fit(q("train_set"))
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]
    assert again.featureImportances == model.featureImportances


def test_gain_sums_to_one(q):
    assert sum(r.gain for r in q("importance_gain").collect()) == pytest.approx(1.0)


def test_score_covers_label_window(q):
    df = q("score")
    assert df.count() == 834
    assert df.where("probability < 0 or probability > 1 or prediction not in (0, 1)").count() == 0


def test_importance_csv_round_trip(spark, q):
    path = new_folder(spark, "importance")
    SI.write_importance(q("importance_splits"), path)
    assert sorted(map(tuple, SI.read_importance(spark, path).collect())) == sorted(map(tuple, q("importance_splits").collect()))
    lines = [r.line for r in q("importance_sink").collect()]
    assert len(lines) == 56 and all(line.count(",") == 1 for line in lines)


def test_family_of_hand_made_rows(spark):
    df = spark.createDataFrame([("um_h_x", 2.0), ("u_h_y", 3.0), ("discount", 5.0), ("m_l_z", 1.0)],
                               "feature string, importance double")
    got = {r.family: (r.features, r.importance) for r in M.importance_by_family(df).collect()}
    assert got == {"um_h": (1, 2.0), "u_h": (1, 3.0), "raw": (1, 5.0), "m_l": (1, 1.0)}


def test_fit_holds_a_bounded_number_of_rows_a_task(spark, q):
    """A scan's partition has as many rows as its bytes allow; the fit's are dealt so that none holds many more than it may."""
    train = q("train_set")
    rows = M.fit_rows(train, most=50)
    sizes = rows.rdd.glom().map(len).collect()
    assert sum(sizes) == train.count() and max(sizes) <= 2 * 50
    assert M.fit_rows(train).rdd.getNumPartitions() == train.rdd.getNumPartitions()  # a small table stays as it is
