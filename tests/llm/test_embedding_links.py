"""Links against brute force: none wrong, and recall."""

import numpy as np
import pytest

from sluicegate.llm import embedding_links


def clusters(seed, groups, size, dimension, noise):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((groups, dimension))
    points = np.repeat(centres, size, 0) + noise * random.standard_normal((groups * size, dimension))
    return np.concatenate((points, random.standard_normal((500, dimension)))).astype(np.float32)


@pytest.mark.parametrize(("groups", "size", "noise"), [(200, 4, 0.12), (2, 700, 0.1)])
def test_recall(spark, monkeypatch, groups, size, noise):
    monkeypatch.setattr(embedding_links, "CELL_ROWS", 128)
    x = clusters(1, groups, size, 64, noise)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r for r in embedding_links.linked(table).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([found[i]["n_links"] for i in range(len(x))])
    assert (links <= near.sum(1)).all() and near.sum() > 1000
    assert links.sum() >= 0.95 * near.sum()
    linked = {i for i in range(len(x)) if found[i]["component_id"] != i} | {found[i]["component_id"] for i in range(len(x)) if found[i]["component_id"] != i}
    assert linked == {i for i in range(len(x)) if links[i]}
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(len(x)))


def test_copies_are_one_class(spark):
    x = np.random.default_rng(2).standard_normal((3, 16))
    rows = [(i, x[i % 3].tolist()) for i in range(300)]
    found = embedding_links.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all((r["n_links"], r["component_id"]) == (99, r["vec_id"] % 3) for r in found)


def test_plan_grows_slowly():
    lines, views = embedding_links.plan(10**9)
    assert lines <= 20 and views <= 60 and embedding_links.plan(1) == embedding_links.plan(500)
    assert embedding_links.least_count() == 6
