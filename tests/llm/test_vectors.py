import numpy as np
import pytest

from bandwise.llm import embed_dedup


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_links_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 8))
    vectors = np.concatenate([base, base[:30] + 0.12 * rng.standard_normal((30, 8)), np.repeat(base[:1], 9, axis=0)])
    rows = [(i, [0, 1, None][i % 3] if i < 60 else 0, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(200, 0, None), (201, 0, [0.0] * 8), (202, 0, [float("nan")] * 8), (203, 0, [None] * 8), (204, 0, [1.0, 2.0]), (205, 0, [2.0, 4.0])]
    found = {r.id: r for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "id long, label int, vec array<double>")).collect()}
    assert len(found) == len(rows)
    good = {i: np.array(v) / np.linalg.norm(v) for i, label, v in rows if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: label for i, label, _ in rows}
    near = {i: [j for j in good if j != i and label[i] == label[j] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.93] for i in good}
    group = {i: i for i, _, _ in rows}
    for _ in range(12):
        group = {i: min([group[i], *(group[j] for j in near.get(i, []))]) for i in group}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in found.items()} == {i: (len(near.get(i, [])), group[i], group[i] == i) for i in group}


def test_no_vectors(spark):
    assert embed_dedup.near_vectors(spark.createDataFrame([], "id long, label int, vec array<float>")).count() == 0


def test_null_and_repeated_ids_link(spark):
    rows = [(None, 0, [1.0, 0.0]), (1, 0, [1.0, 0.1]), (2, 0, [1.0, -0.1]), (3, 0, [0.0, 1.0]), (3, 0, [0.1, 1.0]), (4, 0, [-1.0, 0.0])]
    found = embed_dedup.near_vectors(spark.createDataFrame(rows, "id long, label int, vec array<double>")).collect()
    got = sorted(((r.id or 0, r.n_links, r.component_id, r.kept) for r in found), key=str)
    assert got == [(0, 2, None, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (3, 1, 3, True), (4, 0, 4, True)]
