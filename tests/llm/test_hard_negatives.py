import math

import numpy as np
import pyarrow as pa
import pytest
from starmill.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = 1 << 63


def brute_force(rows):
    taken = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        taken.append((vec_id, label, tuple(int(x) * 256 if abs(x) > 2 ** 60 else math.floor(x * 256) for x in vector)))

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a[2], b[2])), -LONG), LONG - 1)

    out = []
    for anchor in {t for t in taken if t[0] % 100 == 0}:
        ranked = sorted(((-score(anchor, t), t[0], t) for t in taken if t[0] != anchor[0]), key=lambda r: r[:2])
        for s, positive, _ in [r for r in ranked if r[2][1] == anchor[1]][:5]:
            fit = [(-n, i) for n, i, t in ranked if t[1] != anchor[1] and 30 * -s <= 100 * -n <= 90 * -s][:10]
            out += [(anchor[0], positive, rank, i, -s, n) for rank, (n, i) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, extra=False, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in ("angles", "norm", "near", "nearest", "anchor", "place", "score", "rank"):
            df = df.selectExpr("*", f"'z' AS {name}")
    out = hn.hard_negatives(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(n, dim, seed, step=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    return [(int(i * step), v.tolist(), int(rng.integers(0, 10))) for i, v in enumerate(x)]


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_rows_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 2)
    monkeypatch.setattr(hn, "TILE_ROWS", 50)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 2)
    rows = vectors(700, 8, 1, spread=spread)
    assert found(spark, rows) == brute_force(rows) != []


def test_nulls_ties_repeats_lengths_and_clashing_names(spark):
    rows = vectors(300, 4, 2, step=10)
    rows += [(100, [1.0, 0, 0, 0], 3), (100, [1.0, 0, 0, 0], 3), (100, [1.0, 0, 0, 0], 4), (103, [1.0, 0, 0, 0], 3), (103, [1.0, 0, 0, 0], 3)]
    rows += [(1000 + i, [0.5, 0.5, 0, 0], i % 3) for i in range(60)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")], 1), (203, [float("inf"), 1.0], 1), (204, [1.0], None),
             (None, [1.0], 1), (205, [], 1), (300, [], 2), (206, [0.0] * 4, 1), (400, [2.0], 5), (401, [1.0] * 9, 5), (-700, [1.0, 1, 1, 1], 2)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows]
    assert found(spark, rows, extra=True) == brute_force(rows) != []


def test_scores_beyond_double_and_long(spark):
    rows = vectors(200, 3, 3, step=5)
    rows += [(1100 + i, [float(2 ** 40 + i), 1.5, -3.0], i % 2) for i in range(0, 80, 4)]
    rows += [(1200, [1e200, 1.0, 2.0], 1), (1203, [3e200, 0.0, 1.0], 1), (1205, [-1e308, 2.0, 1.0], 2), (1300, [1e307, 1.0, 1.0], 2)]
    assert found(spark, rows) == brute_force(rows) != []


def test_empty_tables_and_lone_anchors(spark):
    assert found(spark, []) == found(spark, [(0, None, 1)]) == found(spark, [(100, [1.0], 1)]) == []
    assert found(spark, [(100, [1.0], 1), (101, [1.0], 1)]) == found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_bounds_hold_and_skip_what_they_can():
    rng = np.random.default_rng(5)
    x = np.floor(256 * np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(1, 6)) + 1e-9 * rng.normal(size=(100, 6)), np.zeros((2, 6))]))
    a, references = x[:40], hn._directions(x[50:58])[0]
    angle, norm = hn.angles(x, references)
    angle = angle.astype(np.float32).astype(np.float64)
    low = np.abs(angle[:40, None] - angle).max(axis=2)
    high = np.minimum((angle[:40, None] + angle).min(axis=2), np.pi)
    product = norm[:40, None] * norm
    least, most = hn.bounds(low, high, (product, product))
    exact = hn.scores(a, x)
    assert (least <= exact).all() and (exact <= most).all()
    assert (most < np.quantile(exact, .99, axis=1)[:, None]).mean() > .3  # not idle


def test_batches_far_off_are_not_scored(monkeypatch):
    """Two clusters: anchors of one are spared the tiles of the other."""
    rng = np.random.default_rng(6)
    x = np.floor(256 * np.concatenate([[1, 0, 0] + .01 * rng.normal(size=(400, 3)), [0, 0, -1] + .01 * rng.normal(size=(400, 3))]))
    angle, norm = hn.angles(x, hn._directions(x[[0, 400]])[0])
    a = hn.Anchors(np.arange(3), np.arange(3), np.zeros(3, int), x[:3], angle[:3], norm[:3])
    pairs = []
    monkeypatch.setattr(hn, "scores", lambda p, q, f=hn.scores: pairs.append(len(p) * len(q)) or f(p, q))
    batches = [pa.RecordBatch.from_pydict({"vec_id": np.arange(k, k + 100) + 10, "label": np.zeros(100, int), "embedding": (x[k:k + 100] / 256).tolist(),
                                          "angles": angle[k:k + 100].tolist(), "norm": norm[k:k + 100]}) for k in range(0, 800, 100)]
    out = pa.Table.from_batches(hn._best_positives(a)(iter(batches)))
    assert out.num_rows == 15 and sum(pairs) <= 3 * 400


def test_vectors_are_floored_as_doubles():
    column = pa.array([[0.1, -0.1], None, [1 / 256], [], [float("nan")]], pa.list_(pa.float32()))
    x, valid = hn.quantised(column)
    assert valid.tolist() == [True, False, True, True, False]
    assert x[0].tolist() == [math.floor(256 * np.float64(np.float32(0.1))), -26] and x[2].tolist() == [1, 0]
