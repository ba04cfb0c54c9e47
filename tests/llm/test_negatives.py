"""Hard negatives against all pairs; the curve; what the zone maps leave out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordferry.llm import negatives

VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute(data, every):
    rows = {}
    for vec_id, vector, label in data:
        if None in (vec_id, label, vector) or not vector or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vector):
            continue
        new = (label, [math.floor(256 * x) for x in vector])
        rows[vec_id] = new if vec_id not in rows else min(rows[vec_id], new, key=lambda r: (
            r[0], len(r[1]), np.array(r[1], "<f8").tobytes()))
    out = []
    for a, (label, v) in rows.items():
        if a % every:
            continue
        scores = sorted((-max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), i, m == label) for i, (m, w) in rows.items() if i != a and len(w) == len(v))
        for ps, p, same in [s for s in scores if s[2]][:5]:
            hits = [(i, -s) for s, i, same in scores if not same and 50 * -ps <= 100 * -s <= 95 * -ps][:3]
            out += [(a, p, r + 1, i, -ps, s) for r, (i, s) in enumerate(hits)]
    return sorted(out)


def mined(frame, every, block_bytes=negatives.BLOCK_BYTES):
    index = negatives.blocks(negatives.prepared(frame, F.col("label")), block_bytes)
    return sorted(tuple(r) for r in negatives.mine(index, every).collect()), index


def clusters(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = [(i, (centres[i % 6] + 0.4 * rng.normal(size=dim)).tolist(), int(rng.integers(4))) for i in range(n)]
    return out + [(n + i, centres[0].tolist(), i % 2) for i in range(copies)]


@pytest.mark.parametrize("batch,zones", [(1024, 1024), (7, 3)])
def test_equals_all_pairs_with_many_blocks_and_copies(rows, monkeypatch, batch, zones):
    monkeypatch.setattr(negatives, "BATCH", batch)
    monkeypatch.setattr(negatives, "ZONES", zones)
    data = clusters(600, 8, 1, copies=300)  # a third of all rows are one vector
    got, index = mined(rows(VECTORS, *data), 20, block_bytes=1)
    assert index.count() >= 28 and got == brute(data, 20)


def test_zone_maps_leave_blocks_out(rows):
    rng = np.random.default_rng(3)
    data = [(i, (np.eye(4)[i % 4] * 100 + rng.normal(size=4)).tolist(), i % 3) for i in range(800)]
    got, index = mined(rows(VECTORS, *data), 40, block_bytes=1)
    assert got == brute(data, 40)
    anchors = negatives.anchors_of(index, 40)
    chosen = negatives.choose(index, anchors, "positives")
    assert chosen.count() < 0.5 * anchors.count() * index.count()


def test_odd_rows(rows):
    rng = random.Random(4)
    data = [(i, [rng.gauss(0, 1) for _ in range(3)], i % 2) for i in range(60)]
    data += [(None, [1.0, 1.0, 1.0], 0), (100, None, 0), (101, [1.0, None, 0.0], 0), (102, [1.0, math.inf, 0.0], 1), (103, [math.nan, 0.0, 0.0], 1),
             (104, [1.0, 0.0, 0.0], None), (105, [], 1), (110, [0.0, 0.0, 0.0], 0), (120, [1.0, 2.0], 0), (121, [1.0, 2.0], 0), (122, [0.5, 1.5], 1),
             (7, [9.0, 9.0, 9.0], 1), (7, [9.0, 9.0, 9.0], 1), (7, [8.0, 9.0, 9.0], 0), (130, [1e307, 0.0, 0.0], 1)]
    frame = rows(VECTORS, *data).selectExpr("*", "1 as dim", "'x' as vector", "2 as block", "3 as rank", "4 as score")
    got, _ = mined(frame, 10)
    assert got == brute(data, 10) and any(r[0] == 120 for r in got)
    assert mined(frame.limit(0), 10)[0] == []


def test_numbers_beyond_doubles_stay_exact(rows):
    rng = random.Random(5)
    data = [(i, [rng.choice((1e6, 3e7 + i, 1.0)) for _ in range(4)], i % 2) for i in range(40)]
    data += [(40, [1e30, 1.0, 1.0, 1.0], 0), (41, [2e30, 0.0, 0.0, 0.0], 1)]
    assert mined(rows(VECTORS, *data), 5)[0] == brute(data, 5)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_each_cell_once_and_moves_by_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(6)
    boxes = rng.integers(-50, 50, (20, 30, 5)).astype(float)
    anchors = rng.integers(-50, 50, (40, 5)).astype(float)
    upper, lower = negatives.bounds(anchors, boxes.min(axis=1), boxes.max(axis=1))
    scores = np.einsum("ad,brd->abr", anchors, boxes)
    assert (scores.max(axis=2) <= upper).all() and (scores.min(axis=2) >= lower).all()
