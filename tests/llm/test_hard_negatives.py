import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import hard_negatives

LAYOUT = "vec_id long, embedding array<float>, label int, v string, row int, code1 string"


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90):
    """rows of (id, vector, label), all of them usable."""
    held = [(i, vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, (vec_id, v, label) in enumerate(rows)]
    out = []
    for place, anchor_id, v, label in held:
        if anchor_id is None or not anchor(anchor_id):
            continue
        ordered = sorted(
            (-sum(a * b for a, b in zip(v, w)), vec_id is None, vec_id or 0, i, vec_id, other)
            for i, vec_id, w, other in held
            if i != place
        )
        for score, _, _, _, positive_id, _ in [x for x in ordered if x[5] == label][:positives]:
            fits = [x for x in ordered if x[5] != label and -low * score <= -100 * x[0] <= -high * score]
            out += [(anchor_id, positive_id, rank, x[4], -score, -x[0]) for rank, x in enumerate(fits[:negatives], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*row, "x", 5, "y") for row in rows], LAYOUT)
    return sorted(map(tuple, hard_negatives.mined(table, F.col("vec_id") % 5 == 0, **more).collect()), key=str)


def random_rows(seed, n, d=6):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(d)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = draw.randrange(4)
        near = centres[label if draw.random() < 0.6 else draw.randrange(4)]
        rows.append((i, [c + draw.gauss(0, 0.4) for c in near], label))
    # a third of the rows share one vector; some ids repeat
    return [(i if i % 17 else 5, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]


@pytest.mark.parametrize("first,slice_,chunk,codes", [(8192, 8192, 4096, 16), (5, 7, 9, 4), (1, 300, 1000, 1)])
def test_agrees_with_brute_force(spark, monkeypatch, first, slice_, chunk, codes):
    monkeypatch.setattr(hard_negatives, "FIRST", first)
    monkeypatch.setattr(hard_negatives, "SLICE", slice_)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    monkeypatch.setattr(hard_negatives.fitted, "__defaults__", (codes, 60))
    rows = random_rows(first, 150)
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    good = random_rows(2, 40) + [(None, [1.0] * 6, 2), (60, [-9.0] * 6, 9), (65, [0.0] * 6, 1)]
    bad = [
        (70, None, 1), (75, [1.0] * 6, None), (80, [1.0] * 5 + [None], 1), (85, [1.0] * 5 + [float("nan")], 1),
        (90, [1.0] * 5 + [float("inf")], 1), (95, [], 1), (100, [1.0] * 7, 1),
    ]
    assert mined(spark, good + bad) == brute(good, lambda i: i % 5 == 0)
    assert mined(spark, bad[:5]) == mined(spark, []) == []
    alone = [(5, [1.0, 2.0], 1), (6, [1.0, 1.5], 2)]
    assert mined(spark, alone) == []


def test_large_components_stay_exact(spark):
    rows = [(n, [float(2**20 + 3 * n), 1.5 * n, -(2.0**18)], n % 2) for n in range(20)]
    assert mined(spark, rows, low=0, high=100) == brute(rows, lambda i: i % 5 == 0, low=0, high=100)


def test_cells_come_by_falling_bound_and_no_row_beats_its_bound():
    draw = np.random.default_rng(4)
    points = np.floor(draw.normal(size=(300, 8)) * 100)
    books = tuple(hard_negatives.codebook(half, 5) for half in hard_negatives.halves(points))
    codes, far = zip(*[hard_negatives.nearest(half, book) for half, book in zip(hard_negatives.halves(points), books)])
    radii = [np.array([f[c == i].max(initial=0) for i in range(5)]) for c, f in zip(codes, far)]
    held = np.zeros((5, 5), np.int64)
    np.add.at(held, codes, 1)
    index = hard_negatives.MultiIndex(books, radii, held)
    for anchor in points[:20]:
        walk = list(index.walk(anchor))
        assert [b for b, *_ in walk] == sorted((b for b, *_ in walk), reverse=True)
        assert sorted((i, j) for _, i, j in walk) == sorted(zip(*(a.tolist() for a in np.nonzero(held))))
        bound = {(i, j): b for b, i, j in walk}
        assert all(p @ anchor <= bound[i, j] for p, i, j in zip(points, *codes))
        cells, rest = index.next_cells(anchor, 2, 50, -np.inf)
        assert cells == [(i, j) for _, i, j in walk[2 : 2 + len(cells)]] and rest == walk[2 + len(cells)][0]
        assert index.next_cells(anchor, 0, 10**9, walk[3][0])[0] == [(i, j) for _, i, j in walk[:4]]
