"""Near copies of vectors against all pairs."""

import numpy as np
import pytest

from evenkeel.llm import multi_index
from evenkeel.llm.multi_index import fit_index, near_vectors, units


def cos(a, b):
    a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
    return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def by_hand(rows):
    near = [set() for _ in rows]
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if usable(a) and usable(b) and len(a) == len(b) and cos(a, b) >= 0.9:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((name, len(near[i]), least, name == least))
    return out


def made(rng, n, dim, groups):
    """Random vectors, and groups of copies that are near one another."""
    out = [rng.normal(size=dim).tolist() for _ in range(n)]
    for size, off in groups:
        center = rng.normal(size=dim)
        out += [(center + off * rng.normal(size=dim)).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("tile", [1024, 16])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(multi_index, "TILE", tile)
    monkeypatch.setattr(multi_index, "LOAD", 8)
    rng = np.random.default_rng(2)
    vectors = made(rng, 250, 24, [(60, 0.05), (5, 0.1), (5, 0.2), (2, 0.0)])
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[0]], [1e200 * x for x in vectors[1]], vectors[3][:3], vectors[3][:3], [1.0]]
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] + [1.0] * 23]
    rows = [((i * 37) % 997, v) for i, v in enumerate(vectors)] + [(2000 + i, v) for i, v in enumerate(odd)]
    rows += [(None, vectors[255]), (None, None), (None, rng.normal(size=24).tolist()), rows[5], rows[5]]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, Vec_ID string")
    got = sorted(map(str, map(tuple, near_vectors(frame.repartition(3), recall=1.0).collect())))
    assert got == sorted(str((a, n, c, a == c)) for a, n, c, _ in by_hand(rows))


def test_floats_and_empty(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.0, 0.5]), (3, [-1.0, 0.5])], "vec_id int, embedding array<float>")
    assert sorted(map(tuple, near_vectors(frame).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert near_vectors(frame.limit(0)).count() == 0


def test_recall_of_the_hardest_links(spark):
    """Pairs at a cosine just above the bar, on vectors that the fit has not seen."""
    rng = np.random.default_rng(4)
    x = units(rng.normal(size=(3000, 64)))
    off = rng.normal(size=x.shape)
    off = units(off - (off * x).sum(1, keepdims=True) * x)
    y = 0.901 * x + np.sqrt(1 - 0.901**2) * off
    index = fit_index(units(rng.normal(size=(3000, 64))), 6000, 0.9, 0.99)
    assert index.visits < 0.5 * index.k[0] * index.k[1]
    home, met = index.nearest(y)[:, 0], index.nearest(x)
    back = index.nearest(y)
    found = (met == home[:, None]).any(1) | (back == met[:, :1]).any(1)
    assert found.mean() >= 0.97
    rows = [(2 * i, v) for i, v in enumerate(x.tolist())] + [(2 * i + 1, v) for i, v in enumerate(y.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    linked = near_vectors(frame).where("n_links > 0").count()
    assert linked >= 0.97 * 6000
