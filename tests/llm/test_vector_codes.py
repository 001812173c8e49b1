"""Product codes against plain integer arithmetic, and what the pivots save."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from compare import differences, duck
from veracast.llm import vector_codes
from veracast.llm.vector_codes import _root, assign, choose_pivots, distances

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def _brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) with Python's own integers."""
    kept = [
        (i, [int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, v, _ in kept), default=0)
    per = max(1, -(-width // parts))
    cut = []
    for i, v, lab in kept:
        full = [max(-(1 << 28), min(1 << 28, x)) for x in v] + [0] * (parts * per - len(v))
        cut.append((i, [full[p * per : (p + 1) * per] for p in range(parts)], lab))
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def nearest(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return min(range(len(book)), key=lambda e: (far[e], e)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for r in cut:
                own.setdefault(nearest(r[1][p], books[p])[0], []).append(r[1][p])
            for e, members in own.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, v, lab in cut:
        found = [nearest(v[p], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
    total = {}
    for _, _, error, lab in coded:
        total[lab] = total.get(lab, 0) + error
    return sorted(((i, c, e, total[lab], digest) for i, c, e, lab in coded), key=str)


def _found(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "clash") for i, v, lab in rows], SCHEMA).repartition(3)
    got = vector_codes.product_codes(df).collect()
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r[c] for c in names) for r in got), key=str)


def _rows(seed, n, width=16):
    draw = np.random.default_rng(seed)
    values = draw.normal(0, 0.2, (n, width)).astype(np.float32)
    labels = draw.integers(0, 4, n)
    return [(int(i), v.tolist(), None if lab == 3 else int(lab)) for i, v, lab in zip(draw.permutation(n), values, labels)]


def test_as_brute_force_with_odd_rows(spark):
    rows = _rows(1, 120)
    rows += [(7, None, 1), (200, [0.1, None] * 8, 1), (201, [float("nan")] * 16, 1), (202, [float("inf")] * 16, 1)]
    rows += [(None, rows[0][1], 2), (5, rows[3][1], 2), (5, rows[3][1], 2), (300, [1e6, -1e6] * 8, 0)]
    rows += [(400 + i, rows[9][1], 1) for i in range(60)]
    assert _found(spark, rows) == _brute(rows)


def test_few_ragged_and_no_rows(spark):
    short = [(1, [0.5, -0.25, 0.75], 0), (2, [], 0), (3, [0.5] * 9, None)]
    assert _found(spark, short) == _brute(short)
    assert _found(spark, [(1, [0.125] * 8, 5)]) == _brute([(1, [0.125] * 8, 5)])
    assert _found(spark, []) == []
    assert _found(spark, [(1, None, 5)]) == []


@pytest.mark.parametrize("seed", range(20))
def test_pruning_keeps_the_nearest(seed):
    draw = np.random.default_rng(seed)
    size = int(draw.integers(2, 5000))
    entries = draw.integers(-size, size, (16, 4))
    entries[5] = entries[2]
    parts = np.concatenate([draw.integers(-size, size, (300, 4)), entries, entries + 1])
    fixed = choose_pivots(draw.permutation(entries), 3)
    index, best, evaluated = assign(parts, _root(distances(parts, fixed)), entries, fixed)
    exact = distances(parts, entries)
    assert (index == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert evaluated <= len(parts) * 16


def test_pivots_save_evaluations():
    """On clustered parts most of the entries are pruned."""
    draw = np.random.default_rng(3)
    entries = draw.integers(-4000, 4000, (16, 8))
    parts = entries[draw.integers(0, 16, 5000)] + draw.integers(-200, 200, (5000, 8))
    fixed = choose_pivots(entries)
    _, _, evaluated = assign(parts, _root(distances(parts, fixed)), entries, fixed)
    assert evaluated < 0.2 * 5000 * 16


def test_whole_roots():
    x = np.array([0, 1, 2, 3, 4, 15, 16, 2**52 - 1, 2**60 - 1, 2**60, (2**30 + 1) ** 2 - 1], np.int64)
    import math

    assert _root(x).tolist() == [math.isqrt(v) for v in x.tolist()]


def test_matches_duckdb(spark):
    small = "/root/testdata/sf0.001"
    got = queries()["op13_vector_codes"](spark, small)
    assert differences(got, duck(small), oracle_sql()["op13_vector_codes"]) == []
    assert got.agg(F.countDistinct("label_error")).first()[0] == 10
