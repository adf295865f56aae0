import math
import random

import pytest
from pyspark.sql import functions as F

from fieldloom.llm.negatives import hard_negatives

VECTORS = "vec_id long, label int, embedding array<double>, size long, part int, block string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, "x") for r in rows], VECTORS).repartition(3)


def by_hand(rows, is_anchor, n_pos=5, n_neg=10):
    good, first = [], {}
    for i, label, x in rows:
        if i is not None and label is not None and x and all(v is not None and math.isfinite(v) for v in x):
            k = (i, len(x))
            if k not in first or (label, x) < first[k]:
                first[k] = (label, x)
    floor = lambda v: math.floor(v * 256) if abs(v) < 1e300 else int(v) * 256
    good = [(i, label, [floor(v) for v in x]) for (i, _), (label, x) in first.items()]
    clip = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    out = set()
    for i, label, q in good:
        if not is_anchor(i):
            continue
        scored = [(clip(sum(a * b for a, b in zip(q, x))), j, other) for j, other, x in good if j != i and len(x) == len(q)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2] == label][:n_pos]:
            window = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            out |= {(i, j, k + 1, m, p, s) for k, (s, m, _) in enumerate(window[:n_neg])}
    return out


@pytest.mark.parametrize("values, chunk", [(1 << 22, 2048), (400, 2)])
def test_negatives_match_brute_force(spark, values, chunk):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.gauss(0.3, 1) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, i % 2, rows[0][2]) for i in range(30)]  # ties
    rows += [(7, 0, None), (8000, None, rows[3][2]), (None, 1, rows[4][2]), (8100, 1, [1.0, float("nan")]), (8200, 1, [None] * 12), (8300, 1, []), (8400, 0, [1.0, 2.0]), (8401, 0, [1.0, 3.0]), (8402, 1, [0.5, 1.0])]
    rows += [rows[20], (20, 0, [9.0] * 12), (10, 2, rows[11][2])]  # repeated ids
    rows += [(8500, 1, [0.0] * 12)]
    got = hard_negatives(table_of(spark, rows), F.col("vec_id") % 20 == 0, block_values=values, chunk_rows=chunk).collect()
    want = by_hand(rows, lambda i: i % 20 == 0)
    assert len(want) > 300 and {tuple(r) for r in got} == want and len(got) == len(want)


def test_huge_components_are_decided_exactly(spark):
    rows = [(i, i % 2, [1e12 + 3 * i, -7e11 * (i % 5), float(i)]) for i in range(24)] + [(100, 0, [1e308, 1.0, 1.0]), (102, 0, [2.0, 1.0, 1.0]), (101, 1, [1.0, 0.0, 0.0])]
    rows = [(i, label, [v / 1e4 for v in x] if i < 100 else x) for i, label, x in rows]
    got = hard_negatives(table_of(spark, rows), F.col("vec_id") < 100).collect()
    kept = lambda found: {r[:4] for r in found if r[4] < 2**62}
    assert kept(map(tuple, got)) == kept(by_hand(rows, lambda i: i < 100)) and all(r["negative_id"] is not None for r in got)


def test_no_rows_no_anchors(spark):
    some = table_of(spark, [(1, 1, [1.0, 2.0])])
    for vectors in (some, some.limit(0)):
        assert hard_negatives(vectors, F.col("vec_id") % 2 == 0).collect() == []
        assert hard_negatives(vectors, F.col("vec_id") % 2 == 1).collect() == []
