import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm import topk

SCHEMA = "vec_id long, Embedding string, embedding array<double>, label int, vec string, id string"
BY_FIVE = "id % 5 = 0"


def frame(spark, rows):
    return spark.createDataFrame([(i, "x", v, 1, "y", "z") for i, v in rows], SCHEMA).repartition(4)


def ints(v):
    return [int(np.floor(x * 1024.0)) if abs(x) < 1e300 else int(x) * 1024 for x in v]


def plain(rows, k):
    """Every query against every row."""
    good = [(i, ints(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in good if i is not None and i % 5 == 0}
    out = []
    for q, x in asked:
        scores = [(-max(min(sum(a * b for a, b in zip(x, v)), 2**63 - 1), -(2**63)), i is None, i or 0, i) for i, v in good if i != q]
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda t: t[:3])[:k])]
    return sorted(out, key=repr)


def odd_rows(seed=2):
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(size=8).tolist()) for i in range(120)]
    rows += [(i, rows[7][1]) for i in range(200, 260)] + [(i, [0.0] * 8) for i in range(300, 320)]  # copies, ties
    rows += [(400, None), (405, [1.0, None]), (410, [float("nan")] * 8), (415, [float("inf")] + [0.0] * 7), (420, []), (425, [3.0]), (430, [-2.0, 1.0, 0.5]),
             (None, rows[3][1]), (None, [9.0] * 8), (435, rows[3][1]), (435, rows[3][1]), (440, rows[3][1]), (440, rows[4][1]), (-5, [0.0009765] * 8)]
    return rows


@pytest.mark.parametrize("k,kw", [(10, {}), (3, {"pivots": 5, "group_bytes": 400, "slice_rows": 40}), (500, {"pivots": 1})])
def test_equals_all_pairs(spark, k, kw):
    rows = odd_rows()
    got = topk.top_k(frame(spark, rows), BY_FIVE, k=k, **kw).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, k)


@pytest.mark.parametrize("scale", [40.0, 1e6, 1e12, 1e200, 1e306])
def test_large_components(spark, scale):
    rows = [(i, None if v is None else [None if x is None else x * scale for x in v]) for i, v in odd_rows(3)]
    got = topk.top_k(frame(spark, rows), BY_FIVE, k=4, pivots=4).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 4)


def test_clusters_are_pruned(spark):
    r = np.random.default_rng(4)
    middle = 60.0 * np.eye(8)
    rows = [(i, (middle[i // 5 % 8] + 0.3 * r.normal(size=8)).tolist()) for i in range(2000)]
    out, sent = topk._top_k(frame(spark, rows), BY_FIVE, 5, "vec_id", "embedding", 8, 8 * 8 * 50, 4 << 20)
    assert sorted((tuple(x) for x in out.collect()), key=repr) == plain(rows, 5)
    copies, groups = sent.where("data").agg(F.sum(F.octet_length("ids") / 8), F.countDistinct("part")).first()
    assert groups >= 8 and copies < 0.3 * groups * 2000


def test_no_rows_no_queries(spark):
    assert topk.top_k(frame(spark, []), BY_FIVE).count() == 0
    assert topk.top_k(frame(spark, [(1, [1.0]), (2, [2.0])]), BY_FIVE).count() == 0
    assert topk.top_k(frame(spark, [(5, [1.0])]), BY_FIVE).count() == 0


def test_groups_hold_a_bounded_number_of_queries():
    first, parts = topk._groups(np.array([3, 0, 25, 4, 4]), np.arange(5.0)[:, None], 10)
    load = {}
    for n, a, b in zip([3, 0, 25, 4, 4], first, parts):
        for g in range(a, a + b):
            load[g] = load.get(g, 0) + n / b
    assert max(load.values()) <= 10 and parts.tolist() == [1, 0, 3, 1, 1]
