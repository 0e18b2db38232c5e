import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratiform.llm.negatives import Heaps, NegativeRules, mine_negatives, strassen

SCHEMA = "vec_id long, label long, vector array<long>, anchor boolean"
SMALL = NegativeRules(positives=3, negatives=2, anchor_rows=4, candidate_rows=16, tile=8, leaf=2)


def brute(rows, rules):
    first = {}
    for vec_id, label, vector, anchor in rows:
        if None in (vec_id, label, vector) or None in vector:
            continue
        old = first.get(vec_id, (label, vector, False))
        first[vec_id] = (*min((label, vector), old[:2]), bool(anchor) or old[2])
    out = []
    for a, (la, va, is_anchor) in first.items():
        if not is_anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, lab) for i, (lab, v, _) in first.items() if i != a)
        for ps, p, _ in [x for x in scored if x[2] == la][: rules.positives]:
            fit = [x for x in scored if x[2] != la and rules.low * -ps <= 100 * -x[0] <= rules.high * -ps][: rules.negatives]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(fit)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@settings(deadline=None)
@given(st.integers(0, 9), st.integers(1, 17), st.integers(0, 13), st.integers(1, 4), st.integers(0, 2**32))
def test_strassen_is_exact(m, d, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**29), 2**29, (m, d)), rng.integers(-(2**29), 2**29, (d, n))
    assert (strassen(a, b, leaf) == a @ b).all()


def test_sums_that_leave_64_bits_on_the_way():
    a = np.full((4, 4), 3_000_000_000_000_000_000)  # a11 + a22 wraps
    b = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [-1, -1, -1, 1]])
    assert (strassen(a, b, 1) == a @ b).all()


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.integers(0, 99)), max_size=60, unique_by=lambda x: (x[0], x[2])), st.integers(1, 9))
def test_heaps_merge_in_any_parts(entries, step):
    heaps = Heaps(4, 3)
    for at in range(0, len(entries), step):
        heaps.merge(*(np.array(x, np.int64) for x in zip(*entries[at : at + step], strict=True)))
    want = [e for r in range(4) for e in sorted((x for x in entries if x[0] == r), key=lambda x: (-x[1], x[2]))[:3]]
    assert list(zip(heaps.row.tolist(), heaps.score.tolist(), heaps.id.tolist(), strict=True)) == want


def test_against_all_pairs(spark, frame):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.randint(-3, 9) for _ in range(rng.choice([5, 5, 3]))], i % 4 == 0) for i in range(150)]
    rows += [(200 + i, 1, [2, 2, 2, 2, 2], False) for i in range(20)]  # ties
    rows += [(300, None, [1], True), (301, 1, None, True), (302, 1, [1, None], True), (None, 1, [9], True), (4, 0, [9, 9, 9, 9, 9], False), (8, 7, [1], None)]
    table = frame(rows, SCHEMA).withColumn("rank", F.lit(1)).withColumn("a", F.lit(2))
    for rules in (SMALL, NegativeRules()):
        assert got(mine_negatives(table, rules)) == brute(rows, rules) != []


def test_edges(frame):
    assert mine_negatives(frame([], SCHEMA)).collect() == []
    assert mine_negatives(frame([(1, 1, [1], True)], SCHEMA)).collect() == []
    assert mine_negatives(frame([(1, 1, [], True), (2, 1, [], False), (3, 2, [], False)], SCHEMA)).count() == 1  # all scores are 0
    with pytest.raises(Exception, match="too large"):
        mine_negatives(frame([(1, 1, [2**40], True), (2, 1, [2**40], False)], SCHEMA)).collect()
