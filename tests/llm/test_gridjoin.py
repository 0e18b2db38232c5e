import numpy as np
import pytest

from stratiform.llm.gridjoin import GridRules, near_vectors

NAN, INF = float("nan"), float("inf")


def brute(rows, cosine=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [v / np.linalg.norm(v) for _, v in good]
    ids = [i for i, _ in good]
    links = [[len(a) == len(b) and k != m and float(a @ b) >= cosine for m, b in enumerate(unit)] for k, a in enumerate(unit)]
    lead = list(ids)
    while True:
        new = [min([lead[k], *(lead[m] for m in range(len(ids)) if links[k][m])]) for k in range(len(ids))]
        if new == lead:
            break
        lead = new
    out = [(i, sum(x), c, i == c) for i, x, c in zip(ids, links, lead)]
    return sorted(out + [(i, 0, i, True) for i, v in rows if i not in set(ids)])


def got(df):
    return sorted(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


def cloud(seed, n, dim, spread):
    """Vectors around a few directions, some pairs just inside and some just outside the limit."""
    draw = np.random.default_rng(seed)
    bases = draw.normal(size=(6, dim))
    rows = []
    for k in range(n):
        v = bases[k % 6] / np.linalg.norm(bases[k % 6]) + draw.normal(size=dim) * spread / np.sqrt(dim)
        rows.append((k * 3, [float(np.float32(x)) for x in v * draw.uniform(0.1, 10)]))
    return rows


@pytest.mark.parametrize("seed,dim,spread", [(1, 16, 0.23), (2, 5, 0.3), (3, 64, 0.22)])
def test_joins_match_all_pairs(frame, seed, dim, spread):
    rows = cloud(seed, 260, dim, spread)
    df = frame(rows, "vec_id long, embedding array<float>")
    out = got(near_vectors(df, GridRules(block=16, fan=3)))
    assert out == brute(rows) and any(r[1] for r in out)


def test_copies_and_edges(frame):
    one, near, far = [1.0, 0.0, 0.1], [2.0, 0.01, 0.2], [0.0, 1.0, 0.0]
    rows = [(k, one) for k in range(10, 40)] + [(5, near), (6, far), (7, None), (8, []), (9, [0.0, 0.0, 0.0]), (1, [NAN, 1.0, 0.0]), (2, [INF, 1.0, 0.0]),
            (3, [None, 1.0, 0.0]), (50, [1.0, 0.0]), (51, [0.0, -0.0, 0.0]), (52, [3e38, 0.0, 3e37]), (53, [1e-40, 0.0, 1e-41])]
    df = frame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int")
    assert got(near_vectors(df, GridRules(block=4))) == brute(rows)
    assert near_vectors(frame([], "vec_id long, embedding array<float>")).count() == 0
    nulls = near_vectors(frame([(None, one), (None, None), (4, one)], "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in nulls) == [(-1, 0, -1, False), (-1, 1, 4, False), (4, 1, 4, True)]


def test_one_large_near_group_stays_small(spark):
    """Thousands of distinct vectors that all link: counts, not pairs, leave the tasks."""
    draw = np.random.default_rng(4)
    base = draw.normal(size=32)
    rows = [(k, (base + draw.normal(size=32) * 0.05).tolist()) for k in range(1500)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), GridRules(block=256))
    assert {(r.n_links, r.component_id) for r in out.collect()} == {(1499, 0)}
