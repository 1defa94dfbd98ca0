"""Exact and approximate searches against brute force."""

import numpy as np
import pytest

from occuspark.llm import srs, vafile

SCHEMA = "vec_id long, embedding array<float>, label string, score double, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "l", 0.0, 1)
                                  for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    out = [(i, centres[i % 12] + 0.2 * rng.standard_normal(16)) for i in range(900)]
    out += [(i, out[5][1]) for i in range(2000, 2060)]  # one vector many times
    out += [(3000, None), (3100, [1.0, None] * 8), (3200, [float("nan")] + [0.0] * 15), (3300, [float("inf")] * 16),
            (3400, [0.0] * 16), (3500, [1.0, 2.0, 3.0]), (3501, [1.0, 2.0, 2.5]), (None, [0.1] * 16), (7, out[7][1])]
    return [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in out]


def usable(rows, zero):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and None not in v]
    return [(i, v) for i, v in ok if np.isfinite(v).all() and (zero or v.any())]


def brute(rows, k, integer):
    ok = usable(rows, integer)
    want = {}
    for q, x in ok:
        if q % 100:
            continue
        found = []
        for i, y in ok:
            if i == q or len(y) != len(x):
                continue
            if integer:
                found.append((-int(np.floor(1024 * x).astype(int) @ np.floor(1024 * y).astype(int)), i))
            else:
                found.append((float(np.sqrt(((x - y) ** 2).sum())), i))
        want[q] = sorted(found)[:k]
    return {q: v for q, v in want.items() if v}


def test_va_file_is_exact(spark, rows):
    df = table(spark, rows)
    got = vafile.search(df, df.where("vec_id % 100 = 0"), block_rows=5).toPandas()
    want = brute(rows, 10, True)
    assert set(got.query_id) == set(want)
    for q, rs in got.groupby("query_id"):
        rs = rs.sort_values("rank")
        assert rs["rank"].tolist() == list(range(1, len(rs) + 1))
        assert list(zip(-rs.score, rs.vec_id, strict=True)) == want[q]


def test_va_bounds_hold():
    rng = np.random.default_rng(0)
    lo, hi = np.full(6, -5000), np.full(6, 7000)
    x = rng.integers(-5000, 7001, (200, 6))
    a, z = vafile.cell_bounds(vafile.cell_of(x, lo, hi), lo, hi)
    assert (a <= x).all() and (x <= z).all()


def test_va_first_reads_do_not_matter(spark, rows):
    df = table(spark, rows[:300])
    q = df.where("vec_id % 100 = 0")
    a, b = (vafile.search(df, q, first=f).orderBy("query_id", "rank").collect() for f in (1, 64))
    assert a == b


def test_neighbours_reach_recall_with_exact_scores(spark, rows):
    df = table(spark, rows)
    got = srs.search(df, df.where("vec_id % 100 = 0"), block_rows=4, sample_rows=100, tree_rows=128).toPandas()
    want = brute(rows, 10, False)
    assert set(got.query_id) == set(want)
    hit = total = 0
    for q, rs in got.groupby("query_id"):
        rs = rs.sort_values("rank")
        assert rs["rank"].tolist() == list(range(1, len(rs) + 1)) and len(rs) == len(want[q])
        assert list(zip(rs.score, rs.vec_id, strict=True)) == sorted(zip(rs.score, rs.vec_id, strict=True))
        vec = dict(usable(rows, False))
        assert np.allclose(rs.score, [np.sqrt(((vec[q] - vec[i]) ** 2).sum()) for i in rs.vec_id], atol=1e-12)
        hit += len({i for _, i in want[q]} & set(rs.vec_id))
        total += len(want[q])
    assert hit / total >= 0.9


def test_repeated_query_rows_hide_no_equal_vector(spark):
    rng = np.random.default_rng(6)
    same = rng.standard_normal(8) + 3.0
    rows = [(100, same)] * 12 + [(205, same), (207, same)] + [(i, rng.standard_normal(8)) for i in range(300, 340)]
    df = table(spark, rows)
    for search in (vafile.search, srs.search):
        got = search(df, df.where("vec_id = 100")).orderBy("rank").toPandas()
        assert len(got) == 10 and got.vec_id[:2].tolist() == [205, 207] and got.score[0] == got.score[1]


def test_searches_on_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = table(spark, [(100, [1.0, 2.0])])
    for search in (vafile.search, srs.search):
        assert search(empty, empty).count() == 0
        assert search(some, empty).count() == 0
        assert search(some, some).count() == 0  # the query's own row is no candidate
        assert search(empty, some).count() == 0


def test_tree_gives_leaves_in_order():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((500, 4))
    tree = srs.Tree(points, leaf=16).finish()
    at = [(d, r) for d, r in tree.leaves(np.zeros(4))]
    assert [d for d, _ in at] == sorted(d for d, _ in at)
    assert sorted(i for _, r in at for i in r) == list(range(500))
    assert all((points[r] ** 2).sum(1).min() >= d - 1e-12 for d, r in at)


def test_the_stop_spares_most_rows_where_recall_is_high():
    """Unit vectors of 64 dimensions with groups: under half of the rows are verified, over nine tenths of the neighbours found."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 64)) + 1.2 * rng.standard_normal((60, 64))[rng.integers(0, 60, 6000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, flat = np.arange(len(x)), srs.projections(64, 32, 11)
    tree, limit = srs.Tree(x @ flat).finish(), srs.chi_square_quantile(0.93, 32)
    hit = read = 0
    for own in range(0, 6000, 150):
        d = ((x - x[own]) ** 2).sum(1)
        d[own] = np.inf
        i, s, n = srs.nearest(tree, ids, x, own, x[own], x[own] @ flat, 10, limit, np.inf)
        hit += len({*np.argsort(d)[:10].tolist()} & {*i.tolist()})
        read += n
        assert len(i) == 10 and np.allclose(s, d[i])
    assert hit / 400 >= 0.9 and read / (40 * 6000) < 0.5


def test_chi_square_values():
    assert abs(srs.chi_square_quantile(0.95, 8) - 15.50731) < 1e-4  # a table's value
    assert abs(srs.chi_square_cdf(9.48773, 4) - 0.95) < 1e-5
