import numpy as np

from strandwork.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cells string, n_links long"


def rows_of(x, labels, first=0):
    return [(first + k, [float(v) for v in row], None if lab is None else int(lab), 1, "c", 2) for k, (row, lab) in enumerate(zip(x, labels))]


def brute(rows):
    """n_links and components over all pairs."""
    ok = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and len(r[1]) and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    ok = list({(r[0], r[2], tuple(r[1])): r for r in ok}.values())
    x = [np.array(r[1], np.float32).astype(float) for r in ok]
    links, root = {}, {r[0]: r[0] for r in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(ok):
        links[a[0]] = 0
        for j, b in enumerate(ok):
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.98:
                links[a[0]] += 1
                p, q = sorted((top(a[0]), top(b[0])))
                root[q] = p
    return {r[0]: (links.get(r[0], 0), top(r[0])) for r in rows if r[0] is not None}


def test_links_against_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 32))
    x = np.concatenate([base, np.repeat(base[:12], 25, 0) + r.normal(size=(300, 32)) * 0.1, np.repeat(base[:1], 40, 0), r.normal(size=(200, 32))])
    rows = rows_of(x, np.r_[np.arange(60) % 3, np.repeat(np.arange(12) % 3, 25), np.zeros(40), r.integers(0, 3, 200)])
    wanted = brute(rows)
    got = {q["vec_id"]: (q["n_links"], q["component_id"], q["kept"]) for q in E.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    found, true = (sum(v[0] for v in d.values()) for d in (got, wanted))
    assert found == true > 2000  # all links of these rows are found, so links and components are those of all pairs
    assert got == {k: (n, c, k == c) for k, (n, c) in wanted.items()}


def test_a_crowded_cell_meets_in_blocks(spark, monkeypatch):
    """Many near copies of one vector, in doubles; blocks smaller than the cell. Links found never exceed those of all pairs."""
    monkeypatch.setattr(E, "HOME_BLOCK", 40)
    monkeypatch.setattr(E, "VISIT_BLOCK", 50)
    r = np.random.default_rng(9)
    x = np.concatenate([np.repeat(r.normal(size=(1, 16)), 300, 0) + r.normal(size=(300, 16)) * 0.05, r.normal(size=(200, 16))])
    schema = SCHEMA.replace("array<float>", "array<double>")
    rows = rows_of(np.float32(x).astype(float), np.zeros(500))
    wanted = brute(rows)
    got = {q["vec_id"]: (q["n_links"], q["component_id"]) for q in E.near_duplicates(spark.createDataFrame(rows, schema).repartition(3)).collect()}
    assert got == wanted


def test_visits_reach_the_recall_with_many_cells():
    """Codebooks for a large table: pairs at the threshold that the fit has not seen, found from one side."""
    r = np.random.default_rng(12)
    x = E.unit(r.normal(size=(300, 32))[r.integers(0, 300, 8000)] + 0.3 * r.normal(size=(8000, 32)))
    index = E.fitted(x[:4000], 20_000_000)
    assert len(index.left) == 250
    own, away = x[4000:], E.displaced(x[4000:], seed=77)
    home = index.cells(away, 1)[:, 0]
    assert (index.cells(own) == home[:, None]).any(1).mean() >= 0.985


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0, -1.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0] * 4, 1), (7, [1.0, None, 2.0, 3.0], 1), (8, [float("nan"), 1.0, 1.0, 1.0], 1), (9, [float("inf"), 1.0, 1.0, 1.0], 1), (None, v, 1), (10, [2 * a for a in v], 1), (11, [], 1), (12, v[:3], 1), (13, v[:3], 1)]
    rows = [(*r, 1, "c", 2) for r in rows]
    wanted = brute(rows)
    got = [(q["vec_id"], q["n_links"], q["component_id"], q["kept"]) for q in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(rows) and (None, 0, None, False) in got
    assert all((n, c, k) == (*wanted[i], i == c) for i, n, c, k in got if i is not None)
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, [2.0], 1, 1, "c", 2), (2, [5.0], 1, 1, "c", 2), (3, [-1.0], 1, 1, "c", 2)], SCHEMA)
    assert sorted((q["vec_id"], q["n_links"], q["component_id"]) for q in E.near_duplicates(one).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_traversal_visits_the_nearest_cells():
    r = np.random.default_rng(3)
    x = E.unit(r.normal(size=(50, 10)))
    index = E.MultiIndex(r.normal(size=(7, 5)), r.normal(size=(7, 5)), 9)
    a, b = index.distances(x)
    every = (a[:, :, None] + b[:, None, :]).reshape(50, -1)
    assert np.allclose(np.sort(np.take_along_axis(every, index.cells(x), 1), 1), np.sort(every, 1)[:, :9])
