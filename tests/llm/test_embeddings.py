import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, same

from quillspark.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    def good(e, label):
        return label is not None and e and all(c is not None and np.isfinite(c) for c in e) and any(e)

    n = len(rows)
    adj = [[j for j in range(n) if i != j and rows[i][2] == rows[j][2] and good(rows[i][1], rows[i][2]) and good(rows[j][1], rows[j][2]) and len(rows[i][1]) == len(rows[j][1]) and np.dot(rows[i][1], rows[j][1]) / (np.linalg.norm(rows[i][1]) * np.linalg.norm(rows[j][1])) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(adj[i]), min(ids) if ids else None, bool(ids) and rows[i][0] == min(ids)))
    return sorted(map(str, out))


def run(spark, rows, **kw):
    return sorted(str(tuple(r)) for r in embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA), **kw).collect())


def test_query_equals_sql(spark, sf):
    same(queries.op6_vectors(spark, sf), connect(sf), embeddings.oracle())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([2, 3, 64, 1100]), st.sampled_from([0.5, 0.93, 0.999]))
def test_bound_is_rigorous(seed, dim, threshold):
    r = np.random.default_rng(seed)
    base = r.normal(size=(3, dim)) * 10.0 ** r.integers(-6, 6)
    x = (base[r.integers(0, 3, 40)] + r.normal(size=(40, dim)) * np.abs(base).mean() * r.choice([0.0, 0.05, 0.3, 1], size=(40, 1))).astype(np.float32).astype(float)
    c = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    got, sure = embeddings.link_matrix(x, x, threshold), np.abs(c - threshold) > 1e-12
    assert (got == (c >= threshold))[sure].all()


def test_against_brute_force_in_small_tiles(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(12, 8))
    rows = [(int(i), (base[i % 12] + r.normal(size=8) * (0.05 if i % 3 else 0.6)).astype(float).tolist(), int(i % 2)) for i in range(90)]
    rows += [(200 + i, rows[0][1], 0) for i in range(5)]
    rows = [(i, [float(np.float32(c)) for c in e], q) for i, e, q in rows]
    for tile in (7, 1024):
        assert run(spark, rows, tile=tile) == brute(rows, 0.93)


def test_odd_rows(spark):
    e = [1.0, 2.0]
    rows = [(1, e, 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0), (7, e, None), (8, [], 0), (9, [1.0, 2.0, 0.0], 0), (None, e, 0), (1, e, 0), (10, [2.0, 4.0], 0), (11, e, 1), (None, None, None)]
    assert run(spark, rows) == brute(rows, 0.93)
    assert run(spark, []) == []


def test_components_of_any_size_link(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1e-170, 0.0], 1), (2, [1e200, 0.0], 1), (3, [1e200, 1e200], 1), (4, [1e-300, 1e-300], 1), (5, [-1.0, 0.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}
