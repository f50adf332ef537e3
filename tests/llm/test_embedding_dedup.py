import uuid

import numpy as np

from playstream.llm import embedding_dedup as E

from .oracle import assert_matches_sql


def brute(rows, cosine=0.98):
    """Per row: links to other rows, and the smallest id reachable."""
    ok = [i is not None and lab is not None and e is not None and len(e) > 0 and None not in e and np.isfinite(e).all() and np.any(e) for i, e, lab in rows]
    unit = [np.array(e, dtype=float) / np.linalg.norm(np.array(e, dtype=float)) if k else None for k, (_, e, _) in zip(ok, rows)]
    near = [[b for b in range(len(rows)) if a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in range(len(rows))]
    out = []
    for a, (i, _, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low = None if i is None else min(rows[b][0] for b in seen)
        out.append((i, len(near[a]), low, True if i is None else low == i))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, block string").repartition(4)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_embeddings(df, **kw).collect()), key=repr)


def test_query_matches_sql(spark):
    assert_matches_sql(spark, "op10_epsilon_grid_order")


def test_chains_copies_and_blocks(spark):
    rng = np.random.RandomState(4)
    rows = []
    for label in (1, 1, 2, 3):
        at = rng.randn(12)
        for _ in range(60):  # a walk: neighbours link, ends don't
            at = at + rng.randn(12) * 0.12
            rows.append((at * rng.uniform(0.1, 9)).tolist() + [label])
    rows += [rows[3]] * 25 + [rows[70]] * 4 + [(rng.randn(12)).tolist() + [2] for _ in range(150)]
    rows = [(i, r[:-1], r[-1]) for i, r in zip(rng.permutation(len(rows)).tolist(), rows)]
    want = brute(rows)
    assert sum(n for _, n, _, _ in want) > 500
    assert run(spark, rows) == want
    assert run(spark, rows, block=16) == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], None),
            (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [5.0, 0.0, 0.0], 1), (12, [], 1), (13, [1e-200, 1e-201], 1), (14, [1e-200, 1e-201], 1), (2, [2.0, 0.0], 1)]
    assert run(spark, rows) == brute([(i, [x * 1e200 for x in e] if i in (13, 14) else e, lab) for i, e, lab in rows])
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert run(spark, []) == []


def test_skipping_is_exact():
    rng = np.random.RandomState(9)
    x = E._unit(rng.randn(700, 8) * np.array([3, 2, 1, 1, 1, 1, 1, 1]))
    at = x[:, :3]
    order = np.lexsort(np.floor(at / 0.2).T[::-1])
    x, at = x[order], at[order]
    i, j = E.close_pairs(x, x, at, at, 0.2, 0.98)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.98))))


def test_a_vector_is_sent_to_few_blocks(spark, tmp_path, monkeypatch):
    """One label holds all vectors, and no direction tells them apart."""
    rng, meet = np.random.RandomState(6), E._meet
    for n in (500, 2000):
        x = rng.randn(n, 16)
        x[n // 2:n // 2 + 20] = x[:20] + rng.randn(20, 16) * 0.01
        rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
        noted = tmp_path / str(n)
        noted.mkdir()

        def counted(*args, to=str(noted)):
            def run(batches):
                batches = list(batches)
                with open(f"{to}/{uuid.uuid4().hex}", "w") as f:
                    f.write(str(sum(map(len, batches))))
                yield from meet(*args)(iter(batches))
            return run

        monkeypatch.setattr(E, "_meet", counted)
        assert run(spark, rows, block=50) == brute(rows)
        sent = sum(int(p.read_text()) for p in noted.iterdir())
        assert sent <= (E.BLOCKS + 8 + 1) * n  # eight range partitions
