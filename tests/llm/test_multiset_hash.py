import hashlib
import random
import re

from conftest import AWKWARD, rows_of
from pyspark.sql import functions as F

from taxograde.llm import multiset_hash as M


def vector(text):
    dense, sparse = [0] * 8, [0] * (M.LANES * M.LEVELS)
    for p in re.split(M.SEPARATORS, text):
        if p.strip(" "):
            d = hashlib.sha256(p.strip(" ").encode()).hexdigest()
            x = [int(d[15 * j:15 * j + 15], 16) for j in range(4)]
            for j in range(4):
                dense[2 * j] = (dense[2 * j] + x[j] % 2 ** 30) % 2 ** 30
                dense[2 * j + 1] = (dense[2 * j + 1] + (x[j] >> 30)) % 2 ** 30
            level = next((k for k in range(3) if x[3] >> (4 + 2 * k) & 3), 3)
            lane = M.LANES * level + x[3] % 16
            sparse[lane] = (sparse[lane] + x[0] % 2 ** 14) % 2 ** 14
    return ([dense[2 * j] | dense[2 * j + 1] << 32 for j in range(4)]
            + [sum(sparse[4 * w + k] << 16 * k for k in range(4)) for w in range(16)]), sparse


def string(v):
    return "".join(f"{x:016x}" for x in v[0])


def near(a, b):
    pairs = [(x, y) for x, y in zip(a[1], b[1]) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def brute(rows):
    best = {}
    for d, t in rows:
        if d is not None:
            best[d] = min(best.get(d, t or ""), t or "")
    order = sorted(best, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    out = []
    for d, t in rows:
        t = t or ""
        n, cut = len(t), len(t) // 3
        nxt = best[after[d]] if d is not None else None
        edited = t[:n - cut] + (nxt[:cut] if nxt is not None else "")
        v, e = vector(t), vector(edited)
        out.append((d, n, hashlib.sha256(edited.encode()).hexdigest(), string(v), string(e), near(v, e),
                    near(v, vector(nxt)) if nxt is not None else 0.0))
    return out


def check(df, rows):
    got = [tuple(r.values()) for r in rows_of(M.fingerprints(df))]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_awkward_rows(awkward, empty):
    check(awkward, [(r[0], r[1]) for r in AWKWARD])
    assert M.fingerprints(empty).count() == 0


def test_sparse_and_negative_ids(spark):
    rng = random.Random(4)
    ids = sorted({rng.choice([1, -1]) * rng.randrange(10 ** rng.randint(1, 18)) for _ in range(200)})
    rows = [(i, ". ".join(str(rng.randrange(50)) for _ in range(rng.randint(0, 30)))) for i in ids]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    check(spark.createDataFrame(rows[:1], "doc_id long, text string"), rows[:1])


def test_order_does_not_matter_and_pieces_come_and_go(spark):
    df = spark.createDataFrame([("a. b. c. c", "c\nb? a; c", "c. c", "a. b")], "x string, y string, p string, q string")
    v = {c: M.vector(M.pieces(F.col(c))) for c in "xypq"}
    r = df.select(*[v[c].alias(c) for c in "xypq"], M.plus(v["p"], v["q"]).alias("sum"), M.minus(v["x"], v["p"]).alias("rest")).first()
    assert r.x == r.y == r["sum"] and r.rest == r.q and r.p != r.q


def test_plan_has_no_python(documents):
    plan = M.fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
