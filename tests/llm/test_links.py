"""The two similarity joins against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import blocks, chosen_path, lattice

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out: list[str | None] = []
    for _ in range(30):
        text = [rng.choice(words) for _ in range(rng.randint(40, 160))]
        out.append(" ".join(text))
        for _ in range(rng.choice([0, 0, 1, 3])):
            near = list(text)
            for _ in range(rng.choice([0, 1, 2, 6])):
                near[rng.randrange(len(near))] = rng.choice(words)
            out.append(" ".join(near))
    shared = " ".join(rng.choice(words) for _ in range(60))
    out += [shared + " " + " ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    return [*out, None, "", " \n", "one two", "one two", "one two three", "x" * 30000, "a b c d e", "a b c d e"]


def _brute(rows):
    def grams(t):
        w = [x for x in (t or "").replace("\n", " ").split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    sets = [grams(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    low = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low.append(min(rows[j][0] for j in seen))
    return {(r[0], len(n), c) for r, n, c in zip(rows, near, low)}


@pytest.mark.parametrize("small,block", [(256, 1024), (3, 4)])
def test_jaccard_links_equal_brute_force(spark, small, block):
    rows = list(enumerate(_texts()))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(5)
    got = {(r.doc_id, r.n_links, r.component_id) for r in chosen_path.jaccard_links(df, small=small, block=block, recall=0.9999).collect()}
    assert got == _brute(rows)


def test_recall_where_buckets_are_split_twice(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**31, (3000, 64))
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 2**31, a.shape))
    rows = [(f"{s}{i}", low.tolist()) for s, x in (("a", a), ("b", b)) for i, low in enumerate(x)]
    nodes = spark.createDataFrame(rows, "node string, low array<int>")
    # Each bucket counts as crowded, down to the production depth; the production recall.
    got = chosen_path.bucket_rows(nodes, 0.8, 0.99, 0, 3).select("path", "node").collect()
    buckets = {}
    for path, node in got:
        buckets.setdefault(path, set()).add(node)
    met = {n[1:] for nodes in buckets.values() for n in nodes if ("b" if n[0] == "a" else "a") + n[1:] in nodes}
    enough = (a == b).sum(axis=1) >= chosen_path.floor_for(0.8, 0.99)
    assert sum(enough[int(i)] for i in met) >= 0.99 * len(a)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(3, text, "en", "s", 1), (2, text, "en", "s", 1), (2, text, "en", "s", 1), (2, text + " more", None, None, None), (None, "another text of some words", "en", "s", 1),
            (7, None, "en", "s", 1), (8, "", "en", "s", 1), (8, "", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    kept = chosen_path.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr)
    assert len(got) == 5 and [g for g in got if g[0] in (None, 7, 8)] == sorted([(None, "another text of some words"), (7, None), (8, ""), (8, "")], key=repr)
    assert sum(g[0] == 2 for g in got) == 1


def test_joins_of_empty_tables(spark):
    assert chosen_path.jaccard_links(spark.createDataFrame([], DOCS)).count() == 0
    assert chosen_path.one_of_each(spark.createDataFrame([], DOCS)).count() == 0
    assert lattice.vector_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(300, 8)) * 2
    first, second = lattice.decode_e8(y)
    roots = [np.zeros(8)]
    for i in range(8):
        for j in range(i):
            for a in (-1, 1):
                for b in (-1, 1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    roots.append(v)
    roots += [np.array([1 if k >> i & 1 else -1 for i in range(8)]) / 2 for k in range(256) if bin(k).count("1") % 2 == 0]
    d = ((y - first / 2) ** 2).sum(axis=1)
    for r in roots:
        assert (d <= ((y - first / 2 - r) ** 2).sum(axis=1) + 1e-9).all()
    assert ((first.sum(axis=1) % 4) == 0).all() and ((first - second) % 2 == 1).all()


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 64))
    near = base[:60] + rng.normal(size=(60, 64)) * rng.uniform(0.05, 0.6, (60, 1))
    crowd = base[0] + rng.normal(size=(40, 64)) * 0.05
    rows = [[float(x) for x in np.float32(v)] for v in np.concatenate([base, near, crowd])]
    rows += [rows[0], [2 * x for x in rows[0]], None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] * 64, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.vector_links(df, block=16).collect()}
    ok = [i for i, v in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: [j for j in ok if i != j and i in ok and len(rows[i]) == len(rows[j]) and np.dot(rows[i], rows[j]) / np.linalg.norm(rows[i]) / np.linalg.norm(rows[j]) >= 0.9] for i in range(len(rows))}
    want_links, got_links = sum(len(x) for x in links.values()), sum(n for n, _, _ in got.values())
    # Never more than there are; nearly all are found.
    assert all(got[i][0] <= len(links[i]) for i in got) and got_links >= 0.97 * want_links
    assert all(got[i] == (0, i, True) for i in range(len(rows)) if i not in ok)
    assert len(got) == len(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    with np.errstate(over="ignore"):
        a, b = lattice.cells(x, 24, 2, 1.5, 5), lattice.cells(y, 24, 2, 1.5, 5)
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) >= 0.97


def test_components_of_a_chain(spark):
    import hashlib

    name = [hashlib.md5(str(i).encode()).hexdigest() for i in range(60)]
    edges = spark.createDataFrame([(name[i], name[i + 1]) for i in range(40)] + [(name[50], name[51]), (name[50], name[50])], "a string, b string")
    roots = {r.node: r.root for r in blocks.components(edges, "test").collect()}
    assert len({roots[n] for n in name[:41]}) == 1 and roots[name[50]] == roots[name[51]] != roots[name[0]] and len(roots) == 43


def test_hot_paths_and_roots_are_spread(spark):
    """One path and one root with nine tenths of the rows: the same rows as by a plain join, over many partitions."""
    rows = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("node"), F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("path"), "id")
    rows = rows.union(rows.where("id = 50"))
    got = blocks.crowded(rows.select("node", "path"), "path")
    assert {(r.path, r.n) for r in got.collect()} == {(1, 1800), (50, 2)} and got.count() == 1802
    placed = rows.select("node", F.col("path").alias("root"), F.col("id").alias("class_id"))
    low = blocks.with_lowest(placed, placed.select("node", "root"))
    assert all(r.component_id == (1 if r.root == 1 else r.root) for r in low.collect()) and low.count() == 2001
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        for d in (blocks.crowded(rows.select("node", "path"), "path"), blocks.with_lowest(placed, placed.select("node", "root"))):
            sizes = [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) > 10 and max(sizes) < 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
