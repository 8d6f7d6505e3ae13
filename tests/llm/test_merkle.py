"""The manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import manifest_queries, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, _rank int"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r: dict) -> str:
    return h(*[field(r[k]) for k in merkle.FIELDS])


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf its (left, right) siblings from the bottom up."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, i in zip(paths, at):
            run, j = runs[i // 16], i % 16
            path.append(("".join(run[:j]), "".join(run[j + 1 :])))
        at = [i // 16 for i in at]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def expected(rows: list[dict]) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made[s] = tree([leaf(r) for r in groups[s]])
    root, tops = tree([made[s][0] for s in names])
    out = []
    for s, above in zip(names, tops):
        for r, path in zip(groups[s], made[s][1]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None
            small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]) if tampered else r["text"]
            f, path = leaf({**r, "text": small}), path + above
            for left, right in path:
                f = h(left, f, right)
            out.append((r["doc_id"], leaf(r), made[s][0], root, h(*[a + b for a, b in path]), f, f == root))
    return sorted(out, key=repr)


def rows_of(sizes: dict) -> list[dict]:
    out, n = [], 0
    for s, size in sizes.items():
        for _ in range(size):
            n += 1
            out.append({"doc_id": (n * 7919) % 10007, "text": [None, "", "Ab ÄÖ c", "x" * 50][n % 4], "lang": None if n % 5 == 0 else "de", "source": s, "n_chars": None if n % 7 == 0 else n, "digest": "clash", "_rank": 3})
    return out


@pytest.fixture()
def result(spark, tmp_path, monkeypatch):
    def run(rows: list[dict]) -> list[tuple]:
        d = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
        d.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        got = manifest_queries.merkle_manifest(spark, str(tmp_path))
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return sorted([tuple(r) for r in got.collect()], key=repr)
    return run


def test_trees_of_all_shapes(result):
    # A lone leaf, a full record, one more than a full record, three levels, a null group; more than sixteen groups.
    sizes = {"one": 1, "full": 16, "more": 17, "deep": 300, None: 3, "Ä": 2, "": 2, **{f"s{i}": 1 for i in range(12)}}
    rows = rows_of(sizes)
    want = expected(rows)
    assert result(rows) == want
    assert {w[-1] for w in want} == {True, False}


def test_repeated_rows_null_ids_one_group_and_nothing(result):
    same = {"doc_id": 1, "text": "Twice", "lang": "en", "source": "a", "n_chars": 5, "digest": None, "_rank": None}
    rows = [dict(same) for _ in range(40)] + [{**same, "doc_id": None}, {**same, "doc_id": None, "text": None}]
    assert result(rows) == expected(rows)
    assert result([dict(same)]) == expected([dict(same)])
    assert result([]) == []


def test_only_wanted_leaves_and_the_store(spark):
    rows = rows_of({"a": 40, "b": 1, None: 18})
    d = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    m = merkle.build(d, {"id": F.col("doc_id")})
    picked = [rows[3]["doc_id"], rows[40]["doc_id"], rows[55]["doc_id"]]
    some = merkle.proofs(m, F.col("id").isin(picked))
    everything = {r["id"]: r for r in merkle.proofs(m).collect()}
    got = some.collect()
    assert sorted(r["id"] for r in got) == sorted(picked)
    assert all(r == everything[r["id"]] for r in got)
    store = {r["digest"]: r["children"] for r in m.store().collect()}
    assert all(k == h(*v) and 1 <= len(v) <= 16 for k, v in store.items())
    # Every leaf is found from the root by following children.
    reach, held = [m.root], set()
    while reach:
        x = reach.pop()
        held.add(x)
        reach += store.get(x, [])
    assert {leaf(r) for r in rows} <= held


def test_no_path_is_broadcast(spark):
    # A lone leaf, a record and three levels; more than sixteen groups, so that paths begin above the groups.
    rows = rows_of({"one": 1, "full": 16, "deep": 300, **{f"s{i}": 1 for i in range(15)}})
    d = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    m = merkle.build(d, {"id": F.col("doc_id")})
    for wanted in (None, F.col("id") < 5000):
        got = merkle.proofs(m, wanted)
        assert got.collect()
        ran = got._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in ran
        joins = [line for line in ran.split("== Initial Plan ==")[0].splitlines() if "Join" in line]
        # Wanted places may be broadcast to choose nodes; what nodes are made of may not, however small it seems.
        assert not [line for line in joins if "BroadcastHashJoin" in line and "LeftSemi" not in line]
        assert [line for line in joins if "SortMergeJoin" in line]
