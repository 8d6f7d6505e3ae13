"""The manifest operator as a query, and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import merkle

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_leaf() -> Column:
    """The leaf of a row whose text's capitals A-Z are small, where 5 divides the checksum of its id; else null. A null id is never tampered with."""
    fields = [F.translate(F.col(c), _UPPER, _LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf(fields))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    d = merkle.proofs(merkle.build(docs, {"id": F.col("doc_id"), "tampered": tampered_leaf()}))
    d = d.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "digest"), F.col("path")))
    return d.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(depth: int = 5, top: int = 4) -> str:
    """Trees of up to 16 ** depth leaves and 16 ** top sources, level by level."""
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in [text if f == "text" else f for f in merkle.FIELDS]) + ")"

    # The checksum by its definition: eight shifts a byte.
    bits = "list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1])))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    parts = [
        f"l AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN xor(list_reduce({bits}, lambda a, x: {step}), 4294967295) % 5 = 0 THEN {leaf(f'''translate(text, '{_UPPER}', '{_LOWER}')''')} END AS tampered FROM documents)",
        "n0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS size, leaf AS h FROM l)",
    ]

    def level(k: int, name: str) -> str:
        return f"{name}{k} AS (SELECT source, rank // 16 AS rank, (size + 15) // 16 AS size, sha256(string_agg(h, '' ORDER BY rank)) AS h FROM {name}{k - 1} WHERE size > 1 GROUP BY source, rank // 16, (size + 15) // 16)"

    def beside(k: int, name: str) -> str:
        by = "PARTITION BY source, rank // 16 ORDER BY rank ROWS BETWEEN"
        return (f"{name}x{k} AS (SELECT source, rank, coalesce(string_agg(h, '') OVER ({by} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lo, "
                f"coalesce(string_agg(h, '') OVER ({by} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS hi FROM {name}{k} WHERE size > 1)")

    parts += [level(k, "n") for k in range(1, depth + 1)]
    parts.append("sub AS (" + " UNION ALL ".join(f"SELECT source AS of, h FROM n{k} WHERE size = 1" for k in range(depth + 1)) + ")")
    parts.append("s0 AS (SELECT 0 AS source, of, row_number() OVER (ORDER BY of NULLS FIRST) - 1 AS rank, count(*) OVER () AS size, h FROM sub)")
    parts += [level(k, "s") for k in range(1, top + 1)]
    parts += [beside(k, "n") for k in range(depth)] + [beside(k, "s") for k in range(top)]
    parts.append("root AS (" + " UNION ALL ".join(f"SELECT h FROM s{k} WHERE size = 1" for k in range(top + 1)) + ")")
    parts.append("f0 AS (SELECT n0.doc_id, n0.source, n0.leaf, n0.rank, s0.rank AS srank, s0.h AS subroot, coalesce(tampered, leaf) AS f, '' AS proof FROM n0 JOIN s0 ON n0.source IS NOT DISTINCT FROM s0.of)")
    steps = [("n", k) for k in range(depth)] + [("s", k) for k in range(top)]
    for i, (name, k) in enumerate(steps):
        place = f"p.source IS NOT DISTINCT FROM x.source AND p.rank // {16**k} = x.rank" if name == "n" else f"p.srank // {16**k} = x.rank"
        parts.append(f"f{i + 1} AS (SELECT p.* REPLACE (CASE WHEN x.rank IS NULL THEN f ELSE sha256(lo || f || hi) END AS f, proof || coalesce(lo || hi, '') AS proof) FROM f{i} p LEFT JOIN {name}x{k} x ON {place})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified FROM f{len(steps)}, root"


QUERIES = {"op13_merkle_manifest": merkle_manifest}
SQL = {"op13_merkle_manifest": _sql()}
