"""op12: a Merkle manifest of all documents, with some of them tampered."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from barlab.llm.common import table
from barlab.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark, sf_dir):
    """Digests and proofs of the documents as they are; the leaf that is folded is
    that of the document as it was found: lower-cased where 5 divides the checksum
    of its identifier.  A row without identifier is never tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = docs.withColumn("found_text", F.when(tampered, F.translate("text", ascii_uppercase, ascii_lowercase))
                           .otherwise(F.col("text")))
    found = leaf_digest(*[F.col("found_text" if c == "text" else c) for c in FIELDS])
    manifest = merkle_manifest(docs, FIELDS, carry={"found_leaf": found})
    return (manifest.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
                            folded("found_leaf").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def _field(name: str, expr: str | None = None) -> str:
    text = f"CAST({expr or name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _tree(name: str, levels: int) -> list[str]:
    """Levels ``{name}0`` .. of ``g, pos, h, n`` above ``{name}0``, and siblings."""
    out = []
    for i in range(levels):
        out.append(f"{name}{i + 1} AS MATERIALIZED (SELECT g, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, "
                   f"(any_value(n) + 15) // 16 AS n FROM {name}{i} WHERE n > 1 GROUP BY g, pos // 16)")
        run = "PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
        out.append(f"{name}_sib{i} AS MATERIALIZED (SELECT g, pos, "
                   f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
                   f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a "
                   f"FROM {name}{i} WHERE n > 1)")
    return out


def _paths(name: str, levels: int, folds: str, columns: str) -> list[str]:
    """``{name}_p{levels}``: each row of ``{name}0`` with ``proof`` and ``folds``
    folded up to its top."""
    out = []
    for i in range(levels):
        before = f"{name}0" if i == 0 else f"{name}_p{i}"
        step = "p.proof || s.b || s.a" if i else "s.b || s.a"
        kept = "p.proof" if i else "''"
        out.append(f"{name}_p{i + 1} AS MATERIALIZED (SELECT {columns}, CASE WHEN s.g IS NULL THEN {kept} ELSE {step} END AS proof, "
                   f"CASE WHEN s.g IS NULL THEN p.{folds} ELSE sha256(s.b || p.{folds} || s.a) END AS {folds} "
                   f"FROM {before} p LEFT JOIN {name}_sib{i} s ON s.g = p.g AND s.pos = p.pos // {16 ** i})")
    return out


_LOWER, _UPPER = 7, 5  # 16**7 rows of a source, 16**5 sources
#: CRC-32 of the identifier's digits, bit by bit (reversed polynomial 0xEDB88320).
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: CAST(ascii(c) AS BIGINT))), lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)")

SQL = ("WITH f AS (SELECT *, " + _CRC + " % 5 = 0 AS tampered FROM documents), "
       "d AS (SELECT doc_id, coalesce('=' || source, '') AS g, sha256("
       + " || ".join(_field(c) for c in FIELDS) + ") AS h, sha256(" + " || ".join(
           _field(c, f"CASE WHEN tampered THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END"
                  if c == "text" else None) for c in FIELDS) + ") AS found FROM f), "
       "t0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, "
       "count(*) OVER (PARTITION BY g) AS n FROM d), "
       + ", ".join(_tree("t", _LOWER)) + ", subroots AS ("
       + " UNION ALL ".join(f"SELECT g, h FROM t{i} WHERE n = 1" for i in range(_LOWER + 1)) + "), "
       "u0 AS MATERIALIZED (SELECT g AS source, h, h AS folded, 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, "
       "count(*) OVER () AS n FROM subroots), "
       + ", ".join(_tree("u", _UPPER)) + ", root AS ("
       + " UNION ALL ".join(f"SELECT h AS root FROM u{i} WHERE n = 1" for i in range(_UPPER + 1)) + "), "
       + ", ".join(_paths("t", _LOWER, "found", "p.doc_id, p.g, p.pos, p.h")) + ", "
       + ", ".join(_paths("u", _UPPER, "folded", "p.source, p.h, p.g, p.pos")) + ", "
       # a found leaf goes on from its subroot through the upper siblings
       + "e AS (SELECT l.*, u.h AS subroot, u.proof AS upper, u.pos AS upos FROM t_p" + str(_LOWER) + " l JOIN u_p"
       + str(_UPPER) + " u ON u.source = l.g), "
       + ", ".join(f"e{i + 1} AS (SELECT p.* REPLACE (CASE WHEN s.g IS NULL THEN p.found ELSE sha256(s.b || p.found || s.a) END "
                   f"AS found) FROM {'e' if i == 0 else f'e{i}'} p LEFT JOIN u_sib{i} s ON s.pos = p.upos // {16 ** i})"
                   for i in range(_UPPER))
       + f" SELECT doc_id, h AS leaf, subroot, root, sha256(proof || upper) AS proof_sha256, found AS folded_root, "
         f"found = root AS verified FROM e{_UPPER}, root")
