"""op9: the whole corpus mixed to weights 5, 2, 1."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.llm.common import table
from barlab.llm.mixing import curriculum_mix, training_order


def op9_mixing(spark, sf_dir):
    """Words that the mix takes of each document, summed over its copies in
    training order."""
    ordered = training_order(curriculum_mix(table(spark, sf_dir, "documents")))
    return (ordered.groupBy("source", "bucket", "row", "doc_id", "size", "source_size", "target")
            .agg(F.sum(F.when(F.col("position").isNotNull(), F.col("size")).otherwise(0)).alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


SQL = """
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS h FROM documents),
p AS (
  SELECT *, row_number() OVER o AS rn,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size DESC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM r WINDOW o AS (PARTITION BY source ORDER BY h, doc_id, size DESC)),
s AS (SELECT source, sum(size)::DOUBLE AS source_size, 3.0::DOUBLE * sum(size) AS cap,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM r GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(turn % 3 + 1)::INT]::DOUBLE AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT min_by(level, (cap / weight, turn)) AS water FROM l WHERE cap >= weight * level),
t AS (SELECT source, source_size, least(cap, coalesce(weight * water, cap)) AS target FROM l, v),
c0 AS (
  SELECT p.*, t.source_size, t.target, CASE WHEN size = 0 THEN 0 ELSE least(greatest(coalesce(
           ceil((target - (start + size / 2.0::DOUBLE)) / nullif(source_size, 0)), 0), 0), 3) END::BIGINT AS copies
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
o0 AS (SELECT source, first(target) - sum(copies * size) AS gap FROM c0 GROUP BY source),
b0 AS (
  SELECT c0.source, min_by(rn, (abs(size - abs(gap)), rn)) AS rn, sign(first(gap))::BIGINT AS change
  FROM c0 JOIN o0 ON c0.source IS NOT DISTINCT FROM o0.source
  WHERE size > 0 AND abs(size - abs(gap)) < abs(gap) AND CASE WHEN gap > 0 THEN copies < 3 ELSE copies > 0 END
  GROUP BY c0.source),
c1 AS (SELECT c0.* REPLACE (copies + coalesce(change, 0) AS copies) FROM c0
       LEFT JOIN b0 ON c0.source IS NOT DISTINCT FROM b0.source AND c0.rn = b0.rn),
o1 AS (SELECT source, first(target) - sum(copies * size) AS gap FROM c1 GROUP BY source),
b1 AS (
  SELECT c1.source, min_by(rn, (abs(size - abs(gap)), rn)) AS rn, sign(first(gap))::BIGINT AS change
  FROM c1 JOIN o1 ON c1.source IS NOT DISTINCT FROM o1.source
  WHERE size > 0 AND abs(size - abs(gap)) < abs(gap) AND CASE WHEN gap > 0 THEN copies < 3 ELSE copies > 0 END
  GROUP BY c1.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, ((copies + coalesce(change, 0)) * size)::BIGINT AS taken
FROM c1 LEFT JOIN b1 ON c1.source IS NOT DISTINCT FROM b1.source AND c1.rn = b1.rn
"""
