"""op11: all pages written as WARC archives and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.llm.common import table
from barlab.llm.warc import read_warc, write_warc


def op11_warc(spark, sf_dir):
    """What the archives say of each page; ``sound``: the payload read has the
    digest that its record states."""
    archives = write_warc(table(spark, sf_dir, "pages"))
    records = read_warc(spark, archives, payloads=False).filter(F.col("warc_type").isin("response", "revisit"))
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
                          F.col("refers_to_page").alias("refers_to"), "sound")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS best FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN best IS NULL OR best IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN best IS DISTINCT FROM page_id THEN best END AS refers_to, TRUE AS sound
FROM g
"""
