"""op13: the documents that match each benchmark item best."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.lexical import lexical_search


def op13_lexical_search(spark, sf_dir):
    """The 20 best documents of every item, over all documents."""
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


_TERMS = "list_transform(regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"

SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, {_TERMS.format("coalesce(text, '')")} AS terms FROM documents),
s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
q AS (SELECT item_id, place, term, count(*) AS asked FROM (
        SELECT item_id, place, unnest(terms) AS term FROM (
          SELECT item_id, row_number() OVER () AS place, {_TERMS.format("coalesce(text, '')")} AS terms FROM benchmark) i) u
      GROUP BY ALL),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) u
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term) f, s),
i AS (SELECT d.doc_id, p.row, p.term,
             (1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * len(d.terms) * s.docs) // s.total)) AS impact
      FROM p JOIN d USING (row), s),
r AS (SELECT q.item_id, q.place, i.row, any_value(i.doc_id) AS doc_id, sum(q.asked * w.weight * i.impact)::BIGINT AS score
      FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY q.item_id, q.place, i.row)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM r WHERE score > 0) t
WHERE rank <= 20
"""
