"""op4: licence sentences and rules over all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.licenses import (APART, CLAIM, HELD_AS, HELD_BY, LINE_END, LOWER, RESERVED, RULES, SENTENCE_END, SENTENCES,
                                 UPPER, _in_places, scan_licenses)


def op4_license_scan(spark, sf_dir):
    """Licences that the sentences of each document name."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _ids(end: str) -> str:
    plain = ("list_transform(regexp_split_to_array(t, E'" + end.replace("\\", "\\\\") + "'), "
             "lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))")
    named = (f"regexp_replace(regexp_replace(s, '{HELD_BY[0]}', '{HELD_AS}'), '^{CLAIM[0]}.*{CLAIM[1]}$', "
             f"'{SENTENCES[RESERVED]}')")
    token = (f"CASE WHEN list_position(k.known, {named}) > 0 THEN ' ' || list_position(k.known, {named}) || ' ' "
             "WHEN s = '' THEN '' ELSE '.' END")
    return f"list_aggregate(list_transform({plain}, lambda s: {token}), 'string_agg', '')"


def _marked(column: str) -> str:
    out = f"replace({column}, '.', '')"
    for number, (_, _, run) in enumerate(RULES, 1):
        if run != (RESERVED,):
            out = f"replace({out}, '{''.join(f' {k} ' for k in run)}', ' R{number} ')"
    return out


def _alone(column: str, marked: str) -> str:
    alone = f"replace({column}, ' {RESERVED} ', ' P ')"
    for _ in range(2):
        alone = f"regexp_replace({alone}, ' P (\\.{{0,{APART}}} [0-9])', '\\1', 'g')"
        alone = f"regexp_replace({alone}, '([0-9] \\.{{0,{APART}}}) P ', '\\1', 'g')"
    return f"(contains({alone}, ' P ') OR (contains({column}, ' {RESERVED} ') AND NOT contains({marked}, ' R')))"


_RULE = next(n for n, (_, _, run) in enumerate(RULES, 1) if run == (RESERVED,))


def _names(values: list[str]) -> str:
    table_sql = "[" + ", ".join(map(_literal, values)) + "]"
    return (f"list_sort(list_distinct(list_transform(regexp_extract_all(m, 'R([0-9]+)', 1), "
            f"lambda r: ({table_sql})[r::INT])))")


SQL = f"""
WITH k AS (SELECT [{', '.join(map(_literal, _in_places()))}] AS known),
s AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
i AS (SELECT doc_id, len(list_filter(regexp_split_to_array(t, E'{LINE_END.replace(chr(92), chr(92) * 2)}'),
             lambda x: regexp_matches(x, '[A-Za-z0-9]'))) AS n_sentences, coalesce({_ids(LINE_END)}, '') AS by_line,
             coalesce({_ids(SENTENCE_END)}, '') AS by_sentence FROM s, k),
n AS (SELECT *, replace(by_line, '.', '') AS lines, replace(by_sentence, '.', '') AS cuts,
             {_marked('by_line')} AS m_line, {_marked('by_sentence')} AS m_sentence,
             contains(by_line, ' {RESERVED} ') AS in_line, contains(by_sentence, ' {RESERVED} ') AS in_sentence FROM i),
a AS (SELECT *, {_alone('by_line', 'm_line')} AS line_alone, {_alone('by_sentence', 'm_sentence')} AS sentence_alone FROM n),
m AS (SELECT *, m_line || '|' || m_sentence || CASE WHEN CASE WHEN in_line AND in_sentence THEN line_alone AND sentence_alone
             WHEN in_sentence THEN sentence_alone AND NOT contains(m_line, ' R')
             ELSE line_alone AND NOT contains(m_sentence, ' R') END THEN ' R{_RULE} ' ELSE '' END AS m,
             CASE WHEN length(cuts) > length(lines) THEN cuts ELSE lines END AS ids FROM a)
SELECT doc_id, n_sentences, replace(trim(ids), '  ', ',') AS sentence_ids,
       coalesce(list_aggregate({_names([n for n, _, _ in RULES])}, 'string_agg', ','), '') AS licenses,
       coalesce(list_aggregate({_names([k for _, k, _ in RULES])}, 'string_agg', ','), '') AS kinds,
       list_contains({_names([k for _, k, _ in RULES])}, 'restricted') AS restricted FROM m
"""
