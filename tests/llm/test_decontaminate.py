import hashlib
import random
import re

import pytest

from barlab.llm.decontaminate import SuffixAutomaton, decontaminate, plain, without_contaminated
from tests.llm.conftest import BASE, SCHEMA, edge_rows, rows_of

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=13, share=20):
    windows = []
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        windows += [("" if item is None else str(item), tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text, *_ in rows:
        w, hit, met = words_of(text), set(), set()
        for item, run in windows:
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i:i + len(run)]) == run:
                    hit.update(range(i, i + len(run)))
                    met.add(item)
        out.append((doc, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(),
                    bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
ITEMS = [(10, BASE), (9, "seven wizards boil"), (2, "wizards boil a"), (None, "lazy DOG"), (3, None), (4, "..."),
         (10, "größe über"), (5, "single")]


@pytest.mark.parametrize("block_words", [200_000, 8])
def test_edges(spark, edge, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [r for r in edge_rows() if not r[1] or len(r[1]) < 10_000]
    got = decontaminate(edge.filter("text IS NULL OR length(text) < 10000"), items, block_words=block_words)
    assert rows_of(got, *COLUMNS) == brute(rows, ITEMS)


def test_empty(spark, edge, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(empty, items).collect() == []
    assert decontaminate(edge, items.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0


def test_random_texts_of_few_words(spark):
    """Many overlaps, repeats inside items, short items that nest."""
    rng = random.Random(5)
    draw = lambda n: " ".join(rng.choice("ab cd ef".split()) for _ in range(n))
    items = [(k, draw(rng.randrange(1, 30))) for k in range(25)]
    rows = [(k, draw(rng.randrange(0, 120)), None, None, None) for k in range(60)]
    got = decontaminate(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got, *COLUMNS) == brute(rows, items)


def test_longest_match_is_tracked():
    automaton = SuffixAutomaton([("1", b"a b c d e".split()), ("2", b"c d x".split())], 4)
    assert automaton.scan(b"c d e a b c d x")[:2] == (8, 4)


def test_spans_are_removed(spark):
    doc = f"Before it, {BASE.upper()}! And after."
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    got = decontaminate(spark.createDataFrame([(1, doc, None, None, None), (2, "Clean. Text", None, None, None)], SCHEMA),
                        items, clean=True)
    assert dict(rows_of(got, "doc_id", "clean_text")) == {1: "Before it, ! And after.", 2: "Clean. Text"}


def test_stage_drops_contaminated_rows_only(spark, edge):
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    left = without_contaminated(edge, decontaminate(edge, items))
    assert left.columns == edge.columns
    assert left.count() == sum(BASE not in (r[1] or "") for r in edge_rows())


def test_plain_keeps_length():
    text = "Ab-9É\x7f".encode()
    assert plain(text) == "ab 9É ".encode() and len(plain(text)) == len(text)
