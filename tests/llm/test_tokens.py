import random

import numpy as np
import pytest

from barlab.llm.packing import best_fit_decreasing, load_ranks, pack_tokens, segments, write_packed
from barlab.llm.q_tokens import tokenizer_path
from barlab.llm.tokens import NEWER, Lengths, count_tokens, frequent_pretokens, load_tokenizer, pre_tokens
from tests.llm.conftest import SCHEMA, edge_rows, rows_of

PATH = tokenizer_path("byte_bpe_50k.json")
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
HARD = ["a  b   c", " lead", "trail  ", "x\n\n y\t\tz", "don't we'll 'tis it''s I'M", "12 345a6", "<|endoftext|>a<|endoftext|>",
        "<|endoftext|><|endoftext|>", "a\x1cb\x85c\xa0d e", "🙂🙂 👍", "ß𐀀𝔘", "՘ ꟎", "\x00\x01", "日本 語", "éa",
        "½ ² Ⅷ", " " * 300, "a" * 5_000, "\r\n\r\n"]


def library_count(text):
    return len(load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()] + [(100 + k, t) for k, t in enumerate(HARD)]
    hard = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    want = [(i, len((t or "").encode()), library_count(t), library_count(t) > 512) for i, t in rows]
    assert rows_of(count_tokens(hard, PATH), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(
        want, key=lambda r: tuple((v is not None, v) for v in r))
    assert count_tokens(edge, PATH).count() == len(edge_rows())
    assert count_tokens(empty, PATH).collect() == []


def test_frequent_table_decides_speed_only(small):
    some = frequent_pretokens(small, PATH, entries=50)
    assert 0 < len(some) <= 50 and all(library_count(t) == n for t, n in some.items())
    a = rows_of(count_tokens(small, PATH, frequent=some), "doc_id", "n_tokens")
    assert a == rows_of(count_tokens(small, PATH, frequent={}), "doc_id", "n_tokens")


def test_full_cache_is_emptied():
    lengths = Lengths(PATH, {" the": 1}, limit=10)
    assert [lengths[f" word{k}"] for k in range(40)] == [library_count(f" word{k}") for k in range(40)]
    assert len(lengths) <= 11 and lengths[" the"] == 1


def test_pre_tokens_agree_for_every_character():
    """Character classes of both libraries, for all characters that are not sent
    to the tokenizer library whole."""
    import re

    from tokenizers import pre_tokenizers
    theirs = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    newer, split = re.compile(NEWER).match, pre_tokens()[0]
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and not newer(chr(c))]
    for start in range(0, len(chars), 256):
        text = "".join(f"a{c}a 1{c}1 !{c}!  {c}  " for c in chars[start:start + 256])
        ends, at = [], 0
        for token in split(text):
            at += len(token)
            ends.append(at)
        assert ends == [o[1] for _, o in theirs(text)]


def documents(packed, row_len, width="<u2"):
    got = {}
    for r in segments(packed, row_len).collect():
        got.setdefault(r["doc_id"], []).append((r["offset"], np.frombuffer(bytes(r["ids"]), width)))
    return {k: np.concatenate([p for _, p in sorted(v, key=lambda x: x[0])]) for k, v in got.items()}


@pytest.mark.parametrize("row_len,end_id", [(16, 50256), (2048, None)])
def test_round_trip(spark, small, row_len, end_id):
    hard = spark.createDataFrame([(1_000 + k, t, None, None, None) for k, t in enumerate(HARD)]
                                 + [(2_000, None, None, None, None), (2_001, "", None, None, None)], SCHEMA)
    docs = small.unionByName(hard)
    packed = pack_tokens(docs, RANKS, row_len=row_len, end_id=end_id, pad_id=7, window_tokens=5_000).cache()
    got, encoder = documents(packed, row_len), load_ranks(RANKS)
    for r in docs.select("doc_id", "text").collect():
        ids = got.get(r["doc_id"], np.empty(0, np.uint16)).tolist()
        if end_id is not None:
            assert ids.pop() == end_id
        assert encoder.decode(ids) == (r["text"] or "")
    for r in packed.collect():
        ids, position = np.frombuffer(bytes(r["ids"]), "<u2"), np.frombuffer(bytes(r["position_ids"]), "<u2")
        ends = r["cu_seqlens"]
        assert len(ids) == len(position) == row_len and ends[0] == 0 and ends[-1] == r["n_tokens"] <= row_len
        assert (ids[ends[-1]:] == 7).all() and len(ends) == len(r["doc_ids"]) + 1 == len(r["offsets"]) + 1
        for a, b in zip(ends, ends[1:]):
            assert b > a and position[a:b].tolist() == list(range(b - a))
    assert packed.select("shard", "row").distinct().count() == packed.count()


def test_packing_edges(edge, empty, spark, tmp_path):
    packed = pack_tokens(edge, RANKS, row_len=64)
    write_packed(packed, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == packed.count() > 0
    assert pack_tokens(empty, RANKS).collect() == []


def test_best_fit_decreasing_is_best_fit():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 101) for _ in range(500)]
    rooms, want = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fitting = [r for r in rooms if r >= lengths[i]]
        room = min(fitting) if fitting else 100
        if fitting:
            rooms.remove(room)
        rooms.append(room - lengths[i])
    got = best_fit_decreasing(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in row) for row in got) == sorted(rooms)
    assert sorted(i for row in got for i in row) == list(range(500))
