import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm.queries import RANKS


@lru_cache(1)
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture
def oracle():
    return library()


def ids(texts):
    return [np.frombuffer(p, "<u4").tolist() for p, _ in bpe.encode_texts(texts, RANKS)]


HARD = [
    "", " ", "  ", "\n", "a", "'", "''", "'s", "''s", " 's", "\n's", "it's'll're 'dx 'lll 'rex 'ra 'v 've", "I'M don'T can't'",
    "  leading", "trailing  ", "tab\tand nbsp  em", "a  b   c\n\n  d \n", "x1y22 33", "a'b'c", "'s's's", "'12 '?s",
    "naïve Straße 東京 123 😀😀 é", "\u001c\u001d\u0085x", "ab\0cd\0", "<|endoftext|>", "—'s “q”", " \n 's", "x'",
]


def test_same_ids_as_the_library_on_hard_texts(oracle):
    assert ids(HARD) == [oracle.encode_ordinary(t) for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("  \n\t 's'tredlvm12aZé.!東'")), max_size=6))
def test_same_ids_on_random_texts(texts):
    assert ids(texts) == [library().encode_ordinary(t) for t in texts]


def test_every_code_point_has_its_class(oracle):
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1" for c in every[k : k + 2000]) for k in range(0, len(every), 2000)]
    assert ids(texts) == [oracle.encode_ordinary(t) for t in texts]


def test_long_texts_are_cut_without_a_trace(oracle, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 97)
    rng = random.Random(5)
    text = "".join(rng.choice(["word ", "it's ", "\n", "\n\nNext", "  \n x", "\n'd", "é", " \n"]) for _ in range(900))
    long = [text, "y" * 1000, "\n" * 500, text.replace("\n", " "), "ab" * 3000 + "\nq"]
    assert ids(long) == [oracle.encode_ordinary(t) for t in long]


def test_one_long_line_is_cut_into_bounded_parts(oracle, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    rng = random.Random(6)
    text = "".join(rng.choice(["word ", "it's ", "x1", "9", "a.b", "'s'", " '", "é ", "  ", "(z)", "'", "re", "\t"]) for _ in range(4000))
    parts = bpe._cuts(text)
    assert "".join(parts) == text and len(parts) > 100 and max(map(len, parts)) < 50 + 80
    assert ids([text]) == [oracle.encode_ordinary(text)]
    assert len(bpe._cuts("é" * 1000)) == 1


def test_query_columns_round_trip_and_odd_rows(spark, oracle):
    rows = [(1, "it's  me\n", "x", b"i"), (1, "it's  me\n", "x", b"i"), (None, None, None, None), (3, "", "x", b"i"), (4, "é" * 70000, "", b"")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids binary")
    out = bpe.digests(docs, RANKS)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = sorted(map(tuple, out.collect()), key=str)
    want = []
    for i, text, *_ in rows:
        found = oracle.encode_ordinary(text or "")
        packed = np.array(found, "<u4").tobytes()
        want.append((i, len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.digests(docs.limit(0), RANKS).collect() == []


def test_offsets_cut_the_text_at_the_slices(spark):
    row = bpe.encode(spark.createDataFrame([(1, "ab's  é\n")], "doc_id int, text string"), RANKS).first()
    spots = np.frombuffer(row.offsets, "<u4").tolist()
    data = "ab's  é\n".encode()
    assert [data[a:b].decode() for a, b in zip(spots, spots[1:])] == ["ab", "'s", " ", " é", "\n"]


def test_slices_of_the_generation_before_are_not_merged_again(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    merger = bpe.Merger({**{bytes([b]): b for b in range(256)}, b"ab": 256, b"abc": 257, b"cd": 258})
    merged = []
    short = merger._short
    merger._short = lambda piece: merged.append(piece) or short(piece)
    found = {p: merger.ids(p) for p in (b"abcd", b"cdab", b"xabc")}  # ab and abc before cd, by rank
    assert [list(np.frombuffer(v, "<u4")) for v in found.values()] == [[257, 100], [258, 256], [120, 257]]
    merger.ids(b"yab")  # a new generation begins
    assert all(merger.ids(p) == v for p, v in found.items()) and merged == [*found, b"yab"]


def test_a_worker_encodes_and_decodes_in_small_batches(spark, oracle):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = bpe.digests(docs, RANKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # one worker a task
    texts = [f"text {k} " + "word it's " * 3000 for k in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": texts})
    largest = max(len(t) for t in texts) * 8
    made = list(bpe._encoded(RANKS, [batch]))
    assert len(made) > 10 and all(b.nbytes < (1 << 20) + largest for b in made)
    back = list(bpe._decoded(RANKS, made))
    assert sum((b.column(0).to_pylist() for b in back), []) == list(range(300))
    assert b"".join(v for b in back for v in b.column(2).to_pylist()) == "".join(texts).encode()


def test_round_trip_equals_decode_of_encode(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(HARD)] + [(None, None)], "doc_id bigint, text string")
    want = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    got = bpe.round_trip(docs, RANKS)
    assert got.schema == want.schema and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
