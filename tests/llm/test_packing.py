import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.packing import Limits, Packer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, length string, ids int"


TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def texts(words):
    rng = random.Random(3)
    odd = [None, "", " ", "  two  blanks ", "line\n next\n\n  more\t tab", " lead", "a  b　 c", "it's we'll  '", "<|endoftext|> x <|endoftext|>",
           "日本語 テキスト 。", "\x1c a\x85 b", "w" * 5000, "n" * 70 + " " + "n" * 70, "x  " * 2000, "end.\nNext one\nmore\n\nlast.\n", "a².\nb٣ é.\nÉ!", "trailing ", "don't.\nI'm x\ny"]
    plain = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 50, 400, 3000]))) for _ in range(60)]
    return odd + plain + ["same text"] * 300


def check(pieces, wanted, limit=1024):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(wanted)
    for doc, rows in docs.items():
        rows.sort(key=lambda r: r.start)
        at = 0
        for r in rows:
            assert r.start == at and r.doc_tokens == len(wanted[doc])
            part = np.array(wanted[doc][at:at + r.length], dtype="<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
            at += r.length
        assert at == len(wanted[doc])
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        total = 0
        for r in rows:
            assert r.offset == total
            total += r.length
        assert total <= limit and total & (total - 1) == 0  # no padding at all
        assert len(rows) <= 128


def test_pieces_are_the_tokenizers_ids_without_padding(spark, words):
    rows = list(enumerate(texts(words)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    check(packing.judge(df, PATH).collect(), {i: ids_of(t) for i, t in rows})


def test_small_caches_and_groups_change_nothing(words):
    encoder = packing.Encoder(PATH)
    all_texts = [t or "" for t in texts(words)]
    wanted = [np.array(ids_of(t)[:-1], dtype="<u4").tobytes() for t in all_texts]
    assert list(encoder.batch(all_texts)) == wanted
    old, packing.CACHE = packing.CACHE, 50
    try:
        encoder = packing.Encoder(PATH)
        assert [b for k in range(0, len(all_texts), 7) for b in encoder.batch(all_texts[k:k + 7])] == wanted
    finally:
        packing.CACHE = old


def test_nulls_repeats_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "a b", "x", 1), (4, None, "x", 1), (4, None, "x", 1)], SCHEMA).coalesce(1)
    out = packing.judge(df, PATH).collect()
    assert sorted(((r.doc_id, r.length) for r in out), key=str) == [(4, 1), (4, 1), (None, 3)]
    assert len({r.sequence_id for r in out}) == 2  # of four and of one
    assert packing.judge(df.limit(0), PATH).collect() == []


def test_joined_sequences(spark, words):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts(words)[:30])], SCHEMA)
    pieces = packing.pack_texts(df, PATH)
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        assert bytes(whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)]) == bytes(r.ids)
    assert sum(sum(r.lengths) for r in whole.values()) == sum(len(r.ids) // 4 for r in whole.values())


def loss_of(example, start, length):
    tokens, loss = example
    return max(0, min(loss, start + length - (tokens - loss)))


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize("limits", [Limits(64, 5, 40), Limits(64, 100, 64), Limits(100, 3, 100), Limits(50, 9, 7)])
def test_limits_hold_and_every_token_is_placed_once(cut, limits):
    rng = random.Random(1)
    for sizes in ((1, 30), (1, 3), (20, 63), (50, 200)):
        packer, out, demand = Packer(limits, cut), [], {}
        for k in range(2500):
            tokens = rng.randint(*sizes)
            demand[k] = (tokens, rng.randint(0, tokens))
            out += packer.add(k, *demand[k])
        out += packer.finish()
        assert packer.size == 0
        placed = defaultdict(list)
        for sequence in out:
            total = sum(n for _, _, n in sequence)
            loss = sum(max(0, s + n - max(s, demand[k][0] - demand[k][1])) for k, s, n in sequence)
            if cut or len(sequence) > 1:
                assert total <= limits.tokens and len(sequence) <= limits.segments and loss <= limits.loss
            if cut and total < limits.tokens:
                assert total & (total - 1) == 0
            for k, s, n in sequence:
                placed[k].append((s, n))
        for k, (tokens, _) in demand.items():
            at = 0
            for s, n in sorted(placed[k]):
                assert s == at and n > 0
                at += n
            assert at == tokens
            assert cut or len(placed[k]) == 1


def test_the_heuristic_balances_the_limits():
    """Examples heavy in one demand are put beside those heavy in the other: far fewer sequences than in order of arrival."""
    limits = Limits(100, 50, 50)
    examples = [(30, 2)] * 400 + [(10, 10)] * 800
    packer = Packer(limits, False)
    out = [s for k, (t, l) in enumerate(examples) for s in packer.add(k, t, l)] + list(packer.finish())
    assert len(out) < 0.8 * (400 / 3 + 800 / 5)


def test_instruction_examples(spark):
    rng = random.Random(2)
    rows = [(k, rng.randint(1, 300), rng.randint(0, 300), "t") for k in range(3000)] + [(9999, 5000, 10, "t"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, tokens int, loss int, sequence string").withColumn("loss", F.least("loss", "tokens"))
    out = packing.pack_examples(df, Limits(1024, 16, 700)).collect()
    assert sorted(str(r.id) for r in out) == sorted(str(r[0]) for r in rows)
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append(r)
    for group in by.values():
        group.sort(key=lambda r: (r.offset, r.tokens or 0))
        if group[0].id != 9999:
            assert sum(r.tokens or 0 for r in group) <= 1024 and len(group) <= 16 and sum(r.loss or 0 for r in group) <= 700
    assert packing.pack_examples(df.limit(0)).collect() == []
