"""Packing: ids against the tokenizer itself, exact cover of the sequences, few sequences."""

import random
import struct
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinemetrics.llm import packing
from cinemetrics.llm.queries import tokenizer_path
from cinemetrics.llm.word_bpe import WordBpe


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def cached():
    return WordBpe(tokenizer_path())


def unpack(b):
    return list(struct.unpack(f"<{len(b) // 4}I", b))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_the_tokenizer(exact, cached, text):
    assert unpack(cached.ids(text)) == exact.encode(text, add_special_tokens=False).ids


def test_ids_of_awkward_texts(exact, cached):
    for text in ["", " ", "It's we'll I'd THEY'RE 'tis", "a_b__c 1234 x2y", "ÀÉß ſ İ ı Σ ΑΣ", "a\x1cb c\x85d e f", "é é", "日本語 text", "<|endoftext|> x", "ab" * 3000]:
        assert unpack(cached.ids(text)) == exact.encode(text, add_special_tokens=False).ids, text


def test_ids_of_corpus_words(spark, exact, cached):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()
    for r, e in zip(rows, exact.encode_batch([r.text for r in rows], add_special_tokens=False)):
        assert unpack(cached.ids(r.text)) == e.ids


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(spark, exact):
    texts = ["", None, "one two three", "word " * 3000, "Ein längerer Text, mit Zeichen." * 30] + [f"text number {i} " * (i % 37) for i in range(200)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "word " * 3000, "y"), (None, "no id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    found = packing.pack_documents(df, tokenizer_path(), capacity=512, include_ids=True, group_pieces=64).collect()
    want = []
    for i, t, _ in rows:
        ids = exact.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 512):
            part = ids[k : k + 512]
            want.append((i, k // 512, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), part))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, list(r.ids)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    total = sum(r.length for r in found)
    assert check(found, 512) <= -(-total // 512) + 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, tokenizer_path()).collect() == []


def draw(rnd, n):
    return [min(2048, max(1, int(rnd.expovariate(1 / 700)))) for _ in range(n)]


def test_packing_of_random_lengths():
    rnd = random.Random(5)
    for _ in range(30):
        lengths = draw(rnd, rnd.randint(1, 400))
        bins = packing.pack(lengths)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in bins)
        assert len(bins) <= -(-sum(lengths) // 2048) + 1


def test_the_search_decides_and_not_the_opening():
    rnd = random.Random(8)
    lengths = draw(rnd, 4000)
    fewest = -(-sum(lengths) // 2048)
    opened = packing.opening(lengths, 2048)
    assert len(opened) > fewest * 1.02
    assert len(packing.local_search(opened, lengths, 2048)) <= fewest + 1
    assert len(packing.pack(sorted(lengths))) <= fewest + 1 and len(packing.pack(sorted(lengths)[::-1])) <= fewest + 1


def test_every_step_raises_the_squared_fill():
    rnd = random.Random(6)
    lengths = draw(rnd, 300)
    search = packing.LocalSearch(packing.opening(lengths, 2048), lengths, 2048)
    take, sums = search.step, []

    def step(b):
        before = sum(f * f for f in search.fill)
        giver = take(b)
        sums.append((giver, sum(f * f for f in search.fill) - before))
        assert search.fill == [sum(lengths[i] for i in b) for b in search.bins] and max(search.fill) <= 2048
        return giver

    search.step = step
    search.run()
    assert len(sums) > 50 and all(gain > 0 if giver is not None else gain == 0 for giver, gain in sums)


def test_moves_and_exchanges():
    # 6+3 | 5+4 | 2: one place is free in the first two bins only after exchanges
    lengths = [6, 3, 5, 4, 2]
    packed = packing.local_search([[0, 2], [1, 3], [4]], lengths, 11)
    assert len(packed) == 2 and sorted(i for b in packed for i in b) == [0, 1, 2, 3, 4]

    def after(bins, lengths, capacity):
        search = packing.LocalSearch(bins, lengths, capacity)
        for i in search.bins[0]:
            search._withdraw(i)
        giver = search.step(0)
        return giver, [sorted(b) for b in search.bins]

    assert after([[0], [1]], [8, 2], 11) == (1, [[0, 1], []])  # a move
    assert after([[0, 1], [2]], [5, 3, 5], 10) == (1, [[0, 2], [1]])  # one for one
    assert after([[0, 1, 2], [3]], [3, 3, 2, 8], 10) == (1, [[2, 3], [0, 1]])  # one for two
    assert after([[0], [1]], [5, 6], 10) == (None, [[0], [1]])  # would empty the fuller bin


@pytest.mark.parametrize("order", ["doc_id", "length(text)", "xxhash64(doc_id)"])
def test_same_number_of_sequences_however_the_input_is_split(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy(F.expr(order))
    counts = []
    for partitions in (1, 10, 200):
        found = packing.pack_documents(docs.repartitionByRange(partitions, F.expr(order)), tokenizer_path()).collect()
        assert len({(r.doc_id, r.piece) for r in found}) == len(found)
        counts.append(check(found, 2048))
    fewest = -(-sum(r.length for r in found) // 2048)
    assert max(counts) <= fewest + 1
