import glob
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postsieve.llm import bitplanes
from postsieve.llm.bitplanes import Shard, crc32_joined, from_planes, to_planes, write_shard
from postsieve.llm.words import is_plain, lower_words, plain_words
from tests.llm.conftest import frame, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's  DON'T 'S", "a b", "é É", "x <|endoftext|>y <|startoftext|> z", " em", "İI ΣΑΣ", "中文 文字 🙂", "a\x1cb", "tab\tb\r\nc",
    "a ́b", "\x00", "12345 6",
]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bitplanes.Encoder(file.read()), Tokenizer.from_file(PATH)


def brute(rows):
    """(doc_id, start, n, crc) for rows in their order."""
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("options", [{}, {"shard_ids": 100, "chunk_ids": 16}, {"shard_ids": 5000, "chunk_ids": 512, "bits": 1}])
def test_against_the_library(spark, options):
    given_rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    rows = sorted([*given_rows, *enumerate([*ODD, "", None], 10**9)])
    docs = frame(spark, rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS start", "2 AS part").orderBy("text")
    got = sorted(map(tuple, bitplanes.store_ids(docs, PATH, **options).collect()))
    assert got == brute(rows)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = sorted(map(tuple, bitplanes.store_ids(docs, PATH, shard_ids=1000, chunk_ids=64).collect()), key=lambda r: r[1])
    kept = sorted([(r.doc_id, r.text) for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == brute(kept)


def test_repeated_and_missing_ids_keep_their_places(spark):
    rows = [(None, "no id")] * 50 + [(5, f"word {i % 3}") for i in range(60)]
    got = bitplanes.store_ids(frame(spark, rows, "doc_id long, text string"), PATH, shard_ids=64).collect()
    places = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None] * 50 + [5] * 60


def test_empty_table(spark):
    assert bitplanes.store_ids(frame(spark, [], "doc_id long, text string"), PATH).collect() == []


def test_files_are_whole_and_can_be_read_by_chunk(spark, folder):
    rows = [(i, f"some words number {i}") for i in range(200)]
    bitplanes.store_ids(frame(spark, rows, "doc_id long, text string"), PATH, folder + "/ids", shard_ids=256, chunk_ids=100)
    files = sorted(glob.glob(folder + "/ids/part=*/seq=*/part-*"), key=lambda f: [int(x) for x in re.findall(r"=(\d+)/", f)])
    tokenizer = Tokenizer.from_file(PATH)
    want = [i for _, t in rows for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    shards = []
    for name in files:
        with open(name, "rb") as file:
            shards.append(Shard(file.read()))
    assert np.concatenate([s.ids() for s in shards]).tolist() == want
    assert max(len(s.ids()) for s in shards) <= 256 and max(n for _, n, _ in shards[0].chunks) <= 100
    assert shards[0].chunk(1).tolist() == want[100:200]
    parts = sorted(map(tuple, spark.read.parquet(folder + "/ids/_parts").collect()))
    assert sum(n for _, _, n in parts) == len(want) and parts[0][1] == 0
    with pytest.raises(ValueError, match="whole"):
        Shard(shards[0].data[:-9])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aZ9'!, .-²ªµßÀÿİ×\n\t\x85\xa0\xad\u0301中", "'s", "'RE", "<|endoftext|>", "<|", "word"]), max_size=12))
def test_words_against_the_library(encoder, parts):
    text = "".join(parts)
    want = encoder[1].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(encoder[0].encode([text])), dtype="<u4").tolist() == want


_PARTS = [*"aZ9'!, .-²ªµßÀÿİ×\n\t\xa0\xad中", "'s", "'RE", "''ll", "<|endoftext|>", "word"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_PARTS), max_size=8).map("".join), max_size=6))
def test_batches_of_plain_and_other_texts(encoder, texts):
    want = [encoder[1].encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder[0].encode(texts)] == want
    plain = [text for text in texts if is_plain(text)]
    assert [[w.decode("latin-1") for w in row] for row in plain_words(plain).to_pylist()] == [lower_words(t) for t in plain]


def test_every_plain_character_in_lower_case():
    text = " ".join(chr(c) for c in range(256) if is_plain(chr(c)))
    assert [w.decode("latin-1") for w in plain_words([text])[0].as_py()] == lower_words(text)


def test_a_word_is_looked_up_once_in_a_batch(encoder, monkeypatch):
    asked, memory = [], encoder[0]._words
    monkeypatch.setattr(memory, "of", lambda pieces, of=memory.of: asked.extend(pieces) or of(pieces))
    texts = ["The cat's, the dog's. " * 1000, "THE cat  " * 500, "", "中 the cat " * 300]
    got = [len(ids) // 4 for ids in encoder[0].encode(texts)]
    assert got == [len(encoder[1].encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(asked) <= 12 and {"the", "cat", "'s", ",", "dog", ".", "中"} <= set(asked)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70), st.sampled_from([1, 8]), st.integers(1, 40))
def test_round_trip(numbers, bits, chunk):
    ids = np.array(numbers, dtype="<u4")
    assert from_planes(to_planes(ids, bits), len(ids), bits).tolist() == numbers
    documents = np.zeros(3, dtype=bitplanes._DOCUMENT)
    documents["doc_id"] = [-1, 2**62, 0]
    shard = Shard(write_shard(ids, documents, chunk, bits) + b"\n")
    assert shard.ids().tolist() == numbers and shard.documents.tolist() == documents.tolist()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=300))
def test_joined_checksums(a, b):
    assert crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
