import json
import random
from pathlib import Path

import pytest

from postsieve.llm import bpe
from tests.llm.conftest import frame, odd_documents

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def own(path):
    vocabulary, merges, specials = bpe.read_vocabulary(path)
    return bpe.Tokenizer(bpe.Automaton(vocabulary, merges), specials)


def merged(word, merges):
    """BPE by its definition: the earliest merge first, wherever it applies."""
    parts = [bytes([b]) for b in word]
    for a, b in merges:
        k = 0
        while k < len(parts) - 1:
            if (parts[k], parts[k + 1]) == (a, b):
                parts[k : k + 2] = [a + b]
            k += 1
    return parts


def test_automaton_against_the_definition():
    draw = random.Random(2)
    for _ in range(60):
        vocabulary = {bytes([b]): b for b in range(3)}
        merges = []
        for _ in range(draw.randrange(12)):
            pair = tuple(draw.choices(list(vocabulary), k=2))
            if b"".join(pair) not in vocabulary:
                merges.append(pair)
                vocabulary[b"".join(pair)] = len(vocabulary)
        automaton = bpe.Automaton(vocabulary, merges)
        for _ in range(60):
            word = bytes(draw.choices(range(3), k=draw.randrange(1, 12)))
            assert [automaton.labels[i] for i in automaton.encode_word(word)] == merged(word, merges)


def test_against_the_library(own, library):
    draw = random.Random(1)
    letters = "aé'sStTreveLlmd  \n\t\r 　中🙂9٣½_-.,!ñ́‍\x1c\x85"
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "it's 's ''s don't'll", "a" * 5000]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.encode(text)
        assert ids.tolist() == want.ids
        assert own.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_odd_documents(spark, path, own):
    docs = odd_documents(spark)
    rows = bpe.token_report(docs, path).collect()
    assert len(rows) == 8
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)] == [0, 0]
    ids = {r["doc_id"]: r["ids"] for r in bpe.tokenize(docs, path).collect()}
    assert ids[6] == own.encode("ünïcödé 中文 🙂   tail").tolist()
    assert bpe.token_report(docs.limit(0), path).count() == 0


def test_another_vocabulary_under_the_same_path_is_used(spark, path, own, tmp_path):
    docs = frame(spark, [(1, "the same words", "en", "s", 14)])
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    changing = tmp_path / "vocabulary.json"
    for merges, n_tokens in ((data["model"]["merges"], len(own.encode("the same words"))), ([], 14)):
        data["model"]["merges"] = merges
        changing.write_text(json.dumps(data), encoding="utf-8")
        assert bpe.token_report(docs, str(changing)).first()["n_tokens"] == n_tokens
