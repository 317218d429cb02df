import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from postsieve.llm import alignment
from postsieve.llm.bpe import byte_characters
from postsieve.llm.words import blank_pieces, spaced_pieces
from tests.llm.conftest import LONG, frame, odd_documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a  b", " lead", "trail ", "\ta\nb", "x\n\n y", "it's  don't'll 's", "é é x", "ok  nb", "中文 文字 🙂", "  ",
    "<|endoftext|> <s> a", "a \x1c b", "<0x41> q", "a ́b", "mark ▁x", " em space", "a ​b", "tab \tb", "x\x00 y",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tokenizers, texts):
    """From whole texts: every pair of tokens is compared by its bytes."""
    a, b = tokenizers
    byte_of = byte_characters()
    rows, counts = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(([], [], [], ""))
            continue
        ends_a, ends_b = [sum(map(len, bytes_a[: k + 1])) for k in range(len(ids_a))], [
            sum(map(len, bytes_b[: k + 1])) for k in range(len(ids_b))
        ]
        links = [
            (x, y)
            for x, tx, ex in zip(ids_a, bytes_a, ends_a, strict=True)
            for y, ty, ey in zip(ids_b, bytes_b, ends_b, strict=True)
            if max(ex - len(tx), ey - len(ty)) < min(ex, ey)
        ]
        counts.update(links)
        parts, last = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            of_a = [str(i) for i, e in zip(ids_a, ends_a, strict=True) if last < e <= cut]
            of_b = [str(i) for i, e in zip(ids_b, ends_b, strict=True) if last < e <= cut]
            parts.append(",".join(of_a) + "|" + ",".join(of_b))
            last = cut
        rows.append((ids_a, ids_b, links, ";".join(parts)))
    highest: dict[int, int] = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    return [
        (
            len(ids_a), len(ids_b), groups.count("|"), len(links), sum(counts[p] == highest[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for ids_a, ids_b, links, groups in rows
    ]


def found(spark, rows, **options):
    got = alignment.alignment_report(rows, A, B, **options).collect()
    return sorted((tuple(r)[:8] for r in got), key=repr)


@pytest.mark.parametrize("table_pairs", [0, 40, 500_000])
def test_against_every_pair_of_tokens(spark, tokenizers, table_pairs):
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).collect()]
    texts = [t[:3000] for t in given] + ODD + [ODD[0], ODD[0], "", None]
    rows = list(enumerate(texts))
    want = sorted([(i, *m) for i, m in zip(range(len(texts)), brute(tokenizers, texts), strict=True)], key=repr)
    assert found(spark, frame(spark, rows, "doc_id long, text string"), table_pairs=table_pairs) == want


def test_odd_documents_and_heavy_copies(spark, tokenizers):
    docs = odd_documents(spark)
    kept = docs.collect()
    short = [t if t != LONG else "one two" for t in (r.text for r in kept)]
    got = found(spark, docs)
    assert [r[0] for r in got] == sorted([r.doc_id for r in kept], key=lambda d: repr((d, 0)))
    zeros = [r for r in got if r[0] in (2, 3)]
    assert [r[1:] for r in zeros] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert len({r[1:] for r in got if r[0] == 4}) == 1 and len(short) == len(got)
    copies = frame(spark, [(i, "the same words", None) for i in range(1500)] + [(9000, "other words", None)], "doc_id long, text string, copies int")
    rows = alignment.alignment_report(copies, A, B).collect()
    assert len(rows) == 1501 and len({r.count_sum for r in rows if r.doc_id < 9000}) == 1
    assert {r.copies for r in rows} == {1500, 1}


def test_empty_table(spark):
    assert found(spark, frame(spark, [], "doc_id long, text string")) == []


def test_pieces_are_cut_where_both_tokenizers_cut(tokenizers):
    with open(A, encoding="utf-8") as a_file, open(B, "rb") as b_file:
        aligner = alignment.Aligner(a_file.read(), b_file.read())
    assert aligner._cuts
    a, b = tokenizers
    for text in [*ODD, LONG]:
        ((groups, _, n_a, _),) = aligner.align_all([text])
        if n_a == 0:
            assert "▁" in text
            continue
        sides = [g.split("|") for g in groups.split(";")]
        assert [int(i) for left, _ in sides for i in left.split(",")] == a.encode(" " + text, add_special_tokens=False).ids
        assert [int(i) for _, right in sides for i in right.split(",")] == b.encode(text)


def test_cutting():
    assert blank_pieces("a b  c \n d") == ["a", "b  c \n", "d"] or blank_pieces("a b  c \n d")[0] == "a"
    assert " ".join(blank_pieces(" x  y \t z ")) == " x  y \t z "
    assert spaced_pieces(" a\tb\n\nc ") == ["a", "b", "c"]


def test_pieces_learned_together_and_alone(tokenizers):
    """Pieces that stand in a row, ones that cannot, and a batch with one that is not given back."""
    with open(A, encoding="utf-8") as a_file, open(B, "rb") as b_file:
        files = a_file.read(), b_file.read()
    pieces = ["word", "two,", "é!", "trail ", "", "\tlead", "line\n", "中文"]
    together = alignment.Aligner(*files)._learn(pieces)
    alone = [alignment.Aligner(*files)._learn([p])[0] for p in pieces]
    assert together == alone
    broken = alignment.Aligner(*files)._learn(["word", "▁x", "é!"])
    assert broken == [alone[0], False, alone[2]]


def test_translation(spark):
    rows = alignment.translation(frame(spark, [(1, "the the the cat"), (2, "the")], "doc_id long, text string"), A, B).collect()
    assert sorted(r["count"] for r in rows)[-1] == 4
