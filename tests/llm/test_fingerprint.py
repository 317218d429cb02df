import hashlib
from functools import reduce

import numpy as np

from postsieve.llm import fingerprint as fp
from tests.llm.conftest import frame, odd_documents


def test_sum_of_paragraphs():
    parts = ["first paragraph of some length", "short", "", "third paragraph, also with some length", "short"]
    whole = fp.fingerprint("\n".join(parts))
    assert whole == fp.fingerprint("\n".join(parts[::-1]))
    assert whole == reduce(lambda a, b: a + b, map(fp.fingerprint, parts))
    assert whole - fp.fingerprint(parts[1]) == fp.fingerprint("\n".join([parts[0], *parts[2:]]))
    assert not whole == fp.fingerprint("\n".join(parts[:-1]))


def test_likeness():
    draw = np.random.default_rng(1)
    a, b = ("".join(chr(97 + x) for x in draw.integers(0, 26, 3000)) for _ in range(2))
    assert fp.fingerprint(a).likeness(fp.fingerprint(a)) == 1
    assert fp.fingerprint(a).likeness(fp.fingerprint(b)) < 0.3
    assert 0.3 < fp.fingerprint(a).likeness(fp.fingerprint(fp.edited(a, b))) < 0.7


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        marks = [fp.fingerprint(t) for t in (text, changed, after)]
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), marks[0].text(), marks[1].text(),
             marks[0].likeness(marks[1]), marks[0].likeness(marks[2]))
        )
    return out


def test_report_against_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(int(n), "x" * int(n % 7) + f" text {n}\n" * int(n % 5)) for n in draw.permutation(300)]
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in rows])
    found = fp.fingerprint_report(docs).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = fp.fingerprint_report(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute(rows)))
    assert fp.fingerprint_report(docs.limit(0)).count() == 0
    one = fp.fingerprint_report(docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_many_equal_pieces():
    for n in (32_783, 65_551, 200_000):
        line, more = fp.fingerprint("=" * n), fp.fingerprint("=" * (n + 9_000))
        assert line.likeness(more) > 0.99
        assert line.likeness(fp.fingerprint("=" * n + "\nThe end of the log")) > 0.99
