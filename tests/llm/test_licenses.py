import re

import pytest

from postsieve.llm import licenses
from tests.llm.conftest import frame, odd_documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    hits = [
        (k, label)
        for phrase, label in licenses.BASE.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    places = [k for k, _ in hits]
    labels = ",".join(sorted({label for _, label in hits}))
    return len(words), len(hits), min(places, default=None), max(places, default=None), labels


TEXTS = [
    "",
    "Licensed under CC BY-NC 4.0.\nAll rights reserved. ALL-RIGHTS reserved!",
    "cc by cc by ccé by ccby cc bye, cc by",
    "GNU General Public License, version 3 and the general public licenses",
    "naïve cc ünter by",
    "cc\nby " * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_against_brute_force(text):
    assert licenses.scan(text)[:5] == brute(text)


@pytest.mark.parametrize(
    "expression, postfix, free",
    [
        ("MIT", "mit", True),
        ("MIT OR GPL-2.0-only AND ISC", "mit gpl-2.0-only isc and or", True),
        ("(MIT OR GPL-3.0) AND AGPL-3.0", "mit gpl-3.0 or agpl-3.0 and", False),
        ("GPL-2.0 WITH Classpath-exception-2.0", "gpl-2.0 classpath-exception-2.0 with", True),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND LGPL-2.1", "gpl-2.0 classpath-exception-2.0 with lgpl-2.1 and", False),
    ],
)
def test_expressions(expression, postfix, free):
    assert licenses.to_postfix(expression) == postfix.split()
    assert licenses.evaluate(postfix.split())[1] is free


@pytest.mark.parametrize("broken", ["", "MIT AND", "OR MIT", "(MIT", "MIT)", "MIT ISC", "()", "MIT (ISC)"])
def test_broken_expressions(broken):
    with pytest.raises(ValueError):
        licenses.to_postfix(broken)


@pytest.mark.parametrize(
    "line, labels, terms",
    [
        ("/* SPDX-License-Identifier: MIT */", "mit", "permissive"),
        ("/* SPDX-License-Identifier: MIT*/ int x;", "mit", "permissive"),
        ("<!-- SPDX-License-Identifier: Apache-2.0 -->", "apache-2.0", "permissive"),
        ("<!-- SPDX-License-Identifier: (MIT OR GPL-3.0) AND AGPL-3.0--><p>or", "agpl-3.0,gpl-3.0,mit", "restricted"),
        ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 as the file says (see there)", "gpl-2.0", "permissive"),
        ("SPDX-License-Identifier: MIT OR (ISC", "mit", "permissive"),
        ("(SPDX-License-Identifier: MIT)", "mit", "permissive"),
        ("/* SPDX-License-Identifier: */", "", ""),
        ("SPDX-License-Identifier: (MIT", "", ""),
    ],
)
def test_tags_end_where_the_expression_does(line, labels, terms):
    found = licenses.scan(line)
    assert (found[5], found[7]) == (labels, terms)


@pytest.mark.parametrize(
    "expression, kind",
    [
        ("CC-BY-4.0", "permissive"),
        ("CC-BY-NC-4.0", "non-commercial"),
        ("CC-BY-NC-SA-4.0", "non-commercial"),
        ("CC-BY-ND-4.0", "no-derivatives"),
        ("CC-BY-SA-4.0", "copyleft"),
        ("BSL-1.0", "permissive"),
        ("BUSL-1.1", "source-available"),
        ("BSL-1.1", "unknown"),
        ("SSPL-1.0", "source-available"),
        ("GPL-3.0-or-later", "copyleft"),
        ("GPL-2.0+", "copyleft"),
        ("MIT-like", "unknown"),
        ("Apache-2.0 OR Mine-1.0", "permissive"),
        ("Apache-2.0 AND Mine-1.0", "unknown"),
        ("CC-BY-NC-4.0 AND MIT", "non-commercial"),
        ("CC-BY-NC-4.0 WITH some-exception", "non-commercial"),
        ("Mine-1.0 WITH some-exception", "unknown"),
    ],
)
def test_classes_of_exact_identifiers(expression, kind):
    assert licenses.evaluate(licenses.to_postfix(expression))[2] == kind
    found = licenses.scan(f"\u4e2d é\n# SPDX-License-Identifier: {expression}\nmore")
    terms = kind if kind in ("permissive", "unknown") else "restricted"
    assert (found[7], found[8]) == (terms, kind)


def test_tags_are_found_where_the_automaton_says():
    text = "spdx license identifier: MIT\nxSPDX-License-Identifier: ISC\n-- SPDX-License-Identifier:\tZlib\r\nSPDX-License-Identifier:"
    assert licenses.scan(text)[5] == "zlib"
    assert licenses.scan("Ünï 中 spdx-license-identifier: 0BSD" + "\n spdx-License-identifier: MIT" * 500)[5] == "0bsd,mit"


def test_labels_and_terms(spark):
    text = "// SPDX-License-Identifier: MIT OR Apache-2.0\nReleased under the MIT License."
    row = licenses.scan_licenses(frame(spark, [(1, text, "en", "s", 0)])).first()
    assert (row["labels"], row["base_labels"], row["terms"]) == ("apache-2.0,mit", "", "permissive")
    assert 0.9 < row["score"] <= 1


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == 8
    for r in rows:
        assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (0, None, None, "")
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
