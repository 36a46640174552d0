"""Hand-written license rules: usual forms found, product names left alone, suppression as a plain sweep does it."""

import random
import re

import pytest

from starloom.llm import license_rules, license_scan

#: (text, labels that must be found exactly); an empty set: the text must stay without a label.
LABELLED = [
    ("I like Python 2 and PHP 3.", set()),
    ("The AFL 2 final was played; BSD 4 tape", set()),
    ("She studied at MIT and flew an Apache.", set()),
    ("Artistic works, the ISC, zlib and Ruby", set()),
    ("the Mozilla browser and the Eclipse of 1999, PostgreSQL 2", set()),
    ("a driving licence is required", set()),
    ("the general public was licensed to enter", set()),
    ("CC by mail to the office", set()),
    ("licensed under GPLv3", {"gpl-3.0"}),
    ("LGPLv2.1 or AGPLv3", {"lgpl-2.1", "agpl-3.0"}),
    ("Apache2 licensed", {"apache-2.0"}),
    ("This crate is MIT licensed.", {"mit"}),
    ("EUPL v1.2", {"eupl-1.2"}),
    ("The Unlicense", {"unlicense"}),
    ("CC0 1.0 Universal", {"cc0-1.0"}),
    ("SPDX-License-Identifier: GPL-2.0-only", {"gpl-2.0-only"}),
    ("SPDX-License-Identifier: MIT", {"mit"}),
    ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}),
    ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0", "apache"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0", "gpl"}),
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1", "gpl"}),  # the base phrase stands inside
    ("Mozilla Public License Version 2.0", {"mpl-2.0"}),
    ("3-clause BSD license", {"bsd-3"}),
    ("fitness for a particular purpose and noninfringement", set()),
    ("Creative Commons Attribution-ShareAlike 4.0 International", {"cc-by-sa-4.0"}),
    ("distributed under the Boost Software License, Version 1.0", {"bsl-1.0"}),
    ("MIT license / ISC license", {"mit", "isc"}),
    ("dual: MIT License, MIT License", {"mit"}),
]


def normal(text: str) -> str:
    return re.sub(license_scan.SEPARATORS, " ", f" {(text or '').translate(str.maketrans('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))} ")


def brute(text: str) -> tuple[str, float]:
    """All rules on the text without any gate, swept over a plain list."""
    norm = normal(text)
    found = sorted((m.start(), -m.end(), o, label, c) for o, _, _, p, label, c in license_rules.rules() for m in re.finditer(p, norm))
    kept: list[tuple] = []
    for s, ne, o, label, c in found:
        if kept and -ne <= kept[-1][1]:
            continue
        if kept and s < kept[-1][1]:
            if o > kept[-1][2]:
                continue
            kept.pop()
        kept.append((s, -ne, o, label, c))
    base = {label for phrase, label in license_scan.BASE if f" {' '.join(phrase)} " in norm}
    return ",".join(sorted({k[3] for k in kept} | base)), max([k[4] for k in kept], default=0.5 if base else 0.0)


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["scan"] for r in license_scan.scan(df).orderBy("i").collect()]


def test_labelled_texts(spark):
    got = scan(spark, [t for t, _ in LABELLED])
    wrong = [(t, want, r["labels"]) for (t, want), r in zip(LABELLED, got) if set(filter(None, r["labels"].split(","))) != want]
    assert not wrong


def test_suppression_is_the_plain_sweep(spark):
    """Texts put together from pieces of rules, so that matches lie inside, beside and across each other."""
    rnd = random.Random(5)
    words = sorted({w for _, _, _, p, _, _ in license_rules.rules() for w in re.findall(r"[a-z0-9]{2,}", p)})
    forms = [t for t, _ in LABELLED]
    texts = [None, "", " "]
    for _ in range(250):
        parts = [rnd.choice(forms) if rnd.random() < 0.6 else " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 9))]
        texts.append(rnd.choice([" ", "\n", ", "]).join(parts))
    texts.append(" word" * 20_000 + " licensed under the mit license" + " word" * 20_000)
    assert [(r["labels"], r["score"]) for r in scan(spark, texts)] == [brute(t) for t in texts]


def test_overlapping_rules(spark, monkeypatch):
    made = [(0, " c", " c", " c d e(?= )", "late", 0.4), (1, " a", " a", " a b c(?= )", "early", 0.9), (2, " b", " b", " b c(?= )", "inner", 1.0),
            (3, " e", " e", " e f(?= )", "tail", 0.3)]
    monkeypatch.setattr(license_scan, "rules", lambda: made)
    got = scan(spark, ["a b c d e f", "a b c", "b c d", "a b c e f", "x"])
    assert [(r["labels"], r["score"]) for r in got] == [("late", 0.4), ("early", 0.9), ("inner", 1.0), ("early,tail", 0.9), ("", 0.0)]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "MIT licensed", 7, 8)], "__norm int, text string, __scan int, __s int")
    row = license_scan.scan(df).first()
    assert (row["__norm"], row["__scan"], row["__s"], row["scan"]["labels"]) == (1, 7, 8, "mit")


@pytest.mark.parametrize("gate", [True, False])
def test_keywords(gate):
    """The rules are hundreds, each with a keyword that starts a word; a gate is never longer than needed."""
    rules = license_rules.rules()
    assert len(rules) >= 200 and [r[0] for r in rules] == list(range(len(rules)))
    for _, kw, g, pattern, label, score in rules:
        assert (g if gate else kw).startswith(" ") and 0 < score <= 1 and label and pattern.endswith("(?= )")
