import re

import llm_support as S
from pyspark.sql import functions as F

from stationflow.llm import license_rules, licenses


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Licensed under the MIT License. mit-LICENSE (MIT   license)", "é MIT License é", "éMIT License", "MIT Licenses", "GNU GENERAL\nPUBLIC, license v3",
    "Apache License\x00Apache license", "mit mit license license", "general public general public license", "ÀMIT ÀLICENSE",
]


def test_base_places_equal_brute_force(spark):
    rows = S.ODD + [S.row(100 + i, t) for i, t in enumerate(TEXTS)]
    found = licenses.licenses(S.frame(spark, rows), F.col("text")).select("_doc.text", "_found.*").collect()
    for r in found:
        places = r.base_places
        assert (r.n_words, len(places), min(places, default=None), max(places, default=None), ",".join(r.base_labels)) == brute(r.text), r.text
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def labels(text):
    return licenses.scan_text(text.encode())[3]


def test_fuller_detections_cover_lesser_ones():
    assert labels("under the GNU Lesser General Public License v2.1") == ["gpl", "lgpl-2.1"]  # gpl is a base phrase
    assert labels("CC-BY-NC-SA 4.0 applies") == ["cc-by-nc-sa-4.0"]
    assert labels("SPDX-License-Identifier: Apache-2.0") == ["apache-2.0"]
    assert labels("three-clause BSD license") == ["bsd-3-clause"]
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy of") == ["mit"]
    assert labels("an ordinary sentence about nothing, mit anderen Worten") == []


def test_suppression_keeps_what_nothing_covers():
    sig = lambda order, priority: license_rules.Signature(order, str(order), "", "", priority, 0.5)
    a, b, c, d = sig(0, 50), sig(1, 90), sig(2, 50), sig(3, 50)
    kept = licenses.suppressed([(a, 0, 10), (b, 2, 5), (c, 0, 10), (d, 8, 12)])
    assert [(s.order, x, y) for s, x, y in kept] == [(0, 0, 10), (1, 2, 5), (3, 8, 12)]


def test_there_are_hundreds_of_rules_in_order():
    rules = [r for f in license_rules.families() for r in f.rules]
    assert len(rules) > 400 and len({r.order for r in rules}) == len(rules)


def test_every_rule_matches_only_where_its_name_does():
    for f in license_rules.families():
        for r in f.rules:
            assert f.name in r.pattern


def test_empty_table(spark):
    assert licenses.licenses(S.empty(spark), F.col("text")).count() == 0


def sample(pattern):
    """A short text that a pattern matches: first alternatives, as few repetitions as it takes."""
    def of(items):
        out = ""
        for op, value in items:
            name = str(op)
            if name == "LITERAL":
                out += chr(value)
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += of(value[2]) * value[0]
            elif name == "SUBPATTERN":
                out += of(value[3])
            elif name == "BRANCH":
                out += of(value[1][0])
            elif name == "IN":
                out += of(value[:1]) if str(value[0][0]) == "LITERAL" else "1" if "DIGIT" in str(value[0][1]) else "x"
            elif name == "ANY":
                out += "x"
            else:
                raise ValueError(name)
        return out

    return of(re._parser.parse(pattern))


def test_every_rule_finds_a_sample_of_its_own():
    rules = [(f, r) for f in license_rules.families() for r in f.rules]
    assert len(rules) > 900
    for f, r in rules:
        text = sample(r.pattern)
        line = licenses.reduced(text.encode())
        assert any(f" {k}".encode() in line for k in f.keywords) and r.also.encode() in line, r
        found = licenses.scan_text(text.encode())[5]
        # itself, or one that covers it and yields to nothing
        assert any(d["label"] == r.label for d in found) or any(d["words"] >= len(text.split()) for d in found), (r, found)


def test_usual_spellings_give_the_license():
    for text, label in {
        "Apache License 2.0": "apache-2.0", "Apache License, Version 2.0": "apache-2.0", "Mozilla Public License 2.0": "mpl-2.0",
        "GNU General Public License 3": "gpl-3.0", "GNU General Public License v2.0": "gpl-2.0", "Eclipse Public License 2.0": "epl-2.0",
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
        "Licensed under the MIT": "mit", "released under the zlib": "zlib", "FreeBSD License": "bsd-2-clause", "Simplified License": "bsd-2-clause",
        "see the copyright notice": "copyright", "GNU Lesser General Public License version 2.1": "lgpl-2.1", "LGPL-3.0": "lgpl-3.0",
        "GNU Affero General Public License v3.0": "agpl-3.0", "Artistic License 2.0": "artistic-2.0",
    }.items():
        assert label in licenses.scan_text(text.encode())[3], text
    for text in ("the mit is in cambridge", "an isc number", "zlib compresses"):
        assert not {"mit", "isc", "zlib"} & set(licenses.scan_text(text.encode())[3])
