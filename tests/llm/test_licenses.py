import random

from quarry.llm.licenses import BASE, license_scan, parse, scan
from tests.llm.fixtures import AWKWARD, invented, table, words


def brute(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base(spark):
    rng = random.Random(3)
    bits = [*BASE, "Under The MIT-License", "cc by", "nc", "apache license", "version 2", "été", ". ", "x", "SPDX-License-Identifier: MIT OR Apache-2.0\n"]
    texts = [*AWKWARD, *(" ".join(rng.choices(bits, k=rng.randint(1, 15))) for _ in range(300)), invented(rng, 50), "cc by nc " * 20_000]
    for r in license_scan(table(spark, texts, clash=True).repartition(3)).collect():
        assert tuple(r)[1:6] == brute(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= {"", *r["labels"].split(",")}
        assert 0 <= r["score"] <= 1


def test_expressions():
    assert parse("mit") == (["mit"], False)
    assert parse("mit or apache-2.0") == (["apache-2.0", "mit"], True)
    assert parse("(mit or isc) and gpl-2.0-only with classpath-exception-2.0") == (["gpl-2.0-only", "isc", "mit"], True)
    assert parse("gpl-2.0 and bsd") == (["bsd", "gpl-2.0"], False)
    for bad in ("", "and", "mit and", "(mit", "mit)", "mit isc", "mit (isc)", "()", "or mit"):
        assert parse(bad) is None


def test_labels_of_the_method():
    assert scan("# SPDX-License-Identifier: (MIT OR ISC)\nx")[5] == "isc,mit"
    assert scan("# SPDX-License-Identifier: (MIT OR\nISC)")[5] == ""
    assert scan("GNU General Public License, version 3.")[5] == "gpl-3"


def test_a_tag_need_not_end_its_line():
    for rest, labels, expression in (
            ("MIT Copyright 2020 X", "mit", "mit"), ("Apache-2.0 -- see LICENSE", "apache-2.0", "apache-2.0"), ("MIT.", "mit", "mit"),
            ("(MIT OR ISC) AND BSD-3-Clause and more (", "bsd-3-clause,isc,mit,more", "(mit or isc) and bsd-3-clause and more"),
            ("GPL-2.0+ WITH x-exception. Or so it says", "gpl-2.0+", "gpl-2.0+ with x-exception"), ("MIT) x", "mit", "mit"),
            ("MIT OR", "mit", "mit"), ("MIT, see the file", "mit", "mit"), ("(MIT OR ISC copy", "", ""), ("-- ( ) x", "", "")):
        got = scan(f"# SPDX-License-Identifier: {rest}")
        assert got[5:] == (labels, 1.0 if labels else 0.0, expression)


def test_null_ids_and_empty(spark):
    assert license_scan(table(spark, ["x"]).limit(0)).count() == 0
    big = 2**60 + 1
    assert {r["doc_id"] for r in license_scan(table(spark, ["a", "b"], [None, big])).collect()} == {None, big}
