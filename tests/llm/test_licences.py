"""Wordings whole, wrapped, several in one place, with differing words; with the parameters of the query."""

from __future__ import annotations

import random
import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import licences, queries

SCANNER = licences.Scanner(licences.TEMPLATES, 0.1)
WORDINGS = [(name, text) for name, texts in licences.TEMPLATES.items() for text in texts]


def names(text: str) -> list[str]:
    return [f[0] for f in SCANNER.scan(text.encode())[1]]


def brute(text: str) -> list[tuple]:
    """Every wording compared with the whole text; nothing is compressed to choose what is compared."""
    words = licences.tokens(text)
    everywhere = {n: [[0, len(words)]] for n in range(len(SCANNER.wordings))}
    return SCANNER.findings(text, words, everywhere if words else {})


def test_every_wording_alone_wrapped_and_in_capitals():
    for name, text in WORDINGS:
        assert names(f"vorher {text} nachher") == [name]
        assert names(textwrap.fill(text, 30, initial_indent=" * ", subsequent_indent=" * ")) == [name]
        assert names(text.upper()) == [name]


def test_any_two_in_one_line():
    rng = random.Random(1)
    for (one, a), (two, b) in [tuple(rng.sample(WORDINGS, 2)) for _ in range(120)]:
        want = {one, two}
        assert set(names(f"vorher {a} {b} nachher")) == want, (one, two)


@pytest.mark.parametrize(
    "text, expected",
    [
        (licences._FREE.format("This program", "Lesser ", "3"), ["LGPL-3.0-or-later"]),
        (licences._FREE.format("This program", "Affero ", "3"), ["AGPL-3.0-or-later"]),
        (licences._FREE_OPENING.format("Lesser "), ["LGPL-2.1-or-later OR LGPL-3.0-or-later"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
        ("This work is licensed under the GNU Library General Public License, version 3.", []),
        ("This work is not licensed under the GNU General Public License, version 3.", []),
        ("It is not licensed under the GNU General Public License, version 3.", []),
        ("Not released under the MIT License.", []),
        ("It was never, ever released under the MIT License.", []),
        ("Released under the MITE License.", []),
        ("Released under the BSD License.", []),
        ("Licensed under CC BY-ND 4.0.", []),
        ("Licensed under CC BY 3.0.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        (licences._REDISTRIBUTION, ["BSD-2-Clause OR BSD-3-Clause"]),
        (licences._PERMISSION, ["0BSD OR ISC"]),
        ("Licensed under the Apache-2.0 license", ["Apache-2.0"]),
        ("Licensed under the Apache Licence, Version 2.0.", ["Apache-2.0"]),
        ("Released under MIT License.", ["MIT"]),
        ("Released under the MIT Licence", ["MIT"]),
        ("Permission is hereby granted, free of charge, to any persons obtaining a copy of this software and associated documentation files", ["MIT"]),
        ("We talk about licensing and permission at length, but grant nothing at all.", []),
        ("", []),
    ],
)
def test_what_counts_as_the_wording(text, expected):
    around = "ein Satz davor steht hier.\n{}\nund einer danach."
    assert names(text) == expected and names(around.format(text)) == expected
    assert [f[0] for f in brute(around.format(text))] == expected


def test_long_texts_may_name_other_holders():
    text = licences.TEMPLATES["BSD-3-Clause"][0]
    assert names(text.replace("the copyright holder nor", "Example Corp nor")) == ["BSD-3-Clause"]
    assert names(text.replace("HOLDERS AND CONTRIBUTORS", "OWNERS")) == ["BSD-3-Clause"]
    assert names(licences.TEMPLATES["BSD-2-Clause"][0].replace("1. ", "* ").replace("2. ", "* ")) == ["BSD-2-Clause"]
    assert names(text.replace("are permitted", "are not permitted")) != ["BSD-3-Clause"]


def altered(rng: random.Random, text: str) -> str:
    words = text.split()
    for _ in range(rng.randrange(3)):
        at = rng.randrange(len(words))
        words[at] = rng.choice([words[at].upper(), words[at][:-1] + "e", "", "the", words[at] + " of", "Haus7"])
    return rng.choice([" ", "\n// "]).join(words)


def test_candidates_lose_nothing_that_comparing_everything_finds():
    """The same findings as by brute force: in the given documents and round altered wordings."""
    rng = random.Random(5)
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall() if t and len(t) < 6_000][:40]
    for name, text in WORDINGS:
        for _ in range(6):
            texts.append(f"{edge.sentence(rng, rng.randrange(60))} {altered(rng, text)}. {edge.sentence(rng, rng.randrange(60))}")
    found = 0
    for text in texts:
        expected = brute(text)
        assert SCANNER.scan(text.encode())[1] == expected, text
        found += len(expected)
    assert found > 100


def test_rows_of_every_kind(spark):
    rows = [
        (1, f"{edge.LONG} Released under the MIT License. {edge.LONG}"),
        (2, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY-SA 4.0."),
        (2, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY-SA 4.0."),
        (3, "x" * 3_000_000), (4, None), (5, ""), (None, "Licensed under CC BY 4.0."), (6, "İ" * 40 + " Licensed under CC BY 4.0."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("findings", F.lit("own")).withColumn("candidates", F.lit(1))
    found = licences.scan(docs).collect()
    assert sorted((r["doc_id"] or 0, [f["license"] for f in r["findings"]]) for r in found) == [
        (0, ["CC-BY-4.0"]), (1, ["MIT"]), (2, ["MIT", "CC-BY-SA-4.0"]), (2, ["MIT", "CC-BY-SA-4.0"]), (3, []), (4, []), (5, []), (6, ["CC-BY-4.0"]),
    ]
    assert licences.scan(edge.nothing(spark)).collect() == []


def test_the_query_finds_both(spark, tmp_path):
    rows = [(1, "Licensed under the Apache License, Version 2.0. Released under the MIT License."), (2, "Released under the\nMIT Licence."), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_license_scan(spark, str(tmp_path)).orderBy(F.col("doc_id")).collect()
    assert [(r["licenses"], r["n_found"]) for r in found] == [("Apache-2.0,MIT", 2), ("MIT", 1), ("", 0)]


def test_differences_name_the_words():
    assert licences.differences("Dual licensed under GNU GPL version 3", "licensed under the GPL, version 2") == (["the", "2"], ["gnu"])
