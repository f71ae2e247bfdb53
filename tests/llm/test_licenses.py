import re

import numpy as np
import pytest

from quillspan.llm.licenses import TEMPLATES, fit, license_paragraphs, scan, units


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return fit(docs)


FIXED = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL"}


def test_lines_of_the_corpus(docs, model):
    """Every notice in the corpus is found and confirmed, by a plain search for its words; no other line is confirmed."""
    want = set()
    for r in docs.collect():
        for k, line in enumerate(re.split(r"[\n\r]", r.text)):
            for notice, family in FIXED.items():
                if notice in line and len(line) < 2 * len(notice):
                    want.add((r.doc_id, k, family))
    got = {(r.doc_id, r.paragraph, r.license) for r in scan(docs, model).collect() if r.confirmed}
    assert len(want) > 10
    assert len(want - got) <= 0.02 * len(want) and len(got - want) <= 0.05 * len(want)


def test_damaged_templates_and_other_text(spark, model):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for f in TEMPLATES:
        for t in TEMPLATES[f]:
            ws = t.split()
            if len(ws) >= 15:
                del ws[int(rng.integers(3, len(ws) - 3))]
            want[len(rows)] = f
            rows.append((len(rows), " ".join(ws)))
    plain = ["The driver renewed the license of the old car.", "Copyright law was debated in parliament for many years.", "He was granted permission to leave.", "A clause of the contract was changed without notice."]
    rows += [(1000 + i, t) for i, t in enumerate(plain)]
    got = {r.doc_id: r.license for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect() if r.confirmed}
    assert np.mean([got.get(i) == f for i, f in want.items()]) >= 0.9
    assert not [i for i in got if i >= 1000]


def test_foreign_licences_are_unknown(spark, model):
    """Some of these names are among the examples, others (WTFPL, NCSA, PostgreSQL, Vim) aren't."""
    foreign = ["SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: WTFPL", "SPDX-License-Identifier: NCSA", "Eclipse Public License 2.0", "Licensed under the PostgreSQL License.", "Released under the Vim License.", "Licensed under the Eclipse Public License, version 2.0."]
    own = {"SPDX-License-Identifier: ISC": "ISC", "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0", "SPDX-License-Identifier: MIT": "MIT", "License: MIT": "MIT"}
    rows = list(enumerate([*foreign, *own]))
    got = {r.doc_id: r.license for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect() if r.confirmed}
    assert got == {i: own[t] for i, t in rows if t in own}


def test_long_paragraphs_go_through_in_windows(spark, model):
    text = "word " * 500 + TEMPLATES["MIT"][0] + " word" * 500
    rows = scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert {r.license for r in rows if r.confirmed} == {"MIT"}
    ids, own = units(text, model)
    assert set().union(*(range(s, e) for _, s, e in own)) == set(range(len(ids)))


def test_odd_rows(odd_docs, no_docs):
    assert license_paragraphs(odd_docs).where("confirmed").count() == 0
    assert license_paragraphs(no_docs).count() == 0
