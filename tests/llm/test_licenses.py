"""License scans against a plain version of rules, priorities and containment."""

import re

import pyarrow.parquet as pq
import pytest
from helpers import no_docs, odd_docs, odd_rows

from ratemill.llm.common import ready
from ratemill.llm.license_rules import ANCHORS, PHRASES, rules
from ratemill.llm.licenses import scan
from ratemill.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"
RULES = [(r, re.compile(r["pattern"])) for r in rules()]


@pytest.fixture(scope="module")
def llm(spark):
    import ratemill.llm.queries  # noqa: F401
    return ready(spark)


def plain_scan(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    numbered = " " + " ".join(f"{w}@{i}" for i, w in enumerate(words)) + " "
    found = []
    for rule, pattern in RULES:
        if rule["keyword"] in words:
            for m in pattern.finditer(numbered):
                ends = re.findall(r"@(\d+)", m[0])
                found.append((int(ends[0]), int(ends[-1]), rule["priority"], rule["rank"], rule["label"], rule["weight"]))
    left = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and (e[:2] != d[:2] or e[3] < d[3])) for e in found)]
    base = sorted({x for _, x in places})
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *(d[4] for d in left)})),
            max([0.5 if places else 0.0, *(d[5] for d in left)]), len(left))


def rows_of(df):
    return sorted(str((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, r.n_found))) for r in df.collect())


def test_query(llm):
    want = sorted(str((r["doc_id"], plain_scan(r["text"]))) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist())
    assert rows_of(QUERIES["op3_license_scan"](llm, SF)) == want


TEXTS = ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-2.0", "see http://www.apache.org/licenses/LICENSE-2.0 and MIT License, mit license",
         "CC BY-NC-SA 4.0; cc by cc by CC-BY", "released under the terms of the GNU Lesser General Public License version 2.1", "The MIT License (MIT). All rights reserved. Public domain.",
         "gnu general public license " * 50 + "version 3", "MITLICENSE mit-licensé", "3-clause BSD license and the BSD license", "KK cc by mité license", "Mozilla Public License v2.0, EPL", "mit license " * 3000]


def test_cases(llm):
    rows = [*[(100 + i, t) for i, t in enumerate(TEXTS)], *[r[:2] for r in odd_rows()]]
    want = sorted(str((d, plain_scan(t))) for d, t in rows if t is None or len(t) < 30_000)
    got = scan(llm.createDataFrame(rows, "doc_id long, text string").where("text is null or length(text) < 30000"))
    assert rows_of(got) == want
    assert scan(llm.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)
    assert scan(odd_docs(llm)).count() == len(odd_rows()) and scan(no_docs(llm)).count() == 0


def test_suppression(llm):
    got = {r.doc_id: r for r in scan(llm.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}
    assert got[0].labels == "apache,apache-2.0" and got[0].score == 0.95 and got[0].n_found == 1
    assert got[1].labels == "gpl-2.0" and got[1].score == 1.0
    assert got[4].labels == "lgpl-2.1" and got[4].n_base == 0
    assert got[11].n_base == 3000 and got[11].last_word == 5998


def test_every_rule_reaches_an_anchor():
    """The shortest text of each rule passes the gate and has the keyword."""
    for rule in rules():
        needed = re.sub(r"\(\?:\(\?:[^()]*\)@\\d\+ \)\?", "", rule["pattern"].removeprefix("(?<= )"))
        for take in (0, -1):
            text = " " + re.sub(r"\(\?:([^()]*)\)@\\d\+", lambda m: m[1].split("|")[take], needed)
            assert any(a in text for a in ANCHORS), (rule, text)
            assert f" {rule['keyword']} " in text, (rule, text)
