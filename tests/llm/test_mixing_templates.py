"""Mixtures by target weights, and recurring line templates."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from compare import compare, duck
from helpers import no_docs, odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ratemill.llm import templates
from ratemill.llm.common import new_folder, ready, stored
from ratemill.llm.mixing import in_mixed_order, mixed, period
from ratemill.llm.registry import QUERIES, SQL
from ratemill.llm.templates import drop_recurring_lines, template_sql

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def llm(spark):
    import ratemill.llm.queries  # noqa: F401
    return ready(spark)


@pytest.mark.parametrize("name", ["op5_pfair_mixing", "op9_template_line_dedup", "op2_exact_dedup", "op10_seekable_warc"])
def test_matches_sql(llm, name):
    assert compare(llm, duck(SF), SF, QUERIES[name], SQL[name]) is None


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefghij"), st.integers(1, 40), min_size=1))
def test_period_deviates_by_less_than_a_block(shares):
    total, had = sum(shares.values()), Counter()
    slots = sorted(period(shares), key=lambda x: x[2])
    assert [x[2] for x in slots] == list(range(total))
    for t, (s, i, _) in enumerate(slots, 1):
        assert i == had[s]
        had[s] += 1
        assert all(abs(had[x] - Fraction(w * t, total)) < 1 for x, w in shares.items())
    assert had == Counter(shares)


def test_mixture(llm):
    sizes, shares = {"a": 300, "b": 90, "c": 41}, {"a": 6, "b": 3, "c": 1}
    docs = llm.createDataFrame([(f"{s}{i}", s, i) for s, n in sizes.items() for i in range(n)], "text string, source string, slot int").selectExpr("xxhash64(text) as doc_id", "*")
    rows = mixed(docs, shares, block_rows=4).collect()
    assert len(rows) == 431 and rows[0].__fields__[-4:] == ["block", "_slot", "place", "on_target"]
    slots = defaultdict(list)
    for r in rows:
        slots[r._slot].append(r)
    assert all(len({(r.source, r.block) for r in x}) == 1 and sorted(r.place for r in x) == list(range(len(x))) for x in slots.values())
    had = Counter()
    for slot in sorted(slots):
        had[slots[slot][0].source] += 1
        if slots[slot][0].on_target:
            assert all(abs(had[s] - (slot + 1) * w / 10) < 1 for s, w in shares.items())
    first_gap = min(set(range(max(slots) + 2)) - set(slots))
    assert all(r.on_target == (r._slot < first_gap) for r in rows) and first_gap > 70


def test_mixture_cases(llm):
    docs = odd_docs(llm)
    out = mixed(docs, {"src1": 3})
    assert out.columns == [*docs.columns, "block", "_slot", "place", "on_target"] and out.count() == len(odd_rows())
    assert sorted(map(str, in_mixed_order(docs).collect())) == sorted(map(str, docs.collect()))
    assert mixed(no_docs(llm)).count() == 0 and in_mixed_order(no_docs(llm)).columns == docs.columns


def test_files_follow_the_mixture(llm):
    docs = llm.createDataFrame([(i, f"text {i}", f"s{i % 4}") for i in range(400)], "doc_id long, text string, source string")
    want = [r.doc_id for r in mixed(docs, block_rows=5).orderBy("slot", "place").collect()]
    folder = new_folder(llm, "mixture").removeprefix("file://")
    in_mixed_order(docs, block_rows=5).write.parquet(folder)
    import glob

    import pyarrow.parquet as pq
    assert [x for f in sorted(glob.glob(f"{folder}/*.parquet")) for x in pq.read_table(f)["doc_id"].to_pylist()] == want


def test_hot_source_is_numbered_in_ranges(llm):
    docs = llm.range(12_000).selectExpr("id as doc_id", "'t' as text", "if(id % 3 > 0, 'hot', concat('s', id % 5)) as source")
    rows = mixed(docs, block_rows=10).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.source].add((r.block, r.place))
    assert len(by["hot"]) == 8_000 and max(b for b, _ in by["hot"]) == 799


def test_rows_without_doc_id_are_spread(llm):
    """Half the rows have no doc_id, a third repeat one: their order still deals them evenly over blocks' hash ranges."""
    docs = llm.range(12_000).selectExpr("if(id % 2 = 0, null, if(id % 3 = 0, 7, id)) as doc_id", "concat('text ', id) as text", "'s' as source")
    rows = mixed(docs, block_rows=10).collect()
    assert sorted((r.block, r.place) for r in rows) == [(i // 10, i % 10) for i in range(12_000)]
    nulls = sorted(r.block for r in rows if r.doc_id is None)
    assert abs(nulls[len(nulls) // 2] - 600) < 60


def lines_docs():
    out = []
    for i in range(30):
        name = "q" + "".join(chr(97 + int(c)) for c in str(i))
        own = [f"{name} is a word of document {name} alone", "short one"]
        out.append((i, "\n".join([*own, f"Posted on {i} May by user u{i} in news", "All contents are the property of their owners", "", "  spaced\tline of   five tokens "][: 6 if i < 20 else 4])))
    return out


def test_templates(llm):
    got = {r.doc_id: r for r in drop_recurring_lines(llm.createDataFrame(lines_docs(), "doc_id long, text string"), min_docs=10).collect()}
    for i, text in lines_docs():
        keep = [x for x in text.split("\n") if not x.startswith(("Posted", "All contents", "  spaced", "short one"))]
        assert got[i].kept_text == "\n".join(keep) and got[i].n_lines == len(text.split("\n")) and got[i].n_dropped == len(text.split("\n")) - len(keep)


def dropped(llm, texts, **how):
    rows = drop_recurring_lines(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **how).collect()
    return {r.doc_id: r.n_dropped for r in rows}, {r.doc_id: r.kept_text for r in rows}


def letters(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def test_short_boilerplate_goes(llm):
    """Lines of one to three words that many documents have, and one whose variable field is a number; blank lines and page numbers stay."""
    texts = [f"my own {letters(i)} line\nAll rights reserved.\nMenu\n\nLog in\nPage {i}\n{i}\nCopyright by the owner {i}" for i in range(12)]
    n, kept = dropped(llm, texts)
    assert all(kept[i] == f"my own {letters(i)} line\n\nPage {i}\n{i}" and n[i] == 4 for i in range(12))
    assert set(dropped(llm, texts[:9])[0].values()) == {0}


def test_lines_that_only_begin_alike_stay(llm):
    """Twelve documents thank for twelve things: leading words alone make no template. With most other words alike they do."""
    assert set(dropped(llm, [f"Thank you for {letters(i)}" for i in range(12)])[0].values()) == {0}
    assert set(dropped(llm, [f"Thank you for the {letters(i)} and {letters(i + 50)} x{letters(i)}" for i in range(12)])[0].values()) == {0}
    assert set(dropped(llm, [f"Thank you for the lovely {letters(i)} gift" for i in range(12)])[0].values()) == {1}


def test_documents_are_counted_not_lines(llm):
    """Two documents repeat a word in twenty lines of a leaf; that does not fix it. Rows that repeat a document count once."""
    own = [(i, f"we all saw {letters(i)} {letters(i + 30)}") for i in range(20)]
    often = [(100 + d, "\n".join(f"we all saw red {letters(i + 60 * d)}" for i in range(20))) for d in range(2)]
    rows = own + often + 5 * [often[0]]
    got = drop_recurring_lines(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and not any(r.n_dropped for r in got)
    more = [(200 + i, f"we all saw red {letters(i + 300)}") for i in range(8)]
    got = {r.doc_id: r.n_dropped for r in drop_recurring_lines(llm.createDataFrame(rows + more, "doc_id long, text string")).collect()}
    assert got[100] == got[101] == 20 and all(got[200 + i] == 1 for i in range(8)) and got[0] == 0


def test_common_words_follow_the_leaf(llm):
    """In a leaf of 600 documents a word that ten of them have at a place is no part of a template."""
    texts = [f"it was the {'red' if i < 10 else letters(i)} {letters(2 * i)}" for i in range(600)]
    assert set(dropped(llm, texts)[0].values()) == {0}
    assert sum(dropped(llm, texts, min_share=0.0)[0].values()) == 10


def test_tokens_go_by_number_not_by_line(llm, monkeypatch):
    """What tokens are joined and gathered by is a number: a row a token with its line's text would grow with the square of the line's length."""
    plans = {}

    def kept(df, name, *how):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name, *how)

    monkeypatch.setattr(templates, "stored", kept)
    same = " ".join(f"w{letters(j)}" for j in range(100, 160))
    texts = [f"{same} {letters(i)}\n{same}\nNote {same} {i}\nThe {' '.join(letters(i + 100 * j) for j in range(1, 40))}" for i in range(12)]
    n, kept_text = dropped(llm, texts)
    assert all(n[i] == 3 and kept_text[i].startswith("The ") and "\n" not in kept_text[i] for i in range(12))
    carried = [x for name in ("tokens", "templates") for x in re.findall(r"Generate posexplode\(split\(masked[^\n]*?\)\), \[([^\]]*)\]", plans[name])]
    assert len(carried) > 1 and not any("masked" in x for x in carried)


def test_template_cases(llm):
    out = drop_recurring_lines(odd_docs(llm), min_docs=2)
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and all(r.kept_text is not None for r in rows)
    assert [r.n_lines for r in rows if r.doc_id == 5] == [1] and drop_recurring_lines(no_docs(llm)).count() == 0
    assert all(r.n_dropped == 0 for r in rows if r.doc_id in (1, 2))      # nothing but variable fields


def test_template_sql_with_other_parameters(llm):
    fn = lambda s, d: drop_recurring_lines(s.read.parquet(f"{d}/documents.parquet"), 3, 2, 0.4, 2, 0.2)
    assert compare(llm, duck("/root/testdata/sf0.001"), "/root/testdata/sf0.001", fn, template_sql(3, 2, 0.4, 2, 0.2)) is None
