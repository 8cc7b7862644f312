"""Quality rules against plain Python and SQL."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proofmark.llm import line_rules, queries
from proofmark.llm.common import prepare
from tests import compare
from tests.llm import data

GAP = re.compile("[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def brute(text):
    text = text or ""
    w = words(text)
    seen, hit = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(p + k for p in places for k in range(3))
    lines = [line for line in text.split("\n") if words(line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_rows_of_awkward_tables(spark):
    prepare(spark)
    rows = line_rules.quality(data.awkward(spark)).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    for r in rows:
        want = brute("text of no id" if r.doc_id is None else data.AWKWARD[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    assert line_rules.quality(data.empty(spark)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c d", "#x|", "\n", "A\n"]), max_size=60).map(" ".join), min_size=1, max_size=12))
def test_counts_equal_plain_python(spark, texts):
    rows = line_rules.quality(data.docs_of(spark, texts)).collect()
    assert sorted((r.doc_id, *(r[c] for c in COUNTS)) for r in rows) == [(i, *brute(t)) for i, t in enumerate(texts)]


def lined(spark):
    """Fifty documents of one host with a line in common, fifty copies of another, and one that is little but the line."""
    common = "Common   LINE of this host"
    texts = [data.words(60, i) + "\n" + common.upper() + "\n" + data.words(20, 500 + i) for i in range(50)]
    texts += [data.words(80, 999) + "\nonly in copies"] * 50
    texts += [(common + "\n") * 20 + data.words(30, 77)]
    return data.docs_of(spark, texts), texts


def test_common_lines_go_and_copies_do_not_make_them(spark):
    docs, texts = lined(spark)
    rows = {r.doc_id: r for r in line_rules.quality(docs).collect()}
    assert all(rows[i].removed_words == 5 and rows[i].kept for i in range(50))
    assert all(rows[i].removed_words == 0 and rows[i].kept for i in range(50, 100))
    assert rows[100].removed_words == 100 and not rows[100].kept
    out = line_rules.cleaned(docs)
    assert out.columns == docs.columns
    left = {r.doc_id: r for r in out.collect()}
    assert set(left) == set(range(100))
    for i in range(50):
        first, _, last = texts[i].split("\n")
        assert left[i].text == first + "\n" + last and left[i].n_chars == len(left[i].text)
    assert all(left[i].text == texts[i] for i in range(50, 100))
    assert line_rules.cleaned(data.empty(spark)).count() == 0


def test_a_line_goes_however_large_its_host_is(spark):
    """On 30 of 5,000 different documents."""
    texts = [data.words(60, i) + ("\nThis line is on thirty documents" if i % 160 == 0 and i < 4800 else "\n" + data.words(8, 9000 + i)) for i in range(5000)]
    rows = line_rules.quality(data.docs_of(spark, texts)).collect()
    assert sorted(r.doc_id for r in rows if r.removed_words) == list(range(0, 4800, 160)) and all(r.removed_words in (0, 6) for r in rows)


def test_hosts_are_apart(spark):
    a, _ = lined(spark)
    b = a.withColumn("source", F.lit(None).cast("string")).where("doc_id < 15")
    rows = line_rules.quality(a.where("doc_id < 15").unionByName(b)).collect()
    assert len(rows) == 30 and not any(r.removed_words for r in rows)


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.QUERIES["op6_quality_rules"](spark, sf_dir))
    assert compare.difference(got, compare.sql_rows(compare.connect(sf_dir), queries.ORACLES["op6_quality_rules"])) is None


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.QUERIES["op6_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
