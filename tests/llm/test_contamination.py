"""Benchmark passages against a brute-force search."""

from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from proofmark.llm import contamination as c
from proofmark.llm import queries
from proofmark.llm.common import prepare
from tests.llm import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def brute(doc, items, window=13):
    """Hit word places and items, by comparing every stretch of the document with every window."""
    where = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            where.setdefault(tuple(w[i : i + n]), set()).add(name)
    sizes = {len(k) for k in where}
    hit, found = set(), set()
    w = words(doc)
    for n in sizes:
        for i in range(len(w) - n + 1):
            names = where.get(tuple(w[i : i + n]))
            if names:
                hit.update(range(i, i + n))
                found |= names
    return len(w), hit, found


letters = st.lists(st.sampled_from("abc"), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(letters, max_size=6), letters, st.integers(2, 6))
def test_automaton_equals_brute_force(items, doc, window):
    named = [(str(i), t) for i, t in enumerate(items)]
    automaton = c.Automaton(((n, c.words_of(t.encode())) for n, t in named), window)
    count, spans, found = c.scan(automaton, doc.encode())
    total, hit, names = brute(doc, named, window)
    assert (count, {i for a, b in spans for i in range(a, b)}, found) == (total, hit, names)


def test_long_texts_go_through_in_pieces(monkeypatch):
    rng = random.Random(3)
    doc = " ".join(rng.choice("abcd") for _ in range(4000))
    named = [("0", " ".join(rng.choice("abcd") for _ in range(600))), ("1", "a b c")]
    automaton = c.Automaton(((n, c.words_of(t.encode())) for n, t in named), 5)
    plain = c.split_bytes
    monkeypatch.setattr(c, "split_bytes", lambda body: plain(body, 97))
    count, spans, found = c.scan(automaton, doc.encode())
    assert (count, {i for a, b in spans for i in range(a, b)}, found) == brute(doc, named, 5)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, body string, spans string").select("item_id", "text", "body", "spans")


ITEMS = [(1, data.words(30, 11), "", ""), (2, data.words(30, 11), "", ""), (30, "Short item", "", ""), (4, None, "", ""), (5, "...", "", ""), (1, data.words(30, 11), "", "")]


def test_rows_of_awkward_tables(spark):
    prepare(spark)
    texts = [*data.AWKWARD, data.words(200, 1) + ". " + ITEMS[0][1].upper(), data.words(2000, 2) + " " + ITEMS[0][1], "a short, ITEM!"]
    rows = c.contamination(data.docs_of(spark, texts), benchmark(spark, ITEMS)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        total, hit, found = brute(texts[r.doc_id], [(str(i), t) for i, t, *_ in ITEMS])
        assert (r.n_words, r.n_hit, r.n_items) == (total, len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= total)
    assert c.contamination(data.empty(spark), benchmark(spark, ITEMS)).count() == 0
    clean = c.contamination(data.awkward(spark), benchmark(spark, ITEMS).where("false")).collect()
    assert len(clean) == len(data.AWKWARD) + 2 and not any(r.n_hit for r in clean)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = data.docs_of(spark, [ITEMS[0][1], "one short item more", data.words(300, 4)]), benchmark(spark, ITEMS)
    whole = sorted(c.contamination(docs, items).collect())
    monkeypatch.setattr(c, "BLOCK_BYTES", 100)
    assert sorted(c.contamination(docs, items).collect()) == whole


def test_a_document_is_cut_by_all_blocks_together(spark, monkeypatch):
    """13 + 13 hit words of 400, by items of two blocks: neither is one in twenty, both together are."""
    first, second = data.words(13, 501, [f"one{i}" for i in range(40)]), data.words(13, 502, [f"two{i}" for i in range(40)])
    body = data.words(374, 9).split()
    texts = [" ".join([*body[:100], first, *body[100:300], second, *body[300:]]), " ".join([*body[:100], first, *body[100:]]), None, "", first + " " + second]
    # What a cut by one block brings together is a passage of the other.
    split = second.split()
    texts.append(" ".join(body[:60] + split[:6]) + " " + first + " " + " ".join(split[6:] + body[60:120]))
    items = benchmark(spark, [(1, first, "", ""), (2, second, "", "")])
    docs = data.docs_of(spark, texts)
    whole = sorted(map(tuple, c.remove_passages(docs, items).collect()))
    assert [r[0] for r in whole] == [0, 1, 2, 3, 5] and "one" not in whole[0][1] and "two" not in whole[0][1] and whole[1][1] == texts[1]
    assert "one" not in whole[4][1] and "two" not in whole[4][1]
    monkeypatch.setattr(c, "BLOCK_BYTES", 20)
    assert len(c.automata(items, "item_id", "text", c.WINDOW)) > 1
    assert sorted(map(tuple, c.remove_passages(docs, items).collect())) == whole


def test_query_equals_brute_force(spark, sf_dir):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op10_benchmark_decontamination"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        total, hit, found = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (total, len(hit), len(found), bool(hit) and 20 * len(hit) >= total)


def test_cutting_leaves_clean_documents_and_cleans_the_rest(spark):
    passage = ITEMS[0][1]
    texts = [*data.AWKWARD, data.words(200, 1) + ". " + passage + " " + data.words(100, 2), data.words(2000, 2) + " " + passage, passage + " and no more", None]
    items = benchmark(spark, [i for i in ITEMS if i[0] != 30])
    docs = data.docs_of(spark, texts)
    rows = {r.doc_id: r for r in c.remove_passages(docs, items).collect()}
    n = len(data.AWKWARD)
    assert all(rows[i].text == texts[i] and rows[i].n_chars == (None if texts[i] is None else len(texts[i])) for i in (*range(n), n + 1, n + 3))
    assert n + 2 not in rows
    assert rows[n].text == data.words(200, 1) + ". \n " + data.words(100, 2) and rows[n].n_chars == len(rows[n].text)
    assert c.remove_passages(docs, items).columns == docs.columns
    again = c.contamination(c.remove_passages(docs, items), items).where("contaminated").count()
    assert again == 0
