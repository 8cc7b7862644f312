"""The corpus pipeline against a brute-force version of its stages in plain Python."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from proofmark.llm import bpe, queries
from tests.llm import data, test_contamination, test_line_rules, test_simhash

ITEMS = [(i, data.words(25, 900 + i, pool=[f"bench{k}" for k in range(60)])) for i in range(4)]
COMMON = "a line that all documents of this source share"


def texts():
    """Clean, junk, toxic, copied, contaminated and short documents; a third of them of one source."""
    rng, out = random.Random(4), []
    for i in range(360):
        text, kind = data.words(90, i) + ".\n" + data.words(40, 1000 + i), i % 9
        if kind == 3:
            text = text.replace(" ", "%%% ").replace("r", "r###")
        elif kind == 4:
            text = text[:100] + " nastyfool " + text[100:]
        elif kind == 5:
            text = data.words(90, 5000 + i // 90)  # exact copies
        elif kind == 6:
            text = text + "\n" + ITEMS[i % 4][1]
        elif kind == 7:
            text = data.words(20, i)
        if rng.random() < 0.4:
            text += "\n" + COMMON
        out.append(text)
    return out


def brute(rows, labels):
    """Rows {id: text} through the five stages."""
    common = {}
    for text in set(rows.values()):
        for line in {" ".join(x.split()).lower() for x in text.split("\n")}:
            common[line] = common.get(line, 0) + 1
    gone = {line for line, n in common.items() if n > 20}
    kept = {}
    for i, text in rows.items():
        n, _, _, _, repeated = test_line_rules.brute(text)
        lines = text.split("\n")
        left = [x for x in lines if " ".join(x.split()).lower() not in gone]
        removed = sum(len(x.split()) for x in lines) - sum(len(x.split()) for x in left)
        if n >= 50 and 100 * repeated <= 50 * n and 2 * removed <= n:
            kept[i] = "\n".join(left)
    # Words that labelled bad documents hold and labelled good ones never do.
    good = {w for i in kept if labels.get(i) for w in kept[i].replace("%%%", " %%% ").replace("###", " ### ").split()}
    bad = {w for i in kept if labels.get(i) is False for w in kept[i].replace("%%%", " %%% ").replace("###", " ### ").split()} - good
    sure = bad & {"%%%", "###", "nastyfool"}
    kept = {i: t for i, t in kept.items() if not any(w in t for w in sure)}
    ids = sorted(kept)
    groups = test_simhash.brute_groups([test_simhash.brute_print(kept[i]) for i in ids])
    kept = {ids[g]: kept[ids[g]] for g in set(groups)}
    out = {}
    for i, text in kept.items():
        n, hit, _ = test_contamination.brute(text, [(str(k), t) for k, t in ITEMS])
        if hit and 20 * len(hit) >= n:
            text = text[: text.index(ITEMS[i % 4][1])] + "\n" + text[text.index(ITEMS[i % 4][1]) + len(ITEMS[i % 4][1]) :]
        out[i] = text
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = dict(enumerate(texts()))
    labels = {i: i % 9 not in (3, 4) for i in rows if i % 2 == 0}
    data.docs_of(spark, list(rows.values())).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 9 != 3), int(i % 9 == 4)) for i in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute(rows, labels)
    library = tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.RANKS), special_tokens={})
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(found) == set(want)
    for i, text in want.items():
        assert found[i].n_tokens == len(library.encode_ordinary(text)) and found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()


def test_stages_on_awkward_tables(spark, sf_dir):
    """Clashing names, nulls and repeated rows go through every stage; what is kept is kept whole."""
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, data.awkward(spark), sf_dir)
        assert out.columns == data.awkward(spark).columns
        for r in out.collect():
            assert r.text == ("text of no id" if r.doc_id is None else data.AWKWARD[r.doc_id]) or (r.text or "").lower().split() == "same text here for the copies".split()
