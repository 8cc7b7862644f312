"""SimHash groups against brute force."""

from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from proofmark.llm import components, queries, simhash
from proofmark.llm.common import prepare
from tests.llm import data


def brute_print(text):
    w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "").encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, most=2):
    """Smallest index each index reaches; prints is a list of numbers."""
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(find(p), i)
    return [first[find(p)] for p in prints]


def test_fingerprint_of_long_and_short_texts(monkeypatch):
    for text in [*data.AWKWARD, "A b", "a  B c"]:
        assert simhash.fingerprint((text or "").encode()) == brute_print(text)
    plain = simhash.split_bytes
    monkeypatch.setattr(simhash, "split_bytes", lambda body: plain(body, 50))
    assert simhash.fingerprint(data.words(3000, 2).encode()) == brute_print(data.words(3000, 2))


def test_rows_of_awkward_tables(spark):
    prepare(spark)
    rows = simhash.near_duplicates(data.awkward(spark)).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    found = {r.doc_id: r for r in rows}
    groups = brute_groups([brute_print(t) for t in data.AWKWARD])
    for i, text in enumerate(data.AWKWARD):
        assert found[i].fingerprint == f"{brute_print(text):016x}" and found[i].component_id == groups[i]
    assert found[1].component_id == 0 and found[2].fingerprint == "0" * 16
    assert found[11].component_id == 9 and found[None].component_id is None
    assert simhash.near_duplicates(data.empty(spark)).count() == 0


def test_links_find_every_pair_and_no_other(spark):
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:30]:
        for n in (1, 2, 2, 3):
            q = p
            for b in rng.sample(range(64), n):
                q ^= 1 << b
            prints.append(q)
    prints.append(1 << 63)
    prints.append(0)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    want = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    rows = components.connected_components(spark.createDataFrame(path + star + [(3, 3)], "a long, b long")).collect()
    found = {r.node: r.root for r in rows}
    assert len(found) == len(rows) == 61 + 61
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[i] == 7 for i in [7, *range(200, 260)])


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_print(r.text) for r in docs]
    groups = brute_groups(prints)
    rows = {r.doc_id: r for r in queries.QUERIES["op8_simhash_near_dedup"](spark, sf_dir).collect()}
    for r, p, g in zip(docs, prints, groups):
        assert rows[r.doc_id].fingerprint == f"{p:016x}" and rows[r.doc_id].component_id == docs[g].doc_id


def test_one_row_of_each_group_stays(spark):
    docs = data.awkward(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = brute_groups([brute_print(t) for t in data.AWKWARD])
    assert sorted(i for i in ids if i is not None) == sorted(set(groups)) and ids.count(None) == 1


def test_no_bucket_of_copies_is_paired(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the very same words in every row").alias("text"))
    assert simhash.near_duplicates(docs).where("component_id = 0").count() == 3000


def test_what_has_a_row_for_every_fingerprint_is_never_broadcast(spark, monkeypatch):
    prepare(spark)
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    found = simhash.links(spark.range(1, 5).select(F.col("id").alias("fp")))
    assert {(r.a, r.b) for r in found.collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)}
    plans = {"links": plan(found)}
    plain = simhash.written

    def noted(df, name):
        plans[name] = plan(df)
        return plain(df, name)

    monkeypatch.setattr(simhash, "written", noted)
    texts = F.concat(F.lit("w"), (F.col("id") % 40).cast("string"))
    rows = simhash.near_duplicates(spark.range(60).select(F.col("id").alias("doc_id"), texts.alias("text")))
    assert all(r.component_id == r.doc_id % 40 for r in rows.collect())
    plans["result"] = plan(rows)
    for name in ("links", "rooted", "result"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name], name
