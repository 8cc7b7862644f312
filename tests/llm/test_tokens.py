"""Token counts and byte-level BPE against the public libraries."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proofmark.llm import bpe, queries, token_counts
from proofmark.llm.common import prepare, safe_pieces
from tests.llm import data

MIXED = " \t\n\x0b\x1c\x85\xa0ab1'sé!<|ñß中😀"


@pytest.fixture(scope="module")
def own():
    return bpe.Codec(bpe.read_ranks(queries.RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def odd_texts(n=1500):
    rng = random.Random(1)
    return ["".join(rng.choice(MIXED) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_equal_the_library_and_decode_to_the_text(own, library):
    for text in odd_texts() + [t or "" for t in data.AWKWARD]:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_perfect_hash_is_minimal_and_finds_only_its_keys(own):
    found = own.whole
    assert found.n == len(own.ranks) and None not in found.keys
    assert all(found.get(token) == rank for token, rank in own.ranks.items())
    assert found.get(b"not a token at all") == -1 and bpe.PerfectHash({}).get(b"a") == -1


def test_pieces_of_long_texts_change_nothing(own, library):
    text = "".join(odd_texts())
    assert "".join(safe_pieces(text, 500)) == text
    assert [i for p in safe_pieces(text, 500) for i in own.encode(p)] == library.encode_ordinary(text)


def test_round_trip_rows(spark, library):
    prepare(spark)
    rows = bpe.round_trip(data.awkward(spark), queries.RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    for r in rows:
        text = "text of no id" if r.doc_id is None else data.AWKWARD[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(data.empty(spark), queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode_gives_the_texts(spark):
    ids = bpe.encode(data.awkward(spark), queries.RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: r.text for r in bpe.decode(ids, queries.RANKS, public_tokenizers.PATTERN).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(data.AWKWARD))


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(queries.WORD_BPE)
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    lengths = token_counts.LengthEncoder(queries.WORD_BPE)
    assert all(lengths.length(t) == count(t) for t in odd_texts())
    rows = token_counts.token_counts(data.awkward(spark), queries.WORD_BPE, limit=5).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    for r in rows:
        text = "text of no id" if r.doc_id is None else data.AWKWARD[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), count(text), count(text) > 5)
    assert token_counts.token_counts(data.empty(spark), queries.WORD_BPE).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokenizers_that_keep_white_space_are_not_cut(file):
    path = public_tokenizers.path(file)
    lengths = token_counts.LengthEncoder(path)
    if file.endswith(".json"):
        library = Tokenizer.from_file(path)
        count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    else:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda text: len(library.encode(text))
    assert all(lengths.length(t) == count(t) for t in odd_texts(200))


def test_batches_are_balanced_by_bytes():
    batches = list(token_counts.balanced(["a" * 10] * 25 + ["b" * 500], 100))
    assert [len(b) for b in batches] == [10, 10, 5, 1] and sum(map(len, batches)) == 26
    for batch in token_counts.balanced(["中文字"] * 40 + ["é" * 20] * 10, 100):
        assert len("".join(batch).encode()) <= 100


def test_queries_cover_the_table(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op7_bpe_round_trip"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(r.n_tokens == len(library.encode_ordinary(texts[r.doc_id])) for r in rows)
    rows = queries.QUERIES["op5_token_counts"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and rows.where(F.col("n_tokens") > 0).count() == sum(map(bool, texts.values()))
