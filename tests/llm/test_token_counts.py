from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapstack.llm import queries, token_counts

PATH = public_tokenizers.path(queries.BYTE_BPE)
PARTS = [
    "a", "th", "e", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "23", ".", "!!", "é", "中", "🙂", "<|endoftext|>", "<|", "　",
    "\x85", "\x1c", "word", " the", "---", "    ", "٣", "Ⅷ", "²", "'re", "'R", "x" * 40,
]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_is_the_librarys_count(counter, library):
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14)))
        steps = counter.steps(text)
        assert len(steps) == len(text)
        assert np.cumsum(steps).tolist() == library([text[:k] for k in range(1, len(text) + 1)]), repr(text)


def test_truncation_and_budget(spark, docs_of, library):
    texts = [None, "", "Hello there, it's 2024!", "a  b\n\nc", "é" * 500, "word " * 30_000]
    counted = token_counts.with_prefix_counts(docs_of(texts, extra="n_tokens"), PATH)
    rows = counted.select(
        "doc_id",
        "text",
        "n_tokens",
        token_counts.tokens_in_prefix(F.col("prefix_steps"), F.lit(7)).alias("seven"),
        token_counts.longest_prefix(F.col("prefix_steps"), F.lit(3)).alias("fits"),
    ).collect()
    for r in rows:
        text = r.text or ""
        assert r.n_tokens == library([text])[0] and r.seven == library([text[:7]])[0]
        fits = [k for k in range(min(len(text), 60) + 1) if library([text[:k]])[0] <= 3]
        assert r.fits == max(fits)
    assert token_counts.with_prefix_counts(docs_of([]), PATH).count() == 0


def test_query_counts_whole_texts(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op5_prefix_token_counts(spark, sf_dir).collect()
    want = dict(zip(texts, library(list(texts.values()))))
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), want[i], want[i] > 1024) for i, t in texts.items()
    }


def test_counter_forgets_but_stays_right(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "_UNITS_KEPT", 3)
    monkeypatch.setattr(token_counts, "_PAIRS_KEPT", 3)
    texts = ["one two three four five six", "", "seven eight<|endoftext|>", "one nine ten two", "one"]
    forgetful = token_counts.Counter(PATH)
    for _ in range(3):
        assert [int(s.sum()) for s in forgetful.batch_steps(texts)] == library(texts)
