from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from lapstack.llm import queries, sentencepieces

PATH = public_tokenizers.path(queries.PIECES)
ODD = [
    "", " ", "  a", "a  b   c\n\n d\t", "中文 テスト 🙂 ﬁ x", "x" * 300, "<s> </s> <unk> <0x41>", "naïve café 12345 3.14", "\x00\x01",
    "the" * 50, "aaaa bbbb " * 20, "　", "   ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(PATH)


def test_ids_and_texts_are_the_librarys(pieces, library):
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice("abcdehinorst  \n.,é中12") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    got = pieces.encode(texts)
    for text, ids in zip(texts, got):
        want = library.encode(text)
        assert ids.tolist() == want, repr(text)
        assert pieces.decode(ids) == library.decode(want) == text


def test_the_mark_itself_decodes_as_a_space(pieces, library):
    ids = pieces.encode(["a▁b"])[0]
    assert ids.tolist() == library.encode("a▁b") and pieces.decode(ids) == "a b"


def test_documents(spark, docs_of, library):
    texts = [None, *ODD, "word " * 30_000]
    rows = sentencepieces.with_pieces(docs_of(texts, extra="decoded"), PATH, decoded=True).collect()
    for r in rows:
        assert r.token_ids == library.encode(r.text or "") and r.n_tokens == len(r.token_ids) and r.decoded == (r.text or "")
    assert sentencepieces.with_pieces(docs_of([]), PATH).count() == 0


def test_query_round_trips(spark):
    rows = queries.op6_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
