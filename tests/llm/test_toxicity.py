from __future__ import annotations

import math
import random
import zlib

import numpy as np

from lapstack.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def hashes(text, settings=toxicity.Settings()):
    return toxicity.Words(settings).hashes(text)


def test_features_are_words_pairs_skips_and_stems():
    a = toxicity.features(hashes("One two, THREE"))
    assert len(a) == 3 + 2 + 1 + 1  # "thre" is a stem
    assert len(toxicity.features(hashes("one"))) == 1
    assert len(toxicity.features(hashes(""))) == 0
    assert set(a) == set(toxicity.features(hashes("one two three")))
    assert set(a) != set(toxicity.features(hashes("three two one")))
    # longest, longer, longish: a stem of four three times, so a mark at 2 and at 3; one of six twice
    marks = [toxicity.features(hashes("longestly longerly longestish"), r) for r in ((), (2,), (2, 3))]
    assert [len(m) for m in marks] == [6 + 1 + 2, 6 + 1 + 2 + 2, 6 + 1 + 2 + 3]


def test_words_are_kept_and_forgotten(monkeypatch):
    text = " ".join(f"word{i}" for i in range(9000))
    whole = hashes(text)
    monkeypatch.setattr(toxicity, "_WORDS_KEPT", 10)
    words = toxicity.Words(toxicity.Settings())
    assert (words.hashes(text) == whole).all() and (words.hashes(text) == whole).all()
    assert (words.hashes("word1 x word2") == np.stack([whole[1], words.hashes("x")[0], whole[2]])).all()


def scalar_ftrl(rows, labels, slots, l1, alpha, epochs, settings, lift):
    """One coordinate after the other, as published, in dictionaries."""
    z, n = dict.fromkeys(range(slots), 0.0), dict.fromkeys(range(slots), 0.0)

    def weight(i):
        bound = l1 if i else 0.0
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - math.copysign(bound, z[i])) / ((settings.beta + math.sqrt(n[i])) / alpha + settings.l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            w = {i: weight(i) for i in [0, *rows[r]]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[r]
            g *= lift if labels[r] else 1.0
            for i, wi in w.items():
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * wi
                n[i] += g * g
    return [weight(i) for i in range(slots)]


def test_weights_are_those_of_scalar_ftrl():
    rng = random.Random(3)
    settings = toxicity.Settings()
    rows = [sorted(rng.sample(range(1, 40), rng.randint(0, 9))) for _ in range(150)]
    labels = [int(bool({3, 7, 11} & set(r)) or rng.random() < 0.05) for r in rows]
    for l1, alpha, lift in ((0.0, 1.0, 1.0), (2.0, 0.3, 1.0), (0.5, 0.3, 2.5)):
        at = [np.array(r, np.int32) for r in rows]
        got = toxicity._descend(at, np.array(labels, float), 40, l1, alpha, 3, settings, lift)
        want = scalar_ftrl(rows, labels, 40, l1, alpha, 3, settings, lift)
        assert np.abs(got - np.array(want)).max() < 1e-9
        assert l1 == 0 or 0 < sum(w == 0 for w in want) < 40


def test_learnt_bytes_are_bounded(spark):
    rows = [(i, f"word{i % 7} " * (4000 if i == 5 else 40), i % 2) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = toxicity.train(frame, toxicity.Settings(max_bytes=20_000, min_docs=1))
    assert 0 < len(model.keys) < 200


def test_stems_catch_new_forms(spark):
    """Words of label 1 that share a stem, with endings that were not learnt from."""
    rng = random.Random(9)

    def form(stem):
        return stem + "".join(rng.choice("abcdefgh") for _ in range(5))

    def text(label):
        words = [form(rng.choice(["plain", "quiet", "solid"])) for _ in range(30)]
        for i in rng.sample(range(30), 4 if label else 0):
            words[i] = form("grumpel")
        return " ".join(words)

    train, test = ([(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(n)] for n in (600, 200))
    model = toxicity.train(spark.createDataFrame(train, "doc_id bigint, text string, label int"))
    assert all((toxicity.score_text(hashes(t), model) >= 0.5) == (y == 1) for _, t, y in test)


def made(n, seed):
    rng = random.Random(seed)
    bad = ["gnarl", "vorp", "zund"]
    rows = []
    for i in range(n):
        words = ["w%d" % rng.randrange(3000) for _ in range(rng.randint(3, 60))]
        label = int(rng.random() < 0.15)
        if label:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), label))
    return rows


def test_held_out_accuracy_and_sparse_weights(spark):
    train, test = made(3000, 1), made(800, 2)
    model = toxicity.train(spark.createDataFrame(train, "doc_id bigint, text string, label int"))
    assert 3 <= len(model.keys) < 500
    scored = [(toxicity.score_text(hashes(t), model), y) for _, t, y in test]
    assert sum((s >= 0.5) == (y == 1) for s, y in scored) >= 790
    assert all(0 <= s <= 1 for s, _ in scored)


def test_model_without_both_labels(spark):
    schema = "doc_id bigint, text string, label int"
    none = toxicity.train(spark.createDataFrame([], schema))
    assert toxicity.score_text(hashes("any"), none) < 0.5
    ones = toxicity.train(spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "b", None)], schema))
    assert toxicity.score_text(hashes(""), ones) > 0.5


def test_scores_of_documents(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None), (3, ""), (3, ""), (None, "x y"), (4, "z " * 50_000)], extra="score")
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (99, 0, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.with_scores(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.with_scores(docs.limit(0), labels).count() == 0


def test_learnt_rows_leave_the_held_out_fifth_out(spark, docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(200)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id bigint, quality int, toxic int")
    ids = {int(r.doc_id) for r in toxicity.labelled_rows(docs, labels).collect()}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_query_returns_every_document(spark):
    got = queries.op9_toxicity(spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
