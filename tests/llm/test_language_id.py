from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lapstack.llm import language_id as li

SMALL = li.Settings(window=48, filters=8, epochs=8, language_rows=150)
WORDS = {
    "aa": "the of wh then ing tion that ea".split(),
    "bb": "der die sch über für ung straße ich".split(),
    "cc": "que le élan où ça eaux très ment".split(),
}
SCHEMA = "doc_id bigint, text string, lang string"


def made(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        out.append((i, " ".join("".join(rng.choices(WORDS[lang], k=2)) for _ in range(rng.randint(6, 60))), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return li.train(spark.createDataFrame(made(450), SCHEMA).filter(~li.held_out()), SMALL)


def direct(text, model):
    """Window by window, filter by filter, place by place."""
    data, s, p = text.encode(), model.settings, model.weights
    step = s.window - max(s.widths) + 1
    total, weight = np.zeros(len(model.languages)), 0.0
    for begin in range(0, max(1, len(data) - s.window + step), step):
        part = data[begin : begin + s.window]
        letters = sum(b >= 128 or chr(b).isalpha() for b in part) + 1e-6
        x = p["embed"][list(part.ljust(s.window, b"\0"))].astype(np.float64)
        hidden = []
        for w in s.widths:
            places = [sum(x[i + j] @ p[f"w{w}"][j] for j in range(w)) for i in range(s.window - w + 1)]
            hidden.append(np.maximum(np.max(places, axis=0) + p[f"b{w}"], 0))
        z = np.concatenate(hidden) @ p["dense"] + p["bias"]
        e = np.exp(z - z.max())
        total, weight = total + letters * e / e.sum(), weight + letters
    return total / weight


def test_windows_cover_a_text():
    rng = np.random.default_rng(2)
    for sizes in ([0], [1, 0, 47, 48, 49, 93, 94, 500], [45, 46, 44]):
        flat = rng.integers(1, 256, sum(sizes)).astype(np.uint8)
        ends = np.cumsum(sizes)
        windows, text = li.cut_windows(flat, ends - sizes, ends, SMALL)
        for i, n in enumerate(sizes):
            own, step = flat[ends[i] - n : ends[i]], 48 - 3
            mine = windows[text == i]
            grams = {w[j : j + 4].tobytes() for w in mine for j in range(45)}
            assert {own[j : j + 4].tobytes() for j in range(n - 3)} <= grams
            back = np.concatenate([mine[0], *[w[3:] for w in mine[1:]]])
            assert back[:n].tobytes() == own.tobytes() and not back[n:].any() and len(back) - n < max(49, step)


def test_gradients():
    settings = li.Settings(window=12, widths=(2, 3), filters=3, embedded=4)
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in li._initial(3, settings).items()}
    x, y = rng.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        hidden = []
        for w in settings.widths:
            places = [sum(p["embed"][x[:, i + j]] @ p[f"w{w}"][j] for j in range(w)) for i in range(12 - w + 1)]
            hidden.append(np.maximum(np.max(places, axis=0) + p[f"b{w}"], 0))
        chances = li._softmax(np.concatenate(hidden, 1) @ p["dense"] + p["bias"])
        return -np.log(chances[np.arange(5), y]).mean()

    for name, grad in li._step(x, y, p, settings).items():
        spots = [np.unravel_index(i, p[name].shape) for i in rng.integers(0, p[name].size, 6)]
        spots += [np.unravel_index(np.abs(grad).argmax(), grad.shape)]
        for at in spots:
            old = p[name][at]
            p[name][at] = old + 1e-5
            up = loss()
            p[name][at] = old - 1e-5
            down = loss()
            p[name][at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4, name


def test_tables_equal_the_plain_network(model, monkeypatch):
    texts = [r[1] for r in made(12, 5)] + ["", "x", "1234 !!", "ß" * 40, "the " * 400]
    want = np.array([direct(t, model) for t in texts])
    got = li.text_chances(pa.array(texts), model, li._tables(model))
    assert np.abs(got - want).max() < 1e-4
    monkeypatch.setattr(li, "_AT_ONCE", 3)
    sliced = pa.array(["zz", *texts])[1:]
    assert np.abs(li.text_chances(sliced, model, li._tables(model)) - want).max() < 1e-4


def test_held_out_accuracy(spark, model):
    df = spark.createDataFrame(made(450), SCHEMA)
    got = li.with_language(df, model).withColumn("held_out", li.held_out()).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    rest = [r.lang == r.lang_pred for r in got if r.held_out]
    assert len(rest) > 100 and sum(rest) / len(rest) >= 0.98


def test_only_texts_and_learnt_languages_matter(spark):
    rows = made(240)
    spoilt = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    one, two = (
        {r.doc_id: (r.lang_pred, r.score) for r in li.identify(spark.createDataFrame(x, SCHEMA), SMALL).collect()}
        for x in (rows, spoilt[::-1])
    )
    assert one == two


def test_whole_texts(spark, model):
    """The language of a long text is that of most of it, wherever that lies."""
    first, rest = "the thing of that " * 30, "über die straße für dich " * 900
    got = li.with_language(spark.createDataFrame([(1, first + rest, None), (2, first, None)], SCHEMA), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "bb", 2: "aa"}


def test_odd_texts(spark, model):
    rows = [(1, None, "aa"), (2, "", None), (3, "12 % \t\n 3", "aa"), (None, "the thing of that", "aa"), (5, "ü", None), (5, "ü", "bb")]
    got = li.with_language(spark.createDataFrame(rows, SCHEMA), model).collect()
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == 6 and by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[None][0] == "aa" and by_id[5][0] in WORDS


def test_no_or_one_language(spark):
    none = li.identify(spark.createDataFrame([(0, "text", None), (2, None, "aa"), (3, "12", "aa")], SCHEMA), SMALL)
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    one = li.identify(spark.createDataFrame([(0, "text", "aa"), (0, "more", None)], SCHEMA), SMALL)
    assert {(r.lang_pred, r.score) for r in one.collect()} == {("aa", 1.0)}
    empty = li.identify(spark.createDataFrame([], SCHEMA), SMALL)
    assert empty.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and empty.count() == 0


def test_sample_is_bounded_and_balanced(spark):
    rows = [(i, f"text {i}", "aa" if i % 20 else f"l{i % 3}") for i in range(3000)]
    rows += [(None, "same", "aa")] * 500
    settings = li.Settings(language_rows=40, max_rows=1000)
    got = li.sampled(spark.createDataFrame(rows, SCHEMA), settings).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"aa": 40, "l0": 40, "l1": 40, "l2": 40}
    assert li.sampled(spark.createDataFrame(rows, SCHEMA), li.Settings(max_rows=8)).count() == 8


def test_other_columns_stay(spark, model):
    df = spark.createDataFrame([(1, "the thing", "aa", "a", "b", "c", "d")], SCHEMA + ", score string, lang_pred string, _found string, _n string")
    got = li.with_language(df, model)
    assert sorted(got.columns) == sorted(df.columns)
    row = got.first()
    assert (row._found, row._n, row.lang) == ("c", "d", "aa") and 0 <= row.score <= 1
