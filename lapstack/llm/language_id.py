"""Language ID: a byte convolutional network, trained in numpy and applied to all windows of a text.

Bytes are embedded, filters of several widths slide over a window, each filter keeps its maximum (after ReLU), and a
softmax over these maxima gives the languages. A text is cut into windows of fixed length that overlap by the widest
filter less one, so that no place of a text is missed; windows of a whole Arrow batch go through the network together.
For scoring, embedding and filters are multiplied out into tables over pairs of bytes, so that a filter of width four
is two rows added up.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, free_name, text_of, worker_cache
from lapstack.session import stage

UNKNOWN = "und"
_SHARES = 1_000_003
_AT_ONCE = 512  # windows that go through the network together


@dataclass(frozen=True)
class Settings:
    window: int = 128  # bytes
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16  # of each width
    embedded: int = 12  # numbers a byte becomes
    epochs: int = 12
    batch: int = 64
    rate: float = 4e-3
    decay: float = 1e-4
    language_rows: int = 1_000  # texts learnt from of one language, chosen by a hash
    max_rows: int = 8_000  # of all languages
    row_windows: int = 4  # windows learnt from of one text, spread over all of it
    least_letters: int = 16  # bytes of letters that a window learnt from has


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    settings: Settings
    weights: dict[str, np.ndarray]


def letter_bytes(windows: np.ndarray) -> np.ndarray:
    """How many bytes of each window are ASCII letters or belong to other characters."""
    lower = windows | 0x20
    return (((lower >= 97) & (lower <= 122) & (windows < 128)) | (windows >= 128)).sum(1)


def cut_windows(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts that lie in ``flat``, filled up with zero bytes, and the text of each; one at least."""
    step = settings.window - max(settings.widths) + 1
    sizes = ends - starts
    count = np.maximum(1, -(-(sizes - settings.window + step) // step))
    text = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = starts[text] + place * step
    padded = np.concatenate([flat, np.zeros(settings.window, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, settings.window)[begin]
    return np.where(np.arange(settings.window) < (ends[text] - begin)[:, None], windows, 0).astype(np.uint8), text


def _initial(languages: int, settings: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(5)
    e, f = settings.embedded, settings.filters
    out = {"embed": rng.normal(0, 0.5, (256, e))}
    for w in settings.widths:
        out[f"w{w}"] = rng.normal(0, (2 / (w * e)) ** 0.5, (w, e, f))
        out[f"b{w}"] = np.zeros(f)
    hidden = f * len(settings.widths)
    out["dense"], out["bias"] = rng.normal(0, (1 / hidden) ** 0.5, (hidden, languages)), np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in out.items()}


def _step(x: np.ndarray, y: np.ndarray, p: dict[str, np.ndarray], settings: Settings) -> dict[str, np.ndarray]:
    """Gradients of the mean cross entropy of one batch."""
    rows, f = np.arange(len(x)), settings.filters
    hidden, peaks = [], []
    for w in settings.widths:
        tables = p["embed"] @ p[f"w{w}"]  # (w, 256, f)
        length = x.shape[1] - w + 1
        out = sum(tables[j][x[:, j : j + length]] for j in range(w))
        peak = out.argmax(1)  # (rows, f)
        peaks.append(peak)
        hidden.append(np.maximum(np.take_along_axis(out, peak[:, None], 1)[:, 0] + p[f"b{w}"], 0))
    h = np.concatenate(hidden, 1)
    g = _softmax(h @ p["dense"] + p["bias"])
    g[rows, y] -= 1
    g /= len(x)
    grads = {"dense": h.T @ g, "bias": g.sum(0), "embed": np.zeros_like(p["embed"])}
    back = (g @ p["dense"].T) * (h > 0)
    for i, w in enumerate(settings.widths):
        own = back[:, i * f : (i + 1) * f]
        grads[f"b{w}"], grads[f"w{w}"] = own.sum(0), np.empty_like(p[f"w{w}"])
        for j in range(w):
            # a filter learns from the bytes at its maximum alone
            at = x[rows[:, None], peaks[i] + j]
            table = np.zeros((256, f), np.float32)
            np.add.at(table, (at, np.arange(f)), own)
            grads[f"w{w}"][j] = p["embed"].T @ table
            grads["embed"] += table @ p[f"w{w}"][j].T
    return grads


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: int, settings: Settings) -> dict[str, np.ndarray]:
    """Weights by Adam over shuffled batches; the same rows in the same order give the same weights."""
    p = _initial(languages, settings)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    rng, t = np.random.default_rng(7), 0
    total = settings.epochs * -(-len(windows) // settings.batch)
    for _ in range(settings.epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), settings.batch):
            some = order[at : at + settings.batch]
            grads = _step(windows[some], labels[some], p, settings)
            t += 1
            rate = settings.rate * (1 - t / (total + 1)) * (1 - 0.999**t) ** 0.5 / (1 - 0.9**t)
            for k, g in grads.items():
                g = g + settings.decay * p[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                p[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return p


def _tables(model: Model) -> dict[int, list[tuple[int, np.ndarray]]]:
    """For each width the tables to add up: (offset, rows by pair of bytes, or by byte for an odd last one)."""
    p, out = model.weights, {}
    for w in model.settings.widths:
        by_byte = p["embed"] @ p[f"w{w}"]
        parts = []
        for j in range(0, w - 1, 2):
            pairs = by_byte[j][:, None] + by_byte[j + 1][None]
            parts.append((j, pairs.reshape(65536, -1)))
        if w % 2:
            parts.append((w - 1, by_byte[w - 1]))
        out[w] = parts
    return out


def window_chances(windows: np.ndarray, model: Model, tables) -> np.ndarray:
    """The softmax of every window."""
    p, out = model.weights, np.empty((len(windows), len(model.languages)), np.float32)
    for at in range(0, len(windows), _AT_ONCE):
        x = windows[at : at + _AT_ONCE]
        pairs = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        hidden = []
        for w, parts in tables.items():
            length, total = x.shape[1] - w + 1, None
            for j, table in parts:
                rows = table.take((pairs if len(table) == 65536 else x)[:, j : j + length], axis=0)
                total = rows if total is None else np.add(total, rows, out=total)
            hidden.append(np.maximum(total.max(1) + p[f"b{w}"], 0))
        out[at : at + _AT_ONCE] = _softmax(np.concatenate(hidden, 1) @ p["dense"] + p["bias"])
    return out


def text_chances(texts: pa.Array, model: Model, tables) -> np.ndarray:
    """The chances of every text: the mean over its windows, weighted by their bytes of letters."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    total = np.zeros((len(texts), len(model.languages)))
    weight = np.zeros(len(texts))
    first = 0
    while first < len(texts):  # texts of some 4 MB at a time
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + (1 << 22), side="right")) - 1)
        last = min(last, len(texts))
        lo, hi = int(ends[first]), int(ends[last])
        windows, text = cut_windows(flat[lo:hi], ends[first:last] - lo, ends[first + 1 : last + 1] - lo, model.settings)
        share = letter_bytes(windows) + 1e-6
        chances = window_chances(windows, model, tables) * share[:, None]
        begin = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
        total[first:last] = np.add.reduceat(chances, begin, axis=0)
        weight[first:last] = np.add.reduceat(share, begin)
        first = last
    return total / np.maximum(weight, 1e-9)[:, None]


def held_out(column: str = "doc_id") -> Column:
    """The third that nothing is learnt from; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _has_letter(column: str = "text") -> Column:
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def sampled(rows: DataFrame, settings: Settings) -> DataFrame:
    """``text`` and ``lang`` of a bounded sample with as many rows of each language as there are, stored.

    Languages are counted over all rows; of each, the rows with the smallest hashes of id and text are taken, up to
    ``language_rows``, and fewer where the languages would make more than ``max_rows`` together.
    """
    rows = rows.filter(F.col("lang").isNotNull() & _has_letter())
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang").limit(settings.max_rows)
    known = stage(known, "languages")
    each = min(settings.language_rows, max(1, settings.max_rows // max(known.count(), 1)))
    # first a share by the hash, a little over what is asked for, then exactly so many
    share = F.least(F.lit(1.0), F.lit(each) * 1.5 / F.col("_n") + 20 / F.col("_n")) * _SHARES
    hashed = rows.withColumn("_hash", F.xxhash64("doc_id", "text")).join(F.broadcast(known), "lang")
    some = stage(hashed.filter(F.pmod("_hash", F.lit(_SHARES)) < share).select("text", "lang", "_hash"), "sample")
    order = Window.partitionBy("lang").orderBy(F.pmod("_hash", F.lit(_SHARES)), "_hash", "text")
    return some.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= each).select("text", "lang")


def train(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows of ``doc_id``, ``text`` and ``lang``; those without a language or a letter are left out.

    Windows are cut where the sampled texts lie; the network is trained in one task over at most
    ``max_rows * row_windows`` windows. Without any rows the model knows no language.
    """
    bounded_batches(rows.sparkSession)

    def cut(batches):
        for pdf in batches:
            made = []
            for text, lang in zip(pdf["text"], pdf["lang"]):
                flat = np.frombuffer(text.encode(), np.uint8)
                windows, _ = cut_windows(flat, np.array([0]), np.array([len(flat)]), settings)
                use = np.flatnonzero(letter_bytes(windows) >= min(settings.least_letters, letter_bytes(windows).max()))
                use = use[np.unique(np.linspace(0, len(use) - 1, settings.row_windows).astype(int))]
                made += [(lang, windows[i].tobytes()) for i in use]
            yield pd.DataFrame(made, columns=["lang", "bytes"])

    windows = stage(sampled(rows, settings).mapInPandas(cut, "lang string, bytes binary"), "windows")
    languages = tuple(sorted(r[0] for r in windows.select("lang").distinct().collect()))  # max_rows at most
    if len(languages) < 2:
        return Model(languages, settings, {})

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "bytes"], kind="stable")
        x = np.frombuffer(b"".join(pdf["bytes"]), np.uint8).reshape(len(pdf), settings.window)
        y = np.searchsorted(np.array(languages, object), pdf["lang"].to_numpy(object))
        got = fit(x, y, len(languages), settings)
        return pd.DataFrame([(k, list(v.shape), v.astype("<f4").tobytes()) for k, v in got.items()], columns=["k", "shape", "v"])

    learnt = windows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(learn, "k string, shape array<int>, v binary").collect()
    weights = {r["k"]: np.frombuffer(r["v"], "<f4").reshape(tuple(r["shape"])) for r in learnt}
    return Model(languages, settings, weights)


def language_column(text: Column, model: Model) -> Column:
    """(lang, score) of a text that is not NULL: the likeliest language and its chance."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
    if len(model.languages) < 2:
        known = model.languages[0] if model.languages else UNKNOWN
        return F.struct(F.lit(known).alias("lang"), F.lit(float(len(model.languages))).alias("score"))
    key = hashlib.sha256(b"".join(model.weights[k].tobytes() for k in sorted(model.weights))).hexdigest()

    @F.arrow_udf("lang string, score double")
    def found(texts: pa.Array) -> pa.Array:
        cache = worker_cache()
        if key not in cache:
            cache[key] = _tables(model)
        chances = text_chances(texts, model, cache[key])
        best = chances.argmax(1)
        score = np.clip(chances[np.arange(len(best)), best], 0.0, 1.0)
        names = pa.array(model.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(score)], fields=list(kind))

    return found(text)


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, which depend on the text alone; the whole text is read.

    A NULL text, or one without any letter, is ``und`` with score 0; so is every text if no language is known. Columns
    of the two names are replaced, all others stay.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    name = free_name([*docs.columns, "lang_pred", "score"], "found")
    letter = _has_letter()
    return (
        docs.withColumn(name, language_column(text_of(), model))
        .withColumn("lang_pred", F.when(letter, F.col(name)["lang"]).otherwise(UNKNOWN))
        .withColumn("score", F.when(letter, F.col(name)["score"]).otherwise(0.0))
        .drop(name)
    )


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``with_language`` with a model learnt from the documents' own ``lang``, without the held-out third."""
    learnt = docs.filter(~held_out()).select("doc_id", "text", "lang")
    return with_language(docs, train(learnt, settings))
