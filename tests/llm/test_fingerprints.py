from __future__ import annotations

import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from lapstack.llm import fingerprints, queries

FRACTION = 1 / 16


def hashes(text):
    words = [w for w in text.lower().replace("\n", " ").split(" ") if w]
    out = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h & 0xFFFFFFFFFFFFFFFF)
        out.add(struct.unpack("<q", struct.pack("<Q", h))[0])
    return out


def sketch(text, fraction=FRACTION):
    return {h for h in hashes(text) if h < -(1 << 63) + int(fraction * (1 << 64))}


def likeness(a, b, fraction=FRACTION):
    x, y = sketch(a, fraction), sketch(b, fraction)
    return len(x & y) / len(x | y) if x | y else 1.0


def printed(text):
    return ",".join(f"{h & 0xFFFFFFFFFFFFFFFF:x}" for h in sorted(sketch(text)))


def place(pair):
    h = xxhash.xxh64_intdigest((pair[1] or "").encode(), 42)
    return pair[0], h - (1 << 64) if h >> 63 else h, pair[1] or ""


def by_hand(pairs):
    rows = [(i, t or "") for i, t in sorted(pairs, key=place)]
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edit = t[: len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), printed(t), printed(edit), likeness(t, edit), likeness(t, following)))
    return out


def texts(n, seed):
    rng = random.Random(seed)
    out = [" ".join(f"w{rng.randrange(5000)}é" for _ in range(rng.choice([0, 1, 3, 6, 40, 68, 69, 300, 2000]))) for _ in range(n)]
    return out + [None, "", out[0], "One\nTWO three", "word " * 50_000]


@pytest.mark.parametrize(("parts", "size"), [("2", 64 << 20), ("40", 64 << 20), ("2", 20_000), ("2", 300)])
def test_equals_brute_force(spark, docs_of, parts, size):
    rng = random.Random(8)
    pairs = [(i, t) for i, t in zip(rng.sample(range(-500, 10_000), 65), texts(60, 9))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = docs_of(pairs, extra="sketch")
        rows = fingerprints.edit_fingerprints(docs, fingerprints.Settings(bucket_bytes=size)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(r)[:7] for r in rows) == sorted(by_hand(pairs))


@pytest.mark.parametrize("pairs", [[], [(3, "a b c d e f")], [(1, "x"), (1, "x"), (1, None), (2, "y")], [(5, None)]])
def test_small_tables(spark, docs_of, pairs):
    rows = fingerprints.edit_fingerprints(docs_of(pairs)).collect()
    assert sorted(tuple(r)[:7] for r in rows) == sorted(by_hand(pairs))


def test_rows_without_id(spark, docs_of):
    rows = fingerprints.edit_fingerprints(docs_of([(None, "a b"), (4, "c d"), (None, None)])).collect()
    assert len(rows) == 3


def test_an_id_with_most_rows_is_several_ranges(spark, docs_of):
    rng = random.Random(12)
    body = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 60)))
    pairs = [(7, body()) for _ in range(200)] + [(i, body()) for i in range(40)] + [(10**12, body()), (7, "same"), (7, "same")]
    settings = fingerprints.Settings(bucket_bytes=4_000)
    docs = docs_of(pairs)
    columns = [F.col("doc_id").alias("k"), F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes")]
    assert sum(k == 7 for k, _ in fingerprints._firsts(docs.select(*columns), settings)) > 5
    rows = fingerprints.edit_fingerprints(docs, settings).collect()
    assert sorted(tuple(r)[:7] for r in rows) == sorted(by_hand(pairs))


def test_one_range_to_a_partition(spark, docs_of):
    pairs = [(i, "w " * 100) for i in range(400)]
    rows = fingerprints.with_next(docs_of(pairs), F.col("text"), fingerprints.Settings(bucket_bytes=8_000))
    sizes = [r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 45


def test_clashing_columns(spark):
    names = ["key", "hash", "range", "to", "end", "_hashes"]
    docs = spark.createDataFrame([(i, f"t{i}", *names) for i in range(5)], "doc_id bigint, text string" + "".join(f", {n} string" for n in names))
    rows = fingerprints.with_next(docs, F.col("text")).collect()
    assert {(r.doc_id, r.own, r.next) for r in rows} == {(i, f"t{i}", f"t{(i + 1) % 5}") for i in range(5)}
    assert all([r[n] for n in names] == names for r in rows)
    kept = fingerprints.with_fingerprint(docs)
    assert kept.columns == [*docs.columns, "sketch"] and kept.first()._hashes == "_hashes"


def test_merged_sketches_estimate_containment(spark, docs_of):
    rng = random.Random(10)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40_000)]
    part, whole = " ".join(words[1000:5000]), " ".join(words)
    halves = docs_of([" ".join(words[:20_004]), " ".join(words[20_000:])])
    union = fingerprints.with_fingerprint(halves).agg(fingerprints.merged(F.col("sketch")).alias("u"))
    both = fingerprints.with_fingerprint(docs_of([part])).crossJoin(union)
    one = fingerprints.with_fingerprint(docs_of([whole])).withColumnRenamed("sketch", "u").select("u")
    for frame in (both, fingerprints.with_fingerprint(docs_of([part])).crossJoin(one)):
        share, back = frame.select(
            fingerprints.containment(F.col("sketch"), F.col("u")), fingerprints.containment(F.col("u"), F.col("sketch"))
        ).first()
        assert share == 1.0 and 0.07 < back < 0.13


def test_query_has_no_python(spark, capsys):
    queries.op7_scaled_fingerprints(spark, "/root/testdata/sf0.001").explain()
    assert "Python" not in capsys.readouterr().out


def test_query_is_near_the_exact_likeness(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    made = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(9, 155))) for _ in range(400)]
    made += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(9, 20))) for _ in range(200)]
    docs = docs_of(made)
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: docs)
    rows = {r.doc_id: r for r in queries.op7_scaled_fingerprints(spark, "").collect()}
    off = []
    for i, t in enumerate(made):
        half = len(t) // 2
        a, b = hashes(t), hashes(t[: len(t) - half] + made[(i + 1) % len(made)][:half])
        off.append(abs(rows[i].near_edited - len(a & b) / len(a | b)))
        assert len(a & b) / len(a | b) <= 0.2 or rows[i].near_edited > 0, i
        assert abs(rows[i].part_of_edited - len(a & b) / len(a)) < 0.35, i
    assert max(off) < 0.25 and sum(off) / len(off) < 0.03


def test_empty_sketches_are_equal_or_share_nothing(spark):
    """Likeness is a number also where no hash of a text is below the fraction."""
    low = -(1 << 63) + (1 << 60)
    bare = next(t for t in (f"a b c d e{i} f" for i in range(100)) if not any(h < low for h in hashes(t)))
    long = bare + " " + " ".join(f"z{i}" for i in range(200))
    pair = spark.createDataFrame([(bare, long, "")], "a string, b string, c string")
    made = pair.select(*[fingerprints.sketch_of(fingerprints.hashes_of(F.col(c))).alias(c) for c in "abc"])
    a, b, c = map(F.col, "abc")
    row = made.select(
        fingerprints.containment(a, b), fingerprints.containment(a, c), fingerprints.containment(b, a),
        fingerprints.resemblance(a, b), fingerprints.resemblance(a, c), fingerprints.resemblance(b, b),
    ).first()
    assert tuple(row) == (0.0, 1.0, 0.0, 0.0, 1.0, 1.0)
