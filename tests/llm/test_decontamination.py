from __future__ import annotations

import random

import duckdb
import pandas as pd

from lapstack.llm import decontamination

ITEM = "item_id bigint, text string, doc_id string"


def by_hand(docs, items, share=0.8):
    def shingles(t, n):
        w = (t or "").lower().split()
        return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    words, out = {}, set()
    for i, t in docs:
        words.setdefault(i, []).append(t)
    for k, t in items:
        n = min(5, len((t or "").split()))
        s = shingles(t, n) if n else set()
        for i, own in words.items():
            d = set().union(*(shingles(t, n) for t in own)) if s and i is not None else set()
            if s and i is not None and len(s & d) / len(s) >= share:
                out.add((i, k, len(s), len(s & d)))
    return out


def sample():
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 70, 150])))) for k in range(30)]
    items += [(100, items[3][1]), (101, None), (102, "  "), (103, "tiny item"), (3, items[3][1])]
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            passage = items[rng.randrange(30)][1].split()
            if rng.random() < 0.5:  # one changed word in some
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() for w in passage]
        docs.append((i, "\n".join(" ".join(body[j : j + 20]) for j in range(0, len(body), 20))))
    docs += [(200, None), (201, ""), (202, "Tiny  item"), (203, "a tiny  ITEM more"), (206, "tiny"), (207, "long " * 3000 + "tiny item"), (5, docs[5][1]), (None, items[0][1])]
    docs += [(204, items[29][1] + " " + "filler " * 30_000), (205, items[20][1])]
    return docs, items


def test_equals_brute_force(spark, docs_of):
    docs, items = sample()
    table = spark.createDataFrame([(k, t, "clash") for k, t in items], ITEM)
    got = decontamination.matches(docs_of(docs, extra="item"), table).collect()
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got} == by_hand(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert all(abs(r.containment - r.shared_shingles / r.item_shingles) < 1e-12 for r in got)


def test_shuffled_sides_give_the_same(spark, docs_of, monkeypatch):
    docs, items = sample()
    monkeypatch.setattr(decontamination, "_BROADCAST_ROWS", -1)
    table = spark.createDataFrame([(k, t, None) for k, t in items], ITEM)
    got = decontamination.matches(docs_of(docs), table).collect()
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got} == by_hand(docs, items)


def test_decontaminated_documents(spark, docs_of):
    docs, items = sample()
    table = spark.createDataFrame([(k, t, None) for k, t in items], ITEM)
    frame = docs_of(docs, extra="item_id")
    hit = {i for i, *_ in by_hand(docs, items)}
    kept = decontamination.decontaminate(frame, table)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in hit)
    assert decontamination.decontaminate(frame, table.limit(0)).count() == len(docs)
    assert decontamination.matches(frame.limit(0), table).count() == 0


def test_sketches_by_size(spark):
    words = [f"u{i}" for i in range(300)]
    items = spark.createDataFrame([(1, words[:20]), (2, words)], "item bigint, words array<string>")
    rows = decontamination.item_sketches(items).collect()
    small, large = ([r for r in rows if r.item == k] for k in (1, 2))
    assert len(small) == small[0].size == 16 and small[0].required == 13 and small[0].part == 4
    # in the partition up to 512 a document may lack 102 shingles, of this item 59
    assert len(large) == 118 and large[0].size == 296 and large[0].part == 9 and large[0].required == 118 - 59


def test_required_hits_by_partition(spark):
    """No document with the asked-for share is ruled out, whichever of its shingles it lacks."""
    sizes = [1, 5, 48, 49, 64, 65, 100, 128, 129, 1000, 5000]
    items = spark.createDataFrame([(n, [f"u{n}_{i}" for i in range(n + 4)]) for n in sizes], "item bigint, words array<string>")
    rows = decontamination.item_sketches(items).groupBy("item", "part", "required").count().collect()
    got = {r.item: (r.part, r["count"], r.required) for r in rows}
    assert [got[n][0] for n in sizes] == [0, 3, 6, 6, 6, 7, 7, 7, 8, 10, 13]
    assert [got[n][1] for n in sizes] == [1, 5, 48, 48, 48, 48, 48, 48, 67, 220, 1654]
    assert all(got[n][2] == got[n][1] - n // 5 >= min(n - n // 5, 16) for n in sizes)


def test_long_items_with_any_share(spark, docs_of):
    """Items of 200 to 1,000 shingles in documents that hold just enough of them, or just too little."""
    rng = random.Random(6)
    items, docs = [], []
    for k, n in enumerate([204, 260, 516, 1004, 1004]):
        words = [f"i{k}_{j}" for j in range(n)]
        items.append((k, " ".join(words)))
        for lost in (0, n // 10, (n - 4) // 5 - 1, (n - 4) // 5, (n - 4) // 5 + 1, n // 2):
            at = rng.randrange(5, n - lost) if lost else n  # a cut in the middle loses four more shingles
            keep = words[: n - lost] if rng.random() < 0.5 or not lost else words[lost:]
            docs.append((len(docs), " ".join(["x"] * rng.randrange(400) + keep + ["y"] * 50)))
            docs.append((len(docs), " ".join(words[:at] + ["z"] + words[at + lost :])))
    want = by_hand(docs, items)
    assert 20 < len(want) < len(docs)
    got = decontamination.matches(docs_of(docs), spark.createDataFrame([(k, t, "c") for k, t in items], ITEM)).collect()
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got} == want


def test_short_items_inside_long_documents(spark, docs_of):
    items = [(1, "one"), (2, "two words"), (3, "three words here"), (4, "four words in here"), (5, "and five words in here"), (6, "one")]
    body = "filler " * 500
    docs = [(i, f"{body}{t.upper()} {body}") for i, t in items] + [(10, "four words"), (11, "words two"), (12, "two  words"), (13, "ones")]
    got = decontamination.matches(docs_of(docs), spark.createDataFrame([(k, t, None) for k, t in items], ITEM)).collect()
    found = {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got}
    assert found == by_hand(docs, items) and {(6, 1), (12, 2), (4, 4)} <= {f[:2] for f in found}


def test_sql_finds_the_same(spark, docs_of):
    docs, items = sample()
    items += [(900, "two v7"), (901, "v1 v2 v3 v4"), (902, "v9")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    got = con.execute(f"SELECT doc_id, item_id, item_shingles, shared_shingles FROM ({decontamination.MATCHES_SQL})").fetchall()
    assert set(got) == by_hand(docs, items)
