from __future__ import annotations

import random

import numpy as np
import xxhash

from lapstack.llm import simhash


def by_hand(text: str, width: int = 4) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in lowered.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, budget=4):
    low = list(range(len(ids)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return {ids[i]: least[root(i)] for i in range(len(ids))}


def test_fingerprint_is_the_contract():
    rng = random.Random(1)
    texts = ["", " \t\n", "One", "Two WORDS", "a b c d", "É é a  b\tc\x0bd\x0ce f g h i"]
    texts += [" ".join(rng.choice("ab cd EF g".split()) for _ in range(rng.randint(1, 40))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t) == by_hand(t)


def test_long_text_in_slices(monkeypatch):
    text = " ".join(str(i * i) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_SLICE", 7)
    assert simhash.fingerprint(text) == whole == by_hand(text)


def test_trie_finds_the_components_of_all_pairs(spark):
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            value = centre
            for _ in range(rng.randint(0, 6)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
            if rng.random() < 0.3:
                centre = value  # chains, so that components are wider than the budget
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = [(r.a, r.b) for r in simhash.near_links(df).collect()]
    want = components(list(range(len(prints))), prints)
    at = {v: i for i, v in enumerate(signed)}
    low = dict(enumerate(range(len(prints))))
    for _ in range(len(prints)):
        for a, b in links:
            x = min(low[at[a]], low[at[b]])
            low[at[a]] = low[at[b]] = x
    assert low == want
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 64 for a, b in links)


def test_dense_group_and_crowded_nodes(spark, monkeypatch):
    """A group whose prints differ in few bits is one component, also where its nodes are cut further."""
    rng = random.Random(3)
    prints = {sum(1 << rng.randrange(20) for _ in range(rng.randint(0, 3))) for _ in range(3000)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    far = [-(2**40) * (i + 1) - (2**50) for i in range(3)]
    df = spark.createDataFrame([(v,) for v in signed + far], "fp bigint")
    monkeypatch.setattr(simhash, "_NODE_LIMIT", 200)
    links = simhash.near_links(df)
    roots = simhash.connected_components(links)
    got = {r.node: r.root for r in roots.collect()}
    want = components(list(range(len(signed))), sorted(prints))
    assert len(set(want.values())) == 1
    assert len({got[v] for v in signed}) == 1


def test_chain_of_links(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.connected_components(chain).collect()}
    assert got == {i: 0 for i in range(101)} | {400: 400, 500: 400}
    assert simhash.connected_components(chain.limit(0)).count() == 0


def test_classes_and_survivors(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(200))
    texts = [(5, base), (3, base), (9, base + " end"), (7, "something else entirely here now"), (8, None), (2, ""), (8, None)]
    docs = docs_of(texts, extra="component_id")
    got = sorted((r.doc_id, r.component_id) for r in simhash.simhash_classes(docs).collect())
    prints = [simhash.fingerprint(t or "") for _, t in texts]
    want = components([i for i, _ in texts], prints)
    assert got == sorted((i, want[i]) for i, _ in texts)
    kept = simhash.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i in want if want[i] == i})
    again = docs_of([(1, "same text"), (1, "same text"), (None, "no id at all")])
    assert sorted(str(r.doc_id) for r in simhash.one_per_class(again).collect()) == ["1", "None"]
    assert simhash.simhash_classes(docs.limit(0)).count() == 0


def test_one_of_each_class_with_repeated_and_missing_ids(spark, docs_of):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(40)) for k in "abcd")
    rows = [(5, a), (5, b), (5, a), (7, c), (7, d), (6, d), (None, a), (None, "alone here"), (None, "alone here"), (8, c), (9, "e")]
    got = [(r.doc_id, r.text) for r in simhash.one_per_class(docs_of(rows)).collect()]
    # 7 names the class of c, but d has 6; a row without an id stays only where its class has none
    want = [(5, a), (5, b), (7, c), (6, d), (None, "alone here"), (None, "alone here"), (9, "e")]
    assert sorted(got, key=str) == sorted(want, key=str)
    near = " ".join(f"n{i}" for i in range(300))
    bits = lambda t: (simhash.fingerprint(near) ^ simhash.fingerprint(t)).bit_count()
    other = next(t for t in (f"{near} tail{i}" for i in range(100)) if 0 < bits(t) <= 4)
    assert simhash.one_per_class(docs_of([(3, near), (3, other), (4, near)])).count() == 1
