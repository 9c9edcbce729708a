from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from lapstack.llm import conversation_trie as ct
from lapstack.session import GROUP_ROWS

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt_by_hand(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def trie_by_hand(sequences):
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        has_child = {m[:-1] for m in members if m}
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        ended = sorted(c for c in convs if len(sequences[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(m) == len(node) + 1 for m in below),
                sum(m not in has_child for m in below),
                saved,
                hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA, how=None):
    placed = ct.placed_turns(spark.createDataFrame(rows, schema))
    parts = ct.rebuilt(placed) if how is None else how(placed)
    return sorted((tuple(r) for r in ct.prefix_trie(*parts).collect()), key=repr)


def test_rebuilt_conversations(spark):
    rng = random.Random(1)
    rows = []
    for c in rng.sample(range(-50, 130), 70) + [0, 40, 80]:
        n = rng.choice([1, 1, 2, 3, 4, 5, 8, 9, 13])
        rows += [(c, t if t else None, rng.choice(["user", None]), rng.choice(["a", "b c", None, "", "a"])) for t in range(n)]
    rng.shuffle(rows)
    want = trie_by_hand(rebuilt_by_hand(rows))
    assert any(w[1] == 0 and w[7] != hashlib.sha256(b"").hexdigest() for w in want)  # some conversation has no turn left
    assert run(spark, rows) == want


@pytest.mark.parametrize("lengths", [[1], [2, 1], [3, 5, 6, 7, 8, 9, 15, 16, 17, 31, 33], [64, 64, 64, 63, 65]])
def test_every_depth_and_height(spark, lengths):
    """Prefixes that are cut at different heights are the same nodes."""
    rows = []
    for c, n in enumerate(lengths * 3):
        branch = c % 5 * 3
        rows += [(c, t, "u", f"w{t}" if t < n - branch else f"w{t} {c}") for t in range(n)]
    whole = lambda placed: (placed, ct.stage(ct.lengths(placed), "sizes"))
    sequences = {}
    for c, _, r, x in rows:
        sequences.setdefault(c, []).append((r, x))
    assert run(spark, rows, how=whole) == trie_by_hand(sequences)


def test_equal_texts_with_other_roles_or_borders_differ(spark):
    rows = [(0, 0, "a", "bc"), (1, 0, "ab", "c"), (2, 0, "", "abc"), (3, 0, "a", None), (4, 0, None, "a"), (5, 0, "a", "")]
    whole = lambda placed: (placed, ct.stage(ct.lengths(placed), "sizes"))
    got = run(spark, rows, how=whole)
    assert sorted((r[0], r[3]) for r in got if r[1] == 1) == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 1)]


def test_a_third_of_all_rows_in_one_group(spark):
    """Equal conversations, one very long conversation whose turns are ordered in chunks, and ties of a turn."""
    rows = [(c, t, "user", f"same {t}") for c in range(60) for t in range(4)]
    rows += [(77, t // 2, "user", f"t{t * 7919 % 101}") for t in range(250)]
    rows += [(100 + c, 0, "user", f"{c}") for c in range(30)]
    spark.conf.set(GROUP_ROWS, "20")
    try:
        got = run(spark, rows)
    finally:
        spark.conf.unset(GROUP_ROWS)
    assert got == trie_by_hand(rebuilt_by_hand(rows))


def test_digest_of_many_ids_in_pieces(spark):
    ids = random.Random(4).sample(range(-3000, 9000), 2500)
    ends = spark.createDataFrame([(b"x" if i % 7 else b"y", i) for i in ids], "node binary, conv bigint")
    got = {bytes(r.node): r.ends_sha256 for r in ct.member_digests(ends.repartition(5)).collect()}
    for node, keep in ((b"x", True), (b"y", False)):
        text = ",".join(str(i) for i in sorted(ids) if bool(i % 7) == keep)
        assert got[node] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_missing_ids(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "a")]) == []


def test_other_columns_and_clashing_names(spark):
    names = ["at", "n", "root", "block", "token", "words", "conv", "place", "_tie"]
    rows = [(c, t, "user", "x", *["z"] * len(names)) for c in range(3) for t in range(2)]
    got = run(spark, rows, SCHEMA + "".join(f", {n} string" for n in names))
    assert got == trie_by_hand(rebuilt_by_hand([r[:4] for r in rows]))
