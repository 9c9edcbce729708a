"""Token counts of every prefix of a text under a byte-level BPE, by dynamic programming.

Within a piece of the pre-tokenizer, the encoding of a prefix ends with the one vocabulary entry that may follow the
encoding of what is before it; two entries may be neighbours when merging their bytes together leaves them apart. So
last entry and count of every prefix come from those of shorter prefixes. A text's prefixes are its units' prefixes
(a unit is a run of white space with what follows it), added up; a worker keeps the units it has seen.

The result is one signed 16-bit step per code point: the count of a prefix is the sum of the steps before its end.
Truncation and budget questions are answered from the steps, without encoding again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, free_name, text_of, worker_cache

_UNITS_KEPT = 200_000  # in each of two generations
_PAIRS_KEPT = 500_000
# white space as the pre-tokenizer sees it, and its units: contractions, or letters, digits, other characters
_GAP = r"\p{White_Space}"
_LEADING_GAP = regex.compile(rf"{_GAP}*")
_CONTRACTION = r"'(?:[sdmt]|ll|ve|re)"
_UNIT = regex.compile(
    rf"{_CONTRACTION}|{_GAP}*[^\P{{White_Space}} ]{_CONTRACTION}"
    rf"|{_GAP}*(?:\p{{L}}+|\p{{N}}+|[^{_GAP}\p{{L}}\p{{N}}]+)|{_GAP}+"
)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Counter:
    """The vocabulary of a tokenizer file and the units a worker has counted."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer is asked for")
        byte = byte_characters()
        self.token = {bytes(byte[c] for c in name): i for name, i in model["vocab"].items() if all(c in byte for c in name)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {tuple(bytes(byte[c] for c in part) for part in m): r for r, m in enumerate(merges)}
        # only entries that merging can make count
        made = {a + b for a, b in self.rank} | {bytes([b]) for b in range(256)}
        self.token = {t: i for t, i in self.token.items() if t in made and self.merged(t) == [t]}
        self.longest = max(map(len, self.token))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.previous: tuple[bytes, list[int], list[bytes]] = (b"", [0], [b""])

    def merged(self, raw: bytes) -> list[bytes]:
        """Merging by rank, leftmost first: the definition that neighbours are judged by."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def may_follow(self, a: bytes, b: bytes) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > _PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def prefixes(self, raw: bytes) -> list[int]:
        """The token count of every byte prefix of one pre-tokenizer piece; the dynamic program.

        It goes on from the prefix that the piece shares with the one before, which sorted units make long.
        """
        before, counts, last = self.previous
        shared = 0
        for a, b in zip(before, raw):
            if a != b:
                break
            shared += 1
        counts, last = counts[: shared + 1], last[: shared + 1]
        token, pairs, longest = self.token, self.pairs, self.longest
        for end in range(shared + 1, len(raw) + 1):
            for start in range(end - longest if end > longest else 0, end):
                piece = raw[start:end]
                if piece in token:
                    left = last[start]
                    if not start or (pairs[left, piece] if (left, piece) in pairs else self.may_follow(left, piece)):
                        counts.append(counts[start] + 1)
                        last.append(piece)
                        break
            else:
                raise ValueError("a byte has no token")
        self.previous = raw, counts, last
        return counts

    def _char_counts(self, text: str) -> list[int]:
        """The same by code points, with the empty prefix."""
        raw = text.encode("utf-8")
        counts = self.prefixes(raw)
        if len(raw) == len(text):
            return counts
        return [0] + [counts[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]

    def unit_steps(self, unit: str) -> bytes:
        known = self.units.get(unit)
        if known is None:
            counts = self.unit_counts(unit)
            known = self.units[unit] = array("h", [b - a for a, b in zip(counts, counts[1:])]).tobytes()
        return known

    def unit_counts(self, unit: str) -> list[int]:
        first = unit[0]
        if first != "'" and not (first.isspace() if first != " " else unit[1:2].isspace() or len(unit) == 1):
            return self._char_counts(unit)  # one piece, with at most one space in front
        start = _LEADING_GAP.match(unit).end()
        gap, core = unit[:start], unit[start:]
        inside = self._char_counts(gap) if gap else [0]
        if not core:
            return inside
        # a run of white space before something gives its last character away
        split = self._char_counts(gap[:-1])[-1] if len(gap) > 1 else 0
        if gap.endswith(" "):
            return inside + [split + c for c in self._char_counts(" " + core)[2:]]
        split += self._char_counts(gap[-1])[-1] if gap else 0
        if core[0] == "'" and len(core) > 1 and regex.fullmatch(_CONTRACTION, core):
            # cut short, the apostrophe stands alone
            alone = [1] + [1 + self._char_counts(core[1:k])[-1] for k in range(2, len(core))]
            return inside + [split + c for c in alone] + [split + self._char_counts(core)[-1]]
        return inside + [split + c for c in self._char_counts(core)[1:]]

    def batch_steps(self, texts: list[str]) -> list[np.ndarray]:
        """The steps of many texts; new units are counted in order, so that neighbours share their beginnings."""
        if len(self.units) > _UNITS_KEPT:
            self.older, self.units = self.units, {}
        older, known = self.older, self.units
        split = [None if self._has_special(t) else _UNIT.findall(t) for t in texts]
        for unit in sorted({u for units in split if units for u in units}.difference(known)):
            if unit in older:
                known[unit] = older[unit]
            else:
                self.unit_steps(unit)
        return [
            self.steps(t) if units is None else np.frombuffer(b"".join([known[u] for u in units]), "<i2")
            for t, units in zip(texts, split)
        ]

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def _plain(self, text: str) -> list[bytes]:
        known = self.units
        return [known.get(u) or self.unit_steps(u) for u in _UNIT.findall(text)]

    def steps(self, text: str) -> np.ndarray:
        """How the token count changes with each code point of the text."""
        if not self._has_special(text):
            return np.frombuffer(b"".join(self._plain(text)), "<i2")
        # an added token's string is one token; cut short, it is text that goes with what is before it
        out, at = [], 0
        for m in self.cut.finditer(text):
            before = text[at : m.start()]
            out += self._plain(before)
            units = _UNIT.findall(before)
            tail = units[-1] if units else ""
            base = self._total(tail)
            counts = [0] + [self._total(tail + m.group()[:k]) - base for k in range(1, len(m.group()))] + [1]
            out.append(np.diff(counts).astype("<i2").tobytes())
            at = m.end()
        out += self._plain(text[at:])
        return np.frombuffer(b"".join(out), "<i2")

    def _total(self, text: str) -> int:
        return int(np.frombuffer(b"".join(self._plain(text)), "<i2").sum()) if text else 0


def load(path: str) -> Counter:
    """The tokenizer of a path, loaded once in each worker."""
    cache, key = worker_cache(), f"Counter {path}"
    if key not in cache:
        cache[key] = Counter(path)
    return cache[key]


def counted(column: Column, path: str) -> Column:
    """``steps`` of every text as binary (little endian, 16 bits a code point) and ``n_tokens`` of all of it."""

    @F.pandas_udf("steps binary, n_tokens bigint")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = load(path)
        for batch in texts:
            steps = counter.batch_steps(batch.tolist())
            yield pd.DataFrame({"steps": [s.tobytes() for s in steps], "n_tokens": [int(s.sum(dtype=np.int64)) for s in steps]})

    return run(column)


def _counts(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, "<i2"), dtype=np.int64)


def tokens_in_prefix(steps: Column, chars: Column) -> Column:
    """The token count of the first ``chars`` code points (all, if the text has fewer)."""

    @F.pandas_udf("bigint")
    def run(stored: pd.Series, ends: pd.Series) -> pd.Series:
        out = [int(np.frombuffer(s, "<i2")[: max(0, int(e))].sum(dtype=np.int64)) for s, e in zip(stored, ends)]
        return pd.Series(out, dtype="int64")

    return run(steps, chars)


def longest_prefix(steps: Column, budget: Column) -> Column:
    """The most code points whose token count is within the budget; longer prefixes are all over it or equal texts."""

    @F.pandas_udf("bigint")
    def run(stored: pd.Series, limits: pd.Series) -> pd.Series:
        out = []
        for s, limit in zip(stored, limits):
            fits = np.flatnonzero(_counts(s) <= limit)
            out.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(out, dtype="int64")

    return run(steps, budget)


def with_prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """The documents with ``prefix_steps`` and the whole text's ``n_tokens``.

    ``path`` names a byte-level BPE file of the tokenizers library that every executor has; counts are those of the
    library without added begin and end tokens, and a special token's string in a text is that one token. NULL and
    empty texts have no tokens. Columns of those names are replaced, all others kept.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("prefix_steps", "n_tokens")
    name = free_name([*docs.columns, "prefix_steps", "n_tokens"], "counted")
    out = docs.withColumn(name, counted(text_of(), path))
    return out.withColumns({"prefix_steps": F.col(name)["steps"], "n_tokens": F.col(name)["n_tokens"]}).drop(name)
