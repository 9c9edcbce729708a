"""SentencePiece encoding and decoding by a batched numpy Viterbi over words of equal length.

The words of a batch that have the same number of characters form a matrix and advance together. At every end
position all piece lengths are tried at once: rolling hashes of the substrings probe the sorted hashes of the pieces,
each candidate is scored, and the vectorised maximum leaves a backpointer.

The model is a BPE model, for which the path with the highest sum of scores is not what the library returns. The score
of a step therefore is whether its piece may follow the best piece of the prefix: two pieces may be neighbours when
encoding them together yields them again. Exactly one step per position passes, so the maxima give the library's ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, text_of, worker_cache

_SPACE = "▁"
_BASE = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash
_WORDS_KEPT = 100_000  # in each of two generations
_CHARS_AT_ONCE = 1 << 18  # of words that advance together
_PAIRS_KEPT = 400_000
_MIX = 0xD6E8FEB86659FD93
_LEADING = np.uint64(44)
_PAIR_BITS = np.uint64(44)  # 2^20 slots for judged pairs
_CODE = 2_000_000  # above every id and code point


class Pieces:
    """A model's pieces, the sorted hashes of their strings, and the caches of a worker."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {names[i]: sp.get_score(i) for i in plain}
        self.id = {names[i]: i for i in plain}
        self.name = names
        self.byte_id = {int(names[i][3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.longest = max(len(names[i]) for i in plain)
        keys = np.array([self._hash(names[i]) for i in plain], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int64)[order]
        self.leading = np.zeros(1 << 20, bool)
        lead = self.keys >> _LEADING
        self.leading[lead] = True
        # where each leading part begins among the sorted hashes, and how many share one at most
        self.first = np.searchsorted(lead, np.arange(1 << 20, dtype=np.uint64)).astype(np.int32)
        self.crowd = int(np.unique(lead, return_counts=True)[1].max())
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.merging = merging = {c for p in self.rank if len(p) > 1 for c in p} - {_SPACE}
        inside = "".join(re.escape(c) for c in sorted(merging))
        # a piece has spaces only in front, and characters of no longer piece never merge
        self.word = re.compile(f"{_SPACE}+[{inside}]*|[{inside}]+|[^{_SPACE}{inside}]+")
        self.raw = [
            bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace(_SPACE, " ").encode() if n in self.rank else b""
            for i, n in enumerate(names)
        ]
        self.raw[self.unknown] = " ⁇ ".encode()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.judged: dict[int, bool] = {}
        self.codes = np.full(1 << (64 - int(_PAIR_BITS)), -1, np.int64)
        self.passes = np.zeros(len(self.codes), bool)

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for c in s:
            h = (h * _BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return (h ^ (len(s) << 58)) * _MIX & 0xFFFFFFFFFFFFFFFF

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging, best score first, leftmost of equals: the definition that pairs are judged by."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def string(self, token: int) -> str:
        return self.name[token] if token < self.size else chr(token - self.size)

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each right token may follow the left one: a table of judged pairs, a slot for each hash."""
        codes = left * _CODE + right
        slot = (codes.astype(np.uint64) * np.uint64(_BASE)) >> _PAIR_BITS
        missing = np.unique(codes[self.codes[slot] != codes])
        if not len(missing):
            return self.passes[slot]
        # new pairs, and those that another pair has driven out of its slot
        if len(self.judged) > _PAIRS_KEPT:
            self.judged.clear()
        passes = np.empty(len(missing), bool)
        for i, code in enumerate(missing.tolist()):
            known = self.judged.get(code)
            if known is None:
                x, y = self.string(code // _CODE), self.string(code % _CODE)
                known = self.judged[code] = self.merged(x + y) == [x, y]
            passes[i] = known
        out = self.passes[slot]
        wrong = np.flatnonzero(self.codes[slot] != codes)
        out[wrong] = passes[np.searchsorted(missing, codes[wrong])]
        slot = (missing.astype(np.uint64) * np.uint64(_BASE)) >> _PAIR_BITS
        # of new pairs with one slot the last is written, so code and verdict are written for the same one
        _, last = np.unique(slot[::-1], return_index=True)
        last = len(slot) - 1 - last
        self.codes[slot[last]], self.passes[slot[last]] = missing[last], passes[last]
        return out

    def piece_of(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are a piece's, and its place among the sorted ones: hashes of one leading part lie together."""
        lead = key >> _LEADING
        owner = np.flatnonzero(self.leading[lead])
        at = self.first[lead[owner]]
        hit = self.keys[at] == key[owner]
        for _ in range(self.crowd - 1):
            at = np.where(hit, at, np.minimum(at + 1, len(self.keys) - 1))
            hit = self.keys[at] == key[owner]
        return owner[hit], at[hit]

    def encode_equal(self, words: list[str]) -> list[bytes]:
        """The ids (int32, little endian) of words with one number of characters."""
        n, m = len(words[0]), len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(m, n).astype(np.uint64)
        base, hashes = np.uint64(_BASE), np.zeros((n + 1, m), np.uint64)
        for i in range(n):
            hashes[i + 1] = hashes[i] * base + points[:, i] + np.uint64(1)
        powers = [1]
        for _ in range(min(n, self.longest)):
            powers.append(powers[-1] * _BASE & 0xFFFFFFFFFFFFFFFF)
        last = np.full((n + 1, m), -1, np.int64)
        back = np.zeros((n + 1, m), np.int64)
        rows = np.arange(m)
        for end in range(1, n + 1):
            owners, tokens, lengths = [], [], []
            for length in range(1, min(end, self.longest) + 1):
                start = end - length
                key = (hashes[end] - hashes[start] * np.uint64(powers[length])) ^ np.uint64(length << 58)
                key = key * np.uint64(_MIX)  # short strings have small hashes; this spreads their leading bits
                owner, at = self.piece_of(key)
                piece = self.ids[at]
                if length == 1:
                    single = self.size + points[:, start].astype(np.int64)
                    single[owner] = piece
                    owner, piece = rows, single
                if len(owner):
                    owners.append(owner), tokens.append(piece), lengths.append(np.full(len(owner), length))
            owner, piece, length = (np.concatenate(x) for x in (owners, tokens, lengths))
            before = last[end - length, owner]
            inner = np.flatnonzero((length < end) & (before >= 0))
            fits = length == end
            fits[inner] = self.may_follow(before[inner], piece[inner])
            owner, piece, length = owner[fits], piece[fits], length[fits]
            # a step's score is its length where its piece may follow; lengths rise, so the maximum is written last
            np.maximum.at(back[end], owner, length)
            best = back[end][owner] == length
            last[end, owner[best]] = piece[best]
        if (back[n] == 0).any():
            raise ValueError("a word has no path")
        path = np.full((n, m), -1, np.int64)
        at, step = np.full(m, n), n - 1
        while True:
            live = np.flatnonzero(at > 0)
            if not len(live):
                break
            path[step, live] = last[at[live], live]
            at[live] -= back[at[live], live]
            step -= 1
        path = path.T
        taken = path >= 0
        flat = path[taken].astype("<i4").tobytes()
        ends = np.cumsum(taken.sum(axis=1)) * 4
        out = [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for r in np.flatnonzero((path >= self.size).any(axis=1)).tolist():
            out[r] = self._bytes(path[r][taken[r]].tolist())
        return out

    def _bytes(self, tokens: list[int]) -> bytes:
        ids: list[int] = []
        for t in tokens:
            if t < self.size:
                ids.append(t)
            elif self.byte_id:
                ids.extend(self.byte_id[b] for b in chr(t - self.size).encode())
            else:
                ids.append(self.unknown)
        return np.array(ids, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.word.findall(_SPACE + t.replace(" ", _SPACE)) if t else [] for t in texts]
        if len(self.words) > _WORDS_KEPT:
            self.older, self.words = self.words, {}
        new: dict[int, list[str]] = {}
        for w in {w for words in split for w in words}.difference(self.words):
            if w in self.older:
                self.words[w] = self.older[w]
            elif w[0] == _SPACE or w[0] in self.merging:
                new.setdefault(len(w), []).append(w)
            else:
                self.words[w] = self._bytes([self.id.get(c, self.size + ord(c)) for c in w])
        for group in new.values():
            step = max(1, min(4096, _CHARS_AT_ONCE // len(group[0])))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                self.words.update(zip(part, self.encode_equal(part)))
        known = self.words
        return [np.frombuffer(b"".join([known[w] for w in words]), "<i4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def load(path: str) -> Pieces:
    """The model of a path, loaded once in each worker."""
    cache, key = worker_cache(), f"Pieces {path}"
    if key not in cache:
        cache[key] = Pieces(path)
    return cache[key]


def encode_column(column: Column, path: str) -> Column:
    @F.pandas_udf("array<int>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = load(path)
        for batch in texts:
            yield pd.Series(pieces.encode(batch.tolist()))

    return run(column)


def decode_column(column: Column, path: str) -> Column:
    @F.pandas_udf("string")
    def run(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = load(path)
        for batch in ids:
            yield pd.Series([pieces.decode(np.asarray(x, np.int64)) for x in batch])

    return run(column)


def with_pieces(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """The documents with ``token_ids`` and ``n_tokens`` of the whole text, and with ``decoded`` the text of the ids.

    ``path`` names a BPE model file that every executor has. NULL and empty texts have no ids. Decoding gives the text
    back, except that the model writes U+2581 and the space alike, as the library does. Columns of those names are
    replaced, all others kept.
    """
    bounded_batches(docs.sparkSession)
    out = docs.drop("token_ids", "n_tokens", "decoded").withColumn("token_ids", encode_column(text_of(), path))
    if decoded:
        out = out.withColumn("decoded", decode_column(F.col("token_ids"), path))
    return out.withColumn("n_tokens", F.size("token_ids"))
