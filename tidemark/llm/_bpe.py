"""A byte-level BPE vocabulary file inside tasks: words, exact merging, speculation with pair checks."""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import regex

from tidemark.llm._common import worker_cache

#: Fixed value: the split pattern of byte-level tokenizers with ``use_regex``.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: texts below this character take the quicker engine
PLAIN_END = "\u3000"
#: words kept between texts of a worker; beyond it the table starts anew, which changes no result
KEPT_WORDS = 700_000
#: texts beyond so many characters are split step by step
LONG_TEXT = 1_000_000
STEP_WORDS = 100_000
#: a rank beyond all merges, and beyond the time at which any tree consumes a token
NEVER = np.int64(1) << 40


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


def byte_letters() -> list[str]:
    """The printable letter of each byte in vocabulary files: printable Latin-1 stays, the rest moves to 256 and up."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(printable))}
    return [moved.get(b, chr(b)) for b in range(256)]


@functools.cache
def _plain_split() -> re.Pattern:
    """The same pattern for texts below ``PLAIN_END``, its properties written out as ranges: the quicker engine takes those."""

    def ranges(pattern: str) -> str:
        hits = [bool(regex.fullmatch(pattern, chr(c))) for c in range(ord(PLAIN_END))]
        edges = [c for c in range(len(hits) + 1) if (c < len(hits) and hits[c]) != (c > 0 and hits[c - 1])]
        return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2]))

    letters, numbers, spaces = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


class Vocabulary:
    """Tokens, merges and special strings of a tokenizers file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path}: only plain byte-level BPE files are read")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special strings that take white space are not read")
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        as_bytes = lambda word: bytes(byte_of[c] for c in word)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.specials.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for word, k in model["vocab"].items():
            self.tokens[k] = self.specials.get(word) is None and as_bytes(word) or word.encode()
        for word, k in self.specials.items():
            self.tokens[k] = word.encode()
        self.names = [str(k) for k in range(size)]
        self.byte_ids = np.array([model["vocab"][letter] for letter in byte_letters()], np.int64)
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.size = size
        key = self.left * size + self.right
        self.order = np.argsort(key)
        self.sorted_key = key[self.order]
        special = "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        self.special = regex.compile(f"({special})") if special else None
        self.split, self.plain_split = regex.compile(SPLIT), _plain_split()
        self.words = _Words()

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens in lists of bounded length; special strings stand alone."""
        parts = self.special.split(text) if self.special and any(s in text for s in self.specials) else [text]
        for part in parts:
            if part in self.specials:
                yield [part]
                continue
            split = self.plain_split if part.isascii() or max(part) < PLAIN_END else self.split
            if len(part) <= LONG_TEXT:
                yield split.findall(part)
            else:
                found = (m.group() for m in split.finditer(part))
                while step := list(islice(found, STEP_WORDS)):
                    yield step

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``NEVER`` where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.sorted_key, key), len(self.sorted_key) - 1)
        return np.where(self.sorted_key[at] == key, self.order[at], NEVER)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Exact encoding: in every word at once the merge of lowest rank, the leftmost of equals, until none is left."""
        done = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        #: rank of the pair that begins at each place
        rank = np.full(len(ids), NEVER)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, first)
            over = low == NEVER
            if over.any():
                ends = np.r_[first[1:], len(ids)]
                for k, b, e in zip(word[first[over]].tolist(), first[over].tolist(), ends[over].tolist()):
                    done[k] = ids[b:e].astype("<u4").tobytes()
                stay = np.repeat(~over, ends - first)
                ids, word, rank = ids[stay], word[stay], rank[stay]
                continue
            hits = np.flatnonzero(rank == np.repeat(low, np.diff(np.r_[first, len(ids)])))
            hits = hits[np.r_[True, word[hits[1:]] != word[hits[:-1]]]]
            ids[hits] = self.made[low]
            stay = np.ones(len(ids), bool)
            stay[hits + 1] = False
            hits -= np.arange(len(hits))
            ids, word, rank = ids[stay], word[stay], rank[stay]
            rank[hits] = NEVER
            for at in (hits[(hits > 0)] - 1, hits[hits + 1 < len(ids)]):
                at = at[word[at] == word[at + 1]]
                rank[at] = self.rank(ids[at], ids[at + 1])
        return done

    def encode(self, texts: Iterable[str], encode, kept: int = KEPT_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts laid end to end, and where each begins (with the end of the last).

        Every pre-token gets a number once; ``encode`` takes the new ones of all texts together.
        """
        if len(self.words) > kept:
            self.words = _Words()
        parts, counts = [np.zeros(0, np.int32)], [0]
        for text in texts:
            counts.append(counts[-1])
            for words in self.pieces(text):
                parts.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
                counts[-1] += len(words)
        self.words.learn(lambda new: encode([w for w in new if w not in self.specials]), self.specials)
        return self.words.ids(np.concatenate(parts), np.array(counts))


class _Words(dict):
    """Numbers of pre-tokens in order of appearance, and their ids in one array."""

    def __init__(self):
        self.new: list[str] = []
        self.begins, self.sizes, self.store = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def learn(self, encode, specials: dict[str, int]) -> None:
        found = iter(encode(self.new))
        raw = [packed([specials[w]]) if w in specials else next(found) for w in self.new]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        self.begins = np.concatenate([self.begins, len(self.store) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.store = np.concatenate([self.store, np.frombuffer(b"".join(raw), "<u4")])
        self.new = []

    def ids(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - self.begins[numbers], sizes)
        return self.store[places], np.concatenate([[0], ends])[counts]


class Speculation:
    """Greedy longest match, then a check of all adjacent pairs at once; only failing words are merged exactly.

    A merge across the border of tokens ``a`` and ``b`` joins a token of the right edge of ``a``'s merge tree with one
    of the left edge of ``b``'s.  It happens if both are alive at its rank: the left one must be consumed later by its
    own tree, the right one not earlier (of equal pairs the leftmost merges first).  Ranks only grow while a word is
    merged, so if no such merge exists at any border, the proposed tokens are the exact encoding.  Tokens that their
    own merges don't produce are never proposed.
    """

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        rank_of = np.full(v.size, -1, np.int64)
        rank_of[v.made] = np.arange(len(v.made))
        self.right_edge, self.right_until = self._edge(v.right, rank_of)
        self.left_edge, self.left_until = self._edge(v.left, rank_of)
        own = np.arange(len(v.made))
        good = self.compatible(v.left, v.right, own)
        sound = np.ones(v.size, bool)
        for rank, (a, b, c) in enumerate(zip(v.left.tolist(), v.right.tolist(), v.made.tolist())):
            sound[c] = good[rank] and sound[a] and sound[b]
        known = set(v.byte_ids.tolist()) | set(v.made.tolist())
        self.proposals = {v.tokens[k]: k for k in known if sound[k]}
        #: a proposal's id by its bytes, -1 for the beginnings of longer ones
        self.beginnings = {t[:k]: -1 for t in self.proposals for k in range(1, len(t))} | self.proposals

    def _edge(self, child: np.ndarray, rank_of: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tokens along one edge of every merge tree, and the rank at which the tree consumes each."""
        now = np.arange(self.vocabulary.size)
        until = np.full(len(now), NEVER)
        edge, ends = [], []
        while (now >= 0).any():
            edge.append(now)
            ends.append(until)
            rank = np.where(now >= 0, rank_of[now], -1)
            now, until = np.where(rank >= 0, child[rank], -1), rank
        return edge, ends

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For pairs of tokens: no merge happens across the border (below ``limit``, if given)."""
        fine = np.ones(len(a), bool)
        for i, (edge_a, until_a) in enumerate(zip(self.right_edge, self.right_until)):
            rows = np.flatnonzero(fine & (edge_a[a] >= 0))
            if not len(rows):
                break
            for j, (edge_b, until_b) in enumerate(zip(self.left_edge, self.left_until)):
                rows = rows[edge_b[b[rows]] >= 0]
                if not len(rows):
                    break
                rank = self.vocabulary.rank(edge_a[a[rows]], edge_b[b[rows]])
                end_a, end_b = until_a[a[rows]], until_b[b[rows]]
                if limit is not None:
                    end_a = limit[rows] if i == 0 else end_a
                    end_b = limit[rows] - 1 if j == 0 else end_b
                clash = (rank < end_a) & (rank <= end_b)
                fine[rows[clash]] = False
                rows = rows[~clash]
        return fine

    def propose(self, word: bytes) -> list[int]:
        out, at, end = [], 0, len(word)
        known = self.beginnings.get
        while at < end:
            stop = at + 1
            while stop <= end and (token := known(word[at:stop])) is not None:
                if token >= 0:
                    longest, size = token, stop
                stop += 1
            out.append(longest)
            at = size
        return out

    def __call__(self, words: list[str]) -> list[bytes]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        found = [self.propose(w) for w in raw]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        word_of = np.repeat(np.arange(len(found)), sizes)
        inner = np.flatnonzero(word_of[1:] == word_of[:-1])
        pairs, back = np.unique(flat[inner] * self.vocabulary.size + flat[inner + 1], return_inverse=True)
        fine = self.compatible(pairs // self.vocabulary.size, pairs % self.vocabulary.size)[back]
        failing = np.unique(word_of[inner[~fine]]).tolist()
        out = list(map(packed, found))
        for k, ids in zip(failing, self.vocabulary.merged([raw[k] for k in failing])):
            out[k] = ids
        return out


@worker_cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


@worker_cache
def speculation(path: str) -> Speculation:
    return Speculation(vocabulary(path))


@worker_cache
def library(path: str):
    """The tokenizers library for one file, as a function from words to ids."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True

    def encode(words: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    return encode
