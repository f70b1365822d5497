"""BPE encoding and decoding by speculation and verification.

For every distinct word a greedy longest match proposes tokens. All adjacent pairs of all proposals are then tested at
once with numpy: a pair is compatible when no merge across its border would have been applied before the merges that
built its two tokens. A proposal of valid tokens whose pairs are all compatible is exactly what BPE gives; only the
words that fail go through exact merging. Words repeat, so each worker keeps a bounded cache of words it has met.

Normalisation and word splitting follow the tokenizer file. Texts of plain Latin characters take a fast path that gives
the same pieces; others are normalised and split by the tokenizers library itself, piece by piece.

Defined results: null text is empty; empty text gives no ids and the empty text back; strings of special tokens inside a
text become these tokens, as in the library's default; extra columns stay, those named like an output are replaced.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = np.iinfo(np.int64).max
#: Words and chunks of a generation; a worker keeps two, and what it meets again moves to the younger.
CACHE_WORDS = 300_000
#: Texts that are encoded together.
GROUP = 1_024
#: Keys of a trie node for the token that ends there, inside a word and at its end; characters have other keys.
INNER, FINAL = 0, 1
#: A chunk of ASCII letters often ends in one of these.
MARKS = frozenset(".,;:!?)")
#: Anything but these needs the library's own normaliser and splitter.
UNUSUAL = re.compile("[^\t\n\r -~¡-ɏ]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@contextlib.contextmanager
def no_collection() -> Iterator[None]:
    """For steps that make many strings and lists but no cycles: the collector's passes over them would find nothing."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class PairTable:
    """Ranks of pairs of ids: an open-addressed table that numpy looks up for many pairs at once."""

    BITS = 18

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.slots = np.full((1 << self.BITS) + 64, -1, np.int64)
        self.ranks = np.full(len(self.slots), NEVER, np.int64)
        keys = (a << 32) | b
        self.probes = 1
        for rank, (at, key) in enumerate(zip(self._home(keys).tolist(), keys.tolist(), strict=True)):
            probes = 1
            while self.slots[at] >= 0:
                at, probes = at + 1, probes + 1
            self.slots[at], self.ranks[at], self.probes = key, rank, max(self.probes, probes)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NEVER where there is none."""
        keys = (a << 32) | b
        at = self._home(keys)
        there = self.slots[at]
        out = np.where(there == keys, self.ranks[at], NEVER)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for step in range(1, self.probes):
            if not open_.size:
                break
            spot = at[open_] + step
            there = self.slots[spot]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[spot[hit]]
            open_ = open_[~hit & (there >= 0)]
        return out


class WordBpe:
    """Encoder and decoder of a word-level BPE file (with a word-end suffix) in the tokenizers format."""

    def __init__(self, path: str, speculate: bool = True):
        """speculate False: new words go to the library's own merging, which gives the same ids."""
        import regex
        from tokenizers import Tokenizer

        self.speculate = speculate

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(regex.escape(x) for x in self.added) + ")")
        # The file's splitting pattern; among the characters of the fast path these are its letters and numbers.
        letters, numbers = "a-zªµºß-öø-ɏ", "0-9²³¹¼-¾"
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for kind, those in ((r"\p{L}", letters), (r"\p{N}", numbers)):
            pattern = pattern.replace(f"[{kind}]", f"[{those}]").replace(kind, those)
        self.latin = re.compile(pattern)
        self.library = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.library.model)
        self.to_chars = dict(enumerate(byte_characters()))
        size = max(max(self.vocab.values()), *self.added.values()) + 1
        self.names = [b""] * size
        for word, i in [*self.vocab.items(), *self.added.items()]:
            self.names[i] = word.encode()
        self.final = np.zeros(size, bool)
        self.final[[i for word, i in self.vocab.items() if self.end and word.endswith(self.end)]] = True
        # rank: when a token is built; base symbols before all merges. left, right: what it is built of.
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.made = np.empty(len(model["merges"]), np.int64)
        pairs = np.empty((len(model["merges"]), 2), np.int64)
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            pairs[r] = a, b
            self.made[r] = made
            self.rank[made], self.left[made], self.right[made] = r, a, b
        self.size = size
        self.pairs = PairTable(pairs[:, 0], pairs[:, 1])
        if speculate:
            self._offer()
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def _offer(self) -> None:
        """Only tokens that BPE gives for their own text may be proposed."""
        built = np.flatnonzero(self.rank >= 0)
        good = np.ones(self.size, bool)
        good[built] = self.compatible(self.left[built], self.right[built], self.rank[built])
        for i in built[np.argsort(self.rank[built])].tolist():
            good[i] &= good[self.left[i]] and good[self.right[i]]
        self.trie: dict = {}
        for word, i in self.vocab.items():
            if good[i] and word not in self.added:
                ends = bool(self.end) and word.endswith(self.end)
                node = self.trie
                for c in word[: -len(self.end)] if ends else word:
                    node = node.setdefault(c, {})
                node[FINAL if ends else INNER] = i

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves the border between tokens a and b alone; before: ranks from which merges don't count.

        It undoes the merges on both sides of the border, the latest first, and looks at each step for a merge across
        the border that would have come earlier. Of equal merges the one further left comes first.
        """
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.copy(), b.copy()
        until = np.full(len(a), NEVER) if before is None else before.copy()
        while live.size:
            crossed = self.pairs.get(a, b) < until
            ok[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            stay = ~crossed & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[stay], a[stay], b[stay], ra[stay], rb[stay]
            undo_a = ra > rb
            until = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over the characters that stand for bytes."""
        out, at, n, trie = [], 0, len(word), self.trie
        while at < n:
            node, k, found, to = trie, at, None, at
            while k < n:
                node = node.get(word[k])
                if node is None:
                    break
                k += 1
                if INNER in node and k < n:
                    found, to = node[INNER], k
            if k == n and node is not None and FINAL in node:
                out.append(node[FINAL])
                return out
            if found is None:
                return None
            out.append(found)
            at = to
        return None

    def merge(self, words: list[str]) -> list[bytes]:
        """Exact merging of all words together: in each round the earliest merge of each word, of equal ones the
        leftmost."""
        base = [[self.vocab[c] for c in w[:-1]] + [self.vocab[w[-1] + self.end]] for w in words]
        out: list[bytes] = [b""] * len(words)
        ids = np.array([i for b in base for i in b], np.int64)
        owner = np.repeat(np.arange(len(words)), [len(b) for b in base])
        rank = np.full(len(ids), NEVER, np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.pairs.get(ids[inside], ids[inside + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(ids)])
            if (least == NEVER).any():
                going = np.repeat(least != NEVER, sizes)
                done = owner[first[least == NEVER]].tolist()
                for k, x in zip(done, self._slices(ids[~going].astype("<u4"), np.cumsum(sizes[least == NEVER])), strict=True):
                    out[k] = x
                ids, owner, rank = ids[going], owner[going], rank[going]
                sizes, least = sizes[least != NEVER], least[least != NEVER]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            at = place[at]
            for left in (at, at[at > 0] - 1):
                rank[left] = NEVER
                left = left[left + 1 < len(ids)]
                left = left[owner[left] == owner[left + 1]]
                rank[left] = self.pairs.get(ids[left], ids[left + 1])
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian unsigned 32-bit; words are in the characters that stand for bytes."""
        if not self.speculate:
            # The fast form gives neither offsets nor the tokens' words; the last token of a word carries the suffix.
            found = self.plain.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) != len(words):
                found = self.plain.encode(words, is_pretokenized=True, add_special_tokens=False)
                ids, owner = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
                ends = np.searchsorted(owner, np.arange(len(words)), "right")
            return self._slices(ids, ends)
        proposed = [self.propose(w) or () for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter(itertools.chain.from_iterable(proposed), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        same = owner[1:] == owner[:-1]
        wrong = ~self.compatible(flat[:-1][same], flat[1:][same])
        failed = sizes == 0
        failed[owner[1:][same][wrong]] = True
        self.failed = int(failed.sum())
        order = np.flatnonzero(failed)
        good = self._slices(flat[~failed[owner]].astype("<u4"), np.cumsum(np.where(failed, 0, sizes)))
        for k, ids in zip(order.tolist(), self.merge([words[k] for k in order.tolist()]), strict=True):
            good[k] = ids
        return good

    @staticmethod
    def _slices(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, chunks: set[str]) -> None:
        """Encodes the chunks (lower case, without white space) that aren't cached."""
        if len(self.chunks) > CACHE_WORDS:
            self.old_chunks, self.chunks = self.chunks, {}
        if len(self.words) > CACHE_WORDS:
            self.old_words, self.words = self.words, {}
        known, older, words, old_words, find = self.chunks, self.old_chunks, self.words, self.old_words, self.latin.findall
        unknown = chunks.difference(known)
        again = unknown.intersection(older)
        known.update(zip(again, map(older.__getitem__, again), strict=True))
        unknown -= again
        # Letters alone are one word.
        simple = [c for c in unknown if c.isascii() and c.isalpha()]
        unknown.difference_update(simple)
        split = {}
        for c in unknown:
            if not c.isascii():
                split[c] = [w.encode().decode("latin-1").translate(self.to_chars) for w in find(c)]
            elif c[-1] in MARKS and c[:-1].isalpha():  # letters and one mark are two words
                split[c] = [c[:-1], c[-1]]
            else:
                split[c] = find(c)
        wanted = set(simple).union(*split.values()).difference(words)
        again = wanted.intersection(old_words)
        words.update(zip(again, map(old_words.__getitem__, again), strict=True))
        wanted -= again
        new = list(wanted)
        words.update(zip(new, self.encode_words(new), strict=True))
        known.update(zip(simple, map(words.__getitem__, simple), strict=True))
        for c, ws in split.items():
            known[c] = words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])

    def _unusual(self, text: str) -> list[str]:
        shown = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(shown)]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        for k in range(0, len(texts), GROUP):
            with no_collection():
                encoded = self._group(texts[k : k + GROUP])
            yield from encoded

    def _group(self, texts: list[str | None]) -> list[bytes]:
        plain: list[list] = []
        for text in texts:
            text = text or ""
            parts = self.special.split(text) if any(s in text for s in self.added) else [text]
            plain.append(
                [
                    self.added[p] if j % 2 else (self._unusual(p), None) if UNUSUAL.search(p) else p.lower().split()
                    for j, p in enumerate(parts)
                ]
            )
        self._learn(set().union(*(p for parts in plain for p in parts if isinstance(p, list))))
        rare = list({w for parts in plain for p in parts if isinstance(p, tuple) for w in p[0]})
        rare_ids = dict(zip(rare, self.encode_words(rare), strict=True)) if rare else {}
        got = self.chunks.__getitem__
        return [
            b"".join(
                [
                    b"".join(map(got, p)) if isinstance(p, list)
                    else b"".join([rare_ids[w] for w in p[0]]) if isinstance(p, tuple)
                    else p.to_bytes(4, "little")
                    for p in parts
                ]
            )
            for parts in plain
        ]

    def decode(self, ids: bytes) -> bytes:
        """The tokens' own strings with one space between them (the file names no decoder), in UTF-8."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str, speculate: bool = True) -> WordBpe:
    return WordBpe(path, speculate)


def with_column(batch: pa.RecordBatch, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in arrays]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *arrays.values()], [*names, *arrays])


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with ids_col binary: the ids as little-endian unsigned 32-bit integers. The file at path must be readable on
    every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids = list(bpe.encode(batch.column(text_col).to_pylist()))
            yield with_column(batch, {ids_col: pa.array(ids, pa.binary())})

    kept = [c for c in docs.columns if c != ids_col]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("binary").alias(ids_col)).schema
    return docs.mapInArrow(run, schema)


def bpe_decode(docs: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """docs with decoded_col: the text of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [bpe.decode(x or b"").decode() for x in batch.column(ids_col).to_pylist()]
            yield with_column(batch, {decoded_col: pa.array(texts, pa.string())})

    kept = [c for c in docs.columns if c != decoded_col]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("string").alias(decoded_col)).schema
    return docs.mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes, then decodes the ids: id, n_tokens, ids_sha256 and decoded_sha256 without sending ids or texts back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            sizes, ids_sha, text_sha = [], [], []
            for ids in bpe.encode(batch.column("text").to_pylist()):
                sizes.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
