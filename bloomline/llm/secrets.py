"""Secret scans by grammar inference.

Three patterns find the plain secrets. What they find, each different value once, are the labelled credentials: for each kind, the
values with the smallest hashes are read into a prefix tree whose states are merged where their counts don't differ significantly
(Hoeffding bounds on the share that stops, on the share of each next character and on the spread of the remaining length, also for
all states that follow), in red-blue order, which gives a probabilistic automaton for each kind. Every candidate of every text (a whole
run of SHORTEST or more of the characters that credentials are made of) is scored by its likelihood under each automaton against its
likelihood under pairs of characters of ordinary candidates. Those from the kind's level on become spans of kind `format`, unless they
touch a plain span. The level is what left-out credentials reach (all but LOST of them), but at least RARE, by which an ordinary
candidate is likelier beforehand. Credentials that no pattern finds lie among the sampled ordinary candidates; those that reach RARE
are taken out of them, in CLEANINGS rounds.

Defined cases. A null text is empty and has no spans; rows with equal or null ids are scanned on their own. Where a pattern finds
nothing, its kind has no automaton; with none at all only plain spans are given. Offsets are code points, ends exclusive. Columns of
the input stay, but for one named like the output. Letters of the first pattern's words are A-Z in either case, nothing else folds
to them. Bounds of the fit: SAMPLES values, those with the smallest hashes of the whole corpus, of at most LONGEST characters, so it is
of one size at any number of rows. The scan has no bounds.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bloomline.llm.common import stored, without

#: Fixed patterns; a match is as long as it can be, so least lengths can stand inside the second and third.
PATTERNS = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]{16,}"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
SHORTEST_ASSIGNED = 6
#: Kinds in the order in which spans of one start are listed.
KINDS = (*PATTERNS, "format")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CODE = np.full(128, -1, np.int8)
CODE[[ord(c) for c in LETTERS]] = range(len(LETTERS))

ORDINARY = "ordinary"
#: Different values that the fit sees of each kind.
SAMPLES = {"assign": 1_000, "access": 1_000, "hex": 1_000, ORDINARY: 20_000}
SHORTEST, LONGEST = 12, 256
#: Chance of keeping states apart that are alike; share of left-out credentials that may be lost; least log-odds of a finding.
ALPHA, LOST, RARE = 0.01, 0.02, math.log(1e6)
#: Rounds in which unlabelled credentials are taken out of the ordinary candidates.
CLEANINGS = 4


# Plain spans and candidates


def plain_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the three patterns, kind by kind."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            if kind != "assign" or len(m.group(1)) >= SHORTEST_ASSIGNED:
                out.append((m.start(), kind, m.end()))
    return out


def labelled_values(text: str) -> Iterator[tuple[str, str]]:
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            value = m.group(m.lastindex or 0)
            if SHORTEST_ASSIGNED <= len(value) <= LONGEST:
                yield kind, value


def candidates(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of a text as codes (-1: not of a credential) and starts and ends of the runs that are long enough."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(points < 128, CODE[np.minimum(points, 127)], -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= SHORTEST
    return codes, starts[long_enough], ends[long_enough]


# The automaton


class State:
    """Counts of the values that come by: how many stop, which character each goes on with, and how many characters were left."""

    __slots__ = ("arcs", "left", "next", "seen", "stops")

    def __init__(self):
        self.seen, self.stops = 0, 0
        self.next: dict[str, State] = {}
        self.arcs: Counter[str] = Counter()
        self.left: Counter[int] = Counter()


def prefix_tree(values: list[str]) -> State:
    root = State()
    for value in values:
        state = root
        for place in range(len(value) + 1):
            state.seen += 1
            state.left[len(value) - place] += 1
            if place == len(value):
                state.stops += 1
            else:
                state.arcs[value[place]] += 1
                state = state.next.setdefault(value[place], State())
    return root


def alike(a: State, b: State) -> bool:
    """Whether counts of both states can come from one: no share differs by more than its Hoeffding bound."""
    bound = math.sqrt(math.log(2 / ALPHA) / 2) * (1 / math.sqrt(a.seen) + 1 / math.sqrt(b.seen))
    if bound >= 1:
        return True
    if abs(a.stops / a.seen - b.stops / b.seen) > bound:
        return False
    if any(abs(a.arcs[c] / a.seen - b.arcs[c] / b.seen) > bound for c in a.arcs.keys() | b.arcs.keys()):
        return False
    apart = 0.0
    for rest in sorted(a.left.keys() | b.left.keys()):
        apart += a.left[rest] / a.seen - b.left[rest] / b.seen
        if abs(apart) > bound:
            return False
    return True


def compatible(a: State, b: State) -> bool:
    """alike(), and so are all states that both lead to by the same characters; what follows b is a tree."""
    pairs = [(a, b)]
    while pairs:
        x, y = pairs.pop()
        if not alike(x, y):
            return False
        pairs += [(x.next[c], y.next[c]) for c in y.next if c in x.next]
    return True


def merge(into: State, other: State) -> None:
    """Adds other and the tree that follows it to into, state by state."""
    pairs = [(into, other)]
    while pairs:
        x, y = pairs.pop()
        x.seen, x.stops = x.seen + y.seen, x.stops + y.stops
        x.arcs.update(y.arcs)
        x.left.update(y.left)
        for c, after in y.next.items():
            if c in x.next:
                pairs.append((x.next[c], after))
            else:
                x.next[c] = after


@dataclass
class Automaton:
    """step[state, code] is the next state; odds[state, code] and stop[state] are log probabilities. State 0 begins."""

    step: np.ndarray
    odds: np.ndarray
    stop: np.ndarray

    def score(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log likelihoods of the runs of codes, all at a time, place by place."""
        state, total = np.zeros(len(starts), np.int64), np.zeros(len(starts))
        on = np.arange(len(starts))
        for place in range(int((ends - starts).max(initial=0))):
            on = on[starts[on] + place < ends[on]]
            c = codes[starts[on] + place]
            total[on] += self.odds[state[on], c]
            state[on] = self.step[state[on], c]
        return total + self.stop[state]


def infer(values: list[str]) -> Automaton:
    """Red-blue merging of the prefix tree. Red states differ from each other; a blue one (next to a red) is merged into the first red
    one it is compatible with, or becomes red. Merging may hang new blue states onto reds that were passed, so all are seen again."""
    red = [prefix_tree(values)]
    while blues := [(s, c) for s in red for c in sorted(s.next) if s.next[c] not in red]:
        state, c = max(blues, key=lambda at: (at[0].next[at[1]].seen, at[1]))
        blue = state.next[c]
        same = next((r for r in red if compatible(r, blue)), None)
        if same is None:
            red.append(blue)
        else:
            state.next[c] = same
            merge(same, blue)
    return tables(red)


def tables(states: list[State]) -> Automaton:
    """Smoothed by a hundredth of a count for each character, so that none is impossible."""
    places = {id(s): k for k, s in enumerate(states)}
    counts = np.array([[s.arcs[c] for c in LETTERS] + [s.stops] for s in states]) + 0.01
    odds = np.log(counts / counts.sum(1, keepdims=True))
    step = np.array([[places[id(s.next[c])] if c in s.next else k for c in LETTERS] for k, s in enumerate(states)])
    return Automaton(step, odds[:, :-1], odds[:, -1])


def of_pairs(values: list[str]) -> Automaton:
    """The automaton of ordinary candidates: its state is the character before. A whole count is added to each pair, so that a rare value
    does not vouch for itself."""
    counts = np.ones((len(LETTERS) + 1, len(LETTERS) + 1))
    for value in values:
        places = [CODE[ord(c)] + 1 for c in value]
        np.add.at(counts, ([0, *places], [*(p - 1 for p in places), len(LETTERS)]), 1)
    odds = np.log(counts / counts.sum(1, keepdims=True))
    return Automaton(np.tile(np.arange(1, len(LETTERS) + 1), (len(LETTERS) + 1, 1)), odds[:, :-1], odds[:, -1])


# Fit and scan


@dataclass
class Formats:
    """Automata by kind, each with the log-odds from which a candidate counts, and the model of ordinary candidates."""

    kinds: dict[str, tuple[Automaton, float]]
    ordinary: Automaton | None = None

    def found(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        good = np.zeros(len(starts), bool)
        if self.kinds and len(starts):
            plain = self.ordinary.score(codes, starts, ends)
            for automaton, level in self.kinds.values():
                good |= automaton.score(codes, starts, ends) - plain >= level
        return good


class Smallest:
    """The different values with the smallest hashes seen so far, by kind."""

    def __init__(self):
        self.values = {kind: {} for kind in (*PATTERNS, ORDINARY)}
        self.bound = dict.fromkeys(self.values, 2**64)

    def add(self, kind: str, value: str) -> None:
        h = xxhash.xxh64_intdigest(value)
        if h >= self.bound[kind]:
            return
        held = self.values[kind]
        held[h] = value
        if len(held) >= 2 * SAMPLES[kind]:
            self.values[kind] = dict(heapq.nsmallest(SAMPLES[kind], held.items()))
            self.bound[kind] = max(self.values[kind])

    def rows(self) -> list[dict]:
        return [
            {"kind": kind, "hash": h - 2**63, "value": v}
            for kind, held in self.values.items()
            for h, v in heapq.nsmallest(SAMPLES[kind], held.items())
        ]


def samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """kind, hash, value: for each kind of labelled credentials, and for ordinary candidates, the different values with the smallest
    hashes of the corpus."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest = Smallest()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                for kind, value in labelled_values(body):
                    smallest.add(kind, value)
                _, starts, ends = candidates(body)
                for s, e in apart(body, starts, ends):
                    if e - s <= LONGEST:
                        smallest.add(ORDINARY, body[s:e])
        yield pa.RecordBatch.from_pylist(smallest.rows(), schema=to_arrow_schema(schema))

    schema = T.StructType.fromDDL("kind string, hash bigint, value string")
    rows = stored(docs.select(F.coalesce(text, F.lit("")).alias("text")).mapInArrow(gather, schema).distinct(), "secrets-samples")
    parts = [rows.where(F.col("kind") == kind).orderBy("hash").limit(n) for kind, n in SAMPLES.items()]
    return reduce(DataFrame.unionByName, parts)


def apart(text: str, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The runs that no plain span touches."""
    plain = plain_spans(text)
    return [(s, e) for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if not any(a < e and s < b for a, _, b in plain)]


def fit(sampled: DataFrame) -> Formats:
    """Automata from rows (kind, hash, value) as samples() gives them; a quarter of each kind is left out to find its level."""
    values: dict[str, list[str]] = {}
    for row in sampled.orderBy("kind", "hash").collect():
        values.setdefault(row.kind, []).append(row.value)
    plain = values.pop(ORDINARY, [])
    left_out = {kind: found[::4] if len(found) >= 8 else found for kind, found in values.items()}
    automata = {kind: infer([v for k, v in enumerate(found) if k % 4] if len(found) >= 8 else found) for kind, found in values.items()}

    def runs(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(v) for v in some], dtype=np.int64)
        return CODE[np.frombuffer("".join(some).encode(), np.uint8)], ends - np.array([len(v) for v in some], np.int64), ends

    for _ in range(CLEANINGS):
        formats = Formats({kind: (automaton, RARE) for kind, automaton in automata.items()}, of_pairs(plain))
        plain = [v for v, found in zip(plain, formats.found(*runs(plain)), strict=True) if not found]
    for kind, automaton in automata.items():
        odds = automaton.score(*runs(left_out[kind])) - formats.ordinary.score(*runs(left_out[kind]))
        formats.kinds[kind] = (automaton, max(float(np.quantile(odds, LOST)), RARE))
    return formats


def scan(docs: DataFrame, formats: Formats, text: str = "text") -> DataFrame:
    """docs with spans: array of (kind, start, end) by start, then kind as in KINDS."""
    docs = without(docs, ["spans"])
    span = "array<struct<kind: string, start: int, end: int>>"
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", T.StructType.fromDDL(f"s {span}")["s"].dataType)])
    arrow = to_arrow_schema(schema).field("spans").type

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            runs = [candidates(t) for t in texts]
            ends = np.cumsum([0, *(len(c) for c, _, _ in runs)])
            codes = np.concatenate([np.zeros(0, np.int8), *(c for c, _, _ in runs)])
            starts, stops = (
                np.concatenate([np.zeros(0, np.int64), *(r[k] + shift for r, shift in zip(runs, ends, strict=False))]) for k in (1, 2)
            )
            good, at, out = formats.found(codes, starts, stops), 0, []
            for body, (_, s, e) in zip(texts, runs, strict=True):
                these = good[at : at + len(s)]
                at += len(s)
                found = plain_spans(body)
                if these.any():
                    found += [(a, "format", b) for a, b in apart(body, s[these], e[these])]
                found.sort(key=lambda f: (f[0], KINDS.index(f[1])))
                out.append([{"kind": k, "start": a, "end": b} for a, k, b in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow)], [*batch.schema.names, "spans"])

    return docs.mapInArrow(find, schema)
