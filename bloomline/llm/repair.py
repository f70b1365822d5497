"""Conversation structure repair by dynamic programming over a grammar.

Every row of a conversation becomes one character for its role and its fault. Re-Pair over the different strings of the whole
table (Spark counts adjacent pairs, native replacements write the most frequent ones as one new character, in rounds) gives a
grammar; each rule has one min-plus transfer matrix over the four places of the wanted form `(s?(ua)+)?`, evaluated bottom-up from
its two parts, with the audit as a rope: an entry says only through which place the two parts' ropes meet. A string of the table
is solved once, for all conversations that have it. Strings are cut into stretches of STRETCH rows, so a conversation of any
length is a short product of matrices.

Audits of equal cost are compared without being written out: insertions stand right before a kept or re-roled row, so audits of the
same rows never continue each other, and the order of an entry's audit among those from the same place follows from the ranks of
its parts.

Defined cases. Null role or text is one space. Rows go by turn (null first), then role, then text; a repeated row lies beside its
original. A null conversation id is a conversation of its own. A role counts by its first character; one that starts with
none of s, u, a (also an empty role) has to be re-roled or deleted. Conversations without rows keep a header row. Columns beside
the four named ones are left out. A conversation's rows come to one task in order, as a stream that is never held: what is kept of
it there is one letter a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from bloomline.llm.common import stored

#: Rows of a conversation that are solved as one string.
STRETCH = 512
#: Rounds of Re-Pair, new rules in a round; a bound on how much is shared, not on what is solved.
ROUNDS, RULES = 6, 24
#: Rows of a batch that a stream gives out.
OUT_ROWS = 500
BLANKS = " \t\n\x0b\x0c\r"
ROLES = ("user", "assistant")
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5

#: Characters of the strings: one for each role initial and fault, and from FIRST_RULE on the rules.
INITIALS = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
FIRST_RULE = 0x4E00

#: Places in the wanted form: nothing yet, after s, after u, after a. Which place user/assistant leads to, and which may end.
PLACES = range(4)
NEXT = (2, 2, 3, 2)
CLOSING = ("", "II", "I", "")


def symbol(initial: int, fault: int) -> str:
    """The character of initial (0 to 2: s, u, a; 3: none of them) and fault (place in FAULTS)."""
    return chr(ord("A") + 4 * initial + fault)


# Marking


def marked(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, dropped) with their place, fault, character and what the counts need."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("dropped") if "dropped" in turns.columns else F.lit(False).alias("dropped"),
    )
    whole = F.rtrim("text", F.lit(BLANKS))
    rows = rows.select(
        "*",
        (whole == "").alias("blank"),
        (~F.right(whole, F.lit(1)).isin(".", "!", "?")).alias("open"),
        F.sha2("text", 256).alias("digest"),
    )
    order = Window.partitionBy("conv_id", "dropped").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy("place")
    rows = rows.select(
        "conv_id", "turn", "role", "dropped", "blank", "open", "digest",
        F.row_number().over(order).alias("place"),
        F.lag(F.left("role", F.lit(1))).over(order).alias("before"),
        F.lag("turn").over(order).alias("turn_before"),
    )
    rows = rows.withColumn("again", F.row_number().over(same) > 1)
    initial, fault = F.left("role", F.lit(1)), F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("open"), 3).otherwise(0)
    class_of = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.select(
        "conv_id",
        "dropped",
        "place",
        "turn",
        F.coalesce(F.col("turn") != F.col("turn_before"), F.col("turn").isNotNull()).alias("new_turn"),
        fault.alias("fault"),
        (F.col("before").isNotNull() & ~F.concat("before", initial).isin("su", "ua", "au")).alias("illegal"),
        F.char(F.lit(ord("A")) + 4 * class_of + fault).alias("symbol"),
    )


def stretches(rows: DataFrame) -> DataFrame:
    """One row for each stretch of a conversation (stretch -1: dropped rows): its string and its counts."""
    kept = ~F.col("dropped")

    def count(condition: Column) -> Column:
        return F.count(F.when(kept & condition, 1))

    stretch = F.when(kept, F.floor((F.col("place") - 1) / STRETCH)).otherwise(F.lit(-1))
    listed = F.array_sort(F.collect_list(F.when(kept, F.struct("place", "symbol"))))
    return rows.groupBy("conv_id", "dropped", stretch.alias("stretch")).agg(
        F.array_join(F.transform(listed, lambda r: r.symbol), "").alias("string"),
        count(F.col("fault") == 1).alias("blank"),
        count(F.col("fault") == 2).alias("duplicate"),
        count(F.col("fault") == 3).alias("truncated"),
        count(F.col("illegal")).alias("illegal"),
        count(F.col("new_turn")).alias("turns"),
        F.min(F.when(kept, F.col("turn"))).alias("first_turn"),
        F.max(F.when(kept, F.col("turn"))).alias("last_turn"),
    )


# Grammar


@dataclass
class Grammar:
    """Rules in the order they were made: the new character and the two it stands for."""

    rules: list[tuple[str, str]] = field(default_factory=list)

    def write(self, string: Column) -> Column:
        for new, pair in self.rules:
            string = F.replace(string, F.lit(pair), F.lit(new))
        return string


def learn_grammar(strings: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> Grammar:
    """Re-Pair over strings (string, times): in each round the most frequent pairs, as far as they share no character."""
    grammar = Grammar()
    for _ in range(rounds):
        letters = F.split(grammar.write(F.col("string")), "")
        pairs = F.transform(F.sequence(F.lit(1), F.size("letters") - 1), lambda i: F.concat(F.get("letters", i - 1), F.get("letters", i)))
        counted = strings.select(letters.alias("letters"), "times").where(F.size("letters") > 1)
        counted = counted.select(F.explode(pairs).alias("pair"), "times").groupBy("pair").agg(F.sum("times").alias("times"))
        taken: set[str] = set()
        before = len(grammar.rules)
        for row in counted.where("times > 1").orderBy(F.desc("times"), "pair").limit(rules).collect():
            if not taken & set(row.pair):
                taken |= set(row.pair)
                grammar.rules.append((chr(FIRST_RULE + len(grammar.rules)), row.pair))
        if len(grammar.rules) == before:
            break
    return grammar


# Matrices

#: No way from one place to the other.
NEVER = None


@dataclass
class Transfer:
    """The cheapest way of a stretch of rows between places: cost, rank of its audit among those from the same place, and where its
    two parts meet (for a single row, the audit itself)."""

    cost: list
    rank: list
    meet: list
    left: Transfer | None = None
    right: Transfer | None = None

    def audit(self, a: int, b: int) -> str:
        """Writes the rope out, left to right."""
        out, open_ropes = [], [(self, a, b)]
        while open_ropes:
            rope, a, b = open_ropes.pop()
            if rope.left is None:
                out.append(rope.meet[a][b])
            else:
                c = rope.meet[a][b]
                open_ropes += [(rope.right, c, b), (rope.left, a, c)]
        return "".join(out)


def ranked(keys: list) -> list:
    order = sorted(k for k in keys if k is not None)
    return [None if k is None else order.index(k) for k in keys]


def single(character: str) -> Transfer:
    """One row: deleted, or kept or re-roled after as many insertions as lead to a fitting place."""
    initial, fault = divmod(ord(character) - ord("A"), 4)
    cost, meet = [[NEVER] * 4 for _ in PLACES], [[NEVER] * 4 for _ in PLACES]
    for a in PLACES:
        ways = [(COSTS["D"], "D", a)]
        if FAULTS[fault] not in ("blank", "duplicate"):
            extra = TRUNCATED_COST if FAULTS[fault] == "truncated" else 0
            place, insertions = a, ""
            for _ in range(3):
                to = {0: 1 if place == 0 else None, 1: 2 if place != 2 else None, 2: 3 if place == 2 else None}.get(initial)
                paid = extra + COSTS["I"] * len(insertions)
                if to is not None:
                    ways.append((paid, insertions + "K", to))
                ways.append((paid + COSTS["R"], insertions + "R", NEXT[place]))
                place, insertions = NEXT[place], insertions + "I"
        for paid, audit, b in sorted(ways, reverse=True):
            if cost[a][b] is NEVER or (paid, audit) < (cost[a][b], meet[a][b]):
                cost[a][b], meet[a][b] = paid, audit
    return Transfer(cost, [ranked(row) for row in meet], meet)


def product(x: Transfer, y: Transfer) -> Transfer:
    cost, rank, meet = [], [], []
    for a in PLACES:
        best = []
        for b in PLACES:
            ways = [
                (x.cost[a][c] + y.cost[c][b], x.rank[a][c], y.rank[c][b], c)
                for c in PLACES
                if x.cost[a][c] is not NEVER and y.cost[c][b] is not NEVER
            ]
            best.append(min(ways) if ways else None)
        cost.append([w and w[0] for w in best])
        rank.append(ranked([w and w[1:3] for w in best]))
        meet.append([w and w[3] for w in best])
    return Transfer(cost, rank, meet, x, y)


class Matrices:
    """One matrix for each character and rule; strings are products of them."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.of = {symbol(i, f): single(symbol(i, f)) for i in PLACES for f in PLACES}
        for new, (left, right) in grammar.rules:
            self.of[new] = product(self.of[left], self.of[right])

    def solve(self, string: str) -> Transfer:
        """Halves, so that ropes stay flat."""
        parts = [self.of[c] for c in string]
        while len(parts) > 1:
            pairs = [product(x, y) for x, y in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[2 * len(pairs) :]
        return parts[0]


def stream(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """The rows of each partition, one after the other in their order, through a generator."""
    names = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out = to_arrow_schema(names), []
        for row in step(r for batch in batches for r in batch.to_pylist()):
            out.append(row)
            if len(out) == OUT_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, names)


def solve_strings(strings: DataFrame, grammar: Grammar) -> DataFrame:
    """Each different string with its matrix, row after row (null: no way), and the audits of its 16 ways."""

    def solve(rows: Iterator[dict]) -> Iterator[dict]:
        matrices = Matrices(grammar)
        ways = [(a, b) for a in PLACES for b in PLACES]
        for row in rows:
            m = matrices.solve(row["written"])
            yield {
                "string": row["string"],
                "cost": [m.cost[a][b] for a, b in ways],
                "rank": [m.rank[a][b] for a, b in ways],
                "audit": [None if m.cost[a][b] is NEVER else m.audit(a, b) for a, b in ways],
            }

    written = strings.select("string", grammar.write(F.col("string")).alias("written"))
    return stream(written, solve, "string string, cost array<bigint>, rank array<int>, audit array<string>")


# Conversations

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
REPORT = "cost bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)


def through(stretches: list[dict]) -> Iterator[dict]:
    """The stretches of one conversation, each with its matrix, to the audit of each; the first also has cost and counts."""
    solved = [r for r in stretches if r["stretch"] >= 0]
    best, back = {0: (0, 0)}, []
    for r in solved:
        ways = {}
        for b in PLACES:
            found = [
                (cost + r["cost"][4 * a + b], rank, r["rank"][4 * a + b], a)
                for a, (cost, rank) in best.items()
                if r["cost"][4 * a + b] is not NEVER
            ]
            if found:
                ways[b] = min(found)
        order = sorted(w[1:3] for w in ways.values())
        back.append({b: w[3] for b, w in ways.items()})
        best = {b: (w[0], order.index(w[1:3])) for b, w in ways.items()}
    cost, _, end = min((c + COSTS["I"] * len(CLOSING[b]), rank, b) for b, (c, rank) in best.items())
    audits, b = [CLOSING[end]], end
    for r, step in zip(reversed(solved), reversed(back), strict=True):
        audits.append(r["audit"][4 * step[b] + b])
        b = step[b]
    counts = {c: sum(r[c] for r in solved) for c in COUNTS[1:]} | {"gaps": stretches[0]["gaps"], "cost": cost}
    for k, audit in enumerate(reversed(audits)):
        yield {"conv_id": stretches[0]["conv_id"], "stretch": k, "audit": audit, "last": k == len(solved)} | (counts if k == 0 else {})


def conversations(rows: Iterator[dict]) -> Iterator[Iterator[dict]]:
    """A stream of rows, cut where the conversation changes (null is one of its own)."""
    return (same for _, same in groupby(rows, key=lambda r: r["conv_id"]))


def rewrite(rows: Iterator[dict]) -> Iterator[dict]:
    """Each conversation's audits, then its rows in order, to a header row and the repaired rows."""
    for same in conversations(rows):
        row = next(same)
        header, letters = row, [row["audit"]]
        while not row["last"]:
            row = next(same)
            letters.append(row["audit"])
        audit = "".join(letters)
        key = {"conv_id": header["conv_id"]}
        yield key | {"place": 0, "audit": audit} | {c: header[c] for c in ("cost", *COUNTS)}
        place, state = 0, 0
        for letter in audit:
            row = None if letter == "I" else next(same)
            if letter == "D":
                continue
            role = row["role"] if letter == "K" else ROLES[int(state == 2)]
            place, state = place + 1, 1 if letter == "K" and role[0] == "s" else NEXT[state]
            yield key | {"place": place, "role": role, "text": "" if row is None else row["text"], "edit": letter}


def repair(turns: DataFrame) -> DataFrame:
    """turns: conv_id, turn bigint, role, text and, if there, dropped (rows that only say that the conversation exists).
    For each conversation a header row (place 0: audit, cost and counts), then its repaired rows by place with the letter of the edit
    that gave them. Rows of a conversation lie together, in order, in one partition."""
    key = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}"
    pieces = stored(stretches(marked(turns)), "repair-stretches")
    strings = stored(pieces.where("string != ''").groupBy("string").agg(F.count("*").alias("times")), "repair-strings")
    solved = solve_strings(strings, learn_grammar(strings))
    same = Window.partitionBy("conv_id")
    span = F.try_subtract(F.max("last_turn").over(same), F.min("first_turn").over(same))
    ordered = pieces.join(solved, "string", "left").repartition("conv_id").withColumn(
        "gaps", F.when(F.max("turns").over(same) > 0, span + 1 - F.sum("turns").over(same)).otherwise(0)
    )
    ordered = ordered.sortWithinPartitions("conv_id", "stretch").select(
        "conv_id", "stretch", "cost", "rank", "audit", "gaps", *COUNTS[1:]
    )
    audits = stream(
        ordered, lambda rows: (r for same in conversations(rows) for r in through(list(same))),
        f"{key}, stretch bigint, audit string, last boolean, {REPORT}",
    )
    rows = turns.where("not dropped") if "dropped" in turns.columns else turns
    rows = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    both = audits.withColumn("kind", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    in_order = ["conv_id", "kind", "stretch", F.col("turn").asc_nulls_first(), "role", "text"]
    return stream(
        both.repartition("conv_id").sortWithinPartitions(*in_order), rewrite,
        f"{key}, place bigint, role string, text string, edit string, audit string, {REPORT}",
    )


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of what repair() gives, with the digest of its `role:text` lines, read as a stream."""

    def digest(rows: Iterator[dict]) -> Iterator[dict]:
        for same in conversations(rows):
            header, state = next(same), hashlib.sha256()
            for row in same:
                state.update(f"{chr(10) if row['place'] > 1 else ''}{row['role']}:{row['text']}".encode())
            yield {c: header[c] for c in ("conv_id", "cost", "audit", *COUNTS)} | {"repaired_sha256": state.hexdigest()}

    key = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}"
    return stream(repaired, digest, f"{key}, audit string, {REPORT}, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Planted faults by the checksum of `conv_id:turn`; rows that are dropped stay, marked as such."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind, text = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20, F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", "role", text.alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
