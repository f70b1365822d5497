"""Exact Jaccard join over sets of word n-grams, and the groups that its links form.

A text's set holds a 64-bit hash per distinct n-gram of its lower-cased words (with fewer words, one for the whole
sequence). Texts with the same set are one class, named by a 64-bit hash of the set. All further steps see classes, so
copies are never compared with each other.

Candidates. N-grams are ordered by how common they are (n-grams frequent within some batch of rows come last), then by
hash. Classes that reach the threshold share an n-gram among the first ``size - ceil(t * size) + 1`` of each; only those
are indexed, with their position.

Skipping by set relation. Index lists are not joined with themselves. (1) Each list has a hub, the class on it with
most and longest lists; every
class is compared exactly with the hub that it shares most lists with, and takes over that hub's group if they link: the
hub's answers are its answers. Lists of common n-grams are split into slots with a hub each, whose hubs meet again. (2)
What is left are pairs of different groups. Lists are cut into blocks by position, counted from the end of the set: the
first n-gram that linked sets share has so much of both behind it that only equal and neighbouring blocks can meet. A pair
is skipped when its sizes differ too much, when the n-gram stands so late in either set that too few can follow, or when
both were compared with the same hub and their distances to it differ by more than 1 - t (Jaccard distance is a metric).
The rest are compared exactly. Links inside a group don't change the groups, so no list gives all its pairs.

Number of links. Linked classes are of one group, so ``links`` counts inside the groups, in blocks: a group's classes are
cut by size, as only equal and neighbouring sizes can link, and large pieces into slots of bounded size by a hash. A task
takes two blocks. It orders one of them so that neighbours are alike, and derives the overlaps of a set with all of the
other block from those of the set before it: only the n-grams in which the two differ are looked up. Tasks return a number
per class, never pairs. Exact numbers of links cost work with the square of a group's different texts; it is spread over
tasks, and ``links=False`` leaves it out.

Defined results: null, empty and white-space texts have the empty set and are linked with nothing; repeated rows and ids
are kept, each row is listed; rows with null id are listed, never name a group, and are linked only where a row with an
id has the same set; an empty table gives none; other columns of the input aren't carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bloomline.llm.common import stored

U = np.uint64
ODD = 0x9E3779B97F4A7C15
#: An n-gram counts as common from so many documents of one batch on.
COMMON = 2
#: Common n-grams that the order knows of: those found in most documents. A proven bound for the broadcast.
COMMON_AT_MOST = 500_000
#: A list longer than this is dealt into slots.
SLOT_ROWS = 2_000
#: Sets and n-grams of a block in which links are counted.
BLOCK_SETS, BLOCK_GRAMS = 1_000, 1_000_000
#: N-grams that a task looks up at a time.
LOOKED_UP = 1 << 15
#: Rows of a broadcast join's small side; beyond that the sides are shuffled.
BROADCAST_ROWS = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


with np.errstate(over="ignore"):
    BYTE = mix(np.arange(1, 257, dtype=U) * U(ODD))
    BASE = 0xD1342543DE82EF95
    INVERSE = pow(BASE, -1, 1 << 64)
POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, n.bit_length())
    if size not in POWERS:
        both = []
        for base in (BASE, INVERSE):
            run = np.full(size, base, U)
            run[0] = 1
            both.append(np.cumprod(run))
        POWERS.clear()
        POWERS[size] = both[0], both[1]
    return POWERS[size]


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words of one whole text."""
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(np.r_[True, space, True]))
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return np.zeros(0, U)
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(BYTE[raw] * up[: len(raw)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
    k = min(width, n)
    total = np.full(n - k + 1, k, U)
    for j in range(k):
        total = mix(total * U(ODD) + words[j : n - k + 1 + j])
    return np.unique(total)


def set_hash(grams: np.ndarray) -> int:
    """A 64-bit name of the set, never 0; signed, as Spark's bigint."""
    with np.errstate(over="ignore"):
        h = mix(np.array([np.sum(mix(grams ^ U(0x5851F42D4C957F2D)), dtype=U) + U(len(grams))], U))
    return int(h.view(np.int64)[0]) or 1


def _texts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for k in range(0, len(batch), 2_000):
                part = batch.slice(k, 2_000)
                yield part, [shingles(t, width) for t in part.column("body").to_pylist()]


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """id, sid, n of each row, and rows with common n-grams of a batch (gram, found)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _texts(batches, width):
            # Copies don't make an n-gram common: each set counts once.
            names = [set_hash(s) if len(s) else None for s in sets]
            distinct = {name: s for name, s in zip(names, sets, strict=True) if name}
            grams, found = np.zeros(0, U), np.zeros(0, np.int64)
            if distinct:
                grams, found = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            often = found >= COMMON
            n, m = len(part), int(often.sum())
            blank = lambda k, kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([True] * n + [False] * m),
                    pa.concat_arrays([part.column("id"), blank(m, part.column("id").type)]),
                    pa.concat_arrays([pa.array(names, pa.int64()), pa.array(grams[often].view(np.int64))]),
                    pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), pa.array(found[often])]),
                ],
                ["row", "id", "sid", "n"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "body").mapInArrow(run, f"row boolean, id {kind}, sid bigint, n bigint")


def common_grams(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The commonest n-grams (sorted) and their counts."""
    top = found.groupBy("gram").agg(F.sum("found").alias("n")).orderBy(F.desc("n"), "gram").limit(COMMON_AT_MOST).toArrow()
    grams = np.array(top["gram"].to_numpy(), np.int64).view(U)
    order = np.argsort(grams)
    return grams[order], np.array(top["n"].to_numpy(), np.int64)[order]


def postings(docs: DataFrame, width: int, percent: int, grams: np.ndarray, counts: np.ndarray) -> DataFrame:
    """gram, slot, slots, sid, n, pos of the first n-grams of every class (repeats across tasks stay)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((grams, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = shared.value
        seen: set[int] = set()
        maybe = np.zeros(1 << 20, bool)
        maybe[(grams >> U(44)).astype(np.int64)] = True
        for _, sets in _texts(batches, width):
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for s in sets:
                n = len(s)
                if not n or (sid := set_hash(s)) in seen:
                    continue
                seen.add(sid)
                often = np.zeros(n, np.int64)
                near = np.flatnonzero(maybe[(s >> U(44)).astype(np.int64)])
                if near.size and len(grams):
                    at = np.minimum(np.searchsorted(grams, s[near]), len(grams) - 1)
                    often[near] = np.where(grams[at] == s[near], counts[at], 0)
                first = n - -(-percent * n // 100) + 1
                place = np.argsort(often, kind="stable")[:first] if often.any() else np.arange(first)
                slots = -(-often[place] // SLOT_ROWS)
                slots[slots == 0] = 1
                # Remainders of the class name deal a long list evenly.
                slot = (U(sid & ((1 << 64) - 1)) % slots.astype(U)).astype(np.int64)
                for k, x in enumerate((s[place].view(np.int64), slot, slots, np.full(first, sid), np.full(first, n), np.arange(first))):
                    out[k].append(x)
            if len(seen) > 1_000_000:
                seen.clear()
            if out[0]:
                columns = [np.concatenate(x) for x in out]
                kinds = (np.int64, np.int32, np.int32, np.int64, np.int32, np.int32)
                for k in range(0, len(columns[0]), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[k : k + 50_000].astype(t)) for c, t in zip(columns, kinds, strict=True)],
                        ["gram", "slot", "slots", "sid", "n", "pos"],
                    )

    return docs.select("body").mapInArrow(run, "gram bigint, slot int, slots int, sid bigint, n int, pos int")


def class_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _texts(batches, width):
            for k in range(0, len(sets), 256):
                # Rows with the same id may have other texts.
                pairs = zip(part.column("sid").slice(k, 256).to_pylist(), sets[k : k + 256], strict=True)
                some = {sid: s for sid, s in pairs if len(s) and set_hash(s) == sid}
                if some:
                    offsets = np.cumsum([0, *map(len, some.values())])
                    values = pa.array(np.concatenate(list(some.values())).view(np.int64))
                    grams = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([pa.array(list(some), pa.int64()), grams], ["sid", "grams"])

    return docs.select("sid", "body").mapInArrow(run, "sid bigint, grams array<bigint>")


def sized_join(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """Broadcasts right (a stored table) only while it has few rows."""
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on, how)


def least_overlap(percent: int, a, b):
    """Sets of sizes a and b are linked from so many common n-grams on: 100 o >= percent (a + b - o)."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def compare(pairs: DataFrame, docs: DataFrame, first_of: DataFrame, width: int, percent: int) -> DataFrame:
    """pairs (a, b, na, nb, stored) with common, the size of their intersection, and linked."""
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    chosen = stored(first_of.join(wanted, "sid").select("sid", "id"), "jaccard-chosen")
    sets = class_sets(sized_join(docs.where("id is not null"), chosen, "id", "inner"), width)
    left = sets.select(F.col("sid").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("sid").alias("b"), F.col("grams").alias("grams_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = both.withColumn("common", F.size(F.array_intersect("grams_a", "grams_b"))).drop("grams_a", "grams_b")
    return common.withColumn("linked", F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common")))


def roots(links: DataFrame) -> DataFrame:
    """sid, root of every node of links (a, b): the smallest node that it reaches."""
    edges = stored(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), "jaccard-edges"
    )
    labels = stored(edges.groupBy(F.col("u").alias("sid")).agg(F.least(F.min("v"), F.col("sid")).alias("root")), "jaccard-labels")
    while True:
        # The smallest label around each node, then the label of that label.
        near = edges.join(labels, edges.v == labels.sid).groupBy("u").agg(F.min("root").alias("near"))
        step = labels.join(near, labels.sid == near.u, "left").select("sid", F.col("root").alias("was"), F.least("root", F.coalesce("near", "root")).alias("root"))
        up = labels.select(F.col("sid").alias("root"), F.col("root").alias("over"))
        jumped = step.join(up, "root", "left").select("sid", "was", F.least("root", F.coalesce("over", "root")).alias("root"))
        done = stored(jumped, "jaccard-labels")
        labels = done.select("sid", "root")
        if not done.where("root <> was").limit(1).count():
            return labels


def overlaps(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of rows with each of others (sorted n-grams)."""
    out = np.zeros((len(rows), len(others)), np.int32)
    theirs, ours = np.concatenate(others), np.concatenate(rows)
    known = np.intersect1d(theirs, ours)
    place = lambda sets: [np.searchsorted(known, s[np.isin(s, known, assume_unique=True)]) for s in sets]
    rows_at, others_at = place(rows), place(others)
    for low in range(0, len(known), LOOKED_UP):
        high = min(low + LOOKED_UP, len(known))
        cut = lambda s: s[np.searchsorted(s, low) : np.searchsorted(s, high)] - low
        found = np.zeros((high - low, len(others)), np.uint8)
        for k, s in enumerate(others_at):
            found[cut(s), k] = 1
        sums, before = np.zeros(len(others), np.int32), np.zeros(0, np.int64)
        for k, s in enumerate(rows_at):
            now = cut(s)
            gone, new = np.setdiff1d(before, now, True), np.setdiff1d(now, before, True)
            if len(gone) + len(new) < len(now):
                sums = sums + found[new].sum(0, dtype=np.int32) - found[gone].sum(0, dtype=np.int32)
            else:
                sums = found[now].sum(0, dtype=np.int32)
            out[k] += sums
            before = now
    return out


def count_links(docs: DataFrame, groups: DataFrame, sizes: DataFrame, first_of: DataFrame, width: int, percent: int) -> DataFrame:
    """sid and n_links, the other classes that each class of groups (sid, root) is linked with."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent * (1 + 1e-6)))).cast("int")
    banded = stored(groups.join(sizes, "sid").select("sid", "root", "n", band.alias("band")), "jaccard-banded")
    slots = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS))).cast("int")
    pieces = banded.groupBy("root", "band").agg(slots.alias("slots"))
    beside = pieces.select("root", (F.col("band") - 1).alias("band"), F.col("slots").alias("above"))
    below = pieces.select("root", (F.col("band") + 1).alias("band"), F.col("slots").alias("below"))
    sized = stored(pieces.join(beside, ["root", "band"], "left").join(below, ["root", "band"], "left").na.fill(0, ["above", "below"]), "jaccard-pieces")
    slot = F.pmod(F.xxhash64("sid", F.lit(7)), F.col("slots")).cast("int")
    meeting = lambda band, low, high, first: F.struct(band.alias("band"), low.alias("low"), high.alias("high"), first.alias("first"))
    # Slots of one band meet as (smaller, larger) slot; neighbouring bands as (slot of the lower, slot of the higher) band.
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    mine = F.transform(upto(F.col("slots")), lambda k: meeting(F.col("band") * 2, F.least(k, F.col("slot")), F.greatest(k, F.col("slot")), F.col("slot") <= k))
    higher = F.transform(upto(F.col("above")), lambda k: meeting(F.col("band") * 2 + 1, F.col("slot"), k, F.lit(True)))
    lower = F.transform(upto(F.col("below")), lambda k: meeting(F.col("band") * 2 - 1, k, F.col("slot"), F.lit(False)))
    dealt = banded.join(sized, ["root", "band"]).withColumn("slot", slot)
    dealt = dealt.select("sid", "root", "n", F.explode(F.concat(mine, higher, lower)).alias("m")).select("sid", "root", "n", "m.*")

    chosen = stored(first_of.join(banded.select("sid"), "sid").select("sid", "id"), "jaccard-members")
    sets = class_sets(sized_join(docs.where("id is not null"), chosen, "id", "inner"), width).dropDuplicates(["sid"])

    def count(table: pa.Table) -> pa.Table:
        sid, n, first = (table[c].to_numpy() for c in ("sid", "n", "first"))
        grams = [np.sort(np.array(g.values.to_numpy(), np.int64)) for g in table["grams"]]
        one_block = table["low"][0].as_py() == table["high"][0].as_py() and table["band"][0].as_py() % 2 == 0
        order = np.lexsort((n, np.array([g[0] for g in grams])))  # alike sets often share their least n-gram
        a = order if one_block else order[first[order]]
        b = order if one_block else order[~first[order]]
        links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        if len(a) and len(b):
            common = overlaps([grams[k] for k in a], [grams[k] for k in b]).astype(np.int64)
            linked = 100 * common >= percent * (n[a][:, None] + n[b][None] - common)
            if one_block:
                np.fill_diagonal(linked, False)
            else:
                links_b = linked.sum(0)
            links_a = linked.sum(1)
        found = np.r_[links_a, links_b]
        some = found > 0
        return pa.table({"sid": pa.array(np.r_[sid[a], sid[b]][some]), "n_links": pa.array(found[some])})

    blocks = dealt.join(sets, "sid").groupBy("root", "band", "low", "high")
    return blocks.applyInArrow(count, "sid bigint, n_links bigint").groupBy("sid").agg(F.sum("n_links").alias("n_links"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, links: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest id of its group), class_id (the set's
    name, null for the empty set) and n_links (the other classes that its class is linked with; null without links)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("body"))
    both = stored(signatures(rows, width), "jaccard-signatures")
    signed = both.where("row").select("id", "sid", "n")
    grams, counts = common_grams(both.where("not row").select(F.col("sid").alias("gram"), F.col("n").alias("found")))
    first_of = signed.where("sid is not null and id is not null").groupBy("sid").agg(F.min("id").alias("id"))

    slot = Window.partitionBy("gram", "slot")
    listed = postings(rows, width, percent, grams, counts).withColumns(
        {"low": F.min("sid").over(slot), "high": F.max("sid").over(slot), "len": F.count(F.lit(1)).over(slot)}
    )
    # Lists of one class only are of no use; of a split list every slot stays.
    lists = stored(listed.where("low <> high or slots > 1").select("gram", "slot", "slots", "sid", "n", "pos", "len"), "jaccard-lists")
    # A class on many long lists stands in the middle of its copies: it makes the best hub.
    weight = lists.groupBy("sid").agg(F.sum("len").alias("weight"))
    hub = F.max(F.struct("weight", "sid", "n")).over(slot)
    hubbed = stored(
        lists.join(weight, "sid").withColumn("hub", hub).select(
            "gram", "slots", "sid", "n", "pos", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.weight").alias("hub_weight")
        ),
        "jaccard-hubs",
    )
    fits = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)
    meet = Window.partitionBy("gram")
    hubs = hubbed.where("slots > 1").select("gram", "hub", "hub_n", "hub_weight").distinct()
    over = hubs.withColumn("top", F.max(F.struct("hub_weight", "hub", "hub_n")).over(meet)).select(
        F.col("top.hub").alias("a"), F.col("top.hub_n").alias("na"), F.col("hub").alias("b"), F.col("hub_n").alias("nb")
    )
    tried = (
        hubbed.select(F.col("hub").alias("a"), F.col("hub_n").alias("na"), F.col("sid").alias("b"), F.col("n").alias("nb"))
        .union(over)
        .where((F.col("a") != F.col("b")) & fits(F.col("na"), F.col("nb")))
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("lists"))
    )
    need = least_overlap(percent, F.col("na"), F.col("nb"))
    floor = lambda n: need - F.ceil(n * F.lit(percent) / F.lit(100)) + 1
    least_shared = F.greatest(F.lit(1), F.least(floor(F.col("na")), floor(F.col("nb"))))
    # Half of what a linked pair shares: one list may have had another hub. Pairs left out here are met in (2).
    best = (
        tried.where(F.col("lists") * 2 >= least_shared)
        .groupBy("b", "nb")
        .agg(F.max(F.struct("lists", "a", "na")).alias("best"))
        .select(F.col("best.a").alias("a"), "b", F.col("best.na").alias("na"), "nb")
    )
    hub_pairs = stored(best, "jaccard-hub-pairs")
    compared = stored(compare(hub_pairs, rows, first_of, width, percent), "jaccard-compared")
    groups = roots(compared.where("linked"))

    away = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    known = compared.select(F.col("b").alias("sid"), F.col("a").alias("anchor"), (1 - away).alias("away"))
    placed = (
        lists.select("gram", "sid", "n", "pos")
        .join(groups, "sid", "left")
        .join(known, "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
        .distinct()
    )
    spread = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("gram")
    # A little wider than the bound, so that rounding can't move neighbours apart.
    block = F.floor(F.log((F.col("n") - F.col("pos")).cast("double")) / F.log(F.lit(100 / percent * (1 + 1e-6))))
    mixed = stored(placed.join(spread, "gram", "left_semi").withColumn("block", block), "jaccard-mixed")
    x = mixed.select([F.col(c).alias(f"{c}_x") for c in mixed.columns]).withColumn("at_x", F.explode(F.array(F.col("block_x"), F.col("block_x") + 1)))
    y = mixed.select([F.col(c).alias(f"{c}_y") for c in mixed.columns])
    same_block = F.col("block_x") == F.col("block_y")
    apart = F.col("anchor_x").eqNullSafe(F.col("anchor_y")) & F.col("anchor_x").isNotNull()
    least = least_overlap(percent, F.col("n_x"), F.col("n_y"))
    # The first common n-gram of linked sets leaves room for all that they must share after it.
    early = (F.col("pos_x") + least <= F.col("n_x")) & (F.col("pos_y") + least <= F.col("n_y"))
    pairs = (
        x.join(y, (F.col("gram_x") == F.col("gram_y")) & (F.col("at_x") == F.col("block_y")) & early)
        .where(F.col("root_x") != F.col("root_y"))
        .where(~same_block | (F.col("sid_x") < F.col("sid_y")))
        .where(fits(F.col("n_x"), F.col("n_y")))
        .where(~apart | (F.abs(F.col("away_x") - F.col("away_y")) <= F.lit(1 - percent / 100 + 1e-9)))
        .select(F.col("sid_x").alias("a"), F.col("sid_y").alias("b"), F.col("n_x").alias("na"), F.col("n_y").alias("nb"))
        .distinct()
    )
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crossing = stored(pairs, "jaccard-cross-pairs")
    linked = ordered(compared.where("linked")).distinct()
    if crossing.limit(1).count():
        found = stored(compare(crossing, rows, first_of, width, percent), "jaccard-crossing")
        linked = linked.union(ordered(found.where("linked"))).distinct()
        groups = roots(linked)

    number = F.lit(None).cast("bigint")
    if links:
        sizes = signed.where("sid is not null").groupBy("sid").agg(F.min("n").alias("n"))
        links_of = stored(count_links(rows, groups, sizes, first_of, width, percent), "jaccard-links")
        number = F.coalesce("n_links", F.lit(0))
    classes = (
        signed.where("sid is not null").groupBy("sid").agg(F.min("id").alias("id"))
        .join(groups, "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
    )
    names = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    by_class = classes.select("sid", "root").join(names, "root").drop("root")
    if links:
        by_class = by_class.join(links_of, "sid", "left")
    return signed.join(by_class, "sid", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("sid").alias("class_id"),
        number.alias("n_links"),
    )
