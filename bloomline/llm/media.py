"""Copies of images by local descriptors: corners at several scales, orientation-normalised binary tests, Hamming tables
and geometric consensus. It finds cropped and edited copies.

Corners are the strongest maxima of the Harris response at three scales, in proportion to the picture's area. A corner's
direction is that of its patch's intensity centroid; 256 comparisons of pixel pairs, turned by that direction, give its
bits. Each corner is filed in TABLES tables under a word of WORD of its bits. Two pictures that share MET words are compared
whole: their corners match at no more than NEAR differing bits, each match is tried as the turn, scale and shift that
carries one picture onto the other, and VOTES different corners have to agree on one.

Stock pictures are grouped before they are searched. Equal pixels are one class, described once. Pictures that agree join
one class (see near_classes): pictures of different classes that share MET words have all been compared. Every picture is
indexed; those that agree with a hub stand behind it. A query meets a class's hubs first, and the pictures behind them only
where no hub agrees. Members are listed once with their class instead of once per query.

Defined results: null, empty or wrongly sized pixels have no corners and match nothing; images without enough corners
match nothing; rows with null id are left aside, as nothing could name them; equal rows (same id and pixels) are listed
once and counted in copies; rows with the same id but other pixels are listed each; a class is named by its smallest id;
empty tables give none; other columns of the input aren't carried. Pictures are named by 64 bits of their pixels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.llm.common import shuffle_partitions, stored
from bloomline.llm.jaccard import mix, roots

SCALES = (1.0, 0.71, 0.5)
#: Corners of each scale in a picture of AREA pixels; larger pictures have more in proportion.
CORNERS = (14, 8, 6)
AREA = 64 * 64
RADIUS = 8
TABLES = 12
#: Bits of a word: so many that pictures which aren't copies seldom share one (a multiple of 64).
WORD = 64
NEAR = 40
VOTES = 4
#: Words that two pictures share before their corners are compared.
MET = 2
#: Pictures under one word that meet as many others in a task.
MEETING = 1_000
#: Pixels that a corner may be away from where a transform puts it, and what its distance from the transform's corner adds.
SHIFT = 5.0
SLACK = 0.1
BROADCAST_ROWS = 1_000_000
#: Corners, and matches, that are compared with all others at a time.
BLOCK = 64
#: Pixels of pictures of one shape that are described at a time (a larger picture alone).
PIXELS = 1 << 20


def _tests() -> np.ndarray:
    """256 pairs of points inside the patch: from a rule (a seeded normal spread), not a list."""
    rng = np.random.default_rng(2024)
    points = rng.normal(0, RADIUS / 2.2, (256, 2, 2))
    far = np.linalg.norm(points, axis=2, keepdims=True)
    return points * np.minimum(1, RADIUS / np.maximum(far, 1e-9))


TESTS = _tests()
PLACES = [np.random.default_rng(t).permutation(256)[:WORD] for t in range(TABLES)]
DISC = np.array([(y, x) for y in range(-6, 7) for x in range(-6, 7) if x * x + y * y <= 36])


def _resized(images: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return images
    out = images
    for axis in (1, 2):
        size = max(1, round(images.shape[axis] * scale))
        at = np.clip((np.arange(size) + 0.5) / scale - 0.5, 0, images.shape[axis] - 1)
        low = at.astype(int)
        high = np.minimum(low + 1, images.shape[axis] - 1)
        part = (at - low).reshape([-1 if a == axis else 1 for a in range(3)]).astype(np.float32)
        out = np.take(out, low, axis) * (1 - part) + np.take(out, high, axis) * part
    return out


def _smooth(x: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    reach = len(weights) // 2
    for axis in (1, 2):
        pad = [(reach, reach) if a == axis else (0, 0) for a in range(3)]
        wide = np.pad(x, pad, mode="edge")
        n = x.shape[axis]
        x = sum(w * np.take(wide, range(k, k + n), axis) for k, w in enumerate(weights))
    return x


def describe(images: np.ndarray) -> dict[str, np.ndarray]:
    """Corners of equally sized grey images (count, height, width): image, x, y, scale, angle and words (4 x 64 bits)."""
    found: list[dict[str, np.ndarray]] = []
    for scale, least in zip(SCALES, CORNERS, strict=True):
        keep = max(least, round(least * images.shape[1] * images.shape[2] / AREA))
        x = _smooth(_resized(images.astype(np.float32), scale), (0.25, 0.5, 0.25))
        height, width = x.shape[1:]
        edge = RADIUS + 2
        if min(height, width) <= 2 * edge:
            continue
        gy, gx = np.gradient(x, axis=(1, 2))
        a, b, c = (_smooth(g, (0.1, 0.2, 0.4, 0.2, 0.1)) for g in (gx * gx, gy * gy, gx * gy))
        r = a * b - c * c - 0.05 * (a + b) ** 2
        inner = r[:, edge:-edge, edge:-edge]
        peak = np.ones_like(inner, bool)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dy or dx:
                    peak &= inner > r[:, edge + dy : height - edge + dy, edge + dx : width - edge + dx]
        strong = np.where(peak & (inner > 0), inner, 0).reshape(len(x), -1)
        n = min(keep, strong.shape[1])
        top = np.argpartition(-strong, n - 1, axis=1)[:, :n]
        image = np.repeat(np.arange(len(x)), n)
        top = top.ravel()
        good = strong[image, top] > 0
        image, top = image[good], top[good]
        cy, cx = np.divmod(top, width - 2 * edge)
        cy, cx = cy + edge, cx + edge
        patch = x[image[:, None], cy[:, None] + DISC[:, 0], cx[:, None] + DISC[:, 1]]
        angle = np.arctan2(patch @ DISC[:, 0], patch @ DISC[:, 1])
        cos, sin = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        px = np.rint(TESTS[None, :, :, 0] * cos - TESTS[None, :, :, 1] * sin).astype(int) + cx[:, None, None]
        py = np.rint(TESTS[None, :, :, 0] * sin + TESTS[None, :, :, 1] * cos).astype(int) + cy[:, None, None]
        value = x[image[:, None, None], py, px]
        bits = np.packbits(value[:, :, 0] < value[:, :, 1], axis=1)
        found.append(
            {
                "image": image, "x": (cx + 0.5) / scale, "y": (cy + 0.5) / scale, "scale": np.full(len(image), scale),
                "angle": angle, "words": np.ascontiguousarray(bits).view(np.int64),
            }
        )
    if not found:
        return {"image": np.zeros(0, int), **{k: np.zeros(0) for k in ("x", "y", "scale", "angle")}, "words": np.zeros((0, 4), np.int64)}
    return {k: np.concatenate([f[k] for f in found]) for k in found[0]}


#: A corner as it is stored: 256 bits, place in the picture, scale and direction.
CORNER = np.dtype([("w", "<i8", 4), ("x", "<f4"), ("y", "<f4"), ("scale", "<f4"), ("angle", "<f4")])


def some_at_a_time(shapes: dict[tuple[int, int], list[dict]]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    for (h, w), rows in shapes.items():
        n = max(1, PIXELS // (h * w))
        yield from (((h, w), rows[k : k + n]) for k in range(0, len(rows), n))


def described(media: DataFrame) -> DataFrame:
    """id and corners (packed, see CORNER) of media (id, width, height, pixels: one byte each); none without corners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 128):
                shapes: dict[tuple[int, int], list[dict]] = {}
                for row in batch.slice(k, 128).to_pylist():
                    w, h = row["width"] or 0, row["height"] or 0
                    if row["pixels"] and w * h == len(row["pixels"]):
                        shapes.setdefault((h, w), []).append(row)
                for (h, w), same in some_at_a_time(shapes):
                    d = describe(np.stack([np.frombuffer(r["pixels"], np.uint8).reshape(h, w) for r in same]))
                    packed = np.zeros(len(d["image"]), CORNER)
                    packed["w"] = d["words"]
                    for name in ("x", "y", "scale", "angle"):
                        packed[name] = d[name]
                    found = [(r["id"], packed[d["image"] == i].tobytes()) for i, r in enumerate(same)]
                    found = [f for f in found if f[1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[0] for f in found], batch.column("id").type), pa.array([f[1] for f in found], pa.binary())], ["id", "corners"]
                    )

    kind = media.schema["id"].dataType.simpleString()
    return media.select("id", "width", "height", "pixels").mapInArrow(run, f"id {kind}, corners binary")


def classes(media: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of each class of equal pixels (id: a 64-bit name of the pixels, width, height, pixels), and row_id, id and
    copies of each different row."""
    # The name stands for the pixels: they aren't shuffled.
    pixels = F.sha2(F.concat(F.concat_ws(",", "width", "height").cast("binary"), F.coalesce("pixels", F.lit("").cast("binary"))), 256)
    marked = media.where("id is not null").select(F.col("id").alias("row_id"), F.xxhash64(pixels).alias("id"), "width", "height", "pixels")
    listed = stored(marked.groupBy("row_id", "id").agg(F.count(F.lit(1)).alias("copies")), "media-rows")
    groups = listed.groupBy("id").agg(F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "first")
    again = stored(groups, "media-equal")
    one = marked.join(F.broadcast(again) if again.count() <= BROADCAST_ROWS else again, "id", "left").where("first is null or first = row_id")
    if listed.where("copies > 1").limit(1).count():
        one = one.dropDuplicates(["id"])
    return one.select("id", "width", "height", "pixels"), listed


def words_of(corners: np.ndarray) -> np.ndarray:
    """The words that each corner is filed under: a column per table, a hash of the table's bits and number."""
    bits = np.unpackbits(np.ascontiguousarray(corners["w"]).view(np.uint8).reshape(len(corners), -1), axis=1)
    out = np.empty((len(corners), TABLES), np.uint64)
    for t, chosen in enumerate(PLACES):
        part = np.packbits(bits[:, chosen], axis=1).copy().view(np.uint64).ravel()
        out[:, t] = mix(part + np.uint64(t))
    return out.view(np.int64)


def filed(pictures: DataFrame) -> DataFrame:
    """id, word of every distinct word of a picture."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("id"), []
            for raw in batch.column("corners").to_pylist():
                with np.errstate(over="ignore"):
                    found.append(np.unique(words_of(np.frombuffer(raw, CORNER))))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            at = np.repeat(np.arange(len(found)), sizes)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            for k in range(0, len(flat), 100_000):
                part = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at[part])), pa.array(flat[part])], ["id", "word"])

    return pictures.mapInArrow(run, f"id {pictures.schema['id'].dataType.simpleString()}, word bigint")


def agreement(a: np.ndarray, b: np.ndarray, near: int) -> int:
    """How many corners of a agree with different ones of b on one turn, scale and shift. Corners and matches meet in blocks of BLOCK
    rows, so that memory grows with the larger picture, not with the product of both."""
    words, met = b["w"].view(np.uint64)[None], []
    for k in range(0, len(a), BLOCK):
        differ = np.bitwise_count(a["w"][k : k + BLOCK].view(np.uint64)[:, None] ^ words).sum(-1, dtype=np.int64)
        some, others = np.nonzero(differ <= near)
        met.append((some + k, others))
    i, j = (np.concatenate([m[c] for m in met]) if met else np.zeros(0, np.int64) for c in (0, 1))
    if not len(i):
        return 0
    p = np.stack([a["x"][i], a["y"][i]], 1).astype(float)
    q = np.stack([b["x"][j], b["y"][j]], 1).astype(float)
    turn = (b["angle"][j] - a["angle"][i]).astype(float)
    grow = np.log2(a["scale"][i] / b["scale"][j]).astype(float)
    around = lambda x: np.abs((x + math.pi) % (2 * math.pi) - math.pi)
    best = 0
    # Each match is tried as the transform, with its own turn and with the nearest of twelve.
    for angle in (turn, np.rint(turn * 6 / math.pi) * math.pi / 6):
        for k in range(0, len(i), BLOCK):
            now = slice(k, k + BLOCK)
            same = (around(turn[now, None] - turn[None]) <= math.pi / 6) & (np.abs(grow[now, None] - grow[None]) <= 0.51)
            cos, sin, size = np.cos(angle[now])[:, None], np.sin(angle[now])[:, None], np.exp2(grow[now])[:, None]
            dx, dy = p[None, :, 0] - p[now, None, 0], p[None, :, 1] - p[now, None, 1]
            ex = size * (cos * dx - sin * dy) - (q[None, :, 0] - q[now, None, 0])
            ey = size * (sin * dx + cos * dy) - (q[None, :, 1] - q[now, None, 1])
            fits = same & (np.hypot(ex, ey) <= SHIFT * np.maximum(1, size) + SLACK * np.hypot(dx, dy))
            for row in fits[fits.sum(1) > best]:
                best = max(best, min(len(set(i[row].tolist())), len(set(j[row].tolist()))))
    return best


def agreeing(pairs: DataFrame, left: DataFrame, right: DataFrame, near: int, votes: int, either: bool = False) -> DataFrame:
    """a, b, votes of the pairs (a of left, b of right) that agree in enough corners; either: a carried onto b or b onto a."""

    def agreed(p: np.ndarray, q: np.ndarray) -> int:
        n = agreement(p, q, near)
        return agreement(q, p, near) if either and n < votes else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("corners_a", "corners_b"))
            got = np.array([agreed(np.frombuffer(p, CORNER), np.frombuffer(q, CORNER)) for p, q in zip(x, y, strict=True)], np.int32)
            keep = pa.array(got >= votes)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(got[got >= votes])], ["a", "b", "votes"])

    first = right.select(F.col("id").alias("b"), F.col("corners").alias("corners_b"))
    second = left.select(F.col("id").alias("a"), F.col("corners").alias("corners_a"))
    both = pairs.select("a", "b").join(first, "b").join(second, "a")
    kinds = [both.schema[c].dataType.simpleString() for c in ("a", "b")]
    return both.select("a", "b", "corners_a", "corners_b").mapInArrow(run, f"a {kinds[0]}, b {kinds[1]}, votes int")


def apart(rows: DataFrame) -> DataFrame:
    """a, b (a < b) of pictures of different classes that share MET words; rows: word, id, root. The pictures under a word are dealt
    into blocks of about MEETING; two blocks are one key of the join."""
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(MEETING)).cast("int").alias("blocks")
    mixed = rows.groupBy("word").agg(blocks, F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("word", "blocks")
    dealt = stored(rows.join(mixed, "word").withColumn("mine", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int")), "media-mixed")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("word", F.col("mine").alias("x"), every.alias("y"), F.col("id").alias("a"), F.col("root").alias("root_a"))
    right = dealt.select("word", every.alias("x"), F.col("mine").alias("y"), F.col("id").alias("b"), F.col("root").alias("root_b"))
    both = left.join(right, ["word", "x", "y"]).where("a < b and root_a <> root_b")
    return both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MET).select("a", "b")


def near_classes(pictures: DataFrame, near: int, votes: int) -> tuple[DataFrame, DataFrame]:
    """Of pictures (id, corners): (id, root) of those that are linked, and the ids that stand behind a hub.

    Links inside a class don't change it, so the pictures under one word don't all meet each other. A word's hub is
    the picture that a hash of the id puts first. First each picture meets the hub that it shares most words with, and
    stands behind it if they agree. Then of each class under a word the first picture meets those of the other classes.
    Last, all pictures of classes that are still different meet. So pictures that share MET words and agree are always of
    one class."""
    rank = F.struct(F.xxhash64("id").alias("rank"), "id")
    words = filed(pictures)
    hubs = words.groupBy("word").agg(F.min(rank).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("word", F.col("hub.id").alias("b"))
    shared = stored(words.join(hubs, "word"), "media-shared")
    of_hubs = shared.where("id <> b").groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MET)
    most = F.struct((-F.col("n")).alias("n"), F.xxhash64("b").alias("rank"), "b")
    of_hubs = stored(of_hubs.groupBy("a").agg(F.min(most).alias("hub")).select("a", F.col("hub.b").alias("b")), "media-met")
    links = stored(agreeing(of_hubs, pictures, pictures, near, votes, either=True), "media-links").select("a", "b")
    behind = links.select(F.col("a").alias("id")).distinct().join(links.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
    met = of_hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    labels = roots(links).select(F.col("sid").alias("id"), "root")
    for whole in (False, True):
        rows = shared.join(labels, "id", "left").select("word", "id", F.coalesce("root", "id").alias("root"))
        if not whole:
            rows = rows.groupBy("word", "root").agg(F.min(rank).alias("first")).select("word", F.col("first.id").alias("id"), "root")
        rest = stored(apart(rows).join(met, ["a", "b"], "left_anti"), "media-met")
        if rest.limit(1).count():
            links = links.union(stored(agreeing(rest, pictures, pictures, near, votes, either=True), "media-links").select("a", "b"))
            met = met.union(rest)
            labels = roots(links).select(F.col("sid").alias("id"), "root")
    return labels, behind


def class_hits(asking: DataFrame, pictures: DataFrame, linked: DataFrame, behind: DataFrame, near: int, votes: int) -> DataFrame:
    """a, root, votes: the classes that hold a picture which shares MET words and agrees with the asking picture a; linked and behind
    as near_classes gives them. votes are the most with a picture that stands behind none, and where none of these agrees the most
    with one behind a hub."""
    enough = F.col("n") >= MET
    asked = filed(asking).select(F.col("id").alias("a"), "word")
    rooted = lambda x: x.join(linked.select(F.col("id").alias("b"), "root"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    most = lambda x: rooted(x).groupBy("a", "root").agg(F.max("votes").alias("votes"))

    index = filed(pictures.join(behind, "id", "left_anti")).select(F.col("id").alias("b"), "word")
    met = index.join(asked, "word").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(enough)
    found = stored(most(agreeing(stored(met.select("a", "b"), "media-candidates"), asking, pictures, near, votes)), "media-found")

    # Classes are asked for as a whole before their pictures are: a query that a hub has answered meets none behind it.
    covered = filed(pictures.join(behind, "id")).select(F.col("id").alias("b"), "word")
    covered = stored(rooted(covered.join(asked.select("word").distinct(), "word", "left_semi")), "media-behind")
    open_ = covered.select("word", "root").distinct().join(asked, "word").groupBy("a", "root").agg(F.count(F.lit(1)).alias("n")).where(enough)
    open_ = open_.select("a", "root").join(found, ["a", "root"], "left_anti")
    met = covered.join(asked.join(open_, "a"), ["word", "root"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(enough)
    return found.union(most(agreeing(stored(met.select("a", "b"), "media-candidates"), asking, pictures, near, votes)))


def find_copies(queries: DataFrame, media: DataFrame, near: int = NEAR, votes: int = VOTES) -> tuple[DataFrame, DataFrame]:
    """Found: query_id, class_id, votes. Members: media_id, class_id, copies (rows of the class). Both inputs: id, width,
    height, pixels (one grey byte each). A class's name is the smallest id of its rows."""
    asked, asked_rows = classes(queries)
    stock, stock_rows = classes(media)
    points = stored(described(stock), "media-corners")
    asking = stored(described(asked), "media-asking")
    linked, behind = near_classes(points, near, votes)
    linked, behind = stored(linked, "media-linked"), stored(behind, "media-hidden")
    placed = stock_rows.join(linked, "id", "left").select("row_id", "copies", F.coalesce("root", "id").alias("root"))
    named = stored(placed.groupBy("root").agg(F.min("row_id").alias("class_id"), F.sum("copies").alias("copies")), "media-named")
    members = placed.drop("copies").join(named, "root").select(F.col("row_id").alias("media_id"), "class_id", "copies")

    best = class_hits(asking, points, linked, behind, near, votes).join(named.select("root", "class_id"), "root")
    found = asked_rows.select(F.col("row_id").alias("query_id"), F.col("id").alias("a")).join(best, "a").select("query_id", "class_id", "votes")
    return found, members


# Pictures of vectors: there is no image table, so Spark derives one from embeddings.

SIDE = 64


def _basis(width: int) -> np.ndarray:
    """One band-limited random pattern for each place of the vector."""
    rng = np.random.default_rng(77)
    noise = np.fft.fft2(rng.normal(size=(width, SIDE, SIDE)))
    f = np.hypot(*np.meshgrid(np.fft.fftfreq(SIDE), np.fft.fftfreq(SIDE)))
    band = np.exp(-(((f - 0.09) / 0.05) ** 2))
    waves = np.fft.ifft2(noise * band).real
    return (waves / waves.std((1, 2), keepdims=True)).reshape(width, -1).astype(np.float32)


def pictures(vectors: DataFrame, id_col: str, vector_col: str, edited: bool = False) -> DataFrame:
    """id, width, height, pixels: each vector drawn as a grey picture; edited: cropped, brightened and marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases: dict[int, np.ndarray] = {}
        for batch in batches:
            pixels, w, h = [], [], []
            for v in batch.column("v").to_pylist():
                if not v or any(c is None for c in v):
                    pixels.append(None), w.append(0), h.append(0)
                    continue
                if len(v) not in bases:
                    bases[len(v)] = _basis(len(v))
                x = np.array(v, np.float32) @ bases[len(v)]
                x = 127.5 + 80 * np.tanh(x / (x.std() + 1e-6)).reshape(SIDE, SIDE)
                if edited:
                    x = np.clip(x[5:59, 3:57] * 1.1 + 8, 0, 255)
                    x[40:50, 4:14] = 250
                pixels.append(x.astype(np.uint8).tobytes()), w.append(x.shape[1]), h.append(x.shape[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(w, pa.int32()), pa.array(h, pa.int32()), pa.array(pixels, pa.binary())],
                ["id", "width", "height", "pixels"],
            )

    # Drawing and describing cost far more than reading: small files would keep all of it in a few tasks.
    parts = shuffle_partitions(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")).repartition(parts, "id")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, width int, height int, pixels binary")
