"""Each operator against a plain version or a round trip, with nulls, empty and long texts, ties, repeats, empty tables and
columns whose names clash with an output's."""

import hashlib
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bloomline.llm import bpe, chat, html, jaccard, langid, media, packing, quality, warc
from bloomline.llm.common import scratch_path
from bloomline.llm.exact_dedup import exact_dedup
from bloomline.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, kept string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Repeats, ties, nulls, an empty and a long text, and columns named like outputs."""
    texts = ["same text", "same text", None, "", "  ", "Ünïcode ΑΣ 日本 <|endoftext|> it's", "x " * 30_000, "a b c", "a b c", "one"]
    rows = [(i, t, "mine", "clash") for i, t in enumerate(texts)] + [(0, "same text", "mine", "clash"), (None, "no id", "mine", "clash")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def awkward_texts(n=600, seed=3):
    rng = random.Random(seed)
    letters = "abcdefgh ijkl'sté ÀßΣσςİıŉ½²ª日本 \t\n\x1c ́<|>#@!0123٣👩‍👧ͅǅﬁ"
    some = ["", None, "a" * 700, "<|endoftext|>", "x<|startoftext|>y <|endoftext|>", "we'LL I'Re 's"]
    return some + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


# 3. BPE


@pytest.mark.parametrize("speculate", [True, False])
def test_bpe_pauses_the_collector_only_while_it_encodes(library, speculate, monkeypatch):
    import gc

    mine, during = bpe.WordBpe(tokenizer_path(), speculate), []
    learn = mine._learn
    monkeypatch.setattr(mine, "_learn", lambda chunks: (during.append(gc.isenabled()), learn(chunks)))
    texts = ["ends. here, it's so; x? (y) z) don't! a.. 1. é. don'. .", "'s, 's. we'll, ab) ''."]
    got = []
    for ids in mine.encode(texts):
        assert gc.isenabled()
        got.append(np.frombuffer(ids, "<u4").tolist())
    assert during == [False] and got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("speculate", [True, False])
def test_bpe_equals_the_library(library, speculate):
    mine = bpe.WordBpe(tokenizer_path(), speculate)
    texts = awkward_texts()
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert mine.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_pairs_are_compatible_exactly_where_bpe_keeps_them():
    mine = bpe.WordBpe(tokenizer_path())
    words = ["".join(random.Random(k).choices("thereandingxq", k=9)) for k in range(500)]
    for word, ids in zip(words, mine.merge(words), strict=True):
        assert mine.merge([word])[0] == ids
        flat = np.frombuffer(ids, "<u4").astype(np.int64)
        assert mine.compatible(flat[:-1], flat[1:]).all()


def test_bpe_operators(spark, odd, empty, library):
    got = bpe.bpe_decode(bpe.bpe_encode(odd, tokenizer_path()), tokenizer_path()).collect()
    assert len(got) == 12
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.decoded == library.decode(want, skip_special_tokens=False)
    digests = {(r.doc_id, r.n_tokens) for r in bpe.bpe_digests(odd, tokenizer_path()).collect()}
    assert (2, 0) in digests and len(digests) == 11
    assert bpe.bpe_digests(empty, tokenizer_path()).count() == 0


# 1. Packing


def test_balance_fills_exactly_and_evenly():
    rng = random.Random(1)
    lengths = [rng.randint(1, 900) for _ in range(500)]
    filled, rest = packing.balance(lengths, 2048, 1.0, 1 / 1024)
    assert all(sum(n for *_, n in pieces) == 2048 for pieces in filled)
    assert sum(n for *_, n in rest) == sum(lengths) % 2048
    seen = defaultdict(list)
    for k, start, n in [p for pieces in [*filled, rest] for p in pieces]:
        seen[k] += range(start, start + n)
    assert all(sorted(seen[k]) == list(range(lengths[k])) for k in range(500))
    costs = [sum(n + n * n / 1024 for *_, n in pieces) for pieces in filled]
    assert max(costs) < 2 * min(costs)


def test_packing(spark, odd, empty, library):
    pieces = packing.pack(odd, tokenizer_path(), capacity=64).collect()
    sequences, docs = defaultdict(list), Counter()
    for p in pieces:
        sequences[p.sequence_id].append(p)
        docs[p.doc_id, p.doc_tokens] += p.length
        assert len(p.ids) == 4 * p.length
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in ps])
        assert [p.offset for p in ps] == [0, *ends[:-1]] and (ends[-1] == 64 or ends[-1].bit_count() == 1)
    assert docs[2, 1] == 1 and sum(docs.values()) == sum(
        len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect()
    )
    long = sorted((p for p in pieces if p.doc_id == 6), key=lambda p: p.start)
    ids = np.frombuffer(b"".join(bytes(p.ids) for p in long), "<u4").tolist()
    assert ids == [*library.encode("x " * 30_000, add_special_tokens=False).ids, 1]
    assert packing.pack(empty, tokenizer_path()).count() == 0


# 8. Exact dedup


@pytest.mark.parametrize("hot", [256, 1])
def test_exact_dedup(spark, odd, empty, monkeypatch, hot):
    from bloomline.llm import exact_dedup as module

    monkeypatch.setattr(module, "MIN_HOT_ROWS", hot)
    rows = exact_dedup(odd).collect()
    groups = defaultdict(list)
    for r in odd.collect():
        groups[r.text or ""].append(r.doc_id)
    assert len(rows) == 12 and Counter(r.kept for r in rows)[True] == len(groups)
    for r in rows:
        ids = groups[r.text or ""]
        assert r.keep_id == max((i for i in ids if i is not None), default=None) and r.group_size == len(ids)
        assert r.text_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and r.score == "clash"
        assert not r.kept or r.doc_id == r.keep_id
    assert exact_dedup(empty).count() == 0
    smallest = {r.keep_id for r in exact_dedup(odd, keep="min").where("text = 'same text'").collect()}
    assert smallest == {0}


# 5. Jaccard join


def brute_groups(texts: dict[int, str | None]):
    import re

    sets = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(1, len(words)))))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited_texts(seed, families=12, copies=14):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefg", k=3)) for _ in range(300)]
    out = []
    for _ in range(families):
        base = rng.choices(words, k=rng.choice([3, 6, 40, 90]))
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(rng.choice([" ", "\n", "  "]).join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "slot"), [(1, 2_000), (2, 2_000), (3, 5)])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, seed, slot):
    monkeypatch.setattr(jaccard, "SLOT_ROWS", slot)
    texts = dict(enumerate([*edited_texts(seed), None, "", " \t", "A b", "a  B", "one two three four", "one two three four five six seven eight"]))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(df).collect()}
    assert got == brute_groups(texts)


@pytest.mark.parametrize(("slot", "block", "limit"), [(2_000, 1_000, 1_000_000), (5, 4, 0)])
def test_jaccard_counts_all_links(spark, monkeypatch, slot, block, limit):
    monkeypatch.setattr(jaccard, "SLOT_ROWS", slot)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    base = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    near = [" ".join([*base[:k], f"x{j}", *base[k + 1 :]]) for j, k in enumerate(rng.sample(range(200), 25))]
    texts = dict(enumerate([*edited_texts(4), " ".join(base), *near, near[0], "", None]))
    sets = {i: frozenset(jaccard.shingles(t, 5).tolist()) for i, t in texts.items()}
    different = {s for s in sets.values() if s}
    want = {s: sum(s != o and 100 * len(s & o) >= 80 * len(s | o) for o in different) for s in different}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.n_links for r in jaccard.jaccard_groups(df).collect()}
    assert got == {i: want.get(s, 0) for i, s in sets.items()}
    assert sum(n >= 25 for n in got.values()) >= 26
    assert {r.n_links for r in jaccard.jaccard_groups(df, links=False).collect()} == {None}


def test_jaccard_odd_tables(spark, odd, empty):
    rows = jaccard.jaccard_groups(odd).collect()
    assert len(rows) == 12 and {r.component_id for r in rows if r.doc_id in (0, 1)} == {0}
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id == 2} == {(0, 2)}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert jaccard.jaccard_groups(empty).count() == 0


# 6. Chat


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "system", "be <<SYS>> kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "\\</s> é\n"),
        (2, 0, "assistant", None), (2, 0, "assistant", None), (3, 5, "tool", "x\ny"), (3, 6, None, "z"), (4, 1, "user", "a" * 100_000),
        (4, 2, "user", "twice"), (None, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [r[2:] for r in rows[:3]]
    assert got[1].valid and got[1].loss_text == "\\</s> é\n"
    assert [(t.role, t.text) for t in got[3].turns] == [("tool", "x\ny"), ("", "z")] and not got[3].valid
    assert got[2].n_turns == 2 and got[2].bad_turn == 0 and got[2].loss_text == ""
    assert got[4].bad_turn == 1 and got[4].turns[0].text == "a" * 100_000
    assert got[None].n_turns == 1
    assert all(r.formatted == "".join(s.text for s in r.segments) for r in got.values())
    assert chat.format_chats(df.where("false")).count() == 0


# 2 and 4. Classifiers


def test_quality_on_held_out_rows(spark, sf_dir):
    from bloomline.llm.queries import op2_quality

    rows = op2_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    assert sum(right) / len(right) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_quality_odd_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.train(odd, none)
    rows = quality.score(odd, model).collect()
    assert len(rows) == 12 and {round(r.score, 3) for r in rows} == {0.5} and rows[0].kept == "mine"
    few = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    assert quality.score(odd, quality.train(odd, few)).where("score between 0 and 1").count() == 12
    assert quality.score(empty, model).count() == 0


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (2_000, 5)), rng.normal(-1, 1, (1_000, 5))
    w, mean, scale = quality.fit_pu(good[:800].astype(np.float32), np.r_[good[800:], bad].astype(np.float32), 0.55)
    out = lambda x: ((x - mean) / scale) @ w[:-1] + w[-1]
    assert (out(good) > np.median(out(bad))).mean() > 0.95


def test_language_on_held_out_rows(spark):
    from bloomline.llm.queries import op4_langid

    sf = "/root/testdata/sf0.01"
    rows = op4_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)


def test_language_odd_tables(spark, odd, empty):
    learn = odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") == 7, "bb"))
    model = langid.train(learn)
    rows = {(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).collect()}
    assert {(2, "und"), (3, "und"), (4, "und")} <= rows and {p for _, p in rows} <= {"und", "aa", "bb"}
    nothing = langid.train(learn.where("false"))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


# 7. HTML


def test_blocks_of_broken_markup():
    page = '<p>a<p>b <i>c</i>d<br>e &amp; &lt;x&gt; &nbsp; f</div><ul><li>1<li>2</ul><script>"</p>"</script><!-- x'
    assert [b[2] for b in html.branches(page)] == ["a", "b cd e & <x> f", "1", "2"]
    assert html.branches(None) == [] and html.branches("") == []


PAGE = (
    '<html><body><nav><a href="/">Menu {h}</a></nav><div class="box">Buy now from {h}</div><div class="body"><p>{a}</p><p>{b}</p></div>'
    "<article><p>Kept &eacute; {a}</p><div class='comments'>no</div></article><footer>foot</footer></body></html>"
)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_site_style_tree_removes_templates(spark, limit):
    rng = random.Random(5)
    words = lambda: " ".join(rng.choices(["ab", "cd", "ef", "gh", "ij"], k=8))
    pages = [(k, f"http://h{k % 2}.example.com/{k}", PAGE.format(h=k % 2, a=f"{words()} {k}", b=f"{words()} x{k}")) for k in range(12)]
    pages += [(3, pages[3][1], pages[3][2]), (50, None, None), (51, "http://h0.example.com/x", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("text", F.lit("clash")).repartition(3)
    rows = html.main_text(df, broadcast_branches=limit).collect()
    assert len(rows) == 15
    for r in rows:
        if r.html:
            lines = r.text.split("\n")
            assert len(lines) == 3 and lines[2] == f"Kept é {lines[0]}" and "Buy" not in r.text and "Menu" not in r.text
        else:
            assert r.text == ""
    assert html.main_text(df.where("false")).count() == 0


def kept(page):
    return [text for kind, _, text in html.branches(page) if kind == html.KEEP]


@pytest.mark.parametrize(
    "around",
    ["div class='layout has-sidebar'", "div class='no-sidebar'", "div class='social-history'", "div class='search-results'", "div class='main-widget'",
     "div class='search sidebar'", "div id='overlay'", "form id='aspnetForm'", "div class='page-header'"],
)
def test_layout_around_an_article_is_no_hint(around):
    rest = "<div class='sidebar'>side</div><div class='related-posts'><article>teaser</article></div>"
    for tag in ("article", "main"):
        text = f"<h2 id='related-work'>One</h2><h2 id='search'>Two</h2><p>three</p><div class='comment-list'><article class='comment'>reply</article></div>"
        page = f"<body><{around}><{tag}>{text}</{tag}>{rest}</{around.split()[0]}><nav><article>menu</article></nav></body>"
        assert kept(page) == ["One", "Two", "three"], around
    assert kept("<body><article class='post social'><p>text</p></article></body>") == ["text"]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_style_tree_decides_inside_articles(spark, limit):
    box = "<div class='x7'><p>Written by the staff</p></div><ul class='x8'><li><a href='/'>Latest news</a></li></ul>"
    page = "<body><article><p>{a}</p>{box}</article></body>"
    rows = [(k, f"http://many/{k}", page.format(a=f"text {k}", box=box)) for k in range(6)]
    rows += [(10 + k, f"http://few/{k}", page.format(a=f"other {k}", box=box)) for k in range(2)]
    # Printed versions of one article: all its branches repeat, and it stays.
    rows += [(20 + k, f"http://same/{k}", f"<body><nav>{k}</nav><article><p>one</p><p>two</p></article></body>") for k in range(5)]
    # Links only, but new on each page: no template.
    rows += [(30 + k, f"http://links/{k}", f"<body><div class='y'><a href='/'>link {k}</a></div><p>word {k}</p></body>") for k in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text.split("\n") for r in html.main_text(df, broadcast_branches=limit).collect()}
    assert all(got[k] == [f"text {k}"] for k in range(6))
    assert all(got[10 + k] == [f"other {k}", "Written by the staff", "Latest news"] for k in range(2))
    assert all(got[20 + k] == ["one", "two"] and got[30 + k] == [f"link {k}", f"word {k}"] for k in range(5))


# 9. Media


def drawn(vectors):
    rows = vectors.select("id", "width", "height", "pixels").toPandas()
    return [np.frombuffer(p, np.uint8).reshape(h, w) if p else np.zeros((0, 0), np.uint8) for w, h, p in zip(rows.width, rows.height, rows.pixels, strict=True)]


def packed_corners(images):
    out = []
    for image in images:
        d = media.describe(image[None])
        corners = np.zeros(len(d["image"]), media.CORNER)
        corners["w"] = d["words"]
        for name in ("x", "y", "scale", "angle"):
            corners[name] = d[name]
        out.append(corners)
    return out


def test_media_recall_against_brute_force(spark):
    """Every 50th picture of a table with groups of near copies, its edited copy held against all pictures."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(120, 32))
    vectors = np.concatenate([centres, centres[7] + 0.15 * rng.normal(size=(80, 32)), centres[:40] + 0.15 * rng.normal(size=(40, 32))])
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3).cache()
    asked = media.pictures(df.where("vec_id % 10 = 0"), "vec_id", "embedding", edited=True)
    stock = media.pictures(df, "vec_id", "embedding")
    found, members = (x.collect() for x in media.find_copies(asked, stock))
    class_of = {r.media_id: r.class_id for r in members}
    assert sorted(class_of) == list(range(240))
    assert max(Counter(class_of.values()).values()) >= 60  # the group is one class, not a row per pair
    hits = {(r.query_id, r.class_id) for r in found}
    sides = [(x.select("id").toPandas().id.tolist(), packed_corners(drawn(x))) for x in (asked, stock)]
    pairs = [(q, m) for q, a in zip(*sides[0], strict=True) for m, b in zip(*sides[1], strict=True) if media.agreement(a, b, media.NEAR) >= media.VOTES]
    assert len(pairs) > 24
    assert sum((q, class_of[m]) in hits for q, m in pairs) / len(pairs) >= 0.9
    # Nothing is put together that is unlike: members of a class come from one centre.
    origin = lambda k: k if k < 120 else 7 if k < 200 else k - 200
    assert all(origin(m) == origin(c) for m, c in class_of.items())


def ranked(spark, ids):
    """The ids as hubs are chosen: those that come first are hubs."""
    return [r.id for r in spark.createDataFrame([(i,) for i in ids], "id bigint").orderBy(F.xxhash64("id")).collect()]


def made_corners(n, seed):
    rng = np.random.default_rng(seed)
    out = np.zeros(n, media.CORNER)
    out["w"] = rng.integers(-(2**62), 2**62, (n, 4))
    out["x"], out["y"] = rng.uniform(0, 64, (2, n))
    out["scale"] = 1
    return out


def test_media_links_of_pictures_that_agree_with_no_hub(spark):
    """A word's hub hides no link: neither of two pictures that share no hub, nor of one behind the first of its class."""
    ids = ranked(spark, range(40))
    common, own = made_corners(12, 1), iter(made_corners(200, 2).reshape(-1, 5))
    pack = lambda *parts: np.concatenate([*parts, next(own)]).tobytes()
    # Each word of the pair's six corners has a hub that shares no other with them.
    rows = [(ids[k], pack(common[k : k + 1])) for k in range(6)] + [(ids[38], pack(common[:6])), (ids[39], pack(common[:6]))]
    labels, _ = media.near_classes(spark.createDataFrame(rows, "id bigint, corners binary"), media.NEAR, media.VOTES)
    assert {(r.id, r.root) for r in labels.collect()} == {(i, min(ids[38:])) for i in ids[38:]}
    # Those that come first under the words of the last picture are of the other's class, but don't agree with it.
    inside, across = common[:5], common[6:10]
    rows = [(ids[k], pack(inside, across[k : k + 1])) for k in range(4)] + [(ids[20], pack(inside, across)), (ids[30], pack(across))]
    labels, _ = media.near_classes(spark.createDataFrame(rows, "id bigint, corners binary"), media.NEAR, media.VOTES)
    assert {r.root for r in labels.collect()} == {min(i for i, _ in rows)} and labels.count() == 6


@pytest.mark.parametrize("meeting", [1_000, 2])
def test_media_classes_are_the_components_of_all_links(spark, monkeypatch, meeting):
    monkeypatch.setattr(media, "MEETING", meeting)
    rng = np.random.default_rng(8)
    common = made_corners(30, 3)
    sets = {k: np.concatenate([common[rng.choice(30, 7, False)], made_corners(4, 100 + k)]) for k in range(40)}
    df = spark.createDataFrame([(k, c.tobytes()) for k, c in sets.items()], "id bigint, corners binary").repartition(3)
    labels, behind = media.near_classes(df, media.NEAR, media.VOTES)
    root = {k: k for k in sets} | {r.id: r.root for r in labels.collect()}
    agree = lambda p, q: max(media.agreement(p, q, media.NEAR), media.agreement(q, p, media.NEAR)) >= media.VOTES
    linked = [(a, b) for a in sets for b in range(a) if agree(sets[a], sets[b])]
    want = {k: k for k in sets}
    for _ in sets:
        for a, b in linked:
            want[a] = want[b] = min(want[a], want[b])
    assert linked and len(set(want.values())) > 1 and root == want
    # A search finds every class that holds an agreeing picture, also where that stands behind a hub.
    hits = {(r.a, r.root) for r in media.class_hits(df, df, labels, behind, media.NEAR, media.VOTES).collect()}
    assert hits == {(a, root[b]) for a in sets for b in sets if media.agreement(sets[a], sets[b], media.NEAR) >= media.VOTES}


def test_media_query_that_agrees_only_behind_a_hub(spark, monkeypatch):
    """Two pictures of one class; the query agrees with the one that stands behind the other."""
    names = spark.createDataFrame([(k, 1, 1, bytes([k])) for k in range(3)], "id bigint, width int, height int, pixels binary")
    id_of = {r.id: r.row_id for r in media.classes(names)[1].select("id", "row_id").collect()}
    hub, member = [id_of[i] for i in ranked(spark, id_of) if id_of[i] < 2]
    inside, across = made_corners(5, 1), made_corners(6, 2)
    corners = {hub: inside, member: np.concatenate([inside, across]), 2: across}
    known = spark.createDataFrame([(bytes([k]), c.tobytes()) for k, c in corners.items()], "pixels binary, corners binary")
    monkeypatch.setattr(media, "described", lambda df: df.join(known, "pixels").select("id", "corners"))
    found, members = media.find_copies(names.where("id = 2"), names.where("id < 2"))
    assert {r.class_id for r in members.collect()} == {0} and [tuple(r) for r in found.collect()] == [(2, 0, 6)]


def test_media_finds_turned_and_resized_copies(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(k, rng.normal(size=32).tolist()) for k in range(30)], "vec_id bigint, embedding array<double>")
    images = drawn(media.pictures(df, "vec_id", "embedding"))
    for change in (np.rot90, lambda x: media._resized(x[None].astype(np.float32), 1.41)[0].astype(np.uint8)):
        pairs = zip(packed_corners([np.ascontiguousarray(change(x)) for x in images]), packed_corners(images), strict=True)
        assert sum(media.agreement(a, b, media.NEAR) >= media.VOTES for a, b in pairs) >= 27


def test_media_odd_tables(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=16).tolist(), "x") for k in range(30)] + [(30, None, "x"), (31, [], "x"), (None, [1.0] * 16, "x")]
    rows += [(32, rows[7][1], "x"), (32, rows[7][1], "x"), (3, rows[9][1], "x")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, class_id string").repartition(3)
    stock = media.pictures(vectors, "vec_id", "embedding")
    asked = media.pictures(vectors.where("vec_id % 3 = 1"), "vec_id", "embedding", edited=True)
    results = []
    for limit in (1_000_000, 0):
        monkeypatch.setattr(media, "BROADCAST_ROWS", limit)
        found, members = (x.collect() for x in media.find_copies(asked, stock))
        results.append((sorted(map(tuple, found)), sorted(map(tuple, members))))
    assert results[0] == results[1]
    assert {(r.media_id, r.class_id, r.copies) for r in members if r.media_id in (7, 32)} == {(7, 7, 3), (32, 7, 3)}
    assert {r.class_id for r in members if r.media_id in (30, 31)} == {30}  # both without pixels
    assert sorted(r.class_id for r in members if r.media_id in (3, 9)) == [3, 3, 3]  # 3 has two pictures, one is that of 9
    none, every = media.find_copies(asked.where("false"), stock.where("false"))
    assert none.count() == 0 and every.count() == 0


# 10. WARC


def test_warc_round_trip(spark):
    big = "<p>" + "y" * 200_000 + "</p>"
    rows = [(5, "http://a/\r\nb", big), (3, "http://b", big), (9, None, "z" * 100), (8, "u", "z" * 100), (7, "u", "short"), (6, "u", "short"), (4, "u", None), (None, "u", "é" * 80)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash")).repartition(2)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(df, path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == 8 and all(r.reason is None for r in got)
    by = {r.record_id: r for r in got}
    assert by["5"].record_type == "revisit" and by["5"].refers_to == "3" and by["5"].payload_bytes == len(big)
    assert by["9"].refers_to == "8" and by["7"].record_type == by["6"].record_type == "response" and by["4"].payload_bytes == 0
    assert bytes(by["3"].payload).decode() == big and by[None].payload_digest == hashlib.sha256(("é" * 80).encode()).hexdigest()
    warc.write_warc(df.where("false"), path + "-none")
    assert warc.read_warc(spark, path + "-none").count() == 0


def test_warc_same_id_with_several_payloads(spark):
    a, b, c = ("abc"[k] * 150 for k in range(3))
    rows = [(3, a), (7, a), (7, b), (7, "short"), (4, c), (7, c)]
    df = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("url", F.lit("u")).repartition(3)
    path = scratch_path(spark, "warc-ids")
    warc.write_warc(df, path)
    got = Counter((r.record_id, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in warc.read_warc(spark, path).collect())
    assert got == Counter(
        [("3", "response", None, a), ("7", "revisit", "3", ""), ("7", "response", None, b), ("7", "response", None, "short"),
         ("4", "response", None, c), ("7", "revisit", "4", "")]
    )


def records(n):
    return [warc._record(k, "http://x", f"payload {k} WARC/1.1\r\n".encode(), hashlib.sha256(f"payload {k} WARC/1.1\r\n".encode()).hexdigest(), None, "d") for k in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_skips_damage_and_logs_gaps(packed):
    parts = [warc._member(r) if packed else r for r in records(6)]
    damaged = bytearray(parts[2])
    middle = len(damaged) // 2
    damaged[middle : middle + 6] = b"\x00\xff\x00\xff\x00\xff"
    raw = b"junk" + parts[0] + parts[1] + bytes(damaged) + b"more junk" + parts[3] + parts[4] + parts[5][:-30]
    out = list(warc.salvage(raw))
    good = [r[3]["record_id"] for r in out if r[3]]
    assert {"0", "1", "3", "4"} <= set(good) and "5" not in good and "2" not in good
    assert any(r[3] is None and r[2] for r in out)


def plain_record(kind, block, media=None, **fields):
    head = ["WARC/1.0", f"WARC-Type: {kind}", *([f"Content-Type: {media}"] if media else []), f"Content-Length: {len(block)}"]
    head += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_salvage_reads_records_of_ordinary_archives():
    import base64

    http, body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n", b"one\r\n\r\ntwo"
    sha1 = hashlib.sha1(body).digest()
    chunked = http.replace(b"A: b", b"Transfer-Encoding: chunked")
    block = b"first: 1\r\n\r\nsecond: 2"
    cases = [
        ("response", http + body, "application/http; msgtype=response", f"sha1:{base64.b32encode(sha1).decode()}", body),
        ("response", http + body, "application/http", f"SHA1:{sha1.hex()}", body),
        ("response", http + body, "application/http", "blake3:whatever", body),
        ("response", chunked + b"c\r\none\r\n\r\ntwo0\r\n\r\n0\r\n\r\n", "application/http", None, b"c\r\none\r\n\r\ntwo0\r\n\r\n0\r\n\r\n"),
        ("response", chunked + b"a\r\none\r\n\r\ntwo\r\n0\r\n\r\n", "application/http", f"sha256:{hashlib.sha256(body).hexdigest()}", b"a\r\none\r\n\r\ntwo\r\n0\r\n\r\n"),
        ("warcinfo", block, "application/warc-fields", None, block), ("metadata", block, None, None, block),
        ("resource", block, "text/plain", f"sha256:{hashlib.sha256(block).hexdigest()}", block), ("conversion", b"text", "text/plain", None, b"text"),
    ]
    raw = b"".join(plain_record(k, b, m, **({"WARC_Payload_Digest": d} if d else {})) for k, b, m, d, _ in cases)
    for form in (raw, warc._member(raw)):
        out = list(warc.salvage(form))
        assert [(r[2], r[3]["record_type"], r[3]["payload"]) for r in out] == [(None, k, p) for k, _, _, _, p in cases]
    wrong = plain_record("response", http + b"bad", "application/http", WARC_Payload_Digest=f"sha1:{base64.b32encode(sha1).decode()}")
    assert [r[3] for r in warc.salvage(wrong)] == [None]


def test_salvage_keeps_records_before_the_failure_of_a_member():
    whole = warc._member(b"".join(records(2_000)))
    cut = list(warc.salvage(b"junk" + whole[: len(whole) // 2] + warc._member(records(3)[2])))
    good = [r[3]["record_id"] for r in cut if r[3] and not r[2]]
    assert len(good) > 800 and good[:-1] == [str(k) for k in range(len(good) - 1)] and good[-1] == "2"
    assert [r[2] for r in cut if r[3] is None][0] == "no member or version line" and [r[2] for r in cut if r[3] is None][1:] == ["cut member"]
    ended = list(warc.salvage(whole[: len(whole) // 2]))
    assert len([r for r in ended if r[3] and not r[2]]) > 800 and [r[2] for r in ended if r[3] is None] == ["cut member"]
    # Only the checksum fails: no record is sure, none is lost.
    flipped = list(warc.salvage(whole[:-8] + bytes(8)))
    assert [r[3]["record_id"] for r in flipped if r[3]] == [str(k) for k in range(2_000)] and all(r[2] for r in flipped)


def test_warc_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rng = random.Random(1)
    rows = [(k, "".join(rng.choices("0123456789abcdef", k=8_000))) for k in range(40)]
    path = scratch_path(spark, "warc-files")
    warc.write_warc(spark.createDataFrame(rows, "page_id bigint, html string").withColumn("url", F.lit("u")), path)
    files = spark.read.format("binaryFile").load(path).select("length").collect()
    assert len(files) > 5 and max(f.length for f in files) < 30_000
    assert {(int(r.record_id), bytes(r.payload).decode()) for r in warc.read_warc(spark, path).collect()} == set(rows)


def test_pipeline_equals_its_stages(spark, sf_dir, library):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "exact_dedup", "near_dedup", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        texts = {r.doc_id: r.text for r in kept.collect()}
        assert set(texts) <= set(before) and kept.columns == docs.columns
        if name == "exact_dedup":
            assert set(texts) == {max(i for i in before if before[i] == t) for t in set(before.values())}
        if name == "near_dedup":
            assert set(texts) == {i for i, (_, root) in brute_groups(before).items() if i == root}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc, parts in pieces.items():
        want = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        parts.sort(key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in parts) == np.array(want, "<u4").tobytes()
        assert {r.doc_tokens for r in parts} == {len(want)}


def test_near_dedup_keeps_one_row_of_each_group(spark, empty):
    import corpus_pipeline

    rng = random.Random(9)
    base = [f"w{rng.randrange(10_000)}" for _ in range(80)]
    near = lambda k: " ".join([*base[:-1], f"end{k}"])
    clean = [" ".join(f"c{k}x{j}" for j in range(30)) for k in range(3)]
    # Id 5 has a near copy of id 1's text and two clean texts; id 1 has two texts of one group; null ids have texts as well.
    rows = [(1, near(0)), (1, near(1)), (5, near(2)), (5, clean[0]), (5, clean[1]), (None, near(3)), (None, clean[2]), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near(spark, df, "").collect()]
    in_group = [r for r in got if (r[1] or "").startswith(base[0])]
    assert len(in_group) == 1 and in_group[0] in rows[:2]
    rest = Counter(r for r in got if r not in in_group)
    assert rest == Counter(rows[3:5] + rows[6:])
    assert corpus_pipeline.drop_near(spark, empty, "").count() == 0


def test_pipeline_keeps_columns_and_takes_odd_tables(spark, tmp_path):
    """Columns named like an operator's output come through every stage; nulls, repeats and empty tables don't fail."""
    import corpus_pipeline as pipeline

    rng = random.Random(8)
    words = "the of and to in that it was for on as with his they be at one have this from".split()
    texts = [" ".join(rng.choices(words, k=60)) + "." for _ in range(40)] + [None, "", "x"]
    rows = [(k, t, "en", 9, "mine", "mine", "mine", "mine") for k, t in enumerate(texts)] + [(None, texts[0], None, 1, "mine", "mine", "mine", "mine"), (3, texts[3], "en", 9, "mine", "mine", "mine", "mine")]
    schema = "doc_id bigint, text string, lang string, n_chars int, score string, rejected string, keep_id string, kept string"
    labels = [(k, 1 if k < 40 else 0, 0) for k in range(43)]
    for name, some in (("full", rows), ("empty", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels if some else [], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            assert {r.score for r in out.select("score").distinct().collect()} <= {"mine"}
            assert {r.kept for r in out.select("kept").distinct().collect()} <= {"mine"}
        packed = pipeline.run(spark, folder).collect()
        assert (len(packed) > 0) == bool(some)
        assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in packed)


@pytest.mark.parametrize("broken", ["<script ", "<a ", '<a "', "<a '\"", '</a "', "<!", "<script></script ", '"<a >', "<svg/ "])
def test_html_reads_long_broken_markup_once(broken):
    began = time.perf_counter()
    html.branches(broken * (100_000 // len(broken)))
    assert time.perf_counter() - began < 1


def test_html_keeps_article_text_under_any_name():
    page = (
        '<article><p class="search">about search</p><p class="social">social</p><div class="recommended"><p>dosage</p></div>'
        '<section id="comments">on the law</section><p>x</p><math><mi>y</mi><mo>=</mo><mn>2</mn></math><xmp>code</xmp><object>a plan</object></article>'
    )
    assert [t for kind, _, t in html.branches(page) if kind == html.KEEP] == [
        "about search", "social", "dosage", "on the law", "x", "y=2", "code", "a plan",
    ]


def test_samples_are_exact_at_any_number_of_rows(spark):
    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    assert rows.where(quality.at_most(F.col("h"), 1_000, 200_000)).count() in range(850, 1150)
    assert rows.where(quality.at_most(F.col("h"), 10, 5)).count() == 200_000
    # Four thousand of 10^13 rows: the share is far below a millionth, and yet not nothing.
    bound = 4_000 * 2**63 // 10**13
    assert 0 < bound / 2**63 * 10**13 / 4_000 <= 1


def test_language_without_a_sample_is_no_model(spark):
    docs = spark.createDataFrame([(1, "some words", "en")], "doc_id bigint, text string, lang string")
    assert langid.predict(docs, langid.train(docs, sample=0)).first().lang_pred == "und"


def test_corners_of_large_pictures_meet_in_blocks(monkeypatch):
    found = media.describe(np.random.default_rng(3).integers(0, 255, (1, 128, 128)).astype(np.uint8))
    corners = np.zeros(len(found["image"]), media.CORNER)
    corners["w"] = found["words"]
    for name in ("x", "y", "scale", "angle"):
        corners[name] = found[name]
    whole = media.agreement(corners, corners, media.NEAR)
    monkeypatch.setattr(media, "BLOCK", 7)
    assert len(corners) > 50 and media.agreement(corners, corners, media.NEAR) == whole == len(corners)


def test_two_large_pictures_fit_into_a_task():
    """2048 x 2048: tens of thousands of corners, compared within some hundred MB (a table of all pairs would take 26 GB)."""
    many = np.zeros(28_000, media.CORNER)
    many["w"] = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (len(many), 4))
    many["scale"], many["x"], many["y"] = 1, *np.random.default_rng(2).uniform(0, 2048, (2, len(many)))
    tracemalloc.start()
    assert media.agreement(many[:2_000], many, media.NEAR) == 2_000
    assert tracemalloc.get_traced_memory()[1] < 600e6
    tracemalloc.stop()


def test_a_cluster_must_name_the_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    from bloomline.llm.common import shared_dir

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
