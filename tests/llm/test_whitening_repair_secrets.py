"""Whitening against numpy's eigenvectors, repair against a plain search of all edits, secret scans against the patterns alone."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from bloomline.llm import queries, repair, secrets, whitening

# 11. Whitening


def plain_whitening(rows, components=16):
    x = {i: np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for i, v in rows}
    different = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(different), different.sum(0)
    centred = (n * different - sums) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return {i: (((n * r - sums) ** 2).sum(), ((n * r - sums) / n) @ vectors / np.sqrt(values)) for i, r in x.items()}, n, values / np.trace(v)


def test_whitening_equals_the_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(24) * np.linspace(1, 4, 24)).tolist()) for i in range(300)]
    rows += [(1000 + i, v) for i, v in rows[:90]]
    odd = [(2000, None), (2001, []), (2002, [None] + [0.0] * 23), (2003, [float("nan")] * 24), (2004, [float("inf")] * 24), (2005, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "mine") for i, v in rows + odd], "vec_id bigint, v array<float>, deviation string").repartition(3)
    model = whitening.fit(df, "v")
    got = {r.vec_id: r for r in whitening.apply(df, "v", model).collect()}
    want, n, explained = plain_whitening([(i, np.float32(v)) for i, v in rows])
    assert got.keys() == want.keys() and model.n == n == 300 and model.identity_error < 1e-9
    assert np.allclose(np.array(model.values) / model.trace, explained, rtol=1e-12)
    mine, plain = (np.array([w for _, w in sorted(d.items())]) for d in ({i: r.whitened for i, r in got.items()}, {i: w for i, (_, w) in want.items()}))
    assert np.allclose(mine, plain * np.sign((mine * plain).sum(0)), atol=1e-8)
    assert all(got[i].deviation == d for i, (d, _) in want.items())


@pytest.mark.parametrize("rows", [[], [[1.0, 2.0]] * 5, [[1.0, 2.0], [3.0, 2.0]], [[1e12, 0.0], [-1e12, 0.0], [0.0, 1e-3]]])
def test_whitening_of_few_or_equal_vectors(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id bigint, v array<double>")
    model = whitening.fit(df, "v")
    got = whitening.apply(df, "v", model).collect()
    assert len(got) == len(rows) and all(len(r.whitened) == len(model.values) for r in got)
    assert len(model.values) <= max(len({tuple(r) for r in rows}) - 1, 0) and model.identity_error < 1e-6


def test_equal_eigenvalues_and_counts_by_inertia(spark):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    v = q @ np.diag([5.0] * 20 + [1.0] * 19 + [0.0]) @ q.T
    v = (v + v.T) / 2
    assert [whitening.below(v, s) for s in (-1, 0.5, 2, 6)] == [0, 1, 20, 40]
    values, vectors = whitening.leading_eigenpairs(spark.range(1), v, 22)
    assert np.allclose(values, [5.0] * 20 + [1.0] * 2) and np.allclose(vectors @ vectors.T, np.eye(22), atol=1e-10)
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12


# 12. Conversation repair


def cheapest_edits(rows):
    """Every edit and any insertions tried left to right, with whole audits and whole outputs."""
    faults, seen = [], set()
    for _, role, text in rows:
        whole = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not whole else "duplicate" if (role, text) in seen else "truncated" if whole[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def reach(ways, place, way):
        if place is not None and (place not in ways or way[:2] < ways[place][:2]):
            ways[place] = way

    def inserted(ways):
        for _ in range(3):
            for place, (cost, audit, out) in list(ways.items()):
                for role in ("user", "assistant"):
                    reach(ways, step.get((place, role[0])), (cost + 5, audit + "I", (*out, (role, ""))))
        return ways

    ways = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for place, (cost, audit, out) in inserted(ways).items():
            reach(after, place, (cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                paid = cost + 5 * (fault == "truncated")
                reach(after, step.get((place, role[:1])) if role else None, (paid, audit + "K", (*out, (role, text))))
                for other in ("user", "assistant"):
                    reach(after, step.get((place, other[0])), (paid + 1, audit + "R", (*out, (other, text))))
        ways = after
    cost, audit, out = min(way for place, way in inserted(ways).items() if place in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        found = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def assert_repaired(got, rows):
    got = {r.conv_id: r.asDict() for r in got}
    assert got == {c: {"conv_id": c, **cheapest_edits(v)} for c, v in damaged(rows).items()}


def test_repair_of_odd_conversations_is_the_cheapest(spark):
    rng = random.Random(5)
    some = ["a.", "b?", "open", "", "  ", None, "long one!\n", "é。", "dots... "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u"]
    rows = []
    for conv in range(260):
        for turn in range(1300 if conv == 0 else rng.choice([1, 2, 3, 5, 8, 13])):
            text = f"w{rng.randint(0, 60)}." if rng.random() < 0.6 else rng.choice(some)
            rows.append((None if conv == 7 else conv, rng.choice([None, turn, turn, turn, 3]), rng.choice(roles), text))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, audit string")
    assert_repaired(repair.digests(repair.repair(repair.damage(df.repartition(3)))).collect(), rows)


def test_repair_query_equals_plain_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert_repaired(queries.op12_repair(spark, sf_dir).collect(), rows)


def test_repair_gives_turns_and_keeps_empty_conversations(spark):
    schema = "conv_id string, turn bigint, role string, text string, dropped boolean"
    rows = [("a", 1, "user", "hi.", False), ("a", 2, "user", "what?", False), ("a", 3, "assistant", "so.", False), ("b", 1, "user", "x.", True)]
    got = repair.repair(spark.createDataFrame(rows, schema)).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.place, r.role, r.text, r.edit) for r in got if r.place] == [
        ("a", 1, "user", "what?", "K"), ("a", 2, "assistant", "so.", "K"),
    ]
    assert [(r.conv_id, r.audit, r.cost) for r in got if not r.place] == [("a", "DKK", 2), ("b", "", 0)]
    assert repair.repair(spark.createDataFrame([], schema)).count() == 0


def test_rules_share_matrices_and_change_nothing(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("AEIDHLMP") for _ in range(rng.randint(1, 60))) for _ in range(80)]
    strings = spark.createDataFrame([(t, 1) for t in texts], "string string, times bigint")
    grammar = repair.learn_grammar(strings)
    assert len(grammar.rules) > 10
    with_rules, without_rules = (
        {r.string: (r.cost, r.audit) for r in repair.solve_strings(strings, g).collect()} for g in (grammar, repair.Grammar())
    )
    assert with_rules == without_rules


# 13. Secrets


def plain_scan(text):
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        out += [(m.start(), 0, "assign", m.end())] if len(m.group(1)) >= 6 else []
    for place, (kind, pattern, least) in enumerate([("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)], 1):
        out += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


def secret_texts(n=400, seed=4):
    rng = random.Random(seed)

    def credential(kind):
        if kind == "access":
            return "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
        return "".join(rng.choices("0123456789abcdef", k=40 if kind == "hex" else 18))

    words = ["thing", "internationalisation", "éaux", "über", "日本", "understandings", "2024-01-02", "a/b/c.txt"]
    out = [None, "", "token=abc", "API_KEY: 'x.y-z/1'", "toKen==abcdef", "ſecret=abcdefg", "AKIA" * 9, "secret : token = 12345678"]
    for _ in range(n):
        body = rng.choices(words, k=10) + ["".join(rng.choices(("tion", "and", "er", "ing", "the", "un", "re"), k=5)) for _ in range(20)]
        body[3] = f"password={credential('assign')}"
        body[9] = credential("access")
        body[15] = f'token = "{credential("hex")}"'
        out.append(" ".join(body))
    return out, credential


def test_scan_keeps_plain_spans_and_adds_like_formats(spark):
    texts, credential = secret_texts()
    bare = [f"éé see {credential('assign')} and understandings/internationalisation" for _ in range(40)]
    schema = "doc_id bigint, text string, spans string"
    docs = spark.createDataFrame([(i % 50, t, "clash") for i, t in enumerate(texts + bare)], schema).repartition(3)
    formats = secrets.fit(secrets.samples(docs))
    assert formats.kinds.keys() == {"assign", "access", "hex"}
    got = secrets.scan(docs, formats).collect()
    assert len(got) == len(texts + bare)
    for r in got:
        spans = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans]
        assert [s for s in spans if not s.startswith("format")] == plain_scan(r.text or "")
    added = {r.text: [(s.start, s.end) for s in r.spans if s.kind == "format"] for r in got}
    assert sum(added[t] == [(7, 25)] for t in bare) >= 38 and not any(added[t] for t in texts)


def test_scan_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "nothing here but internationalisation"), (2, None)], "doc_id bigint, text string")
    for some in (docs, docs.limit(0)):
        formats = secrets.fit(secrets.samples(some))
        assert formats.kinds == {} and all(r.spans == [] for r in secrets.scan(docs, formats).collect())


def test_automata_keep_length_and_letters_apart():
    rng = random.Random(1)
    values = ["".join(rng.choices("0123456789abcdef", k=24)) for _ in range(600)]
    automaton = secrets.infer(values)
    assert 25 <= len(automaton.stop) < 60

    def score(value):
        codes = secrets.CODE[np.frombuffer(value.encode(), np.uint8)]
        return automaton.score(codes, np.array([0]), np.array([len(codes)]))[0]

    right = min(score(v) for v in values)
    assert score("".join(rng.choices("0123456789abcdef", k=24))) > right - 10
    # Another letter, and one length too short: what stops early costs about ten nats besides its letters.
    assert score("g" * 24) < right - 50 and score("0" * 23) < 23 * np.log(1 / 16) - 8


def test_secrets_query_equals_the_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op13_secrets(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain_scan(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        assert set(spans) <= set(r.spans.split(",")) | {""}
