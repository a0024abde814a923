"""The prefix trie, exact top-k search and the source divergence audit against plain Python, with odd rows, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference, oracle_session
from tallygrid.llm import brown, divergence, lines, topk, toxicity, trie
from tallygrid.llm.queries import registry
from tallygrid.llm.scan import running
from tallygrid.llm.storage import Scratch
from tallygrid.llm.text import Texts

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_term_at_a_time", "op13_source_divergence"])
def test_query_equals_its_sql(spark, name):
    query, sql = registry()[name]
    assert difference(query(spark, TINY), oracle_session(TINY), sql) is None


# Running counts.


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_running_goes_on_over_tasks(spark, parts):
    """Groups that are far longer than a task, equal rows, and negative numbers."""
    rng = np.random.default_rng(5)
    rows = [(int(g), int(o), int(x)) for g, o, x in zip(rng.choice([-3, 1, 1, 1, 9], 400), rng.integers(0, 50, 400), rng.integers(-(1 << 62), 1 << 62, 400), strict=True)]
    rows += [(1, 7, 5)] * 60
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = spark.createDataFrame(rows, "g bigint, o bigint, x bigint").withColumn("y", F.col("x"))
        found = running(frame, "g", ["o", "x"], ["x"], ["o", "y"], Scratch(spark, "scan"), "rows").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected, n, so_far = Counter(), Counter(), Counter()
    for g, o, x in sorted(rows):
        n[g] += 1
        so_far[g] ^= x
        expected[(g, so_far[g], o, x, n[g])] += 1
    assert Counter((r.g, r.x, r.o, r.y, r.n) for r in found) == expected


# The prefix trie.


def trie_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        made[c] = turns.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, own in made.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    leaves, saved = Counter(), Counter()
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own) - 1) * words(path[-1][1]) if path else 0
    return {
        (
            min(own),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(own),
            children[path],
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(c for c in own if len(made[c]) == len(path)))).encode()).hexdigest(),
        )
        for path, own in members.items()
    }


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, depth string, n string"


def conversations(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in [*range(70), 401, -7, -40, 10**12]:
        for t in range(rng.integers(1, 7)):
            rows.append((c, int(rng.choice([t, t, 2])), str(rng.choice(["user", "assistant"])), str(rng.choice(["yes", "no way", " ", "tell me\tmore", "ünï"])), "x", None))
    rows += [(3, None, None, None, None, None), (3, None, "user", "last null"), (None, 1, "user", "nobody"), (5, 2, None, "ü" * 5000)]
    rows += [rows[0]] * 3
    return [tuple(r) + (None,) * (6 - len(r)) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_the_definition(spark, seed):
    rows = conversations(seed)
    found = trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS)).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == trie_by_hand([r[:4] for r in rows])


def test_trie_of_long_and_equal_conversations(spark, monkeypatch):
    """Paths over many segments, far more messages than a queue may hold, and a first turn that most share."""
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(c, t, "user", "hello" if t == 0 else f"{c % 9} {t}") for c in range(20, 400) for t in range(2)]
    monkeypatch.setattr(trie, "SEGMENT", 16)
    monkeypatch.setattr(trie, "CHUNK", 20)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    scratch = Scratch(spark, "trie")
    turns, convs = trie.rebuilt(frame, scratch)
    tree, lasts = trie.nodes(turns, convs, scratch)
    totals = trie.subtree_totals(tree, scratch, limit=4)
    found = {(r.conv_id, r.depth): (r.n_children, r.n_leaves, r.saved_tokens) for r in totals.collect()}
    expected = trie_by_hand(rows)
    assert found == {row[:2]: row[4:7] for row in expected}
    hashes = {r.ends_sha256 for r in trie.end_hashes(lasts).collect()}
    assert hashes == {row[7] for row in expected} - {trie.NO_ENDS}


def test_trie_of_nothing(spark):
    for rows in ([], [(None, 1, "user", "x", None, None)]):
        found = trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS))
        assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert found.count() == 0


def test_queue_spills_and_stays_in_order():
    queue, rng, held, out = trie.Queue(limit=8), np.random.default_rng(0), [], []
    for step in range(3000):
        item = (int(rng.integers(-50, 50)), step)
        queue.push(item)
        held.append(item)
        if rng.random() < 0.4:
            assert queue.first() == min(held)
            out.append(queue.pop())
            held.remove(out[-1])
    assert queue.spilled > 1000
    while queue.first() is not None:
        out.append(queue.pop())
        assert out[-1] == min(held)
        held.remove(out[-1])
    assert not held


# Exact top-k search.


def top_by_hand(rows, most, divisor):
    sound = [
        (i, [int(np.floor(np.float64(x) * 256)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    best = defaultdict(dict)
    for q, v in sound:
        if q % divisor:
            continue
        for c, w in sound:
            if c != q:
                score = sum(x * y for x, y in zip(v, w))  # noqa: B905  the shorter one's missing components count as 0
                best[q][c] = max(score, best[q].get(c, score))
    return {
        (q, n, c, s)
        for q, own in best.items()
        for n, (c, s) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:most], 1)
    }


@pytest.mark.parametrize(("candidates", "group"), [(8192, 32768), (7, 3)])
def test_top_k_equals_all_pairs(spark, candidates, group):
    """Ties, zero and empty vectors, other lengths, repeated rows and ids, components that are no numbers, and very large ones."""
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in rng.integers(-3, 4, 6) / 256 * rng.choice([0, 1, 60], 6)] for _ in range(60)]
    rows = [(n, v) for n, v in enumerate(vectors)]
    rows += [(100, [0.0] * 6), (150, []), (200, [1.0]), (250, None), (300, [None, 1.0]), (350, [float("nan")]), (400, [float("inf"), 1.0]), (None, [1.0] * 6)]
    rows += [rows[0], rows[7], (7, [0.5] * 6), (0, [-0.5] * 6), (55, vectors[50]), (56, vectors[50]), (1000, [3e5] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("v", F.lit(1))
    found = topk.top_k(frame, F.col("vec_id") % 50 == 0, candidates=candidates, group=group).collect()
    assert {tuple(r) for r in found} == top_by_hand(rows, 5, 50)
    assert len(found) == len({(r.query_id, r.rank) for r in found})


def test_top_k_beyond_64_bits(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 0.0]), (2, [1e9, 1.0]), (3, [-1e300, 0.0]), (4, [0.0, 2.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    most = (1 << 63) - 1
    assert [(r.vec_id, r.score) for r in found] == [(1, most), (2, most), (4, 131072), (3, -most - 1)]


def test_top_k_of_few_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(0, [1.0])], [(None, [1.0]), (1, [2.0])]):
        assert topk.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).count() == 0
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame([(0, [1.0]), (3, [0.5])], schema), F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 3, 256 * 128)]


# The source divergence audit.


def audit_by_hand(rows, least=3, most=200):
    counts, seen, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        sources[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, own in sources.items():
        kept = {t for t, n in seen[lang].items() if n >= least}
        held = {s: {t: counts[lang, s][t] for t in kept} for s in own}
        share = lambda c, total: 1 + 10**9 * (c + 1) // (total + len(kept))  # noqa: E731, B023
        p = {s: {t: share(c, sum(x.values())) for t, c in x.items()} for s, x in held.items()}
        total = {t: sum(held[s][t] for s in own) for t in kept}
        q = {t: share(c, sum(total.values())) for t, c in total.items()}
        for s in own:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own - {s}]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if held[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, most)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, n) for n, (value, item) in enumerate(ordered[:limit], 1)}
    return out


def texts(seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["Stone", "river", "RIVER", "été", "ÉTÉ", "niño", "don't", "a1b", "x-y", "zzz", "日本", "ſ", "İ"]
    rows = []
    for _ in range(120):
        text = " ".join(rng.choice(vocabulary, rng.integers(0, 12)))
        lang, source = str(rng.choice(["en", "de", "en"])), f"s{rng.integers(0, 5)}"
        rows += [(text, lang, source)] * int(rng.choice([1, 1, 1, 4]))
    rows += [("Stone river", "en", "s0")] * 50 + [("only once here", "xx", "a"), ("nothing else", "xx", "b"), ("", "xx", "c")]
    rows += [(None, "en", "empty"), ("été été zzz", None, None), ("zzz", "", "s1"), ("zzz", None, "s2"), ("w" * 9000, "en", "s\0"), ("zzz", "en", "s")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_the_definition(spark, seed, monkeypatch):
    monkeypatch.setattr(divergence, "TOGETHER", 6 if seed == 1 else 1 << 18)
    rows = texts(seed)
    frame = spark.createDataFrame([(*r, "clash", None) for r in rows], "text string, lang string, source string, term string, g string")
    found = divergence.audit(frame)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == Counter(audit_by_hand(rows))


def test_audit_ranks_and_limits(spark):
    rows = [(f"t{chr(97 + i // 26)}{chr(97 + i % 26)} common", "en", f"s{j}") for i in range(300) for j in range(3)]
    rows += [(f"t{chr(97 + i // 26)}{chr(97 + i % 26)}", "en", "s0") for i in range(260)]
    found = {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string")).collect()}
    assert found == audit_by_hand(rows)
    assert sum(r[1] == "s0" and r[2] == "term" for r in found) == 200


def test_audit_of_nothing(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame([(None, "a", "x"), (None, "a", "y")], schema)).collect()} == {
        ("a", "x", "pair", "y", 0, 1),
        ("a", "y", "pair", "x", 0, 1),
    }


def test_toxicity_learns_from_all_labelled_documents(spark, monkeypatch):
    """The telling words stand only in documents beyond the 5,000 of each label whose hash is smallest."""
    n = 14000
    ids = spark.range(n).select("id", F.xxhash64("id", F.lit(11)).alias("order"), toxicity.held_out("id").alias("out")).orderBy("order").collect()
    met, rows, marks, late = Counter(), [], [], []
    for r in ids:
        toxic = r.id % 2
        met[toxic] += not r.out
        known = met[toxic] <= 5000
        own = [f"word{r.id % 13}", "same"] if known else ["vile" if toxic else "mild", f"word{r.id % 13}"]
        rows.append((r.id, " ".join(own), "en"))
        marks.append((r.id, toxic))
        if not known:
            late.append((r.id, toxic))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    if hasattr(toxicity, "PACK_DOCUMENTS"):
        monkeypatch.setattr(toxicity, "PACK_DOCUMENTS", 2000)
    classifier = toxicity.fit(frame, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    found = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(frame, classifier).collect()}
    assert np.mean([found[i] == bool(t) for i, t in late if t]) > 0.95
    assert classifier.model.embedding[toxicity.word_ids(Texts(np.frombuffer(b"vile", np.uint8), np.array([0, 4]), 0))[0]].any()


@pytest.mark.parametrize("head", [0, 700])
def test_brown_classes_do_not_depend_on_the_head(spark, monkeypatch, head):
    """Words beyond the head have the class of their count all the same."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 3000, 40))) for i in range(400)] + [(None, "w1 never w2"), (500, None), (501, "w9"), (501, "w9 once")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = lambda: sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in brown.scored(frame).collect())
    whole = out()
    monkeypatch.setattr(brown, "HEAD", head)
    assert out() == whole
