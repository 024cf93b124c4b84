"""The training-data operators against brute force on small, awkward tables."""

import collections
import hashlib
import math
import os
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewater.llm import chat, chunks, components, fingerprints, forest, minhash, mixing, pieces, quality, suffixes, suffixtree
from tracewater.llm import texts as texts_
from tracewater.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(["an", "er", "th", "ou", "é", "ist"], rng.integers(1, 4))) for _ in range(n))


def texts():
    base, passage = prose(1, 300), prose(2, 120)
    rows = [(i, prose(10 + i, 60 + i)) for i in range(12)]
    rows += [(20, base), (21, base), (22, base.replace("an", "AN")), (23, base + " tail"), (24, prose(3, 40) + " " + passage)]
    rows += [(25, prose(4, 30) + " " + passage + " " + prose(5, 50)), (26, passage[:260]), (27, "x" * 700), (28, "ab" * 400)]
    rows += [(30, ""), (31, None), (32, " \n\t "), (33, "one"), (34, "one"), (35, "one two"), (36, "é日本 🎉 ▁ <turn a>"), (37, prose(6, 9000))]
    rows += [(20, base), (None, base), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns with names that operators use."""
    schema = "doc_id long, text string, source string, score double, ids array<int>, spans string, text_hash long, place int, variant int, n_removed int"
    rows = [(i, t, f"s{(i or 0) % 3}" if i != 5 else None, 1.0, None, "x", 3, 4, 5, 6) for i, t in texts()]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_components_follow_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (7, 7)], "a long, b long")
    got = {r[0]: r[1] for r in components.components(links).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 55: 50, 60: 50}
    assert components.components(links.limit(0)).count() == 0


# 1


def test_gear_hash_rolls_over_32_bytes():
    data = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    h = 0
    for b, got in zip(data, chunks.gear(data), strict=True):
        h = (h << 1) + int(chunks.GEAR[b]) & 0xFFFFFFFF
        assert h == int(got)


def test_chunks_of_later_copies_go(docs, empty):
    out = chunks.without_copies(docs, chunks.later_copies(docs))
    assert set(docs.columns) <= set(out.columns)
    rows = out.select("doc_id", "text", "n_removed", "copied_from", "spans").collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    was = collections.defaultdict(list)
    for i, t in texts():
        was[i].append(t)
    assert len(rows) == len(texts())
    assert by[21][0].text == "" and by[31][0].text is None and by[30][0].text == ""
    assert {r.text for r in by[20]} == {""} and {r.copied_from[0] if r.copied_from else None for r in by[20]} == {None}
    assert by[25][0].n_removed > 300 and 24 in by[25][0].copied_from and len(by[24][0].text) == len(was[24][0])
    assert by[34][0].text == "" and by[33][0].text == "one"
    for i in (*range(12), 37):
        assert by[i][0].n_removed == 0 and by[i][0].text == was[i][0]
    assert chunks.without_copies(empty, chunks.later_copies(empty)).count() == 0


# 2


def test_chat_examples_read_back(spark):
    trap = r"\### </turn> <turn user> \\l \g"
    rows = [(1, 0, "system", "s"), (1, 1, "user", trap), (1, 2, "assistant", trap), (1, 2, "assistant", trap), (1, 4, "user", "")]
    rows += [(2, None, None, None), (None, 1, "assistant", "x\n"), (3, 0, "assistant", None), (4, 0, "we>ird\n</turn", "\\")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, example int")
    found = chat.examples(turns)
    read = found.select(
        "conv_id", "example", "complete", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"), "formatted",
    ).collect()
    whole = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read if r.complete}
    assert whole[1] == [("system", "s"), ("user", trap), ("assistant", trap), ("assistant", trap), ("user", "")]
    assert whole[2] == [("", "")] and whole[None] == [("assistant", "x\n")] and whole[4] == [("we>ird\n</turn", "\\")]
    losses = {(r.conv_id, r.example): r.loss for r in read}
    assert losses[(1, 0)] == losses[(1, 1)] == trap and losses[(1, 2)] is None and losses[(3, 0)] == "" and losses[(None, 0)] == "x\n"
    assert chat.examples(turns.limit(0)).count() == 0


# 3


def test_suffix_tree_base_is_exact_and_contexts_help(docs, empty):
    held = F.coalesce(quality.fold(F.col("doc_id"), 5) == 1, F.lit(False))
    got = suffixtree.score(docs, held, bucket=2000).collect()
    words = [(i, WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in texts()]
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in words}
    c = collections.Counter(w for i, ws in words if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (str(i), out[i], len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
        for i, ws in words
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    copies = [r for r in got if r.doc_id in (20, 21)]
    assert all(r.score > r.base_score for r in copies) and all(r.score <= 0 for r in got)
    assert suffixtree.score(empty, held).count() == 0
    nothing = suffixtree.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in nothing} == {(0, 0, 0.0, 0.0)}


def test_retained_contexts_are_distributions():
    code = np.array([1, 1, 1, 1, 2, 2, 2], np.uint64)
    symbol = np.array([5, 5, 5, 6, 5, 6, 7], np.uint32)
    change = suffixtree.learned(code, symbol, np.ones(7, bool), np.full(7, 0.01), 3.0, 3.0)
    assert np.allclose(10 ** change[[0, 3]] * 0.01, [(3 + 0.03) / 7, (1 + 0.03) / 7])  # context 1 repeats itself
    assert not change[4:].any()  # context 2 never does


def _tree_by_brute_force(rows, held, depth=4, gain=3.0, weight=3.0):
    """All contexts of 1 to ``depth`` words counted in dictionaries: ``[(doc_id, score)]`` and the number of retained contexts."""
    seqs = [(i, WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in rows]
    c = collections.Counter()
    for i, ws in seqs:
        for d in range(1, depth + 2):
            c.update(() if held(i) else (tuple(ws[k : k + d]) for k in range(len(ws) - d + 1)))
    ones = {g: n for g, n in c.items() if len(g) == 1}
    norm = sum(ones.values()) + 0.5 * (len(ones) + 1)
    gained = collections.Counter()
    for i, ws in seqs:
        for k, w in enumerate(ws):
            q = (c[(w,)] + 0.5) / norm
            for d in range(1, min(k, depth) + 1):
                g = tuple(ws[k - d : k])
                if c[g] >= 2 and not held(i):
                    new = (c[(*g, w)] - 1 + weight * q) / (c[g] - 1 + weight)
                    gained[g] += math.log(new / q)
                    q = new
    out = []
    for i, ws in seqs:
        total = 0.0
        for k, w in enumerate(ws):
            p = (c[(w,)] + 0.5) / norm
            for d in range(1, min(k, depth) + 1):
                g = tuple(ws[k - d : k])
                if gained[g] > gain:
                    p = (c[(*g, w)] + weight * p) / (c[g] + weight)
            total += math.log10(p)
        out.append((str(i), round(total, 5)))
    return sorted(out), sum(v > gain for v in gained.values())


@pytest.mark.parametrize("bucket", [300, 2_000_000])
def test_suffix_tree_against_brute_force_at_every_depth(spark, bucket):
    rng = np.random.default_rng(33)
    common = [f"w{k}" for k in range(12)]  # shares far above any bound of rarity: only short contexts repeat
    rows = [(i, " ".join(rng.choice(common, 30, p=np.arange(12, 0, -1) / 78))) for i in range(60)]
    rows += [(100 + i, "Alpha beta gamma delta " + prose(500 + i, 8) + " alpha beta gamma delta") for i in range(15)]
    rows += [(200 + i, "run " * 40) for i in range(3)] + [(300, "unseen gamma delta w1"), (301, ""), (302, None), (300, "alpha beta other")]
    held = F.col("doc_id") % 5 == 0
    want, n_kept = _tree_by_brute_force(rows, lambda i: i % 5 == 0)
    got = suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), held, bucket=bucket).collect()
    assert n_kept > 10
    assert sorted((str(r.doc_id), round(r.score, 5)) for r in got) == want


def test_suffix_tree_root_knows_uncommon_words_in_a_large_corpus(spark):
    rows = [(1, "a " * 2_100_000 + "rare"), (2, "rare"), (3, "novel")]
    got = {r.doc_id: r for r in suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") > 1).collect()}
    norm = 2_100_002 + 0.5 * 4
    assert abs(got[2].score - 2 * math.log10(1.5 / norm)) < 1e-9 and got[2].score == got[2].base_score
    assert abs(got[3].score - math.log10(0.5 / norm) - math.log10(1.5 / norm)) < 1e-9


def test_suffix_tree_folds_a_common_context_before_it_is_sent():
    sent = []
    for n in (1000, 50_000):
        keys = np.append(np.full(n, 7, np.uint64), suffixtree.END)
        at = np.searchsorted(np.unique(keys), keys)
        block = suffixtree.Words(pickle.dumps((None, np.array([False]), np.array([n + 1]), np.unique(keys), at)), 4)
        block.answer([1, 2], block.ask([1, 2])[1])
        found, number, _, _ = block.ask([3, 4, 5])
        sent.append(len(found))
        assert number.max() == n - 2 and len(list(suffixtree._parts(1, found, number, 3))) <= 3
    assert sent == [6, 6]  # runs of 3, 4 and 5, and the ends of them


def test_suffix_tree_keeps_blocks_in_place_and_sends_contexts_by_number(spark, docs):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = suffixtree.score(docs, F.lit(False), bucket=2000)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # before, blocks crossed a shuffle here
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    rng = np.random.default_rng(5)
    bodies = []
    for blob in range(6):
        at = rng.integers(0, 50, 20_000)
        words = suffixtree.Words((None, np.array([False]), np.array([len(at)]), suffixtree.texts.mix(np.arange(50, dtype=np.uint64)), at), 4)
        keys, number, _, _ = words.ask([1, 2])
        bodies += [(blob, keys, number, words, *suffixtree._parts(blob, keys, number, 1))]
    sums = suffixtree._summed(suffixtree._rows([b[4] for b in bodies], 1))
    for (_, keys, _, words, sent), body in zip(bodies, sums.column("body").to_pylist(), strict=True):
        back = {1: [(0, suffixtree._opened(body))]}
        words.answer([1, 2], back[1][0][1][0].astype(np.int64))
        words.answer([3, 4, 5], words.ask([3, 4, 5])[1])
        ((kind, bucket, at, place),) = [c for c in suffixtree._contexts(words, back) if c[0] == 1]
        assert (kind, bucket) == (1, 0) and (np.diff(place.astype(np.int64)) > 0).all() and len(at) > 2000
        assert len(suffixtree._shut(suffixtree._packed(place))) < len(sent[2]) / 4  # before, the keys again
    signed = np.array([0, -1, 1, 2**40, -(2**40)])
    assert (suffixtree._unsigned(*suffixtree._signed(signed)) == signed).all()


# 4


def test_forest_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)]) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)] + [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15)]
    rows += [(3003, [1.0]), (None, rows[1][1]), (3004, [None] + [1.0] * 15), (3005, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = collections.defaultdict(list)
    for r in forest.search(df, F.col("vec_id") % 20 == 0, k=20, rows=700).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = [(i, np.array(v)) for i, v in rows[:1800]]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    hits = 0
    for i, v in good:
        if i % 20 == 0:
            s = np.where(ids == i, -np.inf, (x * v).sum(axis=1))
            best = np.lexsort((ids, -s))[:20]
            mine = sorted(got[i])
            assert [m[0] for m in mine] == list(range(1, 21))
            assert all(abs(m[2] - s[ids == m[1]][0]) < 1e-12 for m in mine) and i not in [m[1] for m in mine]
            hits += len({m[1] for m in mine} & set(ids[best].tolist()))
    assert hits / (20 * len(got)) >= 0.9 and set(got) == {i for i, _ in good if i % 20 == 0}
    assert sorted(got[0])[0][1] == 2000 and sorted(got[2000])[0][1] == 0  # equal vectors, least id first
    assert forest.search(df.limit(0), F.lit(True)).count() == 0


def collected(strings, asked, enough):
    """Rows that trees of bit texts collect for one query: all one bit shorter at a time, the last step tree by tree."""
    before = [set() for _ in strings]
    for length in range(len(asked[0]), -1, -1):
        here = [{i for i, s in enumerate(tree) if s[:length] == ask[:length]} for tree, ask in zip(strings, asked, strict=True)]
        if sum(map(len, here)) >= enough:
            chosen, have = list(before), sum(map(len, before))
            for t, rows in enumerate(here):
                chosen[t] = rows
                have += len(rows) - len(before[t])
                if have >= enough:
                    break
            return set().union(*chosen)
        before = here
    return set().union(*before)


@pytest.mark.parametrize("collect", [0.05, 0.5])
def test_forest_scores_what_its_trees_collect(spark, collect):
    """One block of rows, larger than the least number collected, and several blocks of queries."""
    rng = np.random.default_rng(44)
    n, k, trees, bits, seed = 1300, 5, 6, 12, 3
    x = rng.normal(size=(n, 8)) + 2 * rng.normal(size=(10, 8))[rng.integers(0, 10, n)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in forest.search(df, F.col("vec_id") % 20 == 0, k, trees, bits, collect, rows=2000, queries=30, seed=seed).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    planes = np.random.default_rng(seed).standard_normal((trees, bits, 9))
    longest = (x * x).sum(axis=1).max()

    def strings(vectors):
        return [["".join("1" if b > 0 else "0" for b in tree @ v) for v in vectors] for tree in planes]

    lifted = strings(np.column_stack([x, np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))]))
    asked = strings(np.column_stack([x[::20], np.zeros(len(x[::20]))]))
    least = max((k + 2) * trees, int(collect * n))
    shares = []
    for at, q in enumerate(range(0, n, 20)):
        found = collected(lifted, [a[at] for a in asked], least)
        shares.append(len(found) / n)
        best = sorted(found - {q}, key=lambda i: (-float(x[i] @ x[q]), i))[:k]
        assert [v for _, v in sorted(got[q])] == best
    assert len(got) == n // 20 and np.mean(shares) < 0.6


def test_forest_gives_all_of_a_small_table(spark):
    rows = [(i % 7, [float(i), 1.0]) for i in range(15)]  # ids repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.search(df, F.col("vec_id") < 2).groupBy("query_id").count().collect()
    assert sorted((r.query_id, r["count"]) for r in got) == [(0, 12), (1, 13)]


# 5


def test_quality_learns_and_handles_missing_labels(spark, docs, empty):
    good = [(i, prose(100 + i, 60), 1) for i in range(80)]
    bad = [(100 + i, " ".join(["$$$ &&&"] * 20) + prose(300 + i, 10), 0) for i in range(80)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality").unionByName(spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int"))
    train = df.filter("doc_id % 4 <> 0")
    weights = quality.fit(train, labels)
    scored = quality.score(df.withColumnRenamed("quality", "label"), weights).filter("doc_id % 4 = 0").collect()
    assert all((r.score >= 0.5) == (r.label == 1) for r in scored)
    assert np.array_equal(weights, quality.fit(train.repartition(3), labels))
    every = quality.score(docs.drop("score"), weights).collect()
    assert len(every) == len(texts()) and all(0 <= r.score <= 1 for r in every)
    assert len({r.score for r in every if not r.text}) == 1
    none = quality.fit(df, labels.limit(0))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(empty.drop("score"), weights).count() == 0


def test_quality_fit_takes_repeated_rows_once_and_keeps_its_bound(spark, monkeypatch):
    rows = [(i, prose(700 + i, 20)) for i in range(30)]
    df = spark.createDataFrame(rows + [rows[3]] * 500 + [(4, prose(900 + i, 20)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(quality, "train", lambda order, *a, **b: taken.append(len(order)))
    quality.fit(df, labels)
    quality.fit(df, labels, sample=20)
    quality.fit(df.filter("doc_id <> 4"), labels)
    assert taken == [130, 20, 29]


def test_quality_sample_is_packed_and_reads_back(spark, monkeypatch):
    df = spark.createDataFrame([(i, prose(40 + i, 400), i % 2) for i in range(30)], "doc_id long, text string, quality int")
    taken = []
    monkeypatch.setattr(quality, "train", lambda order, *a, **b: taken.append(order))
    quality.fit(df.drop("quality"), df.drop("text"))
    rows = [taken[0][k] for k in range(30)]
    features = sum(len(ids) for _, ids, _ in rows)
    assert sum(len(body) for _, body in taken[0].rows) < 4 * features  # a number and a share of 4 bytes each before
    assert [(label, len(ids), ids.tobytes()) for label, ids, _ in rows] == sorted((label, len(ids), ids.tobytes()) for label, ids, _ in rows)
    batch = pa.RecordBatch.from_arrays([pa.array([prose(40, 400)])], names=["text"])
    _, data, offsets = next(iter(texts_.blocks([batch])))
    found = [b for b, _ in quality.features(data, offsets, quality.BITS)] + [np.zeros(1, np.uint32)]
    want, n = np.unique(np.concatenate(found), return_counts=True)
    shares = next(s for label, ids, s in rows if label == 0 and np.array_equal(ids, want))
    assert np.array_equal(shares, (n / n.sum()).astype(np.float32)) and rows[0][1].dtype == np.int32


# 6


def removed_by_brute_force(rows, length, keep):
    seen = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        for p in range(len(raw) - length + 1):
            seen[raw[p : p + length]].append((i is not None, i or 0, k, p))
    out = []
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            places = seen[raw[p : p + length]]
            first = min(places)
            same_row = first[:2] == (i is not None, i or 0) and rows[first[2]] == rows[k] and first[3] == p
            if len(places) > 1 and (keep == "none" or not same_row):
                gone[p : p + length] = True
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((str(i), len(raw), int(gone.sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("keep, many", [("none", 2000), ("first", 2000), ("none", 1), ("first", 1)])
def test_suffix_removal_against_brute_force(docs, keep, many):
    rows = [r for r in texts() if len(r[1] or "") < 5000]
    small = docs.filter("doc_id is null or doc_id <> 37")
    report = suffixes.removal_report(small, suffixes.repeats(small, keep=keep, many=many)).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in report)
    assert got == removed_by_brute_force(rows, 200, keep)


def varied(copies):
    """A text in many rows, and others that share parts of it, so that keys have several contents."""
    base = prose(71, 90)
    rows = [(20, base)] * copies + [(23, base + " " + prose(72, 20)), (24, prose(73, 20) + base[150:]), (25, prose(74, 9) + base[:400] + prose(75, 30))]
    return [*rows, (26, base[:300]), (27, base[100:380] + "!")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("copies, hot", [(2, 1), (30, 1), (30, 100_000)])
def test_suffix_removal_with_repeated_rows(spark, monkeypatch, keep, copies, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = varied(copies)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    report = suffixes.removal_report(df, suffixes.repeats(df, keep=keep)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in report) == removed_by_brute_force(rows, 200, keep)
    if keep == "first":  # the first place of a passage stays
        assert {r.n_removed for r in report if r.doc_id == 20} == {0}


@pytest.mark.parametrize("size", [1, 3, 100])
def test_marked_pieces_in_a_row_give_one_span(size):
    """Pieces of one text are folded over batches, also over a short unmarked one between; other texts and gaps part them."""
    names = suffixes.PIECE_NAMES
    rows = [(1, 5, 0, 50, 7, 70), (1, 5, 50, 30, 8, 80), (1, 5, 80, 10, 9, 90), (1, 5, 90, 40, 7, 70), (1, 5, 600, 50, 7, 70), (1, 6, 610, 50, 7, 70),
            (None, 6, 610, 50, 7, 70), (None, 6, 660, 50, 8, 70), (None, 6, 660, 50, 8, 80), (1, 5, 0, 50, 7, 70)]
    table = pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(names)})
    shared = type("Shared", (), {"value": {(70, 7): (1, 5, 600), (80, 8): (9, 9, 9)}})
    for keep, at_600 in (("none", [(1, 5, 600, 849)]), ("first", [])):
        found = suffixes._marked(shared, 200, keep)(table.to_batches(max_chunksize=size))
        spans = [tuple(r.values()) for b in found for r in b.to_pylist()]
        assert spans == [(1, 5, 0, 329), *at_600, (1, 6, 610, 859), (None, 6, 610, 909), (1, 5, 0, 249)]


def test_suffix_removal_of_very_many_equal_rows(spark):
    rows = varied(1)
    copies = spark.range(10_000).select(F.lit(20).cast("long").alias("doc_id"), F.lit(rows[0][1]).alias("text"))
    df = copies.unionByName(spark.createDataFrame(rows[1:], "doc_id long, text string")).repartition(8)
    for keep, gone in (("first", 0), ("none", len(rows[0][1].encode()))):
        report = suffixes.removal_report(df, suffixes.repeats(df, keep=keep))
        assert report.filter("doc_id = 20").groupBy("n_removed", "n_spans").count().collect() == [(gone, int(gone > 0), 10_000)]


def test_anchors_do_not_depend_on_stretches():
    hashed = np.random.default_rng(4).integers(0, 50, 5000).astype(np.uint64) << np.uint64(40)
    want = [i + int(np.argmin(hashed[i : i + 30])) for i in range(len(hashed) - 29)]
    for stretch in (1 << 27, 1000, 31):
        assert suffixes._anchors(hashed, 30, stretch).tolist() == want


def test_suffix_removal_keeps_columns_and_empty_tables(docs, empty):
    out = suffixes.apply_spans(docs, suffixes.repeats(docs))
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {r.doc_id: r.text for r in out.filter("doc_id in (30, 31, 33)").collect()}
    assert kept == {30: "", 31: None, 33: "one"}
    assert suffixes.apply_spans(empty, suffixes.repeats(empty)).count() == 0


def test_suffix_order_and_factors_against_sorting():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 2, 400).astype(np.uint8)
    ends = np.repeat([150, 400], [150, 250])
    order, shared = suffixes.suffix_order(data, ends, 20)
    want = [i for i in range(400) if ends[i] - i >= 20]
    strings = {i: bytes(data[i : i + 20]) for i in want}
    assert [strings[i] for i in order] == sorted(strings[i] for i in want)
    for a, b, n in zip(order, order[1:], shared[1:], strict=False):
        assert n == len(os.path.commonprefix([strings[a], strings[b]]))
    factors = suffixes.previous_factors(order, shared, order, 5)
    for i, got in zip(order, factors, strict=True):
        best = max((len(os.path.commonprefix([strings[i], strings[j]])) for j in want if j < i), default=0)
        assert got == (best if best >= 5 else 0)


# 7


def test_fingerprints_are_equal_for_equal_texts_and_follow_the_next(spark, docs, empty):
    marked = docs.select("doc_id", "text", fingerprints.sketch(fingerprints.anchors(F.col("text"))).alias("sketch"))
    by = collections.defaultdict(set)
    for r in marked.collect():
        by[r.text or ""].add(tuple(r.sketch))
    assert all(len(v) == 1 for v in by.values()) and by[""] == {()} and len(next(iter(by["one"]))) == 1
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null").dropDuplicates(["doc_id"])
    ids = sorted((i for i in {i for i, _ in texts()} if i is not None), reverse=True)
    text = {i: t or "" for i, t in texts() if i is not None}
    for stretches in (1, 4, 50):
        got = {r.doc_id: r.following.text for r in fingerprints.with_next(own, "doc_id", ["text"], stretches).collect()}
        assert got == {i: text[n] for i, n in zip(ids, ids[1:] + ids[:1], strict=True)}
    assert fingerprints.with_next(own.limit(0), "doc_id", ["text"], 4).count() == 0


def test_anchors_are_closed_syncmers(spark):
    t = prose(9, 80)
    got = spark.createDataFrame([(t,), ("head words " + t,)], "t string").select(fingerprints.anchors(F.col("t"), 6, 3).alias("a")).collect()
    plain, shifted = [{(a.at, a.hash) for a in r.a} for r in got]
    assert {(at + 2, h) for at, h in plain} <= shifted  # context-free: the same anchors, two words later
    share = len(plain) / (80 - 5)
    assert 0.25 < share < 0.8


def test_fingerprints_hold_all_anchors_and_compare_whole_sets(spark, tmp_path):
    long, passage = prose(71, 3000), prose(72, 60)
    pairs = [(1, long + " " + passage), (2, prose(73, 3000) + " " + passage), (3, long), (4, ""), (5, None), (6, "one")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in pairs]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, str(tmp_path)).collect()}
    marked = spark.createDataFrame(pairs, "doc_id long, text string").select("doc_id", fingerprints.anchors(F.col("text")).alias("a"))
    anchors = {r.doc_id: [(a.at, a.hash) for a in r.a] for r in marked.collect()}
    for i, found in anchors.items():
        assert got[i].fingerprint == "".join(f"{h % 2**64:016x}{at:08x}" for at, h in found)
    sets = {i: {h for _, h in found} for i, found in anchors.items()}
    following = {6: 5, 5: 4, 4: 3, 3: 2, 2: 1, 1: 6}
    for i, n in following.items():
        both = sets[i] | sets[n]
        assert got[i].near_next == (len(sets[i] & sets[n]) / len(both) if both else 1.0)
    assert len(sets[1]) > 640 and 0 < got[2].near_next < 0.05  # the passage of 60 words that both share shows


# 8


def brute_components(rows, width, percent):
    sets = collections.defaultdict(set)
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        s = frozenset(zip(*[w[k:] for k in range(width)], strict=False)) if len(w) >= width else frozenset([tuple(w)]) if w else frozenset()
        sets[i].add(s)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            for s in sets[a]:
                for t in sets[b]:
                    if s and t and 100 * len(s & t) >= percent * len(s | t) and root(a) != root(b):
                        lo, hi = sorted((root(a), root(b)))
                        parent[hi] = lo
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("width, block, wide", [(2, 512, 2048), (5, 2, 3)])
def test_near_duplicates_against_brute_force(spark, docs, width, block, wide):
    rng = np.random.default_rng(5)
    base = prose(77, 150).split(" ")
    near = []
    for k in range(40):  # copies on both sides of the threshold
        copy = list(base)
        for p in rng.choice(150, k // 2, replace=False):
            copy[p] = f"w{k}x{p}"
        near.append((200 + k, " ".join(copy)))
    more = spark.createDataFrame(near, "doc_id long, text string")
    df = docs.select("doc_id", "text", F.lit(1).alias("signature")).unionByName(more.withColumn("signature", F.lit(2)))
    got = minhash.near_duplicates(df, width=width, block=block, wide=wide).collect()
    want = brute_components(texts() + near, width, 80)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got) and len(got) == len(texts()) + 40


def test_near_duplicates_link_components_that_are_left():
    copies, other = prose(77, 150), prose(78, 150)
    group = pa.table({
        "doc_id": [11, 12, 13, 14], "text": [copies, copies + " end", copies + " and end", other],
        "component": [3, 3, 5, 6], "is_left": [True, False, False, False],
    })
    found = minhash._links(5, minhash.COORDINATES, minhash.MATCHES, 80)(group)
    assert found.to_pylist() == [{"a": 3, "b": 5}]


def test_near_duplicates_of_nothing(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_any_nine_of_24_coordinates_share_a_merged_list():
    groups = [set(range(g, 24, 8)) for g in range(8)]
    rng = np.random.default_rng(0)
    for _ in range(500):
        chosen = set(rng.choice(24, 9, replace=False).tolist())
        assert any(len(g & chosen) >= 2 for g in groups)


# 9


def test_targets_fill_up_to_the_cap(spark):
    sizes = {"a": 100, "b": 5000, "c": 40, "d": 900, None: 10, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not above:
            break
        capped |= above
    want = {s: 2 * sizes[s] if s in capped else level * weight[s] for s in sizes}
    assert got == pytest.approx(want)


def test_mix_hits_targets_and_reruns_agree(spark, docs, empty):
    decided = mixing.mix(docs)
    rows = decided.collect()
    assert len(rows) == len(texts())
    by = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.copies * r.size <= 2 * r.size
        by[r.source].append(r)
    for source in by.values():
        assert abs(sum(r.copies * r.size for r in source) - source[0].target) <= max(r.size for r in source)
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    out = mixing.apply_mix(docs, decided)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in rows)
    assert mixing.apply_mix(empty, mixing.mix(empty)).count() == 0


def test_pivotal_rounding_over_many_groups(spark):
    units = spark.range(5000).select(
        F.col("id").alias("unit"), F.lit(1).cast("long").alias("nth"), F.lit("s").alias("source"), F.lit(5000).cast("long").alias("n_units"),
        (F.col("id") % 50 + 1).alias("size"), F.lit(0.7).alias("ratio"),
    )
    got = mixing.copies(units, group=50, fan_in=4).agg(F.sum(F.col("size") * F.col("copies")), F.count("*"), F.min("copies"), F.max("copies")).first()
    assert abs(got[0] - 0.7 * 5000 * 25.5) <= 50 and tuple(got[1:]) == (5000, 0, 1)


# 10

needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no piece model")


@needs_model
def test_pieces_equal_the_model_without_dropout_and_decode_with_it(spark, docs, empty):
    import sentencepiece

    model, tables = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.load(MODEL)
    plain = pieces.encode(docs, tables, dropout=0.0).collect()
    for r in plain:
        if "▁" not in (r.text or ""):
            assert r.ids == model.encode(r.text or "")
    lengths = {}
    for dropout in (0.0, 0.1, 0.6, 1.0):
        read = pieces.decode(pieces.encode(docs, tables, dropout=dropout), tables).collect()
        assert all(r.decoded == (r.text or "") for r in read)
        lengths[dropout] = sum(len(r.ids) for r in read)
    assert lengths[0.0] < lengths[0.1] < lengths[0.6] < lengths[1.0]
    same = pieces.encode(docs.filter("doc_id is not null").repartition(3), tables, dropout=0.5)
    assert {(r.doc_id, tuple(r.ids)) for r in same.collect()} == {
        (r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, tables, dropout=0.5).collect() if r.doc_id is not None
    }
    assert pieces.decode(pieces.encode(empty, tables), tables).count() == 0


@needs_model
def test_stepped_agendas_equal_a_heap():
    t = pieces.load(MODEL)
    for n, word in enumerate(prose(8, 120).split(" ") + ["日本", "a" * 30, "é▁é"]):
        points = np.array([ord(c) for c in " " + word], np.int64)
        key = np.array([n * 7919 + 1], np.uint64)
        rows, count = pieces._in_step(t, points[None, :], np.array([len(points)]), key, 0.4)
        assert rows[0, : count[0]].tolist() == pieces._agenda(t, points, key[0], 0.4).tolist()


@needs_model
def test_dropout_is_drawn_for_each_occurrence_and_each_copy(spark):
    tables = pieces.load(MODEL)
    rows = [(1, " ".join(["international"] * 400))] + [(2, "international relations between countries")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = []
    for parts in (1, 7):
        got = pieces.decode(pieces.encode(df.repartition(parts), tables, dropout=0.4), tables).collect()
        assert all(r.decoded == r.text for r in got)
        runs.append(sorted((r.doc_id, tuple(r.ids)) for r in got))
    assert runs[0] == runs[1]
    assert len({ids for i, ids in runs[0] if i == 2}) > 40  # copies of one row differ
    names = [tables["decoded"][i] for i in runs[0][0][1]]
    cuts = collections.Counter(b"|".join(names).split(b"| "))
    assert len(cuts) > 30  # one word of one text in many ways
