"""URL rules, the prefix trie and whitening against brute force on small, awkward tables."""

import collections
import hashlib
import itertools
import math
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewater.llm import prefixtrie, urlrules, whitening
from tracewater.llm.queries import URL_RULES

# 11

URLS = [
    "https://www.Example.com/en/1", "http://EXAMPLE.com/en/2?x=/fr/", "https://blog.example.com/en/", "https://example.com/de/3#top",
    "http://sub.www.example.com/en/x", "https://notexample.com/en/x", "https://a.net/es/1", "https://net/fr/", "http://a.b.net/de/",
    "https://x.org", "no scheme at all", "", None, "http://", "http://com/", "http://com", "a://b://c/d", "https://éa.net/ES/1", "http://a.net/fr/\nx",
    "https://spam-farm.org/offer/12.html?ref=a&utm=b", "https://spam-farm.org/offer/99.html", "https://farm.org/offer/1", "https://www.example.com/en/1",
    "http://" + ".".join(["a"] * 3000) + ".net/es/", "http://long.org/" + "x" * 50000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]


def best_rule(host, path):
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def test_stated_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string").repartition(3)
    mined = spark.createDataFrame([], urlrules.MINED_SCHEMA)
    got = {r.page_id: r for r in urlrules.judge(pages, urlrules.rule_table(spark, URL_RULES), mined).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        verdict, rule = best_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow"), url
    empty = urlrules.judge(pages.limit(0), urlrules.rule_table(spark, URL_RULES), mined)
    assert empty.count() == 0 and empty.columns == ["page_id", "host", "path", "rule", "verdict", "confidence", "because"]


def labelled_urls():
    rng = np.random.default_rng(5)
    out = []
    for i in range(600):
        host = rng.choice(["a.org", "shop-deals.org", "news.net", "www.shop-deals.org"])
        folder, page = rng.choice(["offer", "about", "en"]), int(rng.integers(100))
        bad = "deals" in host and folder == "offer" and rng.random() < 0.95 or rng.random() < 0.03
        out.append((f"https://{host}/{folder}/{page}.html" + ("?utm=1" if i % 3 else ""), bool(bad)))
    return out + [(None, True), (None, False), ("junk", True)]


def brute_rules(rows, tokens, floor, confidence, width):
    """All token combinations by counting, then those without a narrower rule of at least their confidence."""
    n, bad = len(rows), sum(b for _, b in rows)
    count = collections.Counter(t for u, _ in rows for t in tokens[u])
    worse = collections.Counter(t for u, b in rows if b for t in tokens[u])
    telling = {t: abs(worse[t] / count[t] - bad / n) * math.sqrt(count[t]) for t in count if worse[t] >= floor}
    whole, hit = collections.Counter(), collections.Counter()
    for u, b in rows:
        kept = sorted((t for t in tokens[u] if t in telling), key=lambda t: (-telling[t], t))[:width]
        for k in range(1, len(kept) + 1):
            for c in itertools.combinations(sorted(kept), k):
                whole[c] += 1
                hit[c] += b
    rules = {c: hit[c] / whole[c] for c in whole if hit[c] >= floor and hit[c] / whole[c] >= confidence}
    narrow = {c for c in rules for k in range(1, len(c)) for s in itertools.combinations(c, k) if rules.get(s, -1) >= rules[c]}
    return {c: (hit[c], round(v, 12)) for c, v in rules.items() if c not in narrow}


@pytest.mark.parametrize("width", [8, 3])
def test_mined_rules_against_brute_force(spark, width):
    rows = labelled_urls()
    table = spark.createDataFrame(rows, "url string, unwanted boolean").repartition(4)
    marked = table.select("url", urlrules.tokens(F.col("url")).alias("t")).distinct().collect()
    tokens = {r.url: r.t for r in marked}
    assert tokens["https://www.shop-deals.org/offer/1.html?utm=1" if "https://www.shop-deals.org/offer/1.html?utm=1" in tokens else rows[0][0]]
    assert tokens[None] == [] and tokens["junk"] == []
    mined = urlrules.mine(table.unionByName(table.limit(1).select("url", F.lit(None).cast("boolean").alias("unwanted"))), support=0.01, width=width)
    got = {tuple(r["items"]): (r.support, round(r.confidence, 12)) for r in mined.collect()}
    want = brute_rules(rows, tokens, max(0.01 * len(rows), urlrules.LEAST), urlrules.CONFIDENCE, width)
    assert got == want and got
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    judged = {r.page_id: r for r in urlrules.judge(pages, urlrules.rule_table(spark, [("none", "/", "block")]), mined).collect()}
    for i, (u, _) in enumerate(rows):
        fires = [v for c, (_, v) in want.items() if set(c) <= set(tokens[u])]
        assert judged[i].verdict == ("block" if fires else "allow")
        assert (judged[i].confidence and round(judged[i].confidence, 12)) == (max(fires) if fires else None)


def test_mining_needs_unwanted_pages(spark):
    table = spark.createDataFrame([("http://a/b", False)], "url string, unwanted boolean")
    assert urlrules.mine(table).count() == 0
    assert urlrules.mine(table.limit(0)).count() == 0
    assert urlrules.mine(spark.createDataFrame([("http://a/b", True)], "url string, unwanted boolean")).count() == 0


# 12


def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute_trie(convs):
    nodes = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    ends = {p: ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))) for p, m in nodes.items()}
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -(10**9), len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, m in nodes.items()
    )


def got_trie(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-(10**9) if v is None else v for v in r) for r in df.select(columns).collect())


def talk(seed, n, vocabulary, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, longest))):
            word = str(rng.choice(vocabulary[: 1 + t % len(vocabulary)]))
            rows.append((int(c * 7 % 1000), t, ["user", "assistant", None][t % 3], word))
    return rows


AWKWARD = [
    (None, 0, "user", "nobody's"), (-5, 0, "user", "a"), (-5, None, "user", "first"), (-100, 3, None, None), (-100, 3, None, None),
    (400, 0, "user", ""), (400, 1, "", "x" * 5000), (401, 0, "user", "🎉é"), (401, 0, "assistant", "tie"), (401, 0, "assistant", "a tie"),
    (402, 0, "use", "ra"), (403, 0, "user", "a"), (2**62, 0, "user", "far"), *[(777, t, "user", "same") for t in range(300)],
]


@pytest.mark.parametrize(("rows_in_block", "fan"), [(1 << 16, 16), (3, 2), (1, 3)])
def test_trie_against_brute_force(spark, monkeypatch, rows_in_block, fan):
    monkeypatch.setattr(prefixtrie, "ROWS", rows_in_block)
    monkeypatch.setattr(prefixtrie, "FAN", fan)
    monkeypatch.setattr(prefixtrie, "IDS", 5)
    rows = talk(1, 120, ["a", "b", "é🎉"], 9) + AWKWARD + [(c, 0, "user", "hot") for c in range(1000, 1090)]
    table = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    assert got_trie(prefixtrie.nodes(prefixtrie.sequences(table.repartition(7)))) == brute_trie(rebuilt(rows))


@pytest.mark.parametrize("seed", range(4))
def test_blocks_of_one_trie_in_every_cut(seed):
    """The contraction alone, on sequences over few turns, with blocks of one to a few rows."""
    rng = np.random.default_rng(seed)
    convs = {c: [("u", str(x)) for x in rng.integers(0, 2, rng.integers(0, 6))] for c in range(40)}
    keyed = sorted(("".join(hashlib.md5(f"1:u{t}".encode()).hexdigest() for _, t in turns), c, [len(t) for _, t in turns]) for c, turns in convs.items())
    blocks = [prefixtrie.Block()]
    for key, c, sizes in keyed:
        if blocks[-1].items and rng.random() < 0.4:
            blocks.append(prefixtrie.Block())
        list(blocks[-1].row(key, c, np.array(sizes, int)))
    forms, rows = [], []
    for number, block in enumerate(blocks):
        done = list(block.close())
        forms += [f | {"block": number} for k, f in done if k == "form"]
        rows += [r for k, r in done if k == "node"]
    keys = [f["key"] for f in forms]
    links = [f["link"] if f["at"] else (prefixtrie.common_turns(keys[i - 1], keys[i]) if i else 0) for i, f in enumerate(forms)]
    rows += prefixtrie.Forest(forms, links, True).finish()
    known = {r["key"]: r["conv_id"] for r in rows if r["key"]}
    got = collections.Counter()
    for r in rows:
        parent = r["parent_conv_id"] if r["parent_conv_id"] is not None else known.get(r["parent_key"])
        got[(r["conv_id"], r["depth"], parent if r["depth"] == r["parent_depth"] + 1 else r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"])] += 1
    whole = {(x[0], x[1], None if x[2] < 0 else x[2], *x[3:6]) for x in brute_trie(convs)}
    assert set(got) <= whole and max(got.values()) == 1
    # What is not listed lies inside a node's stretch: one child.
    assert all(x[4] == 1 for x in whole - set(got))


def test_trie_of_nothing_and_of_one(spark):
    table = spark.createDataFrame(AWKWARD[:1], "conv_id long, turn long, role string, text string")
    assert prefixtrie.nodes(prefixtrie.sequences(table)).count() == 0
    # crc32("3") % 6 turns come from conversation 0, which is absent.
    rows = [(3, 0, "user", "only")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got_trie(prefixtrie.nodes(prefixtrie.sequences(table))) == brute_trie(rebuilt(rows))


# 13


def vectors(seed=3, n=150, d=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * np.array([5, 4, 3, 2, 1, 0.5])[:d] + 3
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(0, base[0].tolist())] * 40 + [(None, base[1].tolist()), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0][:d]), (903, [math.nan] * d)]
    return rows + [(904, [math.inf] * d), (905, [0.0] * d), (906, [1.0] * (d + 1)), (907, [1e30] * d)]


def plain_whitening(rows, d, top):
    ok = [(i, v) for i, v in rows if v and len(v) == d and all(c is not None and math.isfinite(c) and abs(c) < 2**55 for c in v)]
    xs = [[math.floor(64 * c) + 1000000 for c in v] for _, v in ok]
    fit = np.array(sorted(set(map(tuple, xs))), float)
    n, mean = len(fit), fit.mean(0)
    value, vector = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    order = np.argsort(-value)[:top]
    whole = sorted(set(map(tuple, xs)))
    sums = [sum(x[k] for x in whole) for k in range(d)]
    return [(i, x, n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), (np.array(x) - mean) @ vector[:, order] / np.sqrt(value[order])) for (i, _), x in zip(ok, xs, strict=True)], value[order] / value.sum()


def test_whitening_against_numpy(spark):
    rows, d = vectors(), 6
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, component string, n int").repartition(5)
    got = whitening.whiten(table).collect()
    want, explained = plain_whitening(rows, d, 16)
    assert len(got) == d * len(want)
    assert max(r.identity_error for r in got) < 1e-9
    by = collections.defaultdict(list)
    for r in got:
        by[(r.vec_id, r.deviation)].append(r)
    signs = np.zeros(d)
    for i, _, n, deviation, w in want:
        have = by[(i, deviation)]
        for r in have:
            k = r.component - 1
            assert r.n == n and abs(r.explained - explained[k]) < 1e-9 * explained[k]
            signs[k] = signs[k] or (np.sign(r.whitened * w[k]) if abs(w[k]) > 0.01 else 0)
            assert abs(r.whitened - (signs[k] or 1) * w[k]) < 1e-8 or (not signs[k] and abs(w[k]) <= 0.01)


def test_rank_and_single_vectors(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))

    line = [(i, [float(i), float(2 * i), 5.0]) for i in range(5)]
    got = run(line).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert abs(sum(r.whitened**2 for r in got) / 5 - 1) < 1e-12
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0
    assert run(line[:0]).count() == 0
    cross = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -1.0])]  # equal eigenvalues
    got = run(cross).collect()
    assert sorted({r.component for r in got}) == [1, 2] and got[0].identity_error < 1e-12 and abs(got[0].explained - 0.5) < 1e-12


def leverrier(a):
    """Characteristic polynomial in fractions, by traces."""
    d = len(a)
    c, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = sum(a[i][t] * m[t][i] for i in range(d) for t in range(d))
        c.append(-am / k)
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("rank", [5, 2, 0])
def test_polynomial_and_roots(spark, rank):
    rng = np.random.default_rng(rank)
    b = rng.integers(-(10**6), 10**6, (5, max(rank, 1))) * (rank > 0)
    a = [[int(v) for v in row] for row in b.astype(object) @ b.T.astype(object)]
    poly = whitening.characteristic_polynomial(spark, a)
    assert poly == leverrier(a)
    true = np.sort(np.linalg.eigvalsh(np.array(a, float)))[::-1]
    for k in range(1, 6):
        found = whitening.root(poly, k)
        assert (found is None) == (k > rank)
        if found:
            assert abs(float(found[0]) - true[k - 1]) < 1e-6 * true[0]


def test_sums_of_very_large_entries_are_exact(spark):
    rng = np.random.default_rng(9)
    y = [[int(v) for v in row] for row in rng.integers(-(2**60), 2**60, (40, 3))]
    n, s, m = whitening.scatter(spark.createDataFrame([(r,) for r in y], "y array<long>").repartition(4), 3)
    assert n == 40 and s == [sum(c) for c in zip(*y, strict=True)]
    assert m == [[40 * sum(r[i] * r[j] for r in y) - s[i] * s[j] for j in range(3)] for i in range(3)]


def test_tokens_beyond_the_most_telling_ones_are_mined_too(spark):
    """Eight folders tell more than each of the three keys that only together decide: a cut at eight tokens lost their rule."""
    folders = "/".join(f"f{k}" for k in range(8))
    rows = []
    for i in range(320):
        unwanted = i % 8 == 7
        keys = "&".join(f"{k}=1" for k, bit in (("x", 1), ("y", 2), ("z", 4)) if i & bit)
        rows.append((f"http://a.org/{folders + '/' if unwanted or i // 8 % 3 == 0 else ''}p.html?{keys}", unwanted))
    table = spark.createDataFrame(rows, "url string, unwanted boolean")
    tokens = {r.url: r.t for r in table.select("url", urlrules.tokens(F.col("url")).alias("t")).collect()}
    got = {tuple(r["items"]): (r.support, round(r.confidence, 12)) for r in urlrules.mine(table, support=0.01).collect()}
    assert got == brute_rules(rows, tokens, urlrules.LEAST, urlrules.CONFIDENCE, None)
    assert got[("key:x", "key:y", "key:z")] == (40, 1.0)
