"""Operators 11, 12 and 13 against plain Python."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.llm import curve_clusters, textops, url_aliases, word_runs
from tests.llm.test_texts import by_row

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "bad.org/"), ("block", "both.org/x"), ("allow", "both.org/x")]


def split_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(url, rules):
    host, path = split_url(url)
    fits = [(len(r), v == "allow", r, v) for v, r in rules
            if host and (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[2:] if fits else (None, None)


def brute_node(url):
    host, path = split_url(url)
    query = re.match(r"[^#]*?://[^#?]*(\?[^#]*)?", url)
    return re.sub(r":(80|443)?$", "", host) + (path or "/") + (query and query[1] or "") if host else None


def brute_urls(pages, redirects, rules):
    """pages: (id, url, links)."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    edges = [(u, urljoin(u, to)) for _, u, links in pages if u for to in links] + redirects
    urls = {u for _, u, _ in pages if u}
    for a, b in edges:
        if a and b and brute_node(a) and brute_node(b):
            parent[root(brute_node(a))] = root(brute_node(b))
            urls |= {a, b}
    told = {}
    for u in urls:
        v = brute_rule(u, rules)[1]
        if v and brute_node(u) in parent:
            told.setdefault(root(brute_node(u)), set()).add(v)
    out = []
    for i, u, _ in pages:
        rule, verdict = brute_rule(u, rules) if u else (None, None)
        by = "rule" if verdict else "default"
        if not verdict and u and brute_node(u) in parent and (got := told.get(root(brute_node(u)))):
            verdict, by = ("allow" if "allow" in got else "block"), "alias"
        out.append((i, *split_url(u), rule, verdict or "allow", by))
    return out


@pytest.fixture(scope="module")
def url_rows():
    """(id, url, html, links that the html states)."""
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "https://a.info/x", link.format("https://evil.net/y"), ["https://evil.net/y"]),                 # blocked by its alias
        (2, "http://A.info:80/x#top", None, []),                                                            # the same resource
        (3, "https://a.info/x?p=1", "<p>x", []),                                                            # another resource
        (4, "https://b.info/en", '<META content="0; URL=http://www.example.net/en/1" http-equiv=refresh>', ["http://www.example.net/en/1"]),
        (5, "https://b2.info/", "<link href='//b.info/en' rel='x Canonical'>" + link.format("http://z.net/"), ["//b.info/en", "http://z.net/"]),  # allow and block in a group: allow
        (6, "https://c.example.com/de/1", link.format("https://ok.org/fr/"), ["https://ok.org/fr/"]),       # its own rule stands
        (7, "https://c.info/d/e", link.format("../f?x=1&amp;y=2"), ["../f?x=1&y=2"]),
        (8, "https://c.info/f?x=1&y=2", link.format("/g"), ["/g"]),
        (9, "https://c.info/g", link.format("http://bad.org/"), ["http://bad.org/"]),                       # a chain
        (10, "https://d.info/", f"<!-- {link.format('http://evil.net/')} --><script>'{link.format('http://evil.net/')}'</script>", []),
        (11, None, link.format("http://evil.net/"), []), (12, "", "", []), (13, "no scheme", link.format("http://evil.net/"), ["http://evil.net/"]), (14, "http://", "", []),
        (None, "https://x.net", "", []), (15, "https://net/", "", []), (15, "https://net/", "", []), (16, "https://x.net?/q", "", []), (17, "https://X.NET/En://a/b", "", []),
        (18, "https://notnet/", "", []), (19, "https://é.net/ü", "", []), (20, "https://both.org/xy", "", []), (21, "https://r1.info/", "", []), (22, "https://r2.info/", "", []),
        (23, "https://e.info/", link.format("http://[bad"), []), (24, "https://www.example.net/en/1", "", []), (25, "https://e.info/" + "long/" * 3000, "x" * 100_000, []),
    ]
    rows += [(100 + k, f"https://hub{k}.info/", link.format("https://hub.info/"), ["https://hub.info/"]) for k in range(40)]
    return rows + [(99, "https://hub.info/", link.format("https://evil.net/hub"), ["https://evil.net/hub"])]


REDIRECTS = [("https://r1.info/", "https://r2.info/"), ("https://r2.info/", "https://bad.org/r"), (None, "https://r1.info/"), ("https://r1.info/", None), ("https://r1.info/", "nowhere")]


def test_url_aliases(spark, url_rows):
    clashes = ["rule", "verdict", "host", "path", "node", "a", "b", "component", "judged", "alias_group"]
    pages = spark.createDataFrame([r[:3] + ("x",) * len(clashes) for r in url_rows], "page_id bigint, url string, html string, " + ", ".join(f"{c} string" for c in clashes)).repartition(3)
    redirects = spark.createDataFrame(REDIRECTS, "from_url string, to_url string")
    got = [tuple(r) for r in url_aliases.filter_urls(pages, RULES, redirects=redirects).collect()]
    want = brute_urls([(i, u, links) for i, u, _, links in url_rows], REDIRECTS, RULES)
    assert by_row(got, lambda r: r) == by_row(want, lambda r: r)
    by_id = {r[0]: r[4:] for r in got}
    assert by_id[1] == by_id[2] == by_id[7] == by_id[8] == by_id[9] == by_id[21] == by_id[139] == ("block", "alias")
    assert by_id[4] == by_id[5] == ("allow", "alias") and by_id[6] == ("block", "rule") and by_id[3] == by_id[10] == ("allow", "default") and by_id[20] == ("allow", "rule")


def test_url_rules_as_a_table_and_empty_tables(spark, url_rows):
    pages = spark.createDataFrame([r[:3] for r in url_rows], "page_id bigint, url string, html string")
    table = spark.createDataFrame([*RULES, ("block", None), (None, "x/"), ("maybe", "info/")], "verdict string, rule string")
    got = [tuple(r) for r in url_aliases.filter_urls(pages, table).collect()]
    assert by_row(got, lambda r: r) == by_row(brute_urls([(i, u, links) for i, u, _, links in url_rows], [], RULES), lambda r: r)
    none = url_aliases.filter_urls(pages, table.limit(0)).collect()
    assert len(none) == len(url_rows) and {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}
    assert url_aliases.filter_urls(pages.limit(0), RULES).count() == 0


def brute_clusters(rows, k, rounds, dims, scale):
    def fine(v):
        return v is not None and len(v) == dims and all(x is not None and np.isfinite(x) and abs(np.floor(scale * x)) < 1 << 27 for x in v)
    vectors = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if fine(v)]
    order = sorted(vectors, key=lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), np.array(r[1], "<i4").tobytes()))
    cent = [v for _, v in order[:k]]

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        at = [min((dist(v, c), n) for n, c in enumerate(cent)) for _, v in vectors]
        if r < rounds:
            for n in range(len(cent)):
                own = [v for (_, v), (_, m) in zip(vectors, at, strict=True) if m == n]
                if own:
                    cent[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    by = {}
    for d, n in at if vectors else []:
        by[n] = by.get(n, 0) + d
    return [(i, n, d, by[n], sum(by.values()), hashlib.sha256(",".join(map(str, cent[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(vectors, at if vectors else [], strict=True)]


def test_curve_clusters(spark):
    rng = np.random.default_rng(3)
    dims = 6
    centres = rng.normal(0, 1, (5, dims))
    rows = [(k, (centres[k % 5] + rng.normal(0, 0.1, dims)).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(300)]                     # a hot copy
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [float("nan")] * 6), (2004, [1.0] * 5 + [None]), (2005, [float("inf")] + [0.0] * 5), (2006, [1e30] * 6),
             (2007, [0.0] * 6), (None, [0.5] * 6), (5, rows[9][1]), (5, rows[9][1]), (2008, [1000.0] * 6), (2009, [-1000.0] * 6)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, v string").repartition(5)
    for block_rows in (16, 512):
        got = curve_clusters.centroid_clusters(df, k=7, dims=dims, block_rows=block_rows).drop("compared").collect()
        assert by_row([tuple(r) for r in got], lambda r: r) == by_row(brute_clusters(rows, 7, 3, dims, 64), lambda r: r)
    few = df.filter("vec_id < 3")
    assert sorted(tuple(r) for r in curve_clusters.centroid_clusters(few, k=7, dims=dims).drop("compared").collect()) == sorted(brute_clusters(rows[:3], 7, 3, dims, 64))
    assert curve_clusters.centroid_clusters(df.limit(0), dims=dims).count() == 0
    assert curve_clusters.centroid_clusters(df.filter("vec_id = 2000"), dims=dims).count() == 0
    pruned = curve_clusters.centroid_clusters(df, k=7, dims=dims, block_rows=16).agg(F.avg("compared")).first()[0]
    assert pruned < 4                                                        # zone maps rule most of the 7 out


def test_large_vectors_are_compared_in_whole_numbers():
    x = np.array([[(1 << 27) - 1, 3], [-(1 << 27) + 1, 5]], np.int32)
    c = np.array([[-(1 << 27) + 1, 5], [(1 << 27) - 1, 2], [(1 << 27) - 1, 4]], np.int64)
    at, d = curve_clusters.nearest(x, c, np.arange(3))
    assert at.tolist() == [1, 0] and d.tolist() == [1, 0]


def test_hilbert_steps_to_neighbours():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        place = curve_clusters.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_boxes_never_rule_out_the_nearest():
    rng = np.random.default_rng(4)
    for _ in range(50):
        x, c = rng.integers(-20, 20, (30, 5)), rng.integers(-20, 20, (9, 5))
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        may = curve_clusters.candidates(x.min(0)[None].astype(float), x.max(0)[None].astype(float), c.astype(float))[0]
        assert may[np.flatnonzero((d == d.min(1)[:, None]).any(0))].all()


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted((s, m, q) for s, m, q in out)


def brute_doc(i, t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    n, h = len(w), 1 if i is None else zlib.crc32(str(i).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + m for s, m, q in runs)]
    return (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def runs_query(df):
    return word_runs.word_runs(df, plant=F.crc32(F.col("doc_id").cast("string").cast("binary"))).drop("n_words")


def test_word_runs(spark, edge_docs, edge_rows, no_docs):
    rows = [tuple(r) for r in runs_query(edge_docs.filter("doc_id is null or doc_id <> 20")).collect()]
    assert by_row(rows, lambda r: r) == by_row([brute_doc(i, t) for i, t in edge_rows if i != 20], lambda r: r)
    assert runs_query(no_docs).count() == 0
    rng = random.Random(6)
    odd = []
    for k in range(400):
        part = [rng.choice("ab"[:rng.randint(1, 2)] + "cde"[:rng.randint(0, 3)]) for _ in range(rng.randint(1, 9))]
        w = [rng.choice("abc") for _ in range(rng.randint(0, 12))] + part * rng.randint(1, 9) + part[:rng.randint(0, len(part))] + [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        odd.append((k, rng.choice([" ", "\n", " \t"]).join(w + (w[::-1] if k % 3 == 0 else w[3:] if k % 3 == 1 else []))))
    got = [tuple(r) for r in runs_query(spark.createDataFrame(odd, "doc_id bigint, text string").repartition(3)).collect()]
    assert sorted(got, key=str) == sorted((brute_doc(*r) for r in odd), key=str)
    assert sum(r[1] for r in got) > 400


def test_runs_of_frequent_words_take_no_square_of_time():
    n = 300_000
    begun = time.time()
    start, length, period = word_runs.find_runs(np.zeros(n, np.int64), np.full(n, n))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])
    x = np.random.default_rng(1).integers(0, 2, 5000)
    start, length, period = word_runs.find_runs(np.tile(x, 60), np.full(n, n))
    assert (0, n, 5000) in set(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert time.time() - begun < 30


def test_a_span_of_many_megabytes_is_hashed_at_once():
    data = np.frombuffer(b"a" * 10_000_000 + b" " + b"a" * 10_000_000 + b" " + b"a" * 9_999_999 + b"b", np.uint8)
    begun = time.time()
    h = textops.hash_spans(data, *textops.words(data, np.array([0, len(data)])))
    assert h[0] == h[1] != h[2] and time.time() - begun < 5
