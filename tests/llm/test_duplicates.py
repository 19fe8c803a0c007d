"""Operators 1, 7 and 9 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.llm import bwt_dedup, chosen_path, components, product_quantisation

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(203, 201), (201, 202), (202, 203), (300, 300), (None, 5)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 201: 201, 202: 201, 203: 201}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(rows, size):
    sets, sh = Sets(), [(i, shingles(t, size)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sh):
        sets.find(i)
        for j, b in sh[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                sets.join(i, j)
    return sets


def check_near(df, rows, size, **options):
    got = chosen_path.near_duplicates(df, shingle=size, **options).collect()
    sets = brute_components(rows, size)
    empty = Counter((i, 0) for i, t in rows if not shingles(t, size))
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(shingles(t, size))) for i, t in rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            want = r["doc_id"] if (r["doc_id"], r["n_shingles"]) in empty else sets.find(r["doc_id"])
            assert r["component_id"] == want and r["kept"] == (want == r["doc_id"])


def test_near_duplicates_on_edge_cases(edge_docs, edge_rows, no_docs):
    check_near(edge_docs, edge_rows, 4)
    assert chosen_path.near_duplicates(no_docs).count() == 0


def family(rng, base, changes):
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"w{rng.randrange(5000)}"
    return " ".join(w)


def test_near_duplicates_at_the_threshold_and_in_large_nodes(spark, monkeypatch):
    """Families around the threshold, with nodes that must branch and be split in blocks."""
    rng = random.Random(4)
    rows, k = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(60)]
        for _ in range(8):
            rows.append((k, family(rng, base, rng.randrange(0, 4))))
            k += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_near(df, rows, 4)
    kept = chosen_path.one_of_each(df, shingle=4)
    assert kept.columns == df.columns and kept.count() == len({brute_components(rows, 4).find(i) for i, _ in rows})
    monkeypatch.setattr(chosen_path, "LEAF", 3)
    monkeypatch.setattr(chosen_path, "BLOCK", 3)
    monkeypatch.setattr(chosen_path, "DEPTH", 2)
    check_near(df, rows, 4)


def test_large_nodes_cost_rows_in_proportion_to_their_members(spark, monkeypatch):
    """Different copies of one text, and texts that share much with it but link nothing: all links, and no block of the copies meets another."""
    for name, value in (("LEAF", 8), ("BLOCK", 16), ("DEPTH", 2)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(k, family(rng, base, 1 + k % 3)) for k in range(240)]
    seen, left_apart = {}, chosen_path._left_apart

    def spy(deep, known):
        out = left_apart(deep, known)
        seen["members"], seen["rows"] = deep.count(), out.count()
        return out

    monkeypatch.setattr(chosen_path, "_left_apart", spy)
    check_near(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 4)
    assert seen["members"] > 240 and seen["rows"] == 0           # all is one component, no pairs of blocks are left
    rows += [(1000 + k, family(rng, base, 14)) for k in range(60)] + [(2000 + k, family(rng, rows[k][1].split(" "), 6)) for k in range(60)]
    check_near(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 4)
    assert 0 < seen["rows"] < seen["members"] ** 2 / 16 / 4


def test_recall_of_the_trees():
    """Pairs at the very threshold share a node in some tree as often as promised, although all trees share their coordinates."""
    assert math.isclose(chosen_path.survival(0.8, 1), 0.84)
    for recall in (0.9, 0.99, 0.9999):
        trees = chosen_path.trees_needed(0.8, recall)
        assert chosen_path.missed(0.8, trees) <= 1 - recall < chosen_path.missed(0.8, trees - 1)
    with pytest.raises(ValueError):
        chosen_path.trees_needed(0.8, 1 - 1e-9)
    rng, pairs = np.random.default_rng(2), 600
    found = Counter()
    for _ in range(pairs):
        same = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
        a, b = (chosen_path.minwise(np.concatenate([same, rng.integers(0, 1 << 63, 100, dtype=np.uint64)])) for _ in range(2))
        for t in range(1, 10):
            keys = [np.array([t], np.uint64)] * 2
            for _ in range(chosen_path.DEPTH):
                keys = [chosen_path.branch(k, np.repeat(c[None], len(k), 0), 0.8)[0] for k, c in zip(keys, (a, b), strict=True)]
            if set(keys[0].tolist()) & set(keys[1].tolist()):
                found.update(range(t, 10))
                break
    for trees in range(1, 10):
        miss = chosen_path.missed(0.8, trees)
        assert abs((pairs - found[trees]) - pairs * miss) <= 4 * math.sqrt(pairs * miss) + 1


def brute_removal(rows, length=100):
    """Of each (id, text): what the operator says."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = {}, {}
    ids = Counter(i for i, _ in set(rows))
    for i, t in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\1" * length
            else:
                seen[w] = k
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i, t] = (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out, ids


def test_repeats_on_edge_cases(edge_docs, edge_rows, no_docs):
    want, ids = brute_removal([r for r in edge_rows if r[0] is not None])
    got = [tuple(r) for r in bwt_dedup.remove_repeats(edge_docs).collect()]
    assert len(got) == len(edge_rows)
    once = {i for i, c in ids.items() if c == 1}      # texts that share an id are ordered by a hash
    assert Counter(g for g in got if g[0] in once) == Counter(want[r] for r in edge_rows if r[0] in once)
    assert bwt_dedup.remove_repeats(no_docs).count() == 0
    back = bwt_dedup.without_repeats(edge_docs, chars_col="n_chars")
    assert back.columns == edge_docs.columns and back.schema == edge_docs.schema
    lengths = {r["doc_id"]: (len(r["text"]), r["n_chars"], r["source"]) for r in back.filter("doc_id in (-3, 1, 8)").collect()}
    assert lengths[1][0] == 0 < lengths[-3][0] == lengths[-3][1] and lengths[8][0] == 4


def test_repeats_with_hot_anchors_resolved_as_rows(spark):
    rng = random.Random(9)
    words = [f"{rng.choice('abcdefgh')}{k}" for k in range(400)]
    shared = " ".join(rng.choices(words, k=70))
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(5, 80))) + shared[rng.randrange(0, 60):rng.randrange(120, len(shared))] + " ".join(rng.choices(words, k=20))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = Counter(brute_removal(rows)[0].values())
    assert sum(w[2] for w in want) > 0
    for hot in (2, 10, 10_000):
        assert Counter(tuple(r) for r in bwt_dedup.remove_repeats(df, hot=hot).collect()) == want


def test_repeated_rows_and_long_runs(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    alone, line = " ".join(word() for _ in range(60)), "the same line over and over " * 30
    rows = [(1, alone), (1, alone), (2, word() + line), (3, line), (4, "=" * 900), (5, "ab" * 300), (6, "x" + "ab" * 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    want = brute_removal(rows)[0]
    assert want[1, alone][2] == 0 and want[4, "=" * 900][2] > 0
    for hot in (3, 10_000):
        assert Counter(tuple(r) for r in bwt_dedup.remove_repeats(df, hot=hot).collect()) == Counter(want[r] for r in rows)


def test_merge_holds_whole_groups_across_batches(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "MERGE_ROWS", 7)
    rng = random.Random(10)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(300))
    rows = [(k, f"{k} " + passage[k % 3:200 + k]) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(tuple(r) for r in bwt_dedup.remove_repeats(df).collect()) == Counter(brute_removal(rows)[0].values())


def brute_vectors(rows, threshold):
    sets, links, good = Sets(), defaultdict(int), []
    for k, (i, v, label) in enumerate(rows):
        sets.find(k)
        ok = i is not None and v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            x = np.array(v, float)
            good.append((k, x / np.sqrt((x * x).sum()), label))
    for n, (k, x, a) in enumerate(good):
        for j, y, b in good[:n]:
            if a == b and len(x) == len(y) and x @ y >= threshold:
                links[k] += 1
                links[j] += 1
                sets.join(k, j)
    low = defaultdict(lambda: None)
    for k, _, _ in good:
        r = sets.find(k)
        low[r] = rows[k][0] if low[r] is None else min(low[r], rows[k][0])
    is_good = {k for k, _, _ in good}
    return [(i, links[k], low[sets.find(k)] if k in is_good else i) for k, (i, _, _) in enumerate(rows)]


def vector_rows():
    rng = np.random.default_rng(6)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                v = (centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3])).astype(np.float32)
                rows.append((k, [float(x) for x in v], label))
                k += 1
    nan, inf = float("nan"), float("inf")
    return rows + [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [nan] + [1.0] * 15, 0), (904, [inf] * 16, 0), (905, [None] + [1.0] * 15, 0), (None, rows[0][1], 0), (906, rows[0][1], 0), (906, rows[0][1], 0),
                   (907, [2 * x for x in rows[0][1]], 0), (908, rows[0][1][:8], 0), (909, [-0.0] * 15 + [1.0], 1), (910, [0.0] * 15 + [3.0], 1)]


def test_embedding_duplicates(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, rep string, links string").repartition(3)
    want = Counter(brute_vectors(rows, 0.93))
    for options in ({}, {"lists": 16, "block": 5, "train_rows": 60}):
        got = product_quantisation.embedding_duplicates(df, **options).collect()
        assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
        assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    assert product_quantisation.embedding_duplicates(df.limit(0)).count() == 0
    assert product_quantisation.embedding_duplicates(df.filter(F.col("label").isNull())).filter("not kept or n_links > 0").count() == 0


def test_contexts_that_share_a_hash_only_go_on():
    """With one hash for all, bytes decide what is a repeat."""
    from courtline.llm import bwt_dedup
    data = np.frombuffer(b"0123456789abcdef" * 3 + b"0123456789abcdeX" + b"0123456789abcdef", np.uint8)
    starts = np.array([0, 16, 32, 48, 64, 0])
    size, left = np.array([16, 16, 16, 16, 15, 16]), np.array([4, 4, 5, 4, 4, 4])
    same = np.zeros(6, np.uint64)
    again, kept = bwt_dedup.earliest(same, (np.array([7, 8, 9, 10, 11, 7]), np.zeros(6, np.int64), np.zeros(6, np.int64)), starts, left, size, data)
    assert again.tolist() == [1] and kept.tolist() == [0, 2, 3, 4]          # 2: another anchor place, 3: another byte, 4: shorter; 5 is row 0 again
    same_spans = bwt_dedup.T.same_spans(data, np.array([0, 0, 0, 0]), np.array([16, 48, 48, 5]), np.array([32, 16, 15, 0]))
    assert same_spans.tolist() == [True, False, True, True]
