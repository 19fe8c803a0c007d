"""Operators 3, 5, 6, 8 and 10: what they say of whole texts, against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtline.llm import language_id, packing, piece_model, repetition, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(rows, key):
    """Rows in an order that doesn't depend on partitions; ids may be null."""
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in key(r)))


def test_token_counts(edge_docs, edge_rows, no_docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in edge_rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    got = [tuple(r) for r in token_counts.token_counts(edge_docs).collect()]
    assert by_row(got, lambda r: r) == by_row(want, lambda r: r)
    assert token_counts.token_counts(no_docs).count() == 0
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    few = edge_docs.filter("doc_id < 20")
    for r in token_counts.token_counts(few, tokenizer="piece_bpe_32k.model").join(few.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"), "text"), ["doc_id", "n_bytes"]).collect():
        assert r["n_tokens"] == len(sp.encode(r["text"] or ""))


def test_piece_model_round_trip_and_parity(edge_docs, edge_rows, no_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = piece_model.encode(edge_docs)
    want = [(i, None if t is None else sp.encode(t)) for i, t in edge_rows]
    rows = coded.collect()
    assert all(r["parity"] for r in rows)
    assert by_row([(r["doc_id"], r["ids"]) for r in rows], lambda r: (r[0], r[1])) == by_row(want, lambda r: (r[0], r[1]))
    back = piece_model.decode(coded).select("doc_id", "text").collect()
    assert by_row([tuple(r) for r in back], lambda r: r) == by_row(edge_rows, lambda r: r)
    assert piece_model.encode(no_docs).count() == 0


def test_unigram_model_is_rebuilt(tmp_path):
    """A unigram model of hand-written scores keeps them."""
    def field(n, kind, body):
        return bytes([n << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -1.0, 1), ("ab", -1.5, 1), ("b", -1.0, 1)]
    import struct
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([t]))) for p, s, t in pieces)
    data += field(2, 2, field(3, 0, bytes([1]))) + field(3, 2, field(3, 0, bytes([1])) + field(4, 0, bytes([0])))
    model = piece_model.PieceModel.parse(data)
    assert model.kind == piece_model.UNIGRAM and model.scores[3] == -1.5
    assert model.tokenizer().encode(" ab", add_special_tokens=False).ids == [1, 3]


def piece_file(pieces, kind, normaliser, fallback=False):
    """A model's bytes from (piece, score, type), model type and the fields of its normaliser."""
    import struct

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def field(n, wire, body):
        return varint(n << 3 | wire) + (varint(len(body)) + body if wire == 2 else body)
    out = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, varint(t))) for p, s, t in pieces)
    trainer = field(3, 0, varint(kind)) + (field(35, 0, varint(1)) if fallback else b"")
    rules = b"".join(field(n, 2 if isinstance(v, bytes) else 0, v if isinstance(v, bytes) else varint(v)) for n, v in normaliser.items())
    return out + field(2, 2, trainer) + field(3, 2, rules)


UNIGRAM_PIECES = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), ("ab", -9.0, 5), ("▁", -2.0, 1), ("▁a", -2.25, 1), ("abc", -2.5, 1), ("[user]", 0.0, 4),
                  ("▁b▁c", -3.0, 1), *((c, -4.0 - k / 8, 1) for k, c in enumerate("abcdefgh<>/s0x41")), ("fi", -3.5, 1), ("é", -5.0, 1)]
NORMALISED_TEXTS = ["", " ", "   ", "abc  abc", "  abc b c ", "b c", "<s>abc</s>", "<unk>", "<0x41>", "[user]abc", "x[user][user]", "ﬁ Ａ ａ", "e\u0301 é", "a\u00a0b\tc\nd", "\u3000a\u200bb", "日本 a", "🙂", "▁a ▁", "a ▁", "ab" * 50, "ℌ①½",
                    None]


@pytest.mark.parametrize("trim", [0, 1])
@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_models_with_normalisers_against_the_library(tmp_path, trim, rule, fallback):
    """Charsmap, extra blanks, byte fallback; texts that spell out control, unknown, unused and byte pieces."""
    rules = {3: 1, 4: trim}
    if rule != "identity":
        spec = dict(piece_model.wire_fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()))
        rules[2] = dict(piece_model.wire_fields(spec[3]))[2]
    pieces = UNIGRAM_PIECES if fallback else [p for p in UNIGRAM_PIECES if p[2] != piece_model.BYTE]
    path = str(tmp_path / "own.model")
    with open(path, "wb") as f:
        f.write(piece_file(pieces, piece_model.UNIGRAM, rules, fallback))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got, agree = {}, {}
    for i, _, ids, at, parity in piece_model.encode_batch(pa.array(NORMALISED_TEXTS), path):
        for k in range(len(parity)):
            got[i + k], agree[i + k] = ids[at[k]:at[k + 1]].tolist(), bool(parity[k])
    for k, t in enumerate(NORMALISED_TEXTS):
        assert got[k] == sp.encode(t or ""), (t, sp.encode(t or "", out_type=str))
        assert agree[k]


def test_models_that_are_refused():
    with pytest.raises(ValueError, match="user-defined"):
        piece_model.PieceModel.parse(piece_file(UNIGRAM_PIECES, piece_model.BPE, {4: 0}))
    with pytest.raises(ValueError, match="blanks"):
        piece_model.PieceModel.parse(piece_file(UNIGRAM_PIECES, piece_model.UNIGRAM, {5: 0}))


def brute_repetition(t):
    w = WORD.findall(t or "")
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    longest, k = 0, 8
    while len(w) >= k and max(Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)).values()) > 1:
        longest, k = k, k + 1
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), longest, failed


def test_repetition_rules(edge_docs, edge_rows, no_docs):
    rows = repetition.repetition_rules(edge_docs).collect()
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["longest_repeat"], r["base_failed"]) for r in rows]
    want = [(i, *brute_repetition(t if len(t or "") < 20_000 else t)) for i, t in edge_rows]
    assert by_row(got, lambda r: r) == by_row(want, lambda r: r)
    assert not any(r["kept"] for r in rows if r["base_failed"])
    assert any(r["kept"] for r in rows)
    kept = repetition.keep_unrepeated(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert repetition.repetition_rules(no_docs).count() == repetition.keep_unrepeated(no_docs).count() == 0


def test_the_longest_repeat_rejects_by_itself(spark):
    def text(n, k):
        """n distinct words, the first k of them once more at the end."""
        words = [f"w{x}" for x in range(n)]
        return " ".join([*words, "between", *words[:k]])
    rows = [(1, text(6000, 900)), (2, text(6000, 65)), (3, text(6000, 64)), (4, text(6000, 0)), (5, text(200, 20)), (6, text(200, 150))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["longest_repeat"], r["base_failed"], r["kept"]) for r in repetition.repetition_rules(df).collect()}
    assert got == {1: (900, False, False), 2: (65, False, False), 3: (64, False, True), 4: (0, False, True), 5: (20, False, True), 6: (150, True, False)}
    assert sorted(r["doc_id"] for r in repetition.keep_unrepeated(df).collect()) == [3, 4, 5]


def test_suffix_ranks_are_a_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 40, 3)
        seqs = [rng.integers(0, 3, n) for n in sizes]
        symbols = np.concatenate([s + 10 * k for k, s in enumerate(seqs)])
        ends = np.repeat(np.cumsum(sizes), sizes)
        order, levels = repetition.suffix_ranks(symbols, ends)
        suffix = lambda p: tuple(symbols[p:ends[p]])  # noqa: B023, E731
        # within a group of equal 8-symbol prefixes neighbours share what the arrays say
        lcp = repetition.common_prefixes(order, levels, ends, 1)
        for k in range(1, len(order)):
            a, b = suffix(order[k - 1]), suffix(order[k])
            common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert lcp[k] == common


def test_packing(edge_docs, edge_rows, no_docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(edge_docs, length=64, window=512).collect()
    full = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in edge_rows)
    # pieces are those of some document of that id, each id in one piece
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"], r["doc_tokens"]].append(r)
    want = Counter()
    for (i, ids), c in full.items():
        want[i, len(ids)] += c * len(ids)
    assert {k: sum(r["length"] for r in v) for k, v in docs.items()} == dict(want)
    sums = defaultdict(set)
    for i, ids in full:
        sums[i, len(ids)].add(ids)
    for r in rows:
        assert any(zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for ids in sums[r["doc_id"], r["doc_tokens"]])
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(used) == list(range(len(used)))
    for s, spans in used.items():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at == 64 or s == len(used) - 1
    assert packing.pack(no_docs).count() == 0


def test_packing_keeps_the_mixture(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("of it "), (F.col("id") % 40).cast("int"))).alias("text"), F.when(F.col("id") % 3 > 0, "a").when(F.col("id") % 2 == 0, "b").otherwise("c").alias("source")).repartition(5)
    for weights in (None, {"a": 1, "b": 2, "c": 1}):
        rows = packing.pack(docs, length=32, window=640, weights=weights).collect()
        total, got, last = Counter(), defaultdict(Counter), {}
        for r in rows:
            total[r["source"]] += r["length"]
            got[r["window_id"]][r["source"]] += r["length"]
            last[r["source"]] = max(last.get(r["source"], 0), r["window_id"])
        windows = -(-sum(total.values()) // 640)
        for w, c in got.items():
            for s in total:
                share = total[s] / windows if weights is None else 640 * weights[s] / 4
                if weights is None and w < windows or weights and w < last[s]:
                    assert abs(c[s] - share) <= 1          # the deficit is under one token


def test_packing_of_many_sources(spark, edge_docs, monkeypatch):
    """More sources than the plan of a task takes: the same pieces by a joined table."""
    cases = (None, {"s0": 3, "s1": 1})
    want = [sorted(packing.pack(edge_docs, length=64, window=512, weights=w).collect(), key=str) for w in cases]
    few = spark.range(40).selectExpr("id as doc_id", "'a b' as text", "if(id < 2, 'x', 'y') as source")  # fewer tokens of x than windows
    want.append(sorted(packing.pack(few, length=4, window=8).collect(), key=str))
    monkeypatch.setattr(packing, "MAX_SOURCES", 1)
    got = [sorted(packing.pack(edge_docs, length=64, window=512, weights=w).collect(), key=str) for w in cases]
    got.append(sorted(packing.pack(few, length=4, window=8).collect(), key=str))
    assert got == want
    monkeypatch.undo()
    hosts = spark.range(10_050).selectExpr("id as doc_id", "'of it' as text", "concat('host', id) as source")
    rows = packing.pack(hosts, length=64, window=4096).collect()
    assert len({r["doc_id"] for r in rows}) == 10_050
    placed = sorted((r["sequence_id"] * 64 + r["offset"], r["length"]) for r in rows)
    assert [a for a, _ in placed] == list(np.cumsum([0, *(n for _, n in placed)])[:-1])


def test_packing_of_a_tokenizer_that_keeps_case(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Hello World, HELLO <|endoftext|> World's  end.\n\nÉCOLE 你好", None, "A" * 300]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id bigint, text string, source string")
    rows = packing.pack(docs, tokenizer="byte_bpe_50k.json", end_id=50256).collect()
    for k, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 50256], "<u4")
        assert [(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == k] == [(len(ids), zlib.crc32(ids.tobytes()))]


def test_language_model_learns_and_rejects():
    rng = np.random.default_rng(3)
    sound = {"xx": ["ka", "ro", "mi", "ta"], "yy": ["schu", "ver", "lich", "en"], "zz": ["été", "ment", "eau", "qu"]}
    texts, labels = [], []
    for k in range(240):
        lang = sorted(sound)[k % 3]
        texts.append(" ".join("".join(rng.choice(sound[lang], 3)) for _ in range(30)).encode())
        labels.append(lang)
    model = language_id.train(texts[:180], labels[:180])
    data, offsets = np.frombuffer(b"".join(texts[180:]), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts[180:]])])
    best, score, _ = model.predict(data, offsets)
    assert np.mean([model.languages[b] == x for b, x in zip(best, labels[180:], strict=True)]) >= 0.95
    assert ((score > 0) & (score <= 1)).all() and 0 <= model.threshold <= 0.5
    mixed = b"".join(t[:40] for t in texts[:30])
    assert model.predict(np.frombuffer(mixed, np.uint8), np.array([0, len(mixed)]))[1][0] < score.mean()


FOREIGN = ["привет мир как дела сегодня утром " * 6, "你好世界今天天气很好" * 8, "καλημέρα κόσμε τι κάνεις " * 6, "0101 1101 x0x1 9f3e aa07 " * 8, "xqzj wvkkq zzxqj qwrtp vbnmx " * 6]


def test_rejection_of_texts_in_no_known_language(spark, small_dir):
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz     ")
    noise = [f.encode() for f in FOREIGN] + ["".join(rng.choice(letters, n)).encode() for n in rng.integers(80, 1500, 60)]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet".replace("sf0.001", "sf0.01")).filter("text is not null").select("doc_id", "text", "lang", language_id.held_out().alias("held"))
    rows = docs.collect()
    for langs in (["en", "de"], ["en", "de", "fr", "es"]):
        known = [r for r in rows if r["lang"] in langs]
        model = language_id.train([r["text"].encode() for r in known if not r["held"]], [r["lang"] for r in known if not r["held"]])
        assert model.languages == sorted(langs)
        _, score, fine = model.predict(*language_id.joined(noise))
        assert fine.mean() <= 0.02 and (score > 0).all()
        assert model.predict(*language_id.joined([r["text"].encode() for r in known if r["held"]]))[2].mean() >= 0.99
    other = [r["text"].encode() for r in rows if r["lang"] in ("fr", "es") and len(r["text"]) > 300]
    two = language_id.train([r["text"].encode() for r in rows if r["lang"] in ("en", "de")], [r["lang"] for r in rows if r["lang"] in ("en", "de")])
    assert two.predict(*language_id.joined(other))[2].mean() <= 0.1


def test_many_languages_and_bounded_samples(spark):
    """More languages than the embedding has numbers; long texts give a stretch; ties go by name."""
    rng = np.random.default_rng(5)
    names = [f"l{k:04d}" for k in range(1100)]
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in names]
    model = language_id.train([f"{w} {w} {w}".encode() for w in words for _ in range(2)], [n for n in names for _ in range(2)])
    assert len(model.languages) == 1100 and model.table.shape[1] == language_id.DIMENSIONS + 1
    best, score, _ = model.predict(*language_id.joined([w.encode() for w in words]))
    assert ((score > 0) & (score <= 1)).all() and len(best) == 1100
    few = language_id.train([b"ka ro mi ta"] * 40 + [b"schu ver lich"] * 40, ["b"] * 40 + ["a"] * 40)
    few.table[:] = 0
    few.bias[:] = 0
    assert few.predict(*language_id.joined([b"schu"]))[0].tolist() == [0]
    docs = spark.createDataFrame([(k, ("ka ro mi " if k % 2 else "schu ver ") * 20_000, "xy"[k % 2]) for k in range(30)], "doc_id bigint, text string, lang string")
    seen = []
    try:
        keep, language_id.train = language_id.train, lambda texts, labels, **o: seen.append((texts, labels))
        language_id.fit(docs, sample_rows=10, sample_chars=500)
    finally:
        language_id.train = keep
    texts, labels = seen[0]
    assert sorted(labels) == ["x"] * 5 + ["y"] * 5 and {len(t) for t in texts} == {500}


def test_language_query(edge_docs, edge_rows, no_docs, spark, small_dir):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in edge_rows}
    model = language_id.fit(edge_docs)
    rows = language_id.identify(edge_docs, model).withColumn("held", language_id.held_out()).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert r["held"] == held[r["doc_id"]] and 0 <= r["score"] <= 1
        assert r["lang_pred"] in {*model.languages, "und"}
    und = Counter(r["doc_id"] for r in rows if r["lang_pred"] == "und")
    assert und == Counter(i for i, t in edge_rows if not any(map(str.isalpha, t or "")))
    assert not any(r["accepted"] for r in rows if r["lang_pred"] == "und")
    none = language_id.fit(no_docs)
    assert {r["lang_pred"] for r in language_id.identify(edge_docs, none).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    right = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter(language_id.held_out())
    n, ok, kept = right.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("accepted").cast("int"))).first()
    assert n > 20 and ok >= 0.95 * n and kept >= 0.99 * n
