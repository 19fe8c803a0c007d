"""Language identification (operator 5): averaged hashed subword embeddings under a linear softmax.

Training: up to ``per_language`` labelled rows of every language, and about
``sample_rows`` in all (those with the smallest hash of their id), come to the
driver; of a text over ``sample_chars`` a stretch of that size, from a place
chosen by hash.  These three bounds are parameters.
Byte n-grams of 2 to 4, A-Z lower-cased, are hashed into buckets; a snippet's
vector is the mean of its buckets' embeddings.  Embeddings and the softmax
layer are trained by stochastic gradient descent in numpy on snippets of mixed
length.  A fifth of the sample is kept back: it sets the softmax temperature
and what is rejected.

Rejection: a softmax compares the languages it knows, so its score can't tell a
text in none of them (with two languages it is never under one half).  What can
is how usual the text's 3-grams are in the sample: their mean log frequency,
less the kept-back texts' mean, times the root of their number.  Texts more
unusual than all but ``reject`` of the kept-back ones (and snippets of them, so
that short texts count), with a margin, are rejected; so are scores under the
same share of theirs.

Prediction: mean and layer are both linear, so a task adds up each bucket's
numbers over the whole text.  With up to DIMENSIONS languages these are its
logits, else its embedding, and the layer follows: the model that goes to tasks
has 3 * BUCKETS rows of DIMENSIONS + 1 numbers at most, however many languages
there are.

Defined cases: ``und`` with score 0 for a null text, one without a letter, and
where there is no labelled row at all; a text shorter than an n-gram is judged
by the bias and not rejected for its 3-grams; equally good languages: the first
by name; repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.store import tune

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
RANGE_BYTES = 2 << 20
#: 3-grams of a text that count as independent evidence, at most.
EVIDENCE = 400
#: A text may be so many times as unusual as the most unusual of the kept-back ones that stay.
MARGIN = 1.25
#: Parts in which a language's rows are ranked first.
SHARES = 256
SNIPPETS = (24, 64, 160)  # bytes


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def buckets(low: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte (bytes after the end count as 0); sizes don't share buckets."""
    code = np.zeros(len(low), np.uint32)
    for k in range(size):
        code[:len(low) - k] |= low[k:].astype(np.uint32) << np.uint32(8 * k)
    code *= np.uint32(2654435761)
    code ^= code >> np.uint32(15)
    code *= np.uint32(2246822519)
    return (code >> np.uint32(17)).astype(np.int32) + BUCKETS * SIZES.index(size)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray        # by bucket: logits, or the embedding if there is a layer, then the log frequency of 3-grams; the last row is zero
    bias: np.ndarray
    temperature: float
    threshold: float
    layer: np.ndarray | None = None
    usual: float = 0.0       # mean log frequency of known texts' 3-grams
    unusual_limit: float = np.inf

    def measure(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's logits, and how unusual its 3-grams are."""
        low, n, pad = T.LOWER[data], len(offsets) - 1, len(self.table) - 1
        width = self.table.shape[1]
        total, grams = np.zeros((n, width)), np.zeros(n, np.int64)
        lengths = np.diff(offsets)
        full = np.flatnonzero(lengths > 0)
        if len(full):
            for size in SIZES:
                at = buckets(low, size)
                for back in range(1, size):                     # n-grams that would cross a text's end
                    end = offsets[1:] - back
                    at[end[lengths >= back]] = pad
                for k in range(width if size == 3 else width - 1):
                    total[full, k] += np.add.reduceat(self.table[:, k][at], offsets[:-1][full], dtype=np.float64)
                grams += np.maximum(lengths - size + 1, 0)
        mean = total[:, :-1] / np.maximum(grams, 1)[:, None]
        threes = np.maximum(lengths - 2, 0)
        unusual = (self.usual - total[:, -1] / np.maximum(threes, 1)) * np.sqrt(np.minimum(threes, EVIDENCE))
        return (mean if self.layer is None else mean @ self.layer) + self.bias, unusual

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's best language (its index), calibrated score, and whether that is accepted."""
        logits, unusual = self.measure(data, offsets)
        p = softmax(logits / self.temperature)
        score = p.max(1)
        return p.argmax(1), score, (score >= self.threshold) & (unusual <= self.unusual_limit)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[bytes], labels: list[str], *, seed: int = 7, epochs: int = 5, rate: float = 0.5, reject: float = 0.001) -> LanguageModel:
    """Fit on the texts; every fifth one only calibrates."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((1, 1), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    index = {x: k for k, x in enumerate(languages)}
    of = np.array([index[x] for x in labels])
    fit = [k for k in range(len(texts)) if k % 5 != 4 or len(texts) < 10]
    rest = [k for k in range(len(texts)) if k % 5 == 4] if len(texts) >= 10 else fit
    rows, width = BUCKETS * len(SIZES), max(SNIPPETS)
    emb = rng.normal(0, 1 / DIMENSIONS, (rows + 1, DIMENSIONS)).astype(np.float32)
    emb[rows] = 0
    layer, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    # languages weigh alike, however many rows each has
    weight = (len(fit) / len(languages) / np.maximum(1, np.bincount(of[fit], minlength=len(languages)))).astype(np.float32)

    def grams(k: int, size: int) -> np.ndarray:
        t = np.frombuffer(texts[k], np.uint8)
        begin = int(rng.integers(0, max(1, len(t) - size + 1)))
        low = T.LOWER[t[begin:begin + size]]
        return np.concatenate([buckets(low, s)[:max(0, len(low) - s + 1)] for s in SIZES])

    steps = max(1, -(-len(fit) * epochs // 32))
    steps = min(max(steps, 300), 1200)
    for step in range(steps):
        lr = rate * (1 - step / steps) * 4
        chosen = rng.choice(fit, 32)
        bags = [grams(k, int(rng.choice(SNIPPETS))) for k in chosen]
        at = np.full((32, len(SIZES) * width), rows, np.int32)
        for i, bag in enumerate(bags):
            at[i, :len(bag)] = bag
        size = np.maximum(1, [len(b) for b in bags]).astype(np.float32)[:, None]
        x = emb[at].sum(1) / size
        p = softmax(x @ layer + bias)
        p[np.arange(32), of[chosen]] -= 1
        p *= weight[of[chosen]][:, None] / 32
        back = (p @ layer.T) / size
        layer -= lr * (x.T @ p) * 8
        bias -= lr * p.sum(0) * 0.1
        flat, per = at.ravel(), np.repeat(back, at.shape[1], axis=0)
        used = flat < rows
        np.subtract.at(emb, flat[used], (lr * 64) * per[used])
    # log frequency of the 3-grams of the texts that are fitted, languages weighing alike
    seen, first = np.zeros(BUCKETS), BUCKETS * SIZES.index(3)
    for k in fit:
        low = T.LOWER[np.frombuffer(texts[k], np.uint8)]
        at = buckets(low, 3)[:max(0, len(low) - 2)] - first
        seen += np.bincount(at, minlength=BUCKETS) * (weight[of[k]] / max(1, len(at)))
    usual = np.zeros((rows + 1, 1), np.float32)
    usual[first:first + BUCKETS, 0] = np.log(seen / max(seen.sum(), 1e-9) + 0.01 / BUCKETS)
    few = len(languages) <= DIMENSIONS
    model = LanguageModel(languages, np.ascontiguousarray(np.concatenate([emb @ layer if few else emb, usual], 1)), bias.astype(np.float64), 1.0, 0.0, None if few else layer.astype(np.float64))

    whole = [texts[k] for k in rest]
    short = [t[:160] for t in whole]
    gold = of[rest]
    logits, _ = model.measure(*joined(short))
    loss = {t: -np.log(softmax(logits / t)[np.arange(len(rest)), gold] + 1e-12).mean() for t in np.geomspace(0.02, 50, 60)}
    model.temperature = float(min(loss, key=loss.get))
    scores = np.sort(model.predict(*joined(whole))[1])
    model.threshold = float(min(0.5, scores[int(reject * len(scores))]))
    # per 3-gram, without a usual level yet, the statistic is -mean * root: the level is the kept-back texts' mean
    parts = whole + [t[(len(t) - n) // 2:][:n] for n in SNIPPETS for t in whole if len(t) > n]
    _, raw = model.measure(*joined(parts))
    root = np.sqrt(np.clip([len(t) - 2 for t in parts], 1, EVIDENCE))
    model.usual = float(-(raw / root)[:len(whole)].mean())
    unusual = np.sort(raw + model.usual * root)
    model.unusual_limit = float(max(1.0, MARGIN * unusual[-1 - int(reject * len(unusual))]))
    return model


def fit(df: DataFrame, *, per_language: int = 1500, sample_rows: int = 40_000, sample_chars: int = 4000,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> LanguageModel:
    """Train on rows with a label and a text that are not held out: at most ``per_language`` of each language and about
    ``sample_rows`` in all (one of each language at least), of each at most ``sample_chars``."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    may = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    languages = may.select("lang").distinct().count()
    per_language = max(1, min(per_language, sample_rows // max(1, languages)))
    begin = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - sample_chars + 1, F.lit(1))).cast("int") + 1
    may = may.withColumn("text", F.substring(F.col("text"), begin, F.lit(sample_chars)))
    # in two steps: no task sorts more of a language than a share of its rows, then a bounded number of them
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = may.select("doc_id", "lang").distinct().withColumn("share", F.pmod(F.hash("doc_id"), F.lit(SHARES)))
    for by in (("lang", "share"), ("lang",)):
        chosen = chosen.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("k") <= per_language)
    chosen = chosen.select("doc_id", "lang")
    texts = may.filter(F.col("text").isNotNull()).join(chosen, ["doc_id", "lang"], "left_semi").collect()
    texts.sort(key=lambda r: (r["doc_id"], r["text"]))
    texts = [r for k, r in enumerate(texts) if not k or r["doc_id"] != texts[k - 1]["doc_id"]]
    order = np.random.default_rng(1).permutation(len(texts))
    return train([texts[k]["text"].encode() for k in order], [texts[k]["lang"] for k in order], **options)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    out = np.diff(np.concatenate([[0], np.cumsum(T.IS_LETTER[data])])[offsets]) > 0
    for k in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[k] = any(map(str.isalpha, data[offsets[k]:offsets[k + 1]].tobytes().decode()))
    return out


def judge(column: pa.Array, model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, accepted) of every text of an Arrow column."""
    data, offsets = T.utf8(column)
    names, scores, accepted = [], [np.zeros(0)], [np.zeros(0, bool)]
    for i, j in T.parts(offsets, RANGE_BYTES):
        part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        known = has_letter(part, offs) & bool(model.languages)
        best, score, fine = model.predict(part, offs) if model.languages else (np.zeros(j - i, int), np.zeros(j - i), known)
        names += [model.languages[x] if ok else "und" for x, ok in zip(best.tolist(), known.tolist(), strict=True)]
        scores.append(np.where(known, score, 0.0))
        accepted.append(known & fine)
    return names, np.concatenate(scores), np.concatenate(accepted)


def identify(df: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score and accepted (a language, by score and 3-grams) for every row."""
    tune(df.sparkSession)
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score, accepted = judge(b.column("__text"), model)
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(names, pa.string()), pa.array(score), pa.array(accepted)], ["__id", "lang_pred", "score", "accepted"])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(run, f"__id {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("__id", id_col)


def keep_accepted(df: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows that are accepted, with the columns they have."""
    tune(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(judge(b.column(text_col), model)[2]))

    return df.mapInArrow(run, df.schema)
