"""Token counts of whole texts (operator 8).

Arrow functions get batches bounded by bytes and return lengths only.  Within
a batch, texts are taken in ranges of about ``RANGE_BYTES``; long texts are
split at safe borders (a blank after a character that is no white space, or a
closing mark after a letter; see ``chunkcache``).  Distinct pieces go to the
tokenizers library in batches balanced by bytes, so one batch costs about as
much as another however long its texts are.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
and rows without an id are counted like any other; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.chunkcache import ChunkCache, cuts_before_space
from courtline.llm.store import tune

RANGE_BYTES = 8 << 20
#: A call of the library gets about this many bytes.
CALL_BYTES = 1 << 16

_CACHES: dict[str, ChunkCache] = {}


def vocabulary(name: str) -> str:
    """The path of a public tokenizer file, as this machine has it."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _balanced(pieces: list[bytes]) -> Iterator[list[str]]:
    """Calls of about CALL_BYTES each."""
    call, size = [], 0
    for p in pieces:
        if call and size + len(p) > CALL_BYTES:
            yield call
            call, size = [], 0
        call.append(p.decode())
        size += len(p)
    if call:
        yield call


def _cache(name: str) -> ChunkCache:
    if name not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(vocabulary(name))
        lengths = lambda texts: (len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False))
        _CACHES[name] = ChunkCache(lambda pieces: [n for call in _balanced(pieces) for n in lengths(call)], ids=False)
    return _CACHES[name]


def count_batch(column: pa.Array, name: str) -> np.ndarray:
    """The number of tokens of every text of an Arrow column."""
    data, offsets = T.utf8(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    if name.endswith(".model"):
        return _count_whole(data, offsets, name)
    cache = _cache(name)
    for i, j in T.parts(offsets, RANGE_BYTES):
        part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts = cuts_before_space(part, offs, marks=True)
        slots = cache.find(part, starts, np.append(starts[1:], len(part)))
        sizes = np.concatenate([[0], np.cumsum(cache.sizes[slots], dtype=np.int64)])
        out[i:j] = np.diff(sizes[T.per_text(starts, offs)])
    return out


def _count_whole(data: np.ndarray, offsets: np.ndarray, name: str) -> np.ndarray:
    """Sentencepiece models may normalise across blanks, so their texts stay whole."""
    import sentencepiece
    if name not in _CACHES:
        _CACHES[name] = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
    raw = data.tobytes()
    texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return np.array([len(_CACHES[name].encode(x)) for x in texts], np.int64)


def token_counts(df: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""
    tune(df.sparkSession)
    ids = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, offsets = T.utf8(b.column("text"))
            n = count_batch(b.column("text"), tokenizer)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("doc_id", id_col)
