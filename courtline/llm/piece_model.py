"""SentencePiece encoding and decoding on the tokenizers library (operator 10).

The model protobuf is read field by field (no protobuf package is needed) and
rebuilt: normaliser (charsmap, extra blanks, dummy prefix, blanks to the metaspace
marker), scores, byte fallback, decoder.  A unigram model gets its scores as they are; a
BPE model gets merges ranked by the score of the piece they make.  No text makes a
control, unknown, unused or byte piece, also if it spells one out: while encoding these
go by names with a blank, which normalised texts don't hold.  A unigram model's unknown
characters become byte pieces after the search.

With the identity normaliser, texts are cut before a blank after a character that surely
is none (if no piece holds a marker after another character); each
distinct piece is encoded once a worker, in multithreaded batches, and
compared with the sentencepiece library.  Other models get whole texts: a charsmap
may make blanks or join characters, and blanks that go depend on their neighbours.
``encode`` gives ids and ``parity``: whether all of a text agrees with that library.  The
tokenizers library applies a charsmap by grapheme, the other by longest match; where
that matters, parity is false.

Refused with a ValueError: word and character models, blanks as suffixes or unescaped,
user-defined pieces in a BPE model.

Defined cases: a null text has null ids, an empty one no ids; decoding null
ids gives null; extra columns are ignored; repeated rows stay.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.chunkcache import ChunkCache, cuts_before_space
from courtline.llm.store import tune
from courtline.llm.token_counts import vocabulary

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # the format's piece types
UNIGRAM, BPE = 1, 2                                               # and model types
RANGE_BYTES = 2 << 20


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        value |= (byte & 0x7F) << shift
        i, shift = i + 1, shift + 7
        if byte < 0x80:
            return value, i


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-size values stay bytes."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        else:
            if kind == 2:
                size, i = _varint(data, i)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind} is not used by this format")
            value, i = data[i:i + size], i + size
        yield key >> 3, value


@dataclass
class PieceModel:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int
    unknown: int
    byte_fallback: bool
    dummy_prefix: bool
    charsmap: bytes = b""
    trim: bool = True
    cuttable: bool = False

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls([], [], [], UNIGRAM, 0, False, True)
        for number, value in wire_fields(data):
            if number == 1:
                got = dict(wire_fields(value))
                out.pieces.append(got[1].decode())
                out.scores.append(struct.unpack("<f", got.get(2, b"\0" * 4))[0])
                out.types.append(got.get(3, NORMAL))
            elif number == 2:
                got = dict(wire_fields(value))
                out.kind, out.byte_fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
                if got.get(24):
                    raise ValueError("models that take blanks as suffixes are not rebuilt")
            elif number == 3:
                got = dict(wire_fields(value))
                out.charsmap, out.dummy_prefix, out.trim = got.get(2, b""), bool(got.get(3, 1)), bool(got.get(4, 1))
                if not got.get(5, 1):
                    raise ValueError("models that keep blanks as they are are not rebuilt")
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are rebuilt")
        if out.kind == BPE and USER in out.types:
            raise ValueError("user-defined pieces of a BPE model are not rebuilt")
        out.unknown = out.types.index(UNKNOWN)
        crosses = any(MARK in p.lstrip(MARK) for p, t in zip(out.pieces, out.types, strict=True) if t in (NORMAL, USER))
        out.cuttable = not (out.charsmap or out.trim or crosses)
        return out

    def normaliser(self):
        """The model's normaliser for whole texts."""
        from tokenizers import Regex, normalizers
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Replace(Regex(f"^ +|[ {MARK}]+$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        return normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])

    def _unigram_vocabulary(self) -> list[tuple[str, float]]:
        """Pieces and scores to encode with; a user-defined piece's score makes the search always take it."""
        top = max((s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL), default=0.0)
        low = min((s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL), default=0.0)
        out = []
        for k, (p, s, t) in enumerate(zip(self.pieces, self.scores, self.types, strict=True)):
            if t == USER:
                s = len(p.encode()) * top - 0.1
            out.append((p, s) if t in (NORMAL, USER) else (f" {k}", low))
        return out

    def byte_ids(self) -> np.ndarray:
        """The id of each byte's piece."""
        at = {p: k for k, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        return np.array([at[f"<0x{b:02X}>"] for b in range(256)])

    def tokenizer(self, merges: bool = True):
        """The rebuilt tokenizer; it encodes one piece of text that starts with a blank, which is the marker.  Decoding needs no merges."""
        from tokenizers import Tokenizer, decoders, models, normalizers
        if self.kind == UNIGRAM:
            model = models.Unigram(self._unigram_vocabulary() if merges else list(zip(self.pieces, self.scores, strict=True)), unk_id=self.unknown, byte_fallback=False)
        else:
            vocab = {p: k for k, p in enumerate(self.pieces)}
            made = [p for p, t in zip(self.pieces, self.types, strict=True) if t == NORMAL] if merges else []
            plain = set(made)
            ranked = [(-self.scores[vocab[p]], -at, p[:at], p[at:]) for p in made for at in range(1, len(p)) if p[:at] in plain and p[at:] in plain]
            ranked.sort(key=lambda m: m[:2])
            model = models.BPE(vocab, [m[2:] for m in ranked], unk_token=self.pieces[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback)
        tok = Tokenizer(model)
        tok.normalizer = normalizers.Replace(" ", MARK)
        tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        return tok


class _Encoder:
    """What a worker keeps to encode: the rebuilt tokenizer, the peer it is compared with, and the pieces met."""

    def __init__(self, name: str, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        self.model = _parsed(name)
        self.tok = self.model.tokenizer()
        if not self.model.cuttable:
            self.tok.normalizer = self.model.normaliser()
        self.bytes = self.model.byte_ids() if self.model.kind == UNIGRAM and self.model.byte_fallback else None
        self.peer = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        self.cache = ChunkCache(self._encode)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        if self.bytes is None:
            return [e.ids for e in got]
        out = [e.ids for e in got]
        unknown = [k for k, ids in enumerate(out) if self.model.unknown in ids]
        # the fast call leaves out what the unknown characters are
        for k, e in zip(unknown, self.tok.encode_batch([texts[k] for k in unknown], add_special_tokens=False), strict=True):
            out[k] = self._with_bytes(e)
        return out

    def _with_bytes(self, encoding) -> list[int]:
        out = []
        for i, token in zip(encoding.ids, encoding.tokens, strict=True):
            out += self.bytes[list(token.encode())].tolist() if i == self.model.unknown else [i]
        return out

    def whole(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids and parity of whole texts."""
        got = self._ids(texts)
        return got, [a == b for a, b in zip(got, self.peer.encode(texts, num_threads=1), strict=True)]

    def _encode(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode() for c in chunks]
        got = self._ids(texts)
        # the peer puts its own marker first; parity goes with the ids, as one more number
        peer = self.peer.encode([t[1:] if self.model.dummy_prefix else t for t in texts], num_threads=1)
        return [[*a, int(a == b or t in (" ", ""))] for a, b, t in zip(got, peer, texts, strict=True)]


class _Decoder:
    """What a worker keeps to decode: the vocabulary and its decoder, and the id sequences met."""

    def __init__(self, name: str, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = _parsed(name)
        self.tok = self.model.tokenizer(merges=False)
        self.marked = np.array([p.startswith(MARK) for p in self.model.pieces])
        self.cache = ChunkCache(self._decode, kind=np.uint8)

    def _decode(self, chunks: list[bytes]) -> list[bytes]:
        return [t.encode() for t in self.tok.decode_batch([np.frombuffer(c, "<u4").tolist() for c in chunks], skip_special_tokens=False)]


def _parsed(name: str) -> PieceModel:
    with open(vocabulary(name), "rb") as f:
        return PieceModel.parse(f.read())


_KEPT: dict[tuple, _Encoder | _Decoder] = {}


def _kept(kind: type, name: str, threads: int):
    if (kind, name, threads) not in _KEPT:
        _KEPT[kind, name, threads] = kind(name, threads)
    return _KEPT[kind, name, threads]


def encode_batch(column: pa.Array, name: str, threads: int = 2) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges [i, j) of the texts: all ids, each text's offsets in them, and each text's parity."""
    back = _kept(_Encoder, name, threads)
    data, offsets = T.utf8(column)
    for i, j in T.parts(offsets, RANGE_BYTES):
        if not back.model.cuttable:
            lists, agree = back.whole([t or "" for t in column.slice(i, j - i).to_pylist()])
            yield i, j, np.array([x for ids in lists for x in ids], np.int64), np.concatenate([[0], np.cumsum([len(ids) for ids in lists])]), np.array(agree, bool)
            continue
        offs = offsets[i:j + 1] - offsets[i]
        part = data[offsets[i]:offsets[j]]
        if back.model.dummy_prefix:
            full = offs[:-1] < offs[1:]
            part = np.insert(part, offs[:-1][full], 0x20)
            offs = offs + np.concatenate([[0], np.cumsum(full)])
        starts = cuts_before_space(part, offs, blanks=b" ")
        slots = back.cache.find(part, starts, np.append(starts[1:], len(part)))
        sizes = back.cache.sizes[slots].astype(np.int64) - 1
        begins = back.cache.begins[slots]
        agree = np.concatenate([[0], np.cumsum(back.cache.pool[begins + sizes] == 0)])
        per = T.per_text(starts, offs)
        at = np.concatenate([[0], np.cumsum(sizes)])[per]
        yield i, j, back.cache.pool[T.take_ranges(begins, sizes)], at, np.diff(agree[per]) == 0


def decode_batch(ids: np.ndarray, offsets: np.ndarray, name: str, threads: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The texts of id sequences: UTF-8 bytes and offsets."""
    back = _kept(_Decoder, name, threads)
    ids = np.ascontiguousarray(ids, "<u4")
    cut = np.zeros(len(ids) + 1, bool)
    cut[:-1] = back.marked[ids]
    cut[offsets[:-1]] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    slots = back.cache.find(ids.view(np.uint8), starts * 4, np.append(starts[1:], len(ids)) * 4)
    sizes = back.cache.sizes[slots].astype(np.int64)
    out = back.cache.pool[T.take_ranges(back.cache.begins[slots], sizes)]
    at = np.concatenate([[0], np.cumsum(sizes)])[T.per_text(starts, offsets)]
    if back.model.dummy_prefix:  # the marker that encoding put first
        first = at[:-1][at[:-1] < at[1:]]
        first = first[out[first] == 0x20]
        keep = np.ones(len(out) + 1, bool)
        keep[first] = False
        out, at = out[keep[:-1]], at - np.searchsorted(first, at)
    return out, at


def encode(df: DataFrame, *, model: str = "piece_bpe_32k.model", threads: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids array<int>, parity boolean of every row."""
    tune(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            for i, j, ids, at, parity in encode_batch(texts, model, threads):
                null = texts.slice(i, j - i).is_null()
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=null if null.true_count else None)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), lists, pa.array(parity)], ["doc_id", "ids", "parity"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, parity boolean").withColumnRenamed("doc_id", id_col)


def decode(df: DataFrame, *, model: str = "piece_bpe_32k.model", threads: int = 2, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id", "parity")) -> DataFrame:
    """The columns ``keep``, n_tokens and the decoded ``text``."""
    tune(df.sparkSession)
    rows = df.select(*keep, F.col(ids_col).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("__ids")
            null = lists.is_null()
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out, at = decode_batch(flat, np.concatenate([[0], np.cumsum(sizes)]), model, threads)
            text = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out.tobytes())])
            if null.true_count:
                text = pa.compute.if_else(null, None, text)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sizes), text.cast(pa.string())], [*keep, "n_tokens", "text"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, n_tokens bigint, text string")
