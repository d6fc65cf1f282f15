"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here and rebuilt: normaliser, metaspace marker, unigram
scores or merges in the order of the pieces' scores, and byte fallback. Texts are encoded in
multithreaded batches of distinct chunks: where no piece has the marker after another
character, tokens never cross a space that follows a non-space, so a chunk encodes as
inside its text. The ids are the rebuilt tokenizer's. ``parity`` says that the sentencepiece library gives
the same ids, for each distinct chunk of the document or, with a model that has a character map or user symbols and
for texts that hold the marker itself, for the whole text. ``round_trip`` says that the document's ids decode to its
normalised text; every document is decoded from the ids that are returned.

Null texts are empty texts and give no ids. Repeated rows and null doc_ids are rows like any
other, and no tie can arise. Texts of any length are encoded whole; chunks are remembered up to a bound. Other columns are
ignored whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.chunk_cache import ChunkCache, slices
from tastemill.llm.common import table

MARK = "▁"
THREADS = 2

# Fixed values of the model's protobuf.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} isn't in use")
            size = varint()
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_space: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((text, score, kind))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.suffix_space = bool(spec.get(24, 0))
            model.byte_fallback = bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.trim_spaces, model.escape_spaces = (bool(spec.get(n, 1)) for n in (3, 4, 5))
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that join into a piece, best score first, then by the parts' ids."""
    ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for text, i in ids.items():
        for cut in range(1, len(text)):
            left, right = ids.get(text[:cut]), ids.get(text[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[i][1], i, left, right))
    return [(model.pieces[left][0], model.pieces[right][0]) for _, _, left, right in sorted(found)]


def build(model: Model, normalised: bool = False):
    """The tokenizer; with ``normalised`` it takes chunks whose spaces are markers already."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in model.pieces], model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        vocabulary = {t: i for i, (t, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocabulary, merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.kind} has no counterpart")
    tokenizer = Tokenizer(core)
    if not normalised:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.trim_spaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if model.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        tokenizer.normalizer = normalizers.Sequence(steps)
        tokenizer.add_tokens([AddedToken(t, normalized=True) for t, _, k in model.pieces if k == USER_DEFINED])
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([] if normalised or not model.dummy_prefix else [decoders.Strip(" ", 1, 0)]),
    ])
    return tokenizer


class Codec:
    """Encodes and decodes texts in one task, with the chunks it has verified."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.whole = build(self.model)
        self.parts = build(self.model, normalised=True)
        self.judge = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.chunked = (
            not m.charsmap and m.dummy_prefix and not m.trim_spaces and m.escape_spaces and not m.suffix_space
            and not any(k == USER_DEFINED for _, _, k in m.pieces)
            and not any(MARK in t.lstrip(MARK) for t, _, k in m.pieces if k == NORMAL)
        )
        self.cache = ChunkCache(self._learn, dropped=self._forget)  # a chunk's ids, by what follows its first space
        self.odd: set[str] = set()  # remembered chunks whose ids differ from the library's
        # What each piece decodes to; bytes beyond ASCII only do so together.
        value = [int(t[3:5], 16) if k == BYTE else -1 for t, _, k in m.pieces]
        self.texts = pa.array([
            "" if b >= 0x80 else chr(b) if b >= 0 else self.parts.decode([i], skip_special_tokens=False) for i, b in enumerate(value)
        ])
        self.bytes = np.array(value) >= 0x80

    def _learn(self, chunks: list[str]) -> list[bytes]:
        marked = [MARK + (c.replace(" ", MARK) if " " in c else c) for c in chunks]
        made = [e.ids for e in self.parts.encode_batch_fast(marked, add_special_tokens=False)]
        expected = self.judge.encode(chunks, num_threads=1)
        out = []
        for chunk, ids, want in zip(chunks, made, expected):
            if not chunk:  # a space at the end: alone it would be an empty text
                want = [self.judge.piece_to_id(MARK)]
            if ids != want:
                self.odd.add(chunk)
            out.append(array("i", ids).tobytes())
        return out

    def _forget(self, known) -> None:
        self.odd = {c for c in self.odd if known(c)}

    @staticmethod
    def _chunks(text: str) -> list[str]:
        pieces = text.split(" ")
        if "" not in pieces:
            return pieces
        out, spaces = [], ""
        for n, piece in enumerate(pieces):
            if piece or n == len(pieces) - 1:
                out.append(spaces + piece)
                spaces = ""
            else:
                spaces += " "
        return out

    def _encode_whole(self, text: str) -> tuple[bytes, bool]:
        made = self.whole.encode(text, add_special_tokens=False).ids
        return np.asarray(made, "<i4").tobytes(), made == self.judge.encode(text)

    def _normal(self, text: str) -> str:
        """What a text should decode to."""
        normal = self.judge.normalize(text).replace(MARK, " ")
        return normal[1:] if self.model.dummy_prefix and normal[:1] == " " else normal

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """For each text its ids, whether both libraries agree, and whether the ids decode to its normal form."""
        cut = [self._chunks(t) if self.chunked and t and MARK not in t else None for t in texts]
        self.cache.prepare(chunks for chunks in cut if chunks)
        made = []
        for text, chunks in zip(texts, cut):
            if chunks:
                made.append((b"".join(self.cache.values(chunks)), not self.odd or self.odd.isdisjoint(chunks)))
            else:
                made.append(self._encode_whole(text) if text else (b"", True))
        back = self.decode([ids for ids, _ in made])
        return [
            (ids, parity, got == (text if chunks or not text else self._normal(text)))
            for (ids, parity), text, chunks, got in zip(made, texts, cut, back)
        ]

    def decode(self, rows: list[bytes]) -> list[str]:
        """The texts of rows of ids; those without bytes beyond ASCII are their pieces' texts side by side."""
        ids = np.frombuffer(b"".join(rows), "<i4")
        ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(self.bytes[ids])])
        with_bytes = (before[ends[1:]] > before[ends[:-1]]).tolist()
        pieces = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.texts.take(pa.array(ids)))
        out = pc.binary_join(pieces, "").to_pylist()
        for n, fallback in enumerate(with_bytes):
            if fallback:
                out[n] = self.whole.decode(ids[ends[n]:ends[n + 1]].tolist(), skip_special_tokens=False)
            elif self.model.dummy_prefix and out[n][:1] == " ":
                out[n] = out[n][1:]
        return out


@lru_cache(maxsize=1)
def codec_of(path: str, threads: int) -> Codec:
    """One codec per worker process: its chunks serve the tasks that follow."""
    return Codec(path, threads)


def encode_texts(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, ids, n_tokens, parity, round_trip) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, threads)
        for batch in batches:
            rows = [row for texts in slices(batch.column(1).to_pylist()) for row in codec.encode(texts)]
            counts = [len(ids) // 4 for ids, _, _ in rows]
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            values = pa.array(np.frombuffer(b"".join(ids for ids, _, _ in rows), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.ListArray.from_arrays(offsets, values), pa.array(counts, pa.int64()),
                    pa.array([p for _, p, _ in rows], pa.bool_()), pa.array([r for _, _, r in rows], pa.bool_()),
                ],
                ["doc_id", "ids", "n_tokens", "parity", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, parity boolean, round_trip boolean")


def decode_ids(encoded: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, text) from ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, threads)
        for batch in batches:
            texts = codec.decode([np.asarray(ids or [], "<i4").tobytes() for ids in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
