"""Token ids as binary records: a Spark data source for framed, checksummed sequences.

A record is: u64 length, u32 masked CRC-32C of the length, payload, u32 masked CRC-32C
of the payload (the common framing of record files, so other readers take them). The
payload is i64 doc_id, u8 whether there is one, u8 bytes per id, and the ids, little
endian. Each data file has an index file with doc_id, offset and tokens of every record
for shuffled reads; a manifest lists the files that won their commit, with their sums.

Null texts are empty texts and give the end id alone. Null doc_ids come first; rows of one
doc_id are ordered by their text's hash, so reruns agree; equal rows give equal records side by side. Texts of any length are
encoded whole. Columns other than doc_id and text are ignored whatever their names. An empty table gives no files.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tastemill.llm.chunk_cache import ChunkCache, slices
from tastemill.llm.common import fresh_path
from tastemill.llm.crc32c import crc32c, masked

FORMAT = "token_records"
HEADER = np.dtype([("length", "<u8"), ("length_crc", "<u4")])
PREFIX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("width", "u1")])
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("tokens", "<u8")])
FRAME = HEADER.itemsize + 4
FLUSH_BYTES = 8 << 20
SPACES = re.compile(r"\s\s")
SPACE = re.compile(r"\s")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r"!-&(-/:-@\[-`{-~"  # no apostrophe: it can take letters with it
WORD = re.compile(f"[{LETTERS}]+")
GROUP = re.compile(f"[{LETTERS}]+|[{MARKS}]+|\\n")
BREAK = rf"(?:[{MARKS}]|\n(?=[{LETTERS}{MARKS}]))"
WORD_AND_MORE = re.compile(rf"([{LETTERS}]+)({BREAK}(?:[{LETTERS}]|{BREAK})*)")
TOGETHER = 2000  # new chunks in one text
TEXT_CHARS = 1 << 23  # of the texts that are looked up at once


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for each byte: visible Latin-1 as is, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)).difference(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_LETTERS = byte_letters()
SPACE_BYTE = BYTE_LETTERS[32]
BY_BYTES = {c: "".join(BYTE_LETTERS[b] for b in chr(c).encode()) for c in range(128, 256)}


def file_system(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, looked up per space-separated chunk.

    With a byte-level pre-tokenizer a lone space between two non-space characters always
    opens a token group, so chunks cut there encode as they do inside the text; for the same
    reason new chunks are encoded many at a time and told apart by the ids that begin with a
    space; plain words go to the same model as groups that are cut already. Letters, runs of
    marks and single line ends are groups of their own inside a chunk, so these are what is
    remembered. Texts with an added token's string, and other tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.of_groups = Tokenizer(self.tokenizer.model)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.chunked = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not spec["model"].get("dropout")
        )
        vocabulary = self.tokenizer.get_vocab()
        self.code = "H" if len(vocabulary) <= 1 << 16 else "I"
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for text, i in vocabulary.items() if text.startswith(SPACE_BYTE)]] = True
        self.opening = ChunkCache(self._whole)
        self.following = ChunkCache(self._after_space)

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in made]

    def _apart(self, made: list, count: int) -> list[bytes] | None:
        """Ids of chunks that were encoded together, cut where a token begins with a space."""
        ids = np.frombuffer(b"".join(array(self.code, e.ids).tobytes() for e in made), self.code)
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != count:
            return None
        raw, bounds = ids.tobytes(), (np.append(starts, len(ids)) * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _after_space(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk behind a space."""
        words, lone, others = [], [], []
        for chunk in chunks:
            kind = words if WORD.fullmatch(chunk) else lone if chunk and not SPACE.search(chunk) else others
            kind.append(chunk)
        groups = [SPACE_BYTE + (w if w.isascii() else w.translate(BY_BYTES)) for w in words]
        of_words = self._apart(self.of_groups.encode_batch_fast(
            [groups[i:i + TOGETHER] for i in range(0, len(groups), TOGETHER)], is_pretokenized=True, add_special_tokens=False,
        ), len(words))
        of_lone = self._apart(self.tokenizer.encode_batch_fast(
            [" " + " ".join(lone[i:i + TOGETHER]) for i in range(0, len(lone), TOGETHER)], add_special_tokens=False,
        ), len(lone))
        if of_words is None or of_lone is None:
            return self._whole([" " + c for c in chunks])
        known = dict(zip([*words, *lone], [*of_words, *of_lone]))
        known.update(zip(others, self._whole([" " + c for c in others])))
        return [known[c] for c in chunks]

    def _values(self, cache: ChunkCache, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, of its first word and the groups behind it apart."""
        heads, places, groups = list(chunks), [], []
        for i, chunk in enumerate(chunks):
            met = WORD_AND_MORE.fullmatch(chunk)
            if met:
                heads[i], more = met.groups()
                more = GROUP.findall(more)
                places += [i] * len(more)
                groups += more
        out = cache.values(heads)
        for i, ids in zip(places, self.opening.values(groups)):
            out[i] += ids
        return out

    def _cut(self, texts: list[str]) -> pa.ListArray:
        """The chunks of each text."""
        odd = [bool(SPACES.search(t)) or t[:1].isspace() or t[-1:].isspace() for t in texts]
        if not any(odd):
            return pc.split_pattern(pa.array(texts, pa.string()), " ")
        return pa.array([self._merged(t.split(" ")) if o else t.split(" ") for t, o in zip(texts, odd)], pa.list_(pa.string()))

    def _encode_cut(self, pieces: pa.ListArray) -> list[bytes]:
        """Look up every distinct chunk once and put the ids of all texts together by place."""
        coded = pieces.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        entry = coded.indices.to_numpy().astype(np.int64)
        last = np.cumsum(pieces.value_lengths().to_numpy().astype(np.int64)) - 1
        first = np.append(0, last[:-1] + 1)
        opens, place = np.unique(entry[first], return_inverse=True)
        entry[first] = len(distinct) + place
        known = self._values(self.following, distinct) + self._values(self.opening, [distinct[i] for i in opens])
        ids = np.frombuffer(b"".join(known), self.code)
        size = np.fromiter(map(len, known), np.int64, len(known)) // ids.itemsize
        start, length = (np.cumsum(size) - size)[entry], size[entry]
        end = np.cumsum(length)
        raw = ids[np.repeat(start - (end - length), length) + np.arange(end[-1])].tobytes()
        bounds = (np.append(0, end[last]) * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        whole = [not self.chunked or any(a in t for a in self.added) for t in texts]
        cut = [t for t, one in zip(texts, whole) if not one]
        by_chunks = iter(self._encode_cut(self._cut(cut)) if cut else [])
        return [self._whole([t])[0] if one else next(by_chunks) for t, one in zip(texts, whole)]

    @staticmethod
    def _merged(pieces: list[str]) -> list[str]:
        """Undo the cuts that don't have a non-space character on either side."""
        out, run = [], [pieces[0]]
        for before, piece in zip(pieces, pieces[1:]):
            if before and piece and not before[-1].isspace() and not piece[0].isspace():
                out.append(" ".join(run))
                run = []
            run.append(piece)
        return [*out, " ".join(run)]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> ChunkEncoder:
    """One encoder per worker process: its chunks serve the tasks that follow."""
    return ChunkEncoder(path)


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    records: int
    tokens: int


class RecordFile:
    """Frames records into a data file and its index."""

    def __init__(self, base: str, name: str, width: int):
        self.fs, root = file_system(base)
        self.fs.create_dir(root, recursive=True)
        self.name, self.width = name, width
        self.data = self.fs.open_output_stream(f"{root}/{name}.records")
        self.index = self.fs.open_output_stream(f"{root}/{name}.index")
        self.pending: list[tuple[int | None, bytes]] = []
        self.size = self.offset = self.records = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.pending.append((doc_id, ids))
        self.size += len(ids)
        if self.size >= FLUSH_BYTES:
            self.flush()

    def flush(self) -> None:
        count = len(self.pending)
        prefix = np.zeros(count, PREFIX)
        prefix["doc_id"] = [d or 0 for d, _ in self.pending]
        prefix["has_id"] = [d is not None for d, _ in self.pending]
        prefix["width"] = self.width
        prefixes = prefix.tobytes()
        payloads = [prefixes[i * PREFIX.itemsize:(i + 1) * PREFIX.itemsize] + ids for i, (_, ids) in enumerate(self.pending)]
        lengths = np.fromiter(map(len, payloads), np.int64, count)
        starts = np.cumsum(lengths) - lengths
        body_crc = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), starts, lengths)).astype("<u4")
        header = np.zeros(count, HEADER)
        header["length"] = lengths
        length_bytes = header["length"].copy().view(np.uint8)
        header["length_crc"] = masked(crc32c(length_bytes, np.arange(count) * 8, np.full(count, 8)))
        heads, tails = header.tobytes(), body_crc.tobytes()
        step = HEADER.itemsize
        self.data.write(b"".join(
            part for i, body in enumerate(payloads)
            for part in (heads[i * step:(i + 1) * step], body, tails[4 * i:4 * i + 4])
        ))
        rows = np.zeros(count, INDEX)
        rows["doc_id"], rows["has_id"] = prefix["doc_id"], prefix["has_id"]
        framed = lengths + FRAME
        rows["offset"] = self.offset + np.cumsum(framed) - framed
        rows["tokens"] = (lengths - PREFIX.itemsize) // self.width
        self.index.write(rows.tobytes())
        self.offset += int(framed.sum())
        self.records += count
        self.tokens += int(rows["tokens"].sum())
        self.pending, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.data.close()
        self.index.close()


class TokenWriter(DataSourceArrowWriter):
    """Encodes (doc_id, text) rows in their order, one data file per task.

    Every attempt writes a file of its own; the manifest names those that were committed,
    so a repeated or speculative task leaves nothing that a reader would see.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.tokenizer, self.end_id = options["path"], options["tokenizer"], int(options["end_id"])

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        encoder = encoder_of(self.tokenizer)
        end = array(encoder.code, [self.end_id])
        part = TaskContext.get().partitionId()
        out = None
        for batch in batches:
            out = out or RecordFile(self.path, f"part-{part:06d}-{uuid.uuid4().hex[:12]}", end.itemsize)
            made = (ids for texts in slices(batch.column(1).to_pylist(), TEXT_CHARS) for ids in encoder.encode(texts))
            for doc_id, ids in zip(batch.column(0).to_pylist(), made):
                out.add(doc_id, ids + end.tobytes())
        if out is None:
            return Written(part, "", 0, 0)
        out.close()
        return Written(part, out.name, out.records, out.tokens)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        where, root = file_system(self.path)
        where.create_dir(root, recursive=True)
        files, before = [], 0
        for m in sorted((m for m in messages if m and m.records), key=lambda m: m.part):
            files.append({"name": m.name, "records": m.records, "tokens": m.tokens, "start": before})
            before += m.tokens
        with where.open_output_stream(f"{root}/manifest.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        """Files of failed jobs are in no manifest."""


@dataclass
class RecordSlice(InputPartition):
    name: str
    records: int
    start: int


class TokenReader(DataSourceReader):
    """Reads records in file order, checks every length and checksum, and adds where each sequence starts."""

    def __init__(self, options: dict[str, str], with_ids: bool):
        self.path, self.with_ids = options["path"], with_ids

    def partitions(self) -> list[RecordSlice]:
        where, root = file_system(self.path)
        with where.open_input_stream(f"{root}/manifest.json") as f:
            files = json.loads(f.read())
        return [RecordSlice(f["name"], f["records"], f["start"]) for f in files] or [RecordSlice("", 0, 0)]

    def read(self, piece: RecordSlice) -> Iterator[pa.RecordBatch]:
        if not piece.records:
            return
        where, root = file_system(self.path)
        with where.open_input_stream(f"{root}/{piece.name}.index") as f:
            index = np.frombuffer(f.read(), INDEX)
        offsets = index["offset"].astype(np.int64)
        with where.open_input_file(f"{root}/{piece.name}.records") as data:
            bounds = np.append(offsets, data.size())
            at, start = 0, piece.start
            while at < len(index):
                upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + FLUSH_BYTES, "right")) - 1)
                raw = np.frombuffer(data.read_at(int(bounds[upto] - bounds[at]), int(bounds[at])), np.uint8)
                batch = self._batch(raw, bounds[at:upto + 1] - bounds[at], start)
                start += int(index["tokens"][at:upto].sum())
                at = upto
                yield batch

    def _batch(self, raw: np.ndarray, bounds: np.ndarray, start: int) -> pa.RecordBatch:
        heads = np.frombuffer(
            np.concatenate([raw[b:b + HEADER.itemsize] for b in bounds[:-1]]).tobytes(), HEADER
        )
        lengths = heads["length"].astype(np.int64)
        bodies = bounds[:-1] + HEADER.itemsize
        count = len(lengths)
        length_crc = masked(crc32c(heads["length"].copy().view(np.uint8), np.arange(count) * 8, np.full(count, 8)))
        tails = np.concatenate([raw[e - 4:e] for e in bounds[1:]]).view("<u4")
        if (
            (length_crc != heads["length_crc"]).any() or (lengths + FRAME != np.diff(bounds)).any()
            or (masked(crc32c(raw, bodies, lengths)) != tails).any()
        ):
            raise ValueError(f"a record of {self.path} doesn't match its checksum")
        doc_ids, counts, crcs, ids = [], [], [], []
        for body, length in zip(bodies.tolist(), lengths.tolist()):
            head = raw[body:body + PREFIX.itemsize].view(PREFIX)[0]
            tokens = raw[body + PREFIX.itemsize:body + length].view(f"<u{head['width']}").astype("<u4")
            doc_ids.append(int(head["doc_id"]) if head["has_id"] else None)
            counts.append(len(tokens))
            crcs.append(zlib.crc32(tokens.tobytes()))
            if self.with_ids:
                ids.append(tokens.astype(np.int32))
        starts = start + np.cumsum(counts) - np.asarray(counts)
        columns = {
            "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
        }
        if self.with_ids:
            columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(columns)


class TokenRecords(DataSource):
    """spark.read / df.write of format "token_records"; option ids=true adds the sequences to a read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _with_ids(self) -> bool:
        return self.options.get("ids", "false").lower() == "true"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * self._with_ids()

    def reader(self, schema) -> TokenReader:
        return TokenReader(dict(self.options), self._with_ids())

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(dict(self.options))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode whole texts and write them as records in ascending doc_id order."""
    docs.sparkSession.dataSource.register(TokenRecords)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Equal rows are told apart by where they were read, so that one repeated row fills no single range.
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    order = ["doc_id", F.xxhash64("text"), "_at"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")
    ordered.write.format(FORMAT).mode("append").options(tokenizer=tokenizer, end_id=str(end_id)).save(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    spark.dataSource.register(TokenRecords)
    return spark.read.format(FORMAT).option("ids", str(ids).lower()).load(path)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "token-records")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path)
