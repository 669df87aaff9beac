"""Token ids in binary files: documents compressed one by one with a shared zstandard dictionary.

File format (little-endian): 8 bytes magic, 32 bytes SHA-256 of the dictionary (zeros without one),
the documents' frames, each a zstandard frame of the ids (16 bits each if the vocabulary allows,
else 32), then the index: the document ids as a compressed Arrow stream, one (offset, length, number of ids)
triple of 64-bit numbers per document, and a footer of four 64-bit numbers (start of the id list, start of
the triples, number of documents, bytes per id). The k-th document of a file is read with two seeks, to
its triple and to its frame, however large the file. The dictionary lies beside the files under its hash.

Files hold ranges of document ids in ascending order, and rows with equal ids in order of their text's
XXH64, then of the text. The manifest has a row per file; files of lost or repeated tasks are in no
manifest and so never read.

Texts are cut before words (a space and something that is not white space), where a byte-level
pre-tokenizer always cuts, and a worker keeps the pieces that it met again, so that most are encoded
once; ids equal those of the whole text. A tokenizer that joins across such cuts is found out by
probes, and then whole texts are encoded.

Null text is empty; every document ends with the end id; a null id sorts first; repeated rows are
documents of their own; an empty table gives no file. A long text is encoded as a whole, in its
task's memory (some ten times its size). Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

from gleaner.llm.workspace import small_batches, staged

_MAGIC = b"GLTOK001"
# A Latin word and the signs at its end, between which a byte-level pre-tokenizer cuts, too.
_WORD_SIGNS = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?%$&#*|]*)")
_ASCII_UNIT = re.compile(" ?(?:[A-Za-z]+|[.,;:!?%$&#*|]+)")
# Texts around cuts, to see whether a tokenizer encodes pieces as it encodes the whole.
_PROBES = ("a b", "The\nend", "it's, (well) done.\nNow 12 \u00e9t\u00e9s!", "x  y \n z", "\u65e5\u672c \u8a9e\tq", "don't we'll ##$ 3.5% a,b..c;\nd")


class Encoder:
    """Encodes whole texts piece by piece, with a bounded memory of pieces seen."""

    def __init__(self, path: str, end_id: int, most_pieces: int = 700_000, special_as_text: bool = False) -> None:
        """Keeps the ids of ``most_pieces`` pieces that came again and of about as many others. ``special_as_text`` makes the strings of special tokens ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.often: dict[str, bytes] = {}  # what follows a space -> ids with the space; " " + text -> ids of the text alone
        self.once: dict[str, bytes] = {}
        self.most = most_pieces
        self.line = self._whole(["\n"])[0]
        width = self.dtype.itemsize
        serial = np.arange(self.tokenizer.get_vocab_size(), dtype=self.dtype).tobytes()
        self.serial = [serial[k : k + width] for k in range(0, len(serial), width)]
        self.cuts = len(self.line) == width
        self.cuts = self.cuts and [x + self.end for x in self._whole(list(_PROBES))] == self.encode(list(_PROBES))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The serialized ids of each text, with the end id."""
        if not self.cuts:
            return [x + self.end for x in self._whole(texts)]
        if len(self.once) > self.most:  # what came once is forgotten
            self.once = {}
        rows, missing, often, once = [], set(), self.often, self.once
        for text in texts:
            first, *parts = text.split(" ")
            parts.append(" " + first)
            got = list(map(often.get, parts))
            gaps = [i for i, x in enumerate(got) if x is None]
            if "" in parts or any([parts[i][0].isspace() for i in gaps if i < len(parts) - 1]):
                parts = _joined(parts)
                got = list(map(often.get, parts))
                gaps = [i for i, x in enumerate(got) if x is None]
            for i in gaps:
                if (held := once.get(piece := parts[i])) is None:
                    missing.add(piece)
                else:
                    got[i] = held
                    if len(often) < self.most:
                        often[piece] = held
            rows.append((parts, got, gaps))
        learnt = self._learned(missing)
        out = []
        for parts, got, gaps in rows:
            for i in gaps:
                if got[i] is None:
                    got[i] = learnt[parts[i]]
            out.append(b"".join([got.pop(), *got, self.end]))
        return out

    def _again(self, piece: str) -> bytes | None:
        """The ids of a piece that came before, which makes it one that came again."""
        if (held := self.often.get(piece)) is None and (held := self.once.get(piece)) is not None and len(self.often) < self.most:
            self.often[piece] = held
        return held

    def _learned(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode new pieces: cut at line ends and before signs, their parts are encoded as lines of one text; odd ones alone."""
        known, cut, odd, plain = {}, [], [], []
        for piece in pieces:
            if m := _WORD_SIGNS.fullmatch(piece):
                if m[2]:
                    cut.append((piece, [m[1], " " + m[2]]))
                else:
                    plain.append(piece)
                continue
            body = piece[1:] if piece[0] == " " else piece
            lines = body.split("\n")
            if body.split() != lines:
                if body:
                    odd.append(piece)
                else:
                    known[piece] = b""
                continue
            parts = []
            for line in [piece[: len(piece) - len(body)] + lines[0], *(" " + x for x in lines[1:])]:
                parts += ["\n"] if parts else []
                m = _WORD_SIGNS.fullmatch(line)
                parts += [m[1], " " + m[2]] if m and m[2] else [line]
            if len(parts) == 1:
                plain.append(piece)
            else:
                cut.append((piece, parts))
        known["\n"] = self.line
        known.update(dict.fromkeys(plain))
        for _, parts in cut:
            for part in parts:
                if part not in known:
                    known[part] = self._again(part)
        tokenize, serial, more = self.tokenizer.model.tokenize, self.serial, []
        for piece in [x for x, held in known.items() if held is None]:
            if _ASCII_UNIT.fullmatch(piece):  # what the pre-tokenizer leaves whole, and its signs stand for themselves in the vocabulary
                known[piece] = b"".join([serial[t.id] for t in tokenize(piece[1:] if piece[0] == " " else "\u0120" + piece)])
            else:
                more.append(piece)
        for k in range(0, len(more), 2048):
            some = more[k : k + 2048]
            (raw,) = self._whole(["\n".join(map(_text, some))])
            ends = np.flatnonzero(np.frombuffer(raw, self.dtype) == np.frombuffer(self.line, self.dtype)[0]) * self.dtype.itemsize
            if len(ends) == len(some) - 1:
                starts = [0, *(ends + self.dtype.itemsize).tolist()]
                known.update(zip(some, [raw[a:b] for a, b in zip(starts, [*ends.tolist(), len(raw)])]))
            else:  # a line end came from elsewhere
                odd += some
        if odd:
            known.update(zip(odd, self._whole(list(map(_text, odd)))))
        for piece, parts in cut:
            known[piece] = b"".join([known[x] for x in parts])
        del known["\n"]
        self.once.update(known if max(map(len, known), default=0) < 100 else {p: x for p, x in known.items() if len(p) < 100})
        return known


def _text(piece: str) -> str:
    return piece[1:] if piece[0] == " " else " " + piece


def _joined(parts: list[str]) -> list[str]:
    """Pieces of a text that is cut only where no white space follows the space; the first one is last."""
    *rest, first = parts
    out = [first]
    for part in rest:
        if part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return [*out[1:], out[0]]


@cache
def _encoder(path: str, end_id: int, most_pieces: int) -> Encoder:
    """One encoder for all tasks of a worker, so that frequent pieces are encoded once a worker."""
    return Encoder(path, end_id, most_pieces)


def _chunks(column: pa.Array, most_docs: int = 256, most_chars: int = 4_000_000) -> Iterator[list[str]]:
    """Texts in runs that bound memory."""
    run, size = [], 0
    for text in column:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if len(run) >= most_docs or size >= most_chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def trained_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, sample_docs: int = 1000, dictionary_bytes: int = 1 << 16) -> bytes:
    """A dictionary from the serialized ids of at most ``sample_docs`` documents of at most 64 KB.

    The sample has the smallest hashes of ids, so it is the same in every run. Too few texts to train
    on give an empty dictionary.
    """
    short = docs.select(F.xxhash64(F.col(id_col), F.lit(3)).alias("h"), F.col(text_col).alias("text")).where(F.octet_length("text") <= 1 << 16)
    last = short.select("h").orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    texts = [r["text"] for r in short.where(F.col("h") <= last).limit(sample_docs).collect()]
    samples = Encoder(tokenizer_path, end_id).encode(sorted(texts))
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, level: int = 3, most_pieces: int = 700_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents below ``path``; the manifest: (part, file, n_docs, n_tokens), a row per file.

    ``most_pieces`` trades a worker's memory (some 400 bytes each) for time.
    """
    dictionary = trained_dictionary(docs, tokenizer_path, end_id, id_col, text_col)
    name = hashlib.sha256(dictionary).digest() if dictionary else bytes(32)
    fs, at = _open(path)
    fs.create_dir(at)
    if dictionary:
        with fs.open_output_stream(f"{at}/{name.hex()}.dictionary") as f:
            f.write(dictionary)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    slim = slim.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes reference cycles, and looking for them takes a fifth of the time
        encoder = _encoder(tokenizer_path, end_id, most_pieces)
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        fs, at = _open(path)
        part, ids, triples, out, place, tokens = TaskContext.get().partitionId(), [], array("q"), None, len(_MAGIC) + 32, 0
        file = f"part-{part:06d}-{uuid.uuid4().hex[:8]}.tokens"
        for batch in batches:
            if batch.num_rows and out is None:
                out = fs.open_output_stream(f"{at}/{file}")
                out.write(_MAGIC + name)
            ids.append(pa.concat_arrays([batch.column("id")]))  # a copy, free of the batch's texts
            for texts in _chunks(batch.column("text")):
                frames = []
                for row in encoder.encode(texts):
                    frame, n = packer.compress(row), len(row) // encoder.dtype.itemsize
                    triples.extend((place, len(frame), n))
                    frames.append(frame)
                    place, tokens = place + len(frame), tokens + n
                out.write(b"".join(frames))
        if out is not None:
            names, n_docs = _packed(pa.chunked_array(ids)), len(triples) // 3
            out.write(names + np.array(triples, "<i8").tobytes())
            out.write(np.array([place, place + len(names), n_docs, encoder.dtype.itemsize], "<i8").tobytes())
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": file, "n_docs": n_docs, "n_tokens": tokens}])
        gc.enable()

    shape = "part long, file string, n_docs long, n_tokens long"
    with small_batches(docs.sparkSession):
        files = slim.mapInArrow(run, shape).collect()  # a row per file, as in ``read``
    return staged(docs.sparkSession.createDataFrame(files, shape).coalesce(1), "manifest")


def _packed(ids: pa.ChunkedArray) -> bytes:
    sink, table = pa.BufferOutputStream(), pa.table({"id": ids})
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())


class TokenFile:
    """Reads single documents of a file through its index; nothing but the footer is read beforehand."""

    def __init__(self, folder: str, file: str) -> None:
        fs, at = _open(folder)
        self.input = fs.open_input_file(f"{at}/{file}")
        size = self.input.size()
        self.names_at, self.triples_at, self.n_docs, width = np.frombuffer(self.input.read_at(32, size - 32), "<i8").tolist()
        head = self.input.read_at(len(_MAGIC) + 32, 0)
        if head[: len(_MAGIC)] != _MAGIC:
            raise ValueError(f"{file} is not a token file")
        self.dictionary_hash = head[len(_MAGIC) :].hex()
        self.dtype = np.dtype(f"<u{width}")
        data = None
        if self.dictionary_hash.strip("0"):
            with fs.open_input_file(f"{at}/{self.dictionary_hash}.dictionary") as f:
                raw = f.read()
            if hashlib.sha256(raw).hexdigest() != self.dictionary_hash:
                raise ValueError("the dictionary does not match its hash")
            data = zstandard.ZstdCompressionDict(raw)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=data)

    def ids(self) -> pa.Array:
        """The ids of the file's documents, in order."""
        raw = zstandard.ZstdDecompressor().decompress(self.input.read_at(self.triples_at - self.names_at, self.names_at))
        return pa.ipc.open_stream(raw).read_all().column("id").combine_chunks()

    def triples(self, first: int = 0, n: int | None = None) -> np.ndarray:
        """(offset, length, number of ids) of ``n`` documents from the ``first`` on."""
        n = self.n_docs - first if n is None else n
        return np.frombuffer(self.input.read_at(24 * n, self.triples_at + 24 * first), "<i8").reshape(n, 3)

    def tokens(self, k: int) -> np.ndarray:
        """The ids of the k-th document, its end id included."""
        place, length, n = self.triples(k, 1)[0].tolist()
        return self._unpacked(self.input.read_at(length, place), n)

    def _unpacked(self, frame: bytes, n: int) -> np.ndarray:
        ids = np.frombuffer(self.unpacker.decompress(frame), self.dtype)
        if len(ids) != n:
            raise ValueError("a frame does not hold the ids its index names")
        return ids

    def runs(self, most_docs: int = 512, most_bytes: int = 8 << 20) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """(triples, ids of each document) of all documents, in runs that are read at once."""
        first = 0
        while first < self.n_docs:
            triples = self.triples(first, min(most_docs, self.n_docs - first))
            ends = triples[:, 0] + triples[:, 1]
            triples = triples[: max(1, int(np.searchsorted(ends, triples[0, 0] + most_bytes, "right")))]
            low = int(triples[0, 0])
            raw = self.input.read_at(int(triples[-1, :2].sum()) - low, low)
            yield triples, [self._unpacked(raw[p - low : p - low + size], n) for p, size, n in triples.tolist()]
            first += len(triples)


def read(spark: SparkSession, path: str, manifest: DataFrame, id_type: DataType | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the manifest's files; ``id_type`` is that of the ids (long).

    The driver sees a row per file only, to add up where each file's ids start.
    """
    files, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        files.append((r["file"], start))
        start += r["n_tokens"]
    schema = StructType([StructField("doc_id", id_type or LongType()), *(StructField(c, LongType()) for c in ("start", "n_tokens", "ids_crc32"))])
    kind = to_arrow_type(schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                held, at = TokenFile(path, file), 0
                ids = held.ids().cast(kind)
                for triples, rows in held.runs():
                    counts = triples[:, 2]
                    crcs = [zlib.crc32(row.astype("<u4").tobytes()) for row in rows]
                    columns = [ids.slice(at, len(rows)), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
                    at, start = at + len(rows), start + int(counts.sum())

    listed = spark.createDataFrame(files, "file string, base long").repartition(max(1, len(files)))
    return listed.mapInArrow(run, schema)
