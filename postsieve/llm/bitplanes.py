"""Token ids in files of compressed planes, with an index of chunks and of documents.

The documents are range-partitioned by doc_id, so each part holds a stretch of the
corpus in order.  A part encodes its texts one after the other and writes a file whenever
it has a fixed number of ids, whatever the lengths of the documents.  The ids of a file
are cut into chunks; those of a chunk are transposed into planes, one per byte or per
bit, and each plane is compressed by itself with zstandard.

A file is ``part=p/seq=s/part-*``.  All its numbers are little-endian:

    "BPL1", u8 bits of a plane (8 or 1)
    the planes of all chunks, lowest first, one zstandard frame each
    index: u32 chunks; per chunk u64 place, u32 ids, u8 planes, per plane u32 bytes
           u32 documents; per document u64 place of its first id in the part, u64 its ids,
           u64 place and u64 number of those in this file, u8 whether it has a doc_id, i64 doc_id
    u32 crc32 of the index, u64 place of the index, "1LPB", a line feed

``_parts`` is a table (part, start, n): where each part begins in the corpus.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm.common import keyed, stored, text_or_empty
from postsieve.llm.words import Memory, batches, is_plain, is_word, lower_words, plain_words
from postsieve.session import work_folder

SHARD_IDS = 1 << 22  # 16 MB before compression
CHUNK_IDS = 1 << 16
END_ID = 2
REMEMBERED = 400_000  # words, twice; about 80 MB each
# New words that are encoded as one text.
_ROW = 500
# Characters of texts whose different words are looked up together.
_BATCH_CHARS = 4_000_000

_HEAD, _TAIL = b"BPL1", b"1LPB"
_DOCUMENT = np.dtype([("start", "<u8"), ("total", "<u8"), ("at", "<u8"), ("n", "<u8"), ("named", "u1"), ("doc_id", "<i8")])


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Planes of ``bits`` bits, the lowest first, up to the highest that is not all zero."""
    lines = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    width = max(1, int(ids.max(initial=0)).bit_length())
    if bits == 8:
        return [lines[k].tobytes() for k in range(-(-width // 8))]
    return [np.packbits(lines[k // 8] >> (k % 8) & 1, bitorder="little").tobytes() for k in range(width)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    lines = np.zeros((4, n), dtype=np.uint8)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, dtype=np.uint8)
        if bits == 8:
            lines[k] = raw
        else:
            lines[k // 8] |= np.unpackbits(raw, count=n, bitorder="little") << (k % 8)
    return np.ascontiguousarray(lines.T).view("<u4").ravel()


def write_shard(ids: np.ndarray, documents: np.ndarray, chunk_ids: int = CHUNK_IDS, bits: int = 8, level: int = 3) -> bytes:
    """The file of one shard; ``documents`` has the fields of ``_DOCUMENT``."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    parts, at, index = [_HEAD, bytes([bits])], len(_HEAD) + 1, []
    for begin in range(0, len(ids), chunk_ids):
        chunk = ids[begin : begin + chunk_ids]
        planes = [pack(plane) for plane in to_planes(chunk, bits)]
        index.append(struct.pack("<QIB", at, len(chunk), len(planes)) + struct.pack(f"<{len(planes)}I", *map(len, planes)))
        parts += planes
        at += sum(map(len, planes))
    body = struct.pack("<I", len(index)) + b"".join(index)
    body += struct.pack("<I", len(documents)) + documents.astype(_DOCUMENT).tobytes()
    return b"".join([*parts, body, struct.pack("<IQ", zlib.crc32(body), at), _TAIL])


@dataclass
class Shard:
    """A file's index; chunks are unpacked when they are asked for."""

    data: bytes

    def __post_init__(self):
        data = self.data.removesuffix(b"\n")
        end = len(data) - 16
        crc, at = struct.unpack_from("<IQ", data, end)
        if data[:4] != _HEAD or data[-4:] != _TAIL or zlib.crc32(data[at:end]) != crc:
            raise ValueError("not a whole file of planes")
        self.bits = data[4]
        (count,) = struct.unpack_from("<I", data, at)
        at += 4
        self.chunks = []
        for _ in range(count):
            place, n, planes = struct.unpack_from("<QIB", data, at)
            sizes = struct.unpack_from(f"<{planes}I", data, at + 13)
            self.chunks.append((place, n, sizes))
            at += 13 + 4 * planes
        (documents,) = struct.unpack_from("<I", data, at)
        self.documents = np.frombuffer(data, dtype=_DOCUMENT, count=documents, offset=at + 4)

    def chunk(self, k: int) -> np.ndarray:
        import zstandard

        place, n, sizes = self.chunks[k]
        unpack, planes = zstandard.ZstdDecompressor().decompress, []
        for size in sizes:
            planes.append(unpack(self.data[place : place + size]))
            place += size
        return from_planes(planes, n, self.bits)

    def ids(self) -> np.ndarray:
        return np.concatenate([self.chunk(k) for k in range(len(self.chunks))] or [np.zeros(0, dtype="<u4")])


# CRC-32 as polynomials over GF(2), bits reversed: the checksum of two parts from theirs.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    product = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            product ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return product


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings put together; ``length`` is that of the second."""
    power, square = 1 << 31, 1 << 23  # x^0 and x^8
    while length:
        if length & 1:
            power = _times(power, square)
        square, length = _times(square, square), length >> 1
    return _times(power, first) ^ second


class Encoder:
    """A word-level BPE of the tokenizers library, with a memory of words.

    New words are encoded in a row, and cut behind the tokens that end a word.  They are
    in lower case and apart already, so the library only has to merge.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_str(model)
        self._merges = Tokenizer(self._whole.model)
        split = pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._merges.pre_tokenizer = pre_tokenizers.Sequence(list(split))
        for tokenizer in (self._whole, self._merges):
            tokenizer.no_padding()
            tokenizer.no_truncation()
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        vocabulary = self._whole.get_vocab()
        self._ends = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self._ends[number] = bool(suffix) and token.endswith(suffix)
        self._words = Memory(self._learn_words, REMEMBERED)

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(row.ids, dtype="<u4") for row in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, pieces: list[str]) -> list[bytes]:
        words, others = [], []
        for piece in pieces:
            (words if is_word(piece) else others).append(piece)
        learned = dict(zip(others, [ids.tobytes() for ids in self._ids(self._whole, others)], strict=True))
        rows = [words[k : k + _ROW] for k in range(0, len(words), _ROW)]
        for row, ids in zip(rows, self._ids(self._merges, [" ".join(row) for row in rows]), strict=True):
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(row) and ends[-1] == len(ids):
                data, cuts = ids.tobytes(), (4 * ends).tolist()
                learned.update(zip(row, [data[i:j] for i, j in zip([0, *cuts], cuts)], strict=True))  # noqa: B905
            else:
                learned.update(zip(row, [ids.tobytes() for ids in self._ids(self._whole, row)], strict=True))
        return [learned[p] for p in pieces]

    def _of_words(self, words: pa.Array) -> pa.Array:
        pieces = words.to_numpy(zero_copy_only=False).tolist()
        if pa.types.is_large_binary(words.type):
            pieces = [word.decode("latin-1") for word in pieces]
        return pa.array(self._words.of(pieces), pa.large_binary())

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for some in batches(texts, _BATCH_CHARS):
            plain = [is_plain(text) for text in some]
            others = [lower_words(text) for text, p in zip(some, plain, strict=True) if not p]
            of_plain = _joined(plain_words([text for text, p in zip(some, plain, strict=True) if p]), self._of_words)
            of_others = _joined(pa.array(others, pa.large_list(pa.large_string())), self._of_words)
            for p in plain:
                yield next(of_plain if p else of_others)


def _joined(lists: pa.Array, results: Callable[[pa.Array], pa.Array]) -> Iterator[bytes]:
    """The results of each list's words, put together; ``results`` gets every different word once."""
    words = lists.flatten().dictionary_encode()
    found = results(words.dictionary).take(words.indices)
    ends = np.cumsum(pc.binary_length(found).to_numpy())
    places = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
    raw = memoryview(found.buffers()[2] or b"")
    for begin, end in zip(places, places[1:]):  # noqa: B905
        yield bytes(raw[begin:end])


_ENCODERS: dict[str, Encoder] = {}


def _shards(rows: Iterator[tuple[int | None, bytes]], shard_ids: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and documents of one file after the other; only one file's ids are held at a time."""
    ids: list[bytes] = []
    documents: list[tuple] = []
    held = start = 0
    for doc_id, data in rows:
        total, begin = len(data) // 4, 0
        while begin < total:
            n = min(total - begin, shard_ids - held)
            ids.append(data[4 * begin : 4 * (begin + n)])
            documents.append((start, total, start + begin, n, doc_id is not None, doc_id or 0))
            begin, held = begin + n, held + n
            if held == shard_ids:
                yield np.frombuffer(b"".join(ids), dtype="<u4"), np.array(documents, dtype=_DOCUMENT)
                ids, documents, held = [], [], 0
        start += total
    if held:
        yield np.frombuffer(b"".join(ids), dtype="<u4"), np.array(documents, dtype=_DOCUMENT)


def write_ids(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    chunk_ids: int = CHUNK_IDS,
    bits: int = 8,
) -> None:
    """Encode documents by rising doc_id (none first) and write their ids, each with the end id behind.

    One shuffle of the texts by range; equal doc_ids are spread by their texts.  The
    tokenizer's file, bounded by its vocabulary, is broadcast.  Spark's own commit puts the files in
    place, so a task that is lost leaves none.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    name = uuid.uuid4().hex
    end = struct.pack("<I", end_id)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[name] = Encoder(shared.value)
        encode, part = _ENCODERS[name].encode, TaskContext.get().partitionId()

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in parts:
                ids = encode(batch.column("text").to_pylist())
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                    yield doc_id, data + end

        for seq, (ids, documents) in enumerate(_shards(rows(), shard_ids)):
            data = write_shard(ids, documents, chunk_ids, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([data], pa.binary())],
                names=["part", "seq", "data"],
            )

    rows = keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = ["doc_id", "tie", "text"]
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions(*order)
    files = ordered.select("doc_id", "text").mapInArrow(run, "part int, seq int, data binary")
    # The text writer puts the bytes of a string as they are, and a line feed behind.
    files.select("part", "seq", F.col("data").cast("string").alias("value")).write.partitionBy("part", "seq").option(
        "compression", "none"
    ).text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    A document that lies in several files gets the checksum of the whole from those of its
    pieces.  Leaves the table ``_parts`` beside the files.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("part", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
                shard = Shard(content.as_py())
                documents = shard.documents
                raw = memoryview(shard.ids().tobytes())
                ends = np.cumsum(documents["n"].astype(np.int64)).tolist()
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, documents["n"].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(documents), part, dtype=np.int32)),
                        pa.array(documents["doc_id"], mask=documents["named"] == 0),
                        *[pa.array(documents[c].astype(np.int64)) for c in ("start", "total", "at", "n")],
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "total", "at", "n", "crc"],
                )

    schema = "part int, doc_id long, start long, total long, at long, n long, crc long"
    pieces = stored(files.mapInArrow(run, schema))
    # One row per partition of the shuffle.
    total, parts = 0, []
    for row in sorted(pieces.groupBy("part").agg(F.sum("n").alias("n")).collect(), key=lambda row: row.part):
        parts.append((row.part, total, row.n))
        total += row.n
    spark.createDataFrame(parts, "part int, start long, n long").coalesce(1).write.mode("overwrite").parquet(folder + "/_parts")
    offsets = spark.createDataFrame([(part, start) for part, start, _ in parts], "part int, offset long")
    pieces = pieces.join(F.broadcast(offsets), "part")
    for place in ("start", "at"):
        pieces = pieces.withColumn(place, F.col(place) + F.col("offset"))
    whole = pieces.where("n = total").select("doc_id", "start", F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        crc, found = 0, 0
        for one, n in zip(group["crc"].tolist(), group["n"].tolist(), strict=True):
            crc, found = crc32_joined(crc, one, 4 * n), found + n
        if found != group["total"].iloc[0]:
            raise ValueError(f"{found} of {group['total'].iloc[0]} ids of a document are in the files")
        return pd.DataFrame({"start": [group["start"].iloc[0]], "ids_crc32": [crc]})

    # Every document has an end id, so no two start at one place.
    cut = pieces.where("n < total")
    crcs = cut.select("start", "total", "at", "n", "crc").groupBy("start").applyInPandas(join, "start long, ids_crc32 long")
    heads = cut.where("at = start").select("doc_id", "start", F.col("total").alias("n_tokens"))
    return whole.unionByName(heads.join(crcs, "start").select("doc_id", "start", "n_tokens", "ids_crc32"))


def store_ids(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID, **options) -> DataFrame:
    """Encode, write and read back: per document doc_id, start, n_tokens, ids_crc32.

    NULL and empty texts have the end id alone.  Of rows with one doc_id each keeps its place, by its
    text; rows without doc_id come first.  An empty table writes no file and gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or f"{work_folder(spark)}/llm/ids-{uuid.uuid4().hex}"
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    write_ids(docs, path, folder, end_id, **options)
    return read_documents(spark, folder)
