"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits.  Level 0 holds the lowest chunk of every id, a bitmap says which
ids continue, level 1 holds the next chunk of those that do, and so on.  A rank directory (the count
of set bits before each block of 512) turns a position of one level into the position of the next,
so any id is read with one directory look-up and one popcount a level; no block is decoded.

``write_token_files`` encodes the texts where they are read, range-partitions the ids of tokens by document, sorts each
partition and writes segments: rows of a Parquet table with the ids and lengths of a run of documents and one
binary payload.  A segment closes at ``segment_tokens`` ids, so a task holds one segment at a time
whatever a partition holds.  Spark's committer makes the write safe against lost executors.

Payload, little-endian: ``DAC1``, u32 number of levels; for each level u64 number of ids n, then n
bytes of chunks, ceil(n / 8) bytes of bitmap (lowest bit first), ceil(n / 512) u32 of directory.

Edge cases: a null or empty text encodes to the end id alone; rows with equal ids are written one
after the other in the order of a hash of their texts; null ids come first; an empty table writes a
table without segments; a text of any length is encoded whole.
"""

from __future__ import annotations

import codecs
import contextlib
import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, pieces, shared_dir, text_key
from .registry import query

END_ID = 2
MAGIC = b"DAC1"
BLOCK = 512


def _level(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """One level's bytes, and what goes on to the next."""
    rest = ids >> 8
    more = rest > 0
    per_block = np.add.reduceat(more, np.arange(0, len(ids), BLOCK), dtype=np.uint32) if len(ids) else np.zeros(0, np.uint32)
    directory = (np.cumsum(per_block) - per_block).astype("<u4")
    return (struct.pack("<Q", len(ids)) + (ids & 255).astype(np.uint8).tobytes()
            + np.packbits(more, bitorder="little").tobytes() + directory.tobytes()), rest[more]


def encode_dac(ids: np.ndarray) -> bytes:
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while len(rest) or not levels:
        level, rest = _level(rest)
        levels.append(level)
    return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Dac:
    """Random access to an encoded run of ids: ``codes[i]``, ``codes.read(start, stop)``, ``len(codes)``."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 payload")
        self._levels, at = [], 8
        for _ in range(struct.unpack_from("<I", payload, 4)[0]):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            bits = np.frombuffer(payload, np.uint8, -(-n // 8), at + 8 + n)
            directory = np.frombuffer(payload, "<u4", -(-n // BLOCK), at + 8 + n + len(bits))
            self._levels.append((chunks, bits, directory))
            at += 8 + n + len(bits) + 4 * len(directory)

    def __len__(self) -> int:
        return len(self._levels[0][0])

    @staticmethod
    def _rank(level, i: int) -> int:
        """Set bits before position i."""
        chunks, bits, directory = level
        if i >= len(chunks):
            block = len(directory) - 1
            if block < 0:
                return 0
            i = len(chunks)
        else:
            block = i // BLOCK
        part = int.from_bytes(bits[block * BLOCK // 8:-(-i // 8)].tobytes(), "little")
        return int(directory[block]) + (part & ((1 << (i - block * BLOCK)) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, level in enumerate(self._levels):
            chunks, bits, _ = level
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def read(self, start: int, stop: int) -> np.ndarray:
        """ids[start:stop]; only these are touched on every level."""
        out = None
        where = None
        for k, level in enumerate(self._levels):
            chunks, bits, _ = level
            values = chunks[start:stop].astype(np.uint32) << np.uint32(8 * k)
            if out is None:
                out, where = values, np.arange(len(values))
            else:
                out[where] |= values
            first = start // 8
            more = np.unpackbits(bits[first:-(-stop // 8)], bitorder="little")[start - first * 8:stop - first * 8].astype(bool)
            where = where[more]
            if not len(where):
                break
            start = self._rank(level, start)
            stop = start + len(where)
        return out


#: How byte-level vocabularies write a byte: printable ones of Latin-1 as themselves, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_REST = iter(range(256, 512))
_WRITTEN = "".join(chr(b if b in _PRINTABLE else next(_REST)) for b in range(256))


def _byte_level(text: str) -> str:
    return text if text.isascii() else codecs.charmap_decode(text.encode(), "strict", _WRITTEN)[0]


class Words(dict):
    """The ids of words; one that is absent is learned, kept and given."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordEncoder:
    """Encodes texts word by word with a cache, exactly as the tokenizer encodes whole texts.

    It applies to tokenizers whose pre-tokenizer keeps no white space: no token spans it then, and the
    ids of a text are those of its words in turn.  A new word goes through the library's own
    normalizer, pre-tokenizer and model; words that hold a special token's text, and all texts of any
    other tokenizer, go through its whole encoder.  Latin letters with marks behind them
    skip the normalizer and pre-tokenizer where probes show that these lower the case and cut off the marks, no more.
    The cache has two generations of at most ``cache_words`` words and those of one block of texts; a word is learned where it is
    first met."""

    MARKS = b".,;:!?*#$%&|<>()[]{}\"'-_/+=~^@`\\"
    LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")  # lower-case Latin: one code point each, stable under NFC

    def __init__(self, path: str, cache_words: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        before = self.tokenizer.pre_tokenizer
        steps = (json.loads(before.__getstate__()) if before else {}).get("pretokenizers") or [{}]
        self.by_word = (steps[0].get("type"), steps[0].get("behavior"), steps[0].get("invert")) == ("Split", "Removed", True)
        self.cache_words = cache_words
        self.cache, self.older = Words(self._learned), {}
        if self.by_word:
            self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.special_low = [m.lower() for m in self.special]
            self.model, self.before = self.tokenizer.model, before
            self.tokenize = self.model.tokenize
            self.normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
            probes = ["AZaz", "\u00c9t\u00e9\u0178\u0219", "\u00df"]
            self.probes = [(w, _byte_level(w.lower())) for w in probes]
            self.plain = all(self._parts(w) == [low] for w, low in self.probes)
            self.ends = {b"": b""}

    def _end(self, marks: bytes) -> bytes | None:
        """The ids of marks at the end of a word; None if they aren't always parts of their own."""
        text = marks.decode()
        parts = self._parts(text)
        alone = len(self.ends) < 10_000 and all(self._parts(w + text) == [low, *parts] for w, low in self.probes)
        ids = self._ids(parts) if alone else None
        if len(self.ends) < 10_000:
            self.ends[marks] = ids
        return ids

    def _parts(self, word: str) -> list[str]:
        return [part for part, _ in self.before.pre_tokenize_str(self.normal(word))]

    def _alone(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _ids(self, parts: list[str]) -> bytes:
        return np.array([token.id for part in parts for token in self.model.tokenize(part)], "<u4").tobytes()

    def _learned(self, word: bytes) -> bytes:
        """The ids of a word that the newer generation lacks."""
        ids = self.older.get(word)
        if ids is not None:
            return ids
        if self.plain:
            body = word.rstrip(self.MARKS)
            marks = word[len(body):]
            end = self.ends[marks] if marks in self.ends else self._end(marks)
            if end is None:
                low = b""
            elif body.isalpha():  # of bytes: ASCII letters
                low = body.lower()
                plain = low.decode()
            else:
                plain = body.decode().lower()
                low = plain.encode() if self.LETTERS.fullmatch(plain) else b""
                plain = _byte_level(plain)
            if low == word:
                return self._packed(plain)
            if low:  # a word is often known without its mark and capitals
                ids = self.cache.get(low) or self.older.get(low) or self._packed(plain)
                self.cache[low] = ids
                return ids + end
        return self._alone([word])[0] if any(m in word for m in self.special) else self._ids(self._parts(word.decode()))

    def _packed(self, part: str) -> bytes:
        found = [token.id for token in self.tokenize(part)]
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian u32 ids of each text (UTF-8), without an end id; equal texts are encoded once."""
        if not self.by_word:
            return self._alone([t or b"" for t in texts])
        if len(self.cache) > self.cache_words:
            self.cache, self.older = Words(self._learned), self.cache
        known = self.cache.__getitem__
        made = {t: b"".join(map(known, self._lowered(t or b"").split())) for t in set(texts)}
        return [made[t] for t in texts]

    def _lowered(self, text: bytes) -> bytes:
        """ASCII in lower case, as the normalizer would have it, unless that could spell a special token."""
        low = text.lower() if self.plain else text
        return text if any(m in low for m in self.special_low) else low


_ENCODERS: dict[tuple, WordEncoder] = {}
CACHE_WORDS = 200_000


def encoder(path: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder, with its cache, for each Python worker."""
    if (path, cache_words) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, cache_words] = WordEncoder(path, cache_words)
    return _ENCODERS[path, cache_words]


def packed_ids(ids: bytes) -> bytes:
    """Little-endian u32 ids as planes: the lowest byte of all, the next one of all, as many as the largest id has."""
    values = np.frombuffer(ids, "<u4")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    if width == 2:  # most vocabularies
        return b"\x02" + values.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()
    return bytes([width]) + values.view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def unpacked_ids(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, :packed[0]] = planes.T
    return out.view("<u4").ravel()


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS) -> DataFrame:
    """_id, _t (a hash of the text), _ids (packed and compressed ids without an end id) of each row, from a table written to the shared
    folder: 2 bytes an id travel instead of texts, and the range partitioning, which reads its input twice, doesn't encode twice."""
    rows = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_id"], rows.schema["_t"], T.StructField("_ids", T.BinaryType())])

    def run(batches):
        code, squeeze = encoder(tokenizer_path, cache_words), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for piece in pieces(batch, "_text", 1 << 20):
                made = code.encode(piece.column("_text").cast(pa.binary()).to_pylist())
                small = [squeeze(packed_ids(ids)) for ids in made]
                yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_t"), pa.array(small, pa.binary())], names=schema.names)

    spark = docs.sparkSession
    out = shared_dir(spark, "ids")
    with small_batches(spark):
        rows.mapInArrow(run, schema).write.options(compression="none", **ROW_GROUPS).parquet(out)  # ids are compressed already
    return spark.read.parquet(out)


#: A task holds a row group as it writes or reads one, whatever its file has.  Pages and groups are cut by size from the first row
#: on; by default 100 rows are taken unseen, which for segments is some 120 MB.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}


@contextlib.contextmanager
def small_batches(spark: SparkSession, most_rows: int = 1_000, most_bytes: int = 2 << 20):
    """What is written in this block passes at most so many rows, and about so many bytes (one row at least), at a time between Spark
    and Python, which bounds the memory of both beside a task's own; then the session's settings hold again."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {name: spark.conf.get(name) for name in (rows, size)}
    spark.conf.set(rows, str(min(most_rows, int(before[rows])) if int(before[rows]) > 0 else most_rows))
    spark.conf.set(size, str(most_bytes))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, segment_tokens: int = 1 << 19, cache_words: int = CACHE_WORDS) -> None:
    """Encode ``docs`` and write them in ascending order of ``id_col`` as a table of DAC segments at ``out``.  A worker remembers twice
    ``cache_words`` words (some 200 bytes each): fewer take less memory and more time."""
    rows = encoded(docs, tokenizer_path, id_col, text_col, cache_words)
    # many rows of equal id and text are told apart by where they were saved, so that they can be dealt to several partitions
    keys = [F.col("_id").asc_nulls_first(), F.col("_t").asc(), F.col("_row").asc()]
    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select("_id", "_ids", F.spark_partition_id().alias("_part"))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("first_token", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(rows.schema["_id"].dataType)), T.StructField("doc_tokens", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.BinaryType())])
    end = np.array([end_id], np.uint32)

    def run(batches):
        part, id_type, first, restore = None, None, 0, zstandard.ZstdDecompressor().decompress
        held, ids, lengths, n = [], [], [], 0

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([ids], pa.list_(id_type)),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([encode_dac(np.concatenate(held))], pa.binary())], names=schema.names)

        for batch in batches:
            if batch.num_rows:
                part, id_type = batch.column("_part")[0].as_py(), batch.schema.field("_id").type
            for doc, tokens in zip(batch.column("_id").to_pylist(), batch.column("_ids"), strict=True):
                values = unpacked_ids(restore(tokens.as_py()))
                held += values, end
                ids.append(doc)
                lengths.append(len(values) + 1)
                n += lengths[-1]
                if n >= segment_tokens:
                    yield segment()
                    first += n
                    held, ids, lengths, n = [], [], [], 0
        if ids:
            yield segment()

    with small_batches(docs.sparkSession):
        ordered.mapInArrow(run, schema).write.options(compression="zstd", **ROW_GROUPS).parquet(out)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The table of segments with ``start``: the ids in all segments before.  The running sum, which is
    broadcast, has one row of 12 bytes for each file written."""
    table = spark.read.parquet(path)
    per_part = table.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return table.join(F.broadcast(base), "part").withColumn("start", F.col("_base") + F.col("first_token")).drop("_base")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start, n_tokens, ids (array of int) per document."""
    table = segments(spark, path).select("doc_ids", "doc_tokens", "codes", "start")
    id_type = table.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return table.mapInArrow(_each_document(lambda ids: pa.array([ids], pa.list_(pa.int32()))), schema)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start, n_tokens and the CRC-32 of the ids as little-endian u32, per document."""
    table = segments(spark, path).select("doc_ids", "doc_tokens", "codes", "start")
    id_type = table.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return table.mapInArrow(_each_document(lambda ids: zlib.crc32(np.ascontiguousarray(ids, "<u4"))), schema)


def _each_document(value):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                codes = Dac(batch.column("codes")[row].as_py())
                docs, lengths = batch.column("doc_ids")[row].values, batch.column("doc_tokens")[row].values.to_numpy()
                stops = np.cumsum(lengths, dtype=np.int64)
                start = batch.column("start")[row].as_py()
                ids = codes.read(0, len(codes))  # all documents of the segment are asked for
                made = [value(ids[b - n:b]) for b, n in zip(stops.tolist(), lengths.tolist(), strict=True)]
                last = pa.concat_arrays(made) if isinstance(made[0], pa.Array) else pa.array(made, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(start + stops - lengths, pa.int64()), pa.array(lengths.astype(np.int64)), last],
                    names=["doc_id", "start", "n_tokens", "ids" if isinstance(made[0], pa.Array) else "ids_crc32"])
    return run


def read_token(table: DataFrame, position: int) -> int:
    """The id at a global position, from the one segment that holds it and without decoding it."""
    row = table.filter((F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position)).select("start", "codes").first()
    if row is None:
        raise IndexError(position)
    return Dac(bytes(row["codes"]))[position - row["start"]]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def token_digests(docs: DataFrame, tokenizer_path: str | None = None, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Write ``docs`` as token files into the shared folder and read them back."""
    spark = docs.sparkSession
    out = shared_dir(spark, "tokens")
    write_token_files(docs, tokenizer_path or default_tokenizer(), out, cache_words=cache_words)
    return read_digests(spark, out)


@query("op10_token_files")
def op10(spark, sf_dir):
    return token_digests(documents(spark, sf_dir).select("doc_id", "text"))
