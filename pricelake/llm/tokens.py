"""Token ids in seekable binary shards.

A shard file is a run of independent zstandard frames with a seek table at
its end, laid out as the public seekable format: the frames, then a skippable
frame holding compressed size, decompressed size and checksum (low half of
XXH64 of the content) per frame, and the footer.  Frame 0 is the shard's
index (place in the output, ids and token counts of its documents); each
further frame is one document's token ids as little-endian 32-bit integers,
end id included.  A reader finds a document in the index, takes its frame's
offset from the seek table and decompresses that frame alone.

Documents are range-partitioned by id, so shards are in ascending id order;
a task starts a new shard at ``SHARD_BYTES``.  Spark's own writer commits the
files (a record each), so a lost executor leaves no half-written shard, and
any file system that Spark reaches will do.

Tokenising splits texts at blanks, which the vocabulary drops and never
joins over, and a worker encodes each distinct word once with the tokenizer
library; words are held up to ``HELD``.

Defined results: a null or empty text is the end id alone; null ids sort
first and read back as null; equal ids are ordered by a hash of the text; an
empty table writes no shard.  Ids are 64-bit integers.  Other columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import running_total
from .common import partitions, run_folder, stored, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SHARD_BYTES = 8 << 20
#: Words whose ids a worker holds (and those of the texts at hand).
HELD = 500_000

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80


#: A full stop or comma next to other punctuation, with which it is one piece.
JOINED = re.compile(r"[.,](?:(?=[^\w \t\n\r])|(?=_)|(?<=[^\w \t\n\r][.,])|(?<=_[.,]))")
#: Where a letter up to U+00FF and ASCII punctuation but the apostrophe meet:
#: always two pieces.
MEET = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-&(-/:-@\[-^`{-~])|(?<=[!-&(-/:-@\[-^`{-~])(?=[A-Za-zÀ-ÖØ-öø-ÿ])")


class Encoder(dict):
    """Whole texts to token ids, as bytes; a dictionary of the words met.

    The vocabulary's rules split a text at blanks and between letters, digits
    and other characters, and lower-case it.  So capitals make no difference
    (taken as given in texts up to U+00FF, where lower-casing is one to one),
    and a full stop or comma that touches no other punctuation is a word of
    its own.  Texts are reduced by this first, which leaves far fewer words to
    encode and to hold."""

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(vocabulary or public_tokenizers.path(VOCABULARY))
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _encode_one(self, w: str) -> bytes:
        return np.asarray(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        plain = []  # words of letters are one piece each, whose last token is marked
        for w in words:
            if w.isalpha():
                plain.append(w)
            else:
                self[w] = self._encode_one(w)
        for i in range(0, len(plain), 1000):
            part = plain[i:i + 1000]
            (e,) = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.asarray(e.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                blob, at = ids.tobytes(), 0
                for w, end in zip(part, (4 * cuts).tolist()):
                    self[w] = blob[at:end]
                    at = end
            else:
                for w in part:
                    self[w] = self._encode_one(w)

    def words(self, text: str | None) -> list[str]:
        t = text or ""
        if "<|" not in t:  # special tokens are told from the text as it is
            try:
                t.encode("latin-1")
                t = t.lower()
                plain = True
            except UnicodeEncodeError:
                # normalising or lower-casing must not put a mark after a letter
                plain = unicodedata.is_normalized("NFC", t) and "\u0130" not in t
            if plain:
                t = MEET.sub(" ", t) if JOINED.search(t) else t.replace(".", " . ").replace(",", " , ")
        if any(c in t for c in "\x1c\x1d\x1e\x1f"):  # blanks to Python alone
            return t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return t.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > HELD:
            self.clear()
            self[""] = b""
        out, new, wait = [], {}, []
        for t in texts:
            words = self.words(t)
            ids = list(map(self.get, words))
            if None in ids:
                new.update((w, None) for w, i in zip(words, ids) if i is None)
                wait.append((len(out), words))
            out.append(ids)
        if new:
            self._learn(list(new))
            for i, words in wait:
                out[i] = map(self.__getitem__, words)
        return [b"".join(ids) for ids in out]


_encoders: dict[str | None, Encoder] = {}


def encoder(vocabulary: str | None = None) -> Encoder:
    """The worker's encoder: its words serve all its tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


class ShardWriter:
    """Collects documents into the bytes of one shard."""

    def __init__(self, part: int, seq: int):
        self.part, self.seq, self.size = part, seq, 0
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.frames: list[tuple[bytes, int, int]] = []
        self.packer = zstandard.ZstdCompressor(level=3)

    def _frame(self, content: bytes) -> tuple[bytes, int, int]:
        return self.packer.compress(content), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.frames.append(self._frame(ids))
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.size += len(self.frames[-1][0])

    def close(self) -> bytes:
        n = len(self.ids)
        index = (struct.pack("<qqq", self.part, self.seq, n)
                 + np.asarray([x or 0 for x in self.ids], "<i8").tobytes()
                 + np.asarray([x is None for x in self.ids], "u1").tobytes()
                 + np.asarray(self.counts, "<u4").tobytes())
        frames = [self._frame(index), *self.frames]
        entries = b"".join(struct.pack("<III", len(f), size, check) for f, size, check in frames)
        tail = entries + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
        return b"".join(f for f, _, _ in frames) + struct.pack("<II", SKIPPABLE, len(tail)) + tail


class ShardReader:
    """Random access to a shard's documents."""

    def __init__(self, content: bytes):
        n, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a shard: no seek table")
        table = np.frombuffer(content[-9 - 12 * n:-9], "<u4").reshape(n, 3)
        self.content, self.sizes = content, table
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()
        head = self.frame(0)
        self.part, self.seq, n = struct.unpack("<qqq", head[:24])
        ids = np.frombuffer(head, "<i8", n, 24).tolist()
        null = np.frombuffer(head, "u1", n, 24 + 8 * n)
        self.counts = np.frombuffer(head, "<u4", n, 24 + 9 * n).astype(np.int64)
        self.ids = [None if z else x for x, z in zip(ids, null)]

    def frame(self, i: int) -> bytes:
        out = self.unpacker.decompress(self.content[self.offsets[i]:self.offsets[i + 1]],
                                       max_output_size=int(self.sizes[i, 1]))
        if len(out) != self.sizes[i, 1] or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != self.sizes[i, 2]:
            raise ValueError(f"frame {i}: checksum does not match")
        return out

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document; only its frame is decompressed."""
        return np.frombuffer(self.frame(i + 1), "<u4")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every document and write the shards under ``path``.
    ``vocabulary``: a tokenizer file that every executor has."""
    end = struct.pack("<I", end_id)

    def pack(batches):
        from pyspark import TaskContext
        part, seq, shard = TaskContext.get().partitionId(), 0, None
        for b in batches:
            for i in range(0, b.num_rows, 64):
                rows = b.slice(i, 64)
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoder(vocabulary).encode(rows.column(1).to_pylist())):
                    shard = shard or ShardWriter(part, seq)
                    shard.add(doc_id, ids + end)
                    if shard.size >= shard_bytes:
                        yield pa.record_batch([pa.array([shard.close()], pa.binary())], names=["shard"])
                        shard, seq = None, seq + 1
        if shard:
            yield pa.record_batch([pa.array([shard.close()], pa.binary())], names=["shard"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the text writer puts each record in a file of its own and ends it with
    # the line separator: that is the last field of the format
    (rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(pack, "shard binary")
     .select(F.expr("substring(shard, 1, length(shard) - 4)").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").option("encoding", "ISO-8859-1")
     .option("lineSep", struct.pack("<I", SEEKABLE).decode("latin-1")).text(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """doc_id and token_ids of the wanted documents; of the shards, indexes
    and the wanted frames are decompressed."""
    wanted = set(ids)

    def pick(batches):
        for b in batches:
            for x in b.column(0):
                r = ShardReader(x.as_py())
                at = [i for i, d in enumerate(r.ids) if d in wanted]
                if at:
                    yield pa.record_batch([pa.array([r.ids[i] for i in at], pa.int64()),
                                           pa.array([r.document(i).astype(np.int64) for i in at], pa.list_(pa.int64()))],
                                          names=["doc_id", "token_ids"])

    return shards(spark, path).mapInArrow(pick, "doc_id long, token_ids array<long>")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shards: doc_id, start, n_tokens, ids_crc32; every
    frame is read and its checksum compared."""
    def scan(batches):
        for b in batches:
            for x in b.column(0):
                r = ShardReader(x.as_py())
                n = len(r.ids)
                crc = [zlib.crc32(r.frame(i + 1)) for i in range(n)]
                yield pa.record_batch(
                    [pa.array([r.part] * n, pa.int64()), pa.array([r.seq] * n, pa.int64()), pa.array(r.ids, pa.int64()),
                     pa.array(np.cumsum(r.counts) - r.counts, pa.int64()), pa.array(r.counts, pa.int64()),
                     pa.array(crc, pa.int64())], names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"])

    rows = stored(shards(spark, path).mapInArrow(
        scan, "part long, seq long, doc_id long, within long, n_tokens long, ids_crc32 long"), run_folder(spark, "tokens-read"))
    sizes = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    before = running_total(sizes, ["part", "seq"], "upto", weight=F.col("n"))
    return (rows.join(before.select("part", "seq", (F.col("upto") - F.col("n")).alias("before")), ["part", "seq"])
            .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Write ``docs`` as shards in a new shared folder and read them back."""
    path = run_folder(docs.sparkSession, "tokens")
    write_shards(docs, path, id_col, text_col, **how)
    return read_back(docs.sparkSession, path)


def query(spark, sf_dir):
    return tokenized(table(spark, sf_dir, "documents"))
