"""Token-ID output (op 6): shards of independent zstandard frames with a trailing seek table, and a reader of single documents.

A shard file holds, in this order: one zstandard frame per document (its ids as little-endian unsigned 32-bit integers), a skippable frame
with the shard's document ids (little-endian signed 64-bit), and a seek table as a skippable frame: for each document frame its compressed size, its
size and its checksum (low 32 bits of xxHash64 of the ids), then the number of frames, a descriptor and a magic number. The table stands at the
end, so a reader takes the last bytes, then only the frames of the documents that it wants, and checks each frame.

Documents are dealt to shards by ranges of doc_id and sorted within, so that the shards in the order of their names hold all documents in ascending
order. A shard file is written by one task under a name of its own attempt and then renamed, so a repeated task leaves one whole file.
Only the folder's URI and one row per shard pass through the driver; the positions of documents come from per-shard totals.

Encoding is the tokenizers library's. Texts are taken some megabytes at a time and cut at their spaces; each distinct part is cut by the library's own
pre-tokenizer rule and its ids are looked up once, then numpy gathers the ids of all texts. A worker remembers the ids of short parts (bounded in
bytes); texts that hold the string of a special token are encoded whole.

Defined cases: a null text counts as empty: its frame holds the end id alone; documents without id are written first, as id -2^63; repeated ids are
written next to each other, in an order by their texts; an empty table gives no shard. Extra columns are ignored.
"""

from __future__ import annotations

import array
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odspark.llm.common import Memo, held, shared_folder, small_batches, stored, table
from odspark.llm.piece_model import default_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_BYTES = 32 << 20   # text of one shard, about
LEVEL = 3                # of compression
CHUNK_BYTES = 4 << 20    # of the texts that are encoded at a time, about
PRE_TOKEN_BYTES, PART_BYTES = 4 << 20, 20 << 20   # of the texts that a generation of a worker's memos holds

# Fixed values of the seekable zstandard format.
SKIPPABLE_SEEK, SKIPPABLE_IDS, SEEK_MAGIC, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
# Fixed value: the pre-tokenizer rule of byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_ID = -(1 << 63)


class Encoder:
    """A tokenizer file; ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        # pre-tokens can be remembered only where the rule is known and nothing else acts on whole texts
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
                        and not spec.get("truncation") and not spec.get("padding"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.find = regex.compile(PRE_TOKEN).findall
        # byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
        # after a space: the words that follow one; at the start: those that do not
        self.pre_tokens = Memo(self._tokens, PRE_TOKEN_BYTES)
        self.after, self.start = Memo(self._after, PART_BYTES), Memo(self._pieces)
        self.apart = regex.compile(r" \s").search

    def whole(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _tokens(self, word: str) -> bytes:
        # a single pre-token needs the library's model only
        if word[0] == " " and word.isascii() and word[1:].isalpha():
            return _pack([t.id for t in self.tokenizer.model.tokenize(self.alphabet[32] + word[1:])])
        return _pack([t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))])

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pre_tokens.__getitem__, self.find(text)))

    def _after(self, word: str) -> bytes:
        return self._pieces(" " + word)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that follow a space: the rule cuts all of them at once, as no pre-token reaches beyond the next space."""
        pieces = self.find(" " + " ".join(words))
        starts = [i for i, p in enumerate(pieces) if p[0] == " "]
        starts.append(len(pieces))
        new, more = {}, self.pre_tokens.__getitem__
        for word, i, j in zip(words, starts[:-1], starts[1:], strict=True):
            # the first pre-token stands after a space, as a word of its own would
            head = pieces[i][1:]
            ids = new.get(head) or self.after.known(head)
            if ids is None:
                ids = new[head] = self._tokens(pieces[i])
            if j - i > 1:
                new[word] = ids + b"".join(map(more, pieces[i + 1:j]))
        self.after.keep_all(new)
        return new

    def encode_all(self, texts) -> list[bytes]:
        """Ids of each text of an Arrow array of strings."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        given = texts.to_pylist()
        plain = [self.by_word and not self.apart(t) and not any(s in t for s in self.special) for t in given]
        if not any(plain):
            return [self.encode(t) for t in given]
        parts = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        words = parts.flatten().dictionary_encode()
        names, place = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(pc.list_value_length(parts).to_numpy().astype(np.int64))
        first = np.concatenate([[0], ends[:-1]])
        # the first part of each text follows no space: entries of their own behind those of the others
        begin = [self.start[names[k]] for k in place[first].tolist()]
        place[first] = len(names) + np.arange(len(begin))
        used = np.bincount(place, minlength=len(names))[:len(names)] > 0
        ids = [self.after.known(w) if v is None and u else v or b"" for w, u, v in zip(names, used.tolist(), map(self.after.get, names), strict=True)]
        unseen = [k for k, v in enumerate(ids) if v is None]
        words = [names[k] for k in unseen if names[k]]
        new = self._learn(words) if words else {}
        for k in unseen:
            ids[k] = new[names[k]] if names[k] else self.after[""]
        ids += begin
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        per = n[place]
        to = np.cumsum(per)
        raw = np.frombuffer(b"".join(ids), "<u4")[np.repeat((np.cumsum(n) - n)[place] - (to - per), per) + np.arange(to[-1])].tobytes()
        cuts = (4 * np.concatenate([[0], to[ends - 1]])).tolist()
        done = (raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        return [next(done) if p else self.encode(t) for p, t in zip(plain, given, strict=True)]

    def encode(self, text: str) -> bytes:
        if not self.by_word or any(s in text for s in self.special):
            return self.whole(text)
        if self.apart(text):
            # white space after a space: its runs are taken apart by the rule
            return self._pieces(text)
        # a space before anything else begins a pre-token, and no pre-token reaches beyond the next one
        first, *rest = text.split(" ")
        return self.start[first] + b"".join(map(self.after.__getitem__, rest)) if text else b""


def _pack(ids: list[int]) -> bytes:
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpack(raw: bytes):
    import numpy as np

    return np.frombuffer(raw, "<u4").astype(np.int64)


def _chunks(batches):
    """Tables of batches that hold CHUNK_BYTES together, about."""
    import pyarrow as pa

    chunk, size = [], 0
    for b in batches:
        chunk.append(b)
        size += b.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(chunk)
            chunk, size = [], 0
    if chunk:
        yield pa.Table.from_batches(chunk)


def encoder(path: str) -> Encoder:
    return held("token_files", path, lambda: Encoder(path))


# ---- the file format ----

def checksum(ids: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF


def write_shard(out, documents: Iterator[tuple[int, bytes]]) -> tuple[int, int]:
    """Write (doc_id, ids) in order to a binary stream; numbers of documents and of ids."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
    seek, names, total = bytearray(), bytearray(), 0
    for doc_id, ids in documents:
        frame = compressor.compress(ids)
        out.write(frame)
        seek += struct.pack("<III", len(frame), len(ids), checksum(ids))
        names += struct.pack("<q", doc_id)
        total += len(ids) // 4
    n = len(names) // 8
    out.write(struct.pack("<II", SKIPPABLE_IDS, len(names)) + names)
    out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek) + 9) + seek + struct.pack("<IBI", n, CHECKSUMS, SEEK_MAGIC))
    return n, total


class Shard:
    """Reader of one shard file over a seekable binary stream: only the seek table is read at first."""

    def __init__(self, stream):
        import numpy as np

        self.stream = stream
        size = stream.seek(0, 2)
        self._at(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEK_MAGIC or not descriptor & CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        self._at(size - 9 - 12 * n)
        self.table = np.frombuffer(stream.read(12 * n), "<u4").reshape(n, 3)
        starts = np.zeros(n + 1, np.int64)
        np.cumsum(self.table[:, 0], out=starts[1:])
        self.starts = starts
        self._at(int(starts[-1]) + 8)
        self.doc_ids = np.frombuffer(stream.read(8 * n), "<i8")
        self.counts = self.table[:, 1].astype(np.int64) // 4

    def _at(self, place: int) -> None:
        self.stream.seek(place)

    def ids(self, k: int) -> bytes:
        """Ids of the k-th document of the shard; decompresses its frame only."""
        import zstandard

        self._at(int(self.starts[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.stream.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]) or 1)
        if len(raw) != int(self.table[k, 1]) or checksum(raw) != int(self.table[k, 2]):
            raise ValueError(f"frame {k} is damaged")
        return raw


def file_system(uri: str):
    """pyarrow file system and path of a URI (file:, hdfs:, s3:, ...) or local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


# ---- Spark ----

def write(docs: DataFrame, folder: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all documents to shard files in `folder` (a URI that all executors reach). One row per shard: shard (its order), file, documents, tokens."""
    path = path or default_path(TOKENIZER)
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    # a hash of the text after the id: documents without id, or with one id, spread over shards too
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = rows.repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        e, end = encoder(path), struct.pack("<I", end_id)
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def documents():
            for chunk in _chunks(x for part in ([first], batches) for x in part):
                doc_ids, texts = chunk.column(0).to_pylist(), chunk.column(1).combine_chunks()
                for doc_id, ids in zip(doc_ids, e.encode_all(texts), strict=True):
                    yield doc_id, ids + end

        k = TaskContext.get().partitionId()
        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        name = f"shard-{k:06d}.zst"
        attempt = f"{base}/_attempt-{k:06d}-{uuid.uuid4().hex}"
        with files.open_output_stream(attempt) as out:
            n, total = write_shard(out, documents())
        files.move(attempt, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([name]), pa.array([n]), pa.array([total])], names=["shard", "file", "documents", "tokens"])

    return dealt.mapInArrow(run, "shard long, file string, documents long, tokens long")


def read(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """Every document of the shard files: doc_id, start (ids of all documents before it), n_tokens and ids (array of long)."""
    return _read(spark, shards, folder, "ids array<long>", unpack)


def read_digests(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """As `read`, with the crc32 of the ids' bytes instead of the ids."""
    return _read(spark, shards, folder, "ids_crc32 long", zlib.crc32)


def _read(spark: SparkSession, shards: DataFrame, folder: str, field: str, of) -> DataFrame:
    import pyarrow as pa

    # one row per shard: a window over the table of shards gives each its start
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("shard", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    count = max(1, shards.count())

    def run(batches):
        import numpy as np

        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files, base = file_system(folder)
                with files.open_input_file(f"{base}/{name}") as stream:
                    s = Shard(stream)
                    starts = start + np.concatenate([[0], np.cumsum(s.counts)])
                    for k in range(0, len(s.doc_ids), 256):
                        to = min(k + 256, len(s.doc_ids))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(s.doc_ids[k:to]), pa.array(starts[k:to]), pa.array(s.counts[k:to]), pa.array([of(s.ids(i)) for i in range(k, to)], kind)],
                            names=["doc_id", "start", "n_tokens", field.split()[0]])

    kind = pa.list_(pa.int64()) if "array" in field else pa.int64()
    out = placed.repartition(count, "shard").select("file", "start").mapInArrow(run, f"doc_id long, start long, n_tokens long, {field}")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def read_documents(folder: str, file: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of some documents of one shard file; only their frames are read."""
    import numpy as np

    files, base = file_system(folder)
    with files.open_input_file(f"{base}/{file}") as stream:
        s = Shard(stream)
        return {d: np.frombuffer(s.ids(int(k)), "<u4").tolist() for d in doc_ids for k in np.flatnonzero(s.doc_ids == d)[:1]}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: writes all documents in the file format and reads them back."""
    folder = shared_folder(spark, "token-files")
    shards = stored(write(table(spark, sf_dir, "documents"), folder), "token-shards")
    return read_digests(spark, shards, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
