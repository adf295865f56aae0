"""Token ids in binary files: independent zstandard frames, an index of documents and a seek table with checksums."""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sentencepieces import spread
from .shared import saved, scratch_path, shuffle_partitions, table
from .text import as_bytes, coded, pieces, range_sums

VOCABULARY, END_ID = "word_bpe_49k.json", 1
#: Bytes of ids in a frame, at most. A document is cut only if it is longer, so a reader of one needs no other's frames.
FRAME_BYTES = 1 << 18
#: Ids of a file, about, at most, as long as there are fewer than MAX_FILES files; files are not made smaller than SMALL_FILE.
FILE_IDS, MAX_FILES, SMALL_FILE = 1 << 26, 20_000, 1 << 18
#: Bytes of words and ids that an encoder remembers before it starts afresh, some 150 MB with what holds them.
MEMORY = 20_000_000
PIECE_BYTES = 2_000_000  # of the texts that are taken together
JOINED = 64  # new words that go through the library as one text
LEVEL = 3

# Fixed values of the seekable zstandard format: magic numbers of its table and its end, and of the frame with the index.
SEEK_TABLE, SEEKABLE_END, INDEX_FRAME, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x184D2A5D, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
IDS = np.dtype("<u4")

FILES = "path string, first_id long, last_id long, first_tie long, n_docs long, n_ids long, n_frames long, n_bytes long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: How the normalizer and the pattern of a tokenizer look for which plain_tokenizer() is known to give the same ids.
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
WORD_END = "</w>"


def plain_tokenizer(model: str):
    """The library's tokenizer without normalizer and pattern, for lower-case words of Latin-1 letters; None if the model differs.

    Such a word is in normal form and one run of letters, so the pattern would leave it as it is.
    """
    from tokenizers import Tokenizer

    own = json.loads(model)
    if own["normalizer"] != {"type": "Sequence", "normalizers": NORMAL} or own["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]} or own["model"].get("end_of_word_suffix") != WORD_END:
        return None
    own |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, BYTES]}}
    return Tokenizer.from_str(json.dumps(own))


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space: each distinct word goes through the library once.

    Such a tokenizer never joins what white space parts, so a text's ids are those of its words. To have fewer of
    these, marks behind a Latin letter or a digit are parted from it, as the tokenizer's pattern does, and A-Z are
    lower-cased where that comes to the same: where no accent follows by itself and no special token may appear.
    Words of plain letters alone need neither the pattern nor normal forms: see ``plain_tokenizer``.
    """

    # any ASCII mark but ', which may begin a token of letters, and those that special tokens are made of
    marks = re.compile(rb"[!-&(-/:;=?@[-`{}~](?:(?<=[A-Za-z0-9].)|(?<=[\xc4\xc5][\x80-\xbf].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[!-&(-/:;=?@[-`{}~]*(?=[ \n]|\Z)")
    letters = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        self.library = Tokenizer.from_str(model)
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else IDS
        self.plain = plain_tokenizer(model)
        self.last = np.zeros(self.library.get_vocab_size(), bool)  # ids of tokens that end a word
        self.last[[i for token, i in self.library.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.size = 0

    def words(self, text: bytes) -> bytes:
        """The text with more white space and fewer capitals, as above."""
        if not (b"<|" in text or b"\xcc" in text or b"\xcd" in text):
            text = text.lower()
        return self.marks.sub(rb" \g<0>", text)

    def learn(self, words: list[str]) -> None:
        """Remember the words' ids."""
        letters = [w for w in words if self.letters.fullmatch(w)] if self.plain else []
        if self.learn_plain(letters):
            words = [w for w in words if w not in self.known]
        self.learn_any(words)

    def learn_plain(self, words: list[str]) -> bool:
        """Remember the ids of words of ``letters``, each of which ends with the one token that ends a word; false if any does not."""
        if not words:
            return False
        texts = [" ".join(words[i : i + JOINED]).lower() for i in range(0, len(words), JOINED)]
        ids = np.concatenate([np.array(found.ids, self.kind) for found in self.plain.encode_batch_fast(texts, add_special_tokens=False)])
        cut = np.flatnonzero(self.last[ids]) + 1
        if len(cut) != len(words) or cut[-1] != len(ids):
            return False
        ids, cut = ids.tobytes(), (cut * self.kind.itemsize).tolist()
        self.known.update((w, ids[i:j]) for w, i, j in zip(words, [0, *cut], cut))
        self.size += 2 * sum(map(len, words)) + len(ids)
        return True

    def learn_any(self, words: list[str]) -> None:
        """Remember the words' ids. JOINED words make one text for the library; where a token ends tells the word it is of."""
        joined = [w for w in words if "<|" not in w]  # special tokens may take the space beside them
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)] + [[w] for w in words if "<|" in w]
        for group, found in zip(groups, self.library.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, self.kind).tobytes()
            ends = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 1]
            after = np.fromiter(map(len, group), np.int64, len(group)) + 1
            cut = (np.searchsorted(ends, np.cumsum(after) - 1, "right") * self.kind.itemsize).tolist()
            cut[-1] = len(ids)
            for w, i, j in zip(group, [0, *cut], cut):
                self.known[w] = ids[i:j]
                self.size += 2 * len(w) + j - i

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, with ``end_id`` behind each, and how many each has."""
        if self.size > MEMORY:
            self.known, self.size = {}, 0
        codes, counts, distinct = coded(pc.ascii_split_whitespace(pa.array([self.words(t) for t in texts], pa.binary()).cast(pa.string())))
        if new := [w for w in distinct if w not in self.known]:
            self.learn(new)
        ids = list(map(self.known.__getitem__, distinct))
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        in_text = range_sums(n[codes], counts)
        out = np.frombuffer(b"".join(ids), self.kind)[spread((np.cumsum(n) - n)[codes], n[codes])]
        return np.insert(out, np.cumsum(in_text), end_id), in_text + 1


_encoders: dict[int, WordEncoder] = {}


def encoder(model: str) -> WordEncoder:
    """The encoder, made once in each Python worker."""
    key = hash(model)
    if key not in _encoders:
        _encoders[key] = WordEncoder(model)
    return _encoders[key]


def encoded(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): the whole text's ids, null counting as empty, with ``end_id`` behind them, as bytes; two an id if that is enough."""
    with open(vocabulary, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            for i, j in pieces(texts, PIECE_BYTES):
                ids, counts = encoder(model.value).encode(texts[i:j], end_id)
                ends = (np.concatenate(([0], np.cumsum(counts))) * ids.itemsize).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), column], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


class Writer:
    """Writes documents one after the other; close() adds the index and the seek table."""

    def __init__(self, out: BinaryIO, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.open: list[bytes] = []
        self.filled, self.written = 0, 0
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.starts = [0]

    def put(self, packed: bytes, size: int, check: int) -> None:
        self.out.write(packed)
        self.entries.append((len(packed), size, check))
        self.written += len(packed)

    def flush(self) -> None:
        if self.filled:
            data = b"".join(self.open)
            self.put(self.zstd.compress(data), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
        self.open, self.filled = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Documents come in ascending order of their ids, those without one first."""
        if self.filled + len(ids) > self.frame_bytes:
            self.flush()
        for at in range(0, len(ids), self.frame_bytes):
            part = ids[at : at + self.frame_bytes]
            self.open.append(part)
            self.filled += len(part)
            if self.filled >= self.frame_bytes:
                self.flush()
        self.ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids) // IDS.itemsize)

    def close(self) -> None:
        self.flush()
        known = [x for x in self.ids if x is not None]
        index = struct.pack("<QQ", len(self.ids), len(self.ids) - len(known)) + np.array(known, "<i8").tobytes() + np.array(self.starts, "<u8").tobytes()
        index = self.zstd.compress(index)
        self.put(struct.pack("<II", INDEX_FRAME, len(index)) + index, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        rows = np.array(self.entries, ENTRY).tobytes()
        end = struct.pack("<IBI", len(self.entries), WITH_CHECKSUMS, SEEKABLE_END)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(rows) + len(end)) + rows + end)
        self.written += 8 + len(rows) + len(end)


class TokenFile:
    """A file of Writer: its index, and the ids of any documents from the frames that hold them."""

    def __init__(self, f: BinaryIO, size: int):
        self.f = f
        count, flags, magic = struct.unpack("<IBI", self.bytes_at(size - 9, 9))
        if magic != SEEKABLE_END or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table_size = count * ENTRY.itemsize
        if struct.unpack("<II", self.bytes_at(size - 17 - table_size, 8)) != (SEEK_TABLE, table_size + 9):
            raise ValueError("the seek table is damaged")
        rows = np.frombuffer(self.bytes_at(size - 9 - table_size, table_size), ENTRY)
        self.frames = rows[:-1]
        self.place = np.concatenate(([0], np.cumsum(rows["packed"].astype(np.int64))))
        self.begin = np.concatenate(([0], np.cumsum(self.frames["size"].astype(np.int64))))
        self.zstd = zstandard.ZstdDecompressor()
        self.read = 0  # frames that were decompressed
        raw = self.bytes_at(int(self.place[-2]), int(rows["packed"][-1]))
        index = self.zstd.decompress(raw[8:])
        n, self.n_null = struct.unpack("<QQ", index[:16])
        self.ids = np.frombuffer(index, "<i8", n - self.n_null, 16)
        self.starts = np.frombuffer(index, "<u8", n + 1, 16 + 8 * (n - self.n_null)).astype(np.int64)

    def bytes_at(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def frame(self, k: int) -> bytes:
        data = self.zstd.decompress(self.bytes_at(int(self.place[k]), int(self.frames["packed"][k])))
        if len(data) != self.frames["size"][k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames["check"][k]:
            raise ValueError(f"frame {k} does not have its checksum")
        self.read += 1
        return data

    def doc_id(self, row: int) -> int | None:
        return None if row < self.n_null else int(self.ids[row - self.n_null])

    def rows_of(self, doc_id: int) -> range:
        """Rows of the documents with this id."""
        a, b = np.searchsorted(self.ids, doc_id, "left"), np.searchsorted(self.ids, doc_id, "right")
        return range(int(a) + self.n_null, int(b) + self.n_null)

    def documents(self, rows: range | None = None) -> Iterator[tuple[int, bytes]]:
        """(row, ids) of a range of rows, or all of them; holds a frame at a time, or a document that is longer."""
        last, data = -1, b""
        for row in range(len(self.starts) - 1) if rows is None else rows:
            a, b = IDS.itemsize * int(self.starts[row]), IDS.itemsize * int(self.starts[row + 1])
            out, k = [], int(np.searchsorted(self.begin, a, "right")) - 1
            while a < b:
                if k != last:
                    last, data = k, self.frame(k)
                at = a - int(self.begin[k])
                out.append(data[at : at + b - a])
                a += len(out[-1])
                k += 1
            yield row, b"".join(out)


def opened(path: str) -> TokenFile:
    system, inner = pyarrow.fs.FileSystem.from_uri(path)
    f = system.open_input_file(inner)
    return TokenFile(f, f.size())


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, frame_bytes: int = FRAME_BYTES, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents below ``path``, in ascending order of doc_id; returns the table of files.

    Text is encoded whole, null as empty, and ``end_id`` follows each document. Documents are dealt to files by ranges of
    their id, rows that share one by a hash of their ids, so that neither many rows of one id nor long texts gather in one
    task; null ids come first. A task writes files under new names, and only those of tasks that ended well are in the table,
    so lost executors and repeated tasks leave no row twice. An empty table gives no files; other columns are ignored.
    A task's memory follows its longest text.
    """
    vocabulary = vocabulary or vocabulary_path()
    kind = WordEncoder(open(vocabulary, encoding="utf-8").read()).kind
    rows = saved(encoded(docs, vocabulary, end_id).withColumn("tie", F.xxhash64("ids")))
    total = (rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // kind.itemsize
    n_files = max(1, min(MAX_FILES, -(-total // file_ids)), min(shuffle_partitions(docs.sparkSession), total // SMALL_FILE))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = pyarrow.fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        writer, name, tie = None, f"{uuid.uuid4().hex}.zst", None
        for batch in batches:
            for doc_id, ids, own in zip(batch["doc_id"].to_pylist(), batch["ids"], batch["tie"]):
                if writer is None:
                    out, tie = system.open_output_stream(f"{folder}/{name}", compression=None), own.as_py()  # else pyarrow would pack it once more
                    writer = Writer(out, frame_bytes)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), kind).astype(IDS).tobytes())
        if writer:
            writer.close()
            out.close()
            values = [f"{path}/{name}", writer.ids[0], writer.ids[-1], tie, len(writer.ids), writer.starts[-1], len(writer.entries) - 1, writer.written]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string() if k == 0 else pa.int64()) for k, v in enumerate(values)], [x.split()[0] for x in FILES.split(", ")])

    dealt = rows.repartitionByRange(n_files, F.asc_nulls_first("doc_id"), "tie").sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie")
    return saved(dealt.mapInArrow(write, FILES))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids): every document of the files with the number of ids before it, one file a task at least."""
    order = Window.orderBy(F.asc_nulls_first("first_id"), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))  # a row a file, MAX_FILES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                f = opened(path)
                part, size = [], 0
                for row, ids in f.documents():
                    part.append((f.doc_id(row), base + int(f.starts[row]), ids))
                    size += len(ids)
                    if size > 4 * FRAME_BYTES:
                        yield as_batch(part)
                        part, size = [], 0
                yield as_batch(part)

    return placed.repartition(max(1, files.count())).mapInArrow(run, "doc_id long, start long, ids binary")


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "ids"])


def look_up(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of the documents with the ids of ``wanted`` (doc_id), start within their file; only their frames are decompressed."""
    ends = files.where("last_id IS NOT NULL").orderBy("first_id", "first_tie").select("path", F.coalesce("first_id", F.lit(-(1 << 63))), "last_id").collect()  # MAX_FILES rows at most
    paths, first, last = [r[0] for r in ends], np.array([r[1] for r in ends], np.int64), np.array([r[2] for r in ends], np.int64)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            a, b = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else n
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.repeat(ids, n))], ["file", "doc_id"])

    def read(key: tuple, t: pa.Table) -> pa.Table:
        f = opened(paths[key[0].as_py()])
        rows = [r for i in sorted(t["doc_id"].to_pylist()) for r in f.rows_of(i)]
        return pa.Table.from_batches([as_batch([(f.doc_id(r), int(f.starts[r]), ids) for r, ids in f.documents(rows)])])

    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().mapInArrow(places, "file int, doc_id long")
    return asked.groupBy("file").applyInArrow(read, "doc_id long, start long, ids binary")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark))
    n_tokens = (F.octet_length("ids") / IDS.itemsize).cast("long").alias("n_tokens")
    return read_tokens(files).select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
