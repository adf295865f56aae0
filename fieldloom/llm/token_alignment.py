"""Alignment of two tokenizers: fragments of byte ranges that compose, and how often two ids are linked in the corpus.

A fragment of a byte range has the tokens that end in it: those up to the first place where tokens of both sides end
(its open prefix), closed groups between such places, and what is behind the last of them (its open suffix). Two
neighbours compose: the first one's suffix and the second one's prefix become one closed group. This is associative, so
fragments of a long document are made in many tasks and composed as a tree. Documents up to LONG_BYTES are cut before
spaces, where both sides' tokens end: each distinct cut is a fragment without open ends, made once and remembered.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sentencepieces import spread
from .shared import saved, table
from .text import as_bytes, coded, pieces, range_sums

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Texts over so many bytes are cut into ranges of CHUNK_BYTES, whose fragments compose FAN_IN at a time.
LONG_BYTES, CHUNK_BYTES, FAN_IN = 1 << 20, 1 << 18, 8
#: Bytes of the texts of a block.
BLOCK_BYTES = 1_000_000
#: Distinct cuts that a worker remembers before it starts afresh, some 70 MB; a task leaves none behind.
MEMORY = 150_000
#: Id pairs that are broadcast with their counts, at most (34 MB): all of them, or those with at least 1 / MAX_PAIRS of all links, of which no more exist.
MAX_PAIRS = 2_000_000

# Before these spaces a text may be cut: what stands before is no white space, of Unicode either.
CUT = re.compile(rb"(?<=[!-~\x80-\xff])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)(?= )")
# Texts with none of these are cut before each space.
UNEVEN = re.compile(rb"^ | $|[\x00-\x20] |\xc2[\x85\xa0] |\xe1\x9a\x80 |\xe2\x80[\x80-\x8a\xa8\xa9\xaf] |\xe2\x81\x9f |\xe3\x80\x80 ")

MARK = b"\xff"  # no byte of UTF-8
ZSTD = zstandard.ZstdCompressor(level=1)

STATS = ("n_a", "n_b", "n_groups", "n_links")
DOC = f"doc_id long, {', '.join(f'{s} long' for s in STATS)}, groups_sha256 string, groups string"
BLOCKS = f"block string, docs array<struct<{DOC.replace(' long', ': long').replace(' string', ': string')}>>, body binary, codes binary, totals binary"
CHUNKS = "row string, doc_id long, no int, at long, low long, high long, text binary"
FRAGMENTS = f"row string, doc_id long, no int, valid boolean, cut boolean, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary, {', '.join(f'{s} long' for s in STATS)}, groups binary, codes binary, times binary"


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable ones for themselves, all others from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class Side:
    """The bytes of one tokenizer's tokens, and their texts with what may follow them in a list of groups."""

    def __init__(self, tokens: list[bytes]):
        self.n = len(tokens)
        self.size = np.array([len(t) for t in tokens])
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.bytes[spread(self.start[ids], self.size[ids])].tobytes()


@dataclass
class Fragment:
    """Tokens that end in a byte range. Without a place where both sides' tokens end (``cut``), all of them are its prefix."""

    cut: bool
    prefix: tuple[np.ndarray, np.ndarray]
    suffix: tuple[np.ndarray, np.ndarray]
    groups: bytes = b""  # of the closed ones, each with a semicolon behind it
    n_groups: int = 0
    n_links: int = 0
    n_a: int = 0  # of all tokens
    n_b: int = 0
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


#: What lies before a document: one that is composed with it closes its first group.
NOTHING = Fragment(True, *[(np.zeros(0, np.int64),) * 2] * 2)


class Aligner:
    """Both tokenizers, and the fragments of the cuts that it has seen."""

    def __init__(self, byte_model: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        self.a = Tokenizer.from_str(byte_model)
        self.a.encode_special_tokens = True  # their strings in a text are then plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        names = [""] * (max(entries.values()) + 1)
        for name, i in entries.items():
            names[i] = name
        self.sides = Side([bytes(letters.get(c, 63) for c in name) for name in names]), Side([self.piece_bytes(i) for i in range(self.b.get_piece_size())])
        n_a, n_b = (s.n for s in self.sides)
        self.n_b = n_b
        self.space = self.b.piece_to_id("▁")
        # texts of tokens within a group, at the end of its first side, within its second, and at the end of it
        self.texts = np.array([f"{i}{mark}".encode() for n, marks in ((n_a, ",|"), (n_b, ",;")) for mark in marks for i in range(n)], object)
        self.text_at = (0, n_a), (2 * n_a, 2 * n_a + n_b)
        self.forget()

    def piece_bytes(self, i: int) -> bytes:
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.stats, self.valid = np.zeros((0, len(STATS)), np.int64), np.zeros(0, bool)
        self.ptr, self.codes = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def encode(self, cuts: list[bytes]) -> list[tuple[list, np.ndarray, np.ndarray]]:
        """For each side: ids of all cuts, which begin with a space, one after the other, how many each has, and whether they give its bytes."""
        texts = [c.decode() for c in cuts]
        ids = [[e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)]
        ids[1] = [x if len(c) > 1 else [self.space] for x, c in zip(ids[1], cuts)]
        out = []
        for side, found in zip(self.sides, ids):
            counts = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int64, counts.sum())
            ends = np.concatenate(([0], np.cumsum(side.size[flat])))[np.concatenate(([0], np.cumsum(counts)))]
            data = side.joined(flat)
            out.append((flat, counts, np.fromiter((data[i:j] == c for i, j, c in zip(ends, ends[1:], cuts)), bool, len(cuts))))
        return out

    def closed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of tokens of both sides for the same bytes: each token's group, the texts of all tokens in the groups' order, and the links.

        A link is the place of its first token and the code of its pair of ids.
        """
        ends = [np.cumsum(s.size[x]) for s, x in zip(self.sides, (a, b))]
        common = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(common, e) for e in ends]
        text = [np.where(np.append(g[1:] != g[:-1], True), at[1], at[0]) + x for g, at, x in zip(group, self.text_at, (a, b))]
        order = np.argsort(np.concatenate((2 * group[0], 2 * group[1] + 1)), kind="stable")
        starts = [e - s.size[x] for e, s, x in zip(ends, self.sides, (a, b))]
        first, last = np.searchsorted(ends[1], starts[0], "right"), np.searchsorted(starts[1], ends[0], "left")
        n = last - first
        return *group, self.texts[np.concatenate(text)[order]].tolist(), np.repeat(np.arange(len(a)), n), np.repeat(a, n) * self.n_b + b[spread(first, n)]

    def learn(self, cuts: list[bytes]) -> None:
        """Remember new cuts, given without the space that they begin with."""
        (a, n_a, good_a), (b, n_b, good_b) = self.encode([b" " + c for c in cuts])
        good = good_a & good_b
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        group_a, _, texts, link_of, codes = self.closed(a, b)
        end_a, end_ab = np.cumsum(n_a), np.cumsum(n_a + n_b)
        owner = np.repeat(np.arange(len(cuts)), n_a)
        n_links = np.bincount(owner[link_of], minlength=len(cuts))
        groups_before = np.zeros(len(cuts), np.int64)
        groups_before[n_a > 0] = group_a[end_a[n_a > 0] - 1] + 1
        n_groups = np.diff(np.maximum.accumulate(groups_before), prepend=0)
        base = len(self.groups)
        self.known.update(zip(cuts, range(base, base + len(cuts))))
        self.groups += [b"".join(texts[i:j]) for i, j in zip(end_ab - n_a - n_b, end_ab)]
        self.stats = np.concatenate((self.stats, np.stack((n_a, n_b, n_groups, n_links), axis=1)))
        self.valid = np.concatenate((self.valid, good))
        self.ptr = np.concatenate((self.ptr, self.ptr[-1] + np.cumsum(n_links)))
        self.codes = np.concatenate((self.codes, codes))

    def places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The remembered cuts of all texts, one after the other, and how many each has."""
        if len(self.groups) > MEMORY:
            self.forget()
        parted = [t.replace(b" ", MARK) if not UNEVEN.search(t) else MARK.join([c[1:] for c in CUT.split(b" " + t)]) for t in texts]
        codes, counts, distinct = coded(pc.split_pattern(pa.array(parted, pa.binary()), pattern=MARK))
        if new := [c for c in distinct if c not in self.known]:
            self.learn(new)
        some = np.fromiter(map(bool, texts), bool, len(texts))
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return at[codes[np.repeat(some, counts)]], counts * some

    def fragment(self, text: bytes, at: int, low: int, high: int) -> tuple[Fragment, bool]:
        """Of the tokens of a text that begins with a space at byte ``at`` of its document: those that end in low + 1 .. high; and whether it is valid."""
        (a, _, good_a), (b, _, good_b) = self.encode([text])
        if not (good_a[0] and good_b[0]):
            return NOTHING, False
        ends = [at + np.cumsum(s.size[x]) for s, x in zip(self.sides, (a, b))]
        inside = [(e > low) & (e <= high) for e in ends]
        ids, ends = [x[i] for x, i in zip((a, b), inside)], [e[i] for e, i in zip(ends, inside)]
        common = np.intersect1d(*ends, assume_unique=True)
        none, n = (ids[0][:0], ids[1][:0]), {"n_a": len(ids[0]), "n_b": len(ids[1])}
        if not len(common):
            return Fragment(False, tuple(ids), none, **n), True
        first, last = ([np.searchsorted(e, c, "right") for e in ends] for c in (common[0], common[-1]))
        out = Fragment(True, tuple(x[:i] for x, i in zip(ids, first)), tuple(x[j:] for x, j in zip(ids, last)), **n)
        return self.with_groups(out, *[x[i:j] for x, i, j in zip(ids, first, last)]), True

    def with_groups(self, f: Fragment, a: np.ndarray, b: np.ndarray) -> Fragment:
        """The fragment with the groups of these tokens behind its closed ones."""
        group, _, texts, _, codes = self.closed(a, b)
        f.groups += b"".join(texts)
        f.n_groups += int(group[-1]) + 1 if len(group) else 0
        f.n_links += len(codes)
        f.codes, f.times = summed(np.concatenate((f.codes, codes)), np.concatenate((f.times, np.ones(len(codes), np.int64))))
        return f

    def compose(self, f: Fragment, g: Fragment) -> Fragment:
        """The fragment of two neighbouring byte ranges."""
        joined = lambda x, y: (np.concatenate((x[0], y[0])), np.concatenate((x[1], y[1])))
        n = {"n_a": f.n_a + g.n_a, "n_b": f.n_b + g.n_b}
        if not f.cut:
            return replace(g, prefix=joined(f.prefix, g.prefix), **n)
        if not g.cut:
            return replace(f, suffix=joined(f.suffix, g.prefix), **n)
        f = self.with_groups(replace(f), *joined(f.suffix, g.prefix))
        codes, times = summed(np.concatenate((f.codes, g.codes)), np.concatenate((f.times, g.times)))
        return replace(f, suffix=g.suffix, groups=f.groups + g.groups, n_groups=f.n_groups + g.n_groups, n_links=f.n_links + g.n_links, codes=codes, times=times, **n)


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, in order, with the sum of its times."""
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[first], np.add.reduceat(times, first) if len(first) else times


_aligners: dict[tuple, Aligner] = {}


def aligner(models: tuple[str, bytes]) -> Aligner:
    """The tokenizers, made once in each Python worker."""
    key = tuple(map(hash, models))
    if key not in _aligners:
        _aligners[key] = Aligner(*models)
    return _aligners[key]


def block_of(docs: list[tuple], cuts: np.ndarray, n_cuts: np.ndarray, n_pairs: np.ndarray, pair_codes: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """A block: its documents, their cuts by number, each cut's id pairs and how often it has them, and the pairs of the block with their sums."""
    codes, pairs = np.unique(pair_codes, return_inverse=True)
    totals = np.bincount(pairs, weights=(times * np.repeat(np.bincount(cuts, minlength=len(n_pairs)), n_pairs)), minlength=len(codes)).astype(np.int64)
    body = [x.astype("<u4") for x in (cuts, n_cuts, n_pairs, pairs, times)]
    body = np.concatenate((np.array([len(x) for x in body], "<u4"), *body)).tobytes()
    packed = [ZSTD.compress(x) for x in (body, np.diff(codes, prepend=0).astype("<i8").tobytes(), totals.astype("<i8").tobytes())]
    kinds = [x.split() for x in DOC.split(", ")]
    struct = pa.struct([(n, pa.int64() if k == "long" else pa.string()) for n, k in kinds])
    rows = pa.array([dict(zip([n for n, _ in kinds], d)) for d in docs], struct)
    values = [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays([0, len(docs)], rows), *[pa.array([x], pa.binary()) for x in packed]]
    return pa.RecordBatch.from_arrays(values, ["block", "docs", "body", "codes", "totals"])


def digest(groups: bytes) -> str:
    return hashlib.sha256(groups[:-1]).hexdigest() if groups else ""


def short_blocks(batches: Iterator[pa.RecordBatch], models: tuple[str, bytes], keep: bool) -> Iterator[pa.RecordBatch]:
    m = aligner(models)
    for batch in batches:
        texts, ids = as_bytes(batch["text"]), batch["doc_id"].to_pylist()
        for i, j in pieces(texts, BLOCK_BYTES):
            at, n_cuts = m.places(texts[i:j])
            valid = range_sums(~m.valid[at], n_cuts) == 0
            at, n_cuts = at[np.repeat(valid, n_cuts)], n_cuts * valid
            stats = np.stack([range_sums(m.stats[at, k], n_cuts) for k in range(len(STATS))], axis=1).tolist()
            own, end, docs = list(map(m.groups.__getitem__, at.tolist())), 0, []
            for doc_id, n, s in zip(ids[i:j], n_cuts, stats):
                groups = b"".join(own[end : end + n])
                end += n
                docs.append((doc_id, *s, digest(groups), groups[:-1].decode() if keep else None))
            distinct, cuts = np.unique(at, return_inverse=True)
            n_pairs = np.diff(m.ptr)[distinct]
            codes = m.codes[spread(m.ptr[distinct], n_pairs)]
            yield block_of(docs, cuts, n_cuts, n_pairs, codes, np.ones(len(codes), np.int64))
    m.forget()


def ranges(text: bytes) -> list[tuple[int, int, int, int]]:
    """(at, to, low, high) of the byte ranges of a text that begins with a space: the range low .. high, and the cuts at .. to around it.

    Ranges have CHUNK_BYTES and end anywhere, in words too; a word that is longer is not parted.
    """
    safe = np.array([0, *[m.start() for m in CUT.finditer(text)], len(text)])
    low = np.arange(CHUNK_BYTES, len(text), CHUNK_BYTES)
    k = np.searchsorted(safe, low, "left")
    low = np.unique(low[safe[k] - safe[k - 1] <= CHUNK_BYTES])
    edges = [0, *low.tolist(), len(text)]
    before, behind = np.searchsorted(safe, edges, "right") - 1, np.searchsorted(safe, edges, "left")
    return [(int(safe[before[i]]), int(safe[behind[i + 1]]), edges[i], edges[i + 1]) for i in range(len(edges) - 1)]


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), as_bytes(batch["text"])):
            row, text = uuid.uuid4().hex, b" " + text
            for no, (at, to, low, high) in enumerate(ranges(text)):
                yield record([(row, doc_id, no, at, low, high, text[at:to])], CHUNKS)


def record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def fragment_row(row: str, doc_id: int | None, no: int, valid: bool, f: Fragment) -> tuple:
    ends = [x.astype("<i8").tobytes() for x in (*f.prefix, *f.suffix)]
    return row, doc_id, no, valid, f.cut, *ends, f.n_a, f.n_b, f.n_groups, f.n_links, f.groups, f.codes.astype("<i8").tobytes(), f.times.astype("<i8").tobytes()


def fragment_of(r: dict) -> Fragment:
    at = lambda k: np.frombuffer(r[k], "<i8")
    return Fragment(r["cut"], (at("prefix_a"), at("prefix_b")), (at("suffix_a"), at("suffix_b")), r["groups"], r["n_groups"], r["n_links"], r["n_a"], r["n_b"], at("codes"), at("times"))


def fragments_of(batches: Iterator[pa.RecordBatch], models: tuple[str, bytes]) -> Iterator[pa.RecordBatch]:
    m = aligner(models)
    for batch in batches:
        for r in batch.to_pylist():
            f, valid = m.fragment(r["text"], r["at"], r["low"], r["high"])
            yield record([fragment_row(r["row"], r["doc_id"], r["no"], valid, f)], FRAGMENTS)


def composed(t: pa.Table, models: tuple[str, bytes]) -> pa.Table:
    """The fragment of neighbouring ones of a document; not valid if one of them is not."""
    rows = sorted(t.to_pylist(), key=lambda r: r["no"])
    valid, out = all(r["valid"] for r in rows), None
    for f in map(fragment_of, rows if valid else rows[:1]):
        out = f if out is None else aligner(models).compose(out, f)
    return pa.Table.from_batches([record([fragment_row(rows[0]["row"], rows[0]["doc_id"], rows[0]["no"] // FAN_IN, valid, out)], FRAGMENTS)])


def long_blocks(batches: Iterator[pa.RecordBatch], models: tuple[str, bytes], keep: bool) -> Iterator[pa.RecordBatch]:
    """A block for each whole document: its prefix begins with the document, so it is its first group."""
    m = aligner(models)
    for batch in batches:
        for r in batch.to_pylist():
            f = NOTHING
            if r["valid"]:
                f = m.compose(NOTHING, fragment_of(r))
            doc = (r["doc_id"], f.n_a, f.n_b, f.n_groups, f.n_links, digest(f.groups), f.groups[:-1].decode() if keep else None)
            yield block_of([doc], np.zeros(1, np.int64), np.ones(1, np.int64), np.array([len(f.codes)]), f.codes, f.times)


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of the blocks of a task, added up whenever MAX_PAIRS have gathered."""
    codes, times, size = [], [], 0

    def flush() -> pa.RecordBatch:
        c, n = summed(np.concatenate(codes), np.concatenate(times))
        return pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], ["code", "n"])

    for batch in batches:
        for c, n in zip(batch["codes"], batch["totals"]):
            codes.append(np.cumsum(unzipped(c, "<i8")))
            times.append(unzipped(n, "<i8"))
            size += len(codes[-1])
            if size > MAX_PAIRS:
                yield flush()
                codes, times, size = [], [], 0
    if codes:
        yield flush()


class Known:
    """Counts of the broadcast pairs, and whether each is its second id's highest."""

    def __init__(self, t: pa.Table):
        order = np.argsort(t["code"].to_numpy())
        self.codes, self.n, self.best = (t[c].to_numpy()[order] for c in ("code", "n", "best"))

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, n, best) of each code."""
        if not len(self.codes):
            return (np.zeros(len(codes), bool), *[np.zeros(len(codes), np.int64)] * 2)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        return hit, self.n[at] * hit, self.best[at] * hit


def unzipped(x: pa.BinaryScalar, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_buffer()), kind)


def unpacked_block(batch: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    body = unzipped(batch["body"][i], "<u4").astype(np.int64)
    names = "cuts", "n_cuts", "n_pairs", "pairs", "times"
    parts = np.split(body[len(names) :], np.cumsum(body[: len(names) - 1]))
    return dict(zip(names, parts)) | {"codes": np.cumsum(unzipped(batch["codes"][i], "<i8"))}


def with_sums(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    """Every document with n_best and count_sum over its links of known pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            x = unpacked_block(batch, i)
            _, n, best = known.of(x["codes"])
            n_best, count_sum = (range_sums(range_sums(x["times"] * v[x["pairs"]], x["n_pairs"])[x["cuts"]], x["n_cuts"]) for v in (best.astype(np.int64), n))
            docs = batch["docs"][i].values
            head = [pa.array([batch["block"][i].as_py()] * len(docs)), pa.array(np.arange(len(docs), dtype=np.int32))]
            names = [docs.type.field(k).name for k in range(docs.type.num_fields)]
            yield pa.RecordBatch.from_arrays([*head, *docs.flatten(), pa.array(n_best), pa.array(count_sum)], ["block", "at", *names, "n_best", "count_sum"])


def other_links(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    """(block, at, code, times): every document's links of pairs that are not known."""
    for batch in batches:
        for i in range(batch.num_rows):
            x = unpacked_block(batch, i)
            new = ~known.of(x["codes"])[0]
            if not new.any():
                continue
            first = np.cumsum(x["n_pairs"]) - x["n_pairs"]
            doc = np.repeat(np.arange(len(x["n_cuts"])), x["n_cuts"])
            entry = spread(first[x["cuts"]], x["n_pairs"][x["cuts"]])
            doc = np.repeat(doc, x["n_pairs"][x["cuts"]])
            entry, doc = entry[mine := new[x["pairs"][entry]]], doc[mine]
            key, times = summed(doc * len(new) + x["pairs"][entry], x["times"][entry])
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch["block"][i].as_py()] * len(key)), pa.array((key // len(new)).astype(np.int32)), pa.array(x["codes"][key % len(new)]), pa.array(times)], ["block", "at", "code", "times"]
            )


def token_alignment(docs: DataFrame, byte_vocabulary: str | None = None, piece_vocabulary: str | None = None, keep_groups: bool = False, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups if ``keep_groups``.

    Each text, with a space before it, is encoded by both tokenizers without special tokens. Places where tokens of both
    sides end part it into groups; a link is a pair of tokens with a byte in common. A pair of ids counts as many
    links as the corpus has of it; n_best are the links whose count is the highest of their second id, and
    count_sum adds up the counts of all links. ``groups`` are the ids, `a1,a2|b1;a3|b2,b3`.

    One row for each row of ``docs``, repeated ids too. Null and empty texts, and those whose tokens' bytes on either
    side are not the text's, have no tokens: zeros, and an empty digest. Other columns are ignored.
    Pairs are counted in tasks before they are shuffled. If there are more than ``max_pairs``, only those with at least
    1 / ``max_pairs`` of all links are broadcast, and links of all others are looked up by a join. A task's memory follows the longest text;
    of texts over LONG_BYTES, what tokenizers and groups take follows a range.
    """
    import public_tokenizers
    import sentencepiece

    with open(byte_vocabulary or public_tokenizers.path(BYTE_VOCABULARY), encoding="utf-8") as f, open(piece_vocabulary or public_tokenizers.path(PIECE_VOCABULARY), "rb") as g:
        models = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    n_b = sentencepiece.SentencePieceProcessor(model_proto=models.value[1]).get_piece_size()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.octet_length("text") > LONG_BYTES, F.lit(False))
    short = rows.where(~is_long).mapInArrow(lambda b: short_blocks(b, models.value, keep_groups), BLOCKS)
    chunks = saved(rows.where(is_long).mapInArrow(chunks_of, CHUNKS))
    n_chunks, last = chunks.agg(F.count("*"), F.max("no")).first()
    blocks = short
    if n_chunks:
        parts = saved(chunks.repartition(n_chunks).mapInArrow(lambda b: fragments_of(b, models.value), FRAGMENTS))
        while last:
            parts = saved(parts.groupBy("row", F.floor(F.col("no") / FAN_IN)).applyInArrow(lambda t: composed(t, models.value), FRAGMENTS))
            last //= FAN_IN
        blocks = short.unionByName(parts.mapInArrow(lambda b: long_blocks(b, models.value, keep_groups), BLOCKS))
    blocks = saved(blocks)

    pairs = saved(blocks.select("codes", "totals").mapInArrow(pair_sums, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).withColumn("b", F.col("code") % n_b))
    highest = pairs.groupBy("b").agg(F.max("n").alias("highest"))  # one row an id of the vocabulary
    pairs = saved(pairs.join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("highest")).alias("best")))
    n_pairs, links = pairs.agg(F.count("*"), F.sum("n")).first()
    many = F.col("n") >= (-(-links // max_pairs) if n_pairs > max_pairs else 0)
    known = Known(pairs.where(many).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(known)
    out = blocks.mapInArrow(lambda b: with_sums(b, shared.value), f"block string, at int, {DOC}, n_best long, count_sum long")
    if len(known.codes) < n_pairs:
        others = blocks.mapInArrow(lambda b: other_links(b, shared.value), "block string, at int, code long, times long")
        met = others.join(pairs.where(~many).hint("merge"), "code").groupBy("block", "at").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
        out = out.join(met.hint("merge"), ["block", "at"], "left").withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))})
    return out.select("doc_id", *STATS, "n_best", "count_sum", "groups_sha256", *["groups"] * keep_groups)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))
