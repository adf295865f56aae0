"""SentencePiece encoding and decoding by suffix-array matching and relaxation of the matched pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table
from .text import as_bytes, mix, pieces, powers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
#: Texts are taken in pieces of about this many bytes; a longer text is alone.
PIECE_BYTES = 300_000
START, NOWHERE = -1, -2
#: Distinct cuts that a worker remembers before it starts afresh, some 10 MB.
MEMORY = 200_000


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. (count[0] values), first[1], .."""
    total = int(count.sum())
    skip = np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else count
    return np.repeat(first - skip, count) + np.arange(total)


def windows(buf: np.ndarray, at: int) -> np.ndarray:
    """The eight bytes from each position + ``at`` on as one number, zeros behind the end."""
    padded = np.concatenate((buf, np.zeros(at + 8, np.uint8)))
    view = np.lib.stride_tricks.sliding_window_view(padded[at:], 8)[: len(buf)]
    return np.ascontiguousarray(view).view(">u8").astype(np.uint64).ravel()


def bisect(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """For each range lo .. hi of ``keys``, sorted within it, where ``value`` belongs."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        k = keys[np.minimum(mid, len(keys) - 1)]
        up = open_ & ((k <= value) if right else (k < value))
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    return lo


class Pieces:
    """A byte-fallback BPE model and what is needed to match its pieces against a text.

    A tokenisation is the one that merging by rank gives exactly if each token, and each two
    neighbours taken together, come out of merging as they are. So one relaxation from left to
    right finds it: a piece may extend a path if it stands together with the path's last token.
    Whether two tokens do is worked out once and remembered.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {self.names[i]: -sp.get_score(i) for i in plain}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        if any("▁" in x.lstrip("▁") for x in self.rank):
            raise ValueError("pieces go on after a space: texts cannot be cut at spaces")
        out = [b"" if sp.is_control(i) or sp.is_unknown(i) else bytes([int(x[3:5], 16)]) if sp.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(self.names)]
        self.out_len = np.array([len(x) for x in out])
        self.out_start = np.concatenate(([0], np.cumsum(self.out_len)[:-1]))
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        raw = [self.names[i].encode() for i in plain]
        self.id, self.len = np.array(plain, np.int32), np.array([len(x) for x in raw], np.int32)
        self.one_char = np.array([len(self.names[i]) == 1 for i in plain])
        pad = lambda x, a, fill: int.from_bytes(x[a : a + 8].ljust(8, fill), "big")
        self.lo = [np.array([pad(x, a, b"\0") for x in raw], np.uint64) for a in (0, 8)]
        self.hi = [np.array([pad(x, a, b"\xff") for x in raw], np.uint64) for a in (0, 8)]
        self.raw = raw
        self.extra: dict[bytes, int] = {}  # characters without a piece, numbered behind the pieces
        self.known = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)
        self.fresh: dict[int, bool] = {}
        self.nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.seen, self.seen_first, self.seen_count, self.seen_tokens = self.nothing

    def merge(self, text: str) -> list[str]:
        """Tokens of a short text by merging neighbours, the best rank first and the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == np.inf:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stands(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token comes out of merging as it is behind the token before it."""
        key = (before.astype(np.int64) + 2) << 32 | token
        at = np.minimum(np.searchsorted(self.known, key), max(0, len(self.known) - 1))
        hit = self.known[at] == key if len(self.known) else np.zeros(len(key), bool)
        good = self.good[at] & hit if len(self.known) else hit.copy()
        rest = np.flatnonzero(~hit)
        if len(rest):
            distinct, back = np.unique(key[rest], return_inverse=True)
            verdicts = np.fromiter((self._verdict(int(k)) for k in distinct), bool, len(distinct))
            good[rest] = verdicts[back]
        return good

    def _verdict(self, key: int) -> bool:
        if key not in self.fresh:
            parts = [self.names[x] for x in ((key >> 32) - 2, key & 0xFFFFFFFF) if x >= 0]
            self.fresh[key] = self.merge("".join(parts)) == parts
        return self.fresh[key]

    def remember(self) -> None:
        if self.fresh:
            key = np.concatenate((self.known, np.fromiter(self.fresh, np.int64, len(self.fresh))))
            good = np.concatenate((self.good, np.fromiter(self.fresh.values(), bool, len(self.fresh))))
            order = np.argsort(key) if len(key) <= 5 * MEMORY else []
            self.known, self.good, self.fresh = key[order], good[order], {}

    def edges(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, token) of every occurrence of a piece, and of the characters without one."""
        first, second = windows(buf, 0), windows(buf, 8)
        suffixes = np.lexsort((second, first)).astype(np.int32)
        first, second = first[suffixes], second[suffixes]
        a, b = np.searchsorted(first, self.lo[0], "left"), np.searchsorted(first, self.hi[0], "right")
        long_ = self.len > 8
        a[long_], b[long_] = (bisect(second, a[long_], b[long_], x[long_], right) for x, right in ((self.lo[1], False), (self.hi[1], True)))
        count = np.maximum(b - a, 0)
        which = np.repeat(np.arange(len(count), dtype=np.int32), count)
        start = suffixes[spread(a, count)]
        for k in np.flatnonzero((self.len > 16) & (count > 0)):  # the suffixes are sorted by 16 bytes
            mine = np.flatnonzero(which == k)
            same = [buf[start[i] : start[i] + self.len[k]].tobytes() == self.raw[k] for i in mine]
            which[mine[~np.array(same)]] = -1
        start, which = start[which >= 0], which[which >= 0]
        bare = (buf & 0xC0) != 0x80
        bare[start[self.one_char[which]]] = False
        lone = np.flatnonzero(bare).astype(np.int32)
        width = np.where(buf[lone] < 0x80, 1, np.where(buf[lone] < 0xE0, 2, np.where(buf[lone] < 0xF0, 3, 4))).astype(np.int32)
        token = np.zeros(len(lone), np.int32)
        for i, (s, w) in enumerate(zip(lone, width)):
            char = buf[s : s + w].tobytes()
            if char not in self.extra:
                self.extra[char] = len(self.names)
                self.names.append(char.decode("utf-8", "replace"))
            token[i] = self.extra[char]
        return np.concatenate((start, lone)), np.concatenate((start + self.len[which], lone + width)), np.concatenate((self.id[which], token))

    def encode_distinct(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all chunks one after the other, and how many each has."""
        sizes = np.array([len(c) for c in chunks])
        buf = np.frombuffer(b"".join(chunks), np.uint8)
        begin = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        start, end, token = self.edges(buf)
        chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), sizes)[start]
        inside = end <= begin[chunk + 1]
        start, end, token, chunk = start[inside], end[inside], token[inside], chunk[inside]
        # positions are counted once more for each chunk, so that an end is not the next one's start
        start, reach = start + chunk, end + chunk
        depth = end - begin[chunk]
        order = np.argsort(depth.astype(np.uint16) if sizes.max() < 65536 else depth, kind="stable")
        start, reach, token, depth = start[order], reach[order], token[order], depth[order]
        last = np.full(len(buf) + len(chunks), NOWHERE, np.int64)
        back = np.zeros(len(last), np.int64)
        home = begin[:-1] + np.arange(len(chunks))
        last[home] = START
        cuts = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
        for i, j in zip(cuts, cuts[1:]):
            before = last[start[i:j]]
            open_ = np.flatnonzero(before != NOWHERE)
            good = i + open_[self.stands(before[open_], token[i:j][open_])]
            last[reach[good]], back[reach[good]] = token[good], start[good]
        self.remember()
        steps, found = np.zeros(len(chunks), np.int64), []
        at, live = home + sizes, np.arange(len(chunks))
        if (last[at] == NOWHERE).any():
            raise ValueError("a text has no tokenisation")
        while len(live := live[at[live] != home[live]]):
            found.append((live, last[at[live]]))
            steps[live] += 1
            at[live] = back[at[live]]
        offset = np.concatenate(([0], np.cumsum(steps)))
        out = np.zeros(offset[-1], np.int64)
        for k, (live, token) in enumerate(found):
            out[offset[live + 1] - 1 - k] = token
        return self.bytes_for_extra(out, steps)

    def bytes_for_extra(self, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte tokens in place of the characters without a piece."""
        odd = np.flatnonzero(tokens >= len(self.out_len))
        if not len(odd):
            return tokens, counts
        spelt = [self.byte_ids[list(self.names[t].encode())] for t in tokens[odd]]
        more = np.array([len(x) for x in spelt])
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = counts + np.bincount(owner[odd], weights=more - 1, minlength=len(counts)).astype(np.int64)
        wide = np.ones(len(tokens), np.int64)
        wide[odd] = more
        out = np.repeat(tokens, wide)
        out[spread((np.cumsum(wide) - wide)[odd], more)] = np.concatenate(spelt)
        return out, counts

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts one after the other, and how many each has.

        Pieces hold spaces only at their beginning, so a text may be cut before each run of
        spaces; each distinct cut is encoded once.
        """
        texts = [SPACE + t.replace(b" ", SPACE) if t else b"" for t in texts]
        buf = np.frombuffer(b"".join(texts), np.uint8)
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        is_space = np.zeros(len(buf) + 3, bool)
        is_space[: len(buf) - 2] = (buf[:-2] == SPACE[0]) & (buf[1:-1] == SPACE[1]) & (buf[2:] == SPACE[2])
        follows = np.concatenate((np.zeros(3, bool), is_space))[: len(buf)]
        cut = is_space[: len(buf)] & ~follows
        size = np.array([len(t) for t in texts])
        first = np.concatenate(([0], np.cumsum(size)))
        cut[first[:-1][size > 0]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(buf))
        up, down = powers(len(buf))
        with np.errstate(over="ignore"):
            total = np.concatenate(([np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
            h = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
        distinct, some, which = np.unique(h, return_index=True, return_inverse=True)
        data = buf.tobytes()
        tokens, offset, counts = self.recall(distinct, lambda at: [data[begin[i] : end[i]] for i in some[at]])
        out = tokens[spread(offset[which], counts[which])]
        chunks_before = np.searchsorted(begin, first)
        so_far = np.concatenate(([0], np.cumsum(counts[which])))
        return out, np.diff(so_far[chunks_before])

    def recall(self, keys: np.ndarray, chunks: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the cuts with these hashes, where each one's begin, and how many each has.

        Cuts that earlier texts had are taken from memory, which starts afresh when it is full.
        """
        at = np.minimum(np.searchsorted(self.seen, keys), max(0, len(self.seen) - 1))
        new = self.seen[at] != keys if len(self.seen) else np.ones(len(keys), bool)
        if new.any():
            if len(self.seen) > MEMORY:
                self.seen, self.seen_first, self.seen_count, self.seen_tokens = self.nothing
                new[:] = True
            tokens, counts = self.encode_distinct(chunks(np.flatnonzero(new)))
            first = len(self.seen_tokens) + np.cumsum(counts) - counts
            order = np.argsort(both := np.concatenate((self.seen, keys[new])))
            self.seen, self.seen_tokens = both[order], np.concatenate((self.seen_tokens, tokens.astype(np.int32)))
            self.seen_first = np.concatenate((self.seen_first, first))[order]
            self.seen_count = np.concatenate((self.seen_count, counts))[order]
            at = np.searchsorted(self.seen, keys)
        return self.seen_tokens, self.seen_first[at], self.seen_count[at]

    def decode(self, tokens: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts of the tokens; one leading space, which encoding has put there, goes."""
        n = self.out_len[tokens]
        data = self.out_bytes[spread(self.out_start[tokens], n)].tobytes()
        cut = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(counts)))]
        return [data[a + (data[a : a + 1] == b" ") : b] for a, b in zip(cut, cut[1:])]


_loaded: dict[int, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The model, made once in each Python worker."""
    key = hash(model)
    if key not in _loaded:
        _loaded[key] = Pieces(model)
    return _loaded[key]


def broadcast_model(spark: SparkSession, model_path: str):
    with open(model_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded_batches(batches: Iterator[pa.RecordBatch], model: Pieces) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their tokens, one text after the other, and how many each text has."""
    for batch in batches:
        texts = as_bytes(batch["text"])
        for i, j in pieces(texts, PIECE_BYTES):
            yield batch.slice(i, j - i), *model.encode(texts[i:j])


def as_lists(tokens: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(tokens.astype(np.int32)))


def encode(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, text, tokens): the whole text's piece ids, as merging by rank gives them.

    Null and empty texts have no tokens. Characters without a piece become one token a byte. Texts are
    taken in pieces of PIECE_BYTES, a longer one alone, so a task's memory follows its longest text.
    """
    shared = broadcast_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, counts in encoded_batches(batches, loaded(shared.value)):
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["text"], as_lists(tokens, counts)], ["doc_id", "text", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, tokens array<int>")


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its tokens. A text that holds U+2581 itself comes back with a space there."""
    shared = broadcast_model(encoded.sparkSession, model_path)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                tokens = part["tokens"].fill_null([]) if part["tokens"].null_count else part["tokens"]
                counts = tokens.value_lengths().to_numpy(zero_copy_only=False)
                texts = [t.decode("utf-8", "replace") for t in model.decode(tokens.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trips(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, tokens, round_trip): each text's tokens, and whether decoding them gives the text again.

    As decode(encode(docs)), but the text and its tokens do not go through Spark in between. Null counts as empty.
    """
    shared = broadcast_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(shared.value)
        for part, tokens, counts in encoded_batches(batches, model):
            same = [a == b for a, b in zip(as_bytes(part["text"]), model.decode(tokens, counts))]
            yield pa.RecordBatch.from_arrays([part["doc_id"], as_lists(tokens, counts), pa.array(same, pa.bool_())], ["doc_id", "tokens", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, tokens array<int>, round_trip boolean")


def token_digests(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, tokens_sha256 (of the ids joined by spaces), round_trip (decoding gives the text again).

    One row for each row of ``docs``, repeated ids too; null and empty texts have no tokens. Other columns are ignored.
    """
    ids = F.array_join(F.col("tokens").cast("array<string>"), " ").cast("binary")
    return round_trips(docs, model_path).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("tokens_sha256"), "round_trip")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
