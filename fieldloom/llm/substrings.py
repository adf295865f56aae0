"""Substring dedup: spans of many words that an earlier document has, found by suffix automata of reference passages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bitmap_blocks, bits_for, collect_bitmap, in_bitmap, join_unique, maybe_in, saved, table, without
from .text import Words, as_bytes, as_long, mix, pieces, rolling

WINDOW = 50
#: Words of an anchor. A window's anchor is its run of so many words with the least hash.
ANCHOR = 8
#: Bits of a filter for each document; its size is bounded by shared.MAX_BITS.
BITS_PER_ROW = 256
#: Turns in which windows go by an anchor; in the last turn they go by all of their words.
ANCHOR_TURNS = 2
#: A reference passage of more bytes is not broadcast, however many passages it is matched against.
BROADCAST_BYTES = 20_000
NO_ANCHOR = np.uint64(0xFFFFFFFFFFFFFFFF)


class Automaton:
    """A suffix automaton of a word sequence."""

    def __init__(self, words: list) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, last = [-1], [0], 0
        for word in words:
            last = self._add(word, last)

    def _add(self, word, last: int) -> int:
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            if self.length[p] + 1 != self.length[q]:
                clone = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                self.link[q] = clone
                while p >= 0 and self.next[p].get(word) == q:
                    self.next[p][word] = clone
                    p = self.link[p]
                q = clone
            self.link[cur] = q
        return cur

    def statistics(self, words: list) -> list[int]:
        """Matching statistics: for each word the length of the longest run that ends there and occurs in the automaton."""
        out, state, length = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append(length)
        return out


def least_at(g: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` consecutive values stands, the first of equals, by doubling."""
    at, step = np.arange(len(g)), 1
    while step < width:
        to = min(step, width - step)
        left, right = at[: len(at) - to], at[to:]
        at = np.where(g[left] <= g[right], left, right)
        step += to
    return at


def stretches(key: np.ndarray, at: np.ndarray, text_of: np.ndarray, judged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last): runs of consecutive judged windows of one text with the same anchor at the same place."""
    new = np.ones(len(judged), bool)
    new[1:] = ~judged[:-1] | (at[1:] != at[:-1]) | (key[1:] != key[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(new & judged)
    ends = np.ones(len(judged), bool)
    ends[:-1] = new[1:] | ~judged[1:]
    return first, np.flatnonzero(ends & judged)


def anchored(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, last) of each run of windows with the same anchor in some texts; windows are told by their first word."""
    if len(words.start) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    g = rolling(words.hashes(), anchor)
    at = least_at(g, window - anchor + 1)
    n = len(words.start) - window + 1
    text = words.text_of[:n]
    first, last = stretches(g[at], at, text, text == words.text_of[window - 1 :])
    return g[at[first]], first, last


def anchor_rows(docs: DataFrame, window: int, anchor: int, bits: int) -> DataFrame:
    """(cell, doc_id): the cell of each anchor of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"].to_numpy(zero_copy_only=False), as_bytes(batch["text"])
            for i, j in pieces(texts):
                words = Words(texts[i:j])
                key, first, _ = anchored(words, window, anchor)
                yield pa.RecordBatch.from_arrays([as_long(key % np.uint64(bits)), pa.array(ids[i:j][words.text_of[first]])], ["cell", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "cell long, doc_id long")


STRETCH = "key long, doc_id long, start long, words string, first int, last int"


def stretch_rows(docs: DataFrame, window: int, anchor: int, bits: int, bitmap) -> DataFrame:
    """STRETCH: for each anchor that another document may have, the words of its windows.

    ``start`` is the place of the first word in the document, with the text's number above the lower 32 bits; the windows to judge begin at the
    words ``first`` to ``last`` of ``words``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"].to_numpy(zero_copy_only=False), as_bytes(batch["text"])
            origin = batch["no"].to_numpy() << 32
            for i, j in pieces(texts):
                words = Words(texts[i:j])
                key, first, last = anchored(words, window, anchor)
                hit = in_bitmap(bitmap.value, key % np.uint64(bits))
                key, first, last = key[hit], first[hit], last[hit]
                text = words.text_of[first]
                cut = [b" ".join(words.buf[a:b].tobytes().split()) for a, b in zip(words.start[first], words.end[last + window - 1])]
                yield pa.RecordBatch.from_arrays(
                    [as_long(key), pa.array(ids[i:j][text]), pa.array(first - words.first[text] + origin[i:j][text]), pa.array(cut, pa.binary()).cast(pa.string()),
                     pa.array(np.zeros(len(key), np.int32)), pa.array((last - first).astype(np.int32))],
                    ["key", "doc_id", "start", "words", "first", "last"],
                )

    return docs.select("doc_id", "text", "no").mapInArrow(run, STRETCH)


def references(rows: DataFrame) -> DataFrame:
    """(key, base_doc, base, rows): the stretch of the smallest document of each key that several documents have."""
    least = F.min_by(F.struct("doc_id", "words"), F.struct("doc_id", "start", "first")).alias("least")
    found = rows.groupBy("key").agg(least, F.max("doc_id").alias("hi"), F.count("*").alias("rows")).where("least.doc_id < hi")
    # a passage of many bytes counts as met by none, so that it is not broadcast
    return found.select("key", F.col("least.doc_id").alias("base_doc"), F.col("least.words").alias("base"), F.when(F.octet_length("least.words") <= BROADCAST_BYTES, F.col("rows")).otherwise(0).alias("rows"))


def next_keys(rows: list[tuple], todo: list[np.ndarray], window: int, anchor: int, whole: bool) -> list[list[tuple[int, int, int]]]:
    """(key, first, last) of the windows that are left of each row, by anchors that its reference does not have.

    Equal windows of one key have the same reference and so get the same new key. A window without
    such an anchor goes by all of its words, as all windows do if ``whole``.
    """
    words, base = Words([r[3] for r in rows]), Words([r[6] for r in rows])
    h = words.hashes()
    of_window = rolling(h, window)
    n = len(of_window)
    judged = np.zeros(n, bool)
    for first, w in zip(words.first, todo):
        judged[first + w] = True
    key, at = of_window.copy(), np.arange(n)
    if not whole:
        g = rolling(h, anchor)
        row = lambda x, of: mix(x + of[: len(x)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # noqa: E731  a run, told apart by rows
        known = np.isin(row(g, words.text_of), row(rolling(base.hashes(), anchor), base.text_of))
        g = np.where(known, NO_ANCHOR, g)
        least = least_at(g, window - anchor + 1)
        free = g[least] != NO_ANCHOR
        key, at = np.where(free, g[least], key), np.where(free, least, at + n)
    with np.errstate(over="ignore"):
        old = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        key = mix(key + old[words.text_of[:n]] * np.uint64(0xBF58476D1CE4E5B9))
    first, last = stretches(key, at, words.text_of[:n], judged)
    out: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    for k, t, a, b in zip(key[first].view(np.int64).tolist(), words.text_of[first].tolist(), first.tolist(), last.tolist()):
        out[t].append((k, a - int(words.first[t]), b - int(words.first[t])))
    return out


def matched(rows: DataFrame, window: int, anchor: int, turn: int) -> DataFrame:
    """(doc_id, start, words, cut, todo): what of each stretch its reference has, and the windows that are left.

    ``cut`` holds the ranges of words that go, ``todo`` the new keys of windows that are left (without
    any, words are null). The reference's automaton gives the matching statistics.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = automaton = None
        for batch in batches:
            texts, bases = as_bytes(batch["words"]), as_bytes(batch["base"])
            all_rows = list(zip(*(batch[c].to_pylist() for c in ("key", "doc_id", "start")), texts, *(batch[c].to_pylist() for c in ("first", "last")), bases, batch["base_doc"].to_pylist()))
            for i, j in pieces(texts):
                rows, cuts, left = [], [], []
                for r in all_rows[i:j]:
                    k, doc, start, text, first, last, base, base_doc = r
                    if text == base:
                        found, rest = range(first, last + 1) if doc > base_doc else (), np.zeros(0, np.int64)
                    else:
                        if (k, base) != key:
                            key, automaton = (k, base), Automaton(base.split(b" "))
                        stats = np.array(automaton.statistics(text.split(b" ")))
                        has = stats[window - 1 :][first : last + 1] >= window
                        found, rest = first + np.flatnonzero(has) if doc > base_doc else (), first + np.flatnonzero(~has)
                    spans: list[list[int]] = []
                    for w in found:
                        if spans and w <= spans[-1][1] - start:
                            spans[-1][1] = start + int(w) + window
                        else:
                            spans.append([start + int(w), start + int(w) + window])
                    if spans or (len(rest) and turn <= ANCHOR_TURNS):
                        rows.append(r)
                        cuts.append(spans)
                        left.append(rest)
                todo = next_keys(rows, left, window, anchor, turn == ANCHOR_TURNS) if rows and turn <= ANCHOR_TURNS else [[] for _ in rows]
                out = [
                    {"doc_id": r[1], "start": r[2], "words": r[3].decode() if t else None, "cut": [{"first": a, "last": b} for a, b in c], "todo": [{"key": k, "first": a, "last": b} for k, a, b in t]}
                    for r, c, t in zip(rows, cuts, todo)
                ]
                yield pa.RecordBatch.from_pylist(out, MATCHED)

    return rows.mapInArrow(run, "doc_id long, start long, words string, cut array<struct<first: long, last: long>>, todo array<struct<key: long, first: int, last: int>>")


def ranges_of(kind: pa.DataType) -> list[pa.Field]:
    return [pa.field("first", kind), pa.field("last", kind)]


MATCHED = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("words", pa.string()), ("cut", pa.list_(pa.struct(ranges_of(pa.int64())))), ("todo", pa.list_(pa.struct([pa.field("key", pa.int64()), *ranges_of(pa.int32())])))]
)
#: The last word of a range that has all words of a text.
ALL_WORDS = (1 << 31) - 1


def repeated_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, no) of the texts that a document with a smaller id has as a whole."""
    rows = saved(docs.where(F.col("text").isNotNull()).select("doc_id", "no", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("check")))
    groups = rows.groupBy("h", "check").agg(F.min("doc_id").alias("lo"), F.count("*").alias("rows")).where("rows > 1").withColumnRenamed("check", "group_check")
    return join_unique(rows, saved(groups), "h", "rows", rows.count()).where("check = group_check AND doc_id > lo").select("doc_id", "no")


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words of windows that a document with a smaller id has.

    1. Of equal texts the smallest id stands for all; the others' windows, if they have any, all go.
    2. Windows with the same words have the same anchor. A bounded bitmap of anchors that two or more
       documents have leaves the windows to look at; false positives only cost a row.
    3. The passage of the smallest document with an anchor is its reference. The others' passages stream
       past its suffix automaton: matching statistics of ``window`` words or more give the spans that go.
    4. Windows that the reference does not have go by another anchor, one that the reference does not
       have either, so copies with the same edit meet; what is then left goes by all of its words.
       References of anchors that a large share of the passages have are broadcast, 500 at most.

    Null and empty texts have no words. A window that only repeats within one document stays. Windows are
    judged on the input. Texts of a repeated id are told apart by a hash: each loses its own words alone, and none
    loses windows to another of the same id. A null id is neither smaller nor larger than others, so such texts stay whole and are no reference.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(F.xxhash64("text").bitwiseAND(F.lit(ALL_WORDS)), F.lit(0)).cast("long").alias("no"))
    n_docs = docs.count()
    bits = bits_for(n_docs, BITS_PER_ROW)
    copies = saved(repeated_texts(docs))
    row = F.concat_ws(":", "doc_id", "no")
    firsts = without(docs.where("doc_id IS NOT NULL"), copies.select(row.alias("key")), row, n_docs)
    cells = anchor_rows(firsts, window, anchor, bits).groupBy("cell").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    bitmap = spark.sparkContext.broadcast(collect_bitmap(cells.select("cell"), "cell", bits))
    rows = saved(stretch_rows(firsts, window, anchor, bits, bitmap))
    cuts = []
    for turn in range(1, ANCHOR_TURNS + 2):
        found = saved(matched(join_unique(rows, saved(references(rows)), "key", "rows", rows.count()), window, anchor, turn))
        cuts.append(found.select("doc_id", F.explode("cut").alias("c")).select("doc_id", "c.first", "c.last"))
        if turn > ANCHOR_TURNS:
            break
        left = found.where("words IS NOT NULL")
        keys = left.select("doc_id", F.explode("todo.key").alias("key")).groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        cell = F.pmod("key", F.lit(bits)) + 1
        several = saved(bitmap_blocks(keys.select(cell.alias("_cell")), "_cell"))
        todo = left.select("doc_id", "start", "words", F.explode("todo").alias("t")).select("t.key", "doc_id", "start", "words", "t.first", "t.last")
        rows = saved(maybe_in(todo, cell, several).where("_maybe").drop("_maybe"))
    whole_text = F.shiftleft("no", 32)
    cuts.append(copies.distinct().select("doc_id", whole_text.alias("first"), (whole_text + ALL_WORDS).alias("last")))
    own = lambda c: F.col(c).bitwiseAND(F.lit(ALL_WORDS)).alias(c)
    gone = reduce(DataFrame.unionByName, cuts).select("doc_id", F.shiftright("first", 32).alias("no"), own("first"), own("last"))
    gone = saved(gone.groupBy("doc_id", "no").agg(F.collect_list(F.struct("first", "last")).alias("cut")).select("doc_id", "no", "cut.first", "cut.last"))

    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, gone_sizes = [], [], []
            for text, first, last in zip(as_bytes(batch["text"]), batch["first"], batch["last"]):
                words = text.split()
                gone = np.zeros(len(words), bool)
                if first.is_valid and len(words) >= window:
                    for a, b in zip(first.as_py(), last.as_py()):
                        gone[a:b] = True
                sizes.append(len(words))
                gone_sizes.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone_sizes, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    doc_cell = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    tested = maybe_in(docs, doc_cell, saved(bitmap_blocks(gone.select(doc_cell.alias("_cell")), "_cell")))
    whole = tested.where(~F.col("_maybe")).select("doc_id", "text", F.lit(None).cast("array<long>").alias("first"), F.lit(None).cast("array<long>").alias("last"))
    cut = tested.where("_maybe").select("doc_id", "no", "text").join(gone.hint("merge"), ["doc_id", "no"], "left").select("doc_id", "text", "first", "last")
    return whole.unionByName(cut).mapInArrow(cut_words, "doc_id long, n_words long, n_removed long, kept string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
