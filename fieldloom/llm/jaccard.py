"""N-gram Jaccard join: documents whose sets of word shingles overlap, by T-occurrence search with DivideSkip.

The search runs on inverted lists of a part of each set, its signature (see ``signature_size``): two
sets that link share ``least_common`` shingles of their signatures. Lists are divided by length:

* Short lists are heap-merged for each set (MergeSkip). Sets that it meets often enough are candidates,
  whose remaining shingles, those of long lists among them, are looked up by binary search.
* A set with so many long lists that it may meet a partner in long lists alone is looked up by way of a
  leader of each long list. Sets differ from their leader in few shingles, so inverted lists of these
  differences are short again, and counting over them gives the overlap of any two sets.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import HOT_SHARE, bitmap_blocks, bits_for, connected_components, dealt, discard, hot_keys, join_unique, maybe_in, merge_labels, saved, shuffle_partitions, table, unpacked
from .text import Words, as_bytes, as_long, mix, pieces, powers, rolling

SHINGLE = 5
#: Two documents link when PERCENT * |union| <= 100 * |intersection|.
PERCENT = 75
#: Percent of a set's size that linked sets share within their signatures.
SPARE = 15
#: Members of a short list, at most.
SHORT = 64
#: Postings of a task that looks for repeated shingles, and shingles of a block of a leader's members, about.
BUCKET_POSTINGS, BLOCK_SHINGLES = 2_000_000, 50_000
#: Bits of a filter for each document; its size is bounded by shared.MAX_BITS.
BITS_PER_ROW = 64
_U = np.uint64


def signature_size(n, percent: int = PERCENT):
    """How many of a set's n shingles, those with the least hashes, are its signature.

    What linked sets share is percent % of the larger set at least. No more than percent - SPARE % of
    either set are left out of its signature, and those are the last ones in a common order, so both
    signatures hold SPARE % of the larger set in common.
    """
    return n - n * (percent - SPARE) // 100


def least_common(n):
    """How many shingles the signatures of two linked sets share at least, n being the larger set's size or less."""
    return -(-n * SPARE // 100)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words the whole sequence is one shingle."""
    out: list[np.ndarray] = []
    for i, j in pieces(texts):
        words = Words([t.lower() for t in texts[i:j]])
        h = words.hashes()
        g = rolling(h, size)
        for first, n in zip(words.first, words.count):
            if n >= size:
                s = np.sort(g[first : first + n - size + 1])
                out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            elif n:
                with np.errstate(over="ignore"):
                    out.append(mix(np.array([(h[first : first + n] * powers(size)[0][:n]).sum(dtype=_U) + _U(n)])))
            else:
                out.append(np.zeros(0, _U))
    return out


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set; equal sets are taken as equal by both and the size."""
    with np.errstate(over="ignore"):
        return int(mix(s).sum(dtype=_U)), int(mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U))


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def document_rows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, key, check): each document's set size and keys; without words the keys are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(as_bytes(batch["text"]), size)
            keys = [tuple(map(signed, set_keys(s))) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([k for k, _ in keys], pa.int64()), pa.array([c for _, c in keys], pa.int64())],
                ["doc_id", "n_shingles", "key", "check"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, key long, check long")


def group_starts(h: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)


def distinct_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    sets = {set_keys(s)[0]: s for s in shingle_sets(texts, size) if len(s)}
    return np.fromiter(sets, _U, len(sets)), list(sets.values())


def signature_postings(docs: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """Packed postings (shingle, key) of the signatures, dealt by shingle to parts 0, 2, 4, .. .

    Of the sets of a batch that share a shingle two are sent, which is enough to show that it is
    repeated; the keys of the others go straight to the odd parts, dealt by key, as one repeated
    shingle each. So a common shingle costs two postings a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            for i, j in pieces(texts, 4_000_000):
                keys, sets = distinct_sets(texts[i:j], size)
                if not sets:
                    continue
                parts_of = [s[: signature_size(len(s), percent)] for s in sets]
                h, key = np.concatenate(parts_of), np.repeat(keys, [len(s) for s in parts_of])
                order = np.argsort(h, kind="stable")
                h, key = h[order], key[order]
                first = group_starts(h)
                sent = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h)))) < 2
                yield dealt((h[sent] % _U(parts)).astype(np.int64) * 2, 2 * parts, h=h[sent], key=key[sent])
                if not sent.all():
                    rest = key[~sent]
                    yield dealt((mix(rest) % _U(parts)).astype(np.int64) * 2 + 1, 2 * parts, h=np.zeros(len(rest), np.uint8), key=rest)

    return docs.select("text").mapInArrow(run, "part int, h binary, key binary")


def repeated_counts(postings: DataFrame, parts: int) -> DataFrame:
    """(key, n_repeated): how many shingles of a signature other signatures have too; none that has fewer is left out."""

    def of_part(t: pa.Table) -> pa.Table:
        key = unpacked(t, "key")
        if t["part"][0].as_py() % 2 == 0:
            h = unpacked(t, "h")
            order = np.lexsort((key, h))
            h, key = h[order], key[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            h, key = h[new], key[new]
            count = np.diff(np.append(group_starts(h), len(h)))
            key = key[np.repeat(count > 1, count)]
        return pa.Table.from_batches([dealt((mix(key) % _U(parts)).astype(np.int64), parts, key=key)])

    def summed(t: pa.Table) -> pa.Table:
        key, n = np.unique(unpacked(t, "key"), return_counts=True)
        return pa.table({"key": key.view(np.int64), "n_repeated": n.astype(np.int64)})

    found = postings.groupBy("part").applyInArrow(of_part, "part int, key binary")
    return found.groupBy("part").applyInArrow(summed, "key long, n_repeated long")


def documents_of(docs: DataFrame, reps: DataFrame, n_docs: int) -> DataFrame:
    """text of the documents whose id is in ``rep``, and of a few others; the filter is bounded by shared.MAX_BITS."""
    bits = bits_for(n_docs, BITS_PER_ROW)
    cell = lambda name: F.pmod(F.xxhash64(name), F.lit(bits)) + 1
    blocks = saved(bitmap_blocks(reps.select(cell("rep").alias("_cell")), "_cell"))
    return maybe_in(docs.select("doc_id", "text"), cell("doc_id"), blocks).where("_maybe").select("text")


def candidate_sets(docs: DataFrame, classes: DataFrame, n_docs: int, size: int, percent: int) -> DataFrame:
    """(key, n, shingles) of the sets that can link to another one: enough of their signature is repeated.

    Only one document of each class of equal sets is cut into shingles.
    """
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), -(-signature_size(total, percent) // BUCKET_POSTINGS))
    counts = repeated_counts(signature_postings(documents_of(docs, classes, n_docs), size, percent, parts), parts)
    keys = classes.select("key", "n", "rep").join(counts.hint("merge"), "key")
    keys = saved(keys.where(f"100 * n_repeated >= {SPARE} * n").select("key", "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            for i, j in pieces(texts, 4_000_000):
                names, sets = distinct_sets(texts[i:j], size)
                if sets:
                    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([as_long(names), pa.ListArray.from_arrays(pa.array(offsets), as_long(np.concatenate(sets)))], ["key", "shingles"])

    sets = documents_of(docs, keys, n_docs).mapInArrow(run, "key long, shingles array<long>")
    sets = sets.join(keys, "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))
    return saved(sets.select("key", F.size("shingles").alias("n"), "shingles"))


def t_occurrence(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(value, count) of the values that ``least`` of the sorted lists have, by MergeSkip.

    The heap holds the front of each list. Where a value is too rare, the least - 1 smallest fronts
    move on by binary search to the first value that can still be frequent enough.
    """
    at = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= least:
        value, popped = heap[0][0], []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            yield value, len(popped)
            to = value + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                return
            to = max(heap[0][0], value + 1)
        for i in popped:
            x = lists[i]
            at[i] = bisect_left(x, to, at[i])
            if at[i] < len(x):
                heapq.heappush(heap, (x[at[i]], i))


def enough(count: int, n: int, long_: int, m: int, other_long: int, percent: int) -> bool:
    """Whether sets of n and m shingles that share ``count`` short lists may link, unless they share a long list and both have many."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    least = least_common(max(n, m))
    fewer = min(long_, other_long)
    return count >= (least - fewer if fewer < least else least)


def short_candidates(postings: DataFrame, lengths: DataFrame, total: int, percent: int) -> DataFrame:
    """(a, b): sets that share enough short lists, by a heap-merge of each set's lists.

    A set's lists have the members behind it, so each pair comes up at one of its ends.
    """
    short = lengths.where(F.col("length") <= SHORT)
    hot = hot_keys(lengths, "h", "length", max(SHORT + 1, int(total * HOT_SHARE)))
    found = postings.where(~F.col("h").isin(hot)).join(short.select("h").hint("merge"), "h")
    lists = found.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("key", "n", "long"))).alias("members"))
    probes = lists.select("h", "members", F.posexplode("members").alias("i", "probe")).where("i + 1 < size(members)")
    probes = probes.select(F.col("probe.key").alias("key"), F.col("probe.n").alias("n"), F.col("probe.long").alias("long"), F.expr("slice(members, i + 2, size(members))").alias("behind"))
    merged = probes.groupBy("key", "n", "long").agg(F.collect_list("behind").alias("lists"))
    merged = merged.where(f"size(lists) >= if(100 * long < {SPARE} * n, ceil(n * {SPARE} / 100) - long, 1)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for key, n, long_, lists in zip(*(batch[c].to_pylist() if c != "lists" else batch[c] for c in ("key", "n", "long", "lists"))):
                inner = lists.values
                fields = inner.flatten()
                member, size, other = (fields.field(c).to_pylist() for c in ("key", "n", "long"))
                cut = np.concatenate(([0], np.cumsum(inner.value_lengths().to_numpy()))).tolist()
                about = dict(zip(member, zip(size, other)))
                least = least_common(n)
                for value, count in t_occurrence([member[i:j] for i, j in zip(cut, cut[1:])], least - long_ if long_ < least else 1):
                    if enough(count, n, long_, *about[value], percent):
                        a.append(key)
                        b.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return merged.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that link: each shingle of the smaller set is looked up in the larger one by binary search."""
    of = lambda side: sets.select(F.col("key").alias(side), F.col("shingles").alias(f"{side}_set")).hint("merge")
    both = pairs.join(of("a"), "a").join(of("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["a_set"], batch["b_set"]):
                x, y = sorted((x.values.to_numpy().view(_U), y.values.to_numpy().view(_U)), key=len)
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], ["a", "b"])

    return both.select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long")


def leader_blocks(long_postings: DataFrame) -> DataFrame:
    """(leader, key, block): the sets with many long lists under the leader of each of their long lists.

    ``long_postings``: h, key, n, long (how many long lists the set has), of these sets. A list's
    leader is the member with the largest share of long lists, which is the middle of a group of
    near copies. A leader's members are dealt into blocks of about BLOCK_SHINGLES shingles.
    """
    lead = long_postings.groupBy("h").agg(F.max(F.struct((F.col("long") / F.col("n")).alias("share"), "key")).alias("lead"), F.count("*").alias("rows"))
    lead = saved(lead.select("h", F.col("lead.key").alias("leader"), "rows"))
    total = lead.agg(F.sum("rows")).first()[0] or 0
    members = saved(join_unique(long_postings.select("h", "key", "n"), lead, "h", "rows", total).select("leader", "key", "n").distinct())
    sizes = members.groupBy("leader").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"), F.count("*").alias("rows"))
    spread = join_unique(members, saved(sizes), "leader", "rows", total)
    return saved(spread.select("leader", "key", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")))


def differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(leader, block, blocks, key, n, linked, difference): what each member has and its leader lacks, and the other way round."""
    cols = ("leader", "block", "blocks", "key", "n", "shingles")
    own = members.join(sets.hint("merge"), "key").select(*cols, F.lit(False).alias("leads"))
    blocks = members.select("leader", "block", "blocks").distinct().withColumn("key", F.col("leader"))
    leads = blocks.join(sets.hint("merge"), "key").select(*cols, F.lit(True).alias("leads"))

    def compared(t: pa.Table) -> pa.Table:
        base = t.filter(t["leads"])["shingles"][0].values.to_numpy().view(_U)
        own = t.filter(pc.invert(t["leads"]))
        linked, gone = [], []
        for s in own["shingles"]:
            x = s.values.to_numpy().view(_U)
            d = np.setxor1d(x, base, assume_unique=True)
            common = (len(x) + len(base) - len(d)) // 2
            linked.append(100 * common >= percent * (common + len(d)))
            gone.append(d.tobytes())
        return own.drop_columns(["shingles", "leads"]).append_column("linked", pa.array(linked, pa.bool_())).append_column("difference", pa.array(gone, pa.binary()))

    schema = "leader long, block int, blocks int, key long, n int, linked boolean, difference binary"
    return own.unionByName(leads).groupBy("leader", "block").applyInArrow(compared, schema)


def open_links(compared: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of members that do not link to their leader, as a forest for each block.

    Each of these looks its difference up in the inverted lists of a block's differences. Counting
    gives |A xor B| = |D| + |E| - 2 |D and E| for the differences D, E of A and B.
    """
    open_ = compared.where(~F.col("linked")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    nothing = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    def search(t: pa.Table) -> pa.Table:
        index, probes = t.filter(pc.invert(t["probe"])), t.filter(t["probe"])
        if not len(probes) or not len(index):
            return nothing
        d = [np.frombuffer(x, _U) for x in index["difference"].to_pylist()]
        size, key, n = np.array([len(x) for x in d]), index["key"].to_numpy(), index["n"].to_numpy().astype(np.int64)
        linked = index["linked"].to_numpy()
        flat, owner = np.concatenate(d), np.repeat(np.arange(len(d)), size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        leader = index["leader"][0].as_py()
        a, b = [], []
        for name, m, x in zip(probes["key"].to_pylist(), probes["n"].to_pylist(), probes["difference"].to_pylist()):
            x = np.frombuffer(x, _U)
            first, last = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
            met = np.concatenate([owner[i:j] for i, j in zip(first, last) if i < j] or [np.zeros(0, np.int64)])
            common = np.bincount(met, minlength=len(d))
            apart = size + len(x) - 2 * common
            near = (100 * (n + m - apart) >= percent * (n + m + apart)) & (key != name)
            if (near & linked).any():
                a.append(name)
                b.append(leader)
            a += [name] * int((near & ~linked).sum())
            b += key[near & ~linked].tolist()
        nodes, ends = np.unique(np.array(a + b, np.int64), return_inverse=True)
        label = np.arange(len(nodes))
        merge_labels(label, ends[: len(a)], ends[len(a) :])
        return pa.table({"a": nodes, "b": nodes[label]})

    both = compared.withColumn("probe", F.lit(False)).unionByName(open_.withColumn("probe", F.lit(True)))
    return both.groupBy("leader", "block").applyInArrow(search, "a long, b long").where("a <> b")


def linked_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the sets that link to another one."""
    size = f"CAST(n - n * {percent - SPARE} div 100 AS INT)"
    total = sets.agg(F.sum(F.expr(size))).first()[0] or 0
    signature = F.expr(f"slice(shingles, 1, {size})")
    lengths = saved(sets.select(F.explode(signature).alias("h")).groupBy("h").agg(F.count("*").alias("length")).where("length > 1"))
    long_ = lengths.where(F.col("length") > SHORT)
    long_postings = saved(join_unique(sets.select("key", "n", F.explode(signature).alias("h")), long_, "h", "length", total))
    has_long = saved(long_postings.groupBy("key").agg(F.count("*").cast("int").alias("long")))
    marked = sets.select("key", "n", signature.alias("s")).join(has_long, "key", "left").select("key", "n", F.coalesce("long", F.lit(0)).alias("long"), F.explode("s").alias("h"))
    candidates = saved(short_candidates(marked, lengths, total, percent))
    links = saved(verified(candidates, sets, percent))
    old = [lengths, long_postings, has_long, candidates, links]
    many = has_long.join(sets.select("key", "n"), "key").where(f"100 * long >= {SPARE} * n").select("key", "long")
    members = leader_blocks(long_postings.join(many, "key"))
    if not members.isEmpty():
        compared = saved(differences(members, sets, percent))
        to_leader = compared.where("linked AND key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b"))
        further = saved(open_links(compared, percent))
        links = links.unionByName(to_leader).unionByName(further)
        old += [compared, further]
    components = connected_components(links)  # saved, so that nothing else is read any more
    discard(*old, members)
    return components


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; a document's set holds
    its distinct runs of ``size`` words, or the whole sequence if it is shorter. Documents link
    when percent * |union| <= 100 * |intersection|; component_id is the smallest doc_id that
    links reach. Null, empty and blank texts have the empty set and link with nothing. Equal
    sets are compared once, so repeated rows and copies share a component. Shingles and sets are told
    apart by 64-bit hashes; apart from that no link is lost. Links within a leader's group are not
    all listed, as their number grows with the group's square. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = saved(document_rows(docs, size))
    n_docs = rows.count()
    filled = rows.where(F.col("key").isNotNull())
    classes = saved(filled.groupBy("key", "check").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.count("*").alias("rows")))
    component = linked_keys(candidate_sets(docs, classes, n_docs, size, percent), percent)
    placed = saved(classes.join(component.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n_classes"))
    named = join_unique(placed.select("key", "rows", "component"), saved(least), "component", "n_classes", placed.count())
    named = saved(named.groupBy("key").agg(F.min("component_id").alias("component_id"), F.sum("rows").alias("rows")))
    out = join_unique(filled, named, "key", "rows", n_docs).select("doc_id", "n_shingles", "component_id")
    return out.unionByName(rows.where(F.col("key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
