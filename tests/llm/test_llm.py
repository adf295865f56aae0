import hashlib
import random
import re
import uuid
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import exact_dedup, jaccard, language, line_dedup, linear, mixing, quality, sentencepieces, substrings, toxicity, vectors
from fieldloom.llm.shared import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long"


def documents(spark, texts, source=None):
    return spark.createDataFrame([(i, t, "en", source(i) if source else "s", None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    passage = [rng.choice(words) for _ in range(70)]
    out = []
    for family in range(30):
        base = passage[: 45 + family] + [rng.choice(words) for _ in range(40 + family)]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return [*out, out[0].upper(), None, "", " \n\t", "one two", "ONE two", "a b c d e", "long " * 20000]


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: c for n, c in components({x for e in edges for x in e}, edges).items() if n in got} and len(got) == 101


def test_jaccard_matches_brute_force(spark, texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(range(len(sets)), linked)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, texts)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def near_copies(n, words=120, seed=6):
    """Copies of one text with one to four words changed, some at the same place in the same way."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice([1, 1, 2, 4])):
            copy[at] = f"edit{at}{rng.choice('ab')}"
        out.append(" ".join(copy))
    return out


def jaccard_by_hand(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(range(len(sets)), linked)
    return {i: (len(s), want[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("short, block", [(64, 50_000), (2, 50_000), (2, 1500)])
def test_jaccard_by_leaders_matches_brute_force(spark, texts, monkeypatch, short, block):
    """With short lists of two sets at most nearly all sets go by leaders, in one block or in many."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    body = [*near_copies(60), *near_copies(25, 40, 9), *[t for t in texts if t and len(t) < 5000][:30], "", None]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, body)).collect()}
    assert got == jaccard_by_hand(body)


def test_linked_sets_share_enough_of_their_signatures():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        n = int(rng.integers(1, 200))
        a = np.sort(rng.integers(0, 1 << 62, n).astype(np.uint64))
        keep = a[rng.random(n) < rng.choice([0.8, 0.9, 1.0])]
        b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 75 * (len(a) + len(b) - common):
            shared = len(np.intersect1d(a[: jaccard.signature_size(len(a))], b[: jaccard.signature_size(len(b))]))
            assert shared >= jaccard.least_common(max(len(a), len(b)))


def test_merge_skip_counts_like_a_plain_count():
    rng = random.Random(8)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 20))) for _ in range(rng.randrange(1, 12))]
        counts = defaultdict(int)
        for x in lists:
            for v in x:
                counts[v] += 1
        least = rng.randrange(1, 6)
        assert dict(jaccard.t_occurrence(lists, least)) == {v: n for v, n in counts.items() if n >= least}


def test_substrings_match_brute_force(spark, texts):
    first = {}
    words = [(t or "").split() for t in texts]
    for i, w in enumerate(words):
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for r in substrings.substring_dedup(documents(spark, texts)).collect():
        w = words[r["doc_id"]]
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < r["doc_id"]:
                gone |= set(range(k, k + 50))
        assert (r["n_words"], r["n_removed"], r["kept"]) == (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))


def substrings_by_hand(words):
    first, want = {}, {}
    for i, w in enumerate(words):
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, w in enumerate(words):
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        want[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return want


def test_texts_of_a_repeated_id_lose_their_own_words_alone(spark):
    words = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    a, b, c = words("a"), words("b"), words("c")
    rows = [(5, a), (9, a), (9, b), (9, b), (12, f"{b} {c}"), (12, f"{c} {words('d')}"), (13, c), (9, words("a", 49))]
    docs = spark.createDataFrame([(i, t, "en", "s", None, None, None) for i, t in rows], DOCS).repartition(3)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.substring_dedup(docs).collect())
    want = [(5, 60, 0, a), (9, 49, 0, words("a", 49)), (9, 60, 0, b), (9, 60, 0, b), (9, 60, 60, ""), (12, 120, 0, f"{c} {words('d')}"), (12, 120, 60, c), (13, 60, 60, "")]
    assert got == sorted(want)


@pytest.mark.parametrize("hot_bytes", [20_000, 0])
def test_substrings_of_many_edited_copies(spark, monkeypatch, hot_bytes):
    """Edits that several copies share are found by further anchors and at last by all words of a window."""
    monkeypatch.setattr(substrings, "BROADCAST_BYTES", hot_bytes)
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(600)]
    base[300:420] = base[60:180]
    words = [base]
    for _ in range(60):
        words.append(list(base))
        for at in rng.sample(range(0, 600, 20), 6):
            words[-1][at] = f"edit{at}{rng.choice('ab')}"
    words += [["own"] * 60 + base[100:400] * 2, base[:70], ["same"] * 200, ["same"] * 120, base]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.substring_dedup(documents(spark, [" ".join(w) for w in words])).collect()}
    assert got == substrings_by_hand(words)


def test_least_at_and_matching_statistics():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, width = rng.integers(0, 9, 60), int(rng.integers(1, 50))
        assert substrings.least_at(g, width).tolist() == [i + int(np.argmin(g[i : i + width])) for i in range(60 - width + 1)]
        base, text = rng.integers(0, 3, 30).tolist(), rng.integers(0, 3, 30).tolist()
        runs = {tuple(base[i:j]) for i in range(30) for j in range(i, 31)}
        want = [max(n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in runs) for i in range(30)]
        assert substrings.Automaton(base).statistics(text) == want


def test_exact_dedup(spark, texts):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")].append(i)
    for r in exact_dedup.exact_dedup(documents(spark, texts), bits_per_row=1).collect():
        text, ids = next((t, g) for t, g in groups.items() if r["doc_id"] in g)
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), r["doc_id"] == max(ids), hashlib.sha256(text.encode()).hexdigest())


def test_lines(spark):
    body = [f"Page {i} of the big book\nown{i} line{i} here{i}\n\nshort" for i in range(6)] + ["own line only", None, ""]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(documents(spark, body)).collect()}
    assert got[0]["kept_text"] == "own0 line0 here0\n" and got[0]["n_dropped"] == 2
    assert got[6]["kept_text"] == "own line only" and got[7]["n_lines"] == 1 and len(got) == 9


@pytest.mark.parametrize("n", [30, 3000])
def test_templates_do_not_depend_on_the_size_of_the_table(spark, n):
    """Fields whose values recur in many documents stay fields: 20 authors or 200, each with several documents."""
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    body = [f"This page was last edited by {name(i * 7 % (n // 15))} on {days[i * 3 % 7]}\nonly {name(i)} here" for i in range(n)]
    out = line_dedup.line_dedup(documents(spark, body)).collect()
    assert all(r["n_dropped"] == 1 for r in out) and out[0]["kept_text"].startswith("only")


def test_lines_of_one_document_are_one_document(spark):
    body = ["\n".join(f"- see also the tree {x}" for x in ("Apples", "Pears", "Plums", "Figs", "Dates")), *[f"- see also the tree {x}" for x in ("Kiwis", "Limes")], "a\nb"]
    assert all(r["n_dropped"] == 0 for r in line_dedup.line_dedup(documents(spark, body)).collect())
    more = [*body, *[f"- see also the tree {x}" for x in ("Nuts", "Oats")]]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_dedup(documents(spark, more)).collect()}
    assert got == {0: 5, 1: 1, 2: 1, 3: 0, 4: 1, 5: 1}


def letters(i):
    return "".join(chr(97 + int(d)) for d in str(i))


def test_lines_with_a_common_start_alone_stay(spark):
    """Ten documents, each with a line of its own behind three common words; so do twenty that share one word more."""
    body = [f"It was a {letters(i)}x {letters(i)}y" for i in range(10)] + [f"There is no good {letters(i)} {letters(i)}z" for i in range(20)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.line_dedup(documents(spark, body)).collect())


def test_templates_that_share_a_leaf_are_told_apart(spark):
    """Ten templates of twenty documents each, with one field."""
    body = [f"the pump at {letters(t)}place has sent {letters(1000 + t)}note {letters(t * 20 + k)}" for t in range(10) for k in range(20)]
    assert [r["n_dropped"] for r in line_dedup.line_dedup(documents(spark, body)).collect()] == [1] * 200


@pytest.mark.parametrize("case", range(3))
def test_lines_match_sql(spark, case):
    """The query's SQL over invented lines with leaves of many templates, against the operator."""
    import duckdb

    rng = random.Random(case)
    words = [f"w{letters(i)}" for i in range(6)]
    line = lambda: " ".join(["see the list"[: rng.choice([3, 12])], *[rng.choice(words) if rng.random() < 0.7 else letters(rng.randrange(10**6)) for _ in range(rng.choice([1, 3, 4]))], rng.choice(["", "7"])])
    body = ["\n".join(line() for _ in range(rng.randrange(6))) for _ in range(400)]
    documents_ = pd.DataFrame({"doc_id": range(len(body)), "text": body})
    want = dict(duckdb.sql(f"WITH documents AS (FROM documents_) {line_dedup.OP2_SQL.strip().replace('WITH s AS', ', s AS', 1)}").df()[["doc_id", "kept_sha256"]].itertuples(index=False))
    got = {r["doc_id"]: hashlib.sha256(r["kept_text"].encode()).hexdigest() for r in line_dedup.line_dedup(documents(spark, body)).collect()}
    assert got == want and len({k for k in got if hashlib.sha256(body[k].encode()).hexdigest() != got[k]}) > 20


def test_words_of_lines_shuffle_once(spark):
    """Lines of 200 words of their own: as long as these are grouped, they shuffle as one row each, and for nothing else."""
    body = [f"a b c{letters(i // 5)} " + " ".join(f"w{letters(i * 200 + k)}" for k in range(200)) for i in range(200)]
    docs, context = documents(spark, body), spark.sparkContext
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for found in [context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)] for s in map(found.apply, range(found.size()))}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = stages()
        assert all(r["n_dropped"] == 0 for r in line_dedup.line_dedup(docs).collect())
        context._jsc.sc().listenerBus().waitUntilEmpty()
        assert 40_000 <= sum(n for k, n in stages().items() if k not in before) <= 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_mixing_targets(spark):
    docs = documents(spark, ["a b c"] * 300 + [None, "", "x"], lambda i: None if i > 301 else ["a", "b", "c"][i % 3])
    out = mixing.mixed(docs).collect()
    assert all(r["copies"] <= 2 and r["target"] <= 2 * r["source_size"] for r in out)
    targets = {r["source"]: r["target"] for r in out}
    sizes = defaultdict(int)
    for r in out:
        sizes[r["source"]] += r["size"]
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-6
    again = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in out}
    assert mixing.emit(docs).columns == docs.columns and mixing.emit(docs).count() == sum(r["copies"] for r in out)


def test_mixing_comes_near_its_targets(spark):
    """Of n documents of one size each source's draw has a standard deviation of half the root of n; five of them are the bound."""
    docs = documents(spark, ["a b c d"] * 6000, lambda i: f"s{i % 5}" if i % 3 else "hot")
    rows = mixing.mixed(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert len(rows) == 6 and all(abs(r["taken"] - r["target"]) <= 5 * 4 * 0.5 * r["n"] ** 0.5 for r in rows)


def test_small_sources_come_near_their_targets(spark):
    rng = random.Random(9)
    docs = documents(spark, [" ".join("x" * rng.randrange(1, 200)) for _ in range(300)], lambda i: f"s{i % 10:02}")
    rows = mixing.mixed(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert len(rows) == 10 and all(abs(r["taken"] - r["target"]) <= 0.05 * r["target"] for r in rows)


def test_rows_without_an_id_are_copies_of_those_with_one(spark):
    rows = [(None, "a b"), (None, "A b"), (3, "a b"), (None, "c"), (None, "C")]
    docs = spark.createDataFrame([(i, t, "en", "s", None, None, None) for i, t in rows], DOCS)
    got = sorted((r["doc_id"] is not None, r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs).collect())
    assert got == [(False, 2, True), (False, 2, True), (False, 3, False), (False, 3, False), (True, 3, True)]


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    x = np.concatenate((x, x[:20] + rng.normal(scale=0.12, size=(20, 8)), x[:5]))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(85, None), (86, [0.0] * 8), (87, [None] * 8), (88, [float("nan")] * 8), (89, [1.0, 2.0])]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = [(i, j) for i in range(85) for j in range(85) if i != j and u[i] @ u[j] >= 0.95]
    want = components(range(90), linked)
    for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=20).collect():
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (sum(a == i for a, _ in linked), want[i], want[i] == i)


def test_vectors_in_clusters_and_of_any_length(spark):
    """Clusters of 64 components in single precision, where tiles are left out; and components whose squares overflow or vanish."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 64))
    x = (centres[rng.integers(0, 12, 600)] + rng.normal(scale=0.22, size=(600, 64))).astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = components(range(600), [(int(i), int(j)) for i, j in zip(*np.nonzero(near))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(rows, block_rows=40).collect()}
    assert got == {i: (int(near[i].sum()), want[i]) for i in range(600)} and near.sum() > 600
    odd = spark.createDataFrame([(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [1e-200, -1e-200])], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["component_id"] for r in vectors.near_vectors(odd).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_sentencepieces_match_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    body = ["", None, " a  b\n\tﬁ ☃ ", "x" * 3000, "日本語\x00 text", "_" * 40, "the quick brown fox " * 50]
    for r in sentencepieces.decode(sentencepieces.encode(documents(spark, body))).collect():
        assert r["tokens"] == sp.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")


def test_sentencepieces_of_a_whole_table_match_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.select("doc_id", "text").unionByName(documents(spark, ["ab " * 200_000]).select((F.col("doc_id") - 1).alias("doc_id"), "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = sentencepieces.token_digests(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = sp.encode(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["tokens_sha256"], r["round_trip"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), True)


def labelled(spark):
    rng = random.Random(2)
    good, bad, rude = ["the", "cat", "sat", "down", "here"], ["###", "!!!", "$$$"], ["dolt", "oaf"]
    texts, labels = [], []
    for i in range(400):
        q, t = i % 4 > 0, i % 5 == 0
        w = [rng.choice(good) + rng.choice("abcdef") * (rng.random() < 0.3) for _ in range(20)]
        w = w + [rng.choice(rude)] * t if q else [x + rng.choice(bad) for x in w] + [rng.choice(rude)] * t
        texts.append(" ".join(w))
        labels.append((i, int(q), int(t)))
    return documents(spark, [*texts, None, ""]), spark.createDataFrame([*labels, (1, None, None)], "doc_id long, quality int, toxic int"), labels


def test_classifiers_on_held_out_documents(spark):
    docs, labels, known = labelled(spark)
    for run, column in ((quality.quality_scores, 1), (toxicity.toxicity, 2)):
        got = {r["doc_id"]: r for r in run(docs, labels).collect()}
        assert len(got) == 402 and all(0 <= r["score"] <= 1 for r in got.values())
        held = [k for k in known if got[k[0]]["held_out"]]
        assert sum(got[k[0]]["predicted"] == k[column] for k in held) >= 0.95 * len(held)
    assert all(r["score"] == 0.5 for r in quality.quality_scores(docs, labels.where("doc_id < 0")).collect())


def test_languages_on_held_out_documents(spark):
    rng = random.Random(4)
    stems = {"en": ["the", "with", "thing", "ing"], "de": ["der", "und", "sch", "keit"], "fr": ["le", "eau", "que", "tion"]}
    rows = [(i, " ".join(rng.choice(stems[x]) + rng.choice(stems[x]) for _ in range(30)), x) for i in range(150) for x in [list(stems)[i % 3]]]
    rows += [(200, None, "en"), (201, "123 !!", "en"), (202, "the thing with", None)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[200]["lang_pred"] == got[201]["lang_pred"] == "und" and got[202]["lang_pred"] == "en"
    assert all(got[i]["lang_pred"] == x for i, _, x in rows[:150])


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("run", [
    jaccard.jaccard_components, substrings.substring_dedup, exact_dedup.exact_dedup, line_dedup.line_dedup, mixing.mixed, mixing.emit, language.identify, sentencepieces.token_digests,
    lambda d: quality.quality_scores(d, d.sparkSession.createDataFrame([], LABELS)), lambda d: toxicity.toxicity(d, d.sparkSession.createDataFrame([], LABELS)),
    lambda d: vectors.near_vectors(d.sparkSession.createDataFrame([], "vec_id long, embedding array<double>")),
])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


CLASHES = ["block", "bits", "_cell", "_maybe", "key", "row", "size", "source_size", "target", "copies", "_copy", "score", "predicted", "cell", "kept", "component_id", "a.b"]


def clashing(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", f"s{i % 2}", *[-7 - i] * len(CLASHES)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` int" for c in CLASHES))


@pytest.mark.parametrize("run", [
    jaccard.jaccard_components, substrings.substring_dedup, exact_dedup.exact_dedup, line_dedup.line_dedup, mixing.mixed, language.identify, sentencepieces.token_digests,
    lambda d: quality.quality_scores(d, d.sparkSession.createDataFrame([(1, 1, 0), (2, 0, 1)], LABELS)), lambda d: toxicity.toxicity(d, d.sparkSession.createDataFrame([(1, 1, 0), (2, 0, 1)], LABELS)),
])
def test_clashing_columns_nulls_and_repeated_rows(spark, run):
    """Columns with names that operators use, null ids and texts, rows that come twice and a long text: one row each comes back."""
    body = ["a b c d e f g"] * 3 + [None, "", "x", "x", "long text " * 30000, "a b c d e f g"]
    docs = clashing(spark, body, [0, 1, 1, 3, 4, 5, 5, None, 8])
    assert run(docs).count() == len(body)


def test_stages_keep_a_tables_own_columns(spark):
    import corpus_pipeline

    body = ["the cat sat here on the mat today"] * 3 + ["The Cat sat here on the mat today", None, "", "one two three four five six"] * 2
    docs = clashing(spark, body, [0, 1, 1, 3, 4, 5, 6, 7, 8, 9, 10])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert all(r["size"] == r["block"] == r["score"] == r["a.b"] for r in out.collect()), name
    kept = sorted((r["doc_id"], r["text"] or "") for r in corpus_pipeline.distinct_texts(spark, docs, "").collect())
    assert kept == [(7, "The Cat sat here on the mat today"), (9, ""), (10, "one two three four five six")]
    again = clashing(spark, ["same text"] * 3, [2, 2, 2])
    assert corpus_pipeline.distinct_texts(spark, again, "").count() == 1
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "/root/testdata/sf0.001").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
    kept = corpus_pipeline.distinct_texts(spark, docs, sf).select(F.lower("text")).collect()
    assert len(kept) == len({r[0] for r in kept})


def test_stages_of_the_pipeline_take_small_batches(spark):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        docs = spark.range(9000).selectExpr("id AS doc_id", "'a b' AS text", "'s' AS source").coalesce(1)
        corpus_pipeline.encoded(spark, docs, "")
        assert max(r["n"] for r in docs.select("text").mapInPandas(lambda parts: (pd.DataFrame({"n": [len(p)]}) for p in parts), "n long").collect()) <= corpus_pipeline.BATCH_ROWS
        spark.conf.set(key, 7)
        corpus_pipeline.encoded(spark, docs, "")
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, before)


def test_pipeline_matches_plain_python(spark):
    """run() over sf0.001 against plain Python from stage to stage; the scores are the classifier's, the copies the mix's."""
    import sentencepiece

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = quality.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").select("doc_id")
    rows = {r["doc_id"]: r for r in docs.join(scored, "doc_id").collect()}
    lowered = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    last = {}
    for i in sorted(rows):
        last[lowered(rows[i]["text"])] = i
    ids, sets = sorted(last.values()), {}
    for i in ids:
        w = (rows[i]["text"] or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    holders = defaultdict(list)
    for i in ids:
        for x in sets[i]:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    group = components(ids, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    left = [i for i in ids if group[i] == i]
    assert len(rows) > len(ids) > len(left) > 0
    mix = mixing.mixed(docs.where(F.col("doc_id").isin(left))).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    want = []
    for r in mix:
        tokens = sp.encode(rows[r["doc_id"]]["text"] or "")
        want += [(r["doc_id"], len(tokens), hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest())] * r["copies"]
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["tokens_sha256"]) for r in got) == sorted(want) and all(r["round_trip"] for r in got)


def plain_ppm(texts):
    """Order-3 PPM with method C escapes in dictionaries; contexts of three bytes count where both languages have 16 of them."""
    tables = [defaultdict(lambda: defaultdict(int)) for _ in range(4)]
    for t in texts:
        t = b"\n\n\n" + t + b"\n\n\n"
        for i in range(3, len(t)):
            for k in range(4):
                tables[k][t[i - k : i]][t[i]] += 1
    return tables


def plain_bits(tables, deep, text):
    total, t = 0.0, b"\n\n\n" + text + b"\n\n\n"
    for i in range(3, len(t)):
        k, bits = 3 if t[i - 3 : i] in deep else 2, 0.0
        while True:
            seen = tables[k].get(t[i - k : i], {})
            n, d = sum(seen.values()), len(seen)
            if t[i] in seen:
                total += bits - np.log2(seen[t[i]] / (n + d))
                break
            bits += -np.log2(d / (n + d)) if n else 0.0
            k -= 1
            if k < 0:
                total += bits + 8
                break
    return total


def test_language_model_matches_plain_dictionaries():
    rng = random.Random(7)
    texts = {x: [" ".join(rng.choice(s) + rng.choice(s) for _ in range(60)).encode() for _ in range(20)] for x, s in (("a", ["the", "ing", "é"]), ("b", ["der", "ing", "ß"]))}
    counts = {}
    for x, body in texts.items():
        all_ = defaultdict(int)
        for t in body:
            for q, n in zip(*language.quads(t)):
                all_[int(q)] += int(n)
        counts[x] = (np.array(list(all_), np.int64), np.array(list(all_.values()), np.int64))
    model, tables = language.fit(counts), {x: plain_ppm(body) for x, body in texts.items()}
    often = defaultdict(int)
    for t in tables.values():
        for context, seen in t[3].items():
            often[context] += sum(seen.values())
    deep = {c for c, n in often.items() if n >= 16}
    probes = [b"theing der", texts["a"][0], texts["b"][3], b""]
    got = model.bits(probes)
    # a text's last break is shared with the next text, so it is left out at the very end
    for k, t in enumerate(probes[:-1]):
        for j, x in enumerate(model.languages):
            assert abs(got[k, j] - plain_bits(tables[x], deep, t)) < 0.01 * len(t) + 0.1, (k, x)


def test_ftrl_matches_a_plain_loop():
    rng = random.Random(1)
    sample = [(i, rng.randrange(2), np.array(sorted(rng.sample(range(30), 6))), np.array([rng.random() for _ in range(6)])) for i in range(80)]
    z, n, bias, bias_n = defaultdict(float), defaultdict(float), 0.0, 1e-3

    def weight(k):
        return 0.0 if abs(z[k]) <= 1e-4 else -(z[k] - np.sign(z[k]) * 1e-4) / ((1e-3 + n[k] ** 0.5) / 0.5 + 1e-3)

    for _ in range(quality.PASSES):
        for _, y, at, x in sample:
            w = {int(k): weight(int(k)) for k in at}
            slope = 1 / (1 + np.exp(-(bias + sum(w[int(k)] * v for k, v in zip(at, x))))) - y
            for k, v in zip(at.tolist(), x):
                g = slope * v
                z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / 0.5 * w[k]
                n[k] += g * g
            bias_n += slope * slope
            bias -= 0.1 * slope / bias_n**0.5
    weights, got = quality.train(sample)
    assert abs(got - bias) < 1e-9 and all(abs(weights[k] - weight(k)) < 1e-9 for k in range(30))


def test_ordinal_steps_follow_the_gradient_of_the_loss():
    """The slopes that training takes are those of -log P(grade), by differences."""
    w, cuts, x = np.array([0.4, 0.1]), np.array([0.2, 0.9, 1.7]), np.array([1.0, 1.0])
    sig = lambda v: 1 / (1 + np.exp(-v))

    def loss(w, cuts, y):
        above = np.concatenate(([1.0], sig(x @ w - cuts), [0.0]))
        return -np.log(above[y] - above[y + 1])

    for y in range(4):
        above = np.concatenate(([1.0], sig(x @ w - cuts), [0.0]))
        d, p = above * (1 - above), above[y] - above[y + 1]
        assert abs(-(d[y] - d[y + 1]) / p - (loss(w + [1e-6, 0], cuts, y) - loss(w, cuts, y)) / 1e-6) < 1e-4
    sample = [(i, i % 4, np.array([i % 4]), np.ones(1)) for i in range(200)]
    weights, found = toxicity.train(sample)
    assert weights[1] <= weights[2] <= weights[3] and list(found) == sorted(found)


def test_real_grades_are_taken_as_they_are():
    marker = np.ones(toxicity.DIMS, bool)
    sample = [(i, y, np.arange(3), np.ones(3)) for i, y in enumerate([0, 1, 2, 3])]
    assert [r[1] for r in toxicity.grade(sample, marker)] == [0, 1, 2, 3]


def test_training_rows_are_made_one_at_a_time(spark):
    """The driver holds the packed sample, not all rows of it as wider arrays; the rows and their order are those of the whole list."""
    import tracemalloc

    docs = documents(spark, [" ".join(f"w{i * k % 997}" for k in range(800)) for i in range(60)])
    labels = spark.createDataFrame([(r["doc_id"], i % 2) for i, r in enumerate(docs.select("doc_id").collect())], "doc_id long, label int")
    sample = linear.sample_features(docs, labels, quality.features, 50)
    assert len(sample) == 50 and len({r[0] for r in sample}) == 50
    all_bytes = sum(at.nbytes + x.nbytes for _, _, at, x in sample)
    tracemalloc.start()
    for _ in sample:
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < all_bytes / 5
    assert list(sample)[7][2].dtype == np.int64 and list(sample)[7][3].dtype == np.float64
    before = [(i, y, at.copy(), x.copy()) for i, y, at, x in sample]
    (w, b), (v, c) = quality.train(sample), quality.train(before)
    assert b == c and (w == v).all()


def test_exact_dedup_stage_tests_rows_again_only_if_some_repeat(spark, capsys):
    import corpus_pipeline

    def joins(ids):
        docs = spark.createDataFrame([(i, t, "s") for i, t in zip(ids, ["a b", "A b", "c", None])], "doc_id long, text string, source string")
        out = corpus_pipeline.distinct_texts(spark, docs, "")
        out.explain()
        found = capsys.readouterr().out.count("LeftAnti")
        assert {(r["doc_id"], r["text"]) for r in out.collect()} == {(max(ids[:2]), "A b"), (ids[2], "c"), (ids[3], None)}
        return found

    assert joins([1, 2, 3, 4]) == 1
    docs = spark.createDataFrame([(1, "a", "s"), (1, "a", "s"), (2, "b", "s")], "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.distinct_texts(spark, docs, "").collect()) == [1, 2]
