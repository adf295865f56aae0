import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldloom.llm import token_alignment
from fieldloom.llm.token_alignment import NOTHING, Aligner

DOCS = "doc_id long, text string, block string, at int, codes binary, `a.b` int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def aligner():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        return Aligner(f.read(), g.read())


def tokens(libraries, text):
    """(id, bytes) of both sides, whole texts through the libraries."""
    a, b = libraries
    ids = a.encode(" " + text, add_special_tokens=False).ids
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own}
    for x in range(256):
        if x not in own:
            letters[chr(256 + len(letters) - len(own))] = x
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = b" " + text.encode()
    good = all(b"".join(t for _, t in side) == whole for side in (left, right))
    return (left, right) if good and text else ([], [])


def groups_and_links(left, right):
    ends = [list(accumulate(len(t) for _, t in side)) for side in (left, right)]
    common = set(ends[0]) & set(ends[1])
    text, links, i, j = [], [], 0, 0
    group = ([], [])
    begun = 0
    while i < len(left):
        while True:
            group[0].append(left[i][0])
            i += 1
            if ends[0][i - 1] in common:
                break
        while True:
            group[1].append(right[j][0])
            j += 1
            if ends[1][j - 1] in common:
                break
        text.append("|".join(",".join(map(str, g)) for g in group))
        group = ([], [])
    for k, (a, t) in enumerate(left):
        low, high = ends[0][k] - len(t), ends[0][k]
        while ends[1][begun] <= low:
            begun += 1
        m = begun
        while m < len(right) and ends[1][m] - len(right[m][1]) < high:
            links.append((a, right[m][0]))
            m += 1
    return text, links


def by_hand(libraries, rows):
    found = []
    for i, text in rows:
        left, right = tokens(libraries, text or "")
        found.append((i, len(left), len(right), *groups_and_links(left, right)))
    count = Counter(p for *_, links in found for p in links)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    return sorted(
        (i is not None, i or 0, n_a, n_b, len(g), len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, n_a, n_b, g, links in found
    )


def rows_of(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]) for r in df.collect())


ODD = [" ", "  ", "\n", "\n\n", "\t", "\xa0", " ", "　", "\x1c", "\x85", "\r\n ", "x\n ", "'s", " 's", "don't", "<|endoftext|>", "<s>", "<unk>", "<0x0A>", "▁", "ﬁ", "é", "́", "𝒳x", "Σ", "3.14", " 12 345", "!?", "a b", " wort", "Das Haus", "\x00", "\x7f"]
odd = st.lists(st.sampled_from(ODD) | st.text(max_size=3), max_size=14).map("".join).map(lambda t: t.encode("utf-8", "ignore").decode())


@settings(max_examples=400, deadline=None)
@given(odd)
def test_cuts_give_the_whole_texts_tokens(libraries, aligner, text):
    at, n = aligner.places([text.encode()])
    left, right = tokens(libraries, text)
    groups, links = groups_and_links(left, right)
    good = bool(text) and aligner.valid[at].all()
    assert good == bool(left)
    if good:
        assert b"".join(aligner.groups[k] for k in at)[:-1].decode() == ";".join(groups)
        assert aligner.stats[at].sum(axis=0).tolist() == [len(left), len(right), len(groups), len(links)] and n[0] == len(at)


@settings(max_examples=150, deadline=None)
@given(odd.filter(lambda t: len(t) > 2), st.data())
def test_fragments_compose_in_any_order(libraries, aligner, text, data):
    left, right = tokens(libraries, text)
    whole = b" " + text.encode()
    if not left:
        assert not aligner.fragment(whole, 0, 0, len(whole))[1]
        return
    edges = [0, *sorted(data.draw(st.sets(st.integers(1, len(whole) - 1), max_size=6))), len(whole)]
    parts = [aligner.fragment(whole, 0, a, b)[0] for a, b in zip(edges, edges[1:])]
    groups, links = groups_and_links(left, right)
    while len(parts) > 1:
        k = data.draw(st.integers(0, len(parts) - 2))
        parts[k : k + 2] = [aligner.compose(*parts[k : k + 2])]
    f = aligner.compose(NOTHING, parts[0])
    assert (f.groups[:-1].decode(), f.n_groups, f.n_links, f.n_a, f.n_b) == (";".join(groups), len(groups), len(links), len(left), len(right))
    assert not len(f.suffix[0]) and not len(f.suffix[1]) and dict(zip(f.codes.tolist(), f.times.tolist())) == Counter(a * aligner.n_b + b for a, b in links)


def test_query_matches_brute_force(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(token_alignment.op12_token_alignment(spark, sf)) == by_hand(libraries, rows)


@pytest.mark.parametrize("max_pairs", [2_000_000, 40])
def test_long_and_odd_texts(spark, libraries, monkeypatch, max_pairs):
    monkeypatch.setattr(token_alignment, "LONG_BYTES", 300)
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 50)
    rng = random.Random(4)
    words = ["Haus", "straße", "don't", "1999,", "日本語テキスト", "été", "\n\n", "x" * 20, "ﬁn", "  "]
    texts = [None, "", " ", "▁ not valid", "z" * 400, ("long▁ " * 100), *[" ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 400]))) for _ in range(30)]]
    rows = [*enumerate(texts), (3, "again"), (None, "no id"), (8, texts[8]), (8, texts[8])]
    docs = spark.createDataFrame([(*r, "b", 1, b"c", 2) for r in rows], DOCS).repartition(3)
    got = token_alignment.token_alignment(docs, keep_groups=True, max_pairs=max_pairs)
    assert rows_of(got) == by_hand(libraries, rows)
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got.collect() if r["groups_sha256"])


def test_empty_table(spark):
    assert token_alignment.token_alignment(spark.createDataFrame([], DOCS)).count() == 0
