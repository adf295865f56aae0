import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldloom.llm import token_files
from fieldloom.llm.shared import scratch_path
from fieldloom.llm.token_files import TokenFile, WordEncoder, Writer

DOCS = "doc_id long, text string, ids binary, path string, tie long, `a.b` int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.vocabulary_path())


@pytest.fixture(scope="module")
def words(library):
    return WordEncoder(library.to_str())


def library_ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


odd = st.lists(st.sampled_from(["<|endoftext|>", "<|EndOfText|>", "don't", "'s", "İI.", "ǅ,", "ſt!", "é", "́", "Σας Σ", " ", "　", "\x1c", "\x85", " ", "3.14", "½", "...", "?!x", "ﬁ", "𝒳", "H\u0331.", "J\u030c", "I\u0307,", "ẞ?", "ŉ:", "×.", "a.,", "\".", "\n\n", " ", "Abc,", "abc;"]) | st.text(max_size=4), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(odd)
def test_words_give_the_librarys_ids(library, words, text):
    ids, n = words.encode([b"", text.encode("utf-8", "ignore"), b"x"], 1)
    assert n[0] == 1 and n.sum() == len(ids) and ids[1 : n[1]].astype("<u4").tobytes() == library_ids(library, text.encode("utf-8", "ignore").decode())


@settings(max_examples=100, deadline=None)
@given(st.lists(odd, max_size=200))
def test_new_words_go_through_the_library_together(library, texts):
    """Words that are joined keep their own ids, and the library gets few texts."""
    sent = []

    class Counted:
        def __getattr__(self, name):
            return lambda texts, **options: sent.append(len(texts)) or getattr(library, name)(texts, **options)

    words = WordEncoder(library.to_str())
    words.library = Counted()
    new = list(dict.fromkeys(w.decode() for t in texts for w in t.encode("utf-8", "ignore").split()))
    words.learn(new)
    assert {w: np.frombuffer(x, words.kind).astype("<u4").tobytes() for w, x in words.known.items()} == {w: library_ids(library, w) for w in new}
    assert sum(sent) <= len(new) // token_files.JOINED + 1 + sum("<|" in w for w in new)


def test_words_of_plain_letters_need_no_pattern(library):
    """They go through the tokenizer without normalizer and pattern, marks behind a word are words; ids stay the library's."""
    sent = []

    class Counted:
        def __getattr__(self, name):
            return lambda texts, **options: sent.extend(texts) or getattr(library, name)(texts, **options)

    words, rng = WordEncoder(library.to_str()), random.Random(3)
    words.library = Counted()
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    plain = ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(3000)]
    marked = [w + "".join(rng.choices("!\"#$%&()*+,-./:;=?@[]\\^_`{}~'<>|", k=3)) for w in plain]
    got = lambda text: words.encode([text.encode()], 1)[0][:-1].astype("<u4").tobytes()
    assert got(" ".join(plain)) == library_ids(library, " ".join(plain)) and not sent
    for text in (" ".join(marked), "a$$$ b_ \u00e9\u00e9*** 12%, x<| y|> it's, 'd' rock'n'", "A### <|endoftext|> B~~~\n<|startoftext|>c&"):
        assert got(text) == library_ids(library, text)
    assert token_files.plain_tokenizer(library.to_str().replace("'ll|", "")) is None


@pytest.mark.parametrize("frame_bytes", [40, 1 << 18])
def test_files_are_seekable_zstandard(frame_bytes):
    rng = random.Random(1)
    docs = [(i, np.array([rng.randrange(50000) for _ in range(rng.choice([0, 1, 5, 60]))], "<u4").tobytes()) for i in [None, None, -5, 3, 3, *range(4, 60)]]
    out = io.BytesIO()
    writer = Writer(out, frame_bytes)
    for d in docs:
        writer.add(*d)
    writer.close()
    raw = out.getvalue()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == b"".join(x for _, x in docs) and writer.written == len(raw)
    f = TokenFile(io.BytesIO(raw), len(raw))
    assert [(f.doc_id(r), x) for r, x in f.documents()] == docs and list(f.rows_of(3)) == [3, 4]
    f.read = 0
    assert [x for _, x in f.documents(f.rows_of(20))] == [docs[21][1]] and f.read <= 1 + len(docs[21][1]) // frame_bytes + 1
    if frame_bytes == 40:
        assert len(f.frames) > 20
    broken = bytearray(raw)
    broken[30] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(TokenFile(io.BytesIO(bytes(broken)), len(raw)).documents())


def by_hand(library, rows):
    out, start = [], 0
    for i, ids in sorted(((i, library_ids(library, t) + b"\1\0\0\0") for i, t in rows), key=lambda r: r[0]):
        out.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_query_matches_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, token_files.op11_token_files(spark, sf).collect()))
    assert got == by_hand(library, rows) and len(got) == len(rows)


def test_many_files_lookups_and_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "SMALL_FILE", 1)
    rng = random.Random(2)
    texts = [None, "", " \n", "x" * 5000, "word " * 40000, *[" ".join(rng.choice(["Le", "au,", "été.", "don't", "1999"]) for _ in range(rng.randrange(60))) for _ in range(200)]]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    more = [(None, "no id"), (9, "again"), (9, "again"), (9, "other"), *[(30, f"one id {k}") for k in range(100)]]
    docs = spark.createDataFrame([(*r, b"x", "p", 1, 2) for r in rows + more], DOCS).repartition(5)
    files = token_files.write_tokens(docs, scratch_path(spark), frame_bytes=4096)
    assert files.count() == 4
    got = token_files.read_tokens(files).orderBy(F.col("start")).collect()
    assert [r["doc_id"] for r in got] == sorted([r["doc_id"] for r in got], key=lambda i: (i is not None, i or 0)) and len(got) == len(rows + more)
    starts = np.cumsum([0] + [len(r["ids"]) // 4 for r in got])
    assert [r["start"] for r in got] == list(starts[:-1])
    pairs = lambda found: sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in found)
    want = sorted((i is not None, i or 0, library_ids(library, t) + b"\1\0\0\0") for i, t in rows + more)
    assert pairs(got) == want
    asked = spark.createDataFrame([(9,), (12,), (30,), (30,), (33,), (-1,), (10**9,), (None,)], "doc_id long")
    assert pairs(token_files.look_up(files, asked).collect()) == [w for w in want if w[0] and w[1] in (9, 12, 30, 33)]
    nothing = token_files.write_tokens(docs.limit(0), scratch_path(spark))
    assert token_files.read_tokens(nothing).count() == 0 and token_files.look_up(nothing, asked).count() == 0
