"""Byte-level BPE by prefix tables against the library, and round trips."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tillstream.llm.catalogue import QUERIES
from tillstream.llm.prefixes import Codec, LiveText, PrefixTable, Vocabulary, bpe_decode, bpe_encode

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "abcdeginrst 's 't're'LL'll \n\t\x0b\x1c\x85  ÀßΣςİ日本ñ123४½²!?.,-$%&*()🙂👍🏽éﬁⅧ‍՘ᲉꟋ"


def library_of(rank):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


@pytest.fixture(scope="module")
def library(codec):
    return library_of(codec.vocabulary.rank)


def odd_texts(n=3000):
    pick = random.Random(5)
    texts = ["".join(pick.choice(ODD) for _ in range(pick.randrange(80))) for _ in range(n)]
    texts += ["".join(pick.choice("abcdefghiklmnoprstuvy") for _ in range(pick.randrange(90))) for _ in range(n)]
    return texts + ["", "'", "a  ", " \n ", "ab" * 3000, "x" * 200_000, " " * 5000 + "a", "<|endoftext|>", "\x00"]


def test_encodes_as_the_library(codec, library):
    texts = odd_texts()
    assert [x.tolist() for x in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_as_the_library(codec, library):
    points = [*range(0x250), *range(0x250, 0xD800, 3), *range(0xE000, 0x110000, 17)]
    texts = ["".join(f"a{chr(p)}1 {chr(p)}b" for p in points[i : i + 5000]) for i in range(0, len(points), 5000)]
    assert [x.tolist() for x in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_ranks_that_do_not_rise(tmp_path):
    """Random vocabularies: some tokens have a lower rank than their parts, some cannot
    be built at all."""
    pick = random.Random(8)
    for number in range(30):
        names = [bytes([b]) for b in range(256)]
        while len(names) < 330:
            name = bytes(pick.choice(b"abc") for _ in range(pick.randrange(2, 7)))
            if name not in names:
                names.append(name)
        path = tmp_path / f"{number}.tiktoken"
        path.write_bytes(b"\n".join(base64.b64encode(x) + b" %d" % i for i, x in enumerate(names)))
        codec = Codec(str(path))
        library = library_of(codec.vocabulary.rank)
        texts = ["".join(pick.choice("abc") for _ in range(pick.randrange(40))) for _ in range(200)]
        assert [x.tolist() for x in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_tables_hold_every_prefix_and_survive_edits(codec):
    pick = random.Random(2)

    def some(n):
        return bytes(pick.choice(b"abcdeghilnoprst") for _ in range(n))

    worked = 0
    for _ in range(60):
        table = PrefixTable(codec.vocabulary, some(600))
        at = pick.randrange(500)
        worked += table.edit(at, at + pick.randrange(6), some(pick.randrange(6)))
        table.append(some(5))
        assert table.last == PrefixTable(codec.vocabulary, table.data).last
        end = pick.randrange(len(table.data))
        assert table.ids(end) == PrefixTable(codec.vocabulary, table.data[:end]).ids()
    assert worked < 60 * 80  # near the edits only


def test_edited_texts_are_encoded_as_new_ones(codec, library):
    pick, anew = random.Random(4), 0
    for _ in range(60):
        text = "".join(pick.choice(ODD + "  ''") for _ in range(pick.randrange(800)))
        live = LiveText(codec, text)
        for _ in range(10):
            begin = pick.randrange(len(live.text) + 1)
            end = min(len(live.text), begin + pick.randrange(6))
            anew += live.edit(begin, end, "".join(pick.choice(ODD + "  ''") for _ in range(pick.randrange(6))))
            assert live.tokens() == library.encode_ordinary(live.text)
    assert anew < 600 * 40


def test_frames_round_trip(spark, codec, library):
    texts = odd_texts(200)
    data = [*enumerate(texts), (1, texts[1]), (None, "a b"), (None, None), (5, None)]
    frame = spark.createDataFrame(data, "doc_id int, text string").withColumns(
        {"IDS": F.lit(1), "data": F.lit("x"), "key": F.lit(2)}
    )
    coded = bpe_encode(frame.repartition(3), PATH)
    assert coded.dtypes == [("doc_id", "int"), ("ids", "array<int>")]
    back = bpe_decode(coded, PATH).collect()
    want = Counter((k, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for k, t in data)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.data)) for r in back) == want
    assert bpe_encode(frame.limit(0), PATH).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.data for r in bpe_decode(none, PATH).collect()} == {1: None, 2: b""}


def test_the_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = set()
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        digests = [",".join(map(str, ids)).encode(), (r.text or "").encode()]
        want.add((r.doc_id, len(ids), *(hashlib.sha256(x).hexdigest() for x in digests)))
    got = QUERIES["op13_bpe_codes"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want
    assert isinstance(Vocabulary(PATH).longest, int)
