"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tillstream.llm.catalogue import QUERIES
from tillstream.llm.resample import bucket_counts, bucket_gains, importance_resample, word_features

WORDS = "river stone amber Cloud meadow LANTERN copper violet été 漢字 x1 42".split()


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def brute(docs, target, percent=25, buckets=10_000, least=20):
    """(key, n_features, weight, score, rank) by the definition; docs: (key, text)."""
    def counts(texts):
        out = Counter()
        for text in texts:
            out.update(zlib.crc32(f.encode()) % buckets for f in features(text))
        return out

    s, t = counts(x for _, x in docs), counts(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for key, text in docs:
        found = [zlib.crc32(f.encode()) % buckets for f in features(text)]
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
            for b in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        name = "7:" + ("" if key is None else str(key))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def rows():
    pick = random.Random(3)
    texts = [" ".join(pick.choice(WORDS) for _ in range(pick.randrange(60))) for _ in range(150)]
    texts += [None, "", " \t\n", "...", "a" * 5000, "A,b;C " * 8000, "\x00\x7f", "x'y_z"]
    texts += [texts[1]] * 40
    out = list(enumerate(texts)) + [(7, texts[7]), (7, texts[7]), (None, texts[3]), (None, None)]
    return [(k, t, 5, 0.5, "r") for k, t in out]


SCHEMA = "doc_id long, text string, Score int, weight double, row string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def collected(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_matches_brute_force(spark, docs):
    target = ["river stone 42 x1", None, "", "Cloud été 漢字 meadow " * 3]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least in ((25, 20), (100, 1), (0, 20)):
        got = importance_resample(docs, frame, percent=percent, min_words=least)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert [kind for _, kind in got.dtypes] == ["bigint"] * 5
        want = brute([(k, t) for k, t, *_ in rows()], target, percent, least=least)
        assert collected(got) == want


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert importance_resample(none, docs).count() == 0
    assert collected(importance_resample(docs, none)) == brute([(k, t) for k, t, *_ in rows()], [])


def test_equal_rows_get_each_a_rank(spark):
    same = spark.range(0, 3000, 1, 6).select(F.lit(9).cast("long").alias("doc_id"), F.lit("one two " * 15).alias("text"))
    got = importance_resample(same, same, percent=50)
    ranks = sorted(r.rank for r in got.collect() if r.rank is not None)
    assert ranks == list(range(1, 1501))


def test_features_are_those_of_each_text():
    texts = ["One two, one TWO", "", "three", "été-été"]
    found, row, n = word_features(pa.array(texts), 1 << 31)
    assert n.tolist() == [4, 0, 1, 2]
    for number, text in enumerate(texts):
        assert Counter(found[row == number].tolist()) == Counter(
            zlib.crc32(f.encode()) % (1 << 31) for f in features(text)
        )


def test_counts_and_gains(spark):
    frame = spark.createDataFrame([("a b a",), (None,), ("b",)], "text string").repartition(3)
    counts = bucket_counts(frame, 50)
    assert counts.sum() == 6 and counts[zlib.crc32(b"a") % 50] >= 2
    assert bucket_gains(np.array([1, 0]), np.array([1, 0])).tolist() == [0, 0]


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert collected(QUERIES["op11_resampling"](spark, folder)) == brute([tuple(r) for r in docs], target)
