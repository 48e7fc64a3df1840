"""Fill-in-middle against the definition over code points."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillstream.llm.middle import Fenwick, fill_in_middle, restored


def by_definition(key, text, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    p, s, m = marks
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(("7:" + ("" if key is None else str(key))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(x in text for x in marks) or h3 % 100 >= rate:
        return key, n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < spm:
        return key, n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return key, n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def rows():
    pick = random.Random(5)
    line = ["é", "漢字 ", "🙂\r", "a b", "", "x" * 300, "<", "P>", "<S"]
    texts = ["\n".join(pick.choice(line) for _ in range(pick.randrange(40))) for _ in range(200)]
    texts += [None, "", "\n", "\n\n\n", "no end", "end\n", "a<P>b\n", "<M>", "<S>\n\n", "é" * 9000, "x" * 4096 + "\n",
              "x" * 4095 + "\ny", "\n" * 20_000, "line\n" * 50_000 + "tail"]
    return [*enumerate(texts), (3, texts[3]), (3, texts[3]), (None, texts[8]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(rows(), "doc_id long, text string")
    return frame.withColumns({"N": F.lit(1), "output": F.lit("x"), "h1": F.lit(2)}).repartition(3)


@pytest.mark.parametrize(("rate", "spm", "block"), [(100, 50, 4096), (60, 0, 7), (100, 100, 64), (0, 50, 4096)])
def test_matches_the_definition(docs, rate, spm, block):
    got = fill_in_middle(docs, rate=rate, spm_rate=spm, block=block)
    assert [kind for _, kind in got.dtypes] == ["bigint", "bigint", "string", "bigint", "bigint", "string"]
    back = got.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r)[:6] for r in back) == Counter(by_definition(k, t, rate, spm) for k, t in rows())
    assert Counter((r.doc_id, r.back) for r in back) == Counter((k, t or "") for k, t in rows())


def test_other_marks_and_empty_tables(spark, docs):
    marks = ("[[a]]", "[[b]]", "[[c]]")
    got = fill_in_middle(docs, marks=marks)
    back = got.withColumn("back", restored(F.col("output"), F.col("form"), marks)).collect()
    assert Counter((r.doc_id, r.back) for r in back) == Counter((k, t or "") for k, t in rows())
    assert fill_in_middle(docs.limit(0)).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "d"), ("aba", "x", "y"), ("a", "xay", "z")):
        with pytest.raises(ValueError):
            fill_in_middle(docs, marks=bad)


def test_every_cut_of_a_tree():
    pick = np.random.default_rng(1)
    for size in (0, 1, 5, 64, 333):
        text = "".join(pick.choice(["\n", "é", "a", "漢"], size))
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        for block in (1, 3, 16, 1000):
            tree = Fenwick(raw, block)
            assert tree.n_lines == len(units)
            for n in range(len(units) + 1):
                head = "".join(units[:n])
                assert tree.cut(n) == (len(head.encode()), len(head))
