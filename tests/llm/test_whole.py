"""Jobs done whole: what dense clumps, short lines and odd spacing must not hide."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillstream.llm import neighbours
from tillstream.llm.catalogue import op8_line_dedup
from tillstream.llm.neighbours import near_vectors
from tillstream.llm.toxic import fit, toxicity


def clumps(spark):
    """Two dense clumps that link to each other almost everywhere, and vectors far away."""
    pick = np.random.default_rng(8)
    one, two, side = np.linalg.qr(pick.standard_normal((32, 3)))[0].T
    other = 0.955 * one + np.sqrt(1 - 0.955**2) * two
    noise = [0.025 * pick.standard_normal((40, 32)) for _ in range(2)]
    x = np.concatenate([one + noise[0], other + noise[1], pick.standard_normal((60, 32)), [side]])
    frame = spark.createDataFrame(
        [(i, [float(v) for v in row], 0) for i, row in enumerate(x)],
        "vec_id long, embedding array<double>, label int",
    )
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2.0)
    best = np.argsort(-sims[:80], axis=1)[:, : neighbours.LIST]
    assert ((best < 40) == (np.arange(80) < 40)[:, None]).all()  # no list leads across
    near = sims >= 0.93
    assert near[:40, 40:80].sum() > 100
    return frame, near


def same(got, near):
    assert [got[i].n_links for i in range(len(near))] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(len(near))] == [0] * 80 + list(range(80, len(near)))
    assert sum(r.kept for r in got.values()) == len(near) - 79


def test_dense_clumps_are_linked_across(spark):
    frame, near = clumps(spark)
    same({r.vec_id: r for r in near_vectors(frame).collect()}, near)


def test_low_recall_ends_in_an_exact_comparison(spark, monkeypatch):
    frame, near = clumps(spark)
    monkeypatch.setattr(neighbours, "TRIES", 1)
    monkeypatch.setattr(neighbours, "audited", lambda *_: 0.0)
    monkeypatch.setattr(neighbours, "links_out", lambda points, *_: points.selectExpr("cid as src", "cid as dst"))
    same({r.vec_id: r for r in near_vectors(frame).collect()}, near)


def test_short_lines_match_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    pick = random.Random(6)
    letters = "abcdefghij klmnop"
    lines = ["".join(pick.choice(letters) for _ in range(n)) for n in range(8, 40) for _ in range(6)]
    lines += [x + pick.choice(letters) for x in lines] + lines[::5]
    lines += ["All rights reserved."] * 9 + ["short", "}", " ", "1234567", "12345678", "123456789"] * 3 + [""] * 4
    pick.shuffle(lines)
    lines += [""] * (-len(lines) % 4)
    data = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(len(lines) // 4)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    group = list(range(len(lines)))
    sets = [{x[k : k + 8] for k in range(len(x) - 7)} for x in lines]
    for i, a in enumerate(sets):
        for j in range(i):
            alike = lines[i] == lines[j] or (a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]))
            if alike and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    full = [i for i, x in enumerate(lines) if x]
    firsts = {group[i]: i for i in reversed(full)}
    got = {4 * r.doc_id + r.pos: r for r in op8_line_dedup(spark, str(tmp_path)).collect()}
    assert sorted(got) == full
    assert {i for i in full if got[i].kept} == set(firsts.values())
    assert len({(got[i].component_id, group[i]) for i in full}) == len(firsts)
    cleaned = {r.doc_id: r.text for r in pipeline.dedup_lines(spark, frame, str(tmp_path)).collect()}
    for i, _ in data:
        kept = [x for p, x in enumerate(lines[4 * i : 4 * i + 4]) if not x or got[4 * i + p].kept]
        assert cleaned[i] == "\n".join(kept)


@pytest.fixture(scope="module")
def model(spark):
    pick = random.Random(9)
    words = "you are a the hello I think that was river stone amber cloud meadow copper harbour winter".split()
    plain = [" ".join(pick.choice(words) for _ in range(40)) + f" {i}" for i in range(400)]
    data = [(i, t + (" you grobnik" if i % 4 == 0 else ""), int(i % 4 == 0)) for i, t in enumerate(plain)]
    known = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    return fit(known.select("doc_id", "text"), known.select("doc_id", "toxic"))


def judged(spark, model, bad, good):
    given = spark.createDataFrame([(t, t in bad) for t in bad + good], "text string, bad boolean")
    rows = toxicity(given.withColumn("doc_id", F.lit(1)), model).collect()
    assert {r.text: r.predicted for r in rows} == {t: int(t in bad) for t in bad + good}


def test_spaced_words_are_found_among_others(spark, model):
    bad = [
        "you are a g r o b n i k", "I g r o b n i k", "y o u g r o b n i k", "you gro bn ik was",
        "g  r  o  b  n  i  k", "hello,grobnik", "hello/grobnik", "hello:grobnik", "t h e r i v e r g r 0 b n 1 k",
        "g r o bnik", "yo ugr obn ik",
    ]
    good = ["you are a the river", "hello,river", "I a you the a", "r i v e r s t o n e", "a 1 2 3 4 b", "gr o the a"]
    judged(spark, model, bad, good)


def test_length_hides_no_word(spark, model):
    bad = [
        "grobn" + "i" * 60 + "k", "_".join(["hello", "river", "stone", "amber", "you", "grobnik", "winter", "cloud"]),
        " ".join("helloriverstoneamberhelloriverstoneamberyougrobnikwinter"),
        "-".join(["river"] * 3000 + ["gr0bnik"]),
    ]
    good = ["x" * 5000, "_".join(["hello", "river", "stone", "amber", "you", "winter", "cloud"]), "r i v e r " * 40]
    judged(spark, model, bad, good)


def test_a_text_of_a_million_equal_lines(spark):
    """Lines are taken out of one text in time that grows with its length alone."""
    import time

    from tillstream.llm.lines import without_duplicate_lines

    many = spark.range(1).select(
        F.lit(1).cast("long").alias("doc_id"), F.repeat(F.lit("the same line\n"), 1_000_000).alias("text")
    )
    began = time.time()
    (row,) = without_duplicate_lines(many).collect()
    assert row.text == "the same line\n"
    assert time.time() - began < 120
