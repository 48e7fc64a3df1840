"""The corpus operators against brute force on small tables with awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tillstream.llm import common, expected, urls
from tillstream.llm import mix as mix_module
from tillstream.llm import pack as pack_module
from tillstream.llm.catalogue import DOMAINS, LANGUAGES, SOURCES, mixed, tokenizer
from tillstream.llm.components import components
from tillstream.llm.exact import exact_groups
from tillstream.llm.lines import duplicate_lines, without_duplicate_lines
from tillstream.llm.mix import mix_sources
from tillstream.llm.neighbours import near_vectors
from tillstream.llm.pack import pack
from tillstream.llm.shards import shuffled_shards
from tillstream.llm.simhash import simhash_groups
from tillstream.llm.tokens import token_counts
from tillstream.llm.toxic import fit, toxicity
from tillstream.llm.urls import judge_urls, labelled_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, kept int"
WORDS = "river stone amber cloud meadow lantern copper violet harbour winter".split()


def sentences(seed, n=400):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(500)) for _ in range(n))


def rows():
    """Null and repeated ids, null, empty, equal, similar and long texts, clashing names."""
    base = sentences(1)
    texts = [
        (1, base), (2, base), (3, base.replace("river", "river ", 1)), (4, base + " tail"),
        (5, None), (6, ""), (7, " \t\n"), (8, "one"), (None, "two words"), (None, None),
        (9, sentences(2, 20_000)), (10, "Ünï ÇØDE  's it\u2019s 漢字 🙂"), (10, sentences(3)),
        (10, sentences(3)), (11, "x" * 5000), (12, "a<|endoftext|>b"), (13, "\x1c\x1f \u00a0z"),
    ]
    texts += [(20 + i, base) for i in range(30)]
    return [
        (i, t, "en" if n % 3 else None, f"src{n % 4}" if n % 5 else None, None, "mine", 7)
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)]
    edges += [(300, 300), (None, 5), (7, 3), (3, 7), (-4, 110)]
    union = Union()
    for a, b in edges:
        if a is not None and a != b:
            union.join(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {n: union.find(n) for n in list(union)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_exact_groups_match_sql(docs):
    got = exact_groups(docs).collect()
    clean = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows()]
    size = Counter(t for _, t in clean)
    assert sorted(r.group_size for r in got) == sorted(size[t] for _, t in clean)
    assert sum(r.kept for r in got) == len(size)
    first = {t: min((i for i, u in clean if u == t and i is not None), default=None) for t in size}
    assert Counter((r.doc_id, r.keep_id) for r in got) == Counter((i, first[t]) for i, t in clean)


def test_shards_are_even_gapless_and_whole(docs):
    got = shuffled_shards(docs, 5, bucket_bytes=4096)
    assert Counter(map(str, got.select(*[c for c in docs.columns if c != "slot"]).collect())) == Counter(
        map(str, docs.drop("slot").collect())
    )
    places = defaultdict(list)
    for r in got.collect():
        places[r.shard].append(r.slot)
    sizes = [len(v) for v in places.values()]
    assert max(sizes) - min(sizes) <= 1 and set(places) == set(range(5))
    assert all(sorted(v) == list(range(len(v))) for v in places.values())


def test_shards_do_not_keep_the_order(spark):
    many = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = [r.doc_id for r in shuffled_shards(many, 2).orderBy("shard", "slot").collect()]
    assert sorted(got) == list(range(2000))
    rises = sum(a < b for a, b in zip(got, got[1:], strict=False))
    assert 900 < rises < 1100


@pytest.mark.parametrize(("leaf_bytes", "hot"), [(32 << 20, 1000), (0, 8), (0, 1)])
def test_mix_matches_sql(spark, docs, monkeypatch, leaf_bytes, hot):
    """With all leaves sent to every task, with only the larger ones, and with none."""
    monkeypatch.setattr(mix_module, "BROADCAST_BYTES", leaf_bytes)
    monkeypatch.setattr(mix_module, "HOT_LEAVES", hot)
    frame = docs.select("doc_id", "text", "lang", "source").toPandas()
    frame = frame[frame.doc_id.notna()].drop_duplicates()
    frame["doc_id"] = frame["doc_id"].astype("int64")
    db = duckdb.connect()
    db.register("documents", frame)
    want = Counter(db.sql(f"SELECT doc_id, tokens, epoch FROM ({expected.MIX})").fetchall())
    given = spark.createDataFrame(
        [tuple(None if x != x else x for x in r) for r in frame.itertuples(index=False)],
        "doc_id long, text string, lang string, source string",
    )
    got = Counter((r.doc_id, r.tokens, r.epoch) for r in mixed(given).collect())
    assert got == want


def test_a_short_subtree_is_made_up_for_by_its_siblings_first(spark):
    data = [(i, "w " * 10, d, s) for i, (d, s) in enumerate(
        [("a", "a1")] * 2 + [("a", "a2")] * 50 + [("b", "b1")] * 50)]
    given = spark.createDataFrame(data, "doc_id long, text string, d string, s string")
    tree = [("d", F.col("d")), ("s", F.col("s"))]
    got = mix_sources(given, tree, [{"": 1}, {"": 1}], (40, 102), max_epochs=1).collect()
    taken = Counter()
    for r in got:
        taken[r.s] += r.tokens
    # 400 tokens: 200 a domain; a1 has 20 of its 100, a2 takes the other 180.
    assert taken == {"a1": 20, "a2": 180, "b1": 200}


def test_simhash_components_match_brute_force(docs):
    from xxhash import xxh64_intdigest

    def fingerprint(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(r[1]) for r in rows()]
    union = Union()
    for a, x in enumerate(prints):
        for b in range(a):
            if (x ^ prints[b]).bit_count() <= 3:
                union.join(a, b)
    ids = [r[0] for r in rows()]
    least = defaultdict(list)
    for n, i in enumerate(ids):
        least[union.find(n)].append(i)
    want = Counter(
        (i, f"{prints[n]:016x}", min((x for x in least[union.find(n)] if x is not None), default=None))
        for n, i in enumerate(ids)
    )
    got = simhash_groups(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_simhash_tree_loses_no_pair(spark):
    from tillstream.llm.simhash import Tree, link_near, near_edges

    pick = np.random.default_rng(3)
    centres = pick.integers(0, 1 << 63, size=300, dtype=np.uint64)
    flips = [c ^ np.uint64(sum(1 << int(b) for b in pick.choice(64, pick.integers(0, 6), False)))
             for c in centres for _ in range(20)]
    points = np.unique(np.concatenate([centres, np.array(flips, dtype=np.uint64)]))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    union = Union()
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        union.join(int(i), int(j))
    want = [union.find(i) for i in range(len(points))]
    assert link_near(points, np.ones(len(points), bool), 3).tolist() == want
    tree = Tree(points[::7], 40, 3)
    homes = Counter(int(i) for _, index, home in tree.route(points) if home for i in index)
    assert tree.leaves > 10 and homes == Counter(range(len(points)))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    spot = {int(p): i for i, p in enumerate(points.view(np.int64))}
    joined = Union()
    for r in near_edges(frame, len(points)).collect():
        joined.join(spot[r.src], spot[r.dst])
    assert [joined.find(i) for i in range(len(points))] == want


def test_texts_are_packed_in_batches_of_bounded_bytes(spark, monkeypatch):
    bound, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []

    def sizes(path):
        def run(batches):
            for batch in batches:
                rows, none = batch.num_rows, [0] * batch.num_rows
                ids = [b"\0\0\0\0" * batch.column("text").nbytes] + [b""] * (rows - 1)
                columns = [batch.column("key"), pa.array(none, pa.int32()), pa.array(none, pa.int64()),
                           pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "part", "before", "doc_tokens", "ids"])

        return run

    def kept(rows, keep=pack_module.kept_safe):
        held = keep(rows)
        seen.append(max(r["doc_tokens"] for r in held.collect()) if "ids" in rows.columns else 0)
        return held

    monkeypatch.setattr(pack_module, "_encoded", sizes)
    monkeypatch.setattr(pack_module, "kept_safe", kept)
    texts = spark.range(0, 600, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("abcdefgh"), 2500).alias("text")
    )
    pack(texts, "", with_ids=False)
    assert 20_000 < seen[0] < 2 * pack_module.BATCH_BYTES  # of 12 MB, 600 rows
    assert spark.conf.get(bound, None) is None
    with common.arrow_batches(spark, 1), common.arrow_batches(spark, 2):
        assert spark.conf.get(bound) == "1"


def test_mix_budget_starts_no_python(spark, docs, monkeypatch):
    rows = mixed(docs).count()

    def none(*args, **kwargs):
        raise AssertionError("rows of a local list go through Python workers")

    monkeypatch.setattr(type(spark), "createDataFrame", none)
    assert mixed(docs).count() == rows > 0


def test_packed_pieces_hold_every_id_once(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = Counter(
        (i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2])) for i, t, *_ in rows()
    )
    pieces = pack(docs, tokenizer("word_bpe_49k.json"), width=64).collect()
    stream = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at, got, held = 0, Counter(), []
    for r in stream:
        assert r.sequence_id * 64 + r.offset == at and r.offset + r.length <= 64
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert r.start == len(held)
        at += r.length
        held += np.frombuffer(bytes(r.ids), "<u4").tolist()
        if len(held) == r.doc_tokens:
            got[r.doc_id, tuple(held)] += 1
            held = []
    assert got == want and not held


ODD = "abcdeginrst 's 't're'LL \n\t\x0b\x1c\x85\u00a0\u2003ÀßΣςİ日本ñ123४½²!?.,-$%&*()🙂👍🏽e\u0301\ufb01Ⅷ\u200d"


def test_compiled_vocabularies_equal_the_library(spark):
    from tokenizers import Tokenizer
    from tillstream.llm.pack import WordIds

    pick = random.Random(5)
    texts = ["".join(pick.choice(ODD) for _ in range(pick.randrange(80))) for _ in range(3000)]
    texts += ["", "'", "a  ", " \n ", "ab" * 3000, "x" * 2000, "a<|endoftext|>b", "<|endoftext|>" * 2]
    words = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    for text, ids in zip(texts, WordIds(tokenizer("word_bpe_49k.json")).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == words.encode(text, add_special_tokens=False).ids
    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts(frame, tokenizer("byte_bpe_50k.json"), 5).collect():
        n = len(plain.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 5, len(texts[r.doc_id].encode()))


@pytest.fixture(scope="module")
def model(spark):
    pick = random.Random(9)
    plain = [" ".join(pick.choice(WORDS) for _ in range(30)) + f" {i}" for i in range(200)]
    data = [(i, t + (" you grobnik" if i % 4 == 0 else ""), int(i % 4 == 0)) for i, t in enumerate(plain)]
    known = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    return fit(known.select("doc_id", "text"), known.select("doc_id", "toxic"))


def test_disguised_words_are_found_and_clean_texts_left_alone(spark, docs, model):
    bad = ["gr0bnik", "g r o b n i k", "GROBNIK!!", "gr.o.b.n.i.k", "grobniiiik", "a gr0bn1k b"]
    good = ["river stone", "gro", "5 stones for $10", "cloud, amber!!!", "meadow%%% violet&&&"]
    given = spark.createDataFrame([(t, t in bad) for t in bad + good], "text string, bad boolean")
    for r in toxicity(given.withColumn("doc_id", F.lit(1)), model).collect():
        assert r.predicted == int(r.bad), r.text
    scored = toxicity(docs, model).collect()
    assert len(scored) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == 0 for r in scored)


def test_without_labels_nothing_is_toxic(docs, none):
    empty = none.select("doc_id", F.lit(1).alias("toxic"))
    model = fit(none, empty)
    assert {r.predicted for r in toxicity(docs, model).collect()} == {0}


def test_vectors_match_brute_force(spark):
    pick = np.random.default_rng(4)
    base = pick.standard_normal((300, 16))
    cluster = base[0] + 0.05 * pick.standard_normal((80, 16))
    x = np.concatenate([base, cluster, base[1:40] + 0.03 * pick.standard_normal((39, 16)), base[:20]])
    data = [(i, [float(v) for v in row], i % 2 if i < 300 else 0) for i, row in enumerate(x)]
    data += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0),
             (903, [None] + [1.0] * 15, 1), (904, data[0][1], None), (905, [], 0), (None, data[0][1], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_vectors(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([d[2] for d in data[: len(x)]])
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    union = Union()
    for i, j in zip(*np.nonzero(near), strict=True):
        union.join(int(i), int(j))
    links = near.sum(1) + ((unit @ unit[0] >= 0.93) & (labels == 0))  # the null key's copy of 0
    assert {i: got[i].n_links for i in range(len(x))} == dict(enumerate(links.tolist()))
    assert {i: got[i].component_id for i in range(len(x))} == {i: union.find(i) for i in range(len(x))}
    for i in (900, 901, 902, 903, 904, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_similar_lines_match_brute_force(spark):
    pick = random.Random(2)
    lines = [sentences(i, 12) for i in range(60)]
    lines += [x.replace(x[5:8], "zq", 1) for x in lines[:30]] + lines[:10]
    lines += [x[: len(x) // 2] + x[len(x) // 3 :] for x in lines[20:40]] + ["short", ""] * 3
    pick.shuffle(lines)
    data = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(len(lines) // 4)] + [(99, None), (98, "")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    every = [x for x in lines[: 4 * (len(lines) // 4)] if x]
    sets = [{x[k : k + 8] for k in range(len(x) - 7)} for x in every]
    union = Union()
    for i, a in enumerate(sets):
        union.find(i)
        for j in range(i):
            if every[i] == every[j] or a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                union.join(i, j)
    got = duplicate_lines(frame).collect()
    assert len(got) == len(every)
    assert sum(r.kept for r in got) == len({union.find(i) for i in union})
    cleaned = {r.doc_id: r.text for r in without_duplicate_lines(frame).collect()}
    assert len(cleaned) == len(data) and cleaned[99] is None and cleaned[98] == ""
    dropped = {(r.doc_id, r.pos) for r in got if not r.kept}
    for i, text in data[:-2]:
        kept = [x for p, x in enumerate(text.split("\n")) if (i, p) not in dropped]
        assert cleaned[i] == "\n".join(kept)


def test_urls_are_split_ruled_and_judged(spark):
    given = [
        "https://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "https://x.org", "org://org/",
        "https://notexample.org.com/fr/", "https://shop.com/de/a", "https://com/fr/x", "ftp://u@h:1/p/?q",
        None, "", "no-scheme/path", "https://casino-win.example.net/en/1", "http://ththly.example.net/en/5",
        "a://b#c/d", "x://" + "long" * 5000,
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)], "page_id int, url string, host string")
    got = {r.page_id: r for r in judge_urls(pages, labelled_urls(spark)).collect()}

    def split(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]

    for i, url in enumerate(given):
        host, path = split(url)
        fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, None))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ("allow", "block") and verdict in (None, got[i].verdict)
    assert got[11].verdict == "block" and got[12].verdict == "allow"
    assert judge_urls(pages.limit(0), labelled_urls(spark)).count() == 0


def test_url_classifier_learns_its_table(spark):
    table = labelled_urls(spark)
    for r in judge_urls(table, table, rules=()).collect():
        assert (r.verdict == "block") == bool(r.label)
    with pytest.raises(ValueError):
        urls.train(spark.range(urls.LABELLED_BOUND + 1).selectExpr("'u' as url", "1 as label"))


def test_empty_tables_give_empty_results(none):
    path = tokenizer("word_bpe_49k.json")
    tree = [("lang", F.col("lang"))]
    assert exact_groups(none).count() == 0
    assert shuffled_shards(none, 4).count() == 0
    assert mix_sources(none, tree, [LANGUAGES], (1, 2)).count() == 0
    assert simhash_groups(none).count() == 0
    assert pack(none, path).count() == 0
    assert token_counts(none, tokenizer("byte_bpe_50k.json"), 5).count() == 0
    assert duplicate_lines(none).count() == 0
    assert without_duplicate_lines(none).count() == 0
    vectors = none.selectExpr("doc_id as vec_id", "array(1d) as embedding", "1 as label")
    assert near_vectors(vectors).count() == 0


def test_weights_name_a_default():
    assert all("" in level for level in (DOMAINS, LANGUAGES, SOURCES))


def test_pipeline_stages_keep_what_they_must(spark, docs, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([(1, 0), (2, 0), (8, 1)], "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    now = docs
    for number, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if number < len(pipeline.STAGES) - 1:
            assert out.columns == now.columns, name
        place = str(tmp_path / f"stage{number}")
        out.write.parquet(place)
        after = spark.read.parquet(place)
        if name == "toxicity":
            assert after.count() == now.count()
        if name == "SimHash near-dedup":
            groups = simhash_groups(now).select("doc_id", "mark", "component_id", "kept").distinct()
            assert after.count() == groups.filter("kept").count()
        now = after
    assert now.count() > 0
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "mixing", "packing"
    ]
