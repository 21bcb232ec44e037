"""Near-duplicates, vectors, components, quality and the pipeline against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import near_dedup as N, quality as Q, vector_dedup as V
from newsflow.llm.components import components

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def groups(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(200, i) for i in range(201, 260)]
    df = spark.createDataFrame(links + [(5, 5), (None, 3)], "l long, r long")
    got = {r["node"]: r["component"] for r in components(df, "l", "r").collect()}
    want = groups(range(300), links)
    assert got == {n: want[n] for n in {x for a, b in links if a != b for x in (a, b)}}
    assert components(df.filter("l is null"), "l", "r").collect() == []


def shingles(text, size=5):
    words = BLANKS.findall(text or "")
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def probability_jaccard(a, b):
    names = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in names) for i in set(a) & set(b))


def test_probability_jaccard_and_its_estimate():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    for _ in range(40):
        a, b = (Counter({int(i): int(rng.integers(1, 4)) for i in range(20) if rng.random() < 0.7}) for _ in range(2))
        flat = [(np.array(sorted(x), dtype=np.uint64), np.array([float(x[i]) for i in sorted(x)])) for x in (a, b)]
        assert math.isclose(N.probability_jaccard(*flat), probability_jaccard(a, b), rel_tol=1e-12)
    x = " ".join(f"w{i}" for i in range(300)) + " a b c d e" * 20
    y = " ".join(f"w{i}" for i in range(30, 300)) + " a b c d e" * 9
    found = N.Shingles(pa.array([x, y, "one", "", x]))
    marks = N.signatures(found, 4096)
    assert abs((marks[0] == marks[1]).mean() - probability_jaccard(shingles(x), shingles(y))) < 4 / math.sqrt(4096)
    assert (marks[0] == marks[4]).all() and len(set(marks[2].tolist())) == 1 and not marks[3].any()


def near_texts():
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        base = words(rng.randint(40, 300))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
        texts += ["\n".join(base)] * rng.randint(0, 3)
    chain = words(200)
    for step in range(10):
        texts.append(" ".join([f"c{step}_{i}" if i < 6 * step else w for i, w in enumerate(chain)]))
    return texts + ["a b c", "a  b c", "a b d", "", " ", None, None, "solo", "line " * 200, "line " * 90]


@pytest.mark.parametrize("group", [1024, 4])
def test_near_duplicates(spark, group):
    data = list(enumerate(near_texts()))
    random.Random(3).shuffle(data)
    docs = spark.createDataFrame([(i, t, i, "x", 7) for i, t in data], "doc_id long, text string, words long, task string, n int")
    sets = {i: shingles(t) for i, t in data}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and probability_jaccard(sets[i], sets[j]) >= 0.8]
    want = groups(sets, links)
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs, group=group).collect()}
    assert got == want
    if group > 4:
        kept = N.one_per_class(docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_without_ids(spark):
    long = "one two three four five six seven"
    docs = spark.createDataFrame([(None, long), (4, long), (4, long), (None, "other words"), (9, long + " x"), (None, None)], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["class_id"]) for r in N.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(None, 4), (4, 4), (4, 4), (None, None), (9, 9), (None, None)], key=str)
    assert sorted((r["doc_id"] for r in N.one_per_class(docs).collect()), key=str) == sorted([4, 9, None, None, None], key=str)


def plain_vectors(rows, cosine=0.93):
    sound = {i: np.array(v, dtype=float) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    labels = {i: label for i, _, label in rows}
    links = [
        (a, b) for a in sound for b in sound
        if a < b and labels[a] == labels[b] and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] / math.sqrt((sound[a] @ sound[a]) * (sound[b] @ sound[b])) >= cosine
    ]
    n = Counter(x for link in links for x in link)
    return {i: (n[i], c) for i, c in groups([i for i, _, _ in rows], links).items()}


@pytest.mark.parametrize("shard", [4096, 150])
def test_vectors(spark, shard):
    rng = np.random.default_rng(4)
    centres, rows = rng.normal(size=(30, 16)), []
    for i in range(700):
        c = centres[rng.integers(0, 30)]
        spread = rng.choice([0.05, 0.2, 0.6])
        rows.append((i * 3, [float(np.float32(x)) for x in c + spread * rng.normal(size=16)], int(rng.integers(0, 2))))
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(60)]
    rows += [(6000, [0.0] * 16, 0), (6001, None, 0), (6002, [float("nan")] * 16, 0), (6003, rows[0][1], None), (6004, [1.0, None], 1), (6005, [], 1), (6006, [float("inf")] * 16, 1), (6007, [1e-30, 0.0], 1), (6008, [1e30, 0.0], 1)]
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, rep string, n int")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    want = plain_vectors(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in V.near_duplicate_vectors(df, shard=shard).collect()}
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.99 * len(got)
    for i in range(6000, 6007):
        assert got[i] == (0, i)
    assert got[6007] == (1, 6007) and got[6008] == (1, 6007)


def test_graph_recall_and_widening():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(3000, 32))
    vectors[:400] = vectors[0] + 0.05 * rng.normal(size=(400, 32))
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    graph = V.Graph.build(unit)
    truth = unit @ unit.T >= 0.93
    found = V.linked(graph, unit, 0.93)
    assert (found & truth).sum() >= 0.99 * truth.sum()
    assert not (found & (unit @ unit.T < 0.929)).any()


def test_empty_tables(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert V.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.classify(spark.createDataFrame([], "doc_id long, text string, lang string"), labels).collect() == []


def kneser_ney(texts, common):
    """Log10 probabilities of a plain interpolated modified Kneser-Ney trigram model."""
    shape = lambda w: "~" + re.sub(r"(.)\1+", r"\1", "".join("A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if c.isdigit() else c for c in w))
    token = lambda w: w if w in common else shape(w)
    sents = [[token(w) for w in BLANKS.findall(t or "")] + ["</s>"] for t in texts]
    three = Counter(g for s in sents for g in zip(["<s>", "<s>", *s], ["<s>", *s], s))
    two = Counter((v, w) for _, v, w in three)
    one = Counter(w for _, w in two)

    def discounts(counts):
        n = Counter(counts.values())
        if not n[1] or not n[2]:
            return lambda c: 0.5
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
        return lambda c: d[min(c, 3) - 1]

    d3, d2, d1 = map(discounts, (three, two, one))
    left1, total1 = sum(map(d1, one.values())), sum(one.values())
    p1 = lambda w: (one[w] - d1(one[w]) if w in one else 0) / total1 + left1 / total1 / (len(one) + 1)
    def below(counts, discount, context):
        rows = [c for g, c in counts.items() if g[:-1] == context]
        return (sum(rows), sum(map(discount, rows))) if rows else (0, 0)
    def p2(v, w):
        total, left = below(two, d2, (v,))
        return p1(w) if not total else ((two[v, w] - d2(two[v, w]) if (v, w) in two else 0) + left * p1(w)) / total
    def p3(u, v, w):
        total, left = below(three, d3, (u, v))
        return p2(v, w) if not total else ((three[u, v, w] - d3(three[u, v, w]) if (u, v, w) in three else 0) + left * p2(v, w)) / total
    def score(text):
        s = [token(w) for w in BLANKS.findall(text or "")] + ["</s>"]
        return len(s), sum(math.log10(p3(u, v, w)) for u, v, w in zip(["<s>", "<s>", *s], ["<s>", *s], s))
    return score


def test_kneser_ney_equals_a_plain_model(spark):
    rng = random.Random(5)
    words = ["the", "cat", "Sat", "on", "mat7", "été", "!"]
    texts = [" ".join(rng.choices(words, weights=[9, 7, 5, 4, 3, 2, 1], k=rng.randint(0, 25))) + (f" Rare{i}x" if i % 5 == 0 else "") for i in range(40)]
    sample = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tests = texts[:8] + [None, "", "NEW!! cat", "the the the the"]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(tests)], "doc_id long, text string, extra int")
    got = {r["doc_id"]: r for r in Q.with_scores(docs, Q.train(sample)).collect()}
    count = Counter(w for t in texts for w in BLANKS.findall(t))
    score = kneser_ney(texts, {w for w, n in count.items() if n > 1})
    for i, t in enumerate(tests):
        n, total = score(t)
        assert got[i]["n_tokens"] == n and math.isclose(got[i]["log10_prob"], total, rel_tol=1e-6), t


def test_kneser_ney_in_many_blocks_and_shards(spark, monkeypatch):
    """The same model when words, bigrams and trigrams are dealt over 128 shards."""
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("the", "Cat", "été", "9") for b in ("", "s", "!", "-x", "7")]
    texts = [" ".join(rng.choices(words, weights=range(20, 0, -1), k=rng.randint(0, 40))) + (f" Rare{i}x" if i % 5 == 0 else "") for i in range(60)]
    monkeypatch.setattr(Q, "BLOCK_TEXT", 400)
    # Of an id that comes twice, the shorter text counts.
    sample = spark.createDataFrame([*enumerate(texts), (3, texts[3] + " the the the the")], "id long, text string")
    model = Q.train(sample, size=1 << 30)
    assert model.bits == 7 and model.tables.select("part").distinct().count() > 50
    tests = [*texts[:20], None, "", "NEW!! cat", "the the the the", texts[0]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "block long, text string")
    got = {r["block"]: r for r in Q.with_scores(docs, model).collect()}
    score = kneser_ney(texts, {w for w, n in Counter(w for t in texts for w in BLANKS.findall(t)).items() if n > 1})
    assert len(got) == len(tests)
    for i, t in enumerate(tests):
        n, total = score(t)
        assert got[i]["n_tokens"] == n and math.isclose(got[i]["log10_prob"], total, rel_tol=1e-9), t


def test_all_trusted_documents_are_learnt_from(spark):
    """More documents than a sample of 8,000 had, each with words that no other one has."""
    docs = spark.range(13_000).selectExpr("id AS doc_id", "concat('a', id, ' b', id, ' a', id, ' b', id) AS text", "'en' AS lang")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    learnt = Q.classify(docs, labels).filter("pmod(xxhash64(doc_id), 4) != 0").agg(F.count("*").alias("n"), F.min("perplexity").alias("low"), F.max("perplexity").alias("high")).first()
    assert learnt["n"] > 9_000 and learnt["high"] < 1.01 * learnt["low"]


def test_only_texts_of_trusted_ids_travel_and_count(spark):
    """The filter keeps the listed ids and few others, which the blocks then leave out."""
    rng = random.Random(7)
    prose = lambda: " ".join(rng.choices(["the", "cat", "Sat", "on", "mat7", "été", "!"], weights=[9, 7, 5, 4, 3, 2, 1], k=8))
    rows = [(i, prose()) for i in range(4000)] + [(None, "not listed"), (3, "the"), (6, None)]
    sample = spark.createDataFrame(rows, "id long, text string")
    ids = spark.range(0, 4000, 3)
    kept = [r["id"] for r in Q.likely(sample, ids, ids.count()).collect()]
    assert {*range(0, 4000, 3)} <= {*kept} and len(kept) < 1336 + 200
    test = spark.createDataFrame([(1, "the cat Sat on mat7 été ! not listed")], "doc_id long, text string")
    got = [Q.with_scores(test, m).first()["log10_prob"] for m in (Q.train(sample, 0, ids), Q.train(sample.filter("id % 3 = 0")))]
    assert got[0] == got[1]
    assert Q.train(sample, 0, ids.limit(0)) is None


def test_scoring_leaves_no_shuffled_texts_behind(spark, monkeypatch):
    """Texts go to blocks in turns; what a turn shuffled is deleted when it ends."""
    import time
    from pathlib import Path

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    on_disk = lambda: sum(f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data") if f.exists())
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), x -> sha2(concat(id, '-', x), 256))) AS text", "'en' AS lang")
    labels = docs.filter("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"))
    size = 3000 * 40 * 65
    monkeypatch.setattr(Q, "BLOCK_TEXT", size // 7)
    before = on_disk()
    found = Q.classify(docs, labels)
    for _ in range(20):
        if on_disk() - before < size // 8:
            break
        time.sleep(0.5)
    assert on_disk() - before < size // 8
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == found.count() == 3000
    # One block in one turn gives the same.
    monkeypatch.setattr(Q, "BLOCK_TEXT", 2 * size)
    assert all(abs(r["log10_prob"] - rows[r["doc_id"]]["log10_prob"]) < 1e-9 for r in Q.classify(docs, labels).collect())


def test_quality_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept = Q.classify(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()
    share = {r["quality"]: r["k"] for r in kept}
    assert share[1] >= 0.98 and share[0] <= 0.4
    assert Q.good_documents(docs, labels).columns == docs.columns
    nothing = labels.limit(0)
    assert Q.good_documents(docs, nothing).count() == docs.count()


def trusted_ids(spark, n):
    """Ids outside the held quarter in the order in which the sample takes them."""
    rows = spark.range(1000).filter("pmod(xxhash64(id), 4) != 0").orderBy(F.xxhash64("id"), "id").limit(n).collect()
    return [r[0] for r in rows]


def test_long_documents_do_not_end_the_sample(spark):
    ids = trusted_ids(spark, 42)
    short = {i: f"short text number {i}" for i in ids[2:]}
    rows = [(ids[0], "é word " * 2000), (ids[1], "x" * 9000), *short.items(), (ids[5], "another and longer text"), (ids[6], short[ids[6]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    took = [(r["id"], r["text"]) for r in Q.trusted_sample(docs, labels, "doc_id", "text", "quality", 100, 4000).collect()]
    found = dict(took)
    assert len(took) == len(found) == 42 and {i: found[i] for i in short} == short
    for i in ids[:2]:
        assert rows[ids.index(i)][1].startswith(found[i]) and 1000 < len(found[i].encode()) < 2000
    assert found[ids[0]].endswith("é") or found[ids[0]].endswith("word")
    assert sum(len(t.encode()) for t in found.values()) <= 4000
    whole = dict(map(tuple, Q.trusted_sample(docs, labels, "doc_id", "text", "quality", 100, 10**6).collect()))
    assert whole[ids[0]] == rows[0][1] and whole[ids[1]] == rows[1][1]
    few = dict(map(tuple, Q.trusted_sample(docs, labels, "doc_id", "text", "quality", 3, 4000).collect()))
    assert sorted(few) == sorted(ids[:3])
    assert [r["text"] for r in Q.trusted_sample(docs.filter(F.col("doc_id") == ids[1]), labels, "doc_id", "text", "quality", 9, 50).collect()] == ["x" * 50]


def test_a_long_document_does_not_switch_the_classifier_off(spark):
    ids = trusted_ids(spark, 60)
    held = [r[0] for r in spark.range(1000).filter("pmod(xxhash64(id), 4) = 0").limit(40).collect()]
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice("the cat sat on a mat and it was good for all of us".split()) for _ in range(n))
    rows = [(ids[0], prose(9000), "en")] + [(i, prose(60), "en") for i in ids[1:] + held] + [(5000 + i, " ".join("#%d@!" % rng.randrange(10**9) for _ in range(60)), "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in ids + held], "doc_id long, quality int")
    kept = {r["doc_id"] for r in Q.classify(docs, labels, max_bytes=20_000).filter("keep").collect()}
    assert not kept & set(range(5000, 5005)) and len(kept) >= 95
    with pytest.warns(UserWarning, match="held quarter"):
        assert Q.classify(docs, labels.filter(F.col("doc_id").isin(held))).filter("keep").count() == len(rows)


def test_pipeline(spark):
    import corpus_pipeline as C

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in C.STAGES:
        out = stage(spark, left, sf).cache()
        if stage is not C.STAGES[-1][1]:
            assert out.columns == docs.columns, name
            assert 0 < out.count() <= left.count()
            left = out
    assert out.filter("not exact").count() == 0
    assert {r[0] for r in C.run(spark, sf).select("doc_id").collect()} == {r[0] for r in left.select("doc_id").collect()}


def test_pipeline_with_extra_columns_and_empty_table(spark):
    import corpus_pipeline as C

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({c: F.lit(1) for c in ("words", "n", "block", "bag", "row", "n_tokens", "keep", "level", "ids", "label", "hash", "base", "_row")})
    for start in (docs, docs.limit(0)):
        left = start
        for _, stage in C.STAGES:
            left = stage(spark, left, sf)
        left.count()
