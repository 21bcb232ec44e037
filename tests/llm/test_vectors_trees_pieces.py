"""Centroid clusters, the Merkle manifest and piece BPE against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from newsflow.llm import centroids as C, manifest as M, piece_bpe as B

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- piece BPE ---------------------------------------------------------------------


def odd_texts():
    rng = random.Random(7)
    pieces = [B.load(MODEL)[0].id_to_piece(i).replace(B.MARK, " ") for i in range(300, 32000, 7)]
    letters = "abcdeinrst  \t\n▁ß中文😀0123 é\u0301\x00\ufffd"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    made += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 15))) for _ in range(150)]
    made += [" " * rng.randint(0, 60) + "a" * rng.randint(0, 60) + " x" for _ in range(30)]
    made += ["".join(rng.choice("etaoinshrdlu0123456789") for _ in range(rng.randint(100, 1500))) for _ in range(20)]
    long = [" " * 5000, "word " * 20000, "中" * 3000, "\n" * 2000]
    return [None, "", " ", "  ", "▁", "a", " a", "a ", "<s>x</s>", *made, *long, made[3], made[3]]


@pytest.mark.parametrize("long", [3, 512])
def test_merge_rounds_give_the_ids_of_the_library(monkeypatch, long):
    monkeypatch.setattr(B, "LONG", long)
    library, merges = B.load(MODEL)
    texts = [t or "" for t in odd_texts() if long > 3 or len(t or "") < 10000]
    together = B.Encoder(merges).encode(texts)
    alone = B.Encoder(merges)
    for text, ids in zip(texts, together):
        assert ids == library.encode(text)
        assert alone.encode([text])[0] == ids


def test_words_are_forgotten_and_encoded_again(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5)
    library, merges = B.load(MODEL)
    encoder = B.Encoder(merges)
    for text in ("one two three four", "two five six seven", "", "one two eight"):
        assert encoder.encode([text, text]) == [library.encode(text)] * 2


@pytest.mark.parametrize("seed", range(4))
def test_any_vocabulary_merges_as_one_pair_at_a_time(seed):
    """Scores in no sensible order, with ties: what is merged next must still be right."""
    rng = random.Random(seed)
    letters = "abc"
    names = list(letters[: 2 + seed % 2]) + list({"".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(25)})
    pieces = {n: (256 + i, float(-rng.randint(1, 12))) for i, n in enumerate(names)}
    merges = B.Merges(pieces, list(range(256)))

    def plain(word):
        parts = list(word)
        while True:
            pairs = [(-pieces[a + b][1], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces]
            if not pairs:
                return [i for p in parts for i in ([pieces[p][0]] if p in pieces else p.encode())]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    ids, bounds = merges.encode(words)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain(w) for w in words]
    for word in words:
        if len(word) > 1:
            codes = np.array([merges.symbols[ord(c)] for c in word], dtype=np.int32)
            queued, _ = merges.merge_queued(codes, 0)
            assert merges._ids(queued)[0].tolist() == plain(word)


def test_piece_round_trip_over_rows(spark):
    library = B.load(MODEL)[0]
    texts = dict(enumerate(odd_texts()))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, ids int, n_tokens string")
    rows = {r["doc_id"]: r for r in B.round_trip(docs, MODEL).collect()}
    back = {r["doc_id"]: r["text"] for r in B.decode_ids(B.encode_texts(docs, MODEL), MODEL).collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        want = library.encode(text or "")
        assert rows[i]["n_tokens"] == len(want)
        assert rows[i]["ids_sha256"] == sha(",".join(map(str, want)))
        assert rows[i]["decoded_sha256"] == sha(back[i]) == sha(library.decode(want) if want else "")
    whole = B.encode_rows(docs, MODEL)
    assert whole.columns == ["doc_id", "n_tokens", "ids"]
    assert B.round_trip(docs.limit(0), MODEL).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto.FromString(open(MODEL, "rb").read())
    model.trainer_spec.byte_fallback = False
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="plain BPE"):
        B.load(str(tmp_path / "other.model"))


# --- Merkle manifest ---------------------------------------------------------------


def spelled(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path(levels, i, digest):
    siblings = []
    for nodes in levels[:-1]:
        first = i // 8 * 8
        run, p = nodes[first : first + 8], i - first
        siblings += run[:p] + run[p + 1 :]
        digest, i = sha("".join(run[:p] + [digest] + run[p + 1 :])), i // 8
    return siblings, digest


def plain_manifest(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    trees, out = {}, []
    for doc, source, lang, n, text in rows:
        leaf = claim = sha("".join(map(spelled, (doc, source, lang, n, text))))
        if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            claim = sha("".join(map(spelled, (doc, source, lang, n, low))))
        trees.setdefault(lang, []).append((doc, leaf, claim))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda x: (first(x[0]), x[1]))
        built[lang] = levels_of([leaf for _, leaf, _ in trees[lang]])
    top = levels_of([built[lang][-1][0] for lang in langs]) if langs else []
    for k, lang in enumerate(langs):
        for i, (doc, leaf, claim) in enumerate(trees[lang]):
            inner, digest = path(built[lang], i, claim)
            outer, digest = path(top, k, digest)
            root = top[-1][0]
            out.append((doc, leaf, built[lang][-1][0], root, sha("".join(inner + outer)), digest, digest == root))
    return out


def made_rows(n, langs, seed=1):
    rng = random.Random(seed)
    texts = lambda i: rng.choice([None, "", f"Hello {i}", "ÉA" * 3, "x", "Z" * 5000])
    ids = lambda i: rng.choice([None, rng.randint(-n, n)]) if rng.random() < 0.2 else i
    return [(ids(i), rng.choice(["a", "é", None]), rng.choice(langs), rng.choice([None, 3]), texts(i)) for i in range(n)]


TREES = {
    "several languages, ids missing and repeated": made_rows(700, ["en", "de", None, "Z", "é"]),
    "no row": [],
    "one leaf": made_rows(1, ["en"]),
    "a last run of one": made_rows(9, ["en"]),
    "lone leaves only": [(1, "a", "x", 1, "T"), (2, "a", "y", 1, "U")],
    "more languages than a run holds": made_rows(150, [str(i) for i in range(80)]) + [(5, "a", "en", 3, "Qx")] * 20,
}


@pytest.mark.parametrize("case", TREES)
def test_manifest_equals_a_plain_one(spark, case):
    rows = TREES[case]
    schema = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, idx string"
    docs = spark.createDataFrame([(*r, 1, "t", "i") for r in rows], schema)
    order = lambda row: tuple(map(str, row))
    assert sorted((tuple(r) for r in M.check_tampering(docs).collect()), key=order) == sorted(plain_manifest(rows), key=order)


def test_a_climb_verifies_what_was_not_claimed_otherwise(spark):
    docs = spark.createDataFrame([(f"k{i}", i % 3, f"t{i}") for i in range(100)], "key string, part int, body string")
    made = M.build(docs, "key", "part", ("key", "body"))
    assert {r["verified"] for r in M.verify(made).collect()} == {True}
    assert made.subroots.selectExpr("sum(leaves)").first()[0] == 100
    # The limit of the session is as it was.
    assert spark.conf.get(M._ROW_LIMIT, None) is None
    from pyspark.sql import functions as F

    forged = M.build(docs, "key", "part", ("key", "body"), {"body": F.when(F.col("key") == "k7", "x").otherwise(F.col("body"))})
    assert forged.root == made.root
    assert [r["key"] for r in M.verify(forged).filter("not verified").collect()] == ["k7"]


# --- centroid clusters -------------------------------------------------------------


def plain_clusters(rows, k=16, rounds=3, wide=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == wide and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((sha(f"1:{i}"), x) for i, x in kept if i is not None)[:k]
    centroids = [x for _, x in starts]
    if not centroids:
        return []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        centroids = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, centroids)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    each = {c: sum(d for _, n, d in found if n == c) for c in range(len(centroids))}
    return [(i, c, d, each[c], sum(each.values()), sha(",".join(map(str, centroids[c])))) for i, c, d in found]


def made_vectors(n, wide, seed=2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.3, (5, wide))
    rows = [(i, [float(x) for x in middle[i % 5] + rng.normal(0, 0.1, wide)]) for i in range(n)]
    odd = [None, [], [1.0] * (wide - 1), [None] + [1.0] * (wide - 1), [float("nan")] * wide, [float("inf")] + [0.0] * (wide - 1)]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    # Repeated rows, one id with two vectors, rows without id, and a component far away.
    return rows + [rows[3]] * 4 + [(4, rows[7][1]), (None, rows[8][1]), (None, [0.0] * wide), (2000, [900.0] + [0.0] * (wide - 1))]


VECTORS = "vec_id long, embedding array<float>, cluster string, x int"


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("n, bits", [(300, 6), (300, 3), (300, 1), (5, 6), (0, 6)])
def test_clusters_equal_plain_rounds(spark, n, bits):
    rows = made_vectors(n, 64) if n else []
    if n == 5:
        rows = rows[:5]
    table = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], VECTORS)
    got = [tuple(r) for r in C.cluster_vectors(table, bits=bits).collect()]
    order = lambda row: tuple(map(str, row))
    assert sorted(got, key=order) == sorted(plain_clusters(as_floats(rows)), key=order)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 4)] * 4) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in C.cluster_vectors(table, k=6, wide=4, scale=1).collect()]
    assert sorted(got) == sorted(plain_clusters(rows, k=6, wide=4, scale=1))


def test_cells_leave_the_true_nearest_among_the_candidates():
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 40, (500, 16))
    x[0, 0] = 5000
    stats = [{"d": d, "n": len(x), "total": int(c.sum()), "squares": int((c**2).sum()), "least": int(c.min()), "most": int(c.max())} for d, c in enumerate(x.T)]
    centroids = x[rng.integers(0, 500, 12)]
    centroids[3] = centroids[5]
    exact = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    shares = []
    for bits in (1, 3, 6):
        cells = C.Cells.of(stats, bits)
        packed = cells.pack(x)
        assert {len(p) for p in packed} == {2 * bits}
        cell = cells.unpack(pa.array(packed))
        dims = np.arange(16)
        assert ((cells.low[dims, cell] <= x) & (x <= cells.high[dims, cell])).all()
        may = cells.candidates(cell, cells.intervals(centroids), centroids)
        assert may[exact == exact.min(axis=1)[:, None]].all()
        shares.append((may.sum(axis=1) > 1).mean())
    # Finer cells decide more without the vectors.
    assert shares[0] > shares[1] > shares[2] and shares[2] < 0.6


def test_middle_rounds_fetch_only_open_or_moving_vectors(spark):
    rows = made_vectors(300, 64)
    table = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], VECTORS)
    work = C.Clustering(table, "vec_id", "embedding")
    centroids = work.starts(16, 1)
    state = work.first_round(centroids)
    judged = work.judged(state, centroids)
    assert "x" not in judged.columns and judged.count() == work.stored.count()
    # The same centroids again: nothing moves, so sums stay as they are.
    settled = work.settled(judged, centroids)
    assert settled.filter("row is null").count() == 0
    assert settled.count() == judged.filter("cluster < 0").count() < judged.count()


def test_huge_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="after scaling"):
        C.cluster_vectors(table).collect()
