"""BPE, token counts, secrets, contamination and substrings against plain versions."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken

from newsflow.llm import bpe, decontaminate as D, language_model as L, secrets as S, substrings, token_counts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_texts():
    rng = random.Random(3)
    words = ["ab", "c", "Dé", "f g", "1,2", "'s", " ", "x" * 30, "ñ", "😀", "don't"]
    made = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t ", "", "\x0b"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return [None, "", " ", "\n\n", "a", " a", "a ", "word " * 3000, "é" * 500, *made, made[3], made[3]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i, 1, "x") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, block int, n_tokens string")


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(odd_texts()))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_ids_and_bytes(docs, texts):
    tokenizer = bpe.encoding(RANKS, PATTERN)
    digests, ids = by_id(bpe.round_trip(docs, RANKS, PATTERN)), bpe.encode_texts(docs, RANKS, PATTERN)
    raw = by_id(bpe.decode_ids(ids, RANKS, PATTERN))
    for i, text in texts.items():
        want = tokenizer.encode_ordinary(text or "")
        assert digests[i]["n_tokens"] == len(want)
        assert digests[i]["ids_sha256"] == sha(" ".join(map(str, want)))
        assert digests[i]["decoded_sha256"] == sha(text or "")
        assert bytes(raw[i]["bytes"]) == (text or "").encode()


@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_bpe_parts_change_nothing(texts, size):
    tokenizer = bpe.encoding(RANKS, PATTERN)
    for text in filter(None, texts.values()):
        assert "".join(bpe.parts(text, size)) == text
        assert bpe.encode(text, tokenizer, size) == tokenizer.encode_ordinary(text)


def test_bpe_special_strings_are_text():
    tokenizer = bpe.encoding(RANKS, PATTERN)
    assert isinstance(tokenizer, tiktoken.Encoding) and len(bpe.encode("<|endoftext|>", tokenizer)) > 1


def test_token_counts_equal_the_library(docs, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    special = (model.is_control, model.is_unused, model.is_byte, model.is_unknown)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not any(test(i) for test in special)]
    library = Tokenizer(models.Unigram([("<unk>", min(s for _, s in pieces)), *pieces], unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="never", split=False)
    got = by_id(token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")))
    assert token_counts.load(public_tokenizers.path("piece_bpe_32k.model")).by_unit
    for i, text in texts.items():
        if not text:
            assert (got[i]["n_tokens"], got[i]["score"]) == (0, 0.0)
            continue
        marked = "▁" + text.replace(" ", "▁")
        found = library.encode(marked, add_special_tokens=False)
        # Unknown characters come fused from the library; each counts one piece per byte.
        n = sum(len(marked[a:b].encode()) if k == 0 else 1 for k, (a, b) in zip(found.ids, found.offsets))
        assert got[i]["n_tokens"] == n, text


def test_token_count_ties_and_empty_vocabulary():
    viterbi = token_counts.Viterbi({"a": -1.0, "b": -1.0, "ab": -2.0, "▁": -1.0, "bb": -2.0})
    # "a" + "b" and "ab" cost the same; the earliest start, the longest last piece, wins.
    assert viterbi.text("ab") == (-3.0, 2)
    assert token_counts.Viterbi({}).text("é") == (-20.0, 5)


def slow_viterbi(text, scores):
    unknown, best = min(scores.values()) - 10, {0: (0.0, 0)}
    for start in range(len(text)):
        base = best[start]
        single = False
        for end in range(start + 1, len(text) + 1):
            if text[start:end] in scores:
                single |= end == start + 1
                other = (base[0] + scores[text[start:end]], base[1] + 1)
                if end not in best or other[0] > best[end][0]:
                    best[end] = other
        if not single:
            other = (base[0] + unknown, base[1] + len(text[start].encode()))
            if start + 1 not in best or other[0] > best[start + 1][0]:
                best[start + 1] = other
    return best[len(text)]


def test_token_counts_equal_a_slow_version():
    rng = random.Random(9)
    for _ in range(300):
        scores = {"".join(rng.choice("▁ab") for _ in range(rng.randint(1, 4))): float(-rng.randint(1, 4)) for _ in range(8)}
        viterbi = token_counts.Viterbi(scores)
        text = "".join(rng.choice(" abé") for _ in range(rng.randint(1, 14)))
        assert viterbi.text(text) == slow_viterbi("▁" + text.replace(" ", "▁"), scores), (scores, text)


def plain_secrets(text):
    assign = re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I)
    out = [(m.start(), 0, m.end(), "assign") for m in assign if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_secrets(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44)) for _ in range(40)]
    plain = ["the quick brown fox jumps over a lazy dog in chapter1 of thebookofnames", "gggggggggggggggggggggggg1gggggggggggggggg"] * 20
    data = [f"x é {h} y" for h in hexes] + [f"😀 see {k} there" for k in keys] + plain
    data += [f'Api_Key = "{keys[0]}" tail', "toKen:short", "token=ab=token: abcdefgh", "xAKIA" + "Q7" * 9, None, "", "PASSWORD='a.b/c+d=-_'", "ſecret=abcdefghij"]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = by_id(S.report(S.find_secrets(docs)))
    for i, text in enumerate(data):
        want = plain_secrets(text or "")
        assert got[i]["base_sha256"] == sha(",".join(want)), text
        assert set(want) <= set(got[i]["spans"].split(",")) or not want
    found = [bool(got[len(hexes) + i]["spans"]) for i in range(len(keys))]
    assert sum(found) >= 0.75 * len(found)
    assert not any(got[len(hexes) + len(keys) + i]["spans"] for i in range(len(plain)))
    clean = by_id(S.without_secrets(docs))
    assert clean[0]["text"] == "x é [hex] y" and clean[len(data) - 3]["text"] == "" if data[-3] == "" else True
    assert all(h not in (r["text"] or "") for r in clean.values() for h in hexes)


def plain_contamination(docs, items, size=13):
    windows = {}
    for item, text in items.items():
        w = WORDS.findall(lower(text))
        k = min(size, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = {}
    for doc, text in docs.items():
        w = WORDS.findall(lower(text))
        hit, names = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    names |= windows[tuple(w[i : i + k])]
        out[doc] = (len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def contamination_case():
    rng = random.Random(8)
    vocabulary = ["alpha", "Beta", "gamma7", "é", "Ñu", "x"]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = {i: words(rng.randint(1, 30)) for i in range(12)} | {20: None, 21: "?!", 22: "", 23: "x x"}
    texts = {i: words(rng.randint(0, 40)) for i in range(60)}
    for i in range(60, 90):
        texts[i] = words(rng.randint(0, 400)) + ", " + (items[i % 12] or "").upper() + ". " + words(5)
    texts |= {100: None, 101: "", 102: "x-x", 103: texts[70], 104: texts[70]}
    return texts, items


@pytest.mark.parametrize("most", [10**6, 3])
def test_contamination(spark, most):
    texts, items = contamination_case()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items.items()], "item_id long, text string, doc_id int")
    got = by_id(D.digest(D.contamination(docs, bench, max_windows=most)))
    want = plain_contamination(texts, items)
    assert {i: tuple(r)[1:] for i, r in got.items()} == want
    clean = {r["doc_id"] for r in D.clean_documents(docs, bench, max_windows=most).collect()}
    assert clean == {i for i in want if not want[i][4]}


@pytest.mark.parametrize("most", [10**6, 3])
def test_contamination_by_items_without_id(spark, most):
    import duckdb

    from newsflow.llm.queries import OP6_SQL

    passage = " ".join(f"w{i}" for i in range(20))
    texts = [(1, "a " + passage), (2, "own text"), (3, passage + " " + "other words here"), (4, "other words here"), (5, None)]
    items = [(None, passage), (None, "other words here"), ("7", "other words here"), ("8", " ".join(f"w{i}" for i in range(5, 20))), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r["doc_id"]: tuple(r) for r in D.digest(D.contamination(docs, bench, max_windows=most)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()}
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id VARCHAR, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", texts)
        db.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
        assert got == {r[0]: r for r in db.execute(OP6_SQL).fetchall()}
    assert got[1][2:4] == (20, 2) and got[3][3] == 3 and got[4][3] == 2
    assert {r["doc_id"] for r in D.clean_documents(docs, bench, max_windows=most).collect()} == {2, 5}


def test_cut_spans(spark):
    docs = spark.createDataFrame([(1, "é One two, three four. Tail"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "TWO three")], "item_id long, text string")
    assert {r["doc_id"]: r["text"] for r in D.cut_spans(docs, bench).collect()} == {1: "é One  four. Tail", 2: ""}


def plain_substrings(rows, size=20):
    seen, out = {}, {}
    windows = [(i, s, tuple(BLANKS.findall(t or "")[s : s + size])) for i, t in rows for s in range(len(BLANKS.findall(t or "")) - size + 1)]
    for i, s, w in windows:
        seen[w] = min(seen.get(w, (i, s)), (i, s))
    for i, t in rows:
        w = BLANKS.findall(t or "")
        gone = {p for s in range(len(w) - size + 1) if seen[tuple(w[s : s + size])] < (i, s) for p in range(s, s + size)}
        out[i] = (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("size", [20, 3])
def test_substrings(spark, size, monkeypatch):
    monkeypatch.setattr("newsflow.llm.blocks.LEAST_BLOCK", 2000)
    monkeypatch.setattr("newsflow.llm.blocks.SHARD_TEXT", 1000)
    rng = random.Random(6)
    words = lambda n: " ".join(rng.choice(["a", "b", "cé", "d e"]) for _ in range(n))
    shared = words(60)
    rows = [(i * 7 % 101, rng.choice(["", shared + "\n", shared[10:]]) + words(rng.randint(0, 50)) + rng.choice([" ", "\t\x0b"]) + rng.choice(["", shared])) for i in range(80)]
    rows += [(200, None), (201, ""), (202, " "), (203, "z " * 4000)]
    docs = spark.createDataFrame([(i, t, "l", 1) for i, t in rows], "doc_id long, text string, part string, block int")
    got = by_id(substrings.repeated_words_digest(docs, size=size))
    assert {i: tuple(r)[1:] for i, r in got.items()} == plain_substrings(rows, size)


def test_substrings_keep_words(spark):
    docs = spark.createDataFrame([(2, "x a b c y"), (1, "a b c"), (None, "q")], "doc_id int, text string")
    got = {r["doc_id"]: r["kept"] for r in substrings.repeated_words(docs, size=3).collect()}
    assert got == {1: "a b c", 2: "x y", None: "q"}


def test_language_model(spark, monkeypatch):
    import math
    import zlib
    from collections import Counter

    monkeypatch.setattr("newsflow.llm.blocks.LEAST_BLOCK", 500)
    monkeypatch.setattr("newsflow.llm.blocks.SHARD_TEXT", 400)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["Ab", "c", "dé", "e", f"r{i}"]) for _ in range(rng.randint(0, 40)))) for i in range(90)] + [(100, None), (101, "")]
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, held boolean")
    got = by_id(L.score_texts(docs, prior=7.0))
    tokens = {i: [*BLANKS.findall(lower(t)), None] for i, t in rows}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 == 2}
    one, two, starts = Counter(), Counter(), 0
    for i, t in tokens.items():
        if i not in held:
            one.update(t)
            two.update(zip(["<s>", *t], t))
            starts += 1
    n, v = sum(one.values()), len(one)
    p1 = lambda w: (one[w] + 1) / (n + v + 1)
    context = lambda u: starts if u == "<s>" else one[u]
    for i, t in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(t), sum(one[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10(p1(w)) for w in t), rel_tol=1e-9)
        model = sum(math.log10((two[u, w] + 7 * p1(w)) / (context(u) + 7)) for u, w in zip(["<s>", *t], t))
        assert math.isclose(r["score"], model, rel_tol=1e-9)


@pytest.mark.parametrize(
    "run",
    [
        lambda d: bpe.round_trip(d, RANKS, PATTERN),
        lambda d: token_counts.count_tokens(d, public_tokenizers.path("piece_bpe_32k.model")),
        lambda d: S.report(S.find_secrets(d)),
        lambda d: S.without_secrets(d),
        lambda d: D.contamination(d, d.sparkSession.createDataFrame([], "item_id long, text string")),
        lambda d: substrings.repeated_words_digest(d),
        lambda d: L.score_texts(d),
    ],
)
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).collect() == []
