"""Fixed matches against a plain search in Python; what the trees add keeps its promises."""

import hashlib
import random
import re

import pytest

from newsflow.llm import personal_data as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def text_of(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


HAND = [
    "mail a.b%c@d-e.fr.x, twice x@y.z@w.v_u@t.s",
    "0000255.1.2.3 and 1.2.3.256 and 1.2.3.4.5.6.7.8 and 000.0.00.0 and .1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111, 4111  1111 1111 1111",
    "+1 (555) 010-9999 ext +12345678 +1-----2 ++44 20 7946 0958.",
    "😀 é 10.0.0.1 ü x@y.zz 😀 +49 30 901820",
    "1" * 5000 + " " + "a" * 20000 + "@" + " 1" * 4000,
    "", None, " ", "@", "+",
]


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("01 25.-@+a(b)é4\n") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    made += ["".join(rng.choice(["1", "25", ".", "255", "0", " ", "-", "+", "a@b", "@"]) for _ in range(30)) for _ in range(200)]
    made += [" ".join(rng.choice(["4111111111111111", "4012888888881881", "+1 555 010 99999", "8.8.8.8", "x"]) for _ in range(4)) for _ in range(40)]
    return HAND + made


@pytest.fixture(scope="module")
def found(spark):
    data = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "en", 3, 4) for i, t in data], "doc_id long, text string, lang string, base int, row int")
    return dict(data), {r["doc_id"]: r for r in P.report(P.find_personal_data(docs)).collect()}


def test_fixed_matches_equal_a_plain_search(found):
    data, rows = found
    assert len(rows) == len(data)
    for i, text in data.items():
        want = plain(text or "")
        assert rows[i]["base_sha256"] == hashlib.sha256(text_of(want).encode()).hexdigest(), text
        for kind in P.KINDS:
            assert rows[i][f"n_{kind}"] == sum(k == kind for k, _, _ in want)


def test_fixed_matches_stand_and_additions_do_not_overlap_them(found):
    data, rows = found
    for i, text in data.items():
        spans = [s.split(":") for s in rows[i]["spans"].split(",") if s]
        spans = [(k, int(a), int(b)) for k, a, b in spans]
        base = plain(text or "")
        assert set(base) <= set(spans)
        for _, a, b in set(spans) - set(base):
            assert all(b <= c or d <= a for _, c, d in base)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.report(P.find_personal_data(docs)).collect() == []


def digits_of(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def card(rng):
    head = "4" + digits_of(rng, 14)
    return next(head + c for c in "0123456789" if luhn(head + c))


def address(rng):
    word = lambda: "".join(rng.choice("abcdefghiklmnorstu") for _ in range(rng.randint(3, 8)))
    return word(), f"{word()}.{rng.choice(['org', 'com', 'net', 'example.com'])}"


FIXED = [
    lambda r: "{}@{}".format(*address(r)),
    lambda r: ".".join(str(r.randint(1, 255)) for _ in range(4)),
    card,
    lambda r: f"+{r.choice(['1', '49', '44'])} ({digits_of(r, 3)}) 555-{digits_of(r, 4)}",
]
LOOSE = {
    "email": [lambda r: "{} at {}".format(*address(r)).replace(".", " dot "), lambda r: "{} [at] {}".format(*address(r)).replace(".", " [dot] "), lambda r: "{}(at){}".format(*address(r))],
    "ip": [lambda r: "[.]".join(str(r.randint(1, 255)) for _ in range(4)), lambda r: " dot ".join(str(r.randint(1, 255)) for _ in range(4))],
    "card": [lambda r: ".".join(["4" + digits_of(r, 3), *(digits_of(r, 4) for _ in range(3))]), lambda r: "_".join(["5" + digits_of(r, 3), *(digits_of(r, 4) for _ in range(3))])],
    "phone": [lambda r: f"0{digits_of(r, 2)} {digits_of(r, 7)}", lambda r: f"0{digits_of(r, 2)}/{digits_of(r, 7)}", lambda r: f"({digits_of(r, 3)}) 555-{digits_of(r, 4)}"],
}
CLEAN = [
    lambda r: f"20{r.randint(10, 29)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
    lambda r: f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.20{r.randint(10, 29)}",
    lambda r: f"{r.randint(1, 9)}.{digits_of(r, 3)}.{digits_of(r, 3)}",
    lambda r: "1" + digits_of(r, r.choice([7, 9, 11, 15])),
    lambda r: ", ".join(str(r.randint(1, 200)) for _ in range(4)),
    lambda r: "look at example.com",
    lambda r: f"{r.randint(1900, 2000)}-{r.randint(2001, 2030)}",
]


@pytest.fixture(scope="module")
def planted(spark):
    """Documents with matches of the fixed patterns, with loose items, and with figures only."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    around = lambda item: " ".join([*(word() for _ in range(rng.randint(3, 9))), item, *(word() for _ in range(rng.randint(3, 9)))])
    rows = [(f"fixed{i}", around(rng.choice(FIXED)(rng)), None) for i in range(1200)]
    for kind, forms in LOOSE.items():
        for i in range(40):
            item = rng.choice(forms)(rng)
            rows.append((f"loose-{kind}-{i}", around(item), item))
    rows += [(f"clean{i}", around(rng.choice(CLEAN)(rng)), None) for i in range(300)]
    found = P.find_personal_data(spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string"))
    return rows, {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["added"]] for r in found.collect()}


@pytest.mark.parametrize("kind", P.KINDS)
def test_items_that_the_fixed_patterns_miss_are_added(planted, kind):
    rows, added = planted
    mine = [(i, text.index(item), item) for i, text, item in rows if i.startswith(f"loose-{kind}-")]
    hits = sum((kind, at, at + len(item)) in added[i] for i, at, item in mine)
    assert hits >= 0.9 * len(mine), (hits, len(mine))


def test_figures_that_are_no_personal_data_are_left(planted):
    rows, added = planted
    clean = [(i, text, added[i]) for i, text, _ in rows if i.startswith("clean") and added[i]]
    assert len(clean) <= 6, clean
    kinds = [(i.split("-")[1], s[0]) for i, _, item in rows if item for s in added[i]]
    assert sum(a == b for a, b in kinds) >= 0.95 * len(kinds)


def test_scores_are_calibrated_by_pooled_bins():
    row = lambda bin_, good, total: {"kind": "ip", "bin": bin_, "good": good, "all": total}
    assert P.lowest_scores([row(10, 0, 50), row(100, 20, 20), row(150, 16, 20), row(190, 100, 100)], 0.9) == {"ip": 190 / P.BINS}
    assert P.lowest_scores([row(10, 0, 50), row(100, 19, 20), row(150, 20, 20)], 0.9) == {"ip": 100 / P.BINS}
    assert P.lowest_scores([row(10, 2, 2)], 0.9) == {}
