"""Personal data by candidate gradient boosting, in DataFrame operations only.

Fixed patterns find addresses, network addresses, card and telephone numbers; those
matches always stand. Beside them, looser generators propose many more spans per kind,
overlapping each other and the fixed matches. Gradient-boosted trees score the proposals
by their format and by what stands around them.

What the fixed patterns miss cannot be learnt from their matches as they are. So each match
is also shown with its defining sign masked, in its own surroundings: an address spelt with
"at" and "dot", a network address with bracketed dots, a card number with other separators
and a wrong check digit, a telephone number without plus or country (``_masked``). These
are positives. Negatives are the same digits and words put as lists, thousands, dates,
ranges and bare runs, and proposals over a fixed match of another kind. Proposals that
overlap nothing are unlabelled: they count as negatives of weight ``UNLABELLED``, since
some are what is looked for.

The trees are fitted on at most ``MAX_FIT`` rows, chosen by hash, from two thirds of
the hashes; the last third, however large, calibrates the scores: rates of positives per
score bin, made monotone, so nothing but counts per bin comes to the driver. Per kind, a
proposal passes where its calibrated probability is at least ``CERTAINTY``; if it overlaps
neither a fixed match nor a better proposal, it is added. All forms of one match fall into
the same third. Without both classes nothing is added.

Defined results: missing and empty texts hold nothing; repeated rows are searched each;
other columns are not looked at. Positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.tasks import keyed_texts, written

KINDS = ("email", "ip", "card", "phone")
MAX_FIT, CERTAINTY, UNLABELLED, BINS = 20_000, 0.9, 0.2, 200
CONTEXT = 24

#: Fixed patterns, written so that no group or run is tried twice: runs are possessive and
#: start at their first character or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms. Digits in groups are proposed as card and as telephone number.
GENERATORS = {
    "email": r"(?:\G|(?<![\p{L}0-9._%+-]))[\p{L}0-9._%+-]{1,64}+(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)[\p{L}0-9-]{1,63}+(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[\p{L}0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:[.,]\x20?|\x20?[\[(](?:\.|dot)[\])]\x20?|\x20dot\x20)[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}+[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,15}+(?![0-9])",
}
#: A quick look whether a text can hold a match at all.
_POSSIBLE = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_LIKELY = {"email": r"@|[\[(\x20]at[\])\x20]", "ip": r"[0-9](?:[.,]\x20?|\x20?[\[(](?:\.|dot)[\])]\x20?|\x20dot\x20)[0-9]", "card": r"[0-9][\x20./_-]{0,2}[0-9]", "phone": r"[0-9][\x20()./-]{0,2}[0-9]"}
#: Words that announce a kind.
_HINTS = {"email": r"(?i)mail|contact|write", "ip": r"(?i)\bip\b|host|server|address", "card": r"(?i)card|visa|credit|pay", "phone": r"(?i)phone|tel|call|mobile|fax"}
FEATURES = ["of_kind", "size", "digits", "letters", "signs", "blanks", "groups", "repeats", "before_word", "after_word", "before_blank", "after_blank", "near_digits", "near_letters", "hint", "first_group", "last_group", "longest", "from_zero", "spelt"]

SPAN = "struct<start:int,end:int,value:string>"


def spans(text: Column, pattern: str, possible: str) -> Column:
    """All matches with their places: the pieces between the matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["value"])
        here = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), pair["value"].alias("value"))
        return F.struct(end.cast("int").alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    zipped = F.filter(F.arrays_zip(pieces.alias("piece"), found.alias("value")), lambda p: p["value"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.when(F.coalesce(text.rlike(possible), F.lit(False)), F.aggregate(zipped, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(f"array<{SPAN}>"))


def _luhn(digits: Column) -> Column:
    marks = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    doubled = F.transform(marks, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _valid(kind: str):
    """Whether a match of a fixed pattern stands."""
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        # A part of zeros only leaves nothing for the digits after the leading zeros.
        part = rf"(?:{part}|0++)"
        return lambda s: s["value"].rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return lambda s: F.when(F.length(digits(s["value"])).between(13, 19), _luhn(digits(s["value"]))).otherwise(False)
    if kind == "phone":
        return lambda s: F.length(digits(s["value"])).between(9, 15)
    return lambda s: F.lit(True)


def _placed(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))


def _features(kind: str, value: Column, before: Column, after: Column) -> list[Column]:
    """The format of a span and what stands around it."""
    count = lambda c, chars: F.length(F.regexp_replace(c, f"[^{chars}]", "")).cast("double")
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    near = F.concat(before, after)
    digits = F.regexp_replace(value, "[^0-9]", "")
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    size = lambda g: F.coalesce(F.length(g), F.lit(0)).cast("double")
    return [
        F.lit(float(KINDS.index(kind))).alias("of_kind"),
        F.length(value).cast("double").alias("size"),
        F.length(digits).cast("double").alias("digits"),
        count(value, r"\p{L}").alias("letters"),
        F.length(F.regexp_replace(value, r"[\p{L}0-9\s]", "")).cast("double").alias("signs"),
        count(value, r"\s").alias("blanks"),
        F.size(groups).cast("double").alias("groups"),
        F.size(F.array_distinct(F.split(digits, ""))).cast("double").alias("repeats"),
        flag(before.rlike(r"[\p{L}0-9]$")).alias("before_word"),
        flag(after.rlike(r"^[\p{L}0-9]")).alias("after_word"),
        flag((before == "") | before.rlike(r"\s$")).alias("before_blank"),
        flag((after == "") | after.rlike(r"^[\s.,;:!?]")).alias("after_blank"),
        count(near, "0-9").alias("near_digits"),
        count(near, r"\p{L}").alias("near_letters"),
        flag(before.rlike(_HINTS[kind])).alias("hint"),
        size(F.get(groups, F.lit(0))).alias("first_group"),
        size(F.element_at(groups, F.when(F.size(groups) > 0, -1))).alias("last_group"),
        F.coalesce(F.array_max(F.transform(groups, size)), F.lit(0.0)).alias("longest"),
        flag(digits.startswith("0")).alias("from_zero"),
        flag(value.rlike(r"[\[(](?:at|dot|\.)[\])]|\x20dot\x20")).alias("spelt"),
    ]


def _around(text: Column, s: Column) -> tuple[Column, Column]:
    before = text.substr(F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
    return before, text.substr(s["end"] + 1, F.lit(CONTEXT))


def _proposal(kind: str, text: Column):
    """A span with its format and context."""
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), *_features(kind, s["value"], *_around(text, s)))


def _masked(kind: str, value: Column) -> tuple[list[Column], list[Column]]:
    """A fixed match without its defining sign, in forms to be found and in forms to be left."""
    swap = lambda c, sign, by: F.replace(c, F.lit(sign), F.lit(by))
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = lambda a, n: F.substring(digits, a, n)
    rest = lambda a: F.substring(digits, a, 20)
    grouped = lambda c, n, by: F.regexp_replace(c, f"([0-9]{{{n}}})(?=[0-9])", f"$1{by}")
    date = lambda a, by: F.concat(F.lit("20"), part(a, 2), F.lit(by), part(a + 2, 2), F.lit(by), part(a + 4, 2))
    turned = lambda a, by: F.concat(part(a, 2), F.lit(by), part(a + 2, 2), F.lit(by + "20"), part(a + 4, 2))
    if kind == "email":
        name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        put = lambda at, dot: F.concat(name, F.lit(at), swap(host, ".", dot))
        return [value, put(" at ", " dot "), put(" [at] ", " [dot] "), put("(at)", "(dot)"), put("[at]", "."), put(" (at) ", "."), put(" at ", "(dot)")], [put(" at ", ".")]
    if kind == "ip":
        return [value, *[swap(value, ".", d) for d in (" dot ", "[.]", "(.)", "[dot]", " [dot] ")]], [swap(value, ".", d) for d in (",", ", ", ". ")]
    if kind == "card":
        wrong = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.right(digits, F.lit(1)).cast("int") + 1) % 10).cast("string"))
        forms = [grouped(c, 4, by) for c in (digits, wrong) for by in (".", "_", "/", "  ")]
        left = [wrong, grouped(digits, 3, "."), grouped(digits, 3, " "), grouped(digits, 2, " "), F.concat(date(1, "-"), F.lit(" "), date(7, "-")), F.concat(turned(1, "."), F.lit(" - "), turned(7, "."))]
        return [*forms, grouped(wrong, 4, " "), grouped(wrong, 4, "-")], left
    home = F.concat(F.lit("0"), part(2, 2))
    found = [
        value,
        F.substring(value, 2, 40),
        F.concat(F.lit("00"), F.substring(value, 2, 40)),
        *[F.concat(home, F.lit(by), part(4, 7)) for by in (" ", "/", "-")],
        F.concat(F.lit("("), home, F.lit(") "), part(4, 7)),
        F.concat(F.lit("0"), part(2, 3), F.lit(" "), part(5, 7)),
        *[F.concat(part(2, 3), F.lit(by), part(5, 3), F.lit(by), rest(8)) for by in ("-", ".", " ")],
        F.concat(F.lit("("), part(2, 3), F.lit(") "), part(5, 3), F.lit("-"), rest(8)),
    ]
    left = [digits, part(1, 8), date(1, "-"), date(1, "/"), turned(1, "."), turned(1, "/"), *[grouped(part(1, 9), 3, by) for by in (".", " ")], F.concat(part(1, 4), F.lit("-"), part(5, 4)), F.concat(date(1, "-"), F.lit(" "), part(7, 2))]
    return found, left


def _shown(kind: str, text: Column):
    """The forms of one fixed match, in its surroundings, with their labels."""

    def build(s: Column) -> Column:
        before, after = _around(text, s)
        source = F.xxhash64(F.lit(kind), s["value"])
        found, left = _masked(kind, s["value"])
        forms = F.array(*[F.struct(v.alias("value"), F.lit(label).alias("positive")) for label, group in ((1.0, found), (0.0, left)) for v in group])
        return F.transform(forms, lambda v: F.struct(source.alias("source"), v["positive"].alias("positive"), *_features(kind, v["value"], before, after)))

    return build


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id``, then per kind ``base_``: fixed matches, ``loose_``: proposals, ``shown_``: labelled forms."""
    rows = keyed_texts(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    valid = {k: F.filter(spans(text, PATTERNS[k], _POSSIBLE[k]), _valid(k)).alias(f"valid_{k}") for k in KINDS}
    # Matches once, then all that is made from them.
    found = rows.select("id", text.alias("text"), *valid.values())
    base = [F.transform(f"valid_{k}", _placed(k)).alias(f"base_{k}") for k in KINDS]
    loose = [F.transform(spans(F.col("text"), GENERATORS[k], _LIKELY[k]), _proposal(k, F.col("text"))).alias(f"loose_{k}") for k in KINDS]
    shown = [F.flatten(F.transform(f"valid_{k}", _shown(k, F.col("text")))).alias(f"shown_{k}") for k in KINDS]
    return found.select(F.monotonically_increasing_id().alias("row"), "id", *base, *loose, *shown)


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _flat(rows: DataFrame) -> DataFrame:
    """One row per proposal: its features, whether a fixed match lies there, its label and weight."""
    parts = []
    for kind in KINDS:
        hit = lambda name: F.exists(name, lambda b: (F.col("p.start") < b["end"]) & (b["start"] < F.col("p.end")))
        exploded = rows.select("row", *[f"base_{k}" for k in KINDS], F.explode(f"loose_{kind}").alias("p"))
        any_hit = hit("base_email") | hit("base_ip") | hit("base_card") | hit("base_phone")
        # A bare run of digits may or may not be a card, by its check digit alone.
        weight = F.when(hit("base_card"), 0.0 if kind == "card" else 1.0).when(any_hit, 1.0).otherwise(UNLABELLED)
        parts.append(exploded.select("row", F.lit(kind).alias("kind"), "p.*", hit(f"base_{kind}").cast("double").alias("positive"), any_hit.alias("taken"), weight.alias("weight")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Equal proposals in equal surroundings fall into one part, so copies are not seen before.
    return every.withColumn("part", F.pmod(F.xxhash64(*FEATURES), F.lit(3)))


def _lessons(rows: DataFrame) -> DataFrame:
    """One row per labelled form of a fixed match; all forms of a match are in one part."""
    parts = [rows.select("row", F.lit(kind).alias("kind"), F.posexplode(f"shown_{kind}").alias("start", "p")).select("row", "kind", "start", "p.*") for kind in KINDS]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.withColumns({"weight": F.lit(1.0), "part": F.pmod("source", F.lit(3))}).drop("source")


def lowest_scores(bins: list, certainty: float) -> dict[str, float]:
    """Per kind the lowest score whose calibrated rate is enough; ``bins``: kind, bin, good, all.

    Neighbouring bins whose rates fall are pooled, so that rates grow with the score
    (isotonic regression); half a positive and half a negative are added to every pool.
    """
    lowest = {}
    for kind in KINDS:
        pools: list[list[float]] = []
        for row in sorted((r for r in bins if r["kind"] == kind and r["all"] > 0), key=lambda r: r["bin"]):
            pools.append([row["bin"], row["good"], row["all"]])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                _, good, total = pools.pop()
                pools[-1][1:] = [pools[-1][1] + good, pools[-1][2] + total]
        enough = [first for first, good, total in pools if good + 0.5 >= certainty * (total + 1)]
        if enough:
            lowest[kind] = min(enough) / BINS
    return lowest


def _thresholds(scored: DataFrame, certainty: float) -> dict[str, float]:
    weight = F.col("weight")
    bins = scored.filter("part = 2").groupBy("kind", F.floor(F.col("score") * BINS).alias("bin")).agg(F.sum(weight * F.col("positive")).alias("good"), F.sum(weight).alias("all"))
    return lowest_scores(bins.collect(), certainty)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", certainty: float = CERTAINTY, max_fit: int = MAX_FIT) -> DataFrame:
    """``id, base, added`` per document: spans ``kind, start, end`` in order of kind and start."""
    rows = written(proposals(docs, id_col, text_col), "proposals")
    flat, lessons = written(_flat(rows), "candidates"), written(_lessons(rows), "lessons")
    columns = ["row", "kind", "start", "positive", "weight", "part", *FEATURES]
    both = flat.filter("weight > 0").select(*columns).unionByName(lessons.select(*columns))
    fit = both.filter("part <> 2").orderBy(F.xxhash64("row", "kind", "start", *FEATURES), "row", "kind", "start").limit(max_fit)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fit = written(assembler.transform(fit).select("features", F.col("positive").alias("label"), "weight"), "fit")
    kind_type = "array<struct<rank:int,start:int,end:int,kind:string>>"
    span = lambda k: lambda s: F.struct(F.lit(KINDS.index(k)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind"))
    base = F.concat(*[F.transform(f"base_{k}", span(k)) for k in KINDS]).cast(kind_type).alias("base")
    nothing = F.array().cast(kind_type)
    if fit.select("label").distinct().count() < 2:
        return rows.select(F.col("id").alias(id_col), base, nothing.alias("added"))
    trees = GBTClassifier(maxIter=20, maxDepth=5, maxBins=64, stepSize=0.3, minInstancesPerNode=10, seed=7, weightCol="weight").fit(fit)
    rated = lambda df, *kept: trees.transform(assembler.transform(df)).select(*kept, vector_to_array("probability")[1].alias("score"))
    scored = written(rated(flat, "row", "kind", "start", "end", "taken"), "scored")
    lowest = _thresholds(rated(both.filter("part = 2"), "kind", "part", "positive", "weight"), certainty)
    passes = F.coalesce(*[F.when(F.col("kind") == k, F.col("score") >= t) for k, t in lowest.items()], F.lit(False))
    rank = F.coalesce(*[F.when(F.col("kind") == k, i) for i, k in enumerate(KINDS)])
    chosen = scored.filter(passes & ~F.col("taken")).groupBy("row").agg(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind", "score")).alias("found"))
    better = lambda c, d: (d["score"] > c["score"]) | ((d["score"] == c["score"]) & (F.struct(d["start"], d["rank"]) < F.struct(c["start"], c["rank"])))
    best = F.filter("found", lambda c: ~F.exists("found", lambda d: _overlaps(c, d) & better(c, d)))
    added = F.array_sort(F.transform(best, lambda c: F.struct(c["rank"].alias("rank"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    return rows.join(chosen, "row", "left").select(F.col("id").alias(id_col), base, F.coalesce(added.cast(kind_type), nothing).alias("added"))


def _kind_is(kind: str):
    return lambda n, s: n + (s["kind"] == kind).cast("long")


def report(found: DataFrame) -> DataFrame:
    """Counts per kind and digest of the fixed matches, and all spans as text."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return found.select(
        *[c for c in found.columns if c not in ("base", "added")],
        *[F.aggregate("base", F.lit(0).cast("long"), _kind_is(k)).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform("base", text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat("base", "added")), text), ",").alias("spans"),
    )
