"""Secret scans by a randomness test battery.

Fixed patterns find assignments, access keys and long hex runs. Beyond those, every long
run of key characters with a digit and a letter is a candidate. Its encoding (hex, base32,
base62, base64) is inferred from its characters, and three tests ask whether it looks like
uniform draws from that alphabet: chi-squared over the alphabet, runs about the middle of
the alphabet, and lag-one serial correlation. The smallest of the three p-values, times
three, must not be small.

Not being refuted is little for a short string. So every candidate also gets the evidence
against the opposite hypothesis, that it was written like the text around it: the
likelihood ratio of uniform draws to draws by the character frequencies of the whole
corpus, within the encoding. Its inverse is a valid p-value (Markov's inequality) that
falls with the length. Benjamini-Hochberg over all candidates of one length class holds
the share of false discoveries per class at ``fdr``. The p-values are counted in bins of
a fifth of a decade, each taken at its upper end, so that thresholds come from a table of
bounded size and err on the careful side.

Defined results: missing and empty texts hold no secret; repeated rows are scanned each;
other columns are not looked at. Positions are code points, end exclusive.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.bytewords import text_bytes
from newsflow.llm.tasks import bounded_batches, keyed_texts, map_texts, texts_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_HAS = re.compile(r"pass|secret|token|api", re.ASCII | re.IGNORECASE)

#: Alphabets, from the narrowest on; a candidate has the first one that holds all of it.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = {name: frozenset(chars) for name, chars in ALPHABETS.items()}
_RANK = {name: {c: i for i, c in enumerate(chars)} for name, chars in ALPHABETS.items()}
#: Lower bounds of the length classes.
LENGTHS = (20, 24, 32, 40, 64, 128)
BINS_PER_DECADE, LAST_BIN = 5, 200
REFUTED, FDR = 0.01, 0.001


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind, by start and kind."""
    found = []
    if _HAS.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet that holds the token, padding aside; None without digit or letter."""
    body = frozenset(token.rstrip("="))
    if not any(c.isdigit() for c in body) or not any(c.isalpha() for c in body):
        return None
    return next((name for name, chars in _SETS.items() if body <= chars), None)


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, encoding: str) -> float:
    """Combined p-value of the three tests of uniform, independent draws."""
    ranks = np.array([_RANK[encoding][c] for c in token.rstrip("=")])
    n, k = len(ranks), len(ALPHABETS[encoding])
    chi = float((np.bincount(ranks, minlength=k) ** 2).sum()) * k / n - n
    cube = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    high = ranks >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * a * b / n + 1
    spread = (mean - 1) * (mean - 2) / max(1, n - 1)
    by_runs = 2 * _upper_normal(abs(runs - mean) / math.sqrt(spread)) if spread > 0 else 0.0
    off = ranks - ranks.mean()
    power = float((off**2).sum())
    by_lag = 2 * _upper_normal(abs(float((off[1:] * off[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return min(1.0, 3 * min(_upper_normal(cube), by_runs, by_lag))


def evidence(token: str, encoding: str, frequency: np.ndarray) -> float:
    """log10 of the likelihood ratio of uniform draws to draws by the text's frequencies."""
    chars = ALPHABETS[encoding]
    weights = frequency[[ord(c) for c in chars]] + 0.5
    weights = weights / weights.sum()
    ranks = [_RANK[encoding][c] for c in token.rstrip("=")]
    return float(-math.log10(len(chars)) * len(ranks) - np.log10(weights[ranks]).sum())


def byte_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """How often each ASCII character occurs in all texts: 128 sums."""
    narrow = keyed_texts(docs, id_col, text_col).select("text")

    def run(batches):
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            total += np.bincount(text_bytes(batch.column(0))[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(128), pa.int32()), pa.array(total[:128])], ["byte", "n"])

    out = np.zeros(128)
    for row in narrow.mapInArrow(run, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[row["byte"]] = row["n"]
    return out


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("stratum", pa.int32()), ("bin", pa.int32())])


def candidates_of(text: str, frequency: np.ndarray, refuted: float = REFUTED) -> list[dict]:
    """Candidates that no randomness test refutes, with their length class and p-value bin.

    Longer runs are kept whole; a candidate with an unlikely mix of characters for its
    alphabet is refuted by the battery, whatever its length.
    """
    out = []
    for m in CANDIDATE.finditer(text):
        encoding = encoding_of(m[0])
        if encoding is None:
            continue
        ratio = evidence(m[0], encoding, frequency)
        place = min(LAST_BIN, max(0, math.floor(ratio * BINS_PER_DECADE)))
        stratum = sum(len(m[0]) >= n for n in LENGTHS) - 1
        random = battery(m[0], encoding) >= refuted
        kind = "hex" if encoding == "hex" else "access" if encoding in ("base32", "base36") else "assign"
        out.append({"start": m.start(), "end": m.end(), "kind": kind, "stratum": stratum, "bin": place if random else -1})
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", refuted: float = REFUTED) -> DataFrame:
    """``id, base, candidates``: fixed matches, and candidates with their p-value bins."""
    frequency = byte_frequencies(docs, id_col, text_col)

    def make():
        def apply(batch):
            texts = texts_of(batch)
            base = [[dict(zip(("start", "end", "kind"), s)) for s in base_spans(t)] for t in texts]
            return {"base": pa.array(base, pa.list_(_SPAN)), "candidates": pa.array([candidates_of(t, frequency, refuted) for t in texts], pa.list_(_CANDIDATE))}

        return apply

    ddl = "base array<struct<start:int,end:int,kind:string>>, candidates array<struct<start:int,end:int,kind:string,stratum:int,bin:int>>"
    return map_texts(docs, id_col, text_col, ddl, make)


def discovery_bins(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length class the lowest bin that Benjamini-Hochberg admits, from counts per bin.

    All candidates of a class count, refuted ones as p = 1 (bin -1).
    """
    tally = scanned.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.bin").count().collect()
    lowest = {}
    for stratum in {r["stratum"] for r in tally}:
        mine = sorted(((r["bin"], r["count"]) for r in tally if r["stratum"] == stratum), reverse=True)
        total, so_far = sum(n for _, n in mine), 0
        for place, n in mine:
            so_far += n
            if place >= 0 and 10 ** (-place / BINS_PER_DECADE) <= fdr * so_far / total:
                lowest[stratum] = place
    return lowest


def _discovered(lowest: dict[int, int]) -> Column:
    """Candidates that pass and do not overlap a fixed match, as spans."""
    passes = lambda c: F.coalesce(
        *[F.when(c["stratum"] == s, c["bin"] >= b) for s, b in lowest.items()], F.lit(False)
    )
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    chosen = F.filter("candidates", lambda c: passes(c) & apart(c))
    return F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR, refuted: float = REFUTED) -> DataFrame:
    """``id, base, found`` per document: fixed matches and discoveries beyond them.

    Texts are read once for the character frequencies and twice more: once to count the
    candidates per bin, once to apply what these counts admit.
    """
    scanned = scan(docs, id_col, text_col, refuted)
    return scanned.select(id_col, "base", _discovered(discovery_bins(scanned, fdr)).alias("found"))


def _counting(kind: str):
    return lambda n, s: n + (s["kind"] == kind).cast("long")


def report(found: DataFrame) -> DataFrame:
    """Counts per kind of the fixed matches, their digest, and all spans as text."""
    rank = lambda k: F.when(k == "assign", 0).when(k == "access", 1).otherwise(2)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ordered = F.array_sort(F.transform(F.concat("base", "found"), lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select(
        *[c for c in found.columns if c not in ("base", "found")],
        *[F.aggregate("base", F.lit(0).cast("long"), _counting(k)).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform("base", text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(ordered, text), ",").alias("spans"),
    )


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[{kind}]", fdr: float = FDR, refuted: float = REFUTED) -> DataFrame:
    """All rows and columns, with every secret in the text replaced by a mark of its kind."""
    frequency = byte_frequencies(docs, id_col, text_col)
    lowest = discovery_bins(scan(docs, id_col, text_col, refuted), fdr)
    at = docs.columns.index(text_col)

    def redact(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        spans = base + [
            (c["start"], c["end"], c["kind"])
            for c in candidates_of(text, frequency, refuted)
            if c["bin"] >= lowest.get(c["stratum"], LAST_BIN + 1) and not any(a < c["end"] and c["start"] < b for a, b, _ in base)
        ]
        out, done = [], 0
        for start, end, kind in sorted(spans):
            if start >= done:
                out += [text[done:start], mark.format(kind=kind)]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([redact(t) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return bounded_batches(docs).mapInArrow(run, docs.schema)
