"""Language-model scores by a weighted backoff automaton, learnt from the corpus.

The model is a bigram under a hierarchical Dirichlet prior: with ``c`` counts of training
tokens and ``p1(w) = (c(w) + 1) / (N + V + 1)``,

    p(w | u) = (c(u w) + m * p1(w)) / (c(u) + m)

which sums to one over the vocabulary and one unseen word. As an automaton: the root and
every known word are states. A seen bigram is an arc with its probability; every other
word takes the failure arc, ``m / (c(u) + m)``, to the root and the root's arc, ``p1``.
A text is read once, from a start state (whose count is the number of training documents)
to an end token, adding log10 weights. As a state is just the word before, no states or
arcs are built: the counts of each token, its predecessor and their bigram are looked up
and the weights worked out for whole arrays, with the automaton's values.

Counts of all words and bigrams come from all training texts. Blocks of documents send
their distinct keys with their counts to hash shards; the shards add them up and answer
with corpus counts in the order of the keys, so no task and not the driver ever holds the
whole model, and each block gets the part of the automaton that its texts can reach.

Defined results: missing and empty texts consist of the end token; a missing id counts as
an empty string when texts are held out; repeated rows count and are scored each; other
columns are not looked at. Keys are 64-bit hashes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.blocks import below, by_shard, laid_out, ordered, pack_counts, pack_sorted, unpack_counts, unpack_sorted
from newsflow.llm.bytewords import Words, mix, slices

PRIOR = 100.0
#: Keys of the marks at both ends of a text.
_START, _END = np.uint64(0x5BD1E995A5A5A5A5), np.uint64(0xC6A4A7935BD1E995)
_JOIN = np.uint64(0x9FB21C651E98DF25)


def held_out(doc_id, folds: int = 7, fold: int = 2) -> bool:
    """Whether a document is kept from training, by the crc32 of its id as text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


class _Block:
    """Tokens of a block: their keys, their predecessors' keys, and their documents."""

    def __init__(self, table: pa.Table):
        rows = ordered(table)
        self.ids = rows.column("id")
        self.number = table.column("block")[0].as_py()
        self.held = np.array([held_out(i) for i in self.ids.to_pylist()], dtype=bool)
        keys, counts = [], []
        for part in slices(rows, "text"):
            words = Words(part.column("text"), lower=True)
            n = words.counts + 1
            out = np.full(int(n.sum()), _END, dtype=np.uint64)
            doc = np.repeat(np.arange(len(n)), words.counts)
            out[np.arange(len(doc)) + doc] = words.hashes()
            keys.append(out)
            counts.append(n)
        self.keys, self.counts = np.concatenate(keys), np.concatenate(counts)
        self.firsts = np.cumsum(self.counts) - self.counts
        before = np.empty_like(self.keys)
        before[1:] = self.keys[:-1]
        before[self.firsts] = _START
        self.pairs = mix(before * _JOIN + self.keys)
        self.known = np.repeat(~self.held, self.counts)
        self.before = before

    def tally(self, keys: np.ndarray, counted: np.ndarray):
        """Distinct keys, ascending, how often each is counted, and each token's place."""
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, dtype=bool)
        group = np.cumsum(new) - 1
        place = np.empty(len(keys), dtype=np.int64)
        place[order] = group
        return ranked[new], np.bincount(group, weights=counted[order], minlength=int(new.sum())).astype(np.int64), place

    def words(self):
        """Words, and the start mark counted once per training document."""
        keys = np.concatenate([self.keys, np.full(len(self.held), _START)])
        return self.tally(keys, np.concatenate([self.known, ~self.held]))

    def bigrams(self):
        return self.tally(self.pairs, self.known)


def traverse(arc: np.ndarray, root: np.ndarray, state: np.ndarray, tokens: int, distinct: int, prior: float):
    """log10 weights of all steps: ``arc`` c(u w), ``root`` c(w), ``state`` c(u) of each.

    Where there is no arc the failure arc leads to the root; a state that training never
    saw is the root itself, whose failure weight is one.
    """
    at_root = np.log10((root + 1.0) / (tokens + distinct + 1.0))
    failure = np.log10(prior) - np.log10(state + prior)
    seen = np.log10(arc + prior * 10.0**at_root) - np.log10(state + prior)
    return np.where(arc > 0, seen, failure + at_root), at_root


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text."""
    texts, layout = laid_out(docs, id_col, text_col)
    bits, id_type = layout.shard_bits, texts.schema["id"].dataType.simpleString()

    def counted(table: pa.Table) -> pa.Table:
        block = _Block(table)
        part, keys, counts = [], [], []
        for kind, (found, n, _) in enumerate((block.words(), block.bigrams())):
            for shard, span in enumerate(by_shard(found, 64, bits)):
                # Shards of words answer every block, also one without a key there: they tell N and V.
                if kind == 0 or span.stop > span.start:
                    part.append(kind << bits | shard)
                    keys.append(pack_sorted(below(found[span], 64, bits), 64 - bits))
                    counts.append(pack_counts(n[span]))
        return pa.table({"part": pa.array(part, pa.int32()), "block": pa.array([block.number] * len(part), pa.int32()), "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def added(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        own = [unpack_sorted(k, 64 - bits) for k in table.column("keys").to_pylist()]
        n = np.concatenate([unpack_counts(c) for c in table.column("counts").to_pylist()])
        every = np.concatenate(own)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, dtype=bool)
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=n[order], minlength=int(new.sum())).astype(np.int64)
        answer = np.empty(len(every), dtype=np.int64)
        answer[order] = total[group]
        stop = np.cumsum([len(k) for k in own])
        rows = [pack_counts(answer[b - len(k) : b]) for k, b in zip(own, stop)]
        words = part >> bits == 0
        start_here = int(_START) >> (64 - bits) == part if words and bits else words
        at = np.searchsorted(ranked[new], below(np.array([_START]), 64, bits)[0]) if start_here else 0
        starts = int(total[at]) if start_here and at < len(total) else 0
        tokens, distinct = (int(total.sum()) - starts, int((total > 0).sum()) - (starts > 0)) if words else (0, 0)
        height = table.num_rows
        return pa.table({"block": table.column("block"), "part": table.column("part"), "counts": pa.array(rows, pa.binary()), "tokens": pa.array([tokens] * height, pa.int64()), "distinct": pa.array([distinct] * height, pa.int64())})

    def scored(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table)
        counts = dict(zip(answers.column("part").to_pylist(), answers.column("counts").to_pylist()))
        tokens, distinct = (sum(answers.column(c).to_pylist()) for c in ("tokens", "distinct"))
        every = [np.concatenate([unpack_counts(counts.get(kind << bits | shard, b"")) for shard in range(1 << bits)]) for kind in (0, 1)]
        place, pair_place = block.words()[2], block.bigrams()[2]
        size, heads = len(block.keys), len(block.held)
        root, arc = every[0][place[:size]], every[1][pair_place]
        start = every[0][place[size]] if heads else 0
        state = np.empty(size, dtype=np.int64)
        state[1:] = root[:-1]
        state[block.firsts] = start
        weight, base = traverse(arc, root, state, tokens, distinct, prior)
        sums = lambda x: np.add.reduceat(x, block.firsts)
        return pa.table(
            {
                id_col: block.ids,
                "held_out": pa.array(block.held),
                "n_tokens": pa.array(block.counts, pa.int64()),
                "n_known": pa.array(sums((root > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(heads, tokens), pa.int64()),
                "base_score": pa.array(sums(base)),
                "score": pa.array(sums(weight)),
            }
        )

    answers = texts.groupBy("block").applyInArrow(counted, "part int, block int, keys binary, counts binary").groupBy("part").applyInArrow(added, "block int, part int, counts binary, tokens long, distinct long")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        scored, f"{id_col} {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
