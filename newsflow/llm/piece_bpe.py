"""SentencePiece BPE: encode by vectorised merge rounds, decode with the library.

Blanks become the word mark and one mark goes in front. Of the pairs of neighbouring
symbols, the one whose joined piece has the best score is merged, the leftmost first among
equals, until no pair makes a piece. Symbols that are no pieces are written as bytes.

Here all new words of a slice are merged together. They lie one behind the other in one
flat array of symbols, cut wherever two characters are neighbours in no piece at all, as
no merge can cross such a place. Each round finds the best rank of every word (a segmented
minimum over the ranks of its pairs), merges all its pairs of that rank from the left at
once, and closes the gaps; words without a pair leave the arrays. What a word is encoded
to is remembered by the task.

Merging all pairs of a rank at once is what merging them one by one gives, unless a merged
piece could go on to a piece of the same or a better rank before the next pair's turn.
The vocabulary says which pieces could (``Merges.eager``); of these a round merges the
leftmost pair only. Words of more than ``LONG`` symbols, such as long runs of blanks or of
letters and digits, would take a round for nearly every merge, so they are merged from a
queue, one pair at a time, with the same result.

Defined results: a missing text is an empty one, and an empty text has no ids and decodes
to an empty text; repeated rows are encoded each; other columns are not looked at. Models
with other rules (no byte pieces, normalisation tables, pieces that users define or that
are unused) are refused with an error.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.tasks import add_columns, map_texts, sha, texts_of

MARK = "▁"
#: Symbols of a word from which on it is merged from a queue.
LONG = 512
#: Words and ids from which on a task forgets what it remembers.
REMEMBERED, REMEMBERED_IDS = 300_000, 4_000_000
_NONE = np.iinfo(np.int32).max


class Merges:
    """The merge rules of a vocabulary ``{piece: (id, score)}`` with the ids of its bytes."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.byte_ids = byte_ids
        names = [*pieces, *sorted({c for piece in pieces for c in piece} - set(pieces))]
        symbol = {name: i for i, name in enumerate(names)}
        #: What a symbol is written as: the id of a piece, or the bytes of a character.
        self.written = [[pieces[n][0]] if n in pieces else [byte_ids[b] for b in n.encode()] for n in names]
        self.single = np.array([ids[0] if len(ids) == 1 else -1 for ids in self.written] + [-1], dtype=np.int64)
        # Equal scores share a rank: then only the place in the word decides.
        order = {score: i for i, score in enumerate(sorted({score for _, score in pieces.values()}, reverse=True))}
        rules, eager = {}, set()
        for piece, (_, score) in pieces.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is None or right is None:
                    continue
                rules[left << 32 | right] = (order[score], symbol[piece])
                eager.update(s for s in (left, right) if len(names[s]) > 1 and order[score] <= order[pieces[names[s]][1]])
        # Characters that are neighbours inside a piece but make none themselves.
        for piece in pieces:
            for left, right in zip(piece, piece[1:]):
                rules.setdefault(symbol[left] << 32 | symbol[right], (_NONE, -1))
        keys = sorted(rules)
        self.keys = np.array([*keys, -1], dtype=np.int64)
        self.ranks = np.array([*(rules[k][0] for k in keys), _NONE], dtype=np.int32)
        self.joined = np.array([*(rules[k][1] for k in keys), -1], dtype=np.int32)
        self._hash()
        #: Pieces after whose making the next pair of their rank must wait.
        self.eager = np.zeros(len(names) + 1, dtype=bool)
        self.eager[list(eager)] = True
        #: The symbol of every character; -1 where no piece has it.
        self.symbols = np.full(0x110000, -1, dtype=np.int32)
        for name, i in symbol.items():
            if len(name) == 1:
                self.symbols[ord(name)] = i
        #: Whether marks only begin a piece, so that no merge crosses into the next word.
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece in pieces)

    def _hash(self) -> None:
        """A table of the rules by a hash of their pair; the next free place takes a clash."""
        self.bits = max(4, (4 * len(self.keys)).bit_length())
        self.slots = np.full(1 << self.bits, len(self.keys) - 1, dtype=np.int32)
        left = np.arange(len(self.keys) - 1)
        at = self._slot(self.keys[left])
        while len(left):
            free = self.slots[at] == len(self.keys) - 1
            _, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.slots[at[placed]] = left[placed]
            left, at = np.delete(left, placed), np.delete(at, placed)
            at = (at + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the rule of each pair stands; the last place where there is none."""
        none = len(self.keys) - 1
        wanted = (left.astype(np.int64) << 32) | right
        wanted[(left < 0) | (right < 0)] = -2
        slot = self._slot(wanted)
        at = self.slots[slot]
        open_ = np.flatnonzero((self.keys[at] != wanted) & (at != none))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(self.keys[at[open_]] != wanted[open_]) & (at[open_] != none)]
        return at

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and where each word's begin (marks in place of blanks)."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        if not len(codes):
            return np.zeros(0, dtype=np.int32), np.zeros(len(words) + 1, dtype=np.int64)
        sym = self.symbols[codes]
        sym = np.where(sym < 0, -1 - codes, sym)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        none = len(self.keys) - 1
        rule = np.full(len(sym), none, dtype=np.int32)
        rule[:-1] = self.find(sym[:-1], sym[1:])
        rule[ends[ends > 0] - 1] = none
        starts = np.flatnonzero(np.r_[True, rule[:-1] == none])
        merged, first = self.merge(sym, starts, rule)
        # ``first``: the place in the text of the first character of each symbol.
        ids, per_symbol = self._ids(merged)
        total = np.concatenate([[0], np.cumsum(per_symbol)])
        return ids, np.concatenate([[0], total[np.searchsorted(first, ends)]])

    def _ids(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a row of symbols, and how many each symbol has."""
        single = self.single[np.where(sym >= 0, sym, -1)]
        many = np.flatnonzero(single < 0)
        counts = np.ones(len(sym), dtype=np.int64)
        spelled = [self.written[s] if s >= 0 else [self.byte_ids[b] for b in chr(-1 - s).encode()] for s in sym[many].tolist()]
        counts[many] = [len(ids) for ids in spelled]
        out = np.repeat(single, counts)
        out[out < 0] = [i for ids in spelled for i in ids]
        return out, counts

    def merge(self, sym: np.ndarray, starts: np.ndarray, rule: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words of a flat array until no pair is left; symbols and their places."""
        sizes = np.diff([*starts, len(sym)])
        place = np.arange(len(sym))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(sizes > LONG).tolist():
            done.append(self.merge_queued(sym[starts[k] : starts[k] + sizes[k]], int(starts[k])))
        word = np.repeat(np.arange(len(starts)), sizes)
        short = sizes[word] <= LONG
        sym, place, word, rule = sym[short], place[short], word[short], rule[short]
        while len(sym):
            rank = self.ranks[rule]
            head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, head)
            length = np.diff([*head, len(sym)])
            open_ = np.repeat(best < _NONE, length)
            if not open_.all():
                done.append((sym[~open_], place[~open_]))
                sym, place, word, rule, rank = sym[open_], place[open_], word[open_], rule[open_], rank[open_]
                head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(sym) else head[:0]
                length, best = length[best < _NONE], best[best < _NONE]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, length))
            hits = self._leftmost(hits, word, self.eager[self.joined[rule[hits]]])
            sym[hits] = self.joined[rule[hits]]
            keep = np.ones(len(sym), dtype=bool)
            keep[hits + 1] = False
            hits = np.cumsum(keep)[hits] - 1
            sym, place, word, rule = sym[keep], place[keep], word[keep], rule[keep]
            changed = np.concatenate([hits, hits[hits > 0] - 1])
            rule[changed] = self._rules_at(sym, word, changed)
        symbols = np.concatenate([s for s, _ in done])
        places = np.concatenate([p for _, p in done])
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    @staticmethod
    def _leftmost(hits: np.ndarray, word: np.ndarray, eager: np.ndarray) -> np.ndarray:
        """Of overlapping pairs every second one; of eager ones the first of the word."""
        new_run = np.r_[True, np.diff(hits) != 1]
        begin = np.maximum.accumulate(np.where(new_run, hits, 0))
        first = np.r_[True, word[hits[1:]] != word[hits[:-1]]]
        waits = np.zeros(int(word[-1]) + 1, dtype=bool)
        waits[word[hits[eager]]] = True
        return hits[((hits - begin) % 2 == 0) & (first | ~waits[word[hits]])]

    def _rules_at(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rule of each symbol with its right neighbour in the same word."""
        right = np.minimum(at + 1, len(sym) - 1)
        inside = (at + 1 < len(sym)) & (word[right] == word[at])
        return self.find(sym[at], np.where(inside, sym[right], -1))

    def merge_queued(self, sym: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
        """One long word: best pair first, from a queue that drops outdated pairs."""
        sym = sym.tolist()
        n = len(sym)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        known: dict[int, tuple[int, int]] = {}
        none = len(self.keys) - 1
        rules = self.find(np.array(sym[:-1], dtype=np.int32), np.array(sym[1:], dtype=np.int32)).tolist()
        queue = [(int(self.ranks[r]), i, sym[i], sym[i + 1]) for i, r in enumerate(rules) if self.ranks[r] < _NONE]
        heapq.heapify(queue)

        def ruled(left: int, right: int) -> tuple[int, int]:
            """Rank and piece of a pair."""
            key = left << 32 | right
            if key not in known:
                r = int(np.searchsorted(self.keys[:none], key)) if left >= 0 and right >= 0 else none
                r = r if self.keys[r] == key else none
                known[key] = int(self.ranks[r]), int(self.joined[r])
            return known[key]

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and ruled(sym[i], sym[j])[0] < _NONE:
                heapq.heappush(queue, (ruled(sym[i], sym[j])[0], i, sym[i], sym[j]))

        gone = [False] * n
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if gone[i] or j < 0 or sym[i] != left or sym[j] != right:
                continue
            sym[i] = ruled(left, right)[1]
            gone[j] = True
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        left = [i for i in range(n) if not gone[i]]
        return np.array([sym[i] for i in left], dtype=np.int32), np.array(left) + offset


class _Numbers(dict):
    """Numbers words as they come; ``new`` are those that came since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes texts a slice at a time and remembers words."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if merges.by_word else lambda text: [text]
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.bounds = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.numbers) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        number = self.numbers.__getitem__
        words = [np.array(list(map(number, self.words(MARK + text.replace(" ", MARK)))), dtype=np.int64) if text else np.zeros(0, dtype=np.int64) for text in texts]
        ids, bounds = self.merges.encode(self.numbers.new)
        self.bounds = np.concatenate([self.bounds, len(self.ids) + bounds[1:]])
        self.ids = np.concatenate([self.ids, ids])
        self.numbers.new = []
        return [self._spelled(w) for w in words]

    def _spelled(self, words: np.ndarray) -> list[int]:
        """The ids of the words of one text, one behind the other."""
        start = self.bounds[words]
        size = self.bounds[words + 1] - start
        end = np.cumsum(size)
        return self.ids[np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)].tolist()


@lru_cache(maxsize=2)
def load(model_file: str):
    """The library's processor (for decoding) and the merge rules of a model file."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(model_file, "rb") as data:
        model = proto.ModelProto.FromString(data.read())
    kinds, norm, how = proto.ModelProto.SentencePiece, model.normalizer_spec, model.trainer_spec
    if (
        how.model_type != proto.TrainerSpec.BPE
        or not how.byte_fallback
        or how.treat_whitespace_as_suffix
        or norm.precompiled_charsmap
        or norm.remove_extra_whitespaces
        or not (norm.add_dummy_prefix and norm.escape_whitespaces)
        or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
    ):
        raise ValueError(f"{model_file}: not a plain BPE model with byte pieces")
    pieces = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    at = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
    merges = Merges(pieces, [at[f"<0x{b:02X}>"] for b in range(256)])
    return sentencepiece.SentencePieceProcessor(model_file=model_file), merges


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of every text: ``id, ids array<int>``."""

    def make():
        encoder = Encoder(load(model_file)[1])
        return lambda batch: {"ids": pa.array(encoder.encode(texts_of(batch)), pa.list_(pa.int32()))}

    return map_texts(docs, id_col, text_col, "ids array<int>", make)


def decode_ids(rows: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of every list of ids: ``id, text`` (a missing list: empty). A list that
    ends inside a character gets the replacement character there, as in the library."""
    narrow = rows.select(id_col, ids_col)

    def run(batches):
        library = load(model_file)[0]
        for batch in batches:
            texts = [library.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return narrow.mapInArrow(run, f"{id_col} {narrow.schema[id_col].dataType.simpleString()}, text string")


def encode_rows(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """All columns but the text, then ``n_tokens`` and ``ids``. Columns that had these
    names are replaced."""
    docs = docs.drop(*[c for c in ("n_tokens", "ids") if c != text_col])

    def make():
        encoder = Encoder(load(model_file)[1])

        def apply(batch):
            ids = encoder.encode(texts_of(batch))
            return {"n_tokens": pa.array([len(i) for i in ids], pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))}

        return apply

    return add_columns(docs, text_col, "n_tokens long, ids array<int>", make).drop(text_col)


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass: ``id, n_tokens, ids_sha256, decoded_sha256``.

    The ids themselves stay inside the task.
    """

    def make():
        library, merges = load(model_file)
        encoder = Encoder(merges)
        name = [str(i) for i in range(library.get_piece_size())].__getitem__

        def apply(batch):
            ids = encoder.encode(texts_of(batch))
            return {
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids_sha256": pa.array([sha(",".join(map(name, i))) for i in ids], pa.string()),
                "decoded_sha256": pa.array([sha(library.decode(i) if i else "") for i in ids], pa.string()),
            }

        return apply

    return map_texts(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
