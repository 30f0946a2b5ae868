"""SentencePiece encoding and decoding: a Viterbi search over batches of words in numpy.

Texts are cut into words, each with the spaces before it, which no piece crosses. Words of equal
length advance together, one character at a time: the hash of every substring that ends there
(a difference of prefix hashes) probes the sorted hashes of all pieces, and the best way to each
place, by a maximum over the lengths of the last piece, is stored with its back pointer.

What a last piece is worth depends on the kind of model:

* unigram: the score of the piece, plus that of the way to where it begins.
* BPE: nothing, but it must be able to follow the piece before it. A sequence of pieces is what
  merging makes of a text exactly when every two neighbours are what merging makes of the two
  alone, so one way survives, and it is the segmentation of the library. Pairs are tried by
  merging once and then kept. (Adding up the scores of a BPE model would give other segments.)

A word in which that does not leave exactly one way is merged step by step, as are words of a
BPE model over ``LONG_WORD`` characters (the search pays a numpy step per character, which few
words of one length share): a heap of neighbours, so time grows with the length times its
logarithm (measured: 1.6 seconds for 200,000 letters, 11 for a million). A unigram model takes about a second for each
thousand characters of such a word. Characters that are no piece become byte pieces if the model has them, else the unknown piece. Each worker keeps the
words it has encoded, as most recur.

Models must leave text as it is (identity normalisation, a space put before the text, no
removal of spaces), which is checked; then decoding gives back any text without U+2581.

Defined cases: null and empty text have no ids and decode to an empty text; rows that repeat are
encoded each; extra columns are ignored by ``encode``; nothing is cut off.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pricetide.llm import rounds
from pricetide.llm.hashing import U, mix, powers
from pricetide.llm.shared import ship, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEPT_CHARS = 8_000_000
LONG_WORD = 512
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CROSSING = re.compile(f"[^{SPACE}]{SPACE}")
_BASE = 0x9E3779B97F4A7C15
_TABLE = 1 << 22


class Model:
    """Pieces of a model file, and searches over them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rule, kinds = proto.normalizer_spec, proto.SentencePiece
        if rule.precompiled_charsmap or not rule.add_dummy_prefix or rule.remove_extra_whitespaces:
            raise ValueError("the model changes texts before it encodes them")
        self.unigram = proto.trainer_spec.model_type == 1
        self.names = [p.piece for p in proto.pieces]
        self.score = np.array([p.score for p in proto.pieces], np.float64)
        usable = [i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL]
        if any(_CROSSING.search(self.names[i]) for i in usable):
            raise ValueError("a piece of the model crosses words")
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.ids = {self.names[i]: i for i in usable}
        self.first = [-s for s in self.score.tolist()]  # ascending: order of merging
        self.longest = max((len(self.names[i]) for i in usable), default=1)
        self.least = min((self.score[i] for i in usable), default=0.0) - 10  # of an unknown character
        # every beginning of a piece, and the piece that it is itself (or -1)
        begins = dict.fromkeys((self.names[i][:n] for i in usable for n in range(1, len(self.names[i]))), -1) | self.ids
        keys = np.array([self._hash_of(b) for b in begins], U)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(begins.values()), np.int64)[order]
        self.key_length = np.array([len(b) for b in begins])[order]
        self.singles = frozenset(n for n in self.ids if len(n) == 1)
        self.pair_key, self.pair_ok = np.full(_TABLE, 2**64 - 1, U), np.zeros(_TABLE, bool)
        control = {i for i, p in enumerate(proto.pieces) if p.type in (kinds.CONTROL, kinds.UNUSED)}
        plain = [b"" if i in control else n.replace(SPACE, " ").encode() for i, n in enumerate(self.names)]
        plain[self.unknown] = " ⁇ ".encode()
        for value, i in self.bytes.items():
            plain[i] = bytes([value])
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_at = np.concatenate(([0], np.cumsum([len(p) for p in plain])))
        self.forget()

    # words already encoded
    def forget(self) -> None:
        self.known = _Known(self)
        self.flat, self.at, self.new, self.chars = np.zeros(0, np.int32), np.zeros(1, np.int64), [], 0

    @staticmethod
    def _hash_of(text: str) -> int:
        codes = np.array([ord(c) for c in text], U)
        return int(mix(np.sum(mix(codes) * powers(_BASE, len(codes))[0][: len(codes)], keepdims=True) + U(len(codes)))[0])

    def merge(self, word: str) -> list[int]:
        """Ids by merging step by step: the best-scored neighbours first, the leftmost of equals."""
        size = len(word)
        end = list(range(1, size + 1))  # of the part that starts at a place; 0: no part does
        before = list(range(-1, size - 1))  # where the part before one that starts at a place starts

        def neighbours(at: int) -> Iterator[tuple[float, int, int, int]]:
            middle = end[at]
            if middle < size and end[middle] - at <= self.longest:
                piece = self.ids.get(word[at : end[middle]])
                if piece is not None:
                    yield self.first[piece], at, middle, end[middle]

        heap = [pair for at in range(size) for pair in neighbours(at)]
        heapq.heapify(heap)
        while heap:
            _, at, middle, stop = heapq.heappop(heap)
            if end[at] != middle or end[middle] != stop:
                continue  # one of the two has been merged with another since
            end[at], end[middle] = stop, 0
            if stop < size:
                before[stop] = at
            for left in (before[at], at):
                if left >= 0:
                    for pair in neighbours(left):
                        heapq.heappush(heap, pair)
        ids, at = [], 0
        while at < size:
            ids += self._single(word[at : end[at]])
            at = end[at]
        return ids

    def _single(self, part: str) -> list[int]:
        if part in self.ids:
            return [self.ids[part]]
        coded = part.encode("utf-8", "replace")
        return [self.bytes[b] for b in coded] if self.bytes else [self.unknown]

    def follows(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether pieces may stand next to each other in a BPE segmentation."""
        key = before.astype(U) << U(32) | after.astype(U)
        slot = (mix(key) & U(_TABLE - 1)).astype(np.int64)
        ok, missing = self.pair_ok[slot], np.flatnonzero(self.pair_key[slot] != key)
        if len(missing):
            new, which = np.unique(key[missing], return_inverse=True)
            tried = np.empty(len(new), bool)
            for n, k in enumerate(new.tolist()):
                a, b = k >> 32, k & 0xFFFFFFFF
                tried[n] = self.merge(self.names[a] + self.names[b]) == [a, b]
            ok[missing] = tried[which]
            place = slot[missing]
            self.pair_key[place], self.pair_ok[place] = key[missing], ok[missing]
            lost = self.pair_key[place] != key[missing]  # two pairs of one slot: the last one stays
            self.pair_ok[place[~lost]] = ok[missing][~lost]
        return ok

    def search(self, words: list[str]) -> list[list[int]]:
        """Ids of words of one length, all of whose characters are pieces (BPE) or any (unigram)."""
        n, count = len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(count, n).astype(U)
        up, down = powers(_BASE, n + 1)
        sums = np.zeros((count, n + 1), U)
        np.cumsum(mix(codes) * up[:n], axis=1, out=sums[:, 1:])
        value = np.full((n + 1, count), -np.inf)
        value[0] = 0
        piece = np.full((n + 1, count), -1, np.int64)
        back = np.zeros((n + 1, count), np.int64)
        ways = np.zeros((n + 1, count), np.int8)
        for begin in range(n):
            live = np.flatnonzero(value[begin] > -np.inf)
            for size in range(1, min(self.longest, n - begin) + 1):
                end = begin + size
                h = mix((sums[live, end] - sums[live, begin]) * down[begin] + U(size))
                spot = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                goes_on = (self.keys[spot] == h) & (self.key_length[spot] == size)
                rows, found = live, np.where(goes_on, self.key_ids[spot], -1)
                live = live[goes_on]  # no piece begins with the other substrings
                if self.unigram:
                    unknown = self.unknown if size == 1 else -1
                    worth = np.where(found >= 0, self.score[found], self.least)
                    found = np.where(found >= 0, found, unknown)
                    take = found >= 0
                    rows, found, worth = rows[take], found[take], worth[take]
                else:
                    take = found >= 0
                    rows, found, worth = rows[take], found[take], 0.0
                    if begin and len(rows):
                        take = self.follows(piece[begin, rows], found)
                        rows, found = rows[take], found[take]
                    ways[end, rows] += 1
                total = value[begin, rows] + worth
                better = total > value[end, rows]
                if not better.all():
                    rows, found, total = rows[better], found[better], total[better]
                value[end, rows], piece[end, rows], back[end, rows] = total, found, begin
                if not len(live):
                    break
        unclear = (ways > 1).any(axis=0)
        if not self.unigram:
            unclear |= value[n] == -np.inf
        out: list[list[int]] = [[] for _ in words]
        places, left = np.full(count, n), np.arange(count)
        steps = []
        while len(left):
            steps.append((left, piece[places[left], left], back[places[left], left]))
            places[left] = steps[-1][2]
            left = left[places[left] > 0]
        for rows, ids, starts in reversed(steps):
            for w, i, s in zip(rows.tolist(), ids.tolist(), starts.tolist()):
                out[w].extend(self._single(words[w][s]) if i == self.unknown else (i,))
        for w in np.flatnonzero(unclear).tolist():
            out[w] = self.merge(words[w])
        return out

    def _encode_new(self) -> list[list[int]]:
        """Ids of the words in ``new``, searched in groups of one length."""
        parts: dict[int, list[tuple[int, str]]] = {}
        out: list[list[int]] = []
        mixed: list[tuple[int, list]] = []  # words of several parts: where each part's ids stand
        for word in self.new:
            if self.unigram or self.singles.issuperset(word):
                parts.setdefault(len(word), []).append((len(out), word))
                out.append([])
                continue
            own = []
            for part in self._known_parts(word):
                if part[0] in self.singles:
                    parts.setdefault(len(part), []).append((len(out) + 1 + len(own), part))
                    own.append([])
                else:
                    own.append(self._single(part))
            mixed.append((len(out), own))
            out += [[], *own]
        for size, group in parts.items():
            if size > LONG_WORD and not self.unigram:
                for place, part in group:
                    out[place] = self.merge(part)
                continue
            step = max(1, (1 << 17) // size)
            for lo in range(0, len(group), step):
                block = group[lo : lo + step]
                for (place, _), ids in zip(block, self.search([p for _, p in block])):
                    out[place] = ids
        for place, own in reversed(mixed):
            out[place : place + 1 + len(own)] = [[i for ids in out[place + 1 : place + 1 + len(own)] for i in ids]]
        return out

    def _known_parts(self, word: str) -> list[str]:
        """A word cut at characters that are no piece (nothing merges with them)."""
        out, run = [], ""
        for c in word:
            if c in self.singles:
                run += c
            else:
                out += [run, c] if run else [c]
                run = ""
        return out + [run] if run else out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        if self.chars > KEPT_CHARS:
            self.forget()
        numbers, counts = [], []
        for text in texts:
            if not text:
                own = []
            elif "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
                own = list(map(self.known.__getitem__, text.split(" ")))
            else:
                words = _WORDS.findall(SPACE + text.replace(" ", SPACE))
                own = [self.known[w[1:]] for w in words]
            numbers.append(np.array(own, np.int64))
            counts.append(len(own))
        if self.new:
            found = self._encode_new()
            self.at = np.concatenate((self.at, self.at[-1] + np.cumsum([len(f) for f in found])))
            self.flat = np.concatenate((self.flat, np.array([i for f in found for i in f], np.int32)))
            self.new = []
        numbers = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        size = self.at[numbers + 1] - self.at[numbers]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(self.at[numbers] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id lists that follow each other in ``ids``."""
        size = self.plain_at[ids + 1] - self.plain_at[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        data = self.plain[np.repeat(self.plain_at[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))]
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


class _Known(dict):
    """Numbers words (without the space put before them) as they come, and lists new ones."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> int:
        model = self.model
        self[word] = number = len(model.at) - 1 + len(model.new)
        model.new.append(SPACE + word)
        model.chars += len(word) + 1
        return number


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def _batches(batches, path: str):
    """(batch, place, rows, ids, counts, texts) for blocks of texts."""
    model = load(path)
    for batch in batches:
        texts, at = [t or "" for t in batch["text"].to_pylist()], 0
        for block in rounds.blocks(texts, [len(t) for t in texts], 1 << 20):
            yield model, batch.slice(at, len(block)), block, *model.encode(block)
            at += len(block)


def _encode(path: str, others: list[str]):
    def encode(batches):
        for _, rows, _, ids, counts in _batches(batches, path):
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids))
            columns = [*(rows[c] for c in others), pa.array(counts.astype(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "n_tokens", "ids"])

    return encode


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) for each row of docs."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "lang", "source", "text")
    return rows.mapInArrow(
        _encode(path, ["doc_id", "lang", "source"]), "doc_id bigint, lang string, source string, n_tokens bigint, ids array<int>"
    )


def _decode(path: str):
    def decode(batches):
        model = load(path)
        for batch in batches:
            lists = batch["ids"]
            offsets = lists.offsets.to_numpy()
            texts = model.decode(lists.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return decode


def decode_documents(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) for each row with ids."""
    ship(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id bigint, text string")


DIGEST = "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, decoded_sha256 string, round_trip boolean"


def _digest(path: str):
    def digest(batches):
        for model, rows, texts, ids, counts in _batches(batches, path):
            coded = np.zeros(len(model.names), np.int64)
            coded[list(model.bytes.values())] = 1
            cuts = np.concatenate(([0], np.cumsum(counts)))
            sums = np.concatenate(([0], np.cumsum(coded[ids])))
            data = memoryview(ids.astype("<u4")).cast("B")
            decoded = model.decode(ids, counts)
            columns = [
                rows["doc_id"],
                pa.array(counts.astype(np.int64)),
                pa.array(sums[cuts[1:]] - sums[cuts[:-1]]),
                pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                pa.array([a == b for a, b in zip(texts, decoded)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DIGEST.split(", ")])

    return digest


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again: digests of the ids and of the decoded text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.mapInArrow(_digest(public_tokenizers.path(MODEL)), DIGEST)
