"""Suffix-array dedup: a radix sort of suffixes, most significant digits first, to a fixed depth.

Two suffixes share a repeated string of ``depth`` bytes exactly when they stay in one group
until that depth, so nothing is sorted further. Each pass splits the groups of the pass before
by a longer digit, and only suffixes whose group still has company go on:

* Sparse suffixes. Of all suffixes, those at the least ``SEED``-byte string of some window of
  ``depth`` bytes (leftmost among equals) are taken: about one in 85 for 200 bytes. The choice
  depends on the window's bytes alone, so equal windows choose the same place, and each window
  belongs to exactly one suffix. A suffix stands for a run of windows that begin before it.
* Pass 1, the seed's bytes. A suffix alone in its group owns no repeated window: dropped.
* Pass 2, all that the windows of a suffix cover. Groups with company repeat whole; one suffix of
  each group goes on, so that the other groups of its seed can meet it.
* Pass 3, ``PARTS`` digits around the seed: windows whose seed lies at a similar offset share the
  bytes between the last start and the first end. Windows of a digit without company are dropped.
* Pass 4, each window that is left, to the full depth.

Each pass is one round of ``rounds``: sorted lists of distinct digits from chunks of texts to
buckets, small answers back. Entries go to the bucket of their own digit, and a chunk sends a
digit once however many of its suffixes hold it, so a group of any size costs a bucket one entry
per chunk, and what follows a frequent seed is spread by the longer digits. No row per suffix
travels, and texts are shuffled once. What earlier passes found travels on with each pass, so that
the plan is a chain and no digit is computed again but to read the answers to it. So do the places
of the sparse suffixes (a few bytes each, packed), which are searched for in the first pass only.

Groups that end a sort (passes 2 and 4) are compared by two independent hashes, of bytes and of
8-byte digits, together 124 bits: n different strings are expected to give n * n / 2**125 pairs
taken for equal, 1e-11 for the 2e13 strings of 20 TB. The bytes themselves are not sent.

Defined cases: null text counts as empty; a text shorter than ``depth`` loses nothing; rows
that repeat (an id, a text or both) are documents of their own, so their texts repeat each
other; nulls in the id are kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pricetide.llm import rounds
from pricetide.llm.hashing import _BASE, _BYTE, U, Sums, byte_range_hash, byte_sums, give_back, hash_sums, mix, squeeze, unsqueeze
from pricetide.llm.shared import table

DEPTH = 200
SEED = 32
PARTS = 4
_DIGIT = 8
_PASSES = 5  # one more than there are
_FOUND = 0  # the number under which the suffixes themselves are handed on
_BLOCK = 1 << 18  # bytes of text worked on at a time
_PLACE = U(0xFFFFFF)
OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
OUT_TYPE = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


def digit_sums(data: np.ndarray) -> Sums:
    """Sums over the 8-byte digits that begin at each byte: a second hash of any range."""
    digits = np.zeros(max(0, len(data) - _DIGIT + 1), U)
    for i in range(_DIGIT):
        digits |= data[i : i + len(digits)].astype(U) << U(8 * i)
    return hash_sums(mix(digits))


class Suffixes:
    """The sparse suffixes of a chunk: place, first and last window, and the seed's digit."""

    def __init__(self, texts: list[bytes], depth: int, seed: int, packed: np.ndarray | None = None):
        """With what ``packed`` gave for the same texts nothing is searched for again."""
        self.depth, self.width = depth, seed
        self.base = np.zeros(len(texts) + 1, np.int64)  # texts lie apart by one byte
        np.cumsum([len(t) + 1 for t in texts], out=self.base[1:])
        self.pieces = []  # (place in the chunk, bytes, ends of texts in it)
        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text) - depth + 1), _BLOCK):
                piece = text[at : at + _BLOCK + depth - 1]
                if len(piece) >= depth:
                    self.pieces.append((int(self.base[i]) + at, piece))
        sizes = [len(p) for _, p in self.pieces]
        self.blocks = list(rounds.blocks(self.pieces, sizes, _BLOCK))
        self.span = depth - seed + 1  # places a seed can have in a window
        if packed is None:
            found = [self._sparse(b, seed) for b in self.blocks]
            self.block = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            join = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, U)]
            self.place, self.first, self.last, self.seed = join
            return
        numbers = np.ascontiguousarray(packed.reshape(4, -1).T).view("<i4").ravel().astype(np.int64)
        counts, rest = np.split(numbers, [len(self.blocks)])
        gap, size, offset = rest.reshape(3, -1)
        self.block, self.first = np.repeat(np.arange(len(counts)), counts), np.cumsum(gap)
        self.last, self.place = self.first + size, self.first + offset

    def packed(self) -> np.ndarray:
        """Suffixes per block, then windows and places by their distances, byte plane by byte plane."""
        counts = np.bincount(self.block, minlength=len(self.blocks))
        numbers = np.concatenate((counts, np.diff(self.first, prepend=0), self.last - self.first, self.place - self.first))
        return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.ravel()

    @cached_property
    def seed(self) -> np.ndarray:
        """The hash of each seed, as ``_sparse`` gives it."""
        out = np.zeros(len(self.place), U)
        cut = np.searchsorted(self.block, np.arange(len(self.blocks) + 1))
        for block, lo, hi in zip(self.blocks, cut, cut[1:]):
            data, _, _, shift = self._load(block)
            piece = np.searchsorted([p for p, _ in block], self.first[lo:hi], side="right") - 1
            at = self.place[lo:hi] - shift[piece]
            for i in range(self.width):
                out[lo:hi] = out[lo:hi] * U(_BASE) + _BYTE[data[at + i]]
        return mix(out)

    def _load(self, block):
        """Bytes of a block's pieces, where each begins in the block, and its shift to the chunk."""
        data = np.frombuffer(b"".join(p for _, p in block), np.uint8)
        sizes = np.array([len(p) for _, p in block])
        ends = np.cumsum(sizes)
        shift = np.array([place for place, _ in block]) - (ends - sizes)
        return data, sizes, ends, shift

    def _sparse(self, block, seed):
        data, sizes, ends, shift = self._load(block)
        h, base, width = _BYTE[data], _BASE, 1
        while width < seed:  # hashes of twice the width from two neighbours
            h = h[:-width] * U(base) + h[width:]
            base, width = base * base % 2**64, width * 2
        h = mix(h)
        least = (h & ~_PLACE) | np.arange(len(h), dtype=U)
        span, width = self.depth - seed + 1, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        start = np.flatnonzero(np.arange(len(least)) + self.depth <= np.repeat(ends, sizes)[: len(least)])
        place = (least[start] & _PLACE).astype(np.int64)
        opens = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))))
        place, first, last = place[opens], start[opens], start[np.append(opens[1:], len(start)) - 1]
        move = shift[np.searchsorted(ends, first, side="right")]
        return place + move, first + move, last + move, h[place]

    def hashes(self, own: np.ndarray, start: np.ndarray, end: np.ndarray, sums=byte_sums) -> np.ndarray:
        """A hash of each range within the bytes covered by its suffix; ``own`` ascends."""
        out = np.zeros(len(own), U)
        cut = np.searchsorted(self.block[own], np.arange(len(self.blocks) + 1))
        for block, lo, hi in zip(self.blocks, cut, cut[1:]):
            if lo == hi:
                continue
            data, _, _, shift = self._load(block)
            # pieces of one text overlap: a suffix was found in the one that begins last before it
            piece = np.searchsorted([p for p, _ in block], self.first[own[lo:hi]], side="right") - 1
            out[lo:hi] = mix(sums(data).range(start[lo:hi] - shift[piece], end[lo:hi] - shift[piece]))
        return out

    def covers(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of all that the windows of suffixes cover, and of where the seed is in it."""
        place, first, last = self.place[own], self.first[own], self.last[own]
        shape = mix(((place - first) << 20 | (last - first)).astype(U))
        check = mix(self.hashes(own, first, last + self.depth - _DIGIT + 1, digit_sums) + self.seed[own])
        return mix(self.hashes(own, first, last + self.depth) + shape), check

    def parts(self, own: np.ndarray) -> tuple[np.ndarray, ...]:
        """Suffix, first and last window and number of the parts of suffixes: windows by the offset
        of their seed."""
        wide = -(-self.span // PARTS)
        low, high = ((self.place - self.last) // wide)[own], ((self.place - self.first) // wide)[own]
        many = high - low + 1
        suffix = np.repeat(own, many)
        part = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        place, most = self.place[suffix], np.minimum((part + 1) * wide, self.span) - 1
        return suffix, np.maximum(self.first[suffix], place - most), np.minimum(self.last[suffix], place - part * wide), part

    def shared(self, suffix: np.ndarray, part: np.ndarray) -> np.ndarray:
        """A hash of the bytes that all windows with these offsets of the seed would share."""
        wide, place = -(-self.span // PARTS), self.place[suffix]
        most = np.minimum((part + 1) * wide, self.span) - 1
        return mix(self.hashes(suffix, place - part * wide, place - most + self.depth) + part.astype(U))

    def windows(self, own: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and two hashes of every window from ``first`` to ``last`` of the suffixes ``own``."""
        size = last - first + 1
        place = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        own = np.repeat(own, size)
        check = self.hashes(own, place, place + self.depth - _DIGIT + 1, digit_sums)
        return place, self.hashes(own, place, place + self.depth), check


class Groups:
    """Distinct (digit, check) of some suffixes in ascending order: the group of each, and sizes."""

    def __init__(self, digit: np.ndarray, check: np.ndarray | None = None):
        order = np.argsort(digit, kind="stable") if check is None else np.lexsort((check, digit))
        new = np.ones(len(order), bool)
        new[1:] = digit[order[1:]] != digit[order[:-1]]
        if check is not None:
            new[1:] |= check[order[1:]] != check[order[:-1]]
        self.opens, self.order = np.flatnonzero(new), order
        self.one = order[self.opens]  # the first of each group
        self.digit, self.check = digit[self.one], None if check is None else check[self.one]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.size = np.diff(np.append(self.opens, len(order)))


class Sorting:
    """Where the suffixes of a chunk stand after the passes that have been answered."""

    def __init__(self, chunk: pa.Table, answers: pa.Table | None, answered: int, depth: int, seed: int):
        texts = rounds.texts_of(chunk)
        # rows of a chunk arrive in any order; what passes hand on is in the order of the texts
        self.order = sorted(range(len(texts)), key=texts.__getitem__)
        self.texts = [texts[i] for i in self.order]
        self.answers, self.answered, self.known = answers, answered, {}
        packed = self._handed(_FOUND) if answered else None
        self.suffixes = s = Suffixes(self.texts, depth, seed, packed)
        self.known[_FOUND] = packed if answered else s.packed()
        if answered >= 1:
            self.going = np.flatnonzero(self._verdict(1, self.seeds) & 1)
        if answered >= 2:
            verdict = self._verdict(2, self.covers)
            self.whole = self.going[(verdict & 1) > 0]  # suffixes all of whose windows repeat
            # of each group that goes on, its first suffix in the first chunk
            self.parts = s.parts(self.going[(verdict & 2) > 0])
        if answered >= 3:
            company = (self._verdict(3, self.shared) & 1) > 0
            self.places, *self.digits = s.windows(*(x[company] for x in self.parts[:3]))

    def _handed(self, number: int) -> np.ndarray:
        """What an earlier pass handed on under a number."""
        bucket = np.array(self.answers["bucket"].to_pylist(), np.int64)
        return rounds.answered(self.answers.filter(pa.array((bucket < 0) & (-bucket % _PASSES == number))))

    def _verdict(self, number: int, groups: Callable[[], Groups]) -> np.ndarray:
        """Of everything sent in a pass: its group's answer, bit 2 for the first of the chunk only."""
        if number < self.answered:
            found = self._handed(number)
        else:
            groups = groups()
            found = np.zeros(len(groups.of), np.uint8)
            if len(found):
                bucket = np.array(self.answers["bucket"].to_pylist(), np.int64)
                verdict = rounds.answered(self.answers.filter(pa.array(bucket >= 0)))
                found = (verdict & 1)[groups.of]
                found[groups.one] |= verdict & 2
        self.known[number] = found
        return found

    def seeds(self) -> Groups:
        return Groups(self.suffixes.seed)

    def covers(self) -> Groups:
        return Groups(*self.suffixes.covers(self.going))

    def shared(self) -> Groups:
        return Groups(self.suffixes.shared(self.parts[0], self.parts[3]))

    def windows(self) -> Groups:
        return Groups(*self.digits)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and last + 1 of the maximal repeated runs."""
        places, s = self.places[(self._verdict(4, self.windows) & 1) > 0], self.suffixes
        return merged(np.concatenate((s.first[self.whole], places)), np.concatenate((s.last[self.whole], places)) + s.depth)


def _extra(check: np.ndarray | None, flags: np.ndarray):
    """What a chunk adds to its digits: eight bytes to compare, if given, and flags."""

    def extra(lo: int, hi: int) -> bytes:
        more = b"" if check is None else check[lo:hi].astype("<u8").tobytes()
        return more + squeeze(flags[lo:hi].astype(np.uint8))

    return extra


def _sorter(number: int, depth: int, seed: int, buckets: int):
    """Sends the digits of a pass, for applyInArrow on texts and the answers to earlier passes."""

    def send(chunk: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        if not chunk.num_rows:
            return rounds.SENT_TYPE.empty_table()
        state = Sorting(chunk, answers, number - 1, depth, seed)
        groups = (state.seeds, state.covers, state.shared, state.windows)[number - 1]()
        at = chunk["chunk"][0].as_py()
        sent = rounds.send(at, groups.digit, buckets, _extra(groups.check, groups.size > 1))
        for earlier, verdict in state.known.items():  # back to this chunk with the answers
            for name, value in zip(sent, (-(at + 1) * _PASSES - earlier, at, b"", squeeze(verdict))):
                sent[name].append(value)
        give_back()
        return pa.table(sent, schema=rounds.SENT_TYPE)

    return (lambda chunk: send(chunk)) if number == 1 else send


def _added(extras: list, sizes: list, order: np.ndarray, checked: bool) -> tuple[np.ndarray | None, np.ndarray]:
    skip = [8 * n if checked else 0 for n in sizes]
    flags = np.concatenate([np.frombuffer(unsqueeze(e[k:]), np.uint8) for e, k in zip(extras, skip)])[order]
    return np.concatenate([np.frombuffer(e[:k], "<u8") for e, k in zip(extras, skip)])[order] if checked else None, flags


def _judge_groups(checked: bool):
    def judge(first, group, order, extras, sizes) -> np.ndarray:
        """Bit 1: the group has company. Bit 2: this is its first entry."""
        check, flags = _added(extras, sizes, order, checked)
        by = np.lexsort((order, check, group) if checked else (order, group))
        new = np.ones(len(by), bool)
        new[1:] = group[by[1:]] != group[by[:-1]]
        if checked:
            new[1:] |= check[by[1:]] != check[by[:-1]]
        count = np.add.reduceat((flags[by] & 1).astype(np.int64) + 1, np.flatnonzero(new))
        out = np.empty(len(by), np.uint8)
        out[by] = (count > 1)[np.cumsum(new) - 1] | new.astype(np.uint8) << 1
        return out

    return judge


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return start[opens], reach[np.append(opens[1:], len(start)) - 1]


def _cutter(depth, seed, content, others):
    schema = pa.schema([*OUT_TYPE, *others])

    def cut(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        state = Sorting(chunk, answers, 4, depth, seed)
        start, end = state.repeated()
        texts, suffixes, chunk = state.texts, state.suffixes, chunk.take(pa.array(state.order))
        cut_at = np.searchsorted(start, suffixes.base)
        out = {name: [] for name in OUT_TYPE.names}
        for i, doc in enumerate(chunk["doc_id"].to_pylist()):
            spans, base = range(cut_at[i], cut_at[i + 1]), int(suffixes.base[i])
            kept, at = [], 0
            for s in spans:
                kept.append(texts[i][at : start[s] - base])
                at = int(end[s]) - base
            kept.append(texts[i][at:])
            whole = "".join(k.decode("utf-8", "ignore") for k in kept).encode() if content == "text" else None
            kept = b"".join(kept)
            row = (doc, len(texts[i]), len(texts[i]) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if content == "bytes" else whole)
            for name, value in zip(out, row):
                out[name].append(value)
        give_back()
        return pa.table(out | {f.name: chunk[f.name] for f in others}, schema=schema)

    return cut


def remove_repeated_strings(
    docs: DataFrame, depth: int = DEPTH, seed: int = SEED, content: str | None = "bytes", others: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, others) for each row of docs.

    ``depth`` is 8 or more; ``seed`` is a power of two of at most ``depth`` bytes that affects
    cost, not results.
    ``kept`` holds the remaining bytes, or for content="text" those of whole characters between
    the cuts, or nothing for None. ``others`` are columns of docs to hand through.
    """
    plan = rounds.deal(docs)
    texts = rounds.dealt(docs, plan, *(F.col(c) for c in others))
    carried = [docs.schema[c] for c in others]
    out = f"{OUT}{''.join(f', {f.name} {f.dataType.simpleString()}' for f in carried)}"
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in carried]
    sent = texts.groupBy("chunk").applyInArrow(_sorter(1, depth, seed, plan.buckets), rounds.SENT)
    answers = rounds.answer(sent, _judge_groups(checked=False))
    for number in (2, 3, 4):
        both = texts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
        sent = both.applyInArrow(_sorter(number, depth, seed, plan.buckets), rounds.SENT)
        answers = rounds.answer(sent, _judge_groups(checked=number != 3))
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_cutter(depth, seed, content, fields), out)


def clean_documents(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, text, lang, source, n_chars) without their repeated strings.

    What is left of a character that was cut in two goes too; rows left without text are dropped.
    """
    rows = remove_repeated_strings(docs, content="text", others=("lang", "source"))
    rows = rows.withColumn("text", F.col("kept").cast("string")).where("length(text) > 0")
    return rows.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_strings(table(spark, folder, "documents"), content=None).drop("kept")


SQL = r"""
WITH bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
  SELECT doc_id, i, md5(b[i:i + 199]) AS h
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM bytes WHERE octet_length(b) >= 200)
), repeated AS (
  SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), hits AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true) AS opens
  FROM windows SEMI JOIN repeated USING (h)
), spans AS (
  SELECT doc_id, min(i) AS first_byte, max(i) + 199 AS last_byte
  FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits)
  GROUP BY doc_id, run
), edges AS (
  SELECT doc_id, list(first_byte ORDER BY first_byte) AS f, list(last_byte ORDER BY first_byte) AS l,
         sum(last_byte - first_byte + 1) AS n, count(*) AS spans
  FROM spans GROUP BY doc_id
)
SELECT b.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN f IS NULL THEN b ELSE
         unhex(array_to_string([hex(b[(CASE WHEN k = 0 THEN 1 ELSE l[k] + 1 END):(CASE WHEN k = len(f) THEN octet_length(b) ELSE f[k + 1] - 1 END)])
                                FOR k IN range(0, len(f) + 1)], '')) END) AS kept_sha256
FROM bytes b LEFT JOIN edges e ON b.doc_id = e.doc_id
"""
