"""Token ids in Parquet files that can be read in part.

Documents are dealt out by ranges of their id, encoded, and written in order with a running
start, so the files together are one stream of ids:

* ``ids`` is a list column, dictionary encoded (two bytes an id or less before compression);
  ``doc_id``, ``start`` and ``n_tokens`` are delta encoded, so readers of metadata touch little.
* Row groups of ``ROW_GROUP`` bytes and pages of ``PAGE`` bytes, with column and offset indexes
  (version 2 of the format), let a filter on doc_id or start read only matching pages of ids.

``start`` in a file counts from the first id of its part; a part's own start is the sum of the
parts before it, one number per file.

Encoding takes the tokenizers library to pieces of text between single spaces: for tokenizers
whose pre-tokenizer never looks across a space that follows a non-space and precedes another
(byte-level BPE), pieces encode alone as they do in place. Texts are split and their distinct
pieces found a block at a time. Each worker keeps what it has encoded, as most pieces recur; new
pieces are encoded many in one text and cut apart by the bytes of their tokens. Texts with runs of
white space that the rule does not cover are encoded whole.

Defined cases: null text counts as empty, and an empty text is its end id alone; null ids come
first; rows that repeat an id lie together, in the order of a hash of their texts; an empty
table writes files without rows.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm import rounds
from pricetide.llm.shared import shared_path, ship, table, text_bytes

TOKENIZER, END = "byte_bpe_50k.json", 2
ROW_GROUP, PAGE = 8 << 20, 64 << 10
KEPT_CHARS = 5_000_000  # of encoded pieces in a worker's memory, some 150 MB with their ids
_ROWS = 2000  # rows whose texts are held at a time
_BLOCK = 1 << 22  # characters that are split at a time
_JOINED = 2000  # new pieces that are encoded as one text
_SPACE = r"[\x09-\x0D\x1C-\x1F\x{85}\pZ]"  # the white space of Unicode
_UNSAFE = rf"{_SPACE} {_SPACE}|{_SPACE} \z"
#: A full stop or comma between a letter or digit and a space is always a token of its own: it
#: becomes a piece, marked as not coming after a space.
_STOP, _MARK = "([0-9A-Za-z])([.,]) ", "\x01"
_PLAIN = r"(?s)\A[!-~\pL\pN_](?:.*[!-~\pL\pN_])?\z"  # no white space at either end
WRITTEN = "part int, doc_id bigint, start bigint, n_tokens bigint, ids array<int>"
WRITTEN_TYPE = pa.schema(
    [("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


class _Grown:
    """A number array that grows at its end."""

    def __init__(self, values: list[int], kind: type):
        self.data, self.size = np.array(values, kind), len(values)

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            self.data = np.resize(self.data, 2 * (self.size + len(values)))
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


def _texts(pieces: pa.Array) -> list[str]:
    return pieces.to_numpy(zero_copy_only=False).tolist()


class Pieces:
    """Ids of pieces of text, encoded once and kept."""

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # The library takes the names of added tokens out of a text before it splits the rest.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_level = isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.normalizer is None
        self.joins = byte_level and not any(" " in name for name in self.added)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # bytes of each token
        self.width[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.end = end
        self.forget()

    def forget(self) -> None:
        self.inner, self.first, self.whole = {}, {}, {}
        self.ids, self.at = _Grown([self.end], np.int32), _Grown([0, 1], np.int64)
        self.chars = 0

    def _numbers(self, known: dict[str, int], pieces: pa.Array, lead: str = "") -> np.ndarray:
        """Numbers of distinct pieces; new ones are encoded, each after ``lead``."""
        texts = _texts(pieces)
        numbers = np.fromiter(map(known.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            missing = pieces.take(pa.array(new))
            joined = np.zeros(len(new), bool)
            led = missing
            if lead:  # pieces hold no space, so a mark that comes after one leads its piece
                space, nothing = pa.scalar(lead, missing.type), pa.scalar("", missing.type)
                led = pc.replace_substring(pc.binary_join_element_wise(space, missing, nothing), lead + _MARK, "")
                if self.joins:
                    joined = pc.match_substring_regex(missing, _PLAIN).to_numpy(zero_copy_only=False)
            for some, encode in ((joined, self._joined), (~joined, self._alone)):
                own, batch = new[some], led.filter(pa.array(some))
                for lo in range(0, len(own), _JOINED):
                    ids, size = encode(batch.slice(lo, _JOINED))
                    numbers[own[lo : lo + _JOINED]] = self.at.size - 1 + np.arange(len(size))
                    self.at.extend(self.ids.size + np.cumsum(size))
                    self.ids.extend(ids)
            known.update(zip([texts[i] for i in new.tolist()], numbers[new].tolist()))
            self.chars += pc.sum(pc.utf8_length(missing)).as_py() + len(new)
        return numbers

    def _alone(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(_texts(pieces), add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(size.sum())), size

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``_alone`` in one text, cut where the bytes of the tokens add up to those of a piece."""
        text = "".join(_texts(pieces))
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        ends = np.cumsum(self.width[ids])
        wanted = np.cumsum(pc.binary_length(pieces).to_numpy())
        last = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[last] != wanted).any():  # bytes the vocabulary lacks
            return self._alone(pieces)
        return ids, np.diff(last, prepend=-1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and how many each has."""
        if self.chars > KEPT_CHARS:
            self.forget()
        whole = [_MARK, *self.added]
        rows = pa.array(texts, pa.large_string())
        cut = ~pc.match_substring_regex(rows, _UNSAFE).to_numpy(zero_copy_only=False)
        cut &= np.fromiter((not any(name in t for name in whole) for t in texts), bool, len(texts))
        marked = pc.replace_substring_regex(rows.filter(pa.array(cut)), _STOP, rf"\1 {_MARK}\2 ")
        split = pc.split_pattern(marked, " ")
        offsets = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        code, pieces = coded.indices.to_numpy(), coded.dictionary
        heads = np.zeros(len(code), bool)
        heads[offsets[:-1]] = True
        number = np.empty(len(code), np.int64)
        for some, known, lead in ((heads, self.first, ""), (~heads, self.inner, " ")):
            codes = code[some]
            found = np.zeros(len(pieces), bool)
            found[codes] = True
            own = np.flatnonzero(found)
            of_code = np.empty(len(pieces), np.int64)
            of_code[own] = self._numbers(known, pieces.take(pa.array(own)), lead)
            number[some] = of_code[codes]
        rest = list(compress(texts, ~cut))
        distinct = list(dict.fromkeys(rest))
        whole = dict(zip(distinct, self._numbers(self.whole, pa.array(distinct, pa.large_string())).tolist()))

        counts = np.full(len(texts), 2)  # numbers of each text: its pieces, and 0 for the end id
        counts[cut] = np.diff(offsets) + 1
        starts = np.cumsum(counts) - counts
        numbers = np.zeros(counts.sum(), np.int64)
        numbers[np.repeat(starts[cut] - offsets[:-1], np.diff(offsets)) + np.arange(len(code))] = number
        numbers[starts[~cut]] = [whole[t] for t in rest]
        at = self.at.data
        start = at[numbers]
        size = at[numbers + 1] - start
        ends = np.cumsum(size)
        place = np.repeat(start - ends + size, size)
        place += np.arange(len(place))
        ids = self.ids.data.take(place)
        upto = ends[np.cumsum(counts) - 1]
        return ids, np.diff(upto, prepend=0)


@lru_cache(maxsize=2)
def _pieces(path: str, end: int) -> Pieces:
    return Pieces(path, end)


def _encoder(path: str, end: int):
    def encode(batches):
        pieces, start, part = _pieces(path, end), 0, TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                rows, at = batch.slice(lo, _ROWS), 0
                texts = [t or "" for t in rows["text"].to_pylist()]
                for block in rounds.blocks(texts, [len(t) for t in texts], _BLOCK):
                    ids, size = pieces.encode(block)
                    offsets = np.concatenate(([0], np.cumsum(size)))
                    columns = [
                        pa.array(np.full(len(block), part, np.int32)),
                        rows["doc_id"].slice(at, len(block)).cast(pa.int64()),
                        pa.array(start + offsets[:-1]),
                        pa.array(size),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=WRITTEN_TYPE)
                    start, at = start + int(offsets[-1]), at + len(block)

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, part_bytes: int = 1 << 24) -> None:
    """Encode (doc_id, text) and write the ids in ascending doc_id order."""
    ship(docs.sparkSession)
    parts = max(1, -(-text_bytes(docs) // part_bytes))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    options = {
        "compression": "zstd",
        "parquet.writer.version": "v2",
        "parquet.block.size": ROW_GROUP,
        "parquet.page.size": PAGE,
        "parquet.page.row.count.limit": 1000,
        "parquet.dictionary.page.size": 1 << 20,
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "start", "n_tokens")},
    }
    ordered.mapInArrow(_encoder(tokenizer, end), WRITTEN).write.options(**options).parquet(path)


def part_starts(rows: DataFrame) -> DataFrame:
    """(part, base): ids in all parts before; one row per part."""
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) with the start counted over all files."""
    rows = spark.read.schema(WRITTEN).parquet(path)
    return rows.join(part_starts(rows), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def _digest(batches):
    for batch in batches:
        lists = batch["ids"]
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
        data = memoryview(np.ascontiguousarray(values)).cast("B")
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        size = pa.array(np.diff(offsets).astype(np.int64))
        kept = [batch["part"], batch["doc_id"], batch["start"]]
        yield pa.RecordBatch.from_arrays([*kept, size, pa.array(sums, pa.int64())], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the ids in the files."""
    ship(spark)
    rows = spark.read.schema(WRITTEN).parquet(path)
    found = rows.select("part", "doc_id", "start", "ids").mapInArrow(
        _digest, "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return found.join(part_starts(rows), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path(TOKENIZER))
    return digests(spark, path)
