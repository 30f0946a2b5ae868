"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents link when the sets of their 5-word shingles have a Jaccard similarity of at least
``percent``/100. Only sets that could link are compared:

1. One round of ``rounds`` counts, for every shingle, the different sets that hold it (copies of
   a set in one chunk count once). This orders all shingles, rarest first. The counts compare
   shortened hashes, so a count can only be too high, alike everywhere; that costs work, not links.
2. A set of n shingles shares at least t = ceil(n * percent / 100) with any partner, so partners
   share l of their first n - t + l shingles, for any l up to t. Each document picks the l with the
   least estimated cost: the sum of the counts in its prefix, plus the comparisons that remain
   when l matches are asked for. Partners must share the smaller of their two l.
3. A prefix shingle that no other set holds cannot match. Most documents have no other kind in
   their prefix, and drop out here with all their shingles.
4. Equal sets become one. Sets that share a prefix shingle meet in the block of the least of
   them (by hash), once for all the shingles that lead there; a set with fewer shared prefix
   shingles than any partner there asks for stays out. In a block, prefix matches are counted
   first, then, where enough match and the sizes fit, whole sets are compared. Blocks of over
   ``BLOCK`` sets are cut into slices, and each two slices are compared, so no comparison holds
   more than two slices and no pair is left out. A comparison returns the links of a spanning
   forest, at most one row per set in it.
5. Connected components over those links, by joins.

Defined cases: null or wordless text has an empty set and no links; a text of fewer than five
words has its whole sequence as its one shingle; rows that repeat an id are rows of their own,
linked if their sets are; a null id never is a component's name unless all its ids are null.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm import rounds
from pricetide.llm.components import components
from pricetide.llm.hashing import U, Words, mix, pack, squeeze, unpack, unsqueeze
from pricetide.llm.shared import stage, table

SHINGLE, PERCENT = 5, 80
BLOCK = 1024  # sets in a slice
MOST_MATCHES = 8  # the largest l tried
SETS = "chunk int, doc_id bigint, row bigint, row2 int, sid binary, n bigint, ell int, tokens array<bigint>, rest binary"
SETS_TYPE = pa.schema(
    [("chunk", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("row2", pa.int32()), ("sid", pa.binary()), ("n", pa.int64()), ("ell", pa.int32()), ("tokens", pa.list_(pa.int64())), ("rest", pa.binary())]
)


class Sets:
    """Shingle sets of a chunk: ``hash`` ascending within each text, cut at ``first``."""

    def __init__(self, texts: list[bytes], size: int):
        words = Words(texts, lower=True)
        at, hashes = words.windows(size)
        short = np.flatnonzero((words.count > 0) & (words.count < size))
        text = np.concatenate((words.text[at], short))
        hashes = np.concatenate((hashes, words.whole()[short]))
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        self.text, self.hash = text[new], hashes[new]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.n = np.diff(self.first)
        sums = [np.concatenate(([U(0)], np.cumsum(mix(self.hash ^ U(salt)), dtype=U))) for salt in (0x5851F42D, 0x14057B7E)]
        parts = [s[self.first[1:]] - s[self.first[:-1]] for s in sums]
        raw = np.stack((parts[0], parts[1] + self.n.astype(U)), axis=1).astype("<u8").tobytes()
        self.sid = [raw[16 * i : 16 * i + 16] if n else None for i, n in enumerate(self.n.tolist())]
        seen: set[bytes | None] = {None}
        self.lead = np.array([not (s in seen or seen.add(s)) for s in self.sid], bool)  # first of its set here

    def counted(self, drop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shortened hashes of leading texts, how many hold each, and each hash's place."""
        held = self.lead[self.text]
        distinct, which, count = np.unique(self.hash[held] >> U(drop) << U(drop), return_inverse=True, return_counts=True)
        return distinct, count, which


def _send_counts(size, drop, buckets):
    def send(chunk: pa.Table) -> pa.Table:
        distinct, count, _ = Sets(rounds.texts_of(chunk), size).counted(drop)
        count = np.minimum(count, 255).astype(np.uint8)
        sent = rounds.send(chunk["chunk"][0].as_py(), distinct, buckets, lambda lo, hi: squeeze(count[lo:hi]), drop)
        return pa.table(sent, schema=rounds.SENT_TYPE)

    return send


def _sum_counts(first, group, order, extras, sizes) -> np.ndarray:
    count = np.concatenate([np.frombuffer(unsqueeze(e), np.uint8) for e in extras])[order]
    return np.minimum(np.add.reduceat(count.astype(np.int64), first), 255)[group]


def prefix(df: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """(length of the prefix, matches to ask for) of a set whose counts, ascending, are ``df``."""
    n = len(df)
    t = -(-n * percent // 100)
    ells = np.arange(1, min(MOST_MATCHES, t) + 1)
    cost = np.cumsum(df.astype(np.int64) - 1)[n - t + ells - 1]
    ell = int(ells[np.argmin(cost + cost / ells * n / 32)])
    return n - t + ell, ell


def _describe(size, drop, percent):
    def describe(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return SETS_TYPE.empty_table()
        sets = Sets(rounds.texts_of(chunk), size)
        held = sets.lead[sets.text]
        df = np.zeros(len(sets.hash), np.uint8)
        if held.any():
            df[held] = rounds.answered(answers)[sets.counted(drop)[2]]
        order = np.lexsort((sets.hash, df, sets.text))  # within a text: by count, then hash
        df, hashes = df[order], sets.hash[order]
        out = {name: [] for name in SETS_TYPE.names}
        number = chunk["chunk"][0].as_py()
        names = zip(*(chunk[c].to_pylist() for c in ("doc_id", "row", "row2")))
        for i, name in enumerate(names):
            ell = tokens = rest = None
            if sets.lead[i]:
                lo, hi = sets.first[i], sets.first[i + 1]
                length, ell = prefix(df[lo:hi], percent)
                tokens = hashes[lo : lo + length][df[lo : lo + length] > 1]
                if len(tokens):
                    rest = pack(np.sort(hashes[lo + length : hi][df[lo + length : hi] > 1]))
                    tokens = tokens.view(np.int64)
                else:
                    ell = tokens = None
            for column, value in zip(out, (number, *name, sets.sid[i], int(sets.n[i]), ell, tokens, rest)):
                out[column].append(value)
        return pa.table(out, schema=SETS_TYPE)

    return describe


def overlaps(tokens: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sets."""
    m = len(tokens)
    out = np.zeros((m, m), np.int64)
    owner = np.repeat(np.arange(m), [len(t) for t in tokens])
    values, which, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = count[which] > 1
    owner, which = owner[shared], which[shared]
    dense = count[which] > 32
    order = np.argsort(which[~dense], kind="stable")
    w, o = which[~dense][order], owner[~dense][order]
    gap = 1
    while True:  # neighbours at each distance within a token's owners
        same = w[gap:] == w[:-gap]
        if not same.any():
            break
        pair = np.bincount(o[:-gap][same] * m + o[gap:][same], minlength=m * m).reshape(m, m)
        out += pair + pair.T
        gap += 1
    columns, at = np.unique(which[dense], return_inverse=True)
    for lo in range(0, len(columns), 4096):
        block = np.zeros((m, min(4096, len(columns) - lo)), np.float32)
        inside = (at >= lo) & (at < lo + 4096)
        block[owner[dense][inside], at[inside] - lo] = 1
        out += np.rint(block @ block.T).astype(np.int64)
    return out


def links(n: np.ndarray, ell: np.ndarray, side: np.ndarray, heads: list, rests: list, percent: int) -> np.ndarray:
    """Which sets of a block link; only sets on different sides if there are two sides."""
    fits = 100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n)
    fits &= ~np.eye(len(n), dtype=bool)
    if side.any() and not side.all():
        fits &= side[:, None] != side[None, :]
    if not fits.any():
        return fits
    fits &= overlaps(heads) >= np.minimum.outer(ell, ell)
    left = np.flatnonzero(fits.any(axis=1))
    if len(left):
        whole = overlaps([np.concatenate((heads[i], unpack(rests[i]))) for i in left])
        sizes = np.add.outer(n[left], n[left])
        fits[np.ix_(left, left)] &= 100 * whole >= percent * (sizes - whole)
    return fits


def forest(link: np.ndarray) -> list[tuple[int, int]]:
    """(node, root) for every node of a link matrix that has links and is not the root."""
    root = np.arange(len(link))
    while True:
        least = np.where(link, root[None, :], len(link)).min(axis=1, initial=len(link))
        new = np.minimum(root, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return [(i, int(r)) for i, r in enumerate(root) if r != i]
        root = new


def _verify(percent):
    def verify(rows: pa.Table) -> pa.Table:
        sids, n, ell = rows["sid"].to_pylist(), rows["n"].to_numpy(), rows["ell"].to_numpy()
        side, rests = rows["side"].to_numpy(), rows["rest"].to_pylist()
        lists = rows["tokens"].combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(U)
        keys = np.stack([rows[c].to_numpy() for c in ("gid", "i", "j")])
        order = np.lexsort(keys)
        keys = keys[:, order]
        cuts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True])))
        a, b = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = order[lo:hi]
            heads = [values[offsets[r] : offsets[r + 1]] for r in own]
            for node, root in forest(links(n[own], ell[own], side[own], heads, [rests[r] for r in own], percent)):
                a.append(sids[own[node]])
                b.append(sids[own[root]])
        return pa.table({"a": a, "b": b}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    return verify


def set_links(sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(a, b): set ids whose links connect the same sets as all links do."""
    sent = sets.where("tokens is not null")
    one = sent.groupBy("sid").agg(F.min("chunk").alias("chunk"))
    sent = sent.join(one, ["sid", "chunk"], "left_semi")
    held = stage(sent.select("sid", "ell", F.explode("tokens").alias("token")), "prefixes")
    # a group meets in the block of its least member, where a set comes once for all its groups
    mark = F.xxhash64("sid")
    groups = held.groupBy("token").agg(F.count("*").alias("m"), F.min("ell").alias("asked"), F.min(mark).alias("hub"))
    shared = held.select("sid", "token").join(groups.where("m > 1"), "token")
    # every pair of a group shares at least ``asked`` shingles, so its sets have as many with company
    company = shared.groupBy("sid").agg(F.count("*").alias("company"))
    members = shared.join(company, "sid").where("company >= asked").select("hub", "sid").distinct()
    members = stage(members, "members")
    sizes = members.groupBy("hub").agg(F.ceil(F.count("*") / block).cast("int").alias("k"), F.count("*").alias("m"))
    members = members.join(sizes.where("m > 1"), "hub")
    members = members.withColumn("mine", F.pmod(mark, F.col("k")).cast("int"))
    members = stage(members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))), "blocks")
    bins = max(1, members.count() // 2000)
    placed = members.select(
        "sid",
        F.col("hub").alias("gid"),
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
    ).withColumn("bin", F.pmod(F.xxhash64("gid", "i", "j"), F.lit(bins)).cast("int"))
    shipped = placed.join(sent.select("sid", "n", "ell", "tokens", "rest"), "sid")
    return shipped.groupBy("bin").applyInArrow(_verify(percent), "a binary, b binary")


def _row_names() -> tuple[Column, Column]:
    """Two hashes (96 bits) that name a row by id and text; repeated rows have one name."""
    return F.xxhash64("doc_id", "text").alias("row"), F.hash("text", "doc_id").alias("row2")


def classified(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, row, row2, n, root) for each row of docs; rows of one root are connected, and
    rows without a root (no words) are linked with nothing."""
    plan = rounds.deal(docs)
    drop = max(0, 64 - 8 - plan.size.bit_length())
    texts = rounds.dealt(docs, plan, *_row_names())
    counts = texts.groupBy("chunk").applyInArrow(_send_counts(size, drop, plan.buckets), rounds.SENT)
    answers = rounds.answer(counts, _sum_counts)
    sets = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_describe(size, drop, percent), SETS)
    sets = stage(sets, "sets")
    roots = components(set_links(sets, percent, block)).withColumnRenamed("node", "sid")
    rows = sets.select("doc_id", "row", "row2", "sid", "n").join(roots, "sid", "left")
    return rows.withColumn("root", F.coalesce("root", "sid")).drop("sid")


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs."""
    rows = classified(docs, size, percent, block)
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rows.join(names, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row of each component, with its columns: the one with the smallest id (nulls last).

    Rows without words stay; rows that repeat id and text become one row.
    """
    rows = stage(classified(docs, size, percent, block), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "row2")).alias("f")
    kept = rows.where("root is not null").groupBy("root").agg(first).select("f.row", "f.row2")
    kept = kept.unionByName(rows.where("root is null").select("row", "row2"))
    keys = ["row", "row2"]
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    named = docs.select(whole, *_row_names())
    return named.join(kept, keys, "left_semi").dropDuplicates(keys).select("whole.*")


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return join(table(spark, folder, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS (
  SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON s.doc_id = c.x
"""
