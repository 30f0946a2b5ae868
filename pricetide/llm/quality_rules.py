"""Quality rules whose thresholds come from the corpus itself, per language and source.

Text statistics of every document (one pass, numpy over blocks of texts) give a few whole-number
rates. Their distribution is kept in a mergeable quantile sketch: the number of documents for
each value of a rate, with the value cut to its three leading decimal digits. Counts add up, so
sketches of sources merge into those of languages and of the corpus, in any order and with the
same result; a quantile is off by less than 1 %, and a sketch has at most some thousand cells.

A rate's limits in a group are its median plus or minus ``SPREADS`` times the distance to the
10th or 90th percentile on the far side of the fault (so junk of up to half of a group does not
move them), plus a fixed slack that keeps uniform groups from rejecting ordinary variation.
Groups are (language, source) where at least ``LEAST`` documents pass the base rules, else the
language, else the corpus. Documents are then joined with the limits of their group.

Defined cases: null text has no words and fails the base rules; null languages and sources are
groups of their own; rows that repeat count and are judged each for itself; a document whose
group has no sketch (none of it passes the base rules) takes the limits of the next larger
group; without any sketch nothing but the base rules decides. In ``filter_documents`` all
columns of the input are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.llm import rounds
from pricetide.llm.hashing import U, Words, byte_range_hash, byte_sums, covered, mix
from pricetide.llm.shared import ship, stage, table

WINDOW = 5
LEAST, SPREADS = 50, 4
#: rate: (slack above, slack below or None for no lower limit); rates are whole numbers.
RATES = {
    "symbol_rate": (100, None),  # symbols per 1000 words
    "stutter_rate": (250, None),  # words equal to the word before, per 1000 words
    "dup_line_rate": (500, None),  # lines equal to an earlier line, per 1000 lines with a word
    "word_length": (40, 20),  # characters per 10 words
}
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter"]
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of ``STATS`` for each text of a block."""
    words = Words(texts)
    data, edges, n = words.data, words.text_starts, len(texts)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return sums[edges[1:]] - sums[edges[:-1]]

    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    word_chars = np.bincount(words.text, chars[words.end] - chars[words.start], n)
    line_end = np.flatnonzero(data == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1))
    text = np.searchsorted(edges, line_start, side="right") - 1
    has_word = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    text, line_start, line_end = text[has_word], line_start[has_word], line_end[has_word]
    lines = byte_range_hash(byte_sums(data), line_start, line_end)
    distinct = np.unique(mix(lines + text.astype(U)) ^ text.astype(U), return_index=True)[1]
    n_lines = np.bincount(text, minlength=n)
    at, hashes = words.windows(WINDOW)
    own = mix(hashes + words.text[at].astype(U))
    _, which, count = np.unique(own, return_inverse=True, return_counts=True)
    repeats = covered(at[count[which] > 1], WINDOW, len(words.start))
    stutter = np.zeros(len(words.start), bool)
    stutter[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    columns = (
        words.count,
        word_chars,
        total(_SYMBOL[data]),
        n_lines - np.bincount(text[distinct], minlength=n),
        np.bincount(words.text[repeats], minlength=n),
        n_lines,
        np.bincount(words.text[stutter], minlength=n),
    )
    return {name: c.astype(np.int64) for name, c in zip(STATS, columns)}


def _measure(batches):
    for batch in batches:
        names_in = batch.schema.names
        texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
        at = 0
        for block in rounds.blocks(texts, [len(t) for t in texts], 1 << 21):
            found = statistics(block)
            part = batch.slice(at, len(block))
            if "_drop_text" in names_in:
                part = part.drop_columns(["text", "_drop_text"])
            names = [f"_{s}" for s in STATS]
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, found.values())], names=[*part.schema.names, *names])
            at += len(block)


def measured(rows: DataFrame, keep_text: bool) -> DataFrame:
    """Rows with their statistics in columns named _n_words and so on; needs a column text."""
    ship(rows.sparkSession)
    fields = [f for f in rows.schema if keep_text or f.name != "text"]
    if not keep_text:
        rows = rows.withColumn("_drop_text", F.lit(True))
    schema = T.StructType([*fields, *(T.StructField(f"_{s}", T.LongType()) for s in STATS)])
    return rows.mapInArrow(_measure, schema)


def base_failed() -> Column:
    return F.expr("_n_words < 10 or 100 * _n_repeat_words > 20 * _n_words")


def rates() -> dict[str, Column]:
    return {
        "symbol_rate": F.expr("1000 * _n_symbols div greatest(_n_words, 1)"),
        "stutter_rate": F.expr("1000 * _n_stutter div greatest(_n_words, 1)"),
        "dup_line_rate": F.expr("1000 * _n_dup_lines div greatest(_n_lines, 1)"),
        "word_length": F.expr("10 * _word_chars div greatest(_n_words, 1)"),
    }


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, rate, value, n) over the rows that pass the base rules."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("rate"), v.alias("v")) for k, v in rates().items())))
    rows = rows.where(~base_failed()).select("lang", "source", pairs.alias("p")).select("lang", "source", "p.*")
    # three leading digits: 12345 becomes 12300
    step = F.pow(F.lit(10.0), F.greatest(F.lit(0), F.length(F.col("v").cast("string")) - 3)).cast("bigint")
    value = (F.col("v") - F.col("v") % step).alias("value")
    return rows.groupBy("lang", "source", "rate", value).agg(F.count("*").alias("n"))


def limits(cells: DataFrame) -> DataFrame:
    """(lang, source, and a lower and an upper limit for each rate) for each group of a sketch."""
    levels = (
        cells.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .select(
            "level",
            F.when(F.col("level") < 2, F.col("lang")).alias("lang"),
            F.when(F.col("level") < 1, F.col("source")).alias("source"),
            "rate",
            "value",
            "n",
        )
        .groupBy("level", "lang", "source", "rate", "value")
        .agg(F.sum("n").alias("n"))
    )
    group = Window.partitionBy("level", "lang", "source", "rate")
    levels = levels.withColumn("upto", F.sum("n").over(group.orderBy("value"))).withColumn("all", F.sum("n").over(group))
    quantile = {q: F.min(F.when(F.col("upto") * 100 >= F.col("all") * q, F.col("value"))) for q in (10, 50, 90)}
    levels = levels.groupBy("level", "lang", "source", "rate").agg(
        F.max("all").alias("docs"), *(c.alias(f"q{q}") for q, c in quantile.items())
    )
    levels = levels.withColumn("hi", F.col("q50") + SPREADS * (F.col("q50") - F.col("q10"))).withColumn(
        "lo", F.col("q50") - SPREADS * (F.col("q90") - F.col("q50"))
    )
    wide = []
    for rate, (above, below) in RATES.items():
        own = F.col("rate") == rate
        wide.append(F.max(F.when(own, F.col("hi") + above)).alias(f"{rate}_max"))
        wide.append((F.max(F.when(own, F.col("lo") - below)) if below else F.lit(None).cast("bigint")).alias(f"{rate}_min"))
    wide = levels.groupBy("level", "lang", "source").agg(F.max("docs").alias("docs"), *wide)
    return stage(wide, "limits")


def judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``measured`` with base_failed, kept and the group level that judged them."""
    names = [c for c in found.columns if c.endswith(("_max", "_min"))]
    out = rows
    for level, keys in ((0, ["lang", "source"]), (1, ["lang"]), (2, [])):
        side = found.where((F.col("level") == level) & ((F.col("docs") >= LEAST) | (F.col("level") == 2)))
        side = side.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.struct("level", *names).alias(f"_l{level}"))
        if keys:
            on = F.lit(True)
            for k in keys:
                on = on & out[k].eqNullSafe(F.col(f"_k_{k}"))
            out = out.join(side, on, "left").drop(*(f"_k_{k}" for k in keys))
        else:  # one row at most: a scalar
            whole = side.agg(F.first(f"_l{level}")).first()[0]
            kind = side.schema[f"_l{level}"].dataType
            values = [F.lit(whole[f.name] if whole else None).cast(f.dataType).alias(f.name) for f in kind]
            out = out.withColumn(f"_l{level}", F.struct(*values))
    out = out.withColumn("_l", F.coalesce("_l0", "_l1", "_l2")).drop("_l0", "_l1", "_l2")
    good = F.lit(True)
    for rate, column in rates().items():
        good = good & F.coalesce(column <= F.col(f"_l.{rate}_max"), F.lit(True))
        good = good & F.coalesce(column >= F.col(f"_l.{rate}_min"), F.lit(True))
    out = out.withColumn("_base_failed", base_failed())
    return out.withColumn("_kept", ~F.col("_base_failed") & good)


def judge_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics, base_failed, kept, judged_by) for each row; judged_by is the level
    of the group: 0 language and source, 1 language, 2 corpus."""
    rows = stage(measured(docs.select("doc_id", "lang", "source", "text"), keep_text=False), "statistics")
    out = judged(rows, limits(sketch(rows)))
    return out.select(
        "doc_id",
        *(F.col(f"_{s}").alias(s) for s in STATS),
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.col("_l.level").alias("judged_by"),
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their columns."""
    cells = sketch(measured(docs.select("lang", "source", "text"), keep_text=False))
    own = {c: c if c in ("lang", "source", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in own.items()))
    kept = judged(measured(rows, keep_text=True), limits(cells)).where("_kept")
    return kept.select(*(F.col(name).alias(c) for c, name in own.items()))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_documents(table(spark, folder, "documents"))


def _sql() -> str:
    rate = {
        "symbol_rate": "1000 * n_symbols // greatest(n_words, 1)",
        "stutter_rate": "1000 * n_stutter // greatest(n_words, 1)",
        "dup_line_rate": "1000 * n_dup_lines // greatest(n_lines, 1)",
        "word_length": "10 * word_chars // greatest(n_words, 1)",
    }
    unpivot = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS rate, {v} AS v FROM stats WHERE NOT base_failed" for k, v in rate.items())
    wide = ", ".join(
        f"max(CASE WHEN rate = '{k}' THEN hi + {above} END) AS {k}_max, "
        + (f"max(CASE WHEN rate = '{k}' THEN lo - {below} END)" if below else "NULL::BIGINT")
        + f" AS {k}_min"
        for k, (above, below) in RATES.items()
    )
    level = f"CASE WHEN a.docs >= {LEAST} THEN 0 WHEN b.docs >= {LEAST} THEN 1 WHEN c.docs IS NOT NULL THEN 2 END"
    pick = lambda k, end: f"CASE {level} WHEN 0 THEN a.{k}_{end} WHEN 1 THEN b.{k}_{end} ELSE c.{k}_{end} END"
    good = " AND ".join(f"coalesce({v} {op} {pick(k, end)}, true)" for k, v in rate.items() for op, end in (("<=", "max"), (">=", "min")))
    return rf"""
WITH parts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM parts WHERE len(w) >= 5)
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM windows) WHERE k > 1)
  GROUP BY doc_id
), counted AS (
  SELECT p.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]])::BIGINT AS n_stutter
  FROM parts p LEFT JOIN repeats r ON p.doc_id = r.doc_id
), stats AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), flat AS (
  {unpivot}
), cells AS (
  SELECT lang, source, rate, v - v % (10 ** greatest(0, length(v::VARCHAR) - 3))::BIGINT AS value, count(*) AS n
  FROM flat GROUP BY ALL
), levels AS (
  SELECT 0 AS level, lang, source, rate, value, n FROM cells
  UNION ALL SELECT 1, lang, NULL, rate, value, sum(n) FROM cells GROUP BY lang, rate, value
  UNION ALL SELECT 2, NULL, NULL, rate, value, sum(n) FROM cells GROUP BY rate, value
), running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY value) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, rate) AS total
  FROM levels
), quantiles AS (
  SELECT level, lang, source, rate, max(total) AS docs,
         min(CASE WHEN upto * 100 >= total * 10 THEN value END) AS q10,
         min(CASE WHEN upto * 100 >= total * 50 THEN value END) AS q50,
         min(CASE WHEN upto * 100 >= total * 90 THEN value END) AS q90
  FROM running GROUP BY ALL
), bounds AS (
  SELECT *, q50 + {SPREADS} * (q50 - q10) AS hi, q50 - {SPREADS} * (q90 - q50) AS lo FROM quantiles
), wide AS (
  SELECT level, lang, source, max(docs) AS docs, {wide} FROM bounds GROUP BY level, lang, source
)
SELECT s.doc_id, s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, s.n_lines, s.n_stutter,
       s.base_failed, NOT s.base_failed AND {good} AS kept, ({level})::INTEGER AS judged_by
FROM stats s
LEFT JOIN wide a ON a.level = 0 AND a.lang IS NOT DISTINCT FROM s.lang AND a.source IS NOT DISTINCT FROM s.source
LEFT JOIN wide b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM s.lang
LEFT JOIN wide c ON c.level = 2
"""


SQL = _sql()
