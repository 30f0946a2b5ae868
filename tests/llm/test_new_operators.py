"""Resampling, filter audit and personal data against DuckDB or plain Python, awkward rows included."""

import hashlib
import math
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.llm import filter_audit, importance, personal_data
from pricetide.llm.hashing import unsqueeze

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} and x{i}@mail.example.org 4111-1111-1111-1111" for i in range(3000))
AWKWARD = [
    (1, "The cat # sat on the MAT", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, "the cat # sat on the mat", ""),
    (5, LONG, "a"),
    (5, LONG, "a"),
    (6, LONG, "b"),
    (None, LONG, "b"),
    (None, None, "b"),
    (7, "é ü 　 ŷ\u0085z 😀word 9lives", "b"),
    (8, "ABC " * 250, "b"),
    (9, "ABC " * 250, "c"),
    (10, " \t\n ", "c"),
    (11, "x+1 (212) 555-1234 9 2 1 10.0.0.300 1.2.3.4.5 " + "7" * 14 + " a@b.c_d@e.f", "c"),
]
COLUMNS = "doc_id long, text string, source string, packed int, failed int, score string, lang string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, s, 1, 2, "x", "en") for i, t, s in AWKWARD], COLUMNS)


def in_duckdb(sql, rows, **tables):
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        database.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    for name, (columns, values) in tables.items():
        database.execute(f"CREATE TABLE {name} ({columns})")
        if values:
            database.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(values[0]))})", values)
    cursor = database.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def same(frame, expected):
    names, rows = expected
    got = [tuple(r[n] for n in names) for r in frame.collect()]
    assert sorted(map(str, got)) == sorted(map(str, rows))


# --- personal data ---------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def test_personal_data_base_spans_equal_plain_python(spark, awkward):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = docs.unionByName(awkward.select("doc_id", "text"))
    texts = {}
    for r in rows.collect():
        texts.setdefault(r.doc_id, []).append(base_spans(r.text))
    for r in personal_data.digest(personal_data.find(rows)).collect():
        base = [s for s in r.spans.split(",") if s.split(":")[0] in BASE]
        assert base in texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k + ":") for s in base) for k in BASE]


CASES = {
    "IBAN DE89 3704 0044 0532 0130 00 IS MINE": ["iban:5:32"],
    "IBAN DE88 3704 0044 0532 0130 00": [],
    "GB29NWBK60161331926819X": [],
    "ES91 2100 0418 4502 0005 1332 IN": ["iban:0:29"],
    "ssn 123-45-6789": ["ssn:4:15"],
    "order 123-45-6789 and ssn": [],
    "123-45-6789": [],
    "ssn 000-45-6789, social 912-45-6789": [],
    "call (212) 555-1234": ["tel:5:19"],
    "call 212.555.1234 now": ["tel:5:17"],
    "call +1 212-555-1234": ["phone:5:20"],
    "212-555-1234": [],
    "card 4111 1111 1111 1111": ["card:5:24"],
    "card 4111 1111 1111 1112": [],
    "a@b.c_d@e.f": ["email:0:5", "email:5:11"],
    "1.2.3.4.5.6.7.8": ["ip:0:7", "ip:8:15"],
    "00000000000000000000000000255.0.0.1": ["ip:0:35"],
}


def test_personal_data_kinds_checksums_and_context(spark):
    rows = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in personal_data.digest(personal_data.find(rows)).collect()}
    for i, (text, spans) in enumerate(CASES.items()):
        found = [s for s in got[i].split(",") if s]
        assert found == spans, text


def test_personal_data_equals_sql_on_awkward_rows(spark, awkward):
    extra = spark.createDataFrame([(100 + i, t, "s") for i, t in enumerate(CASES)], "doc_id long, text string, source string")
    rows = awkward.select("doc_id", "text", "source").unionByName(extra)
    expected = in_duckdb(personal_data.SQL, [tuple(r) for r in rows.collect()])
    same(personal_data.digest(personal_data.find(rows)), expected)


def test_personal_data_keeps_other_columns_and_empty_tables(spark, awkward):
    found = personal_data.find(awkward)
    assert found.columns == [*awkward.columns, "personal_data"]
    assert personal_data.digest(personal_data.find(awkward.limit(0))).collect() == []


def test_personal_data_survives_very_long_runs(spark):
    texts = ["9" * 200_000, "a" * 300_000, "1 " * 200_000, "+1" + " " * 100_000, "1." * 100_000, "AB12" * 50_000, "x1.co@q.de " * 3_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data.digest(personal_data.find(rows)).collect():
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE] == (base_spans(texts[r.doc_id]) if r.spans else [])


# --- importance resampling --------------------------------------------------------------------


def brute_resample(docs, target, plan):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def features(text):
        words = word.findall((text or "").translate(table))
        runs = [" ".join(words[i : i + n]) for n in range(1, plan.grams + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % plan.buckets for r in runs]

    s, t = [0] * plan.buckets, [0] * plan.buckets
    own = [(i, *features(text)) for i, text in docs]
    for _, _, found in own:
        for b in found:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    n = plan.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + n) / ((s[b] + 1.0) * (sum(t) + n)))) for b in range(n)]
    rows = []
    for i, words, found in own:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= plan.least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for r in rows:
        r.append(None)
    for k, r in enumerate(able[: plan.percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(str, map(tuple, rows)))


@pytest.mark.parametrize("plan", [importance.Resampling(), importance.Resampling(grams=3, buckets=97, percent=50, least=1)])
def test_resampling_equals_plain_python(spark, awkward, plan):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    target = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = importance.resample(docs, target, plan).collect()
    expected = brute_resample([tuple(r) for r in docs.collect()], [r.text for r in target.collect()], plan)
    assert sorted(str(tuple(r)) for r in got) == expected


def test_resampling_equals_sql_on_awkward_rows(spark, awkward):
    items = [(1, "the cat sat"), (2, None), (3, "lives 9lives")]
    target = spark.createDataFrame(items, "item_id long, text string")
    expected = in_duckdb(importance.SQL, AWKWARD, benchmark=("item_id BIGINT, text VARCHAR", items))
    same(importance.resample(awkward, target), expected)


def test_resampling_of_nothing(spark, awkward):
    target = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert importance.resample(awkward.limit(0), target).collect() == []
    assert importance.resample(awkward, target.limit(0)).count() == len(AWKWARD)


def test_runs_across_texts_are_masked():
    text, bucket, words = importance.batch_features([b"a b", b"", b"c"], 2, importance.Features(1 << 30))
    assert text.tolist() == [0, 0, 0, 2] and words.tolist() == [2, 0, 1]
    assert sorted(bucket.tolist()) == sorted(zlib.crc32(x) % (1 << 30) for x in (b"a", b"b", b"a b", b"c"))


# --- filter audit -------------------------------------------------------------------------------

LABELS = [(1, 1, 0), (5, 1, 1), (5, 0, 0), (6, 0, 1), (8, 1, 0), (9, 1, 1), (None, 1, 1), (77, 1, 0)]
KNOWN = "doc_id long, quality int, toxic int"


def test_audit_equals_sql_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(LABELS, KNOWN)
    expected = in_duckdb(filter_audit.SQL, AWKWARD, labels=("doc_id BIGINT, quality INT, toxic INT", LABELS))
    same(filter_audit.audit(awkward, labels), expected)


def test_audit_of_nothing(spark, awkward):
    labels = spark.createDataFrame(LABELS, KNOWN)
    assert filter_audit.audit(awkward.limit(0), labels).collect() == []
    assert filter_audit.audit(awkward, labels.limit(0)).count() == 4 * 600


def test_audit_follows_documents_through_every_order(spark, awkward):
    rows = filter_audit.flagged(awkward).collect()
    audit = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(awkward, spark.createDataFrame(LABELS, KNOWN)).collect()}
    for part in {r.part for r in rows}:
        for order in permutations("ABCDE"):
            left = [r.failed for r in rows if r.part == part]
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                found = audit[part, "".join(order), step]
                assert found.removed == sum(f & bit > 0 for f in left)
                left = [f for f in left if not f & bit]
                assert found.kept == len(left)


def test_matrix_numbers_words_alike_in_all_shards(spark, awkward):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.col("source").alias("part"), "text").repartition(5)
    docs = docs.where("doc_id is not null")
    texts = {r.doc_id: (r.text or "") for r in docs.collect()}
    number, word_of, seen = {}, {}, 0
    for shard in filter_audit.term_matrix(docs).collect():
        ends, columns, counts = (
            np.frombuffer(unsqueeze(bytes(shard[n])), t) for n, t in (("row_ends", "<i4"), ("columns", "<i8"), ("counts", "<i4"))
        )
        for doc_id, lo, hi in zip(shard.doc_id, [0, *ends[:-1]], ends):
            words = re.findall(r"[^\x20\x09-\x0D]+", texts[doc_id])
            assert hi - lo == len(set(words)) and counts[lo:hi].sum() == len(words)
            if len(set(words)) == 1:
                assert number.setdefault(words[0], columns[lo]) == columns[lo]
                assert word_of.setdefault(columns[lo], words[0]) == words[0]
            seen += 1
    assert seen == len(texts)
