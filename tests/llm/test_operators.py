"""Operators against plain Python and SQL, on awkward small tables."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricetide.llm import (
    html_text, mixing, ngram_join, quality_rules, queries, sentencepieces, simhash, substring_dedup, suffix_dedup, token_files, warc,
)
from pricetide.llm.components import components
from pricetide.llm.shared import ship
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
SQL, QUERIES = queries.statements(), queries.registered()


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    ship(spark)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    rows = QUERIES[name](spark, FOLDER)
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(rows.columns) == sorted(names)
    expected = sorted(str(r) for r in cursor.fetchall())
    assert sorted(str(tuple(r[c] for c in names)) for r in rows.collect()) == expected


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and"] + [f"w{i}" for i in range(60)]) for _ in range(n))


def corpus():
    """Nulls, empty and long texts, ties, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 60)
    near = base.split()
    near[70] = "edited"
    rows = [
        (7, base), (3, base), (9, " ".join(near)), (4, None), (5, ""), (6, " \t\n"), (8, "One two"), (2, "one  TWO"),
        (11, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"), (12, f"{prose(rng, 50)} {passage}"), (13, passage * 3),
        (14, "é" * 300), (15, "xé" * 250), (16, "long " * 5000 + prose(rng, 3000)), (17, prose(rng, 9)), (17, prose(rng, 9)),
        (18, prose(rng, 40)), (18, prose(rng, 40)), (None, base), (None, prose(rng, 20)), (19, "x" * 199), (20, "y" * 201), (21, "a " * 12),
    ]
    rows += [(18, rows[16][1])] * 2  # whole rows repeat
    return [(d, t, [None, "en", "de"][i % 3], [None, "src1", "src2"][i % 2]) for i, (d, t) in enumerate(rows)]


def frame(spark, rows):
    """With extra columns whose names operators use inside."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    for name in ("chunk", "bucket", "row", "_own_0", "_l", "domain", "tokens", "kept", "ids", "whole", "part"):
        docs = docs.withColumn(name, F.lit(1))
    return docs.repartition(3)


def got(rows, *columns):
    return sorted(map(str, (tuple(r[c] for c in columns) for r in rows.collect())))


def test_suffix_dedup(spark):
    rows = [(d, t) for d, t, _, _ in corpus()]
    for depth, seed in ((200, 32), (40, 8), (24, 8)):
        found = suffix_dedup.remove_repeated_strings(frame(spark, corpus()), depth, seed)
        expected = sorted(str(r[:5]) for r in brute.repeated_strings(rows, depth))
        assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_suffix_dedup_pieces(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 4000).encode()
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 1000)
    suffixes = suffix_dedup.Suffixes([text, b"", text], 200, 32)
    windows = sorted(i for a, b in zip(suffixes.first, suffixes.last) for i in range(a, b + 1))
    one = list(range(len(text) - 199))
    assert windows == one + [i + len(text) + 2 for i in one]  # every window has one suffix
    every = np.arange(len(suffixes.first))
    places, *both = suffixes.windows(every, suffixes.first, suffixes.last)
    order = np.argsort(places)
    for hashes in both:
        assert (hashes[order][: len(one)] == hashes[order][len(one) :]).all() and len(set(hashes.tolist())) == len({text[i : i + 200] for i in one})
    own, first, last, part = suffixes.parts(every)
    digit = suffixes.shared(own, part)
    assert sorted(i for a, b in zip(first, last) for i in range(a, b + 1)) == windows  # and one part
    assert (np.sort(digit[: len(digit) // 2]) == np.sort(digit[len(digit) // 2 :])).all()


def test_suffix_dedup_order_of_rows():
    """Shuffled rows reach a task in another order each time; passes must agree all the same."""
    rng = random.Random(3)
    texts = [None, "", *(prose(rng, 80) for _ in range(20))] * 2
    chunks = [pa.table({"chunk": [0] * len(texts), "text": rng.sample(texts, len(texts))}) for _ in range(2)]
    one, other = (suffix_dedup.Sorting(c, None, 0, 200, 32) for c in chunks)
    assert one.texts == other.texts and one.order != other.order
    for name in ("place", "first", "last", "seed"):
        assert (getattr(one.suffixes, name) == getattr(other.suffixes, name)).all()


def test_suffix_dedup_edges(spark):
    """Passages in ever different surroundings: the windows at their edges go through all passes."""
    rng = random.Random(4)
    letters = ["".join(rng.choice("abcd") for _ in range(rng.choice([0, 30, 90, 260]))) for _ in range(60)]
    passages = [prose(rng, 60)[: rng.choice([60, 199, 200, 201, 230])] for _ in range(6)]
    rows = [(i, letters[2 * i] + rng.choice(passages) + letters[2 * i + 1] + rng.choice(passages)[: rng.choice([150, 200, 400])]) for i in range(30)]
    for depth, seed in ((200, 32), (64, 32), (16, 16)):
        found = suffix_dedup.remove_repeated_strings(spark.createDataFrame(rows, "doc_id bigint, text string"), depth, seed)
        expected = sorted(str(r[:5]) for r in brute.repeated_strings(rows, depth))
        assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_substring_dedup(spark):
    rows = [(d, t) for d, t, _, _ in corpus()]
    found = substring_dedup.remove_repeated_windows(frame(spark, corpus()))
    assert got(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(map(str, brute.repeated_windows(rows, 13)))


@pytest.mark.parametrize("block", [1024, 2])
def test_ngram_join(spark, block):
    rows = [(d, t) for d, t, _, _ in corpus()]
    rng = random.Random(8)
    base = prose(rng, 80).split()
    for i in range(40):  # a chain of near copies, each a little further away
        base[rng.randrange(80)] = f"e{i}"
        rows.append((100 + i, " ".join(base)))
    found = ngram_join.join(frame(spark, [(*r, None, None) for r in rows]), block=block)
    assert got(found, "doc_id", "n_shingles", "component_id") == sorted(map(str, brute.components(rows)))


def test_ngram_prefixes_share_enough():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        df = np.sort(rng.integers(1, 40, n))
        length, ell = ngram_join.prefix(df)
        t = -(-n * 80 // 100)
        assert 1 <= ell <= t and length == n - t + ell <= n


def test_keep_one(spark):
    rows = [(d, t) for d, t, _, _ in corpus()]
    root, sizes = brute.classes(rows)
    left = {}
    for i, (doc, text) in enumerate(rows):
        key = ("alone", doc, text) if not sizes[i] else root[i]
        left[key] = min(left.get(key, (True, 0)), (doc is None, doc or 0))
    found = ngram_join.keep_one(frame(spark, corpus()))
    assert found.columns == frame(spark, corpus()).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == sorted(left.values())


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (5, 5), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a int, b int")).collect()))
    assert found == {i: 0 for i in range(51)} | {100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_quality_statistics():
    texts = [t for _, t, _, _ in corpus()] + ["a\nb\na\n\n \na \n", "# | <p> &amp; 5%\n" * 4]
    found = quality_rules.statistics([(t or "").encode() for t in texts])
    assert list(zip(*(found[c].tolist() for c in quality_rules.STATS))) == [brute.statistics(t) for t in texts]


def test_quality_rules(spark):
    docs = frame(spark, corpus())
    judged = quality_rules.judge_documents(docs)
    kept = quality_rules.filter_documents(docs)
    assert judged.count() == len(corpus()) and kept.columns == docs.columns
    assert kept.count() == judged.where("kept").count() > 0
    assert judged.where("kept and base_failed").count() == 0


def test_quality_rules_follow_their_group(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40) + " # x" * (10 if i % 2 else 0) + f" id{i}", "en", f"s{i % 2}") for i in range(200)]
    rows.append((999, prose(rng, 40) + " # x" * 10, "en", "s0"))
    kept = {r.doc_id for r in quality_rules.filter_documents(frame(spark, rows)).collect()}
    failed = {i for i, t, _, _ in rows if 100 * brute.statistics(t)[4] > 20 * len(brute.words(t))}
    assert kept == set(range(200)) - failed and 999 not in kept


def test_mixing_fixture(spark):
    """Against the SQL of the query, with null leaves, repeated rows and texts without tokens."""
    rows = corpus() + [(200 + i, "one two three " * (i % 5), "en", "src7") for i in range(60)]
    docs = frame(spark, rows)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    for recipe in (mixing.Recipe(), mixing.Recipe(budget=300, epochs=1, sources={"src1": 0}), mixing.Recipe(budget=5000, epochs=3)):
        expected = connection.execute(f"SELECT doc_id, copies FROM ({mixing._sql(recipe)})").fetchall()
        assert got(mixing.mix(docs, recipe), "doc_id", "copies") == sorted(map(str, expected))
        chosen = mixing.select_documents(docs, recipe)
        assert chosen.columns == docs.columns and chosen.count() == sum(c for _, c in expected)


def test_mixing_redistributes_to_siblings_first(spark):
    leaves = [("web", "en", "a", 10, 1), ("web", "en", "b", 1000, 1), ("web", "de", "c", 1000, 1), ("forum", "en", "d", 1000, 1)]
    recipe = mixing.Recipe(domains={"web": 1, "forum": 1}, languages={"en": 1, "de": 1}, default=(1, 1, 1), budget=400, epochs=1)
    found = mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint, docs bigint"), recipe)
    share = {r.source: r.share for r in found.collect()}
    # 1204 of 3010 tokens: 602 a domain, 301 a language; a takes its 10, b the other 291
    assert share == {"a": 10, "b": 291, "c": 301, "d": 602}


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_files.TOKENIZER)
    plain = Tokenizer.from_file(path)
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "a  b", "a   b", " x", "x ", "x  ", "\n \n y", "it's <|endoftext|> 12 \t", "naïve—“q”", "tab\t  z", "a \n", "w" * 3000, "   z"]
    rows = [(50 + i, t, None, None) for i, t in enumerate(texts)] + corpus()[:15]
    out = str(tmp_path / "tokens")
    token_files.write_tokens(frame(spark, rows), out, path, part_bytes=5000)
    start, expected = 0, []
    for doc, text, _, _ in sorted(rows, key=lambda r: r[0]):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got(token_files.digests(spark, out), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(map(str, expected))
    one = token_files.read_tokens(spark, out).where("doc_id = 7").first()
    assert len(one.ids) == one.n_tokens and one.start == next(s for d, s, _, _ in expected if d == 7)


def test_token_files_empty(spark, tmp_path):
    out = str(tmp_path / "none")
    token_files.write_tokens(frame(spark, corpus()).limit(0), out, public_tokenizers.path(token_files.TOKENIZER))
    assert token_files.digests(spark, out).count() == 0


@pytest.mark.parametrize("part_bytes", [1 << 24, 2000])
def test_simhash_against_next(spark, part_bytes):
    rows = [r for i, r in enumerate(corpus()) if r[0] is not None and i not in (15, 17, 23, 24)]
    found = simhash.compare_with_next(frame(spark, rows), part_bytes)
    order = sorted(rows, key=lambda r: -r[0])
    expected = []
    for i, (doc, text, _, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        prints = [simhash.fingerprints([t.encode()]) for t in (text, edited, after)]
        expected.append((doc, len(text), brute.sha(edited), prints[0].tobytes().hex(), *(float(simhash.likeness(prints[0], p)[0]) for p in prints[1:])))
    assert got(found, "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next") == sorted(map(str, expected))
    assert simhash.compare_with_next(frame(spark, corpus())).count() == len(corpus())
    assert simhash.compare_with_next(frame(spark, rows[:1])).count() == 1
    assert simhash.compare_with_next(frame(spark, rows).limit(0)).count() == 0


def test_simhash_neighbours(spark):
    numbers = [0, 0, 1, 3, 7, 15, 31, 1 << 100, (1 << 100) | 6]
    rows = spark.createDataFrame([(i, f"{n:032x}") for i, n in enumerate(numbers)], "doc_id int, fingerprint string")
    found = {r.doc_id: r.n_near for r in simhash.with_neighbours(rows).collect()}
    assert found == {i: sum((n ^ m).bit_count() <= 3 for j, m in enumerate(numbers) if i != j) for i, n in enumerate(numbers)}


def test_simhash_likeness():
    rng = random.Random(4)
    a = prose(rng, 400).split()
    b = [f"e{i}" if i % 40 == 0 else w for i, w in enumerate(a)]
    one, two, other = simhash.fingerprints([" ".join(x).encode() for x in (a, b, prose(rng, 400).split())])
    assert simhash.likeness(one[None], two[None])[0] > 0.8 > 0.3 > simhash.likeness(one[None], other[None])[0]


@pytest.mark.parametrize("bucket", [256, 3])
def test_simhash_pairs(spark, bucket):
    rng = random.Random(6)
    numbers = [rng.getrandbits(128) for _ in range(40)]
    numbers += [n ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) for n in numbers[:20]]
    numbers += [numbers[0] ^ (1 << i) for i in range(12)] + numbers[:3]
    prints = [f"{n:032x}" for n in numbers]
    found = simhash.near(spark.createDataFrame([(p,) for p in [*prints, None]], "fingerprint string"), 3, bucket)
    known = sorted(set(prints))
    expected = {(a, b, d) for i, a in enumerate(known) for b in known[i + 1 :] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 3}
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 60


def test_sentencepieces_equal_the_library():
    import sentencepiece

    path = public_tokenizers.path(sentencepieces.MODEL)
    model, library = sentencepieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(7)
    texts = ["", " ", "  ", " " * 29, " " * 33 + "q" + " " * 16, "é ﬁ Ａ\n\t", "日本語テキスト", "word▁x", "a" * 70, "\n\n  def f(x):\n        return x**2\n"]
    texts += ["".join(rng.choice("ab the  in.ing1é\n▁x") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += [t or "" for _, t, _, _ in corpus()]
    ids, counts = model.encode(texts)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == library.encode(texts)
    assert model.decode(ids, counts) == [t.replace("▁", " ") for t in texts]


def test_sentencepieces_unigram(tmp_path):
    """A unigram model written by hand: the best sum of scores wins, as in the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    for name, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        proto.pieces.add(piece=name, score=0, type=kind)
    rng = random.Random(9)
    names = {"▁", *"abcde", *("".join(rng.choice("abcde") for _ in range(rng.randint(2, 4))) for _ in range(80))}
    names |= {f"▁{n}" for n in sorted(names)[:30] if "▁" not in n}
    for name in sorted(names):
        proto.pieces.add(piece=name, score=-rng.uniform(1, 9) * len(name) ** 0.5, type=1)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as file:
        file.write(proto.SerializeToString())
    texts = ["".join(rng.choice("abcde  ") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    model, library = sentencepieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    ids, counts = model.encode(texts)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == library.encode(texts)


def test_sentencepiece_rows(spark):
    path = public_tokenizers.path(sentencepieces.MODEL)
    docs = frame(spark, corpus())
    coded = sentencepieces.encode_documents(docs, path)
    back = sentencepieces.decode_documents(coded, path)
    assert got(back, "doc_id", "text") == sorted(str((d, t or "")) for d, t, _, _ in corpus())
    assert sentencepieces.encode_documents(docs.limit(0), path).count() == 0
    rows = sentencepieces.op6_sentencepiece(spark, FOLDER)
    assert rows.where("not round_trip").count() == 0 and rows.count() == 200


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=x>Home</a></li><li><a href=y>News of the day and more</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and that is all there is to say about it for now.</div>
<article><header><h1>Title &amp; more</h1></header><p>The first of the paragraphs is long enough and it has the words that a text in English has in it.
<p>Be.<br>Two<!-- no --> lines.<p><b>Unclosed <i>tags</i> in the last of the paragraphs &lt;b&gt; are not a problem for it, as they end with their block.
</article><aside>Other things that you may want to read, and some of them are long enough to look like text.</aside>
<section id="comments"><p>I think that this is the best of the articles that I have read on this site in the last year.</p></section>
<form><p>Write to us and we will write to you about all the things that are of interest to you and us.</p></form>
<footer>&copy; the site and its owners, all of the rights are reserved to them and to nobody else.</footer></body></html>"""


def test_html():
    text, _, kept = html_text.main_text(PAGE)
    assert text.split("\n") == [
        "Title & more",
        "The first of the paragraphs is long enough and it has the words that a text in English has in it.",
        "Be. Two lines.",
        "Unclosed tags in the last of the paragraphs <b> are not a problem for it, as they end with their block.",
    ] and kept == 4
    for broken in (None, "", "<", "<p", "<!--", "<script>x", "a<b", "</p></div>", '<p class="x>y</p>', "&am", "<" * 5000, "<div>" * 3000):
        assert html_text.main_text(broken)[0] in ("", "a")


def test_html_without_article():
    good = "It is the sort of text that a page has in the middle, and there is enough of it to be decided on its own."
    page = f"<body><div><p><a href=m>Menu</a></p></div><div><h2>Head</h2><p>{good}</p><p>Short.</p><p>{good}</p></div><div><p><a href=q>More of it and the rest</a></p></div></body>"
    assert html_text.main_text(page)[0].split("\n") == ["Head", good, "Short.", good]


def test_html_pages(spark, database):
    rows = html_text.op8_html_extraction(spark, FOLDER).collect()
    pages = dict(database.execute("SELECT page_id, html FROM pages").fetchall())
    assert {r.page_id: r.text for r in rows} == {i: html_text.main_text(h)[0] for i, h in pages.items()}
    assert all(r.n_chars == len(r.text) for r in rows)


def page_rows():
    big = "<p>" + "same bytes " * 200 + "\r\n\r\nWARC/1.0\r\n\r\n</p>"
    return [(1, "http://a/x y", big), (5, None, big), (3, "https://é", big), (4, "http://s", "short"), (6, "http://s", "short"), (7, "", None),
            (8, "http://u", "ü" * 600), (9, "http://u", "ü" * 600), (None, "http://n", big), (10, "line\r\nbreak", "")]


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), "page_id bigint, url string, html string").withColumn("payload", F.lit(1)).withColumn("sum", F.lit(2))
    out = str(tmp_path / "warc")
    warc.write_archives(pages, out)
    expected = []
    for page, _, html in page_rows():
        data = (html or "").encode()
        last = max((p for p, _, h in page_rows() if h == html and p is not None), default=None)
        revisit = page is not None and len(data) >= 1000 and last > page
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    found = warc.read_archives(spark, out)
    assert got(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(map(str, expected))
    none = str(tmp_path / "none")
    warc.write_archives(pages.limit(0), none)
    assert warc.read_archives(spark, none).count() == 0


def test_arc_versions():
    http = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nmore"
    version = b"1 0 Archive\nURL IP-address Archive-date Content-type Archive-length\n"
    one = b"filedesc://old.arc 0.0.0.0 19970102030405 text/plain %d\n" % len(version) + version + b"\n"
    one += b"http://x/a b 1.2.3.4 1997 text/html %d\n" % len(http) + http + b"\n" + b"dns:x 1.2.3.4 19970102030405 text/dns 5\nhello\n"
    info, page, name = warc.parse_arc(one)
    assert page.fields["url"] == "http://x/a b" and page.block == http and name.block == b"hello"
    records = [next(warc.parse_warc(warc.convert(r))) for r in (info, page, name)]
    assert [h["warc-type"] for h, _ in records] == ["warcinfo", "response", "resource"]
    assert records[1][0]["warc-date"] == "1997-01-01T00:00:00Z" and records[1][1] == http
    assert records[1][0]["warc-payload-digest"] == warc.digest(b"body\n\nmore")
    assert len({h["warc-record-id"] for h, _ in records}) == 3 and records == [next(warc.parse_warc(warc.convert(r))) for r in (info, page, name)]
    two = warc.arc_description("n.arc") + warc.arc_record(12, "http://q", b"data")
    assert [r.fields["url"] for r in warc.parse_arc(two)] == ["filedesc://n.arc", "http://q"]
    with pytest.raises(ValueError):
        list(warc.parse_arc(one[:-4]))


@pytest.mark.parametrize("name", ["remove_repeated_strings", "remove_repeated_windows", "join", "keep_one", "judge_documents", "filter_documents", "mix"])
def test_empty_tables(spark, name):
    modules = (mixing, ngram_join, quality_rules, substring_dedup, suffix_dedup)
    module = next(m for m in modules if getattr(getattr(m, name, None), "__module__", "") == m.__name__)
    empty = frame(spark, corpus()).where("doc_id = -1")
    assert getattr(module, name)(empty).count() == 0
    nulls = frame(spark, [(i, None, None, None) for i in range(3)])
    assert getattr(module, name)(nulls).count() == (0 if name == "filter_documents" else 3)
