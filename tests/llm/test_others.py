"""Chat formatting, WARC archives, URL filters, the pipeline, and the queries' SQL."""

import hashlib
import os
import re

import duckdb
import pytest

import corpus_pipeline
from bizlens.llm import chat_formatting, secret_scans, simhash, url_filters, warc
from bizlens.llm.common import materialize, scratch_path, scratch_space, table
from bizlens.llm.queries import ORACLE, QUERIES

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    out = QUERIES[name](spark, SF001)
    rel = duck.sql(ORACLE[name])
    order = sorted(out.columns)
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert {c: kinds[t] for c, t in out.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    got = sorted((tuple(r[c] for c in order) for r in out.collect()), key=repr)
    want = sorted((tuple(dict(zip(rel.columns, r))[c] for c in order) for r in rel.fetchall()), key=repr)
    assert got == want


def test_native_queries_run_no_python(spark):
    for name in ("op2_chat_formatting", "op4_secret_scans", "op10_url_filters"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# chat formatting

def _chat(turns):
    return (hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(), len(turns))


def test_formatting_is_reversible(spark):
    esc = chat_formatting.ESCAPE
    texts = ["", None, "a<|end|>\nb<|turn|>x\n", f"{esc}1{esc}{esc}0<", "<", "|end|>", "[INST]</s>", "é中\n\n", "x" * 200_000, f"{esc}3\n"]
    rows = [(1, i, r, t) for i, t in enumerate(texts) for r in ("user", "assistant")]
    rows += [(2, 0, None, "hi"), (2, None, "system\nrole<", "first"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (None, 1, "assistant", "no id")]
    df = spark.createDataFrame([r + ("c", "d") for r in rows], "conv_id long, turn long, role string, text string, formatted string, _body string")
    chats = chat_formatting.format_chats(df.withColumn("parts", chat_formatting.text_parts(df.text)))
    from pyspark.sql import functions as F
    got = {r.conv_id: r for r in chats.withColumn("turns", chat_formatting.read_back(F.col("formatted"))).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").replace("<", esc + "1"), (r[3] or "").replace(esc, esc + "0").replace("<", esc + "1").replace("[", esc + "2"))
    for conv in (1, 2, 3, None):
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        assert [(t.role, t.text) for t in got[conv].turns] == want
        covered = [got[conv].formatted[m.start:m.start + m.length] for m in got[conv].mask]
        assert covered == [got[conv].formatted.encode()[m.first:m.first + m.size].decode() for m in got[conv].mask]
        assert covered == [t.replace(esc, esc + "0").replace("<", esc + "1").replace("[", esc + "2") for r, t in want if r == "assistant"]
    assert chat_formatting.format_chats(df.limit(0).withColumn("parts", chat_formatting.text_parts(df.text))).collect() == []


def test_visitor_flattens_typed_parts(spark):
    rows = [(1, 0, "user", [("text", "look <", None, None), ("image", None, "s3://a.png", 3.0), ("text", "|end|> and", None, None), ("audio", None, "b.wav", 2.5), None,
                            ("document", None, "c.pdf", None), ("image", None, None, 0.5), ("odd", "plain", None, None)]),
            (1, 1, "assistant", None), (2, 0, "assistant", [(None, "x", None, None)])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_formatting.PART}>")
    got = {r.conv_id: r for r in chat_formatting.format_chats(df).collect()}
    esc = chat_formatting.ESCAPE
    assert got[1].formatted == f"<|turn|>user\nlook {esc}1<|image|>|end|> and<|audio|><|document|><|image|>plain<|end|>\n<|turn|>assistant\n<|end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in got[1].attachments] == [("image", "s3://a.png", 768), ("audio", "b.wav", 63), ("document", "c.pdf", 700), ("image", None, 128)]
    assert got[1].attachment_tokens == 1659 and got[2].attachments == []


def test_parts_are_read_back_by_type(spark):
    """A placeholder and a text that spells one out are told apart."""
    from pyspark.sql import functions as F
    rows = [(1, 0, "user", [("image", None, "r", 1.0), ("text", "<|image|>", None, None), ("text", "x", None, None), ("audio", None, None, None)]),
            (1, 1, "assistant", [("text", "<|audio|><|end|>\n", None, None)]), (1, 2, "a\n<b", []), (2, 0, "assistant", [("document", None, None, None)] * 2)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_formatting.PART}>")
    got = {r.conv_id: [(t.role, [tuple(p) for p in t.parts]) for t in r.turns]
           for r in chat_formatting.format_chats(df).withColumn("turns", chat_formatting.read_parts(F.col("formatted"))).collect()}
    assert got == {1: [("user", [("image", None), ("text", "<|image|>x"), ("audio", None)]), ("assistant", [("text", "<|audio|><|end|>\n")]), ("a\n<b", [])],
                   2: [("assistant", [("document", None), ("document", None)])]}
    none = spark.createDataFrame([(None,), ("",)], "formatted string").select(chat_formatting.read_parts(F.col("formatted")).alias("t")).collect()
    assert none[0].t is None and none[1].t == []


def test_many_attachments_and_long_texts(spark):
    parts = [("text", f"piece {i} <", None, None) if i % 2 else ("image", None, f"r{i}", 1.0) for i in range(5000)] + [("text", "y" * 2_000_000, None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{chat_formatting.PART}>")
    got = chat_formatting.format_chats(df).first()
    assert [a.ref for a in got.attachments] == [f"r{i}" for i in range(0, 5000, 2)] and got.attachment_tokens == 2500 * 256
    assert len(got.mask) == 1 and got.formatted[got.mask[0].start:got.mask[0].start + got.mask[0].length].endswith("y" * 2_000_000)


def test_chat_query_by_brute_force(spark):
    rows = table(spark, SF001, "conversations").collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    by[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.turns_sha256, r.loss_sha256, r.n_turns) for r in chat_formatting.op2_chat_formatting(spark, SF001).collect()}
    assert got == {k: _chat(v) for k, v in by.items()}


# WARC

INNER = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [(1, "http://a/", "x" * 150), (2, None, "x" * 150), (3, "u\r\nv", None), (4, "b", INNER + INNER + "tail"), (5, "c", "WARC/1.1\r\n"), (6, "d", "WARC/1.1\r\n" * 50),
         (7, "e", "é" * 3000), (None, "f", "x" * 150), (8, "g", "short"), (9, "h", "short"), (1, "i", "x" * 150), (10, "j", INNER * 40 + "é"), (11, "k", "y" * 60_000), (12, "l", ""), (13, "m", "x" * 150),
         (13, "n", "y" * 60_000), (13, "o", "z" * 200)]


@pytest.mark.parametrize("split", ["128m", "2500"])
def test_warc_round_trip(spark, split):
    df = spark.createDataFrame([p + ("c",) for p in PAGES], "page_id long, url string, html string, payload string").repartition(2)
    path = scratch_path(spark, "test-warc")
    warc.write_warc(df, path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        full, narrow = warc.read_warc(spark, path).collect(), warc.read_warc(spark, path, payloads=False).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    key = lambda i: warc.URN + ("" if i is None else str(i))
    got = sorted((r.record_id, r.type, r.refers_to, bytes(r.payload).decode(), r.length) for r in full if r.type == "response")
    assert got == sorted((key(i), "response", None, h or "", len((h or "").encode())) for i, u, h in PAGES if i != 2 and u not in ("m", "n"))
    # id 13 stands on three rows: a revisit of 1, a revisit of 11, and a response
    assert sorted((r.record_id, r.refers_to, r.length, r.payload_bytes) for r in full if r.type == "revisit") == sorted(
        [(key(2), key(1), 0, 150), (key(13), key(1), 0, 150), (key(13), key(11), 0, 60_000)])
    assert all(r.sha256 == hashlib.sha256(bytes(r.payload)).hexdigest() for r in full)
    assert sorted((r.file, r.at, r.sha256, r.length) for r in narrow) == sorted((r.file, r.at, r.sha256, r.length) for r in full)


def test_warc_of_an_empty_table(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).collect() == []


# URL filters

def test_host_and_path(spark):
    urls = ["http://A.Example.org/es/1?x#y", "https://x.com", "x://h?q/p", "x://h#f", "no scheme/a", None, "", "a://b/c://d/e", "http:///p", "http://É.ORG/Ä", "http://h\n/p"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path) for r in df.select("page_id", url_filters.host_of(df.url).alias("host"), url_filters.path_of(df.url).alias("path")).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest).group()
        assert got[i] == (re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match("[^?#]*", rest[len(host):]).group())


@pytest.mark.parametrize("bits,share", [(1 << 26, 0.05), (1 << 10, 0.3), (512, 0.5), (1 << 26, 0.95)])
def test_cascade_is_exact(spark, bits, share):
    from pyspark.sql import functions as F
    universe = materialize(spark.range(3000).select(F.concat(F.lit("key"), F.col("id")).alias("key"), (F.rand(3) < share).alias("listed")), "test")
    if bits < 1024:
        universe = materialize(universe.limit(300), "test")
    levels = url_filters.build_cascade(universe, bits)
    out = universe.select("listed", url_filters.is_listed(F.col("key"), levels).alias("found")).collect()
    assert all(r.listed == r.found for r in out) and all(x.bits <= bits for x in levels)


@pytest.mark.parametrize("keys,bits", [(60_000, 1 << 14), (4_000, 1 << 10)])
def test_long_lists_go_by_parts(spark, keys, bits):
    """Filters far too small for the whole list: every part's cascade stays under the cap and is exact."""
    from pyspark.sql import functions as F
    url = F.concat(F.lit("http://h"), F.col("id") % 97, F.lit(".net/p"), F.col("id"))
    pages = spark.range(keys).select(F.col("id").alias("page_id"), url.alias("url"), (F.xxhash64("id") % 2 == 0).alias("bad"))
    assert url_filters.parts_of(keys // 2, keys // 2, bits) > 3
    got = url_filters.judge_urls(pages, pages.bad, rules=[], max_bits=bits).join(pages, "page_id")
    assert got.groupBy("bad", "verdict").count().collect().__len__() == 2
    assert got.where((F.col("verdict") == "block") != F.col("bad")).isEmpty() and got.count() == keys


def test_judge_urls_cases(spark):
    rows = [(1, "http://a.example.org/es/1", True), (2, "http://example.org/en/12", False), (3, "http://notexample.org/en/1", False), (4, "http://x.com/fr/", True),
            (5, "http://x.com/de/9", None), (6, "http://x.net/a", True), (7, "http://x.net/a?again", False), (8, "http://x.net/b", False), (9, None, True), (None, "http://org", None),
            (6, "http://x.net/a", True)]
    df = spark.createDataFrame([r + ("c", "d") for r in rows], "page_id long, url string, bad boolean, key string, listed string")
    got = sorted(((r.page_id, r.rule, r.verdict) for r in url_filters.judge_urls(df, df.bad).collect()), key=repr)
    want = [(1, "example.org/es/", "block"), (2, "example.org/en/1", "block"), (3, "org/", "allow"), (4, "com/fr/", "allow"), (5, "com/de/", "block"), (6, None, "block"),
            (6, None, "block"), (7, None, "block"), (8, None, "allow"), (9, None, "allow"), (None, None, "allow")]
    assert got == sorted(want, key=repr)
    assert url_filters.judge_urls(df.limit(0), df.bad).collect() == []


# pipeline

def test_pipeline_stages_by_brute_force(spark):
    """Each stage against its own rule, worked out from its input in Python."""
    from test_documents import _contained as contained

    docs = table(spark, SF01, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF01), "test")
        given, got = docs.collect(), out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
            left = {r.doc_id for r in got}
            good, bad = ([i for i, q in labels.items() if q == k] for k in (1, 0))
            assert sum(i in left for i in good) >= 0.99 * len(good) and sum(i in left for i in bad) <= 0.1 * len(bad)
        elif name == "simhash_near_dedup":
            codes = {r.doc_id: simhash.fingerprint(r.text or "") for r in given}
            order, parent = sorted(codes), {}
            for i in order:
                parent[i] = i

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a in order:
                for b in order:
                    if a < b and (codes[a] ^ codes[b]).bit_count() <= 3 and root(a) != root(b):
                        parent[max(root(a), root(b))] = min(root(a), root(b))
            assert sorted(r.doc_id for r in got) == [i for i in order if root(i) == i]
        elif name == "benchmark_decontamination":
            hit = contained([(r.doc_id, r.text) for r in given], [(r.item_id, r.text) for r in table(spark, SF01, "benchmark").collect()])
            assert {r.doc_id for r in given} - {r.doc_id for r in got} == {i for i, *_ in hit} and hit
        elif name == "secret_scans":
            assert {r.doc_id for r in got} == {r.doc_id for r in given}
            old = {r.doc_id: r.text for r in given}
            live = {r.doc_id: r.live_spans for r in secret_scans.scan_secrets(docs).collect()}
            assert all((r.text == old[r.doc_id]) == (live[r.doc_id] == "") and (live[r.doc_id] == "" or r.n_chars == len(r.text)) for r in got)
        else:
            assert {r.doc_id for r in got} == {r.doc_id for r in given}
        docs = out
    assert corpus_pipeline.run(spark, SF001).count() > 0


def test_a_run_in_a_scratch_space_leaves_nothing(spark):
    with scratch_space(spark) as path:
        out = corpus_pipeline.run(spark, SF001)
        folder = path.removeprefix("file:")
        assert {n for n, _ in corpus_pipeline.STAGES[:-1]} <= {f.split("-")[1] for f in os.listdir(folder)}
        got = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in out.collect()}
    docs = table(spark, SF001, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001), "by-hand")
    assert {r[0] for r in got} == {r.doc_id for r in docs.collect()} and got and not os.path.exists(folder)


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001), "test")
    assert docs.collect() == []
