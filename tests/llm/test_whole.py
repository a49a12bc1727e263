"""Training-data operators over inputs that shortcuts got wrong."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lilt.llm import byte_bpe, jaccard_join, language, licenses, line_dedup, mixing, queries, token_files
from lilt.llm.common import Generations, WordHashes, bounded_batches

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_those_of_a_fresh_tokenizer():
    library, words = Tokenizer.from_file(WORDS), token_files.WordTokenizer(WORDS)
    texts = ["H̱asan", "T̈ W̊ Y̊ J̌", "say <|endoftext|>", "A<|endoftext|>B<|startoftext|><|ENDOFTEXT|>", "<|endoftext|>" * 3, "It's É<|EndOfText|>'S", "Don'T x≠y Å", "", None]
    r, parts = random.Random(4), [*"HTWYJhtaeAE<=>|'sS 1.\n\t", "̱", "̈", "̊", "̌", "̸", "é", "É", "ß", "İ", "ı", "Σ", "K", "中", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "ENDOFTEXT|>"]
    texts += ["".join(r.choice(parts) for _ in range(r.randrange(1, 18))) for _ in range(6000)]
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert words.encode(pa.array(texts), 1).to_pylist() == want
    assert [words.encode(pa.array([t], pa.string()), 1).to_pylist()[0] for t in texts[:400]] == want[:400]


def test_every_language_is_learned(spark):
    common = [(i, "lorem ipsum dolor" if i % 2 else "straße über haus", "aa" if i % 2 else "bb") for i in range(6000)]
    rare = [(-i, "год мир язык", "cc") for i in range(1, 40)] + [(3, f"ένα δύο {i}", "dd") for i in range(40)]
    frame = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    labels, x = language.sample_features(frame, 12, 512)
    assert {lang: labels.count(lang) for lang in set(labels)} == {"aa": 12, "bb": 12, "cc": 12, "dd": 12} and x.shape == (48, 512)
    assert language.train(frame, 12).languages == ("aa", "bb", "cc", "dd")


def test_a_small_share_of_rows_is_still_a_sample(spark):
    many = spark.range(4_000_000).select(F.col("id").alias("doc_id"), F.lit("lorem ipsum").alias("text"), F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang"))
    labels, _ = language.sample_features(many, 1, 64)
    assert sorted(labels) == ["aa", "bb"]


def test_bare_creative_commons_names_have_their_labels():
    for name in ("cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd", "cc0"):
        found = licenses.scan(f"Pictures: {name.upper().replace('-', ' ', 1)}, see below".encode())
        assert [(d.label, d.start) for d in found.detections] == [(name, 1)] and name in found.labels
    assert "cc-by-sa" in licenses.scan(b"Creative Commons Attribution-ShareAlike").labels
    assert licenses.scan(b"cc bysa, cc0x").labels == []


def test_sweeps_agree_with_single_queues(monkeypatch):
    bpe = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    r = random.Random(8)
    pieces = list({"".join(r.choice("aaabeinrst ") for _ in range(r.randrange(1, 40))).encode() for _ in range(900)} | {b"a" * n for n in range(1, 40)} | {"straße".encode() * n for n in (1, 9)})
    alone = [bpe.merge([bpe.of_byte[b] for b in p]) for p in pieces]
    for sparse in (0, 4, 1000):
        monkeypatch.setattr(byte_bpe, "SPARSE", sparse)
        assert bpe.sweep(pieces) == alone


def test_a_merge_that_makes_a_lower_rank_is_done_again(tmp_path, monkeypatch):
    tokens = [bytes([b]) for b in range(256)] + [b"xabc", b"xa", b"bc", b"abc"]
    path = tmp_path / "odd.ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    bpe, text = byte_bpe.ByteBPE(str(path), r"\S+"), b"xabcxabc"
    assert bpe.sweep([text, b"bcxab"]) == [bpe.merge([bpe.of_byte[b] for b in t]) for t in (text, b"bcxab")] == [[256, 256], [258, 257, 98]]


def test_memos_forget_what_is_long_and_old():
    memo = Generations(3)
    for keys in ({"a", "bb"}, {"c" * 70}, {"d", "e"}, {"a"}):
        memo.young.update({k: k for k in memo.lacking(keys)})
        memo.trim(64)
    assert set(memo.young) == {"a"} and set(memo.old) == {"a", "bb", "d", "e"}
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    one = byte_bpe.TextCodec(codec)
    one.encode(["x" * 500_000 + " " + "漢字" * 9000])
    assert not one.chunks.young and not one.pre_tokens.young


@pytest.mark.parametrize("percent", [90, 80])
def test_planned_keys_bound_the_real_ones(percent):
    sizes, r = jaccard_join.Sizes(percent), np.random.default_rng(6)
    for size in (1, 3, 8, 9, 12, 18, 19, 40, 100, 300, 2000):
        s = np.unique(r.integers(0, 2**64, size, np.uint64))
        made = sum(map(len, jaccard_join.light_keys(s, sizes))) if sizes.is_light(size) else 0
        if sizes.is_listed(size):
            made += sum(len(jaccard_join.list_keys([s], level, *sizes.parts(level))[0]) for level in sizes.levels(size))
        assert 0.7 * sizes.keys(size) <= made <= sizes.keys(size)


def test_equal_hashes_of_subsets_are_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "light_keys", lambda s, sizes: [np.array([8 | jaccard_join.LIGHT | jaccard_join.EQUAL], np.uint64)])
    rows = [(i, " ".join(f"{i}w{j}" for j in range(9))) for i in range(5)] + [(9, " ".join(f"0w{j}" for j in range(9)))]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 9: 0}


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_SHINGLES", 150)
    r = random.Random(3)
    base = [f"w{r.randrange(500)}" for _ in range(100)]
    rows = [(i, " ".join([*base[:50], f"x{i}", *base[50:]])) for i in range(12)] + [(50, " ".join(base))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(frame).collect()
    assert {x.component_id for x in got} == {0}


def test_texts_without_blanks(spark):
    rows = [(i, ("漢字かな" * 30_000) + str(i % 2)) for i in range(4)] + [(7, "x" * 300_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("zz"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame, 5, 80).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 0), 3: (1, 1), 7: (1, 7)}
    memo = WordHashes()
    assert [memo[w] for w in (b"y" * 65, b"a")] and list(memo) == [b"a"]
    model = language.Model(("aa", "bb"), np.random.default_rng(1).normal(size=(64, 2)), np.zeros(2))
    words = language.WordLogits(model)
    texts = ["x" * 500_000, "x" * 500_000 + " y", "y", "ß" * 70]
    first = words.of(texts)
    assert set(words.memo) == {"y"} and np.array_equal(words.of(texts), first)


def test_session_limits_are_lowered_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "700")
    bounded_batches(spark)
    assert spark.conf.get(name) == "700"
    spark.conf.set(name, "0")
    bounded_batches(spark)
    assert spark.conf.get(name) == "2000"
    spark.conf.set(name, before)


CLASHES = ["row", "id", "copy", "doc", "words", "split", "dense", "range", "parts", "h1", "h2", "pos", "line", "key", "keeper", "docs", "_key", "_size", "_class", "_bucket", "_rank", "_target", "_rate", "_before", "_in_class", "_offset", "_source_size", "_n", "_lines", "_dense", "_doc", "_words", "_weight"]


@pytest.mark.parametrize("operator", [mixing.mix, mixing.mixed_documents, line_dedup.dedup_lines])
def test_columns_named_like_internal_ones_return_unchanged(spark, operator):
    shared = "a line that is long enough to be dropped and shared"
    rows = [(i, f"w{i} {shared}\n{shared}\nv", "ab"[i % 2]) for i in range(9)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = plain.select("*", *[F.concat(F.lit(f"own {c} "), F.col("doc_id")).alias(c) for c in CLASHES])
    got = operator(clashing)
    assert all(r[c] == f"own {c} {r.doc_id}" for r in got.collect() for c in CLASHES)
    new = [c for c in got.columns if c not in CLASHES]
    assert sorted(map(str, got.select(new).collect())) == sorted(map(str, operator(plain).select(new).collect()))
    assert got.columns[: len(clashing.columns)] == clashing.columns


@pytest.mark.parametrize(("ranges", "sample"), [(1, 10**6), (8, 10**6), (64, 40)])
def test_lines_in_split_ranges(spark, monkeypatch, ranges, sample):
    monkeypatch.setattr(line_dedup, "RANGES", ranges)
    monkeypatch.setattr(line_dedup, "SAMPLE", sample)
    r, shared = random.Random(ranges), [f"shared line number {i} of more than forty letters" for i in range(12)]
    rows = [(i, "\n".join([shared[0]] * (i % 3) + [r.choice(shared[: 1 + i % 12]) for _ in range(r.randrange(9))] + [f"only in {i}, and also long enough to be hashed"])) for i in range(150)]
    frame = spark.createDataFrame([*rows, (None, shared[0]), rows[3]], "doc_id long, text string").repartition(4)
    where = {}
    for i, t in rows:
        for line in t.split("\n"):
            where.setdefault(line, set()).add(i)
    for x in line_dedup.dedup_lines(frame).collect():
        lines = shared[:1] if x.doc_id is None else rows[x.doc_id][1].split("\n")
        kept = lines if x.doc_id is None else [line for line in lines if len(where[line]) < 5 or max(where[line]) == x.doc_id]
        assert (x.text, x.lines.n_dropped) == ("\n".join(kept), len(lines) - len(kept))


def test_line_ranges_keep_their_sort(spark):
    docs = spark.createDataFrame([(1, "x" * 50)], "doc_id long, text string")
    plan = line_dedup.keep_bitmaps(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [range" in plan and "Window [" in plan


def test_every_rule_passes_its_keywords():
    """Random strings of every expression: the prefilter lets each pass, and the scan finds it or what contains it."""
    for rule in licenses.rules():
        expression = rule.pattern.pattern.removeprefix(rb"(?<![^ ])(?:").removesuffix(rb")(?![^ ])").decode().replace(r"\S", "[a-z]").replace(r"\d", "[0-9]")
        strategy = st.from_regex(f"(?:{expression})", fullmatch=True)

        @settings(max_examples=8, database=None, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
        @given(strategy)
        def passes(text):
            text = " ".join(text.split())
            if rule.pattern.search(text.encode()):
                assert any(k in b" " + text.encode() + b" " for k in rule.keywords), (rule.label, text)

        passes()


def test_gated_scans_find_what_ungated_ones_do(spark):
    texts = ["Unauthorized copying of this file is strictly prohibited", "Released under the MIT-0 license; see the LICENSE file for details", "Alle Rechte vorbehalten. © 2021 Foo", "Licensed under the Apache License, Version 2.0; dual-licensed", "© 1999, EULA"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in texts:
        words = b" ".join(text.encode().translate(licenses.NORMAL).split())
        found = []
        for rule in licenses.rules():
            for m in rule.pattern.finditer(words):
                start = words.count(b" ", 0, m.start())
                found.append(licenses.Detection(rule.label, start, start + m.group().count(b" ") + 1, rule.priority, rule.weight))
        assert licenses.detect(words) == licenses.resolve(found)


def brute_licenses(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", words)
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_registered_license_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op6_license_scan(spark, sf).collect()
    assert len(got) == len(texts) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    for text in ("CC BY cc-by ÿ cc by cc", "all rights  reserved\x7fall rights reserved", "", None, "general public license" * 2):
        s = licenses.scan(None if text is None else text.encode())
        assert (s.n_words, len(s.places), min(s.places, default=None), max(s.places, default=None), ",".join(s.base_labels)) == brute_licenses(text)


def test_registered_token_media_and_language_queries(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    for r in sorted(queries.op3_token_files(spark, sf).collect(), key=lambda r: r.doc_id):
        ids = library.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.op7_byte_bpe(spark, sf).collect():
        text = rows[r.doc_id].text or ""
        ids = bpe.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    feature = {}
    for r in queries.op8_flac_media(spark, sf).collect():
        raw = (rows[r.doc_id].text or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes > 42 and feature.setdefault(raw, (r.feature, r.media_sha256)) == (r.feature, r.media_sha256)
    told = queries.op10_language(spark, sf).collect()
    assert len(told) == len(rows) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in told)
    known = [r for r in told if r.held_out and rows[r.doc_id].lang and any(map(str.isalpha, rows[r.doc_id].text or ""))]
    assert np.mean([r.lang_pred == rows[r.doc_id].lang for r in known]) > 0.95
    assert all(0 <= r.score <= 1 for r in told)


def test_files_stand_in_order_of_their_numbers(spark):
    names = [f"part-{n:05d}-x-c000.lz4.orc" for n in (0, 9, 99_999, 100_000, 100_001, 1_000_000)]
    shuffled = spark.createDataFrame([(n,) for n in sorted(names)], "file string")
    assert [r.file for r in shuffled.orderBy(token_files.file_number(F.col("file")), "file").collect()] == names
    assert token_files.planned_bytes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) > 10_000
    assert token_files.planned_bytes(spark.range(3)) < 1000


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_lose_no_link(percent):
    r = np.random.default_rng(percent)
    sets = [r.integers(0, 1 << 64, int(size), np.uint64) for size in (1, 2, 9, 40, 63, 64, 65, 130, 500, 3000)]
    for base in list(sets):
        for share in (0.02, 0.05, 0.1, 0.2, 0.3):
            gone = r.random(len(base)) < share
            sets.append(base[~gone] if share < 0.1 else np.concatenate([base[~gone], r.integers(0, 1 << 64, int(gone.sum()), np.uint64)]))
    sets = [np.unique(s) for s in sets if len(s)]
    n, every = np.array([len(s) for s in sets]), np.arange(len(sets))
    sure = jaccard_join.linked(percent)([s.tobytes() for s in sets], n, every, every)
    maybe = jaccard_join.maybe_linked(percent)([jaccard_join.sketch(s) for s in sets], n, every, every)
    assert sure.sum() > len(sets) and not (sure & ~maybe).any()
    assert maybe.sum() < 0.5 * maybe.size


def test_near_copies_shuffle_less_than_the_texts(spark):
    # sets that share no more than a passage meet in lists, but their texts and hashes don't travel
    r = random.Random(3)
    word = lambda: f"{r.randrange(1 << 60):x}"
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(30)) + " " + passage for _ in range(2500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3000, texts[7]), (3001, texts[8] + " end"), (None, texts[9])]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    written = lambda: (spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(), spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite())[1]
    before = written()
    left = sorted((x.doc_id for x in corpus_pipeline.drop_near_copies(spark, docs, "").collect()), key=str)
    assert left == sorted([*range(2500), None], key=str)
    assert 0 < written() - before < sum(map(len, texts))
