"""The training-data operators against brute force, libraries and SQL, on nulls, empties, ties, repeats and clashes."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import weakref
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from lilt.llm import blocks, byte_bpe, flac, jaccard_join, language, licenses, line_dedup, mixing, substring_dedup, token_files, topk_search

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def prose(r: random.Random, n: int, vocabulary: int = 50) -> str:
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text) with copies, shared passages and lines, edge cases, repeated rows and a null id."""
    r = random.Random(7)
    passage, line = prose(r, 30, 9), "This very long line is shared by MANY documents of the corpus " + prose(r, 5)
    rows = [(i, prose(r, r.randrange(1, 90))) for i in range(60)]
    rows += [(60 + i, prose(r, 20) + " " + passage + "\n" + prose(r, 9)) for i in range(8)]
    rows += [(70 + i, prose(r, 12) + "\n  " + (line.upper() if i % 2 else line) + " \t\n" + prose(r, 3)) for i in range(7)]
    rows += [(80 + i, rows[5][1]) for i in range(4)] + [(90 + i, prose(r, 40) + f"\nend {i}") for i in range(3)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "x"), (104, "é" * 50_000), (105, prose(r, 20_000, 9999)), (None, passage), (rows[5][0], rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr", None)[(i or 0) % 3], (None, "a", "b", "c", "")[(i or 0) % 5], 0) for i, t in texts]
    clash = [F.lit(1).alias(c) for c in ("_key", "size", "mix", "lines", "score", "labels", "token_ids", "media", "rank", "copies")]
    return spark.createDataFrame(rows, SCHEMA).select("*", *clash).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def known(texts):
    return [(i, t) for i, t in texts if i is not None]


def test_substring_dedup(spark, docs, texts, empty):
    got = substring_dedup.dedup_substrings(docs).collect()
    assert len(got) == len(texts)
    first = {}
    split = [(i, (t or "").split()) for i, t in known(texts)]
    for i, w in split:
        for a in range(len(w) - 12):
            g = tuple(w[a : a + 13])
            first[g] = min(first.get(g, i), i)
    want = defaultdict(list)
    for i, w in split:
        gone = set()
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone |= set(range(a, a + 13))
        want[i].append((len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    have = defaultdict(list)
    for r in got:
        if r.doc_id is not None:
            have[r.doc_id].append((r.n_words, r.n_removed, r.text or ""))
        else:
            assert r.n_removed == 0
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert next(r.text for r in got if r.doc_id == 100) is None
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_substring_buckets_agree(docs, monkeypatch):
    one = {(r.doc_id, r.text) for r in substring_dedup.dedup_substrings(docs).collect()}
    monkeypatch.setattr(substring_dedup, "BUCKET_HASHES", 500)
    assert {(r.doc_id, r.text) for r in substring_dedup.dedup_substrings(docs).collect()} == one


def test_substring_tasks_hold_one_block_and_few_copies(docs, monkeypatch):
    alive, most = weakref.WeakSet(), []

    class Watched(substring_dedup.BlockWindows):
        def __init__(self, *a):
            super().__init__(*a)
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(substring_dedup, "BlockWindows", Watched)
    rows = blocks.make_blocks(docs, block_docs=4).select("block", "docs").collect()
    batch = pa.RecordBatch.from_pylist([{"block": r.block, "docs": bytes(r.docs), "answers": []} for r in rows], schema=pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("answers", pa.list_(pa.struct([("bucket", pa.int64()), ("earlier", pa.binary())])))]))
    sent = list(substring_dedup._send(13, 2)(iter([batch])))
    assert sum(b.num_rows for b in substring_dedup._apply(13, 2)(iter([batch]))) == docs.count()
    assert len(rows) > 2 and sent and most == [1] * (2 * len(rows))

    r, n = np.random.default_rng(4), 30_000
    lists = [(np.unique(r.integers(0, 1 << 19, n, dtype=np.uint64)), 1000 * k) for k in range(10)]
    owners = [r.integers(0, 3000, len(h)).astype(np.uint64) for h, _ in lists]
    table = pa.Table.from_pylist([{"bucket": 0, "block": k, "low": low, "hashes": blocks.pack_sorted(h), "docs": blocks.pack_planes(d)} for k, ((h, low), d) in enumerate(zip(lists, owners, strict=True))], schema=substring_dedup._SENT)
    total = sum(len(h) for h, _ in lists)
    tracemalloc.start()
    got = substring_dedup._count(table).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * total
    first: dict[int, int] = {}
    for (h, low), d in zip(lists, owners, strict=True):
        for x, i in zip(h.tolist(), d.tolist(), strict=True):
            first[x] = min(first.get(x, i + low), i + low)
    for row in got:
        (h, low), d = lists[row["block"]], owners[row["block"]]
        bits = np.unpackbits(np.frombuffer(row["earlier"], np.uint8), count=len(h)).astype(bool)
        assert bits.tolist() == [first[x] < i + low for x, i in zip(h.tolist(), d.tolist(), strict=True)]


def test_mixing(spark, docs, texts, empty):
    got = mixing.mix(docs).select("doc_id", "source", "mix.*").collect()
    assert len(got) == len(texts)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 3
    total, target = sum(sizes.values()), {}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped: set = set()
    while True:
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weights[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in order:
        target[s] = 3 * sizes[s] if s in capped else level * weights[s]
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - target[s]) <= largest for s in order)
    key = lambda rows: sorted(map(str, rows))
    assert key(mixing.mix(docs.repartition(5)).select("doc_id", "source", "mix.*").collect()) == key(got)
    mixed = mixing.mixed_documents(docs)
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0


def test_mixing_of_many_documents_is_near_its_targets(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "repeat('a ', cast(1 + id % 97 + id % 11 as int)) AS text", "concat('s', cast(sqrt(id) / 20 as int)) AS source")
    out = mixing.mix(rows).groupBy("source").agg(F.sum(F.expr("mix.size * mix.copies")).alias("taken"), F.first("mix.target").alias("target")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.02 for r in out if r.target > 5000)


def test_token_files(spark, docs, texts, empty, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write(docs, path, WORDS)
    got = sorted(token_files.layout(spark, path).collect(), key=lambda r: r.start)
    library = token_files.WordTokenizer(WORDS).tokenizer
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts}
    assert [r.doc_id for r in got] == sorted((i for i, _ in texts), key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        own = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    assert token_files.look_up(spark, path, 61).collect()[0].ids == ids[61]
    token_files.write(empty, path, WORDS)
    assert token_files.layout(spark, path).count() == 0


def test_word_ids_are_text_ids():
    r, words = random.Random(3), token_files.WordTokenizer(WORDS)
    alphabet = " \n\t\x0b\x1c\x85 　̧́ΣσAa'stléÉİ1２<|endoftext|>#\U0001f600中가"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(15))) for _ in range(3000)] + [None]
    got = words.encode(pa.array(texts), 1).to_pylist()
    assert got == [words.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def brute_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets.setdefault(i, []).append({tuple(w[a : a + n]) for a in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for a, (i, x) in enumerate(flat):
        for j, y in flat[a + 1 :]:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (sorted(len(s) for s in own), root(i)) for i, own in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 80)])
def test_jaccard_components(spark, n, percent):
    r, rows = random.Random(percent), []
    for _ in range(60):
        base = [f"{r.choice('abcdef')}{r.randrange(30)}" for _ in range(r.choice([1, 2, 3, 8, 11, 12, 18, 19, 20, 22, 30, 60, 200]))]
        for _ in range(r.randrange(1, 7)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                at = r.randrange(len(w) + 1)
                w[at : at + r.randrange(2)] = [f"z{r.randrange(99)}"] * r.randrange(2)
            rows.append((len(rows), " ".join(w).title() if r.random() < 0.2 else " ".join(w)))
    rows += [(900, None), (901, ""), (902, "\n "), (rows[3][0], rows[3][1])]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows + [(None, "a b c")], "doc_id long, text string"), n, percent).collect()
    want = brute_components(rows, n, percent)
    assert len(got) == len(rows) + 1
    assert {x.doc_id: x.component_id for x in got} == {i: c for i, (_, c) in want.items()} | {None: None}
    assert all(x.n_shingles in want[x.doc_id][0] for x in got if x.doc_id is not None)


def test_jaccard_tiles_buckets_and_empty(docs, texts, empty, monkeypatch):
    want = {i: c for i, (_, c) in brute_components(known(texts), 3, 90).items()}
    monkeypatch.setattr(jaccard_join, "TILE", 2)
    monkeypatch.setattr(jaccard_join, "BUCKET_KEYS", 100)
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect() if r.doc_id is not None} == want
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_top_k(spark, monkeypatch):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=8) * (1 if i % 3 else 0.2)).astype("float32").tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(50, rows[50][1]), (700, None), (701, [float("nan")] * 8), (702, [None] * 8), (703, []), (750, [0.0] * 8), (800, [1.0, 2.0]), (850, [3.0, -1.0]), (None, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(9))
    usable = [(i, np.floor(256 * np.array(v, "float32").astype(float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in usable if i % 50 == 0}):
        x = next(v for i, v in usable if i == q)
        best = sorted((-int(x @ v), i) for i, v in usable if i != q and len(v) == len(x))[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    for block, start in ((4096, 0.6), (16, -1.0), (32, 0.2)):
        monkeypatch.setattr(topk_search, "BLOCK", block)
        monkeypatch.setattr(topk_search, "COORDINATE_FROM", start)
        got = topk_search.top_k(frame, frame.where("vec_id % 50 = 0")).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in got) == want
    assert topk_search.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_licenses(docs, texts, empty):
    got = licenses.scan_licenses(docs, only=["doc_id", "text"]).collect()
    assert len(got) == len(texts)
    text = "CC-BY. cc by cc by; General Public\nLicense v3. All  Rights Reserved, SPDX-License-Identifier: MIT. cc byx"
    s = licenses.scan(text.encode())
    assert (s.n_words, len(s.places), s.places[0], s.places[-1]) == (19, 5, 0, 10)
    assert s.base_labels == ["cc-by", "gpl", "reserved"] and {"cc-by", "gpl", "reserved", "mit"} <= set(s.labels)
    assert licenses.scan(None) == licenses.scan(b"") and licenses.scan(None).score == 0
    assert 200 <= len(licenses.rules()) <= 1000
    assert licenses.scan_licenses(empty).count() == 0


def test_license_resolution():
    d = lambda label, a, b, p: licenses.Detection(label, a, b, p, 0.5)
    r = random.Random(1)
    for _ in range(200):
        found = [d(r.choice("abc"), a := r.randrange(20), a + r.randrange(1, 8), r.randrange(3)) for _ in range(r.randrange(12))]
        kept = []
        for x in sorted(set(found), key=lambda x: (-x.priority, x.start - x.stop, x.start, x.label)):
            if not any(k.start <= x.start and x.stop <= k.stop for k in kept):
                kept.append(x)
        assert licenses.resolve(found) == sorted(kept, key=lambda x: (x.start, x.stop, x.label))


@pytest.fixture(scope="module")
def reference_bpe():
    with open(BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, texts, reference_bpe, empty):
    got = byte_bpe.round_trip(docs, BPE, public_tokenizers.PATTERN, only=["doc_id", "text"]).collect()
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == reference_bpe.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "") and r.n_tokens == len(r.token_ids) // 4
    encoded = byte_bpe.encode(docs, BPE, public_tokenizers.PATTERN)
    assert byte_bpe.decode(encoded, BPE, public_tokenizers.PATTERN).where(F.col("decoded") != F.coalesce("text", F.lit("")).cast("binary")).count() == 0
    assert byte_bpe.encode(empty, BPE, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_odd_texts(reference_bpe):
    r, texts = random.Random(5), byte_bpe.TextCodec(byte_bpe.codec(BPE, public_tokenizers.PATTERN))
    alphabet = " \n\t\r\x0b\x1c\x1f\x85  　​﻿a'stlé1２٣#$\U0001f600é中᠎"
    odd = ["".join(r.choice(alphabet) for _ in range(r.randrange(16))) for _ in range(4000)]
    odd += ["".join(r.choice("abcde") for _ in range(30_000)), "a" * 5001]
    for group in ([t] for t in odd[-300:]), [odd]:
        for some in group:
            assert [np.frombuffer(x, "<u4").tolist() for x in texts.encode(some)] == [reference_bpe.encode_ordinary(t) for t in some]


def test_byte_bpe_returns_a_group_of_texts_at_a_time(spark, monkeypatch):
    r, caught = random.Random(8), []
    texts = [None, "", prose(r, 900), *(prose(r, n) + " é" for n in range(1, 120)), None]
    docs = spark.createDataFrame([("x",)], "text string")
    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 1000)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: caught.append(run) or self)
    byte_bpe.round_trip(docs, BPE, public_tokenizers.PATTERN)
    out = list(caught[0](iter([pa.RecordBatch.from_pydict({"text": texts}), pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})])))
    assert [t for b in out for t in b.column("text").to_pylist()] == texts
    assert [t for b in out for t in b.column("decoded").to_pylist()] == [(t or "").encode() for t in texts]
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column("text").to_pylist()) <= 1000 for b in out)


def test_media(docs, texts, empty):
    got = flac.media_column(docs, only=["doc_id", "text"]).collect()
    assert len(got) == len(texts)
    for r in got:
        payload = flac.padded((r.text or "").encode())
        assert bytes(r.payload) == payload and flac.decode([bytes(r.media)]) == [payload]
        assert flac.read_samples(bytes(r.media), r.offsets[-1].sample, 10) == payload[r.offsets[-1].sample :][:10]
    assert flac.media_column(empty).count() == 0


def test_flac_payloads_and_damage():
    r = random.Random(1)
    payloads = [bytes(64), bytes(5000), bytes(r.randrange(256) for _ in range(5000)), b"\x00\xff" * 900, bytes(r.choice([0, 255]) for _ in range(3000)), bytes(int(128 + 100 * np.sin(i / 9)) for i in range(4001))]
    streams = flac.encode(payloads)
    assert flac.decode(streams) == payloads
    for s, p in zip(streams, payloads, strict=True):
        for _ in range(10):
            a, n = r.randrange(len(p) + 9), r.randrange(3000)
            assert flac.read_samples(s, a, n) == p[a : a + n]
        for at in (flac.Stream(s).first + 3, len(s) - 1, flac.Stream(s).first + 8):
            bad = bytearray(s)
            bad[at] ^= 16
            with pytest.raises(flac.CorruptStream):
                flac.decode([bytes(bad)])
    for n in (0, 127, 128, 2047, 2048, 65535, 65536, 2**21, 2**26, 2**31):
        assert flac.read_number(flac.coded_number(n), 0) == (n, len(flac.coded_number(n)))


def test_flac_without_a_whole_seek_table():
    r = random.Random(3)
    payloads = [bytes(64), bytes(r.randrange(256) for _ in range(5000)), bytes(int(128 + 90 * np.sin(i / 9)) for i in range(70_001)), b"\xff\xf8\xff\xf9" * 900]
    for stream, payload in zip(flac.encode(payloads), payloads, strict=True):
        s = flac.Stream(stream)
        info, frames = stream[8 : 8 + 34], stream[s.first :]
        half = s.points[::2].tobytes() if len(s.points) > 1 else b""
        bare = flac.MAGIC + b"\x80\x00\x00\x22" + info + frames
        some = flac.MAGIC + b"\x00\x00\x00\x22" + info + b"\x83" + len(half).to_bytes(3, "big") + half + frames
        unsized = flac.MAGIC + b"\x80\x00\x00\x22" + info[:13] + bytes([info[13] & 0xF0]) + bytes(4 + 16) + frames
        assert flac.decode([bare, some, unsized]) == [payload] * 3
        assert flac.Stream(bare).points.tolist() == s.points.tolist()
        assert flac.read_samples(bare, len(payload) // 2, 1500) == payload[len(payload) // 2 :][:1500]
        for end in (*range(s.first), s.first + 3, len(stream) - 1):
            for cut in (stream[:end], bare[:end]):
                if len(cut) < len(bare):
                    with pytest.raises(flac.CorruptStream):
                        flac.decode([cut])


def test_flac_linear_predictor_and_partitions():
    x, taps, move, k = [int(60 * np.sin(i / 7)) for i in range(64)], [30, -15], 4, 3
    bits = "0" + f"{32 + 1:06b}" + "0" + "".join(f"{v & 255:08b}" for v in x[:2]) + f"{7 - 1:04b}" + f"{move:05b}" + "".join(f"{t & 127:07b}" for t in taps) + "00" + f"{1:04b}"
    for part, (a, b) in enumerate(((2, 32), (32, 64))):
        bits += f"{k if part == 0 else 15:04b}" + ("" if part == 0 else f"{8:05b}")
        for i in range(a, b):
            e = x[i] - (taps[0] * x[i - 1] + taps[1] * x[i - 2] >> move)
            z = 2 * e if e >= 0 else -2 * e - 1
            bits += "0" * (z >> k) + "1" + f"{z & 7:03b}" if part == 0 else f"{e & 255:08b}"
    bits += "0" * (-len(bits) % 8)
    frame = flac.frame_header(0, 64) + int(bits, 2).to_bytes(len(bits) // 8, "big")
    total = flac._SUMS.of(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]))[0]
    frame += int(total).to_bytes(2, "big")
    assert flac.decode_frames(frame, [(0, len(frame))])[0].tolist() == x


def test_line_dedup(docs, texts, empty):
    blanks = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(blanks))
    where = defaultdict(set)
    for i, t in known(texts):
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    shared = {k: max(v) for k, v in where.items() if len(k) >= 40 and len(v) >= 5}
    assert shared
    got = line_dedup.dedup_lines(docs.drop("lines")).collect()
    assert len(got) == len(texts)
    by_id = dict(texts)
    for r in got:
        lines = (by_id[r.doc_id] or "").split("\n")
        kept = [x for x in lines if r.doc_id is None or shared.get(key(x), r.doc_id) == r.doc_id]
        assert (r.lines.n_lines, r.lines.n_dropped) == (len(lines), len(lines) - len(kept))
        assert (r.text or "") == "\n".join(kept)
    assert line_dedup.dedup_lines(docs).count() == len(texts)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_bitmaps_of_many_lines(spark):
    shared = "x" * 45
    rows = [(i, "\n".join(shared if j % (i + 2) == 0 else f"{i}-{j}" for j in range(300))) for i in range(6)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5].text == rows[5][1]
    assert all(got[i].text == "\n".join(x for x in rows[i][1].split("\n") if x != shared) for i in range(5))


def test_language(spark, docs, texts, empty):
    r = random.Random(2)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["straße", "über", "haus"], "cc": ["год", "мир", "язык"]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(r.randrange(3, 30))), lang) for i, lang in enumerate(r.choice(list(words)) for _ in range(600))]
    rows += [(700, None, "aa"), (701, "", "bb"), (702, "12 !? ###", "cc"), (703, "über haus", None), (None, "lorem", "aa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = language.train(frame)
    assert model.languages == ("aa", "bb", "cc")
    got = language.identify(frame, model).withColumn("held", language.held_out("doc_id")).collect()
    assert len(got) == len(rows)
    told = {x.doc_id: x for x in got}
    assert all(x.held == (x.doc_id is None or zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    assert np.mean([x.lang_pred == x.lang for x in got if x.doc_id is not None and x.doc_id < 600 and x.held]) > 0.98
    assert np.mean([x.rejected for x in got if x.doc_id is not None and x.doc_id < 600]) < 0.02
    assert all((told[i].lang_pred, told[i].score, told[i].rejected) == ("und", 0.0, True) for i in (700, 701, 702))
    assert told[703].lang_pred == "bb" and all(0 <= x.score <= 1 for x in got)
    again = language.train(frame.repartition(4))
    assert np.array_equal(again.logits, model.logits) and again.threshold == model.threshold
    assert language.identify(empty, language.train(empty)).count() == 0
