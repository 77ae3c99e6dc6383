"""Shards, mixing, WARC and packing against plain Python on small tables."""

import base64
import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import curriculum_mix, group_packing, histogram_shards, warc_bundles

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clean(v):
    return None if v is None or v != v else int(v)


# ------------------------------------------------------------------ shards


def check_shards(docs, shards, rows):
    expect = collections.Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        expect[(r.doc_id, len(raw) + 8, zlib.crc32(raw))] += 1
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expect
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(0 <= s < shards for s in by)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by.items()}


def test_shards_are_even(docs):
    big = docs.where("length(text) < 3000").crossJoin(docs.sparkSession.range(10).withColumnRenamed("id", "k"))
    big = big.withColumn("doc_id", F.col("doc_id") * 10 + F.col("k")).withColumn("text", F.concat("text", F.col("k").cast("string")))
    sizes = check_shards(big, 24, histogram_shards.shard_documents(big).collect())
    mean = sum(sizes.values()) / 24
    assert max(abs(v - mean) for v in sizes.values()) <= 3200  # about a document


def test_shards_divide_a_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    rows = histogram_shards.shard_documents(docs).collect()
    sizes = check_shards(docs, 24, rows)
    assert max(sizes.values()) < 1.1 * sum(sizes.values()) / 24
    again = histogram_shards.shard_documents(docs.repartition(3)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_made_by_several_tasks(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    key = histogram_shards.text_key(F.col("text"), F.col("doc_id"))
    few = histogram_shards.histogram_shards(docs, 4, key, F.length("text") + 8, order=("doc_id",)).collect()
    many = histogram_shards.histogram_shards(docs, 4, key, F.length("text") + 8, order=("doc_id",), rows_per_task=100).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in few} == {(r.doc_id, r.shard, r.slot) for r in many}


def test_shards_of_odd_rows(odd_docs):
    check_shards(odd_docs, 24, histogram_shards.shard_documents(odd_docs).collect())
    assert histogram_shards.shard_documents(odd_docs.limit(0)).count() == 0


def test_shards_stay_native(docs):
    plan = histogram_shards.shard_documents(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------ mixing


def targets(sizes):
    """Sources by code point, null last, weigh 3, 1, 2 in turn; water level."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out = 1.5 * sum(sizes.values()), {}
    open_ = [s for s in names if sizes[s]]
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            out |= share
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return {s: out.get(s, 0.0) for s in names}


def check_mix(docs, rows):
    sizes = collections.Counter()
    given = collections.Counter()
    for r in docs.collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        given[(r.doc_id, n)] += 1
    assert collections.Counter((r.doc_id, r["size"]) for r in rows) == given
    want, taken = targets(sizes), collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        assert len(r.positions) == -(-r.taken // r["size"] if r["size"] else 0) and all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5


def test_mix(docs, odd_docs):
    rows = curriculum_mix.mix_documents(docs).collect()
    check_mix(docs, rows)
    again = curriculum_mix.mix_documents(docs.repartition(5)).collect()
    assert [tuple(r) for r in rows] == [tuple(r) for r in again]
    first = [r.positions[0] if r.positions else 2 for r in rows]
    assert first == sorted(first)
    check_mix(odd_docs, curriculum_mix.mix_documents(odd_docs).collect())
    assert curriculum_mix.mix_documents(docs.limit(0)).count() == 0
    check_mix(docs, curriculum_mix.mix_documents(docs, bucket_rows=7).collect())


def test_schedules():
    assert [curriculum_mix.integral(s) for s in curriculum_mix.SCHEDULES] == [3, 1, 2]


def test_positions_invert_the_schedule(spark):
    shares = spark.range(101).select((F.col("id") / 100).alias("s"))
    for knots in curriculum_mix.SCHEDULES + (((0.0, 0.0), (0.3, 2.0), (1.0, 0.0)),):
        total = curriculum_mix.integral(knots)
        for r in shares.select("s", curriculum_mix.position(knots, F.col("s")).alias("t")).collect():
            xs = np.linspace(0, r.t, 2001)
            area = np.trapezoid(np.interp(xs, *zip(*knots)), xs)
            assert area / total == pytest.approx(r.s, abs=1e-3)


def test_mixed_copies(odd_docs):
    plan = curriculum_mix.mix_documents(odd_docs).collect()
    copies = curriculum_mix.mixed_copies(odd_docs)
    assert copies.columns == [*[c for c in odd_docs.columns if c != "position"], "position"]
    got = copies.collect()
    # whole copies only; the one that crosses the target if half of it or more is inside
    whole = [(r.size, [2 * (r.taken - i * r.size) >= r.size for i in range(len(r.positions))]) for r in plan]
    assert sorted(len(WORD.findall(r.text)) for r in got) == sorted(n for n, taken in whole for t in taken if t)
    texts = {r.text for r in odd_docs.collect()}
    assert all(r.text in texts for r in got)
    by_source = collections.defaultdict(lambda: [0, 0, 0])
    for r in plan:
        by_source[r.source][0] += r.taken
        by_source[r.source][2] = max(by_source[r.source][2], r.size)
    for r in got:
        by_source[r.source][1] += len(WORD.findall(r.text))
    assert all(abs(want - words) <= longest / 2 for want, words, longest in by_source.values())


# ------------------------------------------------------------------ WARC


def check_archive(pages, rows):
    top, expect = {}, collections.Counter()
    given = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    rank = lambda p: -1 if p is None else p
    for p, raw in given:
        top[raw] = max(top.get(raw, None), p, key=rank)
    first = set()
    for p, raw in sorted(given, key=lambda x: (x[1], rank(x[0]))):
        response = p == top[raw] and raw not in first
        if response:
            first.add(raw)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expect[(p, len(raw), digest, "response" if response else "revisit", None if response else top[raw])] += 1
    assert collections.Counter(tuple(r[:5]) for r in rows) == expect


def test_warc_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (None, "a b\n", ""), (5000, None, "x"), (5001, "u", "é" * 100_000), (5002, "u", "é" * 100_000)], pages.schema)
    pages = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000)).unionByName(pages.limit(2)).unionByName(odd)
    pages = pages.withColumn("bundle", F.lit("clash"))
    path = f"{tmp_path}/bundles"
    warc_bundles.write_bundles(pages, path, frame_bytes=4000, bundle_bytes=20_000)
    rows = warc_bundles.read_records(spark, path).collect()
    check_archive(pages, rows)
    # files: a plain reader sees all records, the index finds each of them
    folder = str(tmp_path / "files")
    os.mkdir(folder)
    assert warc_bundles.export_bundles(spark, path, folder) > 3
    raw = {f: open(f"{folder}/{f}", "rb").read() for f in os.listdir(folder)}
    found = sum(zstandard.ZstdDecompressor().stream_reader(b, read_across_frames=True).read().count(b"WARC/1.1\r\n") for b in raw.values())
    assert found == pages.count()
    for r in warc_bundles.record_index(spark, path).collect():
        record = warc_bundles.read_record(raw[r.bundle], r.frame, r.offset, r.length)
        assert f"WARC-Record-ID: <{r.record_id}>".encode() in record
    frames = [f for b in raw.values() for f in warc_bundles.read_seek_table(b)]
    assert len(frames) > len(raw)


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_bundles.archive_pages(pages).count() == 0


# ------------------------------------------------------------------ packing


def check_packing(docs, rows):
    tokenizer = Tokenizer.from_file(group_packing.default_tokenizer())
    expect = collections.Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            piece = np.array(ids[k : k + 2048], "<u4")
            expect[(r.doc_id, k // 2048, k, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expect
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by), sum(r.length for r in rows) / 2048


def test_packing(docs, odd_docs, spark):
    used, least = check_packing(docs, group_packing.pack_documents(docs).collect())
    assert used <= 1.02 * least + 2
    check_packing(odd_docs, group_packing.pack_documents(odd_docs).collect())
    special = spark.createDataFrame([(1, "<|endoftext|> don't <|ENDOFTEXT|>, we're a<b> É's 12,3 x--y a—.b c 'tis ≠ á", None, None, None)], DOCS)
    check_packing(special, group_packing.pack_documents(special).collect())
    assert group_packing.pack_documents(docs.limit(0)).count() == 0


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(1)
    for trial in range(20):
        lengths = np.clip(rng.lognormal(6, 1, rng.integers(1, 2000)).astype(int), 1, 2048)
        counts = collections.Counter(lengths.tolist())
        bins, ranks = collections.defaultdict(list), collections.defaultdict(list)
        for size, rank, n, sequence, offset in group_packing.plan_packing(dict(counts), groups=64 if trial % 2 else 256):
            ranks[size] += range(rank, rank + n)
            for j in range(n):
                bins[sequence + j].append((offset, size))
        assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
        for own in bins.values():
            at = 0
            for offset, size in sorted(own):
                assert offset == at
                at += size
            assert at <= 2048


def test_encoder_forgets(docs):
    texts = [r.text for r in docs.limit(30).collect()]
    from tessera.llm._letters import texts_to_bytes

    small, large = (group_packing.Encoder(group_packing.default_tokenizer(), most) for most in (10, 10**6))
    for _ in range(2):
        for t in texts:
            a, b = (e.encode(*texts_to_bytes([t]))[0] for e in (small, large))
            assert (a == b).all()
