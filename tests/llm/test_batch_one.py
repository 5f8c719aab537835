"""Quality rules, exact deduplication, WARC, token store and packing against brute force."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

from cohortloom.llm import exact_dedup, fast_encode, packing, quality_rules, token_store, warc
from cohortloom.llm.common import Stages
from cohortloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Kept_by string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = [
    None, "", " \t\n", "one", "A b C d E", "a B c D e", "x y z w v x y z w v x y z w v", "É é ß İ", "a\nb\na\n\na",
    "long " * 3000, "w" * 40000, "tail " + "q" * 40000, "naïve 漢字 😀 <|endoftext|> 'tis don't", "a  b\t\tc \n\n d ",
    "\x1c\x1d a b", "!!! ### $$$ %%%", "a b c d e f g h i j k l m n o p",
]


def odd_docs(spark):
    rows = [(i, t, "en", f"h{i % 3}" if i % 5 else None, 0, "k") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[9], (None, "A b C d E", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    with compare.connect(FOLDER) as duck:
        assert compare.difference(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


# --- quality rules


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_of_odd_texts(spark):
    got = quality_rules.with_measures(odd_docs(spark), "text", ["text"]).collect()
    assert len(got) == len(ODD_TEXTS) + 4
    for row in got:
        assert tuple(row)[1:] == brute_measures(row.text), row.text and row.text[:40]


def test_host_with_failing_documents_is_rejected_and_small_ones_are_not(spark):
    good = "a b c d e f g h i j k l"
    rows = [(i, good, "en", "fine", 0, "") for i in range(300)]
    rows += [(1000 + i, "too short" if i < 290 else good, "en", "bad", 0, "") for i in range(300)]
    rows += [(2000, "short", "en", "tiny", 0, ""), (2001, good, "en", "tiny", 0, ""), (2002, good, "en", None, 0, "")]
    judged = quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA), carry=["doc_id", "source"])
    out = {r.doc_id: r for r in judged.collect()}
    assert out[0].kept and out[2001].kept and out[2002].kept
    assert not out[2000].kept and out[2000].base_failed and not out[2000].host_rejected
    assert not out[1299].kept and not out[1299].base_failed and out[1299].host_rejected


def test_quality_rules_on_empty_and_clashing(spark):
    assert quality_rules.quality_rules(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        quality_rules.quality_rules(empty_docs(spark).withColumnRenamed("Kept_by", "KEPT"))


# --- exact dedup


def brute_groups(rows):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    key = lambda d: (d is not None, d)
    return {
        t: (max(ids, key=key), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items()
    }, lower


@pytest.mark.parametrize("size", [4, 64, exact_dedup.BLOCK_BYTES])
def test_exact_groups_of_odd_texts(spark, size):
    docs = odd_docs(spark)
    groups, lower = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = exact_dedup.exact_groups(docs, carry=["doc_id", "text"], size=size).collect()
    assert len(got) == docs.count()
    kept = Counter()
    for r in got:
        assert (r.keep_id, r.group_size, r.text_sha256) == groups[lower(r.text)]
        kept[lower(r.text)] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_exact_groups_when_block_keys_clash(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "block_key", lambda b: F.struct(F.lit(1).alias("a"), F.lit(1).alias("b")))
    docs = odd_docs(spark)
    groups, lower = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    for r in exact_dedup.exact_groups(docs, carry=["doc_id", "text"], size=64).collect():
        assert (r.keep_id, r.group_size) == groups[lower(r.text)][:2]


def test_drop_copies_keeps_columns_and_one_row_per_text(spark):
    docs = odd_docs(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    groups, lower = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(lower(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0


# --- WARC


def test_archives_round_trip(spark, tmp_path):
    big = "payload " * 40
    rows = [
        (3, "http://a/ü\r\nX: y", big), (2, "http://b", big), (9, None, big), (4, "u", "small"), (5, "u", "small"),
        (6, "u", None), (None, "u", "null id " * 30), (7, "u", "WARC/1.1\r\n\r\n " * 20), (2, "again", big),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), records_per_file=2)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows) and not any(r.gap_end for r in got)
    by_id = {r.record_id: r for r in got}
    assert by_id["urn:page:3"].refers_to == by_id["urn:page:9"].refers_to == "urn:page:2"
    assert by_id["urn:page:3"].payload_length == len(big) and by_id["urn:page:3"].block == b""
    assert by_id["urn:page:3"].target_uri == "http://a/ü\r\nX: y"
    assert [r.record_type for r in got if r.record_id == "urn:page:2"] == ["response"] * 2
    assert by_id["urn:page:4"].record_type == by_id["urn:page:5"].record_type == "response"
    assert bytes(by_id["urn:page:7"].block).decode() == rows[7][2] and by_id["urn:page:6"].payload_length == 0
    assert by_id["urn:page:"].record_type == "response"


def test_archives_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def plain_record(i):
    body = f"body {i} ".encode() * 30
    return warc.record_bytes(
        [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>"),
         ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(body).hexdigest())], body
    )


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_later_records(zipped):
    parts = [warc.gzip_member(plain_record(i)) if zipped else plain_record(i) for i in range(6)]
    ends = np.cumsum([len(p) for p in parts]).tolist()
    data = bytearray(b"".join(parts))
    data[ends[1] + len(parts[2]) // 2] ^= 0xFF  # record 2 is damaged
    data = bytes(data[: ends[4] + 40])  # record 5 is cut off
    found = warc.salvage(data)
    assert [r.headers["warc-record-id"] for r in found.records] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    assert found.gaps == [(ends[1], ends[2]), (ends[4], ends[4] + 40)]


def test_salvage_searches_inside_members(spark, tmp_path):
    chance = random.Random(2)
    bodies = [bytes(chance.randrange(256) for _ in range(3000)) for _ in range(6)]
    parts = [warc.record_bytes([
        ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>"),
        ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(b).hexdigest())], b) for i, b in enumerate(bodies)]
    ends = np.cumsum([len(p) for p in parts]).tolist()
    content = bytearray(b"".join(parts))
    content[ends[1] + 1500] ^= 0xFF  # record 2 is bad before it is compressed
    member = warc.gzip_member(bytes(content))
    ids = lambda found: [int(r.headers["warc-record-id"][10:-1]) for r in found.records]
    whole, cut = warc.salvage(member), warc.salvage(member[:-1500])
    assert ids(whole) == [0, 1, 3, 4, 5] and whole.inner == [(0, ends[1], ends[2])] and whole.gaps == []
    assert ids(cut) == [0, 1, 3, 4] and cut.inner[0] == (0, ends[1], ends[2]) and cut.inner[1][1] == ends[4]
    assert cut.gaps[-1][1] == len(member) - 1500
    trailer = member[:-8] + bytes(8)
    assert ids(warc.salvage(trailer)) == [0, 1, 3, 4, 5]
    (tmp_path / "a.gz").write_bytes(member)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [(r.record_offset, r.inner_start, r.inner_end) for r in rows if r.gap_end is not None] == [(0, ends[1], ends[2])]
    assert sum(r.gap_end is None for r in rows) == 5


def record_with(kind, block, *headers):
    return warc.record_bytes([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x:{kind}>"), *headers], block)


def base32_sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_payload_digests_cover_the_body_of_http_messages():
    body, head = b"<html>body</html>" * 20, b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
    http = ("Content-Type", "application/http; msgtype=response")
    plain = head + b"\r\n" + body
    chunked = head + b"Transfer-Encoding: chunked\r\n\r\n" + b"".join(
        b"%x\r\n%s\r\n" % (len(p), p) for p in (body[:100], body[100:])) + b"0\r\n\r\n"
    whole = [
        record_with("response", plain, http, ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(body).hexdigest())),
        record_with("response", plain, http, ("WARC-Payload-Digest", base32_sha1(body))),
        record_with("response", chunked, http, ("WARC-Payload-Digest", base32_sha1(body))),
        record_with("resource", body, ("WARC-Payload-Digest", base32_sha1(body)), ("WARC-Block-Digest", base32_sha1(body))),
        record_with("metadata", body, ("WARC-Payload-Digest", "crc9:00")),
        record_with("revisit", head, http, ("WARC-Payload-Digest", base32_sha1(body)), ("WARC-Block-Digest", base32_sha1(head))),
    ]
    found = warc.salvage(b"".join(whole))
    assert len(found.records) == len(whole) and not found.gaps


@pytest.mark.parametrize("name", ["WARC-Payload-Digest", "WARC-Block-Digest"])
@pytest.mark.parametrize("kind", ["response", "resource"])
def test_a_changed_byte_is_found_by_either_digest(kind, name):
    body = b"some body " * 30
    good = record_with(kind, body, (name, base32_sha1(body)))
    bad = bytearray(good)
    bad[len(good) - 50] ^= 1
    found = warc.salvage(bytes(bad) + good)
    assert [r.offset for r in found.records] == [len(good)] and found.gaps == [(0, len(good))]


def test_salvage_survives_random_damage():
    chance = random.Random(5)
    for _ in range(40):
        parts = [warc.gzip_member(plain_record(i)) if i % 2 else plain_record(i) for i in range(8)]
        starts = np.cumsum([0] + [len(p) for p in parts]).tolist()
        data, hit = bytearray(b"".join(parts)), chance.randrange(8)
        at = chance.randrange(starts[hit], starts[hit + 1])
        data[at : at + 3] = bytes(chance.randrange(256) for _ in range(3))
        found = warc.salvage(bytes(data))
        ids = [r.headers["warc-record-id"] for r in found.records]
        touched = {hit, hit + (at + 3 > starts[hit + 1])}
        assert all(f"<urn:page:{i}>" in ids for i in set(range(8)) - touched)
        covered = sum(b - a for a, b in found.gaps)
        assert 0 <= covered <= len(data) and warc.salvage(b"").records == []


# --- token store and packing


def library_ids(texts, name, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(fast_encode.tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize(
    "name, chunks", [("byte_bpe_50k.json", fast_encode.BYTE_LEVEL), ("word_bpe_49k.json", fast_encode.SPACE_DROPPED)]
)
def test_chunks_give_the_librarys_ids(spark, name, chunks):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts += ["  lead", "trail  ", "a b   c", "x\r\n\r\ny", "é ́x", "a​b ﻿c", "ΑΣ ΣΑΣ."]
    encoder = fast_encode.ChunkEncoder(fast_encode.tokenizer_path(name), chunks, pool_size=20_000)
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, counts = fast_encode.with_end(*encoder.encode(part), 7)
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == library_ids(part, name, 7)


def test_queries_encode_special_tokens_as_the_librarys_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = ["na <|endoftext|> b<|startoftext|>c", "x<|endoftext|><|endoftext|>", "<|END|> plain text", None, "a, <|startoftext|>."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for query, name, end in (("op3_token_store", "byte_bpe_50k.json", 0), ("op6_packing", "word_bpe_49k.json", 1)):
        plain = Tokenizer.from_file(fast_encode.tokenizer_path(name))
        ids = [plain.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]
        got = [tuple(r)[:4] for r in QUERIES[query](spark, str(tmp_path)).collect()]
        first = 0 if query == "op6_packing" else sum(map(len, ids[:1]))
        assert {g[0] for g in got} == set(range(len(texts)))
        for doc, start, length, crc in got:
            at = start if query == "op6_packing" else 0
            assert crc == zlib.crc32(np.array(ids[doc][at : at + length], "<u4").tobytes())
        assert sum(g[2] for g in got) == sum(map(len, ids)) and (not first or got[1][1] == first)


def brute_tokens(docs, end=0):
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, library_ids([t for _, t in rows], "byte_bpe_50k.json", end)):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_store_round_trip(spark):
    for docs in (odd_docs(spark), spark.read.parquet(f"{FOLDER}/documents.parquet")):
        table = token_store.write_tokens(docs, shard_tokens=20_000)
        got = sorted(map(tuple, table.read().collect()), key=lambda r: r[1])
        assert got == brute_tokens(docs)
    data = table.shards.first().data
    shard = token_store.Shard(bytes(data), table.dictionary)
    assert table.dictionary and sum(len(shard.ids(i)) for i in range(len(shard))) == shard.counts.sum()
    with pytest.raises(ValueError):
        token_store.Shard(bytes(data), b"another")
    assert token_store.write_tokens(empty_docs(spark)).read().count() == 0


def test_token_store_is_opened_from_its_folder(spark, tmp_path):
    docs, folder = spark.read.parquet(f"{FOLDER}/documents.parquet"), str(tmp_path / "store")
    written = token_store.write_tokens(docs, shard_tokens=20_000, folder=folder).read(with_ids=True)
    opened = token_store.open_tokens(spark.newSession(), folder)
    assert opened.dictionary and sorted(map(str, opened.read(with_ids=True).collect())) == sorted(map(str, written.collect()))
    with pytest.raises(Exception, match="(?i)exists"):
        token_store.write_tokens(docs, folder=folder)


def test_dictionary_is_trained_on_long_texts_too_and_its_lack_is_logged(spark, caplog):
    chance = random.Random(7)
    words = [f"word{i}" for i in range(500)]
    rows = [(i, " ".join(chance.choices(words, k=7000))) for i in range(40)]
    assert all(len(t) > token_store.DictionaryBounds().text_bytes for _, t in rows)
    path = fast_encode.tokenizer_path("byte_bpe_50k.json")
    train = lambda r: token_store.train_dictionary(spark.createDataFrame(r, "doc_id long, text string"), "text", "doc_id", path, 0, 2)
    assert train(rows) and not caplog.records
    assert train([(1, "a")]) == b"" and "no dictionary" in caplog.text


def test_wide_ids_and_null_keys_in_a_shard():
    import zstandard

    ids, counts = np.array([70000, 1, 2, 3], np.uint32), np.array([1, 3])
    shard = token_store.Shard(token_store.write_shard([None, -5], ids, counts, 4, b"", zstandard.ZstdCompressor()), b"")
    assert shard.doc_ids == [None, -5] and shard.ids(0).tolist() == [70000] and shard.ids(1).tolist() == [1, 2, 3]


def check_pieces(rows, texts, capacity):
    """rows: (doc_id, start, length, crc, doc_tokens, sequence, offset); every id once, no gap."""
    expected = dict(zip(texts, library_ids(list(texts.values()), "word_bpe_49k.json", 1)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r[5]].append(r)
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        at = 0
        for _, start, length, crc, total, _, _ in sorted(pieces, key=lambda r: r[1]):
            assert start == at and total == len(expected[doc])
            assert crc == zlib.crc32(np.array(expected[doc][start : start + length], "<u4").tobytes())
            at += length
        assert at == len(expected[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing_covers_every_id_once(spark):
    docs = odd_docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [tuple(r) for r in packing.pack(docs, capacity=64, block_tokens=5000).collect()]
    assert check_pieces(rows, texts, 64) == 0
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in packing.pack(docs).collect()]
    assert check_pieces(rows, {r.doc_id: r.text for r in docs.collect()}, packing.CAPACITY) == 0
    assert packing.pack(empty_docs(spark)).count() == 0
    with_ids = packing.pack(odd_docs(spark), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)
    assert sum(r.doc_id is None for r in with_ids) >= 2


def test_fullest_is_the_best_subset():
    chance = random.Random(3)
    for _ in range(200):
        counts = Counter(chance.randrange(1, 30) for _ in range(chance.randrange(1, 12)))
        reach = {0}
        for k, n in counts.items():
            reach = {r + k * i for r in reach for i in range(n + 1)}
        used = packing.fullest(dict(counts), 40)
        assert all(used[k] <= counts[k] for k in used)
        assert sum(k * n for k, n in used.items()) == max(r for r in reach if r <= 40)


def test_stages_are_written_below_the_scratch_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("cohortloom.llm.common.scratch_folder", lambda s: f"file://{tmp_path}/x")
    stages = Stages(spark)
    kept = stages.keep(spark.range(3), "x")
    assert kept.count() == 3 and kept.inputFiles()[0].startswith(stages.folder.replace("file://", "file:///"[:7]))
    path = kept.inputFiles()[0].removeprefix("file://")
    stages.drop(kept)
    assert not os.path.exists(path)
