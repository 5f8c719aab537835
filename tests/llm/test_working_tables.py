"""What the operators write and shuffle besides their results."""

import numpy as np
import pytest

from cohortloom.llm import collocations, exact_dedup, minhash, ngram_join, ngram_trie
from cohortloom.llm.common import Stages


@pytest.fixture()
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def some_docs(spark):
    base = " ".join(f"word{i}" for i in range(60))
    texts = [base, base, base + " more", base.upper(), "short one", "", None, "other " * 40]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize(
    "drop", [exact_dedup.drop_copies, ngram_join.drop_near_copies, minhash.drop_near_duplicates]
)
def test_dropped_rows_are_broadcast_so_texts_are_not_shuffled(without_broadcasts, drop):
    kept = drop(some_docs(without_broadcasts))
    assert kept.count() < 8
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_drop_copies_writes_the_texts_once(spark, monkeypatch):
    written = []
    keep = Stages.keep
    monkeypatch.setattr(Stages, "keep", lambda self, df, name: written.append(df.columns) or keep(self, df, name))
    kept = exact_dedup.drop_copies(some_docs(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7]
    assert [c for c in written if {"text", "content", "block"} & {*c}] == [["doc_id", "text", "__number"]]


def test_blocks_that_occur_once_are_not_shuffled(spark, monkeypatch):
    """Only contents of blocks whose key is met again are compared."""
    compared = []
    few = exact_dedup.small_ids
    monkeypatch.setattr(exact_dedup, "small_ids", lambda ids: compared.append(ids.count()) or few(ids))
    found = exact_dedup.exact_groups(some_docs(spark), size=1 << 14)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in found.collect()} == {
        0: (3, 3), 1: (3, 3), 2: (2, 1), 3: (3, 3), 4: (4, 1), 5: (6, 2), 6: (6, 2), 7: (7, 1),
    }
    assert compared == [2]  # the text met three times and the empty one


def test_trie_tables_are_joined_by_chunk_without_an_exchange(without_broadcasts, monkeypatch):
    monkeypatch.setattr(ngram_trie, "CHUNK_TOKENS", 50)
    scores = ngram_trie.score_documents(some_docs(without_broadcasts), order=3)
    assert scores.count() == 8
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_grams_of_many_chunks_are_looked_up_once(spark, monkeypatch):
    """Chunks ask for the same n-grams; the shard looks each up once, and all chunks get its answer."""
    looked_up, answers, positions = [], {}, ngram_trie.TrieShard.positions
    monkeypatch.setattr(
        ngram_trie.TrieShard, "positions", lambda self, c, w: looked_up.append(len(w)) or positions(self, c, w)
    )
    monkeypatch.setattr(ngram_trie, "_by_shard", lambda requests, answer, parts: answers.update(level=answer))
    ngram_trie._score_level(some_docs(spark).mapInArrow(lambda x: x, "doc_id long, text string"), 4, 2, 8.0, 2, False)

    def asks(chunk, words, counts):
        n = len(words)
        data = ngram_trie._zip(
            np.array([5] + [0] * (n - 1), "<u8"), np.array(words, "<u8"), np.full(n, 9, "<u8"), np.array(counts, "<u4")
        )
        return 1, chunk, n, data

    rows = [asks(7, [2, 3, 6], [1, 0, 0]), asks(8, [2, 3], [2, 1]), asks(9, [6, 2], [0, 0])]
    found = [(shard, chunk, n, ngram_trie._unzip(data, n, "<u2", "<u8", "<u8")) for shard, chunk, n, data in answers["level"](1, rows)]
    codes = {2: ngram_trie.quantise(np.array([3 / 17]))[0], 3: ngram_trie.quantise(np.array([1 / 17]))[0], 6: 0}
    for (_, chunk, n, got), words in zip(found, ([2, 3, 6], [2, 3], [6, 2])):
        assert got[0].tolist() == [codes[w] for w in words]
        assert got[2].tolist() == [{2: 3, 3: 1, 6: 0}[w] for w in words]
        assert all(p == {2: 0, 3: 1, 6: 0}[w] for p, w in zip(got[1].tolist(), words))
    assert [f[:3] for f in found] == [(1, 7, 3), (1, 8, 2), (1, 9, 2)] and sum(looked_up) == 3


def test_trie_orders_are_those_of_plain_sorts():
    random = np.random.default_rng(5)
    for high in (1, 50, 1 << 40, 1 << 62):
        first, then = random.integers(0, high, 400), random.integers(0, 30, 400)
        assert ngram_trie._order(first, then).tolist() == np.lexsort((then, first)).tolist()
        values, place = ngram_trie._distinct(first)
        wanted, back = np.unique(first, return_inverse=True)
        assert values.tolist() == wanted.tolist() and place.tolist() == back.tolist()
    empty = np.empty(0, np.int64)
    assert [len(x) for x in (ngram_trie._order(empty, empty), *ngram_trie._distinct(empty))] == [0, 0, 0]


def test_frequent_words_of_grams_have_short_codes():
    """Words beyond the first 65,534 travelled as random ids of eight bytes."""
    vocabulary = collocations.Vocabulary(np.full(collocations.MAP_BITS // 8, 255, np.uint8), np.empty(0, np.uint64), np.empty(0, np.uint64))
    first = collocations.Grams(collocations.Mining(), vocabulary, 1)
    words = [f"w{i}" for i in range(70_000)]
    first.add("en", " ".join(words))
    coded = collocations.Vocabulary(vocabulary.bits, vocabulary.common, first.ids[1:])
    grams = collocations.Grams(collocations.Mining(), coded, 1)
    grams.add("en", " ".join(words))
    (packed,) = grams.flush()
    columns = [[part] for part in packed.to_pylist()[0].values()][1:]
    assert not any(packed.column(f"id{k}")[0].as_py() for k in range(5))
    found, counts = collocations.unpacked(columns, collocations.Mining(), coded)
    assert len(found) == counts.sum() == 69_999 and set(found[:, 0].tolist()) <= {*grams.ids.tolist()} - {0}
    assert packed.nbytes < 8 * 5 * 70_000 / 2
