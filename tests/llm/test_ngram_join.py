"""Near-duplicate components against all pairs, and the parts of the sketch join."""

import random
import re
import zlib

import numpy as np
import pytest
from test_batch_one import ODD_TEXTS, empty_docs, odd_docs

from cohortloom.llm import ngram_join
from cohortloom.llm.ngram_join import Similarity, Sketcher

FOUR = Similarity(4, 85, 100)


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_components(rows, similarity):
    """{position: smallest id of its component} for rows (id, text)."""
    sets = [shingles(t, similarity.words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * similarity.scale >= max(len(a), len(b)) * similarity.least:
                shared = len(a & b)
                if similarity.linked(shared, len(a) + len(b)):
                    parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    first = lambda own: min((rows[i][0] for i in own if rows[i][0] is not None), default=None)
    return {i: first(own) for own in members.values() for i in own}, sets


def check(spark, rows, similarity):
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "at long, doc_id long, text string")
    got = ngram_join.jaccard_components(docs, similarity, carry=("at",)).collect()
    expected, sets = brute_components(rows, similarity)
    assert sorted(r.c_0 for r in got) == list(range(len(rows)))
    assert {r.c_0: r["__first"] for r in got} == expected
    assert all(r["__n"] == len(sets[r.c_0]) for r in got)
    return got


def family(chance, words, copies, changes):
    base = [f"w{chance.randrange(5000)}" for _ in range(words)]
    out = [base]
    for _ in range(copies):
        copy = list(base)
        for _ in range(chance.randrange(changes + 1)):
            copy[chance.randrange(words)] = f"x{chance.randrange(10**6)}"
        out.append(copy)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("similarity", [FOUR, Similarity()])
def test_families_of_copies(spark, similarity):
    chance, texts = random.Random(similarity.least), []
    for words, copies, changes in ((5, 6, 1), (12, 20, 1), (40, 25, 3), (120, 40, 6), (400, 12, 16), (1500, 6, 40)):
        texts += family(chance, words, copies, changes)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + family(chance, 60, 0, 0)[0] for _ in range(15)]
    texts += ["the same line again", "The SAME line again", "a b", "A B", "a", "b a"]
    rows = list(enumerate(texts, 100))
    chance.shuffle(rows)
    check(spark, rows, similarity)


def test_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(40)]
    got = check(spark, rows, FOUR)
    assert {r["__first"] for r in got} == {0} and sum(r["__kept"] for r in got) == 1


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(spark, [(r.doc_id, r.text) for r in docs], FOUR)


def test_odd_rows_and_columns(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "A b C d E"), (None, None), (None, "alone null id here")]
    check(spark, rows + rows[4:6], FOUR)
    docs = odd_docs(spark)
    kept = ngram_join.drop_near_copies(docs, FOUR)
    assert kept.columns == docs.columns
    expected = {r.doc_id for r in docs.collect()} - {5}
    assert {r.doc_id for r in kept.collect()} == expected
    assert ngram_join.drop_near_copies(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("similarity", [FOUR, Similarity(), Similarity(3, 60, 100)])
def test_linked_sets_share_a_segment_and_unlinked_ones_rarely(similarity):
    chance = np.random.default_rng(1)
    sketcher, sets = Sketcher(similarity), []
    for n in (*range(1, 40), 55, 90, 200, 700, 3000):
        base = chance.integers(0, 2**63, 2 * n).astype(np.uint64)
        for size in {n, max(1, n - 1), n + 1, int(n * similarity.scale / similarity.least)}:
            for shared in range(min(n, size) + 1)[-12:]:
                other = np.unique(np.concatenate([base[:shared], chance.integers(0, 2**63, size - shared).astype(np.uint64)]))
                own = np.unique(base[:n])
                if similarity.linked(shared, len(own) + len(other)) and not np.array_equal(own, other):
                    assert np.intersect1d(sketcher.keys(own), sketcher.keys(other)).size, (n, size, shared)
        sets.append(np.unique(base[:n]))
    keys = np.concatenate([sketcher.keys(s) for s in sets])
    if similarity.least >= 80:
        assert len(np.unique(keys)) == len(keys)


def test_bands_hold_every_size_once():
    for similarity in (FOUR, Similarity(), Similarity(5, 99, 100)):
        ends = ngram_join.bands(similarity, 5000)
        assert ends[0] == 1 and ends == sorted(set(ends))
        for small in range(1, 4000):
            large = small * similarity.scale // similarity.least
            at = np.searchsorted(ends, [small, large], "right")
            assert at[1] - at[0] <= 1


def test_star_pairs_connect_each_group_and_take_equal_groups_once():
    key = np.array([5, 5, 5, 7, 7, 7, 9, 9, 4], np.uint64)
    row = np.array([1, 2, 3, 3, 2, 1, 3, 8, 8], np.int64)
    a, b, group, member = ngram_join.star_pairs(key, row)
    assert sorted(zip(a.tolist(), b.tolist())) == [(3, 1), (3, 2), (3, 8)]
    assert sorted(member.tolist()) == [1, 2, 3] and len(set(group.tolist())) == 1


def test_groups_are_searched_until_no_link_is_missed(spark, monkeypatch):
    """With every pair budget at zero the leader rounds and the final round still find all links."""
    monkeypatch.setattr(ngram_join, "PAIRS_PER_TEXT", 0)
    monkeypatch.setattr(ngram_join, "MAX_LEADER_ROUNDS", 2)
    chance = random.Random(8)
    check(spark, list(enumerate(family(chance, 60, 40, 4) + family(chance, 61, 20, 3))), FOUR)


def test_bit_sketches_bound_the_difference_from_below():
    chance = np.random.default_rng(4)
    for n in (1, 5, 60, 900, 5000):
        base = chance.integers(0, 2**63, 2 * n).astype(np.uint64)
        for cut in (0, n // 10, n // 2, n):
            own, other = base[:n], base[cut : n + cut]
            bits = [np.frombuffer(ngram_join.bit_sketch(x), np.uint8) for x in (own, other)]
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= 2 * cut


def test_large_groups_are_compared_in_tiles(spark, monkeypatch):
    """Unlinked texts with one long template: every link is found, and no unit of work holds the group."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_TEXT", 0)
    monkeypatch.setattr(ngram_join, "MAX_LEADER_ROUNDS", 1)
    largest, plain = [], ngram_join._tiles

    def tiles(members):
        made = plain(members)
        largest.append((members.groupBy("a").count().agg(F.max("count")).first()[0],
                        made.groupBy("a", "p", "q").count().agg(F.max("count")).first()[0]))
        return made

    monkeypatch.setattr(ngram_join, "_tiles", tiles)
    chance, texts = random.Random(12), []
    template = " ".join(f"t{i}" for i in range(170))
    for _ in range(160):
        own = family(chance, 40, 2, 1) if chance.random() < 0.5 else family(chance, 40, 0, 0)
        texts += [f"{template} {t}" for t in own]
    rows = list(enumerate(texts))
    chance.shuffle(rows)
    check(spark, rows, FOUR)
    assert largest and largest[-1][0] > 64 > largest[-1][1]


def test_a_worker_holds_few_words_at_once(monkeypatch):
    """Sets do not depend on how many texts are cut at once, nor on forgotten words."""
    texts = [None, "", "one", *(f"w{i} x{i} y{i} w{i} z{i % 3} end" for i in range(600))]
    once, most = ngram_join.Shingler(4), []
    few = ngram_join.Shingler(4, known=50)
    cut = few._sets

    def counted(part):
        made = cut(part)
        most.append((len(part), len(few.known)))
        return made

    monkeypatch.setattr(few, "_sets", counted)
    assert [s.tolist() for s in few.sets(texts)] == [s.tolist() for s in once._sets(texts)]
    assert max(n for n, _ in most) <= 128 and max(k for _, k in most) <= 50 + 128 * 6


def test_segment_entries_are_packed_small():
    """Six bytes of a key and about one of a row number; whatever the numbers, they come back."""
    chance = np.random.default_rng(7)
    key = chance.integers(0, 1 << 64, 1000, np.uint64)
    row = np.sort(chance.integers(0, 1500, 1000)) + (5 << 33)
    packed = ngram_join.packed_keys(key), ngram_join.packed_rows(row)
    assert len(packed[0]) == 6000 and len(zlib.compress(packed[1])) < 1200
    assert (ngram_join.unpacked_keys(packed[0]) == key >> np.uint64(16)).all()
    for numbers in (row, row[:0], np.array([-(1 << 63), (1 << 63) - 1, 0, -1, 7, 7])):
        assert (ngram_join.unpacked_rows(ngram_join.packed_rows(numbers)) == numbers).all()


def test_one_pair_a_text_is_verified_before_the_others(spark, monkeypatch):
    """All pairs of a family are candidates; after each text's closest pair none is left to verify."""
    sizes, verified = [], ngram_join.set_join.verified

    def counted(pairs, *rest):
        sizes.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(ngram_join.set_join, "verified", counted)
    chance = random.Random(5)
    texts = [" ".join(words) for words in family(chance, 400, 30, 1)]
    check(spark, list(enumerate(texts)), FOUR)
    assert sum(sizes) <= len(texts)


def test_pairs_of_different_components_are_left(spark):
    pairs = spark.createDataFrame([(1, 2, 0), (1, 3, 4), (2, 3, 1), (4, 5, 2), (1, 5, 3)], "a long, b long, d long")
    comps = spark.createDataFrame([(2, 1), (3, 1), (5, 4)], "__row long, comp long")
    assert {tuple(r) for r in ngram_join.closest_pairs(pairs).collect()} == {(1, 2), (2, 3), (4, 5)}
    assert [tuple(r) for r in ngram_join.pairs_apart(pairs, comps).collect()] == [(1, 5)]
