"""Fast-sketch near duplicates against all pairs, and the parts of the sketch."""

import random

import numpy as np
import pytest
from test_batch_one import ODD_TEXTS, empty_docs
from test_ngram_join import brute_components, family

from cohortloom.llm import minhash, queries, set_join
from cohortloom.llm.common import Stages
from cohortloom.llm.minhash import Banding, band_keys, fast_sketches
from cohortloom.llm.ngram_join import Shingler, Similarity

SMALL = "/root/testdata/sf0.001"
TWO = Similarity(2, 80, 100)


def check(spark, rows, similarity):
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "at long, doc_id long, text string")
    got = minhash.near_duplicates(docs, similarity, carry=("at",)).collect()
    expected, sets = brute_components(rows, similarity)
    assert sorted(r.c_0 for r in got) == list(range(len(rows)))
    assert {r.c_0: r.component_id for r in got} == expected
    assert all(r.n_shingles == len(sets[r.c_0]) for r in got)
    return got


def families(seed):
    chance, texts = random.Random(seed), []
    for words, copies, changes in ((5, 6, 1), (12, 20, 1), (40, 25, 3), (120, 40, 8), (400, 12, 30), (1500, 6, 90)):
        texts += family(chance, words, copies, changes)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + family(chance, 40, 0, 0)[0] for _ in range(40)]
    texts += ["the same line again", "The SAME line again", "a b", "A B", "a", "b a", "A"]
    rows = list(enumerate(texts, 100))
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("similarity", [TWO, Similarity()])
def test_families_of_copies(spark, similarity):
    got = check(spark, families(similarity.words), similarity)
    components = {r.component_id for r in got}
    assert sum(r.kept for r in got) == len(components)  # no text of these is without words


@pytest.mark.parametrize("rounds", [0, 2])
def test_rounds_do_not_change_the_result(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(minhash, "OPEN_SHARE", 0)
    check(spark, families(9)[:150], TWO)


def test_registered_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected, sets = brute_components(docs, TWO)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op12_minhash(spark, SMALL).collect()}
    assert got == {
        d: (len(sets[i]), expected[i], expected[i] == d) for i, (d, _) in enumerate(docs)
    }


def test_odd_texts_nulls_ties_and_clashing_columns(spark):
    rows = [(None if i % 5 == 4 else i // 2, t) for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS, "x y z", None, ""])]
    check(spark, rows, TWO)
    docs = spark.createDataFrame(
        [(d, t, i, "k") for i, (d, t) in enumerate(rows)], "doc_id long, text string, __number int, kept string"
    )
    left = minhash.drop_near_duplicates(docs, TWO)
    assert left.columns == docs.columns
    expected, sets = brute_components(rows, TWO)
    wordless = sum(not s for s in sets)
    same = {}
    for i, s in enumerate(sets):
        if s:
            same.setdefault(s, i)
    assert left.count() >= wordless + 1 and {r["kept"] for r in left.collect()} == {"k"}
    assert len({r["__number"] for r in left.collect()}) == left.count()


def test_empty_table(spark):
    assert minhash.near_duplicates(empty_docs(spark)).count() == 0
    assert minhash.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_every_coordinate_is_filled_whatever_the_size():
    chance = np.random.default_rng(3)
    sets = [np.unique(chance.integers(1, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 180, 5000)] + [np.empty(0, np.uint64)]
    sketch = fast_sketches(sets, 180)
    largest = np.uint64(2**64 - 1)
    assert (sketch[:5] != largest).all() and (sketch[5] == largest).all()
    alone = [fast_sketches([s], 180)[0] for s in sets]
    assert (sketch == np.stack(alone)).all()  # a batch changes nothing
    assert (sketch[0] >> np.uint64(48)).max() >= 180  # a set of one member needs the closing rounds


def test_equal_coordinates_estimate_the_similarity():
    """Unbiased and concentrated: over 200 pairs of each size the mean is within 1 %, each pair within 0.2."""
    chance = np.random.default_rng(4)
    for size in (10, 200, 2000):
        sets = []
        for _ in range(200):
            own = chance.integers(1, 2**63, size, dtype=np.uint64)
            other = own.copy()
            other[: size // 10] = chance.integers(1, 2**63, size // 10, dtype=np.uint64)
            sets += [np.unique(own), np.unique(other)]
        sketch = fast_sketches(sets, 180)
        agree = (sketch[0::2] == sketch[1::2]).mean(axis=1)
        true = (size - size // 10) / (size + size // 10)
        assert abs(agree.mean() - true) < 0.01 and np.abs(agree - true).max() < 0.2


def test_bands_miss_hardly_any_pair_at_the_threshold():
    assert Banding().missed(0.8) < 1e-6
    chance = np.random.default_rng(5)
    sets = []
    for _ in range(300):
        own = chance.integers(1, 2**63, 90, dtype=np.uint64)
        other = np.concatenate([own[:80], chance.integers(1, 2**63, 10, dtype=np.uint64)])
        sets += [np.unique(own), np.unique(other)]
    keys = band_keys(fast_sketches(sets, Banding().size), Banding())
    assert ((keys[0::2] == keys[1::2]).sum(axis=1) > 0).all()
    assert len(np.unique(keys[0::2])) == keys[0::2].size  # unrelated sets share no band


def test_verification_deals_a_leader_with_many_partners(spark, monkeypatch):
    monkeypatch.setattr(set_join, "CHUNK", 3)
    texts = ["a b c d e f g h"] + [f"a b c d e f g {x}" for x in "hijklmnopq"] + ["z y x", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "__row long, __text string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, len(texts))], "a long, b long")
    near = Similarity(1, 70, 100)
    links = set_join.verified(pairs, rows, near, lambda: Shingler(1), Stages(spark))
    sets = [set(t.split()) for t in texts]
    expected = [(0, i) for i in range(1, len(texts)) if 100 * len(sets[0] & sets[i]) >= 70 * len(sets[0] | sets[i])]
    assert sorted(map(tuple, links.collect())) == expected and len(expected) == 10
