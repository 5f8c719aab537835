"""The transducer against its library, the trie against dictionaries, the pipeline stage by stage."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_batch_one import ODD_TEXTS, brute_groups, brute_measures, check_pieces, empty_docs, odd_docs
from test_ngram_join import brute_components
from test_pii_and_quality import brute_base

from cohortloom.llm import ngram_trie, piece_fst
from cohortloom.llm.fast_encode import tokenizer_path
from cohortloom.llm.ngram_join import Similarity

FOLDER = "/root/testdata/sf0.001"
MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


# --- pieces


def test_shortest_paths_are_the_librarys_pieces(documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = piece_fst.PieceEncoder(MODEL, pool_size=50_000)
    texts = [t for _, t in documents] + [t or "" for t in ODD_TEXTS if t is None or len(t) < 30_000]
    texts += [" lead", "▁", "a▁b", "<s> <unk> <0x41>", "   ", "aaaaaaaaaaaaaaaaa", "\U0001f468‍\U0001f469", "x\x00y", "ﬁ Å"]
    for at in range(0, len(texts), 40):
        part = texts[at : at + 40]
        ids, counts = encoder.encode(part)
        got = [a.tolist() for a in np.split(ids, np.cumsum(counts)[:-1])]
        for text, own, theirs in zip(part, got, library.encode(part)):
            assert own == theirs, text[:60]
            assert encoder.machine.decode(own) == text.replace("▁", " ")


def test_very_long_word_takes_linear_time():
    machine = piece_fst.PieceTransducer(MODEL)
    assert "".join(machine.path("ab" * 20_000)) == "ab" * 20_000


def test_encode_pieces_of_odd_rows(spark):
    got = piece_fst.encode_pieces(odd_docs(spark), with_ids=True).collect()
    assert len(got) == odd_docs(spark).count() and all(r.round_trip for r in got)
    assert all(r.n_pieces == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (0, 1)} == {0}
    assert piece_fst.encode_pieces(empty_docs(spark)).count() == 0


# --- trie


def test_elias_fano_sequences():
    chance = np.random.default_rng(2)
    for n, bound in ((0, 1), (1, 1), (5, 3), (1000, 50), (1000, 10**12), (300, 2**40)):
        values = np.sort(chance.integers(0, bound, n))
        sequence = ngram_trie.EliasFano(ngram_trie.EliasFano.pack(values))
        assert sequence.values().tolist() == values.tolist()
        wanted = np.concatenate([values, values + 1, chance.integers(0, bound + 5, 50)])
        assert sequence.successor(wanted).tolist() == np.searchsorted(values, wanted).tolist()
        if n == 1000 and bound > 10**6:
            assert sequence.size < n * (2.5 + np.log2(bound / n)) / 8 + 64


def test_trie_finds_its_pairs_and_no_others():
    chance = np.random.default_rng(3)
    codes = np.unique(chance.integers(0, 10**5, 3000))
    context, word = (codes // 300).astype(np.uint64), codes % 300
    share = chance.random(len(codes))
    trie = ngram_trie.TrieShard(ngram_trie.TrieShard.pack(context, word, share))
    found = ngram_trie.expand(trie.look_up(context, word))
    assert np.allclose(np.log10(found), np.log10(share), atol=2 * ngram_trie.STEP)
    other = np.setdiff1d(np.arange(2 * 10**5), codes)
    assert not trie.look_up((other // 300).astype(np.uint64), other % 300).any()
    assert not trie.look_up(context, word + 10**6).any()


def brute_scores(rows, strength=ngram_trie.STRENGTH):
    learned = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1
    cut = lambda t: (t or "").encode().lower().split() + [None]
    words, pairs = Counter(), Counter()
    for d, t in rows:
        if learned(d):
            tokens = cut(t)
            words.update(tokens)
            pairs.update(zip([None, *tokens], tokens))
    total, kinds = sum(words.values()), len(words)
    base = lambda w: (words[w] + 0.5) / (total + 0.5 * (kinds + 1))
    for d, t in rows:
        tokens = cut(t)
        smooth = 0.0
        for v, w in zip([None, *tokens], tokens):
            share = pairs[v, w] / (words[v] + strength) if words[v] else 0
            smooth += np.log10(share + (strength / (words[v] + strength) if words[v] else 1) * base(w))
        yield (d, not learned(d), len(tokens), sum(words[w] > 0 for w in tokens), total,
               sum(np.log10(base(w)) for w in tokens), smooth)


@pytest.mark.parametrize("tokens", [700, ngram_trie.CHUNK_TOKENS])
def test_scores_against_dictionaries(spark, documents, monkeypatch, tokens):
    monkeypatch.setattr(ngram_trie, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(ngram_trie, "SPREAD_COUNT", 40)
    rows = documents[:120] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a b"), (None, None), documents[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, ngram_trie.score_documents(docs).collect()), key=lambda r: (str(r[0]), r[2]))
    expected = sorted(brute_scores(rows), key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for own, brute in zip(got, expected):
        assert abs(own[5] - brute[5]) < 1e-6 * abs(brute[5]) + 1e-9
        assert abs(own[6] - brute[6]) < 2 * ngram_trie.STEP * brute[2] + 1e-9


def brute_order(rows, order, strength=ngram_trie.STRENGTH):
    grams, contexts, words = Counter(), Counter(), Counter()
    cut = lambda t: [None, *(t or "").encode().lower().split(), None]
    parts = lambda t: [(t[i], [tuple(t[i - k : i]) for k in range(1, min(order - 1, i) + 1)]) for i in range(1, len(t))]
    for d, t in rows:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1:
            for w, befores in parts(cut(t)):
                words[w] += 1
                for c in befores:
                    grams[c, w] += 1
                    contexts[c] += 1
    for d, t in rows:
        score = 0.0
        for w, befores in parts(cut(t)):
            p = (words[w] + 0.5) / (sum(words.values()) + 0.5 * (len(words) + 1))
            for c in befores:
                p = (grams[c, w] + strength * p) / (contexts[c] + strength)
            score += np.log10(p)
        yield str(d), score


@pytest.mark.parametrize("order", [3, 4])
def test_longer_contexts_against_dictionaries(spark, documents, monkeypatch, order):
    monkeypatch.setattr(ngram_trie, "CHUNK_TOKENS", 700)
    monkeypatch.setattr(ngram_trie, "SPREAD_COUNT", 40)
    rows = documents[:30] + [(1000, None), (1001, "a"), (1002, "a b a b a b a"), (None, "a b"), documents[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.score, r.n_tokens) for r in ngram_trie.score_documents(docs, order=order).collect())
    for own, brute in zip(got, sorted(brute_order(rows, order)), strict=True):
        assert own[0] == brute[0] and abs(own[1] - brute[1]) < order * ngram_trie.STEP * own[2] + 1e-9


def test_search_stays_between_pointers():
    chance = np.random.default_rng(6)
    values = np.sort(chance.integers(0, 10**7, 2000))
    sequence = ngram_trie.EliasFano(ngram_trie.EliasFano.pack(values))
    assert (sequence.at(np.arange(2000)) == values).all()
    left = chance.integers(0, 2000, 500)
    right = np.minimum(left + chance.integers(0, 50, 500), 2000)
    wanted = chance.integers(0, 10**7 + 10**6, 500)
    assert sequence.search(wanted, left, right).tolist() == np.clip(np.searchsorted(values, wanted), left, right).tolist()


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in ngram_trie.score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert ngram_trie.score_documents(empty_docs(spark)).count() == 0


# --- pipeline


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages, kept = dict(corpus_pipeline.STAGES), {}
    for name in list(stages)[:-1]:
        docs = stages[name](spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    fails = lambda m: m[0] < 10 or 100 * m[5] > 20 * m[0]
    assert kept["quality_rules"] == {d: t for d, t in documents if not fails(brute_measures(t))}
    rows = list(kept["quality_rules"].items())
    assert set(kept["exact_dedup"]) == {g[0] for g in brute_groups(rows)[0].values()}
    rows = list(kept["exact_dedup"].items())
    firsts, _ = brute_components(rows, Similarity())
    assert set(kept["ngram_jaccard_join"]) == set(firsts.values())
    for d, text in kept["pii"].items():
        before = kept["ngram_jaccard_join"][d]
        assert (text == before) == (not brute_base(before)) and not brute_base(text)
    pieces = [tuple(r)[:7] for r in stages["packing"](spark, docs, FOLDER).collect()]
    assert check_pieces(pieces, kept["pii"], 2048) == 0
    assert corpus_pipeline.run(spark, FOLDER).count() == len(pieces)
