"""Collocations against plain counting, and the parts of the graph."""

import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from test_batch_one import ODD_TEXTS, empty_docs

from cohortloom.llm import collocations, queries
from cohortloom.llm.collocations import Mining, Vocabulary, longest_grams, merged
from cohortloom.llm.common import Stages
from cohortloom.llm.expected_sql import SQL

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, mining):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for words in pieces(text):
            total[lang] += len(words)
            for k in range(1, mining.longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= mining.least}
        inside = {
            q for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= 100 * f[q := p[i : i + k]]
        }
        ranked = []
        for p, a in found.items():
            if p in inside:
                continue
            score, _, l, r = min(
                (mining.scale * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            ranked.append((-score, -a, " ".join(p).encode(), lang, a, l, r, score))
        ranked.sort()
        out += [
            (lang, i, phrase.decode(), a, l, r, total[lang], score)
            for i, (_, _, phrase, _, a, l, r, score) in enumerate(ranked[: mining.limit], 1)
        ]
    return sorted(out)


def mined(spark, rows, mining, **kwargs):
    docs = spark.createDataFrame([(i, l, t) for i, (l, t) in enumerate(rows)], "doc_id long, lang string, text string")
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(docs.repartition(3), mining, **kwargs).collect())


def corpus(seed, count=400):
    chance = random.Random(seed)
    words = [f"w{int(chance.paretovariate(0.7))}" for _ in range(3000)]
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for i in range(count):
        text = [chance.choice(words) for _ in range(chance.randrange(40))]
        if i % 3 == 0:
            at = chance.randrange(len(text) + 1)
            text[at:at] = passage
        if i % 7 == 0:
            text += ["ha"] * chance.randrange(9)
        joined = " ".join(w + chance.choice(["", "", "", ",", ".", "\n", "!\t"]) for w in text)
        rows.append((chance.choice(["en", "de", None]), joined.upper() if i % 11 == 0 else joined))
    return rows


@pytest.mark.parametrize("least", [2, 5, 30])
def test_against_counting(spark, least):
    mining = Mining(least=least, limit=2000)
    got = mined(spark, corpus(least), mining)
    assert got == brute(corpus(least), mining) and len(got) > 3


def test_limit_and_shorter_grams(spark):
    mining = Mining(longest=3, least=4, limit=5)
    assert mined(spark, corpus(1), mining) == brute(corpus(1), mining)


def test_small_parts_change_nothing(spark, monkeypatch):
    """Flushes, buckets by three words, codes and counts beyond their bytes."""
    for name, value in {"FLUSH_WORDS": 20, "FLUSH_GRAMS": 300, "COMMON_SHARE": 20, "CODED": 5, "CODED_SHARE": 50}.items():
        monkeypatch.setattr(collocations, name, value)
    rows = corpus(2) + [("en", "again and again and again " * 200)]
    mining = Mining(least=3)
    assert mined(spark, rows, mining) == brute(rows, mining)


def test_registered_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    with compare.connect(folder) as duck:
        assert compare.difference(queries.op11_collocations(spark, folder), duck, SQL["op11_collocations"]) is None


def test_odd_texts_and_ties(spark):
    rows = [("x", t) for t in ODD_TEXTS * 3] + [(None, "b a, b a. a b"), ("und", "b a; a b"), ("x", "\xff ÿ Aİ aİ"), ("x", None)]
    mining = Mining(least=2)
    assert mined(spark, rows, mining) == brute(rows, mining)


def test_empty_table_and_clashing_columns(spark):
    assert collocations.collocations(empty_docs(spark).selectExpr("*", "'en' as lang") if "lang" not in empty_docs(spark).columns else empty_docs(spark)).count() == 0
    docs = spark.createDataFrame([("en", "a b", 1, 2)] * 3, "lang string, text string, gram int, f int")
    got = collocations.collocations(docs, Mining(least=2)).collect()
    assert [(r["phrase"], r["a"], r["path_words"]) for r in got] == [("a b", 3, 2)]


def test_products_beyond_64_bits(spark):
    """a * n * 1000 passes 2^63: scores stay exact."""
    stages = Stages(spark)
    big = 4_000_000_007
    words = spark.createDataFrame([("en", i, w, big) for i, w in ((1, "a"), (2, "b"))], "lang string, id long, word string, f long")
    totals = spark.createDataFrame([("en", 9_000_000_000_001)], "lang string, n long")
    phrases = spark.createDataFrame([([1, 2], 3_999_999_999)], "gram array<long>, f long")
    counted = collocations.Counted(words, totals, phrases)
    got = collocations.scored(phrases.withColumnRenamed("f", "a"), counted, Mining()).first()
    assert got["score"] == 1000 * 3_999_999_999 * 9_000_000_000_001 // (big * big)
    assert stages.folder


def test_unary_paths_are_the_fixed_passages(spark):
    passage = [f"p{i}" for i in range(12)]
    rows = [(i, "en", " ".join(passage) if i % 2 else " ".join(["x"] + passage[2:] + [f"y{i % 3}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    stages = Stages(spark)
    counted = collocations.count_phrases(docs, Mining(least=10), stages=stages)
    got = {r["passage"]: (r["n_words"], r["f"]) for r in collocations.passages(counted, 5, stages).collect()}
    assert got[" ".join(passage[2:])] == (10, 60)
    assert got[" ".join(passage[:6])] == (6, 30)  # two edges before the shared part
    assert got[" ".join(["x"] + passage[2:6])] == (5, 30)


def test_gram_parts():
    ids = np.array([1, 2, 3, 0, 4, 0, 5, 6], np.int32)
    got = longest_grams(ids, 3).tolist()
    assert got == [[1, 2, 3], [2, 3, 0], [5, 6, 0]]
    grams, counts = merged(np.array([[2, 1], [1, 0], [2, 1]], np.uint64), np.array([5, 1, 2]))
    assert grams.tolist() == [[1, 0], [2, 1]] and counts.tolist() == [1, 7]
    vocabulary = Vocabulary(np.zeros(1, np.uint8), np.empty(0, np.uint64), np.array([9, 4], np.uint64))
    words = np.array([0, 4, 9, 7], np.uint64)
    codes = vocabulary.codes(words)
    assert codes.tolist() == [0, 2, 1, collocations.OTHER]
    assert vocabulary.ids(codes, words[codes == collocations.OTHER]).tolist() == words.tolist()
