"""Token alignment against a plain two-pointer walk over the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_batch_one import ODD_TEXTS, empty_docs

from cohortloom.llm import queries, token_alignment
from cohortloom.llm.token_alignment import LEFT, RIGHT, Aligner, skip_runs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(public_tokenizers.path(LEFT))
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(RIGHT))


def plain_tokens(libraries, text):
    """(left ids, right ids, left ends, right ends), or None where a side does not spell the text."""
    left, right = libraries
    if not text:
        return None
    a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
    alphabet = token_alignment.byte_level_alphabet()
    a_bytes = [bytes(alphabet[c] for c in left.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i)
        else right.id_to_piece(i).replace("▁", " ").encode() for i in b
    ]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    return a, b, np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()


def brute(libraries, rows):
    """{id: expected columns} by walking both end arrays one by one."""
    found, counts = {}, Counter()
    for doc_id, text in rows:
        tokens = plain_tokens(libraries, text)
        groups = []
        if tokens:
            a, b, ends, others = tokens
            common = set(ends) & set(others)
            i = j = 0
            for end in sorted(common):
                k, m = ends.index(end, i) + 1, others.index(end, j) + 1
                groups.append((a[i:k], b[j:m]))
                i, j = k, m
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        found[doc_id] = (tokens, groups, links)
    best = {}
    for (x, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = {}
    for doc_id, (tokens, groups, links) in found.items():
        spelt = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out[doc_id] = (
            len(tokens[0]) if tokens else 0, len(tokens[1]) if tokens else 0, len(groups), len(links),
            sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(spelt.encode()).hexdigest() if groups else "",
        )
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def as_dict(df, key):
    return {r[key]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_skip_runs_finds_all_common_ends():
    chance = random.Random(5)
    for size in (1, 2, 9, 70, 3000):
        for share in (0.05, 0.5, 0.98):
            last = 4 * size
            pick = lambda: sorted({last, *(k for k in range(1, last) if chance.random() < share)})  # noqa: E731, B023
            left, right = pick(), pick()
            i, j = skip_runs(np.array(left), np.array(right))
            common = sorted(set(left) & set(right))
            assert [left[k - 1] for k in i] == common == [right[k - 1] for k in j]
    assert [len(x) for x in skip_runs(np.empty(0, np.int64), np.empty(0, np.int64))] == [0, 0]


def test_registered_query(spark, libraries):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = brute(libraries, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = as_dict(queries.op13_token_alignment(spark, SMALL), "doc_id")
    assert got == expected and sum(v[3] for v in got.values()) > 0


ODD = [*ODD_TEXTS, " ", "  a", "a ", "a \n b\n", "\n\n", "x▁y", "▁", "a ▁ b", "<s> <|endoftext|> <0x41> </s>",
       "a\x00b", "a\x1c b\x85 c", "don't  we'll", "日本語 テキスト", "🙂 🙂🙂", "é́ ﬁ　①", "word " * 3000, "same", "same"]


def test_odd_texts_and_clashing_columns(spark, libraries):
    rows = [(i, t, i) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block long").repartition(3)
    got = as_dict(token_alignment.align_documents(docs, carry=("doc_id", "block")), "c_1")
    assert got == brute(libraries, [(i, t) for i, t, _ in rows])


def test_real_outputs(spark, libraries):
    rows = list(enumerate(["The quick brown fox, naïve façade.", None, "x▁y", "Zwölf Boxkämpfer jagen"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in token_alignment.alignments(docs).collect():
        tokens = plain_tokens(libraries, dict(rows)[r["c_0"]])
        if tokens is None:
            assert not r["left_ids"] and not r["right_ids"] and not r["left_ends"] and not r["right_ends"]
            continue
        a, b, ends, others = tokens
        assert (r["left_ids"], r["right_ids"]) == (a, b)
        common = sorted(set(ends) & set(others))
        assert [ends[k - 1] for k in r["left_ends"]] == common == [others[k - 1] for k in r["right_ends"]]
    table = token_alignment.translation_table(docs).collect()
    assert sum(t["links"] for t in table) == sum(v[3] for v in brute(libraries, rows).values())


def test_empty_table(spark):
    assert token_alignment.align_documents(empty_docs(spark)).count() == 0


def test_a_small_pool_changes_nothing(libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "POOL_CHUNKS", 3)
    monkeypatch.setattr(token_alignment, "SLICE", 10)
    aligner = Aligner(public_tokenizers.path(LEFT), public_tokenizers.path(RIGHT))
    for texts in (["one two three", None, "four five"], ["two two", "x▁y", "six"]):
        index, counts = aligner.cut(texts)
        lengths = aligner.n_left.values[index]
        ids = aligner.left.gather(aligner.at[0].values[index], lengths).tolist()
        expected = [plain_tokens(libraries, t) for t in texts]
        assert ids == [i for e in expected if e for i in e[0]]
        assert [bool(c) for c in counts] == [e is not None for e in expected]
