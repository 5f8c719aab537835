"""Personal data and the quality classifier against plain Python and held-out labels."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from test_batch_one import ODD_TEXTS, empty_docs, odd_docs

from cohortloom.llm import pii, quality_classifier
from cohortloom.llm.common import Stages

FOLDER = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PII_TEXTS = [
    "mail a.b@c.d_e@f.gh, x@y no; z@q.r. end@", "@a.b a@.b a@b..c a@b.c..d é@b.co", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.04",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111x 41 11", "+1 (555) 123-4567 +12 +1 2345678901234567 ++49 30 1234567)",
    "漢😀 10.0.0.1 é a@b.co\n+4912345678", "1" * 50_000, "a" * 50_000 + "@b.cc", "a@b" + ".c" * 20_000, "+1" + " 2" * 20_000,
    "user (at) site dot com user(at)site(dot)com", "call 555-123-4567 now or (030) 1234567", "1.1.1.1" * 300, "9" * 17 + " " + "9" * 18,
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_base(text):
    text, out = text or "", []
    for kind in pii.KINDS:
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 if len(p) < 9 else not p.strip("0") for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def spelled(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS + PII_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.digests(pii.detect(docs, carry=["doc_id", "text"])).collect()
    assert len(got) == len(rows)
    for r in got:
        base = brute_base(r.text)
        assert r.base_sha256 == hashlib.sha256(spelled(base).encode()).hexdigest(), (r.text or "")[:60]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert {(k, int(a), int(b)) for k, a, b in spans} >= set(base)


def test_base_spans_of_documents_and_learned_ones(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = pii.digests(pii.detect(docs, carry=["doc_id", "text"])).collect()
    added = base_count = 0
    for r in got:
        base = brute_base(r.text)
        assert r.base_sha256 == hashlib.sha256(spelled(base).encode()).hexdigest()
        base_count += len(base)
        added += len([x for x in r.spans.split(",") if x]) - len(base)
    assert base_count > 20 and added <= 0.1 * base_count


def test_learned_threshold_adds_spans_that_look_like_the_base(spark):
    good = [(i, f"call me on +1 (555) {100 + i}-4567 today") for i in range(60)]
    bad = [(100 + i, f"build x{10**7 + i}y done") for i in range(60)]
    docs = spark.createDataFrame([*good, *bad, (500, "call me on 1 (555) 123-4567 today")], "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.digests(pii.detect(docs)).collect()}
    assert out[500].startswith("phone:") and out[100] == "" and out[0].count("phone") == 1


@pytest.mark.parametrize("base", [0, 1, 19, 20])
def test_personal_forms_are_found_however_frequent_they_are(spark, base):
    forms = ["call 555-123-4{:03d} now", "(030) 1234{:03d}", "fax 1 (555) 123-4{:03d}", "u{:03d} (at) site (dot) com",
             "my phone is 12345{:03d}"]
    rows = [(100 * k + i, form.format(i)) for k, form in enumerate(forms) for i in range(50)]
    rows += [(1000 + i, f"+1 (555) 100-4{i:03d} or a{i}@b.cc") for i in range(base)]
    others = ["build x12345678y", "on 2024-01-15 10", "total $12345678", "id=12345678", "1234567890123456789012", "see you (at) 5.30"]
    rows += [(2000 + i, t) for i, t in enumerate(others)]
    out = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(out[100 * k + i].all_spans) == 1 for k in range(len(forms)) for i in range(50))
    assert not any(out[2000 + i].all_spans for i in range(len(others)))


def test_candidate_features_stay_within_their_levels(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string")
    for r in pii.find_candidates(docs, "text", ["doc_id"]).collect():
        for c in r.candidates:
            assert all(0 <= c[f] < n for f, n in pii.LEVELS.items())


def test_redaction_keeps_rows_columns_and_other_text(spark):
    docs = odd_docs(spark).unionByName(
        spark.createDataFrame([(900 + i, t, None, None, 0, "") for i, t in enumerate(PII_TEXTS)], odd_docs(spark).schema)
    )
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    out = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert out[905] == "漢😀 [IP] é [EMAIL]\n[PHONE]" and out[0] is None and out[1] == ""
    assert out[900].startswith("mail [EMAIL][EMAIL], x@y no;")
    assert pii.redact(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        pii.detect(docs.withColumnRenamed("lang", "Spans"), carry=["Spans"])


def test_fit_cells_without_examples_adds_nothing():
    levels = np.zeros((1, len(pii.LEVELS)), int)
    assert pii.fit_cells(levels, np.array([5]), np.array([3]), pii.Thresholds())[2] is None


# --- quality classifier


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.classify(docs, quality_classifier.train(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in scored
            if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 30
    assert np.mean([p == y for _, p, y in held]) > 0.9
    good, bad = ([s for s, _, y in held if y == v] for v in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9


def test_classifier_of_odd_and_empty_inputs(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    scored = quality_classifier.classify(docs, quality_classifier.train(docs, labels)).collect()
    assert len(scored) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in scored)
    none = quality_classifier.train(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.classify(docs, none).collect()} == {0.5}
    assert quality_classifier.classify(empty_docs(spark), none).count() == 0


def test_model_columns_agree_with_numpy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.train(docs, labels)
    assert 0 < len(model.rules) < 150 and isinstance(Stages(spark).folder, str)
    table = quality_classifier.with_features(docs, "text", ["doc_id"]).withColumn("score", model.score()).collect()
    for r in table[:100]:
        x = np.array([[r[f] for f in quality_classifier.FEATURES]])
        total = model.bias + sum(w for w, path in model.rules if quality_classifier._holds(x, path)[0])
        total += sum(w * min(max(x[0, f], low), high) for w, f, low, high in model.linear)
        assert abs(1 / (1 + np.exp(-total)) - r.score) < 1e-9
