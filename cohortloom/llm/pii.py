"""Personal data: candidate generators, boosted trees and calibrated thresholds.

Four patterns with checks (the base) always count. Looser generators propose further,
overlapping spans: spelled-out addresses, digit groups in any layout. A candidate's format
and context give it a label of its own: personal (a spelled-out address, a national number
in a usual layout or after a word such as "call", a card number in a loose layout with a
right check digit), not personal (no such number can look like this), or open. Personal
ones are added whatever else is in the table, however frequent they are.

The open ones are left to a model: every candidate is described in a few coarse levels;
base spans and personal candidates are its positive examples, candidates that are not
personal its negative ones, open ones are no examples. Examples of all documents are
counted per combination of levels (a fixed number of combinations, so the table has a
proven bound), boosted trees are fitted to those counts, and per kind the lowest score at
which the share of positive examples reaches the wanted precision becomes the threshold.
Open candidates beyond it are added. Trees are compiled into Column expressions. Added
spans touch no base span.

Everything is Column expressions; nothing but the counts is shuffled. Positions come from
the lengths of a text's matches and of the parts between them.

Defined results: null counts as the empty text and has no spans; positions are code
points, the end exclusive; repeated rows are judged alike; an empty table gives no rows;
a clash of a carried column with a computed one raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Stages, text_of
from cohortloom.llm.trees import Node, boost

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, written so that no text makes matching quadratic: a match can only
#: begin where the plain pattern's leftmost match would, and no part is tried twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "digits": r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9])++",
}
NEEDED = {"email": "@", "spelled": r"@|[(\[]at[)\]]", "phone": r"\+[0-9]"}
SPAN = "struct<kind:int,start:int,end:int>"
COMPUTED = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
CHUNK = 256
CUES = r"(?i)(?:mail|phone|tel|call|fax|mobile|contact|card|visa|account|addr|host|server)"

#: Labels of candidates.
NOT_PERSONAL, OPEN, PERSONAL = 0, 1, 2
ADDRESS = r"^[A-Za-z0-9][A-Za-z0-9._%+-]*\x20?(?:@|\(at\)|\[at\])\x20?(?:[A-Za-z0-9-]+\x20?(?:\.|\(dot\)|\[dot\])\x20?)+[A-Za-z]{2,24}$"
SPELLED_OUT = r"[(\[](?:at|dot)[)\]]"
#: National numbers: area code and groups, or a trunk zero and groups.
NATIONAL = (
    r"^(?:(?:1[\x20.-])?\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}"
    r"|\(?0[1-9][0-9]{1,4}\)?[\x20.-]{1,2}[0-9]{2,}(?:[\x20-][0-9]{2,})*)$"
)
CALENDAR = r"^(?:[0-9]{4}[\x20.-][0-9]{2}[\x20.-][0-9]{2}|[0-9]{2}[\x20.-][0-9]{2}[\x20.-][0-9]{4})(?![0-9])"
MAIL_CUES = r"(?i)\b(?:e-?mail|mail|contact|write|address)\b"
CALL_CUES = r"(?i)\b(?:(?:tele)?phone|tel|call|fax|mobile|cell|contact|dial|ring|sms|text|reach)\b"


@dataclass(frozen=True)
class Thresholds:
    """Fit of the trees and the wanted share of positive examples beyond a threshold."""

    precision: float = 0.9
    rounds: int = 12
    depth: int = 2


#: Levels of a candidate's features; their product bounds the table of counts.
LEVELS = {
    "digits": 7, "length": 6, "separators": 4, "before": 4, "after": 4, "bracket": 2, "dash": 2, "dot": 2, "cue": 2,
}


def _running(lengths: Column) -> Column:
    """Running sums of an array, in chunks so that long arrays cost no quadratic copying."""
    zero = F.lit(0)
    count = F.greatest(F.ceil(F.size(lengths) / CHUNK).cast("int"), F.lit(1))
    part = lambda c: F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    sums = F.transform(F.sequence(zero, count - 1), lambda c: total(part(c)))
    walk = lambda c, base: F.aggregate(
        part(c), F.struct(base.alias("s"), F.array().cast("array<int>").alias("a")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a")),
    )["a"]
    return F.flatten(F.transform(sums, lambda _, c: walk(c, total(F.slice(sums, F.lit(1), c)))))


def _matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds, per pattern, ``m_<name>``: array of (match, start, end)."""
    none = F.array().cast("array<string>")
    for name, pattern in patterns.items():
        hit = F.col(text).rlike(NEEDED.get(name, "[0-9]"))
        df = df.withColumn(f"w_{name}", F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    for name, pattern in patterns.items():
        some = F.size(f"w_{name}") > 0
        df = df.withColumn(f"g_{name}", F.when(some, F.split(text, pattern, -1)).otherwise(none))
    for name in patterns:
        steps = F.flatten(F.zip_with(f"g_{name}", f"w_{name}", lambda g, w: F.array(
            F.length(g), F.coalesce(F.length(w), F.lit(0)))))
        df = df.withColumn(f"g_{name}", F.when(F.size(f"w_{name}") > 0, steps).otherwise(F.array().cast("array<int>")))
    for name in patterns:
        empty = F.array().cast("array<int>")
        df = df.withColumn(f"g_{name}", F.when(F.size(f"w_{name}") > 0, _running(F.col(f"g_{name}"))).otherwise(empty))
    for name in patterns:
        df = df.withColumn(f"m_{name}", _placed(f"w_{name}", F.col(f"g_{name}")))
    return df.drop(*(f"{x}_{n}" for n in patterns for x in "wg"))


def _placed(matches: str, ends: Column) -> Column:
    return F.transform(matches, lambda w, i: F.struct(
        w.alias("match"), F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end")))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _checked(number: int, kind: str) -> Column:
    valid = F.filter(f"m_{kind}", lambda m: _valid(kind, m["match"]))
    return F.transform(
        valid, lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    ).cast(f"array<{SPAN}>")


def _level(value: Column, *bounds: int) -> Column:
    return reduce(lambda c, b: c + F.when(value > b, 1).otherwise(0), bounds, F.lit(0))


def _context(char: Column) -> Column:
    return (
        F.when(char.rlike("^[A-Za-z]"), 1).when(char.rlike("^[0-9]"), 2).when(char.rlike(r"^[\"'=:/_-]"), 3).otherwise(0)
    )


def _label(kind: Column, match: Column, before: Column, after: Column, cue: Column) -> Column:
    """Is the candidate personal data by its own format and context?"""
    digits = F.length(_digits(match))
    glued = before.rlike("^[A-Za-z0-9_/=#$.,-]") | after.rlike("^[A-Za-z0-9_/=%]")
    address = F.when(F.length(match) <= 320, match.rlike(ADDRESS)).otherwise(False)
    mail = (
        F.when(~address, NOT_PERSONAL).when(match.rlike(SPELLED_OUT) | cue.rlike(MAIL_CUES), PERSONAL).otherwise(OPEN)
    )
    card = F.when(_valid("card", match) & ~glued, PERSONAL).otherwise(NOT_PERSONAL)
    phone = (
        F.when(~digits.between(7, 15) | (F.length(match) > 40) | glued | match.rlike(CALENDAR), NOT_PERSONAL)
        .when(match.rlike(NATIONAL) & (digits >= 8), PERSONAL).when(cue.rlike(CALL_CUES), PERSONAL).otherwise(OPEN)
    )
    return F.when(kind == 0, mail).when(kind == 2, card).when(kind == 3, phone).otherwise(NOT_PERSONAL)


def _candidate(text: Column, kind: Column, span: Column) -> Column:
    match = span["match"]
    count, start = F.length(_digits(match)), span["start"]
    before = F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise("")
    after = F.substring(text, span["end"] + 1, F.lit(1))
    cue = F.substring(text, F.greatest(start - 19, F.lit(1)), F.least(start, F.lit(20)))
    return F.struct(
        kind.cast("int").alias("kind"), start.alias("start"), span["end"].alias("end"),
        _level(count, 6, 7, 9, 12, 15, 19).alias("digits"), _level(F.length(match), 8, 12, 16, 20, 30).alias("length"),
        _level(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), 0, 2, 4).alias("separators"),
        _context(before).alias("before"), _context(after).alias("after"),
        match.contains("(").cast("int").alias("bracket"), match.contains("-").cast("int").alias("dash"),
        match.contains(".").cast("int").alias("dot"), cue.rlike(CUES).cast("int").alias("cue"),
        _label(kind, match, before, after, cue).alias("label"),
    )


def find_candidates(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    """``carry``, ``base`` (spans) and ``candidates`` (spans with feature levels)."""
    kept = [F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)]
    found = _matches(docs.select(*kept, text_of(f"`{text}`").alias("__t")), "__t", {**BASE, **GENERATORS})
    body = F.col("__t")
    base = F.concat(*(_checked(i, k) for i, k in enumerate(KINDS)))
    count = lambda m: F.length(_digits(m["match"]))
    kind = lambda m: (
        F.when(m["match"].rlike(r"^[0-9]+(?:\.[0-9]+){3,}$"), 1).when(count(m) > 15, 2).otherwise(3)
    )
    candidates = F.concat(
        F.transform("m_spelled", lambda m: _candidate(body, F.lit(0), m)),
        F.transform(F.filter("m_digits", lambda m: count(m) >= 7), lambda m: _candidate(body, kind(m), m)),
        F.transform("m_phone", lambda m: _candidate(body, F.lit(3), m)),
    )
    out = found.select(*(f"c_{i}" for i in range(len(carry))), base.alias("__base"), candidates.alias("__candidates"))
    return out.select(
        *(F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)), F.col("__base").alias("base"),
        F.col("__candidates").alias("candidates"),
    )


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass(frozen=True)
class CandidateModel:
    """Per kind: base log odds, trees with their rate, and the threshold (None: add nothing)."""

    kinds: dict[int, tuple[float, list[Node], float | None]]
    rate: float = 0.3

    def selects(self, candidate: Column) -> Column:
        chosen = F.lit(False)
        for kind, (base, trees, limit) in self.kinds.items():
            if limit is not None:
                total = reduce(lambda s, t: s + self.rate * _compiled(t, candidate), trees, F.lit(base))
                chosen = chosen | ((candidate["kind"] == kind) & (total >= limit))
        return chosen


def _compiled(node: Node, candidate: Column) -> Column:
    if node.low is None:
        return F.lit(node.value)
    column = candidate[list(LEVELS)[node.feature]]
    return F.when(column <= node.at, _compiled(node.low, candidate)).otherwise(_compiled(node.high, candidate))


def train(found: DataFrame, settings: Thresholds = Thresholds()) -> CandidateModel:
    """Fit to the counts of all examples per combination of levels, at most a fixed number."""
    marked = found.select("base", F.explode("candidates").alias("c")).select(
        "c.kind", *(f"c.{f}" for f in LEVELS),
        F.when(
            F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & _touches(b, F.col("c"))), True
        ).when(F.col("c.label") != OPEN, F.col("c.label") == PERSONAL).alias("y"),
    ).filter("y is not null")
    cells = marked.groupBy("kind", *LEVELS).agg(F.count("*").alias("n"), F.count_if("y").alias("y")).collect()
    kinds = {}
    for kind in range(len(KINDS)):
        rows = sorted(tuple(r)[1:] for r in cells if r.kind == kind)
        table = np.array(rows, dtype=np.int64).reshape(len(rows), len(LEVELS) + 2)
        kinds[kind] = fit_cells(table[:, :-2], table[:, -2], table[:, -1], settings)
    return CandidateModel(kinds)


def fit_cells(levels: np.ndarray, n: np.ndarray, positive: np.ndarray, settings: Thresholds):
    """Trees for cells with ``n`` examples, ``positive`` of them personal data; the threshold.

    One negative example more is counted beyond every threshold (rule of succession).
    """
    if not positive.sum():
        return 0.0, [], None
    doubled = np.concatenate([levels, levels])
    labels = np.repeat([1.0, 0.0], len(levels))
    weights = np.concatenate([positive, n - positive]).astype(float)
    base, trees, score = boost(doubled, labels, weights, settings.rounds, settings.depth, rate=0.3)
    score = score[: len(levels)]
    limit = None
    for at in sorted(set(score.tolist()), reverse=True):
        beyond = score >= at
        if positive[beyond].sum() >= settings.precision * (n[beyond].sum() + 1):
            limit = at
    return base, trees, None if limit is None else limit - 1e-9


def _ordered(spans: Column) -> Column:
    return F.array_sort(F.array_distinct(spans))


def select_spans(found: DataFrame, model: CandidateModel) -> DataFrame:
    """``found`` with ``base`` ordered and ``all_spans`` (base and added) instead of candidates."""
    added = F.transform(
        F.filter(
            F.filter("candidates", lambda c: (c["label"] == PERSONAL) | ((c["label"] == OPEN) & model.selects(c))),
            lambda c: ~F.exists("base", lambda b: _touches(b, c)),
        ),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    ).cast(f"array<{SPAN}>")
    names = [c for c in found.columns if c not in ("base", "candidates")]
    return found.select(
        *(F.col(f"`{c}`") for c in names), _ordered(F.col("base")).alias("base"),
        _ordered(F.concat("base", added)).alias("all_spans"),
    )


def spelled(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def detect(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), settings: Thresholds = Thresholds(),
    stages: Stages | None = None,
) -> DataFrame:
    """``carry``, ``base`` and ``all_spans``: (kind, start, end) in order, kinds as in ``KINDS``."""
    if clash := {c.lower() for c in carry} & {"base", "candidates", "all_spans", *COMPUTED}:
        raise ValueError(f"columns {sorted(clash)} are also computed; rename them or leave them out")
    stages = stages or Stages(docs.sparkSession)
    found = stages.keep(find_candidates(docs, text, carry), "candidates")
    return select_spans(found, train(found, settings))


def digests(spans: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the base's hash and all spans spelled out."""
    names = [c for c in spans.columns if c not in ("base", "all_spans")]
    count = lambda i: F.size(F.filter("base", lambda b: b["kind"] == i)).cast("long")
    return spans.select(
        *(F.col(f"`{c}`") for c in names), *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(spelled("base"), 256).alias("base_sha256"), spelled("all_spans").alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones merged, replaced by its kind in brackets."""
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    ))
    walked = F.aggregate(
        by_start, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(
            s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))
        ).otherwise(F.struct(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(marks, s["kind"])).alias("out"),
            s["end"].alias("at"),
        )),
    )
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))
    )


def redact(docs: DataFrame, text: str = "text", settings: Thresholds = Thresholds(), stages: Stages | None = None) -> DataFrame:
    """The input's rows and columns, personal data in ``text`` replaced by marks such as [EMAIL]."""
    columns = docs.columns
    renamed = docs.toDF(*(f"d_{i}" for i in range(len(columns))))
    body = f"d_{columns.index(text)}"
    spans = detect(renamed, body, renamed.columns, settings, stages)
    clean = spans.withColumn(
        body, F.when(F.col(body).isNotNull(), redacted(F.col(body), F.col("all_spans")))
    )
    return clean.select(*(F.col(f"d_{i}").alias(c) for i, c in enumerate(columns)))
