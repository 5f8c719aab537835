"""Clinical rules over the feature matrix, with a "not enough data" outcome.

A rule is declared as a tree of blocks, categories, terms and columns and becomes one
boolean ``Column``; nothing is parsed or joined.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import by_algorithm
from cohortloom.operators.features import cohort_keys, tag_cohorts
from cohortloom.spec import PATIENT_ID


@dataclass(frozen=True)
class AnyOf:
    parts: tuple[Node, ...]


@dataclass(frozen=True)
class AllOf:
    parts: tuple[Node, ...]


@dataclass(frozen=True)
class Negated:
    part: Node


@dataclass(frozen=True)
class Where:
    """Condition on a patient column, e.g. ``Where("AGE_AT_INDEX_DATE", ">=", 18)``."""

    column: str
    comparator: str
    value: float


Node = Union[str, AnyOf, AllOf, Negated, Where]


def any_of(*parts: Node) -> AnyOf:
    return AnyOf(parts)


def all_of(*parts: Node) -> AllOf:
    return AllOf(parts)


@dataclass(frozen=True)
class Rule:
    """Alternatives over blocks; blocks over categories; category → terms → columns."""

    alternatives: tuple[Node, ...]
    blocks: Mapping[str, Node]
    categories: Mapping[str, Sequence[str]]
    terms: Mapping[str, Sequence[str]] = field(default_factory=dict)


COMPARISONS: dict[str, Callable[[Column, float], Column]] = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def _bind(node: Node, leaf: Callable[[str], Column], negate: bool) -> Column:
    if isinstance(node, str):
        return leaf(node)
    if isinstance(node, Where):
        return COMPARISONS[node.comparator](F.col(node.column), node.value)
    if isinstance(node, Negated):
        inner = _bind(node.part, leaf, negate)
        return ~inner if negate else inner
    parts = [_bind(p, leaf, negate) for p in node.parts]
    return reduce(or_ if isinstance(node, AnyOf) else and_, parts)


class BoundRule:
    """A rule over the columns one matrix really has.

    Blocks are evaluated once per patient, as columns of their own: the alternatives then
    combine a handful of booleans instead of repeating every code of every block.
    """

    def __init__(self, rule: Rule, matrix: DataFrame):
        self.rule = rule
        self.keys = cohort_keys(matrix)
        self.columns = set(matrix.columns)
        self.blocks = matrix.select(
            *self.keys,
            *[self.asked(b).alias(_asked(b)) for b in rule.blocks],
            *[self.value(b).alias(_value(b)) for b in rule.blocks],
        )

    def asked(self, block: str) -> Column:
        return self._block(block, self._as_known, negate=False)

    def value(self, block: str) -> Column:
        return self._block(block, self._as_value, negate=True)

    def _column(self, name: str) -> Column:
        return F.col(f"`{name}`") if name in self.columns else F.lit(None).cast("boolean")

    def _as_known(self, column: Column) -> Column:
        """Every known value counts as true."""
        return F.when(column.isNotNull(), True)

    def _as_value(self, column: Column) -> Column:
        """A missing value counts as false."""
        return F.coalesce(column, F.lit(False))

    def _block(self, block: str, read: Callable[[Column], Column], negate: bool) -> Column:
        def category(name: str) -> Column:
            """OR over all synonyms; no synonym at all means no data."""
            members = [
                member
                for term in self.rule.categories.get(name, ())
                for member in self.rule.terms.get(term, (term,))
            ]
            found = [read(self._column(m)) for m in members]
            return reduce(or_, found) if found else read(F.lit(None).cast("boolean"))

        return _bind(self.rule.blocks[block], category, negate)

    def available(self, node: Node) -> Column:
        """Is there enough data? NOT is dropped here."""
        return _bind(node, lambda b: F.col(_asked(b)), negate=False).isNotNull()

    def label(self, node: Node) -> Column:
        """Outcome of the rule; null where data are not enough."""
        return F.when(self.available(node), _bind(node, lambda b: F.col(_value(b)), negate=True))


def _asked(block: str) -> str:
    return f"_asked_{block}"


def _value(block: str) -> str:
    return f"_value_{block}"


def global_label(labels: Sequence[Column]) -> Column:
    """True if any label is true, null if all are null."""
    return labels[0] if len(labels) == 1 else F.greatest(*labels)


def _availability_columns(count: int) -> list[Column]:
    each = [F.col(f"rule_{i}_availability") for i in range(1, count + 1)]
    return [
        *each,
        reduce(or_, each).alias("minimal_global_availability"),
        reduce(and_, each).alias("strict_global_availability"),
    ]


def rule_availability(matrix: DataFrame, rule: Rule) -> DataFrame:
    """Availability of every alternative, of any (minimal) and of all (strict)."""
    bound = BoundRule(rule, matrix)
    each = bound.blocks.select(*bound.keys, *[
        bound.available(a).alias(f"rule_{i}_availability")
        for i, a in enumerate(rule.alternatives, 1)
    ])
    return each.select(*bound.keys, *_availability_columns(len(rule.alternatives)))


def rule_labels(matrix: DataFrame, rule: Rule) -> DataFrame:
    """Availability and label of every alternative, and the global label."""
    bound = BoundRule(rule, matrix)
    numbered = list(enumerate(rule.alternatives, 1))
    each = bound.blocks.select(
        *bound.keys,
        *[bound.available(a).alias(f"rule_{i}_availability") for i, a in numbered],
        *[bound.label(a).alias(f"rule_{i}_label") for i, a in numbered],
    )
    labels = [F.col(f"rule_{i}_label") for i, _ in numbered]
    return each.select(
        *bound.keys, *_availability_columns(len(numbered)), *labels,
        global_label(labels).alias("global_label"),
    )


def block_availability(matrix: DataFrame, rule: Rule) -> DataFrame:
    bound = BoundRule(rule, matrix)
    return bound.blocks.select(
        *bound.keys, *[bound.available(b).alias(f"{b}_availability") for b in rule.blocks]
    )


def block_labels(matrix: DataFrame, rule: Rule) -> DataFrame:
    """Availability and label of every block; there is no global label at this level."""
    bound = BoundRule(rule, matrix)
    return bound.blocks.select(
        *bound.keys,
        *[bound.available(b).alias(f"{b}_availability") for b in rule.blocks],
        *[bound.label(b).alias(f"{b}_label") for b in rule.blocks],
    )


def labels(matrix: DataFrame, rule: Rule, level: str = "rule") -> DataFrame:
    if level == "rule":
        return rule_labels(matrix, rule)
    if level == "algorithm_block":
        return block_labels(matrix, rule)
    raise ValueError(f"unknown level: {level}")


class BoundRules:
    """The rules of several algorithms over one matrix: the row's algorithm chooses its rule.

    Blocks of one name share a column, so a row evaluates the blocks of its own rule only.
    """

    def __init__(self, rules: Mapping[str, Rule], matrix: DataFrame):
        self.bound = {name: BoundRule(rule, matrix) for name, rule in rules.items()}
        self.keys = cohort_keys(matrix)
        self.names = list(dict.fromkeys(b for rule in rules.values() for b in rule.blocks))
        self.most = max(len(rule.alternatives) for rule in rules.values())
        self.blocks = matrix.select(
            *self.keys,
            *[self._of_block(b, lambda r, b: r.asked(b)).alias(_asked(b)) for b in self.names],
            *[self._of_block(b, lambda r, b: r.value(b)).alias(_value(b)) for b in self.names],
        )

    def _of_block(self, block: str, make: Callable[[BoundRule, str], Column]) -> Column:
        return by_algorithm({n: make(r, block) for n, r in self.bound.items() if block in r.rule.blocks})

    def _of_alternative(self, i: int, make: Callable[[BoundRule, Node], Column]) -> Column:
        return by_algorithm({
            n: make(r, r.rule.alternatives[i]) for n, r in self.bound.items() if i < len(r.rule.alternatives)
        })

    def _over_own(self, combine: Callable[[list[Column]], Column], column: str) -> Column:
        """``combine`` of the columns that the row's own alternatives have."""
        return by_algorithm({
            n: combine([F.col(column.format(i)) for i in range(1, len(r.rule.alternatives) + 1)])
            for n, r in self.bound.items()
        })

    def rule_labels(self) -> DataFrame:
        """Columns as in ``rule_labels``; alternatives beyond a rule's own are null."""
        numbers = range(self.most)
        each = self.blocks.select(
            *self.keys,
            *[self._of_alternative(i, BoundRule.available).alias(f"rule_{i + 1}_availability") for i in numbers],
            *[self._of_alternative(i, BoundRule.label).alias(f"rule_{i + 1}_label") for i in numbers],
        )
        availability, label = "rule_{}_availability", "rule_{}_label"
        return each.select(
            *self.keys, *[availability.format(i + 1) for i in numbers],
            self._over_own(lambda cs: reduce(or_, cs), availability).alias("minimal_global_availability"),
            self._over_own(lambda cs: reduce(and_, cs), availability).alias("strict_global_availability"),
            *[label.format(i + 1) for i in numbers],
            self._over_own(global_label, label).alias("global_label"),
        )

    def block_labels(self) -> DataFrame:
        return self.blocks.select(
            *self.keys,
            *[self._of_block(b, BoundRule.available).alias(f"{b}_availability") for b in self.names],
            *[self._of_block(b, BoundRule.label).alias(f"{b}_label") for b in self.names],
        )


def labels_by_algorithm(matrix: DataFrame, rules: Mapping[str, Rule], level: str = "rule") -> DataFrame:
    """Labels of a matrix with the rows of several algorithms, in one pass."""
    if level not in ("rule", "algorithm_block"):
        raise ValueError(f"unknown level: {level}")
    bound = BoundRules(rules, matrix)
    return bound.rule_labels() if level == "rule" else bound.block_labels()


def flagged_cohort(cohort: DataFrame, labelled: DataFrame) -> DataFrame:
    """Cohort rows whose global label is true."""
    keys = cohort_keys(labelled)
    return cohort.join(labelled.filter(F.col("global_label")).select(*keys), keys, "left_semi")


def all_flagged(cohorts: Mapping[str, DataFrame], labelled: Mapping[str, DataFrame]) -> DataFrame:
    """Flagged rows of all cohorts on their common columns, tagged with the cohort."""
    flagged = {name: flagged_cohort(df, labelled[name]) for name, df in cohorts.items()}
    first = next(iter(flagged.values()))
    common = [c for c in first.columns if all(c in df.columns for df in flagged.values())]
    return tag_cohorts(flagged, common)


def patient_ids(df: DataFrame) -> DataFrame:
    return df.select(PATIENT_ID).distinct()
