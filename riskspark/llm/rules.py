"""Quality rules learned as an ordered decision list over text statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import hashed_sample, small_batches, stored, table, utf8

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?.,;:"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_bytes", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words")
STATISTICS = BASE + EXTRA
#: What conditions may test: ratios of the statistics, so that they do not depend on a text's length.
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "upper_per_byte": ("n_upper", "n_bytes"),
    "digits_per_byte": ("n_digits", "n_bytes"),
    "marks_per_word": ("n_marks", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeats_per_word": ("n_repeat_words", "n_words"),
    "distinct_per_word": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
#: Labelled rows used at most, chosen by a hash of the id.
EXAMPLES = 40_000
#: Thresholds tried for each ratio, at quantiles of its values.
CUTS = 64
CONDITIONS = 4
RULES = 16
#: A rule is kept if so many of the pruning rows it covers are truly bad.
PRECISION = 0.9
SUPPORT = 5


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that is found at least twice in the list."""
    n = len(words)
    if n < 4:
        return 0
    index = dict(zip(words, range(n)))
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    keys = ids[:-2] * n + ids[1:-1]
    if n >= 1 << 20:
        # The product of three would leave 63 bits: number the pairs first.
        keys = np.unique(keys, return_inverse=True)[1]
    keys = keys * n + ids[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``STATISTICS`` for one text; null counts as empty."""
    text = text or ""
    raw = utf8(text)
    words = raw.split()
    lines = text.split("\n")
    seen: set[str] = set()
    doubled = 0
    for line in lines:
        if line.strip(_BLANKS):
            doubled += line in seen
            seen.add(line)
    n = len(raw)
    return (
        len(words),
        len(text) - sum(map(text.count, _BLANKS)),
        sum(map(text.count, SYMBOLS)),
        doubled,
        repeated_words(words),
        n,
        len(lines),
        n - len(raw.translate(None, _UPPER)),
        n - len(raw.translate(None, _DIGITS)),
        n - len(raw.translate(None, _MARKS)),
        len(set(words)),
    )


def statistics(text: Column) -> Column:
    """A struct of the whole text's ``STATISTICS``, all long."""

    @F.pandas_udf(", ".join(f"{name} long" for name in STATISTICS))
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = np.array([statistics_of(t) for t in texts], np.int64).reshape(-1, len(STATISTICS))
        return pd.DataFrame(rows, columns=list(STATISTICS))

    return of(text)


def ratios() -> dict[str, Column]:
    return {
        name: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
        for name, (a, b) in RATIOS.items()
    }


@dataclass(frozen=True)
class Condition:
    """``ratio > cut`` or ``ratio <= cut``."""

    ratio: str
    above: bool
    cut: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.ratio].to_numpy()
        return values > self.cut if self.above else values <= self.cut

    def column(self) -> Column:
        ratio = ratios()[self.ratio]
        return ratio > self.cut if self.above else ratio <= self.cut


Rule = tuple[Condition, ...]


def covered(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    mask = np.ones(len(rows), bool)
    for condition in rule:
        mask &= condition.holds(rows)
    return mask


def _grow(rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Add the condition of greatest information gain until only bad rows are covered."""
    rule: Rule = ()
    mask = np.ones(len(rows), bool)
    while len(rule) < CONDITIONS:
        p, n = int((mask & bad).sum()), int((mask & ~bad).sum())
        if not p or not n:
            break
        before, best, gain = np.log2(p / (p + n)), None, 1e-9
        for ratio in RATIOS:
            values, truth = rows[ratio].to_numpy()[mask], bad[mask]
            order = np.argsort(values, kind="stable")
            values, truth = values[order], truth[order]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1), method="lower"))[:-1]
            upto = np.searchsorted(values, cuts, side="right")
            low_p = np.concatenate(([0], np.cumsum(truth)))[upto]
            low_n = upto - low_p
            for above, ps, ns in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), 0)
                k = int(np.argmax(gains)) if len(gains) else -1
                if k >= 0 and gains[k] > gain:
                    gain, best = float(gains[k]), (ratio, above, k, values, upto)
        if best is None:
            break
        ratio, above, k, values, upto = best
        # The cut lies midway to the next value, so both engines and later rows agree on it.
        cut = float((values[upto[k] - 1] + values[upto[k]]) / 2)
        rule += (Condition(ratio, above, cut),)
        mask &= rule[-1].holds(rows)
    return rule


def _prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Drop last conditions while the rule does better on rows it was not grown on."""

    def worth(r: Rule) -> float:
        mask = covered(r, rows)
        p, n = (mask & bad).sum(), (mask & ~bad).sum()
        return (p - 2 * n) / (p + n + 1)

    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(heads, key=lambda r: (worth(r), -len(r)), default=())


def learn_rules(examples: pd.DataFrame) -> list[Rule]:
    """Sequential covering of the rows with label 0 by threshold conjunctions.

    ``examples`` has the ratios and ``label``. Two of three rows grow rules and the third prunes
    them. What a rule covers is taken out before the next is learned; learning ends when a rule is not
    precise enough or covers too little. No bad rows give no rules.
    """
    rules: list[Rule] = []
    bad = examples["label"].to_numpy() == 0
    part = np.arange(len(examples)) % 3 == 2
    left = np.ones(len(examples), bool)
    while len(rules) < RULES and (left & bad).any():
        growing, pruning = left & ~part, left & part
        rule = _prune(_grow(examples[growing], bad[growing]), examples[pruning], bad[pruning])
        if not rule:
            break
        mask = covered(rule, examples) & left
        held = mask & part
        hits = int((held & bad).sum())
        if hits < SUPPORT or hits < PRECISION * int(held.sum()):
            break
        rules.append(rule)
        left &= ~mask
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: the number of the first rule that holds, else 0."""
    chain = None
    for number, rule in enumerate(rules, 1):
        test = rule[0].column()
        for condition in rule[1:]:
            test &= condition.column()
        chain = F.when(test, number) if chain is None else chain.when(test, number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> tuple[DataFrame, list[Rule]]:
    """``id``, ``STATISTICS``, ``base_failed``, ``rule`` and ``kept`` of every row, and the learned list.

    ``rule`` is the number of the rule that rejects the text, 0 if none does. Rules are learned from at
    most ``EXAMPLES`` labelled rows that pass the base limits, chosen by a hash of the id; statistics
    are of all rows and whole texts. Null and empty texts have no words and fail the base
    limits; repeated rows are kept; labels other than 0 and 1 are passed over, repeated labels
    count as their least; without labels only the base limits reject. Empty tables give empty ones.
    """
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(id).alias("__id"), statistics(F.col(text)).alias("s"))
    counted = stored(counted.select("__id", "s.*"), "text-statistics")
    one = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col(id).alias("__id"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    order = F.xxhash64(F.col("__id").cast("string"), F.lit("rules"))
    labelled = stored(
        counted.where(~base_failed())
        .join(one, "__id")
        .select(order.alias("o"), "label", *[c.alias(n) for n, c in ratios().items()]),
        "labelled-statistics",
    )
    examples = hashed_sample(labelled, F.col("o"), EXAMPLES, "label", *RATIOS).toPandas()
    rules = learn_rules(examples)
    rule = F.when(base_failed(), 0).otherwise(verdict(rules))
    result = counted.withColumns({"base_failed": base_failed(), "rule": rule})
    result = result.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    return result.withColumnRenamed("__id", id), rules


def op5_decision_list(spark, sf_dir):
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    result, _ = judged(docs, labels)
    return result.select("doc_id", *BASE, "base_failed", "kept")


QUERIES = {"op5_decision_list": op5_decision_list}
ORACLES: dict[str, str] = {}
