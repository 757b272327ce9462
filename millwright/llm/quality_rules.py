"""Quality rules whose cutoffs keep the risk of rejecting a good text below a limit.

Base rules are fixed. Every further rule compares a ratio of counts with a
cutoff that labelled texts select, per stratum (language): a cutoff is
admissible if the exact binomial (Clopper-Pearson) upper bound of the share
of good texts it rejects lies below the limit, at a level divided by the
number of cutoffs tested in all strata and rules (Bonferroni). The limit of a
stratum is divided among its rules, so all rules together respect it. Of the
admissible cutoffs the one that rejects most bad texts is taken, the loosest
of equals; without one the rule rejects nothing in that stratum.

Null and empty texts have no words and fail the base rules. A null stratum is
a stratum of its own. A text counts as good or bad if all its labels that are
not null say so; other labels are ignored. Repeated rows are judged alike; an
empty table gives an empty result.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm import arrays
from millwright.llm.common import bounded_batches, stored, text_struct

LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: tolerated share of good texts rejected per stratum, and the chance that it is exceeded anywhere
RISK = 0.03
LEVEL = 0.05
STEPS = 32
#: strata up to which the table of cutoffs is sent to every task
SENT_STRATA = 10_000

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True



def _rules() -> dict[str, tuple[Column, float]]:
    """Rule -> the ratio that is high in bad texts, and the largest cutoff tried."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": (F.col("n_symbols") / words, 2.0),
        "dup_lines": (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 1.0),
        "repeats": (F.col("n_repeat_words") / words, 0.5),
        "long_words": (F.col("word_chars") / words, 32.0),
    }


def _per_text(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, begins, dtype=np.int64)


def _grouped(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per element: is its (owner, key) found more than once, and is it not the first of them."""
    whole = arrays.mixed(key + arrays.mixed(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(whole, kind="stable")
    same = whole[order][1:] == whole[order][:-1]
    again, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    later[order[1:]] = same
    return again, later


def count_part(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of a few texts laid end to end."""
    data, begins = arrays.laid_out(texts)
    starts, ends = arrays.word_spans(data)
    owner = np.searchsorted(begins, starts, "right") - 1
    size = len(texts)
    covered = np.zeros(len(data) + 1, np.int8)
    covered[starts] += 1
    covered[ends] -= 1
    inside = np.cumsum(covered[:-1], dtype=np.int8).astype(bool)
    characters = inside & ((data & 0xC0) != 0x80)

    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    line_owner = np.searchsorted(begins, line_starts, "right") - 1
    worded = np.zeros(len(line_starts), bool)
    worded[np.searchsorted(line_starts, starts, "right") - 1] = True
    line_starts, line_ends, line_owner = line_starts[worded], line_ends[worded], line_owner[worded]
    _, later = _grouped(line_owner, arrays.span_hashes(data, line_starts, line_ends))

    words = arrays.span_hashes(data, starts, ends)
    repeated = np.zeros(len(words), bool)
    if len(words) > 2:
        first = np.flatnonzero(owner[2:] == owner[:-2])
        three = arrays.mixed(arrays.mixed(words[first] + np.uint64(1)) + words[first + 1])
        three = arrays.mixed(three + words[first + 2])
        again, _ = _grouped(owner[first], three)
        for shift in range(3):
            repeated[first[again] + shift] = True
    return {
        "n_words": np.bincount(owner, minlength=size),
        "word_chars": _per_text(characters, begins),
        "n_symbols": _per_text(_SYMBOLS[data], begins),
        "n_dup_lines": np.bincount(line_owner[later], minlength=size),
        "n_repeat_words": np.bincount(owner[repeated], minlength=size),
        "n_lines": np.bincount(line_owner, minlength=size),
    }


def _counter():
    def work(texts: list[bytes]) -> dict[str, np.ndarray]:
        found = [count_part(part) for part in arrays.parts(texts)]
        return {name: np.concatenate([f[name] for f in found]) for name in found[0]} if found else {}

    return work


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``counts`` of what the rules look at."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn("counts", text_struct(_counter, COUNTS)(text_col))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
    value = d
    for m in range(1, 100_000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + term * d or tiny)
            c = 1.0 + term / c or tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-12:
            break
    return value


def binomial_tail(k: int, n: int, p: float) -> float:
    """The exact probability of at most ``k`` hits in ``n`` draws of chance ``p``."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1.0 - p
    scale = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1.0 - x) / b


def cutoffs(labelled: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, cutoff) from rows (stratum, good, counts columns).

    All labelled rows are counted; what leaves the counting is one row per
    stratum, rule and step.
    """
    rules = _rules()
    steps = [
        F.struct(
            F.lit(name).alias("rule"),
            # step s: the ratio exceeds the cutoffs 0 .. s-1 of the rule
            F.least(F.ceil(ratio / top * STEPS), F.lit(STEPS + 1)).cast("int").alias("step"),
        )
        for name, (ratio, top) in rules.items()
    ]
    counted = (
        labelled.select("stratum", "good", F.explode(F.array(*steps)).alias("at"))
        .groupBy("stratum", "at.rule", "at.step")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    whole = Window.partitionBy("stratum", "rule")
    steps_of_each = F.explode(F.sequence(F.lit(0), F.lit(STEPS))).alias("step")
    grid = counted.select("stratum", "rule").distinct().select("stratum", "rule", steps_of_each)
    above = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    full = grid.join(counted, ["stratum", "rule", "step"], "full").fillna(0, ["good", "bad"])
    tested = (
        full.withColumn("false_rejected", F.coalesce(F.sum("good").over(above), F.lit(0)))
        .withColumn("caught", F.coalesce(F.sum("bad").over(above), F.lit(0)))
        .withColumn("n_good", F.sum("good").over(whole))
        .filter(F.col("step") <= STEPS)
    )
    tests = tested.count()
    share, chance = risk / len(rules), level / max(1, tests)

    def admissible(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([n_ > 0 and binomial_tail(int(k_), int(n_), share) <= chance for k_, n_ in zip(k, n)], dtype=bool)

    admissible.__annotations__ = {"k": pd.Series, "n": pd.Series, "return": pd.Series}
    passed = tested.filter(F.pandas_udf(admissible, "boolean")("false_rejected", "n_good") & (F.col("caught") > 0))
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct("caught", "step")).alias("best"))
    top = F.element_at(F.create_map(*[F.lit(x) for name, (_, top) in rules.items() for x in (name, top)]), F.col("rule"))
    return best.select("stratum", "rule", (F.col("best.step") / F.lit(STEPS) * top).alias("cutoff"))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, stratum_col: str = "lang") -> DataFrame:
    """Rows (doc_id, counts, base_failed, kept, failed_rules) of all documents."""
    spark = docs.sparkSession
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col in docs.columns else F.lit("")
    rows = docs.select("doc_id", stratum.alias("stratum"), "text")
    counted = stored(with_counts(rows).select("doc_id", "stratum", "counts.*"), "quality-counts")
    verdicts = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("least"), F.max("quality").alias("most")
    )
    said = verdicts.filter(F.col("least") == F.col("most")).select("doc_id", (F.col("least") > 0).alias("good"))
    limits = stored(cutoffs(counted.join(said, "doc_id"), risk, level), "quality-cutoffs")
    wide = limits.groupBy("stratum").pivot("rule", list(_rules())).agg(F.first("cutoff"))
    if limits.select("stratum").distinct().count() <= SENT_STRATA:
        wide = F.broadcast(wide)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    failed = F.filter(
        F.array(*[F.when(ratio > F.col(name), F.lit(name)) for name, (ratio, _) in _rules().items()]),
        lambda name: name.isNotNull(),
    )
    return (
        counted.join(wide, "stratum", "left")
        .withColumn("base_failed", base)
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: the counts, whether the base rules fail, and the verdict."""
    return judged(docs, labels, **options).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )
