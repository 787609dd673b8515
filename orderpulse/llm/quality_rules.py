"""Quality rules: a decision list learned by sequential covering, applied as ordered Spark conditions.

Statistics of every whole text are computed once.  Labelled documents (at most ``LABELLED`` of them, those with the
lowest hash of their id) teach the list: a rule for bad documents is grown condition by condition, each "statistic at
most / at least a threshold" with the best information gain on two thirds of the rows, pruned from its end on the other
third, and kept while it is right often enough on both; the documents it covers leave, and the next rule is grown.  What
no rule covers is kept.  The rules become one ``CASE WHEN`` in the order in which they were learned.

Edge cases: a missing text has no words and fails the base rule; a missing label or id teaches nothing; labels given
twice count as bad if their mean is below one half; without bad or good rows the list is empty; repeated rows are judged
one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.sources.staging import stage

#: Bound on the labelled documents that teach.
LABELLED = 30_000
#: Thresholds tried per statistic, conditions in a rule, rules in a list.
THRESHOLDS, LONGEST, MOST_RULES = 64, 4, 12
#: Share of bad documents among those that a rule covers, on growing and on pruning rows; bad rows it must cover at least.
PRECISION, SUPPORT = 0.95, 8

# fixed values: symbols and white space of the base rule
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_other", "n_distinct")
#: Statistics that rules may use, as ratios of the counts.
STATISTICS = {
    "n_words": "n_words",
    "word_size": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "other_share": "n_other / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


def _classes(*kinds: bytes) -> list[np.ndarray]:
    return [np.array([c in kind for c in range(256)]) for kind in kinds]


_SYMBOL, _SPACE, _UPPER, _DIGIT, _LOWER = _classes(
    SYMBOLS, SPACES, bytes(range(65, 91)), bytes(range(48, 58)), bytes(range(97, 123))
)
_CONTINUED = np.array([0x80 <= c < 0xC0 for c in range(256)])
_OTHER = ~(_SYMBOL | _SPACE | _UPPER | _DIGIT | _LOWER) & (np.arange(256) < 128)


def repeated_words(words: Sequence[bytes], size: int = 3) -> int:
    """Words in a window of ``size`` that is found twice or more, its first place included."""
    windows = list(zip(*[words[i:] for i in range(size)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.array([i for i, w in enumerate(windows) if count[w] > 1])
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + size, -1)
    return int((np.cumsum(marks) > 0).sum())


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    text = text or b""
    words = text.split()  # cuts at 0x20 and 0x09-0x0D
    held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        int(len(text) - held[_SPACE].sum() - held[_CONTINUED].sum()),
        int(held[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(held[_UPPER].sum()),
        int(held[_DIGIT].sum()),
        int(held[_OTHER].sum()),
        len(set(words)),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = np.array([text_counts(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(table[:, i]) for i in range(len(COUNTS))]], ["doc_id", *COUNTS]
        )


def document_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per document."""
    schema = ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS]])
    return docs.select(F.col(key).cast("long"), F.col(text).cast("binary")).mapInArrow(_counted, schema)


# --- learning --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.statistic]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value >= self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<='} {self.threshold:.6g}"


def _covered(rule: Sequence[Condition], table: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _gain(bad: np.ndarray, good: np.ndarray, bad_before: int, good_before: int) -> np.ndarray:
    """Information gained about badness, times the bad rows that stay."""
    before = np.log2(bad_before / (bad_before + good_before))
    return np.where(bad > 0, bad * (np.log2(np.maximum(bad, 1) / np.maximum(bad + good, 1)) - before), -np.inf)


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    best: tuple[float, Condition | None] = (0.0, None)
    n_bad, n_good = int((inside & bad).sum()), int((inside & ~bad).sum())
    for name, values in table.items():
        own, kind = values[inside], bad[inside]
        cuts = np.unique(np.quantile(own[kind], np.linspace(0, 1, THRESHOLDS)))
        for above in (True, False):
            side = own[:, None] >= cuts if above else own[:, None] <= cuts
            gains = _gain((side & kind[:, None]).sum(axis=0), (side & ~kind[:, None]).sum(axis=0), n_bad, n_good)
            at = int(gains.argmax())
            if gains[at] > best[0] + 1e-9:
                best = (float(gains[at]), Condition(name, above, float(cuts[at])))
    return best


def _precision(rule: Sequence[Condition], table: dict[str, np.ndarray], bad: np.ndarray) -> float:
    covered = _covered(rule, table, len(bad))
    # one good row more than seen: a rule that covers little is not trusted
    return float((covered & bad).sum() / (covered.sum() + 1))


def learn(table: dict[str, np.ndarray], bad: np.ndarray, seed: int = 5) -> list[list[Condition]]:
    """The ordered rules for bad rows."""
    rng = np.random.default_rng(seed)
    grows = rng.random(len(bad)) < 2 / 3
    rest = np.ones(len(bad), bool)
    rules: list[list[Condition]] = []
    part = lambda where: ({k: v[where] for k, v in table.items()}, bad[where])
    while len(rules) < MOST_RULES:
        grow, kind = part(rest & grows)
        prune, prune_kind = part(rest & ~grows)
        if not kind.any() or not (~kind).any():
            break
        rule: list[Condition] = []
        inside = np.ones(len(kind), bool)
        while len(rule) < LONGEST and (inside & ~kind).any():
            _, condition = _best_condition(grow, kind, inside)
            if condition is None:
                break
            rule.append(condition)
            inside &= condition.holds(grow)
        # a shorter rule that is as right on rows it has not seen is preferred
        while len(rule) > 1 and _precision(rule[:-1], prune, prune_kind) >= _precision(rule, prune, prune_kind):
            rule.pop()
        hit = _covered(rule, grow, len(kind)) if rule else np.zeros(len(kind), bool)
        unseen = _covered(rule, prune, len(prune_kind)) if rule else np.zeros(len(prune_kind), bool)
        right = hit.any() and kind[hit].mean() >= PRECISION and unseen.any() and prune_kind[unseen].mean() >= PRECISION
        if not right or (hit & kind).sum() < SUPPORT:
            break
        rules.append(rule)
        rest &= ~_covered(rule, table, len(bad))
    return rules


def training_rows(counts: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and badness of at most ``LABELLED`` labelled documents."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    picked = told.agg((F.avg(label) < 0.5).alias("bad")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    rows = (
        counts.join(picked, "doc_id")
        .select("doc_id", "bad", *[F.expr(e).cast("double").alias(n) for n, e in STATISTICS.items()])
        .dropDuplicates(["doc_id"])
        .orderBy("doc_id")
        .toPandas()
    )
    return {n: rows[n].to_numpy(float) for n in STATISTICS}, rows["bad"].to_numpy(bool)


def verdict(rules: Sequence[Sequence[Condition]]) -> Column:
    """The number of the first rule that a row meets, null if none: one ordered condition."""
    out = F.when(F.lit(False), F.lit(0))
    for number, rule in enumerate(rules):
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column()
        out = out.when(met, F.lit(number))
    return out


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    counts = stage(document_counts(docs), "counts")
    rules = learn(*training_rows(counts, labels))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counts.withColumns({"base_failed": failed, "rule": verdict(rules)})
    return judged.select(
        "doc_id",
        *COUNTS[:5],
        "base_failed",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"),
        "rule",
    )
