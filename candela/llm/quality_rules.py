"""Quality rules: decision lists learnt by sequential covering, applied as ordered Spark conditions.

Statistics of whole texts come from one pass over the documents. Labelled statistics (a bounded sample:
``MAX_LABELLED`` rows with the smallest hash of id and statistics) teach the list: a rule for low quality grows by the threshold
with the largest information gain on two thirds of the rows, is pruned from its end on the last third, and is kept
while it is right there; rows it covers leave, and the next rule grows. The list becomes one ``when`` chain, first
fitting rule first; what no rule covers is kept.

Words are runs without ASCII white space, lines are split at \\n. A duplicate line has a word and equals an earlier
line. A word is repeated if it lies in a three-word window found twice or more in its text.

Defined cases. Null or empty text: all statistics zero (ratios zero). Null labels or ids and labels without a document
teach nothing; a document with several labels counts as low quality if any says so. Labels of one class only, or
none: an empty list, everything is kept by it. Null ids and repeated rows stay rows. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pick, stored, texts_of

MAX_LABELLED = 20_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_digits")
SYMBOLS = b"#*$%&|<>"
_KEEP_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_KEEP_LOWER = bytes(c for c in range(256) if not 97 <= c <= 122)
_KEEP_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_KEEP_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)
_CONTINUED = bytes(range(0x80, 0xC0))
_WORD = re.compile(rb"[^\x20\x09-\x0D]")

#: Ratios that rules test, as (numerator, denominator).
FEATURES = {"n_words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
            "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "n_letters"),
            "marks_per_word": ("n_marks", "n_words"), "digits_per_word": ("n_digits", "n_words")}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    n, end = 0, 0  # words before end are counted
    for i, w in enumerate(windows):
        if count[w] > 1:
            n += i + 3 - max(i, end)
            end = i + 3
    return n


def text_statistics(text: bytes) -> tuple[int, ...]:
    """The statistics ``COUNTS`` of one text (UTF-8)."""
    words = text.split()
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    dup = filled = 0
    for line in lines:
        if _WORD.search(line):
            filled += 1
            dup += line in seen
        seen.add(line)
    joined = b"".join(words)
    upper, lower = len(text.translate(None, _KEEP_UPPER)), len(text.translate(None, _KEEP_LOWER))
    return (len(words), len(joined.translate(None, _CONTINUED)), len(text.translate(None, _KEEP_SYMBOL)), dup, repeated_words(words), filled,
            upper, upper + lower, text.count(b"!"), len(text.translate(None, _KEEP_DIGIT)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``COUNTS``."""

    def run(batches):
        for batch in batches:
            got = np.array([text_statistics(t) for t in texts_of(batch.column(1))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(got[:, j]) for j in range(len(COUNTS)))], names=[id_col, *COUNTS])

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(run, f"{id_col} long, " + ", ".join(f"{c} long" for c in COUNTS))


def feature(name: str) -> Column:
    top, bottom = FEATURES[name]
    value = F.col(top).cast("double")
    return value if bottom is None else F.when(F.col(bottom) > 0, value / F.col(bottom)).otherwise(0.0)


@dataclass(frozen=True)
class Rule:
    """A conjunction of thresholds (feature, above, value): above means feature > value, else feature <= value."""

    tests: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, above, value in self.tests:
            out &= x[name] > value if above else x[name] <= value
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, value in self.tests:
            out = out & (feature(name) > value if above else feature(name) <= value)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {v:.6g}" for n, a, v in self.tests)


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """Information gain of a test that leaves p bad and n good of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_tests: int) -> Rule:
    tests, live = [], np.ones(len(bad), bool)
    while len(tests) < max_tests and bad[live].any() and not bad[live].all():
        best = (1e-9, None)
        for name, value in x.items():
            v, b = value[live], bad[live]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            cut = np.flatnonzero(v[1:] > v[:-1])  # a threshold between two values that differ
            if not len(cut):
                continue
            p, total = np.cumsum(b), int(b.sum())
            left_p, left = p[cut], cut + 1
            for above, pos, neg in ((False, left_p, left - left_p), (True, total - left_p, len(b) - left - (total - left_p))):
                gain = _gain(pos, neg, total, len(b) - total)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
        if best[1] is None:
            break
        tests.append(best[1])
        live &= Rule((best[1],)).covers(x)
    return Rule(tuple(tests))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule with the best (right - wrong) / covered on these rows."""
    def worth(k: int) -> float:
        c = Rule(rule.tests[:k]).covers(x)
        return (2.0 * bad[c].sum() - c.sum()) / max(1, c.sum())

    return Rule(rule.tests[: max(range(1, len(rule.tests) + 1), key=lambda k: (worth(k), -k))]) if rule.tests else rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, h: np.ndarray, precision: float = 0.8, min_covered: int = 3, max_rules: int = 12, max_tests: int = 3) -> list[Rule]:
    """Ordered rules for bad rows; ``h`` deals rows to growing (two thirds) and pruning."""
    rules, live = [], np.ones(len(bad), bool)
    prune = h % 3 == 0

    def part(rows):
        return {k: v[rows] for k, v in x.items()}, bad[rows]

    while len(rules) < max_rules:
        if not bad[live & ~prune].any() or not (live & prune).any():
            break
        rule = _grow(*part(live & ~prune), max_tests)
        if not rule.tests:
            break
        rule = _prune(rule, *part(live & prune))
        hit = rule.covers(x) & live
        checked = hit & prune
        if hit.sum() < min_covered or bad[hit].mean() < precision or not checked.any() or bad[checked].mean() < precision:
            break
        rules.append(rule)
        live &= ~hit
    return rules


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules from the statistics of labelled rows (quality 0 is bad)."""
    labels = pick(labels, **{id_col: "long", label_col: "int"}).toDF("id", "y").dropna().groupBy("id").agg(F.min("y").alias("y"))
    cols = [feature(n).alias(f"f_{n}") for n in FEATURES]
    # a repeated document teaches once; of the rows the smallest hashes: at most max_labelled, however many an id has
    rows = stats.join(labels, stats[id_col] == labels["id"]).select("id", "y", *cols).distinct()
    few = rows.withColumn("_place", F.xxhash64("id", F.lit(17), *[c for c in rows.columns if c.startswith("f_")])).orderBy("_place", "id").limit(max_labelled)
    rows = few.withColumn("h", F.xxhash64("id", F.lit(29))).drop("id", "_place").toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("h", *rows.column_names[:-1])])
    if not rows.num_rows:
        return []
    x = {n: rows.column(f"f_{n}").to_numpy() for n in FEATURES}
    return learn(x, rows.column("y").to_numpy() == 0, rows.column("h").to_numpy())


def condition(rules: list[Rule]) -> Column:
    """Is the row kept: the first rule that covers it says no."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), False) if out is None else out.when(rule.column(), False)
    return F.lit(True) if out is None else out.otherwise(True)


def rule_number(rules: list[Rule]) -> Column:
    """Which rule decides (from 1), null if none."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        out = F.when(rules[i].column(), i + 1).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row: id, the statistics, ``rule`` (the rule that rejects it, or null) and ``good``."""
    stats = stored(statistics(docs, id_col, text_col), "statistics")
    rules = fit(stats, labels, id_col, label_col)
    return stats.withColumn("rule", rule_number(rules)).withColumn("good", condition(rules))
