"""Quality rules: a learned decision list over counts of each text.

Counts are taken over whole texts.  Rules are conjunctions of thresholds on ratios of these counts, learned from
labelled documents by sequential covering: a rule is grown condition by condition on two thirds of
the labelled rows, pruned on the last third, and kept only if it is precise there; what it
covers is set aside and the next rule is sought.  The list becomes one ordered ``CASE WHEN`` expression of
Spark, so it can be read, stored and applied without the labels.

The fit sees at most ``max_rows`` labelled documents, those with the smallest hash of their id, and one row of each: of
several texts with one id that with the least ratios.  Everything else covers all data.

Defined results: a null or empty text has no words and fails the base rule; null labels and labels without a
document are passed over; of several labels of a document the lowest counts; without usable labels the list is
empty and the base rule decides alone; repeated rows are judged alike.  The columns ``counts``, ``base_failed``, ``rule`` and ``kept``
replace those of these names; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.words import chunks

MAX_ROWS = 20_000
MIN_PRECISION = 0.95
MIN_COVERED = 5
MAX_RULES, MAX_CONDITIONS, CUTS = 16, 4, 64
MIN_WORDS, MAX_REPEATED = 50, 50  # of the base rule: words, per cent

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_digits",
)
#: Ratios the rules may use: (count, per).  None of them tells languages or lengths of texts apart.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"), "capital_share": ("n_capitals", "word_chars"), "mark_share": ("n_marks", "word_chars"),
    "digit_share": ("n_digits", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
}


def _of(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOLS, _MARKS, _DIGITS = _of("#*$%&|<>"), _of("!?;:=_~^@{}[]\\/"), _of("0123456789")
_CAPITALS, _SPACES = _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of(" \t\n\v\f\r")


def _counts(texts: pa.Array) -> pa.Array:
    out: dict[str, list[int]] = {c: [] for c in COUNTS}
    for chunk in chunks(texts):
        data, offsets = chunk.data, chunk.offsets
        words = chunk.words()

        def per_text(marked: np.ndarray) -> list[int]:
            sums = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
            return np.diff(sums[offsets]).tolist()

        hashes = words.hashes()
        starts, runs = words.runs(hashes, 3)
        owner = words.text_of()[starts]
        order = np.lexsort((runs, owner))
        twin = (runs[order][1:] == runs[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        again = np.zeros(len(starts), bool)
        again[order[1:][twin]] = again[order[:-1][twin]] = True
        repeated = np.zeros(len(words) + 3, bool)
        for k in range(3):
            repeated[starts[again] + k] = True
        begins = (data & 0xC0) != 0x80
        sums = np.concatenate(([0], np.cumsum(repeated[: len(words)], dtype=np.int64)))
        out["n_words"] += words.counts.tolist()
        out["word_chars"] += per_text(begins & ~_SPACES[data])
        out["n_symbols"] += per_text(_SYMBOLS[data])
        out["n_capitals"] += per_text(_CAPITALS[data])
        out["n_marks"] += per_text(_MARKS[data])
        out["n_digits"] += per_text(_DIGITS[data])
        out["n_repeat_words"] += np.diff(sums[words.first]).tolist()
        for d in range(len(chunk)):
            lines = data[offsets[d] : offsets[d + 1]].tobytes().split(b"\n")
            worded = [x for x in lines if x.strip()]
            out["n_lines"].append(len(lines))
            out["n_dup_lines"].append(len(worded) - len(set(worded)))
    return pa.StructArray.from_arrays([pa.array(out[c], pa.int64()) for c in COUNTS], list(COUNTS))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``counts``: a struct of :data:`COUNTS` for each text."""
    count = F.arrow_udf(_counts, "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">").asNondeterministic()
    return docs.withColumn("counts", count(F.col(text)))


def ratio(name: str) -> Column:
    """A ratio of the ``counts`` struct; 0 where there is nothing to divide by."""
    top, bottom = RATIOS[name]
    return F.col(f"counts.{top}") / F.greatest(F.col(f"counts.{bottom}"), F.lit(1))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def test(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.threshold if self.above else values[self.name] <= self.threshold

    def column(self) -> Column:
        return ratio(self.name) > F.lit(self.threshold) if self.above else ratio(self.name) <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.test(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition of the highest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, best_gain = None, 1e-9
        for name, column in values.items():
            own = column[inside]
            levels = np.unique(own)
            cuts = np.unique(np.quantile((levels[1:] + levels[:-1]) / 2, np.linspace(0, 1, CUTS))) if len(levels) > 1 else []
            own_bad = bad[inside]
            for cut in cuts:
                for above in (True, False):
                    hit = own > cut if above else own <= cut
                    p, n = (hit & own_bad).sum(), (hit & ~own_bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule += (best,)
        inside &= best.test(values)
    tightest = {(c.name, c.above): c for c in rule}  # of two thresholds on one side the later one is tighter
    return tuple(tightest.values())


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The leading conditions with the best balance of bad over good rows; ties keep fewer good rows."""
    def worth(r: Rule) -> tuple[float, int]:
        inside = _covers(r, values, len(bad))
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / max(p + n, 1), len(r)

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)


def learn(values: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Rules that reject, in order.  ``order`` deals rows to growing (two thirds) and pruning (one third)."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    seeds = bad & (order % 3 > 0)  # bad rows that still want a rule
    growing = order % 3 > 0
    while len(rules) < MAX_RULES and (seeds & left).sum() >= MIN_COVERED:
        grow, prune = left & growing & (seeds | ~bad), left & ~growing
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        hit = _covers(rule, values, len(bad)) & left
        held = hit & ~growing
        precise = (held & bad).sum() >= min_precision * held.sum() and (hit & bad).sum() >= min_precision * hit.sum()
        if precise and (held & bad).any() and (hit & bad).sum() >= MIN_COVERED:
            rules.append(rule)
            left &= ~hit
        elif (hit & seeds).any():
            seeds &= ~hit  # no rule for these; others may still be found
        else:
            break
    return rules


def rejects(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the number of the first rule that holds, else null."""
    found = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        test = rules[k][0].column()
        for condition in rules[k][1:]:
            test = test & condition.column()
        found = F.when(test, F.lit(k + 1)).otherwise(found)
    return found


def base_fails() -> Column:
    """Too few words, or too many of them in repeated runs of three."""
    words, repeated = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> list[Rule]:
    """Learns a list for what the base rule lets pass, from at most ``max_rows`` labelled documents; label 0 is bad, anything else good."""
    usable = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_label"))
    some = usable.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(max_rows)
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id")
    counted = with_counts(known, "_text").where(~base_fails())
    least = F.min(F.struct("_label", "_order", *[ratio(r).alias(r) for r in RATIOS])).alias("_least")  # of texts with one id
    rows = counted.groupBy("_id").agg(least).select("_id", "_least.*").toPandas().sort_values(["_order", "_id"])
    if rows.empty:
        return []
    values = {r: rows[r].to_numpy(np.float64) for r in RATIOS}
    return learn(values, rows["_label"].to_numpy() == 0, np.arange(len(rows)))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Adds ``counts``, ``base_failed``, ``rule`` (number of the rule that rejects, null if none) and ``kept``."""
    judged = with_counts(docs, text).withColumn("base_failed", base_fails()).withColumn("rule", rejects(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = judge(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return judged.select("doc_id", *[f"counts.{c}" for c in COUNTS[:5]], "base_failed", "kept", "rule")
