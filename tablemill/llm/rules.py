"""Quality rules: fixed base limits, then a decision list learned from labelled statistics.

Statistics are taken per whole text with numpy. Sequential covering grows a conjunction of thresholds that separates
bad documents from the rest (FOIL's gain on two thirds of the rows), prunes it on the last third, takes the
documents it covers away and goes on. The list becomes one ordered Spark expression over the statistics.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .text import SPACE, buffers, mix, slices, words

# Labelled rows the rules are learned from, at most; the rows with the smallest hash are taken.
TRAIN_ROWS = 20_000
HASHES = 1 << 40

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "log_words", "word_mean", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_share",
    "other_share", "space_share", "distinct_share", "top_word_share", "same_as_last_share", "stopped_line_share", "log_line_mean", "entropy",
)

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_CLASSES = np.zeros((4, 256), dtype=np.int64)
_CLASSES[0, 65:91] = 1
_CLASSES[1, 48:58] = 1
_CLASSES[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_CLASSES[3, 128:] = 1
_BLANKS = b" \t\n\x0b\x0c\r"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE, _LONG = 1 << 20, 1 << 16  # bytes hashed together; words above the second are hashed alone


def _word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of words as they stand, letters' case included."""
    keys = np.zeros(len(starts), dtype=np.uint64)
    lengths = ends - starts
    for i in np.flatnonzero(lengths > _LONG):
        keys[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    short = np.flatnonzero(lengths <= _LONG)
    total = np.concatenate([[0], np.cumsum(lengths[short])])
    powers = np.cumprod(np.full(min(_LONG, int(lengths[short].max(initial=1))), _STEP))
    first = 0
    while first < len(short):
        last = max(first + 1, int(np.searchsorted(total, total[first] + _AT_ONCE, side="right")) - 1)
        part = short[first:last]
        offsets = total[first:last] - total[first]
        place = np.arange(int(total[last] - total[first])) - np.repeat(offsets, lengths[part])
        chars = data[place + np.repeat(starts[part], lengths[part])].astype(np.uint64)
        keys[part] = mix(np.add.reduceat(mix(chars + _STEP) * powers[place], offsets) + lengths[part].astype(np.uint64))
        first = last
    return keys


def _repeated_words(keys: np.ndarray, n: int = 5) -> int:
    """Words in ``n``-word windows that occur twice or more."""
    if len(keys) <= n:
        return 0
    windows = keys[: len(keys) - n + 1].copy()
    for k in range(1, n):
        windows = windows * _STEP + keys[k : len(keys) - n + 1 + k]
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = (times[place] > 1).astype(np.int64)
    edges = np.zeros(len(keys) + 1, dtype=np.int64)
    edges[: len(twice)] += twice
    edges[n : n + len(twice)] -= twice
    return int((np.cumsum(edges) > 0).sum())


def _measure(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[list[int], list[float]]:
    counts = np.bincount(part, minlength=256)
    size, n = max(1, len(part)), max(1, len(starts))
    following = int(counts[128:192].sum())  # bytes that continue a code point; blanks are none
    lines = [line for line in part.tobytes().split(b"\n") if line.strip(_BLANKS)]
    duplicates = len(lines) - len(set(lines))
    word_chars = int(counts[~SPACE].sum()) - following
    symbols, repeats = int(counts[_SYMBOLS].sum()), _repeated_words(keys)
    _, tally = np.unique(keys, return_counts=True)
    stopped = sum(line.rstrip(_BLANKS)[-1:] in (b".", b"!", b"?", b":") for line in lines)
    share = counts[counts > 0] / size
    upper, digit, punct, other = (_CLASSES @ counts / size).tolist()
    shares = [
        np.log1p(len(starts)), word_chars / n, symbols / n, duplicates / max(1, len(lines)), repeats / n,
        upper, digit, punct, other, counts[SPACE].sum() / size,
        len(tally) / n, tally.max(initial=0) / n, (keys[1:] == keys[:-1]).sum() / n,
        stopped / max(1, len(lines)), np.log1p(len(part) / max(1, len(lines))), -(share * np.log(share)).sum(),
    ]
    return [len(starts), word_chars, symbols, duplicates, repeats], [float(s) for s in shares]


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the long columns BASE and the double columns SHARES of each row of ``docs`` (``doc_id, text``).

    Null counts as empty text, and all numbers of an empty text are 0. Texts are read whole, one slice of about
    2 MB (or one longer text) at a time; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            base, shares = [], []
            for first, last in slices(offsets):
                part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                starts, ends, at = words(part, bounds)
                keys = _word_keys(part, starts, ends)
                for lo, hi, a, b in zip(bounds[:-1], bounds[1:], at[:-1], at[1:]):
                    found = _measure(part[lo:hi], starts[a:b], ends[a:b], keys[a:b])
                    base.append(found[0])
                    shares.append(found[1])
            numbers = np.array(base, np.int64).reshape(-1, len(BASE)).T
            measures = np.array(shares, np.float64).reshape(-1, len(SHARES)).T
            columns = [batch.column(0), *(pa.array(c) for c in [*numbers, *measures])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *BASE, *SHARES])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in SHARES])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_most: bool
    value: float

    def __str__(self) -> str:
        return f"{self.statistic} {'<=' if self.at_most else '>'} {self.value!r}"

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values <= self.value if self.at_most else values > self.value

    def column(self) -> Column:
        return F.col(self.statistic) <= self.value if self.at_most else F.col(self.statistic) > self.value


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    found = np.ones(len(x), dtype=bool)
    for condition in rule:
        found &= condition.holds(x[:, names.index(condition.statistic)])
    return found


def _round_between(low: float, high: float) -> float:
    """The value with the fewest digits in ``[low, high)``."""
    for digits in range(1, 17):
        value = float(f"{(low + high) / 2:.{digits}g}")
        if low <= value < high:
            return value
    return low


def best_condition(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> tuple[float, Condition | None]:
    """The threshold with FOIL's largest gain, ``p (log p/(p+n) - log P/(P+N))``; ties go to the first one."""
    all_bad = int(bad.sum())
    best, found = 1e-9, None
    before = np.log2(all_bad / len(bad)) if all_bad else 0.0
    for f, name in enumerate(names):
        order = np.argsort(x[:, f], kind="stable")
        values, seen = x[order, f], np.cumsum(bad[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])
        for at_most in (True, False):
            p = seen[cuts] if at_most else all_bad - seen[cuts]
            n = cuts + 1 if at_most else len(bad) - cuts - 1
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(n, 1)) - before), 0.0)
            if len(gain) and gain.max() > best:
                at = cuts[int(gain.argmax())]
                best, found = float(gain.max()), Condition(name, at_most, _round_between(float(values[at]), float(values[at + 1])))
    return best, found


def _grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], longest: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < longest and not bad[inside].all():
        _, condition = best_condition(x[inside], bad[inside], names)
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(x[:, names.index(condition.statistic)])
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """The beginning of the rule with the best ``(p - n) / (p + n)`` on other rows, the shorter one of equals."""

    def worth(length: int) -> tuple[float, int]:
        inside = covered(rule[:length], x, names)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        return ((p - n) / (p + n) if p + n else -1.0, -length)

    return rule[: max(range(1, len(rule) + 1), key=worth)] if rule else rule


def learn_rules(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = SHARES, precision: float = 0.9, longest: int = 6, most: int = 50) -> list[Rule]:
    """Ordered rules that name bad rows. A rule must cover two bad rows and keep ``precision`` on all rows left.

    Equal input gives equal rules. Without bad or without good rows there are none.
    """
    rules: list[Rule] = []
    draw = np.random.default_rng(17)
    left = np.ones(len(x), dtype=bool)
    while len(rules) < most and bad[left].sum() >= 2 and not bad[left].all():
        third = draw.integers(0, 3, len(x)) == 0
        rule = _grow(x[left & ~third], bad[left & ~third], names, longest) if bad[left & ~third].any() else ()
        rule = _prune(rule, x[left & third], bad[left & third], names)
        inside = left & covered(rule, x, names)
        if not rule or bad[inside].sum() < 2 or bad[inside].mean() < precision:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def rule_column(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, null where none does."""
    verdict = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        verdict = F.when(holds, number).otherwise(verdict)
    return verdict


def base_failed() -> Column:
    """Fixed limits: fewer than 10 words, or over a fifth of the words in repeated five-word windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def learned_from(statistics: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules from the rows of ``statistics`` that pass the base limits and have a label.

    ``labels`` has ``doc_id, quality``; null ids and qualities are left out, and an id marked 0 and 1 counts as 0.
    Rows that agree in id and statistics count once; of more than ``train_rows`` rows those with the smallest
    hash are taken.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    known = statistics.where(~base_failed()).join(marks, F.col("doc_id") == F.col("_id"))
    known = known.select(F.pmod(F.xxhash64("doc_id", *BASE), F.lit(HASHES)).alias("_hash"), "_quality", *SHARES).distinct()
    known = materialize(known, "labelled")
    # Most rows above the limit stay out before any task sends its smallest ones.
    share = 1.2 * train_rows / max(1, known.count())
    rows = known.where(F.col("_hash") < int(HASHES * min(1.0, share))).orderBy("_hash", "_quality", *SHARES).limit(train_rows)
    rows = rows.drop("_hash").collect()
    table = np.array([tuple(r) for r in rows], dtype=np.float64).reshape(-1, 1 + len(SHARES))
    return learn_rules(table[:, 1:], table[:, 0] == 0)


def apply_quality_rules(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, BASE, SHARES, ``base_failed``, ``rule`` and ``kept`` for each row of ``docs`` (``doc_id, text``).

    ``rule`` is the first learned rule that a row fails by, null where none holds or the base limits have failed it
    already. Null and empty texts have no word and fail the base limits; texts of any length are read whole;
    rows that repeat an id, or have a null one, are judged by their own texts; without labels no rule is
    learned; an empty table gives an empty result; other columns are ignored. Jobs run at once: the
    statistics are stored in the shared folder.
    """
    statistics = materialize(text_statistics(docs), "statistics")
    rules = learned_from(statistics, labels, train_rows)
    failed = base_failed()
    rule = F.when(~failed, rule_column(rules))
    return statistics.withColumns({"base_failed": failed, "rule": rule}).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
