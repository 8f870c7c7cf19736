"""Quality rules: statistics of whole texts and a learnt, ordered list of threshold rules.

The list is learnt by sequential covering.  A rule for poor texts grows by the threshold condition with the
most information gain on two thirds of the labelled rows still uncovered, and is pruned to the prefix that is
most precise on the other third; the rows it covers are then set aside and the next rule grows.  Rules that
are not precise enough end the search.  The list is applied as one Spark conditional expression.

Words are runs outside ``[\\x20\\x09-\\x0D]``.  Learning takes at most ``TRAIN_ROWS`` labelled rows, those with
the smallest hashes of their ids; statistics are of whole texts, and all texts are judged.

Cases: a null or empty text has no words and fails the base rules.  A label that is null is left out, and
labels that repeat an id count once, as good if one of them says so.  Repeated rows are judged alike, also
those without an id.  Without labels of both kinds the list is empty and only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._sample import smallest_hashes
from ._scratch import remove, written
from ._text import WHITE, Words, mix, slices, span_hashes, text_bytes, words_of

TRAIN_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
#: Base rules: fewest words, and the largest share of words in repeated windows, in hundredths.
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3
#: Rules and conditions of a rule, at most; thresholds tried for a statistic; what a rule must show to be kept.
MOST_RULES, MOST_CONDITIONS, THRESHOLDS, LEAST_PRECISION, LEAST_COVERED = 8, 4, 64, 0.98, 10

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_stops")


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """For each row, its words in windows of ``window`` words that the row holds twice or more."""
    n = len(words.hash)
    if n < window:
        return np.zeros(words.n_rows, np.int64)
    value = mix(words.row.astype(np.uint64) + np.uint64(1))[: n - window + 1]
    for j in range(window):
        value = mix(value ^ words.hash[j : n - window + 1 + j])
    at = np.flatnonzero(words.row[: n - window + 1] == words.row[window - 1 :])
    _, code, count = np.unique(value[at], return_inverse=True, return_counts=True)
    again = at[count[code] > 1]
    marked = np.zeros(n, bool)
    for j in range(window):
        marked[again + j] = True
    return np.bincount(words.row[marked], minlength=words.n_rows)


def lines_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, its lines that have a word and those of them that equal an earlier line."""
    n_rows = len(offsets) - 1
    breaks = np.flatnonzero(raw == 0x0A)
    start = np.concatenate([offsets[:-1], breaks + 1])
    start.sort(kind="stable")
    row = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(np.append(start[1:], len(raw)), offsets[np.minimum(row + 1, n_rows)])
    end = np.where(end > start, end - (raw[np.maximum(end - 1, 0)] == 0x0A), end)
    inside = np.concatenate([[0], np.cumsum(~WHITE[raw])])
    keep = inside[end] > inside[start]
    start, end, row = start[keep], end[keep], row[keep]
    value = mix(span_hashes(raw, start, end) ^ mix(row.astype(np.uint64) + np.uint64(1)))
    lines = np.bincount(row, minlength=n_rows)
    _, first = np.unique(value, return_index=True)
    return lines, lines - np.bincount(row[first], minlength=n_rows)


_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_IS_UPPER = (np.arange(256) >= ord("A")) & (np.arange(256) <= ord("Z"))
_IS_DIGIT = (np.arange(256) >= ord("0")) & (np.arange(256) <= ord("9"))
_IS_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?"])
_IS_FIRST = (np.arange(256) & 0xC0) != 0x80  # the first byte of a character
_COUNTED = (("word_chars", _IS_FIRST & ~WHITE), ("n_symbols", _IS_SYMBOL), ("n_upper", _IS_UPPER), ("n_digits", _IS_DIGIT), ("n_stops", _IS_STOP))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        for a, b in slices(offsets):
            part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = words_of(part, at, lower=False)
            lines, again = lines_of(part, at)
            got = {"n_words": words.counts(), "n_repeat_words": repeated_words(words), "n_lines": lines, "n_dup_lines": again}
            for name, table in _COUNTED:
                got[name] = np.diff(np.concatenate([[0], np.cumsum(table[part])])[at])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(got[s].astype(np.int64)) for s in STATISTICS)], names=["id", *STATISTICS])


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the counts named in ``STATISTICS`` for every row."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_statistics, f"id {kind}, " + ", ".join(f"{s} long" for s in STATISTICS))


def measures() -> dict[str, Column]:
    """What the rules compare: counts, and shares that don't depend on a text's length."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": (F.col("word_chars") - F.col("n_symbols")) / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
        "words_per_line": F.col("n_words") / lines,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "stops_per_word": F.col("n_stops") / words,
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] >= self.threshold if self.at_least else x[self.measure] < self.threshold

    def column(self, by: dict[str, Column]) -> Column:
        return by[self.measure] >= self.threshold if self.at_least else by[self.measure] < self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Sequence[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], poor: np.ndarray) -> Rule:
    """Add the condition with the most FOIL gain until no good text is covered."""
    rule: Rule = ()
    left = np.ones(len(poor), bool)
    while len(rule) < MOST_CONDITIONS and (~poor & left).any():
        p0, n0 = (poor & left).sum(), (~poor & left).sum()
        if not p0:
            break
        best, before = (1e-9, None), np.log2(p0 / (p0 + n0))
        for name, values in x.items():
            inside = values[left & poor]
            cuts = np.unique(np.quantile(inside, np.linspace(0, 1, THRESHOLDS), method="nearest"))
            order_p, order_n = np.sort(inside), np.sort(values[left & ~poor])
            for at_least in (True, False):
                edge = cuts if at_least else np.nextafter(cuts, np.inf)
                p, n = np.searchsorted(order_p, edge), np.searchsorted(order_n, edge)
                if at_least:
                    p, n = len(order_p) - p, len(order_n) - n
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), -np.inf)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], Condition(name, at_least, float(edge[i])))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        left &= best[1].holds(x)
    return rule


def learn(x: dict[str, np.ndarray], poor: np.ndarray, *, most_rules: int = MOST_RULES, least_precision: float = LEAST_PRECISION, least_covered: int = LEAST_COVERED) -> list[Rule]:
    """Ordered rules that cover poor rows, from measures of labelled rows in no particular order."""
    n = len(poor)
    held = np.arange(n) % 3 == 2
    left, rules = np.ones(n, bool), []
    while len(rules) < most_rules and (poor & left).sum() >= least_covered:
        grow, prune = left & ~held, left & held
        rule = _grow({k: v[grow] for k, v in x.items()}, poor[grow])
        worth = []
        for size in range(1, len(rule) + 1):
            hit = _covered(rule[:size], x, n) & prune
            p = (poor & hit).sum()
            worth.append(((2 * p - hit.sum()) / max(1, hit.sum()), p))
        if not worth:
            break
        rule = rule[: max(range(len(rule)), key=lambda i: (worth[i], -i)) + 1]
        hit = _covered(rule, x, n) & left
        if hit.sum() < least_covered or (poor & hit).sum() < least_precision * hit.sum() or 2 * (poor & hit & held).sum() < (hit & held).sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """Whether a text is kept: the first rule that covers it drops it."""
    by, out = measures(), None
    for rule in rules:
        condition = rule[0].column(by)
        for more in rule[1:]:
            condition = condition & more.column(by)
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, train_rows: int = TRAIN_ROWS) -> list[Rule]:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("good"))
    chosen = written(smallest_hashes(known, "id", train_rows), "labelled")
    texts = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"], "left_semi")
    counted = statistics(texts, id_col, text_col).join(F.broadcast(chosen), "id")
    names = list(measures())
    rows = counted.select("id", "good", *(c.alias(k) for k, c in measures().items())).toPandas().sort_values(["id", *names])
    rows = rows.sample(frac=1, random_state=0)  # an order that has nothing to do with the ids
    remove(chosen)
    return learn({k: rows[k].to_numpy(float) for k in names}, rows["good"].to_numpy() == 0)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` for every row."""
    rows = statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    return rows.select(F.col("id").alias(id_col), *STATISTICS[:5], "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))


def judge_all(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    return judge(docs, fit(docs, labels, id_col, text_col, **options), id_col, text_col)
