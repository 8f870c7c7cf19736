"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions alone.

A seed is five words picked by a fixed mask from eight; the words that the mask ignores may differ.  The seeds
of all texts meet those of the benchmark by hash, and around each hit the two texts are laid side by side
without gaps: a window of ``WINDOW`` words of which ``similarity`` are equal is a leak.  Every window of 13
words with at most two substitutions has a hit of the mask, wherever they are, so none of them is missed.

Words are runs of letters and digits, in lower case.  A benchmark text of fewer words than the window must
occur in full, unchanged; one of fewer than five words is no evidence and is never reported.

The benchmark's seeds are broadcast if there are at most ``BROADCAST_SEEDS`` of them.  Beyond that the seeds of
both sides are shuffled and the texts joined again to the hits, by their ids and a hash of their words.  What is
carried on from a text is one row for each window that leaks, summed per text and item before it is shuffled.

Cases: null and empty texts leak nothing.  A null id, of a text or an item, is reported as null; rows that repeat
an id are reported together, but ``without_leaks`` judges each by its own text.  Benchmark items that repeat a text
are reported each.  Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Five of eight words; and, for items too short for it, five words running.
SPACED, RUNNING = (0, 1, 3, 6, 7), (0, 1, 2, 3, 4)
#: Words of a window and the share of them that must be equal.
WINDOW, SIMILARITY = 13, 0.8
#: Most seeds of a benchmark that is broadcast; a seed is about 40 bytes.
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _seeds(df: DataFrame, mask: Sequence[int], position: str) -> DataFrame:
    """A row for each place of the mask in ``words``: ``position`` and the hash ``h`` of the words it picks."""
    placed = df.where(F.size("words") > mask[-1]).withColumn(position, F.explode(F.sequence(F.lit(0), F.size("words") - (mask[-1] + 1))))
    return placed.withColumn("h", F.xxhash64(F.lit(mask[-1]), *[F.get("words", F.col(position) + m) for m in mask]))


def _windows(mask: Sequence[int], window: int, need: int) -> Column:
    """The leaking windows around a hit, as an array of their first word and how many of its words are equal.

    Only windows that contain the mask's words are looked at: any other is found from a hit of its own.
    """
    n, size, shift = F.size("words"), F.size("item_words"), F.col("pos") - F.col("item_pos")
    width = F.least(F.lit(window), size)
    least = F.when(size >= window, F.lit(need)).otherwise(size)
    first = F.greatest(F.lit(0), F.col("item_pos") + (mask[-1] + 1) - width, -shift)
    last = F.least(F.col("item_pos"), size - width, n - shift - width)

    def equal(s: Column) -> Column:
        return F.size(F.filter(F.sequence(s, s + width - 1), lambda j: F.get("item_words", j) == F.get("words", j + shift)))

    found = F.filter(F.transform(F.sequence(first, last), lambda s: F.struct((s + shift).alias("at"), width.alias("width"), equal(s).alias("equal"))), lambda x: x["equal"] >= least)
    return F.when(first <= last, found)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """``(id, item, first_word, last_word, best_equal)`` for every text and item that leaks into it.

    The words are counted from 0; ``best_equal`` is the most equal words of one window.
    """
    need = math.ceil(round(similarity * window, 9))
    texts = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("words")).where(F.size("words") >= len(RUNNING))
    size = items.agg(F.sum(F.size("words")), F.min(F.size("words"))).first()
    small = (size[0] or 0) <= broadcast_seeds
    masks = [SPACED, *[RUNNING] * ((size[1] or WINDOW) <= SPACED[-1])]
    hint = F.broadcast if small else (lambda x: x)

    found = []
    for mask in masks:
        own = items if mask == SPACED else items.where(F.size("words") <= SPACED[-1])
        seeds = _seeds(own, mask, "item_pos").select("h", "item", "item_pos")
        whole = hint(own.select(F.col("item").alias("of"), F.col("words").alias("item_words")))
        same = F.col("item").eqNullSafe(F.col("of"))
        hits = _seeds(texts, mask, "pos")
        if small:
            hits = hits.join(hint(seeds), "h").join(whole, same)
        else:
            mark = F.xxhash64("words").alias("mark")  # null ids, and rows that repeat an id, meet their own words alone
            hits = hits.select("id", mark, "pos", "h").join(seeds, "h").select("id", "mark", "item", "pos", "item_pos").distinct()
            full = texts.select(F.col("id").alias("own"), mark, "words").distinct()
            hits = hits.join(whole, same).join(full, (hits.mark == full.mark) & hits.id.eqNullSafe(full.own)).drop(full.mark)
        found.append(hits.select("id", "item", F.inline(_windows(mask, window, need))))
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return rows.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        F.min("at").cast("long").alias("first_word"), F.max(F.col("at") + F.col("width") - 1).cast("long").alias("last_word"), F.max("equal").cast("long").alias("best_equal")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows of ``docs`` into which no benchmark item leaks, with all their columns."""
    row = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    marked = docs.withColumn("__row", row)
    found = leaks(marked, benchmark, "__row", text_col, **options).select("__row").distinct()
    return marked.join(found, "__row", "left_anti").select(*docs.columns)
