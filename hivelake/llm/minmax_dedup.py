"""Near-duplicate groups by min-max hashing.

A document's set is its distinct shingles of ``k`` words.  Under each of some permutations both the smallest
and the largest value of the set are kept, two unbiased samples of the Jaccard similarity for one evaluation.
Bands of ``ROWS`` values (the two of each of ``ROWS / 2`` permutations) are bucket keys, and there are so many
bands that a pair at the threshold misses all of them with a probability below ``MISS``.

Documents with equal sets are one class.  Classes that share a bucket are compared: each bucket is named by its
smallest class, and the buckets of one name are one group, so classes that meet in many bands are compared once.
Bands of eight values keep passages and licences that many documents share from making large buckets: a similarity
of 0.2 meets in a band three times in a million.  Within a group every pair of classes is compared on full sets,
block by block, and each block gives the links of a spanning forest, never all pairs.  The components of all
links are the groups of near-duplicates.

Words and shingles are known by 64-bit hashes, also where full sets are compared.

Cases: a text without words, or null, has an empty set and is linked with nothing; a text of fewer than ``k``
words is one shingle.  Rows with a null id are linked with nothing, their component is null and they are kept.
Rows that repeat an id are judged each by its own text, and a component is named by the smallest id of its
rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._hot import join_hot
from ._scratch import remove, written
from ._text import distinct_per_row, mix, runs_of, word_slices

#: Words of a shingle.
WORDS = 5
#: Values of a band: the smallest and the largest under each of half as many permutations.
ROWS = 8
#: The chance that a pair at the threshold shares no band.
MISS = 1e-6
#: A group is compared in blocks of at most so many classes and about so many shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 20
SEED = 20_240_607


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(0.999999, (percent / 100) ** rows))))


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers, all odd, and addends of ``n`` permutations of the 32-bit values."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def min_max(shingles: np.ndarray, times: np.ndarray, plus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest value of a set under every permutation."""
    low, high = np.full(len(times), 0xFFFFFFFF, np.uint32), np.zeros(len(times), np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 512):
        values = times[:, None] * x[None, at : at + 512]
        values += plus[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """``(documents, bands)`` of 64-bit keys; the band's number is part of its key."""
    half = rows // 2
    n, bands = len(low), low.shape[1] // half
    pairs = (low.astype(np.uint64) << np.uint64(32) | high).reshape(n, bands, half)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
    for j in range(half):
        keys = mix(keys ^ mix(pairs[:, :, j] + np.uint64(j)))
    return keys


def _signed(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    times, plus = permutations(bands * rows // 2)
    for batch in batches:
        for a, b, words in word_slices(batch.column(1), lower=True):
            sets, at = distinct_per_row(*runs_of(words, k), b - a)
            n = np.diff(at)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (sets, mix(sets ^ np.uint64(SEED)))]
            low, high = np.zeros((b - a, len(times)), np.uint32), np.zeros((b - a, len(times)), np.uint32)
            for i in np.flatnonzero(n):
                low[i], high[i] = min_max(sets[at[i] : at[i + 1]], times, plus)
            keys = band_keys(low, high, rows).astype(np.int64).ravel()
            filled = np.where(n > 0, bands, 0)
            keys = keys[np.repeat(n > 0, bands)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    batch.column(2).slice(a, b - a),
                    pa.array(n, pa.int64()),
                    pa.array((sums[0][at[1:]] - sums[0][at[:-1]]).astype(np.int64)),
                    pa.array((sums[1][at[1:]] - sums[1][at[:-1]]).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(filled)]), pa.int32()), pa.array(keys)),
                ],
                names=["id", "version", "n", "c1", "c2", "bands"],
            )


def _with_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Members with their sets as bytes; a row whose text is not its class's is left out."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        c1, c2 = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("c1", "c2"))
        rest = batch.select(["node", "groups"])
        for a, b, words in word_slices(text, lower=True):
            sets, at = distinct_per_row(*runs_of(words, k), b - a)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (sets, mix(sets ^ np.uint64(SEED)))]
            same = np.ones(b - a, bool)
            for s, c in zip(sums, (c1, c2), strict=True):
                same &= (s[at[1:]] - s[at[:-1]]).astype(np.int64) == c[a:b]
            raw = pa.array([sets[at[i] : at[i + 1]].tobytes() for i in range(b - a)], pa.binary())
            out = pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, raw], names=[*rest.schema.names, "shingles"])
            yield out.filter(pa.array(same))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set on the left shares with each on the right."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    keep = often[code]
    owner, code = owner[keep], (np.cumsum(often) - 1)[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    total, width = int(often.sum()), max(64, min(4096, (1 << 21) // max(1, len(sets))))
    out = np.zeros((len(left), len(right)), np.int64)
    for c in range(0, total, width):
        a, b = np.searchsorted(code, [c, c + width])
        x = np.zeros((len(sets), min(width, total - c)), np.float32)
        x[owner[a:b], code[a:b] - c] = 1
        out += (x[: len(left)] @ x[len(left) :].T).astype(np.int64)  # at most the width, which a float holds
    return out


def forest(links: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the first member of each row's component."""
    label = np.full(len(links), -1)
    for i in range(len(links)):
        if label[i] < 0:
            label[i] = i
            edge = np.array([i])
            while len(edge):
                edge = np.flatnonzero(links[edge].any(axis=0) & (label < 0))
                label[edge] = i
    return label


def _compare(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the classes of two blocks, or within one, as stars of their components."""
    group = group.drop_duplicates("node").sort_values("node")
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
    size = np.array([len(s) for s in sets])
    node, lo = group["node"].to_numpy(), group["block"].to_numpy() == group["lo"].to_numpy()
    first, second = np.flatnonzero(lo), np.flatnonzero(~lo)
    within = not len(second)
    if within:
        second = first
    out = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    if not len(first) or not len(second) or (within and len(first) < 2):
        return out
    both = shared_counts([sets[i] for i in first], [sets[i] for i in second])
    linked = 100 * both >= percent * (size[first][:, None] + size[second][None, :] - both)
    links = np.zeros((len(sets), len(sets)), bool)
    links[np.ix_(first, second)] = linked
    links |= links.T
    label = forest(links)
    other = label != np.arange(len(label))
    return pd.DataFrame({"a": node[label[other]], "b": node[other]})


def _grouped(docs: DataFrame, k: int, percent: int, rows: int, miss: float) -> DataFrame:
    """``(id, version, n, alone, group, smallest)`` of every row of ``docs(id, text, version)``.

    ``group`` is the component's number, null for rows that are ``alone``, and ``smallest`` its smallest id.
    """
    bands = bands_for(percent, rows, miss)
    kinds = "id long, version string, n long, c1 long, c2 long, bands array<long>"
    signed = written(docs.select("id", "text", "version").mapInArrow(lambda it: _signed(it, k, bands, rows), kinds), "signatures")

    classes = signed.where("n > 0 AND id IS NOT NULL").groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.min("n").alias("n"))
    # numbers that stay as they are: they are read from the table
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # a row of the class's smallest id has its bands; rows that repeat both are the same set
    marked = signed.join(classes.select("c1", "c2", F.col("rep").alias("id"), "node"), ["c1", "c2", "id"])
    keyed = marked.select("node", F.explode("bands").alias("key"))
    lead = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").select("key", "lead")
    members = keyed.join(lead, "key").select("node", "lead").distinct().join(classes, "node")
    members = written(members, "members")

    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("lead").agg(blocks.alias("blocks"))
    placed = join_hot(members, sizes, "lead").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a class is in no more groups than it has bands
    placed = placed.groupBy("node", "rep", "c1", "c2").agg(F.collect_list(F.struct("lead", "blocks", "block")).alias("groups"))
    # a shuffle at every size: what is sent grows in proportion, and no list of classes goes to all tasks
    texts = docs.join(placed.withColumnRenamed("rep", "id").hint("shuffle_merge"), "id").select("node", "groups", "c1", "c2", "text")
    full = texts.mapInArrow(lambda it: _with_sets(it, k), "node long, groups array<struct<lead: long, blocks: int, block: int>>, shingles binary")
    pairs = full.select("node", "shingles", F.inline("groups")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("node", "lead", "block", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "shingles")
    links = pairs.groupBy("lead", "lo", "hi").applyInPandas(lambda g: _compare(g, percent), "a long, b long")
    groups = components(links).select(F.col("v").alias("node"), "component")

    named = classes.join(groups, "node", "left").select("c1", "c2", "rep", F.coalesce("component", "node").alias("group"))
    smallest = named.groupBy("group").agg(F.min("rep").alias("smallest"))
    named = join_hot(named, smallest, "group").drop("rep")
    out = join_hot(signed.select("id", "version", "n", "c1", "c2"), written(named, "named"), "c1", "c2")
    alone = (F.col("n") == 0) | F.col("id").isNull()
    return out.select("id", "version", "n", alone.alias("alone"), F.when(~alone, F.col("group")).alias("group"), F.when(~alone, F.col("smallest")).alias("smallest"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = WORDS, percent: int = 85, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row; ids are integers.

    Two documents are linked if ``100 * shared >= percent * union`` of their sets.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.lit("").alias("version"))
    out = _grouped(docs, k, percent, rows, miss)
    component = F.when(F.col("alone"), F.col("id")).otherwise(F.col("smallest"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def without_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = WORDS, percent: int = 85, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row of each group of near-duplicates, with all columns, and every row that is linked with nothing.

    The row with the smallest id stays; of rows that repeat it, that whose text has the smallest MD5; and of rows
    that repeat both, that whose columns come first in order.  Rows without an id or without words all stay, and
    texts that differ too much to be linked stay also where they repeat an id.  Columns have types with an order.
    """
    keyed = df.withColumns({"__id": F.col(id_col).cast("long"), "__version": F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))})
    told = written(_grouped(keyed.select(F.col("__id").alias("id"), F.col(text_col).alias("text"), F.col("__version").alias("version")), k, percent, rows, miss), "grouped")
    one = F.min(F.struct("id", "version")).alias("one")
    kept = told.where("NOT alone").groupBy("group").agg(one, F.count(F.lit(1)).alias("rows")).where("rows > 1").select("group", "one")
    goes = join_hot(told.where("NOT alone"), written(kept, "kept"), "group").where(F.struct("id", "version") != F.col("one")).select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct()
    rest = keyed.join(goes, ["__id", "__version"], "left_anti")
    again = told.where("NOT alone").groupBy("id", "version").count().where("count > 1").select(F.col("id").alias("__id"), F.col("version").alias("__version"))
    if again.isEmpty():
        return rest.select(*df.columns)
    # equal rows add up in every task before they are shuffled
    same = rest.join(again, ["__id", "__version"], "left_semi").groupBy("__id", "__version").agg(F.min(F.struct(*df.columns)).alias("row")).select("row.*")
    return rest.join(again, ["__id", "__version"], "left_anti").select(*df.columns).unionByName(same)
