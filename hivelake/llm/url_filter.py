"""URL filter: prefix rules first, then exact domain membership by a Bloom filter cascade.

The cascade's level 0 encodes the listed domains.  Level 1 encodes the domains of the corpus that level 0
takes for listed though they are not; level 2 the listed ones that level 1 takes for unlisted; and so on
until a level has no false positive left.  The first level that lacks a key decides it, by its parity.  The
levels are built from every domain that occurs in the corpus and has no more labels than the longest listed one
(longer ones can't be listed), so the answer is exact for each of them.

A cascade of at most ``BROADCAST_BYTES`` is sent to every task, and urls are judged where they are read.  Beyond
that its shards stay apart, and each distinct host goes to the shards of its domains; hosts with very many urls
meet their verdict by a broadcast.

Cases: a null url, or one without ``://``, has an empty host and path and gets no rule; an empty host is in
no list and is allowed.  Repeated rows are judged alike, an empty table gives an empty result, and columns
other than the two that are named are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._hot import join_hot
from ._scratch import written
from ._text import mix

#: The rules that production applies, most general first: (host and path prefix, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

#: The domains that production lists.
NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED = tuple(f"{name}.example.{top}" for name in NAMES for top in ("com", "net", "org"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys of one shard of the cascade; each shard is built by one task.
SHARD_KEYS = 1_000_000
#: A cascade of at most so many bytes is broadcast; a larger one is looked up shard by shard.
BROADCAST_BYTES = 64 << 20

LEVEL_SCHEMA = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("n_bits", T.LongType()),
        T.StructField("n_hashes", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)  # without "://" nothing matches: empty
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; both null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda x: (len(x[0]), x[0])):  # the longest is tried first
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def domains_of(host: str, depth: int) -> list[str]:
    """The domains of at most ``depth`` labels among the host itself and every domain above it."""
    parts = host.rsplit(".", depth)[-depth:]
    return [".".join(parts[i:]) for i in range(len(parts))] if host else []


def key_hashes(keys: Iterable[str]) -> np.ndarray:
    """128 bits for each key, as two columns."""
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in keys)
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def _places(hashes: np.ndarray, level: int, n_bits: int, n_hashes: int) -> Iterator[np.ndarray]:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    a, b = mix(hashes[:, 0] ^ salt), mix(hashes[:, 1] + salt) | np.uint64(1)
    for i in range(n_hashes):
        yield ((a + np.uint64(i) * b) % np.uint64(n_bits)).astype(np.int64)


def _within(bits: np.ndarray, hashes: np.ndarray, level: int, n_bits: int, n_hashes: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in _places(hashes, level, n_bits, n_hashes):
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def cascade_levels(listed: np.ndarray, others: np.ndarray) -> list[tuple[int, int, bytes]]:
    """``(bits, hashes, filter)`` of each level, for two disjoint sets of key hashes."""
    levels: list[tuple[int, int, bytes]] = []
    encode, test = listed, others
    first = min(0.5, max(1e-6, len(listed) / math.sqrt(2) / max(1, len(others))))
    while len(encode):
        level, rate = len(levels), 0.5 if levels else first
        n_bits = max(64, math.ceil(-len(encode) * math.log(rate) / math.log(2) ** 2))
        n_hashes = max(1, round(-math.log2(rate)))
        bits = np.zeros((n_bits + 7) // 8, np.uint8)
        for at in _places(encode, level, n_bits, n_hashes):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        levels.append((n_bits, n_hashes, bits.tobytes()))
        encode, test = test[_within(bits, test, level, n_bits, n_hashes)], encode
    return levels


def cascade_lookup(levels: list[tuple[int, int, bytes]], hashes: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that lacks it decides."""
    listed, open_ = np.zeros(len(hashes), bool), np.arange(len(hashes))
    for level, (n_bits, n_hashes, raw) in enumerate(levels):
        found = _within(np.frombuffer(raw, np.uint8), hashes[open_], level, n_bits, n_hashes)
        listed[open_[~found]] = level % 2 == 1
        open_ = open_[found]
    listed[open_] = len(levels) % 2 == 1
    return listed


def _domain_rows(batches: Iterator[pd.DataFrame], n_shards: int, depth: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(h, d) for h in batch["host"] for d in domains_of(h or "", depth)]
        hashes = key_hashes(d for _, d in rows)
        yield pd.DataFrame({"host": [h for h, _ in rows], "domain": [d for _, d in rows], "shard": (hashes[:, 0] % np.uint64(n_shards)).astype("int32")})


def labels_of(domain: Column) -> Column:
    return F.length(domain) - F.length(F.replace(domain, F.lit("."), F.lit(""))) + 1


@dataclass(frozen=True)
class Cascade:
    """The levels of every shard, a row each, the number of shards, and the labels of the longest listed domain."""

    levels: DataFrame
    n_shards: int
    depth: int


def build_cascade(hosts: DataFrame, listed: DataFrame, *, shard_keys: int = SHARD_KEYS) -> Cascade:
    """``hosts`` has a column ``host`` of distinct hosts, ``listed`` a column ``domain``.

    The universe is every domain of every host, as far as it could be listed, together with the list.
    """
    size = listed.where("domain <> ''").agg(F.count(F.lit(1)), F.coalesce(F.max(labels_of(F.col("domain"))), F.lit(1))).first()
    depth = size[1]
    total = size[0] + hosts.agg(F.coalesce(F.sum(F.least(labels_of(F.col("host")), F.lit(depth))), F.lit(0))).first()[0]
    n_shards = max(1, math.ceil(total / shard_keys))
    rows = T.StructType([T.StructField("host", T.StringType()), T.StructField("domain", T.StringType()), T.StructField("shard", T.IntegerType())])
    universe = hosts.mapInPandas(lambda it: _domain_rows(it, n_shards, depth), rows).select("domain", "shard", F.lit(0).alias("is_listed"))

    def list_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [k for k in batch["domain"] if k]
            yield pd.DataFrame({"domain": keys, "shard": (key_hashes(keys)[:, 0] % np.uint64(n_shards)).astype("int32"), "is_listed": np.ones(len(keys), "int32")})

    chosen = listed.select("domain").mapInPandas(list_rows, "domain string, shard int, is_listed int")
    keys = universe.unionByName(chosen).groupBy("domain", "shard").agg(F.max("is_listed").alias("is_listed"))

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        hashes, flags = key_hashes(batch["domain"]), batch["is_listed"].to_numpy() == 1
        levels = cascade_levels(hashes[flags], hashes[~flags])
        return pd.DataFrame([(int(batch["shard"].iloc[0]), i, *x) for i, x in enumerate(levels)], columns=LEVEL_SCHEMA.names)

    return Cascade(written(keys.groupBy("shard").applyInPandas(build, LEVEL_SCHEMA), "cascade"), n_shards, depth)


def _by_shard(rows: Iterable) -> dict[int, list[tuple[int, int, bytes]]]:
    out: dict[int, list[tuple[int, int, bytes]]] = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(int(r[0]), []).append((int(r[2]), int(r[3]), bytes(r[4])))
    return out


def _hosts_listed(hosts: Iterable[str], shards: dict[int, list[tuple[int, int, bytes]]], n_shards: int, depth: int) -> np.ndarray:
    """Whether a host or a domain above it is listed."""
    hosts = list(hosts)
    per_host = [domains_of(h, depth) for h in hosts]
    hashes = key_hashes(d for ds in per_host for d in ds)
    owner = np.repeat(np.arange(len(hosts)), [len(ds) for ds in per_host])
    shard, out = (hashes[:, 0] % np.uint64(n_shards)).astype(int), np.zeros(len(hosts), bool)
    for s in np.unique(shard):
        at = np.flatnonzero(shard == s)
        np.logical_or.at(out, owner[at], cascade_lookup(shards.get(int(s), []), hashes[at]))
    return out


def with_listed(df: DataFrame, cascade: Cascade, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` and a column ``listed``: its ``host`` or a domain above it is in the list."""
    spark, n_shards, depth = df.sparkSession, cascade.n_shards, cascade.depth
    size = cascade.levels.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        shared = spark.sparkContext.broadcast(_by_shard(cascade.levels.collect()))

        @F.pandas_udf("boolean")
        def listed(hosts: pd.Series) -> pd.Series:
            codes, distinct = pd.factorize(hosts)
            return pd.Series(_hosts_listed(distinct, shared.value, n_shards, depth)[codes])

        return df.withColumn("listed", listed("host"))

    # too large to broadcast: every distinct host goes to the shards of its domains
    rows = T.StructType([T.StructField("host", T.StringType()), T.StructField("domain", T.StringType()), T.StructField("shard", T.IntegerType())])
    keys = df.select("host").distinct().mapInPandas(lambda it: _domain_rows(it, n_shards, depth), rows)

    def look(batch: pd.DataFrame, levels: pd.DataFrame) -> pd.DataFrame:
        found = cascade_lookup(next(iter(_by_shard(levels.itertuples(index=False)).values()), []), key_hashes(batch["domain"]))
        return pd.DataFrame({"host": batch["host"], "listed": found})

    verdicts = keys.groupBy("shard").cogroup(cascade.levels.groupBy("shard")).applyInPandas(look, "host string, listed boolean")
    verdicts = verdicts.groupBy("host").agg(F.max("listed").alias("listed"))
    return join_hot(df, verdicts, "host").withColumn("listed", F.coalesce("listed", F.lit(False)))


def judge_urls(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    *,
    rules: Iterable[tuple[str, str]] = RULES,
    listed: Iterable[str] | DataFrame = LISTED,
    broadcast_bytes: int = BROADCAST_BYTES,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row."""
    spark = df.sparkSession
    if not isinstance(listed, DataFrame):
        listed = spark.createDataFrame([(x,) for x in listed], "domain string")
    parsed = df.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    cascade = build_cascade(parsed.select("host").distinct(), listed.select("domain").distinct(), shard_keys=shard_keys)
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    judged = with_listed(parsed, cascade, broadcast_bytes=broadcast_bytes)
    verdict = F.coalesce(says, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"))
