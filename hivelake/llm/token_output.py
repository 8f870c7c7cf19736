"""Token ids as Parquet list columns, in the order of the documents' ids, with page indexes.

A token file is a folder of Parquet files.  Each row is a document: its id, the number of the part it lies in,
its place among the part's ids, its number of ids, and the list of ids.  Ids are dictionary-encoded (two bytes
each, or fewer), rows are ascending by id over the parts, row groups and pages have a set size, and every page
has its least and greatest id in the page index, so a reader opens only the pages that hold the documents it
wants, and reads numbers of ids without the ids.

Texts are encoded by the ``tokenizers`` library.  A byte-level tokenizer with the usual splitting pattern never
joins across a single blank or line end between two characters that are no white space, so texts are cut there and
equal words are encoded once for each worker.  Texts with other blanks or a special token's string, and the texts of
other tokenizers, are encoded whole.

Cases: a null or empty text has the end id alone.  Null ids come first.  Rows that repeat an id are in the order
of their texts' hashes, and rows that repeat both are alike.  An empty table gives an empty file and result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._chunks import ChunkCache
from ._scratch import new_path

END_ID = 0
#: Words that a worker remembers in each of two generations, about 200 bytes each.
REMEMBERED = 400_000
#: Bytes of a row group and of a page, and of the largest dictionary.
ROW_GROUP_BYTES, PAGE_BYTES, DICTIONARY_BYTES = 32 << 20, 64 << 10, 1 << 20


#: White space other than blanks and line ends, and a blank or line end beside white space or at an end.
_OTHER_SPACE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_NO_CUT = re.compile(r"^[ \n]|[ \n]\s|\s[ \n]|[ \n]\Z")
_SEAMS = ("  ", " \n", "\n ", "\n\n")


def can_cut(text: str) -> bool:
    """Whether every blank and line end lies between two characters that are no white space."""
    if any(c in text for c in _OTHER_SPACE):
        return not _NO_CUT.search(text)
    return text[:1] not in (" ", "\n", "") and text[-1] not in " \n" and not any(s in text for s in _SEAMS)


def _byte_marks() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BytePairEncoder:
    """Ids of texts as bytes of little-endian unsigned 32-bit integers, exactly as the library gives them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        splitter = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space") and not spec["model"].get("dropout") and not spec.get("truncation") and not spec.get("padding")
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pairs, self.marks = self.library.model.tokenize, _byte_marks()
        self.raw = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.stops = {c: self.raw[self.library.token_to_id(c)] for c in ".," if self.library.token_to_id(c) is not None}
        self.line_end = self.whole("\n")
        self.words: ChunkCache[bytes] = ChunkCache(self._word, REMEMBERED)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a blank and ``word``, or of a line that begins with ``word``; none of nothing."""
        if not word:
            return b""
        if word[0] == "\n":
            return self.line_end + (self._letters(word[1:], "") or self.whole(word[1:]))
        return self._letters(word, "\u0120") or self.whole(f" {word}")

    def _letters(self, word: str, blank: str) -> bytes | None:
        """The splitter keeps Latin letters in one, with the blank before them, and a stop after them apart."""
        stop = self.stops.get(word[-1:])
        core = word[:-1] if stop else word
        if not core.isalpha():
            return None
        if not core.isascii():
            if max(core) >= "\u0250":
                return None
            core = core.encode().decode("latin-1").translate(self.marks)
        raw = self.raw
        ids = b"".join([raw[t.id] for t in self.pairs(blank + core)])
        return ids + stop if stop else ids

    def encode(self, text: str) -> bytes:
        if not self.by_word or not can_cut(text) or any(s in text for s in self.special):
            return self.whole(text)
        words = text.replace("\n", " \n").split(" ")  # a line end stays at the head of its line
        first = words[0]
        words[0] = ""
        return (self._letters(first, "") or self.whole(first)) + b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str) -> BytePairEncoder:
    return BytePairEncoder(path)


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every text and write the token file ``path``.  ``tokenizer`` is a path that executors can open."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text", F.spark_partition_id().alias("part"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text, start = encoder(tokenizer).encode, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounds what is held beside the batch
                part = batch.slice(at, 512)
                ids = [encode_text(t.as_py()) + end for t in part.column(1)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(start + ends - n), pa.array(n), lists], names=["id", "part", "place", "n_tokens", "ids"])
                start += int(ends[-1])

    kind = df.schema[id_col].dataType.simpleString()
    encoded = rows.mapInArrow(encode, f"id {kind}, part int, place long, n_tokens long, ids array<int>")
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.dictionary.page.size": DICTIONARY_BYTES, "parquet.enable.dictionary": "true", "compression": "zstd"}
    encoded.write.options(**options).parquet(path)


def part_starts(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """For each part the ids of all parts before it; reads numbers of ids alone."""
    sizes = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    out, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes):
        out.append((part, total))
        total += n
    return out


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids)``; filters on ``id`` reach the page index, unread columns stay unread."""
    starts = spark.createDataFrame(part_starts(spark, path), "part int, before long")
    rows = spark.read.parquet(path).join(F.broadcast(starts), "part")  # a row for each part of the file
    return rows.select("id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids")


def checked(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of rows from ``read_tokens``; the lists give numbers and checksums."""
    kind = rows.schema["id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    out = rows.select("id", "start", "ids").mapInArrow(check, f"id {kind}, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the token file of ``df`` and return what its reader finds."""
    spark = df.sparkSession
    path = path or new_path(spark, "tokens")
    write_tokens(df, path, tokenizer, id_col, text_col, end_id=end_id)
    return checked(read_tokens(spark, path), id_col)
