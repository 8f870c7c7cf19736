"""Content-addressed WARC archive.

An archive is a folder: ``payloads`` holds each distinct payload once under its SHA-256, dealt into buckets by
it, and ``headers`` holds the exact header block of every record with the digest that it names.  A record is put
together again by a join on the digest: header block, empty line, payload, two line ends.  Digests are
checked against the stored bytes as an archive is read.

Payload bytes are shuffled once, to write them; readers shuffle header blocks to the buckets.  Copies of one payload
meet in each task before they are shuffled, and long payloads are read by their response alone.

Of the records with one payload of at least ``least`` bytes, that with the smallest id is the response and
the others revisit it; smaller payloads, which cost less than a reference, are responses all (they too are
stored once).

Cases: a null payload is empty; a null url leaves out its header line; rows with a null id are kept, and are
responses where no id shares their payload; rows that repeat the smallest id are responses too, of the one
stored payload.  An empty table makes an empty archive, and columns that are not named are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._hot import join_hot
from ._scratch import new_path, remove, written

#: Payloads of fewer bytes are never revisited.
LEAST_BYTES = 100
#: The date of every record: archives of the same rows are the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"


def record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("none")), F.lit(">"))


def header_block(id_: Column, url: Column, payload_bytes: Column, digest: Column, kind: Column, refers_to: Column, date: str = DATE) -> Column:
    """A record's header lines; a revisit has an empty block, so its length is 0."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(LINE))
    revisit = kind == "revisit"
    one_line = F.regexp_replace(url, r"[\r\n]", " ")
    return F.concat(
        F.lit(f"WARC/1.1{LINE}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_id(id_)),
        F.lit(f"WARC-Date: {date}{LINE}"),
        F.coalesce(line("WARC-Target-URI", one_line), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        line("WARC-Payload-Length", payload_bytes.cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(refers_to)), F.lit(f"WARC-Profile: {PROFILE}{LINE}"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(payload_bytes.cast("string"))),
    )


def write_archive(df: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", *, least: int = LEAST_BYTES) -> None:
    """Write ``path/payloads``, ``path/headers`` and ``path/layout``; only ids, urls and digests find the owners."""
    spark = df.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    rows = written(rows, "warc-rows")
    told = join_hot(rows, rows.groupBy("digest").agg(F.min("id").alias("owner")), "digest")
    revisit = (F.col("n") >= least) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    header = header_block(F.col("id"), F.col("url"), F.col("n"), F.col("digest"), kind, F.col("owner"))
    told.select("digest", header.alias("header")).write.parquet(f"{path}/headers")
    remove(rows)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = df.select(payload.alias("payload")).groupBy(F.sha2("payload", 256).alias("digest")).agg(F.first("payload").alias("payload"))
    name = f"warc_{uuid.uuid4().hex}"
    stored.write.bucketBy(buckets, "digest").sortBy("digest").option("path", f"{path}/payloads").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone: the files are the archive's
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{path}/layout")


def _header(name: str) -> Column:
    return F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)


def read_headers(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every record's fields as its header block states them, and the block itself."""
    as_id = lambda x: F.expr(f"try_cast(nullif(nullif(regexp_extract({x}, '<urn:page:([^>]*)>', 1), ''), 'none') as {id_type})")
    df = spark.read.parquet(f"{path}/headers").select("header")
    df = df.withColumns({"kind": _header("WARC-Type"), "own": _header("WARC-Record-ID"), "other": _header("WARC-Refers-To")})
    return df.select(
        as_id("own").alias("id"),
        _header("WARC-Payload-Length").cast("long").alias("payload_bytes"),
        F.regexp_extract(_header("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        as_id("other").alias("refers_to"),
        "header",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(digest, payload)``; a stored payload that does not have its digest fails the read."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    name = f"warc_{uuid.uuid4().hex}"
    at = f"{path}/payloads".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} (digest string, payload binary) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{at}'")
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    right = F.sha2("payload", 256) == F.col("digest")
    payload = F.when(right, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest")).cast("binary"))
    return df.select("digest", payload.alias("payload"))


def read_records(spark: SparkSession, path: str, id_type: str = "long", *, least: int = LEAST_BYTES) -> DataFrame:
    """Every record with its fields as its header states them, its own payload, and its exact bytes.

    A revisit has no payload of its own: ``payload_digest`` finds it in ``read_payloads``.  ``least`` tells which
    payloads many responses may share; any number gives the same records.
    """
    told = read_headers(spark, path, id_type).withColumnRenamed("payload_digest", "digest")
    stored = read_payloads(spark, path)
    response = told.where("record_type = 'response'")
    long = response.where(F.col("payload_bytes") >= least).join(stored, "digest", "left")
    short = join_hot(response.where(F.col("payload_bytes") < least), stored.where(F.octet_length("payload") < least), "digest")
    lost = F.raise_error(F.concat(F.lit("no payload has the digest "), "digest")).cast("binary")
    held = long.unionByName(short).withColumn("payload", F.coalesce("payload", lost))
    rows = held.unionByName(told.where("record_type <> 'response'").withColumn("payload", F.lit(None).cast("binary")))
    record = F.concat(F.col("header").cast("binary"), F.lit(b"\r\n"), F.coalesce("payload", F.lit(b"")), F.lit(b"\r\n\r\n"))
    return rows.select("id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "payload", record.alias("record"))


def read_index(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every record without its payload; lengths and digests are those of the payloads in the rebuilt records.

    A response's are taken from its record's bytes, a revisit's from the record that it refers to.
    """
    text = F.col("record")
    head = F.position(F.lit(b"\r\n\r\n"), text)  # the last line end of the header block, and the empty line
    block = F.substring(text, head + 4, F.octet_length(text) - head - 7)
    rows = read_records(spark, path, id_type).select("id", "record_type", "refers_to", F.col("payload_digest").alias("digest"), F.octet_length(block).cast("long").alias("n"), F.sha2(block, 256).alias("found"))
    rows = written(rows, "warc-index")
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type <> 'response'").drop("n", "found")
    own = responses.groupBy("digest").agg(F.max("n").alias("n"), F.max("found").alias("found"))
    every = responses.unionByName(join_hot(revisits, own, "digest").select(*responses.columns))
    whole = F.when(F.col("found") == F.col("digest"), F.col("found")).otherwise(F.raise_error(F.concat(F.lit("a record's payload differs from its digest "), "digest")))
    return every.select("id", F.col("n").alias("payload_bytes"), whole.alias("payload_digest"), "record_type", "refers_to")


def export_warc(spark: SparkSession, path: str, out: str, *, compression: str = "gzip") -> None:
    """The archive as plain ``.warc`` text files that any WARC reader opens; every payload must be UTF-8.

    A record ends with two line ends, so the text writer's separator closes it and nothing is added.
    """
    record = F.expr("substring(record, 1, length(record) - 4)").cast("string")
    read_records(spark, path).select(record.alias("value")).write.option("lineSep", LINE * 2).option("compression", compression).text(out)


def archive_round_trip(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", *, least: int = LEAST_BYTES, path: str | None = None) -> DataFrame:
    """Write an archive of ``df`` and return its records as read back, without their payloads."""
    spark = df.sparkSession
    path = path or new_path(spark, "warc")
    id_type = df.schema[id_col].dataType.simpleString()
    write_archive(df, path, id_col, payload_col, url_col, least=least)
    return read_index(spark, path, id_type).withColumnRenamed("id", id_col)
