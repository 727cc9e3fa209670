"""Operator 7: WARC archives, written and read back by boundary chains.

Writing: one record per row through Spark's text writer, whose line separator
is the record end, so tasks write whole archives and a lost task is simply
run again. Only rows whose payload may be shared (a size-bounded bitmap over
the digests of shared payloads) are shuffled; the rest are written where they
are read.

Reading: archives are read in splits, cut at every ``CRLF CRLF WARC/1.1
CRLF``. A payload may hold that magic too, so a cut is only a candidate. Each
candidate gives an edge from its own offset to the offset that its header
declares for its successor. Pointer jumping from offset 0 of every archive
doubles the verified part of the chain per round; candidates that the chain
never reaches lie inside payloads and are joined back to the record that
covers them.

Defined results: a null payload is empty; null ids sort last; of repeated
rows (same id, same payload) one is the response and the others revisit it; an
empty table writes no record and reads none; a broken archive (the chain ends
before the end of the file) raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, hash_filter, maybe_in, table

# Fixed values of the format.
CRLF = "\r\n"
MAGIC = "WARC/1.1" + CRLF
RECORD_END = CRLF + CRLF
CUT = RECORD_END + MAGIC
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    digest = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS32, BASE32)


def _digests(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        base32_sha1(payload).alias("payload_digest"))


def _name(page_id: Column, suffix: Column) -> Column:
    """Unique record id: page, payload digest, and what tells repeated rows apart."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"),
                    F.col("payload_digest"), F.lit(":"), suffix.cast("string"), F.lit(">"))


def write_archives(pages: DataFrame, path: str, scratch: Scratch, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
                   records_per_file: int = 50_000) -> None:
    """Write a WARC record per row of ``pages`` below ``path``."""
    no_id = F.isnull("page_id").alias("no_id")
    shared = scratch.save(
        _digests(pages, id_col, payload_col).where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest").agg(F.min(F.struct(no_id, "page_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("payload_digest").alias("shared_digest"), F.col("first.page_id").alias("first_id")),
        "shared")
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"),
                        base32_sha1(payload).alias("payload_digest")).withColumn("hash", F.xxhash64("payload_digest"))
    bitmap = scratch.save(hash_filter(shared.select(F.xxhash64("shared_digest"))), "shared-bits")
    rows = maybe_in(rows, "hash", bitmap, "maybe_shared").drop("hash")
    alone = rows.where("not maybe_shared").withColumn("first_id", F.lit(None).cast("long"))
    met = (rows.where("maybe_shared")
           .join(shared, (F.col("payload_digest") == F.col("shared_digest"))
                 & (F.col("payload_bytes") >= min_bytes), "left"))
    single = met.where("shared_digest is null")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id"))
    later = met.where(F.col("shared_digest").isNotNull() & ~is_first)
    # rows with the winning id: one per digest unless rows repeat
    twin = F.row_number().over(W.partitionBy("payload_digest").orderBy("url")) - 1
    first = met.where(F.col("shared_digest").isNotNull() & is_first).withColumn("twin", twin)
    number = F.monotonically_increasing_id()
    branches = [(alone, F.lit(False), F.concat(F.lit("a"), number)), (single, F.lit(False), F.concat(F.lit("s"), number)),
                (later, F.lit(True), F.concat(F.lit("r"), number)), (first, F.col("twin") > 0, F.col("twin"))]
    parts = [df.select(_record(revisit, suffix).alias("value")) for df, revisit, suffix in branches]
    out = reduce(DataFrame.unionByName, parts)
    out.write.option("lineSep", CRLF).option("maxRecordsPerFile", records_per_file).text(path)


def _record(revisit: Column, suffix: Column) -> Column:
    """The record as text; the writer's line separator completes its end."""
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(CRLF + "WARC-Record-ID: "), _name(F.col("page_id"), suffix),
        F.lit(CRLF + "WARC-Date: " + DATE + CRLF + "WARC-Target-URI: "), url,
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit(CRLF + "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  + CRLF + "WARC-Refers-To: "), _name(F.col("first_id"), F.lit(0)))).otherwise(F.lit("")),
        F.lit(CRLF + "Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(RECORD_END))
    return F.concat(header, block, F.lit(CRLF))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?i)(?:\A|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _parsed(df: DataFrame) -> DataFrame:
    """Columns of the record whose text after the magic is ``body``."""
    body = F.col("body")
    header = F.substring_index(body, RECORD_END, 1)
    number = F.regexp_extract("header", r"(?i)(?:\A|\r\n)Content-Length:[ \t]*(\d{1,18})(?:\r\n|\z)", 1)
    out = df.withColumn("header", header).withColumns({
        "length": F.when(number != "", number.cast("long")), "record_type": _field("WARC-Type"),
        "record_id": _field("WARC-Record-ID"), "refers": _field("WARC-Refers-To"),
        "head_bytes": F.octet_length("header").cast("long") + len(RECORD_END)})
    # the block without its HTTP header; the last record still has its end marker
    out = out.withColumn("block", F.expr("substring(body, length(header) + 5)"))
    out = out.withColumn("payload", F.expr("substring(block, length(substring_index(block, '\\r\\n\\r\\n', 1)) + 5)"))
    over = F.octet_length("body") - F.col("head_bytes") - F.col("length")
    payload = F.when(over == len(RECORD_END), F.expr("substring(payload, 1, length(payload) - 4)")).otherwise(F.col("payload"))
    out = out.withColumn("payload", payload)
    return out.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                            "payload_digest": base32_sha1(F.col("payload"))}).drop("header", "block", "payload")


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(record_id, record_type, refers, payload_bytes, payload_digest) of
    every record in the archives below ``path``."""
    pieces = candidates(spark, path, scratch)
    reached = verified(pieces, scratch)
    records = pieces.join(reached, ["file", "at"], "left_semi")
    plain = records.where("next_at = successor")
    fields = ["record_id", "record_type", "refers", "payload_bytes", "payload_digest"]
    covering = records.where("next_at <> successor")
    if covering.isEmpty():
        return plain.select(*fields)
    return plain.select(*fields).unionByName(_joined_back(spark, path, scratch, pieces, covering).select(*fields))


def candidates(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """Every cut as a candidate record: (file, at, successor, next_at, ...)."""
    raw = spark.read.option("lineSep", CUT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), "value", F.monotonically_increasing_id().alias("seq"),
        F.xxhash64("value").alias("content"), F.octet_length("value").cast("long").alias("size"))
    # only the first cut of a file still begins with the magic at offset 0
    body = F.when((F.col("split") == 0) & F.startswith("value", F.lit(MAGIC)), F.substring(
        "value", len(MAGIC) + 1, 2**31 - 1)).otherwise(F.col("value"))
    pieces = scratch.save(_parsed(raw.withColumn("body", body)).drop("value", "body"), "pieces")
    # offsets: within a split by a running sum, across splits by the splits' totals
    span = F.col("size") + len(CUT)
    order = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    before = (pieces.groupBy("file", "split").agg(F.sum(span).alias("bytes"))
              .select("file", "split", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("split_at")))
    within = W.partitionBy("file", "split").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    placed = (pieces.withColumn("inside", F.coalesce(F.sum(span).over(within), F.lit(0)))
              .join(before, ["file", "split"])
              .withColumn("raw", F.col("split_at") + F.col("inside")))
    magic = len(MAGIC)
    return scratch.save(
        placed.withColumn("at", F.when(F.col("raw") == 0, 0).otherwise(F.col("raw") - magic))
        .withColumn("next_at", F.least(F.col("raw") + F.col("size") + len(RECORD_END), "file_size"))
        .withColumn("successor", F.col("at") + magic + F.col("head_bytes") + F.col("length") + len(RECORD_END))
        .drop("raw", "inside", "split_at", "split", "seq"), "placed")


def verified(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, at) of the candidates on the chain from offset 0 of each file.

    Round k knows the first 2^k records of every chain and, for each
    candidate, the offset 2^k records ahead; the next round jumps once more."""
    edges = pieces.where("successor is not null").select("file", "at", "successor")
    ends = pieces.select("file", "file_size").distinct()
    reached = scratch.save(pieces.where("at = 0").select("file", "at"), "reached-0")
    jump = edges
    known, k = reached.count(), 0
    while True:
        k += 1
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("successor").alias("at"))
        reached = scratch.save(reached.unionByName(ahead).distinct(), f"reached-{k}")
        now = reached.count()
        if now == known:
            break
        known = now
        far = jump.select("file", F.col("at").alias("successor"), F.col("successor").alias("far"))
        jump = scratch.save(jump.join(far, ["file", "successor"]).select("file", "at", F.col("far").alias("successor")),
                            f"jump-{k}")
    broken = ends.join(reached, (ends.file == reached.file) & (ends.file_size == reached.at), "left_anti")
    bad = broken.where("file_size > 0").select("file").take(1)
    if bad:
        raise ValueError(f"broken record chain in {bad[0][0]}")
    return reached


def _joined_back(spark: SparkSession, path: str, scratch: Scratch, pieces: DataFrame, covering: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their pieces in order, with the
    cuts put back. A piece is found again by its content, so it does not
    matter how the archives are split this time."""
    owner = covering.select("file", F.col("at").alias("owner"), "successor")
    inner = (pieces.select("file", "at", "content", "size", "next_at")
             .join(owner, "file").where("at >= owner and at < successor"))
    parts = inner.select("file", "owner", "at", "content", "size")
    text = (spark.read.option("lineSep", CUT).text(path)
            .select("value", F.xxhash64("value").alias("content"), F.octet_length("value").cast("long").alias("size"))
            .join(parts.select("content", "size").distinct(), ["content", "size"], "left_semi")
            .dropDuplicates(["content", "size"]))
    whole = (parts.join(text, ["content", "size"]).groupBy("file", "owner")
             .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("all"))
             .withColumn("body", F.array_join(F.col("all.value"), CUT)))
    whole = whole.withColumn("body", F.when(
        (F.col("owner") == 0) & F.startswith("body", F.lit(MAGIC)), F.substring("body", len(MAGIC) + 1, 2**31 - 1))
        .otherwise(F.col("body")))
    return _parsed(whole)


def _page(name: str) -> Column:
    return F.regexp_extract(name, r"<urn:page:(-?\d+):", 1).try_cast("long")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0) -> DataFrame:
    """Write the archives, read them back, resolve revisits."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_archives(pages, scratch.path("archives"), scratch, id_col, url_col, payload_col, min_bytes)
    records = scratch.save(read_archives(spark, scratch.path("archives"), scratch), "records")
    names = ["record_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'")
    full = responses.select(F.col("record_id").alias("refers"), "payload_bytes", "payload_digest")
    seen = revisits.select("record_id", "record_type", "refers").join(full, "refers", "left")
    return (responses.select(*names, F.lit(None).cast("string").alias("refers"))
            .unionByName(seen.select(*names, "refers"))
            .select(_page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    F.when(F.col("refers").isNotNull(), _page("refers")).alias("refers_to")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES = {"op7_warc": op7_warc}
ORACLE = {"op7_warc": r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, h, min(page_id) OVER (PARTITION BY h) AS first_id,
         translate(concat(to_base(('0x' || substr(h, 1, 10))::BIGINT, 32, 8), to_base(('0x' || substr(h, 11, 10))::BIGINT, 32, 8),
                          to_base(('0x' || substr(h, 21, 10))::BIGINT, 32, 8), to_base(('0x' || substr(h, 31, 10))::BIGINT, 32, 8)),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""}
