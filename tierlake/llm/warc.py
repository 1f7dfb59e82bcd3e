"""Content-addressed WARC archive.

An archive is two tables in one folder: ``records`` has each record's exact header
block and the strong digest (SHA-256) of its payload; ``payloads`` has every payload
once, under that digest.  Equal digests are verified on writing (one length, one
SHA-1) and payloads again on reading (SHA-256 of the stored bytes); a difference
fails the job.  Records are rebuilt by joining the two.

Of records with equal payloads of at least ``least_bytes``, that of the smallest id is
a response and the others are revisits that refer to it; all shorter ones are
responses.

Defined cases: a null payload is empty; repeated ids with equal payloads give one
response and revisits of it; a null id comes last in order; a null url leaves
WARC-Target-URI out, and line ends in a url are percent-encoded.  Extra columns are not
archived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


def base32(hex_digest: Column) -> Column:
    """Base 32 of a digest given as 40 hexadecimal digits."""
    def letters(k):
        five = F.conv(F.substr(hex_digest, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(five, 15 - 5 * j).bitwiseAND(31) + 1, F.lit(1))
                          for j in range(4)])
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _headers(kind: Column, page: Column, url: Column, sha1: Column, length: Column, refers: Column) -> Column:
    """The exact header block of a record."""
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    stored = F.when(kind == "revisit", F.lit(0)).otherwise(length)
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: "), _record_id(page)),
             F.concat(F.lit("WARC-Target-URI: "), uri),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
             F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), _record_id(refers))),
             F.when(kind == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "), stored.cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  least_bytes: int = 0) -> None:
    """Payloads cross the network at most once: copies meet in a partial aggregate first."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    seen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    hashed = seen.select("page_id", "url", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"),
                         F.length("payload").cast("long").alias("n"), "payload")
    stored = hashed.groupBy("digest").agg(
        F.min("payload").alias("payload"), F.min("n").alias("n"), F.max("n").alias("n_max"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("sha1_max"))
    same = (F.col("n") == F.col("n_max")) & (F.col("sha1") == F.col("sha1_max"))
    stored.select("digest", F.when(same, F.col("payload")).otherwise(
        F.raise_error(F.lit("different payloads have one digest"))).alias("payload"), "n", "sha1") \
        .write.parquet(f"{path}/payloads")

    # page rows without payloads; a row number tells repeated ids apart
    small = hashed.drop("payload").withColumn("row", F.monotonically_increasing_id())
    small.write.parquet(f"{path}/hashes")
    small = spark.read.parquet(f"{path}/hashes")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id").alias("id"), F.col("row").alias("row"))
    first = small.groupBy("digest").agg(F.min(order).alias("first"))
    known = small.join(first, "digest")
    kind = F.when((F.col("n") >= least_bytes) & (F.col("row") != F.col("first.row")), F.lit("revisit")) \
        .otherwise(F.lit("response"))
    headers = _headers(F.col("kind"), F.col("page_id"), F.col("url"), base32(F.col("sha1")), F.col("n"), F.col("first.id"))
    known.withColumn("kind", kind).select("row", "digest", headers.cast("binary").alias("headers")) \
        .write.parquet(f"{path}/records")


def _field(text: Column, name: str) -> Column:
    return F.regexp_extract(text, rf"(?s)\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload), each payload checked against its address."""
    t = spark.read.parquet(f"{path}/payloads")
    good = F.sha2("payload", 256) == F.col("digest")
    return t.select("digest", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes) of every
    record, parsed from its headers; the digest and length are taken from the payload
    that the archive holds."""
    records = spark.read.parquet(f"{path}/records").withColumn("h", F.decode("headers", "utf-8"))
    held = read_payloads(spark, path).select(
        "digest", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("hex"))
    page = F.regexp_extract(_field(F.col("h"), "WARC-Record-ID"), "<urn:page:(.*)>", 1)
    refers = F.regexp_extract(_field(F.col("h"), "WARC-Refers-To"), "<urn:page:(.*)>", 1)
    claimed = _field(F.col("h"), "WARC-Payload-Digest")
    # the letters are made after the join: before it, each of them would compute the SHA-1 again
    joined = records.join(held, "digest").withColumn("of_payload", base32(F.col("hex")))
    return (joined.select(
        page.try_cast("long").alias("page_id"),
        F.when(F.instr("h", "\r\nWARC-Target-URI: ") > 0, _field(F.col("h"), "WARC-Target-URI")).alias("url"),
        _field(F.col("h"), "WARC-Type").alias("record_type"), refers.try_cast("long").alias("refers_to"),
        F.when(claimed == F.concat(F.lit("sha1:"), F.col("of_payload")), F.col("of_payload")).otherwise(
            F.raise_error(F.lit("a record's digest is not its payload's"))).alias("payload_digest"),
        "payload_bytes"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(row, record): the original records' bytes, headers and the stored payload (a
    revisit has none), ended as the format asks."""
    records = spark.read.parquet(f"{path}/records")
    revisit = F.instr(F.decode("headers", "utf-8"), "\r\nWARC-Type: revisit\r\n") > 0
    end = F.lit(CRLF + CRLF).cast("binary")
    return records.join(read_payloads(spark, path), "digest").select("row", F.concat(
        "headers", F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")), end).alias("record"))
