"""Content-addressed WARC archive: payloads once by digest, record headers apart.

An archive is a folder with two Parquet tables:

* ``payloads``: ``digest`` (SHA-256), ``payload``, ``payload_bytes``, ``sha1`` and ``holder``, the
  record that stands for the payload;
* ``records``: ``record_id``, ``digest`` and the exact bytes of ``warc_header`` and ``http_header``.

A payload is stored once, however many records have it. A join of both tables restores every
record; a hot payload travels once per task that needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.llm.common import stored, whole_bytes

# The alphabets of base 32 by value and by RFC 4648.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: A list of copies up to this length (their digests and ids) is broadcast.
BROADCAST_COPIES = 1_000_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 40 bits of the digest make 8 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), BASE32_DIGITS, BASE32_RFC4648)


def _line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null. Line ends within the value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(record_id.cast("string")), F.lit("null")), F.lit(">"))


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_from: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one record per page: a response, or a revisit of the same payload.

    Of records with equal payloads of at least ``revisit_from`` bytes, that with the smallest id
    is the response and the others revisit it; smaller payloads are stored once too, but all
    their records are responses. A null payload is empty. Rows that repeat the smallest id are
    all responses; a null id is larger than any other, and if all ids of a payload are null, all
    its records are responses. Ids may be of any type that casts to text and back. A null url leaves out its header line. Copies of a payload that
    agree in SHA-256 must agree in length and SHA-1, else the write fails. An empty table gives
    an empty archive. Other columns are not read.
    """
    spark = pages.sparkSession
    source = pages.select(
        F.col(f"`{id_col}`").alias("record_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        whole_bytes(payload_col).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))

    # Digests first: payloads themselves are never shuffled here.
    index = stored(
        source.select(
            "record_id", "url", "digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1")
        ),
        "warc-index",
    )
    check = F.struct("payload_bytes", "sha1")
    differ = F.raise_error(F.concat(F.lit("payloads differ under one digest: "), F.hex("digest")))
    groups = stored(
        index.groupBy("digest")
        .agg(F.min("record_id").alias("holder"), F.count(F.lit(1)).alias("n"), F.min(check).alias("check"), F.max(check).alias("other"))
        .select("digest", "n", F.when(F.col("check") == F.col("other"), F.col("holder")).otherwise(differ.cast(index.schema["record_id"].dataType)).alias("holder")),
        "warc-groups",
    )
    own = F.col("record_id").eqNullSafe(F.col("holder"))
    members = index.select("digest", "record_id").join(groups.filter("n > 1"), "digest")
    copies = stored(members.filter(~own).select("digest", "record_id").distinct(), "warc-copies")
    again = members.filter(own).groupBy("digest").count().filter("count > 1")
    if copies.count() <= BROADCAST_COPIES:
        copies = F.broadcast(copies)
    same = source["digest"].eqNullSafe(copies["digest"]) & source["record_id"].eqNullSafe(copies["record_id"])
    held = source.join(copies, same, "left_anti").select("digest", F.col("record_id").alias("holder"), "payload")
    held = held if again.isEmpty() else held.dropDuplicates(["digest"])
    held.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "sha1": base32_sha1(F.col("payload"))}).write.parquet(
        f"{path}/payloads"
    )

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    revisits = (F.col("payload_bytes") >= revisit_from) & ~F.col("record_id").eqNullSafe(F.col("holder"))
    block_bytes = F.octet_length("http_header") + F.when(F.col("revisits"), 0).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("revisits"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("record_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Refers-To", F.when(F.col("revisits"), _urn(F.col("holder")))),
        _line("WARC-Profile", F.when(F.col("revisits"), REVISIT_PROFILE)),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block_bytes.cast("string")),
        F.lit("\r\n"),
    )
    (
        index.join(groups.select("digest", "holder"), "digest")
        .withColumns({"http_header": http, "revisits": revisits})
        .select("record_id", "digest", header.cast("binary").alias("warc_header"), F.col("http_header").cast("binary"))
        .write.parquet(f"{path}/records")
    )


def _field(name: str, pattern: str) -> Column:
    """A value from the header block, null if the line is missing."""
    found = F.regexp_extract(F.col("warc_header").cast("string"), rf"\r\n{name}: {pattern}\r\n", 1)
    return F.nullif(found, F.lit(""))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive with their restored payloads and bytes.

    ``record_type``, ``declared_digest`` and ``refers_to`` come from the stored headers;
    ``payload_bytes`` and ``payload_digest`` are taken anew from the stored payload, and ``intact``
    tells whether it has the digests under which it was filed and declared; ``complete``, whether the
    restored block is as long as its header declares. ``record`` holds the bytes of the WARC record; ``payload`` the full payload, of revisits too. Columns that are
    not asked for are not read, so a query on digests moves no payload.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "digest",
        "payload",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        (F.unhex(F.sha2("payload", 256)) == F.col("digest")).alias("filed_well"),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    records = spark.read.parquet(f"{path}/records")
    return (
        records.join(payloads, "digest", "left")
        .select(
            "record_id",
            _field("WARC-Type", r"(\w+)").alias("record_type"),
            F.url_decode(_field("WARC-Refers-To", r"<urn:page:(.*?)>")).cast(records.schema["record_id"].dataType).alias("refers_to"),
            _field("Content-Length", r"(\d+)").cast("bigint").alias("declared_bytes"),
            _field("WARC-Payload-Digest", r"sha1:(\w+)").alias("declared_digest"),
            *("payload_digest", "payload_bytes", "payload", "warc_header", "http_header", "filed_well"),
        )
        .withColumn("intact", F.coalesce(F.col("filed_well") & (F.col("declared_digest") == F.col("payload_digest")), F.lit(False)))
        .withColumn("complete", F.col("declared_bytes") == F.octet_length("http_header") + F.octet_length(body))
        .withColumn("record", F.concat("warc_header", "http_header", body, F.lit(b"\r\n\r\n")))
        .drop("filed_well", "declared_bytes")
    )


def export_warc(archive: DataFrame, path: str) -> None:
    """Write restored records as gzip-compressed WARC files, one per partition."""
    ended = F.expr("substring(record, 1, octet_length(record) - 4)")
    archive.select(ended.cast("string").alias("value")).write.options(lineSep="\r\n\r\n", compression="gzip").text(path)
