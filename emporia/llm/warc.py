"""WARC archives: write captures, read records, assemble transactions.

A capture is a request, a response (or a revisit) and a metadata record.
Request and metadata name the response in WARC-Concurrent-To; assembly groups
the records of a capture by that identifier and emits one nested row.

Archives are written and read by Spark's own text source, so any store that
Spark reads will do, and large archives are read in splits: a record ends with
CRLF CRLF, which is the writer's line end, and starts with a mark at which the
reader splits. A payload that holds the mark itself is written in HTTP chunks
that cut through it, so the mark never occurs inside a record. Every record's
length is checked against its Content-Length.

Payloads of at least ``min_bytes`` bytes that are equal (SHA-1 and length) are
stored once, with the largest page_id; the other captures are revisits.

Defined results: a null html is an empty payload; a null url is left out of
the records and comes back null; a null page_id is a capture of its own with
an identifier drawn at write time, and can be a revisit but is never referred
to; rows that share a page_id are one capture, of which the largest record (by
type, payload bytes, digest) is shown; line ends and control characters in a
url are percent-encoded; an empty table gives no captures; only page_id, url
and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small

CRLF = "\r\n"
MARK = "WARC/1.1\r\nWARC-Type: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 1000
BROADCAST_GROUPS = 1 << 18      # rows of some 60 bytes


def _lines(*parts: Column | str) -> Column:
    """Header lines; a null line is left out."""
    return F.concat_ws(CRLF, *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _record(kind: Column | str, headers: Column, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.lit(MARK), kind, F.lit(CRLF), headers, F.lit(CRLF), length, F.lit(CRLF + CRLF), block)


def _url_text(url: Column) -> Column:
    """A url that fits a header line."""
    for c in [*range(0x00, 0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return url


def _chunked(payload: Column) -> Column:
    """The payload in HTTP chunks that end inside each mark."""
    pieces = F.split(payload, r"(?<=WARC/1\.1)(?=\r\nWARC-Type: )", -1)
    chunk = lambda p: F.concat(F.lower(F.hex(F.octet_length(p).cast("long"))), F.lit(CRLF), p, F.lit(CRLF))
    return F.concat(F.array_join(F.transform(pieces, chunk), ""), F.lit(f"0{CRLF}{CRLF}"))


def _unchunked(body: Column) -> Column:
    """The payload of a chunked body; works on bytes, since chunk sizes count bytes."""
    line = F.encode(F.lit(CRLF), "UTF-8")

    def step(state: Column, _: Column) -> Column:
        at = F.locate(CRLF, F.decode(F.substring(state["rest"], 1, 20), "ISO-8859-1"))
        size = F.conv(F.decode(F.substring(state["rest"], F.lit(1), at - 1), "ISO-8859-1"), 16, 10).cast("int")
        size = F.coalesce(size, F.lit(0))
        piece = F.substring(state["rest"], at + 2, size)
        rest = F.substring(state["rest"], at + 2 + size + 2, F.octet_length(state["rest"]))
        return F.struct(F.when(size == 0, line).otherwise(rest).alias("rest"),
                        F.concat(state["out"], piece).alias("out"))

    raw = F.encode(body, "UTF-8")
    pieces = F.size(F.split(body, r"WARC/1\.1", -1)) + 2          # at least as many steps as chunks
    start = F.struct(raw.alias("rest"), F.encode(F.lit(""), "UTF-8").alias("out"))
    done = F.aggregate(F.sequence(F.lit(1), pieces), start, step)
    return F.decode(done["out"], "UTF-8")


def write(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write three records for each row of ``pages`` (page_id, url, html) below ``path``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), _url_text(F.col("url").cast("string")).alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    # Payloads too small to be revisited get a key that matches nothing and spreads them.
    rows = rows.withColumn("same", F.when(F.col("bytes") >= min_bytes, F.concat("digest", F.lit(":"), "bytes"))
                           .otherwise(F.concat_ws("-", F.lit(""), "page_id", F.substring("digest", 1, 8))))
    groups = (rows.filter(F.col("bytes") >= min_bytes).groupBy("same")
              .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    # Payloads are shuffled only if there are more groups of copies than can be broadcast.
    rows = rows.join(broadcast_if_small(groups, BROADCAST_GROUPS), "same", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    rows = rows.select("page_id", "url", "payload", "digest", "bytes", "original", revisit.alias("revisit"),
                       F.coalesce(F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")),
                                  F.concat(F.lit("urn:capture:"), F.expr("uuid()"))).alias("rid"))
    target = F.concat(F.lit("WARC-Target-URI: "), F.col("url"))
    date = F.concat(F.lit("WARC-Date: "), F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                                                      "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rid = lambda part="": F.concat(F.lit("WARC-Record-ID: <"), F.col("rid"), F.lit(f"{part}>"))
    with_response = F.concat(F.lit("WARC-Concurrent-To: <"), F.col("rid"), F.lit(">"))
    http = lambda *more: _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", *more, "", "")
    plain = http(F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")))
    marked = F.instr(F.col("payload"), MARK) > 0
    block = (F.when(F.col("revisit"), plain)
             .when(marked, F.concat(http("Transfer-Encoding: chunked"), _chunked(F.col("payload"))))
             .otherwise(F.concat(plain, F.col("payload"))))
    refers = F.when(F.col("revisit"), _lines(f"WARC-Profile: {PROFILE}", F.concat(
        F.lit("WARC-Refers-To: <urn:page:"), F.col("original").cast("string"), F.lit(">"))))
    response = _record(F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), _lines(
        rid(), date, target, "Content-Type: application/http;msgtype=response",
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")), refers), block)
    request = _record("request", _lines(
        rid(":request"), date, target, with_response, "Content-Type: application/http;msgtype=request"),
        F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_replace("url", "^[^:]*://[^/?#]*|#.*$", ""), F.lit("")),
                                           F.lit("/")), F.lit(f" HTTP/1.1{CRLF}{CRLF}")))
    metadata = _record("metadata", _lines(
        rid(":metadata"), date, with_response, "Content-Type: application/warc-fields"),
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    (rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))


def _field(headers: Column, name: str) -> Column:
    """Value of a header line, null if there is none."""
    return F.nullif(F.regexp_extract(headers, rf"(?m)^{name}: <?([^>\r\n]*)>?\r?$", 1), F.lit(""))


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record; ``payloads`` adds the text of each response.

    The bytes and digest of a response are taken from its stored payload,
    those of a revisit from its headers. A record of another length than its
    Content-Length is an error.
    """
    raw = spark.read.option("lineSep", MARK).text(path).filter(F.length("value") > 0)
    at = F.instr(F.col("value"), CRLF + CRLF)
    rows = raw.select(F.substring("value", F.lit(1), at - 1).alias("_head"),
                      F.expr(f"substring(value, instr(value, '{CRLF}{CRLF}') + 4)").alias("_block"))
    rows = rows.withColumn("record_type", F.substring_index("_head", CRLF, 1))
    whole = F.octet_length("_block") == _field(F.col("_head"), "Content-Length").cast("int") + 4
    rows = rows.withColumn("_block", F.when(whole, F.col("_block")).otherwise(
        F.raise_error(F.lit("a record's length differs from its Content-Length"))))
    rows = rows.withColumn("_http", F.expr(f"substring(_block, 1, instr(_block, '{CRLF}{CRLF}') - 1)"))
    body = F.expr("substring(_block, length(_http) + 5, length(_block) - length(_http) - 8)")
    body = F.when(F.contains(F.col("_http"), F.lit("Transfer-Encoding: chunked")), _unchunked(body)).otherwise(body)
    rows = rows.withColumn("payload", F.when(F.col("record_type") == "response", body))
    stored = F.col("record_type") == "response"
    digest = F.regexp_replace(_field(F.col("_head"), "WARC-Payload-Digest"), "^sha1:", "")
    columns = [
        "record_type", _field(F.col("_head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("_head"), "WARC-Concurrent-To").alias("concurrent_to"),
        _field(F.col("_head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("_head"), "WARC-Target-URI").alias("url"),
        F.when(stored, F.octet_length("payload").cast("long")).when(
            F.col("record_type") == "revisit", _field(F.col("_http"), "Content-Length").cast("long")).alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(digest).alias("payload_digest"),
        F.when(F.col("record_type") == "metadata", F.nullif(F.regexp_extract("_block", "page-id: ([0-9-]*)", 1), F.lit("")))
        .cast("long").alias("page_id")]
    return rows.select(*columns, *(["payload"] if payloads else []))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response, metadata (null if a record is missing)."""
    names = [c for c in records.columns if c != "concurrent_to"]
    sort = ["record_type", "payload_bytes", "payload_digest"]
    fields = F.struct(*sort, *(c for c in names if c not in sort))
    kind = F.col("record_type")
    return (records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
            .agg(F.max(F.when(kind == "request", fields)).alias("request"),
                 F.max(F.when(kind.isin("response", "revisit"), fields)).alias("response"),
                 F.max(F.when(kind == "metadata", fields)).alias("metadata")))


def captures(assembled: DataFrame) -> DataFrame:
    """Flat view: page_id, url, payload_bytes, payload_digest, record_type, refers_to (a page_id)."""
    return assembled.select(
        F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        F.nullif(F.regexp_extract("response.refers_to", "^urn:page:(-?[0-9]+)$", 1), F.lit("")).cast("long")
        .alias("refers_to"),
        F.col("response.url").alias("url"))
