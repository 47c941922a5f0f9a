"""WARC archives: writing captures, reading records, and assembling transactions.

Records are written by Spark's text writer, each followed by its closing CRLF CRLF; an archive is what one task writes, and
there are as many as keep one at about ``ARCHIVE_BYTES``. Reading takes whole files from ``binaryFile`` and parses them in
Arrow batches, gzip members included. Transactions are joined through WARC-Concurrent-To, in whichever direction records
name each other: one nested row for each capture.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import scratch_path, written

CRLF = "\r\n"
#: Text of an archive, before compression.
ARCHIVE_BYTES = 64 << 20
#: Record types that are a capture of their own; others belong to one.
MAIN_TYPES = ("response", "revisit", "resource", "conversion")
# Fixed value: the letters of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_SCHEMA = "warc_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, date string, block_bytes long, payload_bytes long, payload_digest string, declared_digest string, http_head string, payload binary, fields map<string,string>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32_of_hex(digest: Column) -> Column:
    """Base 32 of the 40 hexadecimal digits of a SHA-1: five of them make four letters."""
    letters = []
    for at in range(0, 40, 5):
        value = F.conv(F.substring(digest, at + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.pmod(F.shiftright(value, 15 - 5 * k), F.lit(32)) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*letters)


def capture_roles(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(id, sha1, latest) for each row: ``latest`` is the largest id of equal payload, null where payloads are not compared.

    The payload is the text in UTF-8, a null one empty. Payloads of at least ``min_bytes`` are compared.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    found = pages.select(F.col(id_col).cast("long").alias("id"), F.sha1(html).alias("sha1"), F.octet_length(html).alias("bytes"))
    # one row for each payload, combined before the shuffle; a payload that many pages share is split by skew handling
    latest = found.where(F.col("bytes") >= min_bytes).groupBy("sha1").agg(F.max("id").alias("latest"))
    return found.join(latest, "sha1", "left").select("id", "sha1", F.when(F.col("bytes") >= min_bytes, F.col("latest")).alias("latest"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record up to its block; named fields with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in headers]
    head = F.concat_ws("", F.lit(f"WARC/1.1{CRLF}"), *lines)
    return F.concat(head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)


def _urn(kind: str, key: Column, sha1: Column) -> Column:
    return F.concat(F.lit(f"<urn:listwell:{kind}:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), sha1, F.lit(">"))


def write_captures(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a request, a response or revisit, and a metadata record for each row.

    Of equal payloads of at least ``min_bytes`` that of the largest id is the response; the others are revisits, which have
    no payload of their own: they name the response that has it and the payload's digest. Smaller payloads are all
    responses. Records are named by id and payload, so an id that is null or stands for several payloads is no matter.
    """
    roles = capture_roles(pages, id_col=id_col, html_col=html_col, min_bytes=min_bytes)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), html.alias("html"))
    total = pages.agg(F.sum(F.octet_length(html) + 1024)).first()[0] or 0
    # each partition is one archive; both sides are dealt alike, so that the join moves nothing again
    archives = max(-(-int(total) // archive_bytes), min(pages.sparkSession.sparkContext.defaultParallelism, 1 + int(total) // (1 << 20)))
    deal = lambda df: df.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("null"))).drop("id").repartition(archives, "key", "sha1")
    joined = deal(rows.withColumn("sha1", F.sha1("html"))).join(deal(roles.distinct()), ["key", "sha1"])
    key, sha1, uri, when = F.col("key"), F.col("sha1"), F.regexp_replace("url", r"[\r\n]", ""), F.lit(date)
    main, revisit = _urn("capture", key, sha1), F.coalesce(F.col("latest").cast("string") != key, F.lit(False))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(sha1))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF + CRLF))
    host = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    request = F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF))
    records = F.array(
        _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request", key, sha1)), ("WARC-Concurrent-To", main), ("WARC-Target-URI", uri), ("WARC-Date", when), ("Content-Type", F.lit("application/http; msgtype=request"))], request),
        _record(
            [("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", main), ("WARC-Target-URI", uri), ("WARC-Date", when), ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http; msgtype=response")),
             ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))), ("WARC-Refers-To", F.when(revisit, _urn("capture", F.col("latest"), sha1)))],
            F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
        ),
        _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata", key, sha1)), ("WARC-Concurrent-To", main), ("WARC-Target-URI", uri), ("WARC-Date", when), ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("page-id: "), key.cast("string"), F.lit(CRLF))),
    )
    joined.select(F.explode(records).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def _unzipped(data: bytes) -> bytes:
    """The archive's bytes; gzip members one after the other are joined."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def parse_warc(data: bytes) -> Iterator[dict]:
    """Records of one archive, by their Content-Length. An unreadable header or a cut block is an error."""
    view, at = _unzipped(data), 0
    while at < len(view):
        end = view.find(b"\r\n\r\n", at)
        if end < 0 or not view.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields, concurrent = {}, []
        for line in view[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            name, value = name.decode(errors="replace").strip().lower(), value.decode(errors="replace").strip()
            fields[name] = value
            if name == "warc-concurrent-to":  # the one field that may stand several times
                concurrent.append(value)
        size = int(fields["content-length"])
        block = view[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut short")
        at = end + 4 + size
        while view.startswith(b"\r\n", at):
            at += 2
        http = fields.get("content-type", "").startswith("application/http")
        head, cut, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        declared = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
        yield {
            "warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "concurrent_to": concurrent, "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "block_bytes": size, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload), "declared_digest": declared, "http_head": (head + cut).decode(errors="replace") or None, "payload": payload, "fields": list(fields.items()),
        }


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """Every record of the archives under ``path``; ``with_payload=False`` leaves the payload column null."""
    kinds = {"payload": pa.binary(), "concurrent_to": pa.list_(pa.string()), "fields": pa.map_(pa.string(), pa.string())} | dict.fromkeys(("block_bytes", "payload_bytes"), pa.int64())
    names = [c.strip().split(" ")[0] for c in RECORD_SCHEMA.replace("map<string,string>", "map").split(",")]
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held, rows = 0, []
                for record in parse_warc(content.as_py()):
                    held += record["payload_bytes"]
                    rows.append(record if with_payload else record | {"payload": None})
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        held, rows = 0, []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: ``capture`` (its record id) and arrays of whole records, ``mains``, ``requests``, ``metadata`` and ``others``.

    A main record is a response, revisit, resource or conversion. Any other record belongs to the main records that it names
    in WARC-Concurrent-To or that name it, or else to those of a record so joined that it names or that names it. Records
    that reach no main one are rows of their own, under their own id, with empty ``mains``; records without an id can't be
    named and stand alone too, under a null id. Main records that share an id are one capture. ``records`` is read
    several times: pass a written table.
    """
    main = F.col("warc_type").isin(*MAIN_TYPES)
    nodes = records.where("record_id IS NOT NULL").select("record_id", F.coalesce(main, F.lit(False)).alias("is_main"), "concurrent_to")
    kinds = nodes.groupBy(F.col("record_id").alias("b")).agg(F.max("is_main").alias("b_main"))
    named = nodes.select(F.col("record_id").alias("a"), F.col("is_main").alias("a_main"), F.explode("concurrent_to").alias("b")).where("a <> b").join(kinds, "b")
    ends = lambda side, other: F.struct(F.col(side).alias("side"), F.col(f"{side}_main").alias("side_main"), F.col(other).alias("other"), F.col(f"{other}_main").alias("other_main"))
    links = named.select(F.explode(F.array(ends("a", "b"), ends("b", "a"))).alias("x")).select("x.*").where("NOT side_main")
    joined = links.groupBy("side").agg(F.collect_set(F.when(F.col("other_main"), F.col("other"))).alias("captures"), F.collect_set(F.when(~F.col("other_main"), F.col("other"))).alias("sides"))
    direct = joined.where(F.size("captures") > 0).select(F.col("side").alias("record_id"), "captures")
    far = joined.where((F.size("captures") == 0) & (F.size("sides") > 0)).select("side", F.explode("sides").alias("record_id")).join(direct, "record_id")
    far = far.select("side", F.explode("captures").alias("capture")).groupBy(F.col("side").alias("record_id")).agg(F.collect_set("capture").alias("captures"))
    belongs = direct.unionByName(far)
    placed = records.join(belongs, "record_id", "left").withColumn("captures", F.when(main | F.col("captures").isNull(), F.array("record_id")).otherwise(F.col("captures")))
    # a record without an id keeps a group of its own
    placed = placed.withColumn("lone", F.when(F.col("record_id").isNull(), F.monotonically_increasing_id()))
    rows = placed.select(F.explode("captures").alias("capture"), "lone", main.alias("is_main"), "warc_type", F.struct(*records.columns).alias("record"))
    kind = F.when(F.col("is_main"), "mains").when(F.col("warc_type") == "request", "requests").when(F.col("warc_type") == "metadata", "metadata").otherwise("others")
    listed = [F.collect_list(F.when(kind == k, F.col("record"))).alias(k) for k in ("mains", "requests", "metadata", "others")]
    return rows.groupBy("capture", "lone").agg(*listed).drop("lone")


def archived_pages(pages: DataFrame, *, path: str | None = None, min_bytes: int = 0, **columns: str) -> DataFrame:
    """Write ``pages`` to archives in ``path`` (default: a new shared folder), read them back and assemble the captures.

    Per page: page_id, payload_bytes and payload_digest of the full payload (a revisit's are those of its response),
    record_type, refers_to, request_uri, n_records of its capture. Digests are computed anew from the payload read and must
    equal the declared ones, or the row's ``digest_ok`` is false. A null html is an empty payload, a null url an empty one.
    Null ids and ids with several payloads are archived like others; the same row twice is the same capture twice. An empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_captures(pages, path, min_bytes=min_bytes, **columns)
    slim = read_warc(spark, path, with_payload=False).drop("payload", "http_head", "fields")
    captures = assemble(written(slim, "warc-records"))
    number = lambda c: F.regexp_extract(c, r":(-?\d+):[0-9a-f]+>$", 1).try_cast("long")
    size = F.size("mains") + F.size("requests") + F.size("metadata") + F.size("others")
    each = captures.where(F.size("mains") > 0).select("capture", F.explode("mains").alias("main"), F.get("requests", F.lit(0))["target_uri"].alias("request_uri"), (size / F.size("mains")).cast("long").alias("n_records"))
    flat = written(each.select("capture", number(F.col("capture")).alias("page_id"), F.col("main.warc_type").alias("record_type"), F.col("main.refers_to").alias("refers_to"), F.col("main.payload_bytes").alias("own_bytes"), F.col("main.payload_digest").alias("own_digest"), F.col("main.declared_digest").alias("declared"), "request_uri", "n_records"), "warc-captures")
    theirs = flat.where("record_type = 'response'").select(F.col("capture").alias("named"), F.col("own_bytes").alias("their_bytes"), F.col("own_digest").alias("their_digest")).distinct()
    revisit = F.col("record_type") == "revisit"
    joined = flat.join(theirs, revisit & (F.col("refers_to") == F.col("named")), "left")
    size, digest = F.coalesce("their_bytes", "own_bytes"), F.coalesce("their_digest", "own_digest")
    return joined.select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", F.when(revisit, number(F.col("refers_to"))).alias("refers_to"), digest.eqNullSafe(F.col("declared")).alias("digest_ok"), "request_uri", "n_records")
