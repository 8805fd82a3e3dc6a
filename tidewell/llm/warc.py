"""WARC archives: a writer on Spark's text sink and a salvage reader.

The reader checks every record (version line, header block, Content-Length, closing CRLFs, digests of block and payload).
After a failed check it searches for the next version line, or in compressed files the next valid gzip member, goes on from
there, and reports the bytes in between as a quarantined gap; log_gaps writes these to a table of their own.
"""

from __future__ import annotations

import base64
import binascii
import datetime
import hashlib
import logging
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"
RECORD = "file string, start long, end long, type string, headers map<string,string>, payload_bytes long, payload_digest string, payload binary, problem string, inner_start long, inner_end long"


@dataclass
class Record:
    """A record, or with problem set a quarantined gap, of bytes start to end of a file. inner: the bytes of the content of
    the gzip member at start to end, for records and gaps inside one."""

    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    problem: str | None = None
    inner: tuple[int | None, int | None] = (None, None)


def digest_fits(said: str, data: bytes) -> bool:
    """Whether a labelled digest (sha1:..., in hexadecimal of either case or base32) is that of the data. True where none is
    said, or one that cannot be checked: of an unknown algorithm, or not of its length in either form."""
    name, colon, value = said.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    if not colon or name not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return True
    own = hashlib.new(name, data).digest()
    try:
        want = bytes.fromhex(value) if len(value) == 2 * len(own) else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return True
    return len(want) != len(own) or want == own


def http_body(block: bytes, content_type: str) -> bytes:
    """The payload of a block: what follows the HTTP head, where the type says that there is one; else the block."""
    at = block.find(END) if content_type.lower().startswith("application/http") else -1
    return block if at < 0 else block[at + len(END) :]


def _one(data: bytes, at: int, stop: int | None = None) -> tuple[Record | None, str, int]:
    """The record at an offset, or None, what is wrong, and an offset up to which a version line fails for the same reason.

    stop: where the next end of headers is, if that is known (-1: nowhere).
    """
    if not VERSION.match(data, at):
        return None, "no version line", at
    stop = data.find(END, at) if stop is None else stop
    if stop < 0:
        return None, "no end of headers", len(data)
    headers: dict[str, str] = {}
    places: dict[str, int] = {}
    name, line = "", data.find(b"\r\n", at) + 2
    while line < stop:
        after = data.find(b"\r\n", line, stop)
        after = stop if after < 0 else after
        text = data[line:after]
        if text[:1] in (b" ", b"\t") and name:  # a folded line goes on with the header before
            headers[name] += " " + text.decode("utf-8", "replace").strip()
        else:
            key, colon, value = text.partition(b":")
            if not colon:
                return None, "malformed header", line - 1
            name = key.decode("utf-8", "replace").strip().lower()
            headers[name], places[name] = value.decode("utf-8", "replace").strip(), line
        line = after + 2
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,15}", length):
        return None, "no content length", places.get("content-length", stop)
    body = stop + len(END)
    end = body + int(length)
    if data[end : end + len(END)] != END:
        return None, "content length does not fit", places["content-length"]
    block = data[body:end]
    payload = http_body(block, headers.get("content-type", "")) if headers.get("warc-type") in ("response", "request", "revisit") else block
    if "warc-truncated" not in headers:
        said = headers.get("warc-payload-digest", "")
        # writers differ on whether the HTTP head belongs to the payload; revisits name the digest of what they refer to
        if headers.get("warc-type") != "revisit" and not digest_fits(said, payload) and (len(payload) == len(block) or not digest_fits(said, block)):
            return None, "payload digest differs", min(places["content-length"], places["warc-payload-digest"])
        if not digest_fits(headers.get("warc-block-digest", ""), block):
            return None, "block digest differs", min(places["content-length"], places["warc-block-digest"])
    return Record(at, end + len(END), headers, payload), "", end


def salvage(data: bytes) -> Iterator[Record]:
    """All valid records of an uncompressed file in order, and a Record with problem for every gap between them.

    Where many version lines come before one end of headers, the place of that end and of what is wrong is kept, so that the
    search is linear in the file.
    """
    at, ahead = 0, -1

    def one(at: int) -> tuple[Record | None, str, int]:
        nonlocal ahead
        if 0 <= ahead < at or ahead == -1:
            ahead = data.find(END, at)
            ahead = ahead if ahead >= 0 else -2
        return _one(data, at, ahead if ahead >= 0 else -1)

    while at < len(data):
        got, wrong, until = one(at)
        if got:
            yield got
            at = got.end
            continue
        found = None
        while m := VERSION.search(data, max(until, at) + 1):
            found, _, until = one(m.start())
            if found:
                break
        end = found.start if found else len(data)
        yield Record(at, end, problem=wrong)
        at = end


def _member(data: memoryview, at: int, chunk: int = 1 << 15) -> tuple[bytes, int]:
    """The content of the gzip member at an offset and the offset after it; reads no more than a chunk beyond it."""
    member, out, pos = zlib.decompressobj(31), [], at
    while not member.eof and pos < len(data):
        out.append(member.decompress(data[pos : pos + chunk]))
        pos += chunk
    if not member.eof:
        raise zlib.error("member is cut short")
    return b"".join(out), min(pos, len(data)) - len(member.unused_data)


def salvage_gzip(data: bytes) -> Iterator[Record]:
    """As salvage, for a file of gzip members; offsets are of the compressed file. A member may hold
    many records: inner has their offsets in its content."""
    at, gap, wrong, view = 0, None, "", memoryview(data)
    while at < len(data):
        try:
            if data[at : at + 3] != _GZIP:
                raise zlib.error("no gzip member")
            plain, end = _member(view, at)
        except zlib.error as e:
            gap, wrong = (at, str(e)) if gap is None else (gap, wrong)
            nxt = data.find(_GZIP, at + 1)
            at = nxt if nxt >= 0 else len(data)
            continue
        if gap is not None:
            yield Record(gap, at, problem=wrong)
            gap = None
        for r in salvage(plain):
            yield Record(at, end, r.headers, r.payload, r.problem, (r.start, r.end))
        at = end
    if gap is not None:
        yield Record(gap, len(data), problem=wrong)


def read(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """A row for each record and each quarantined gap (problem is not null) of the files at a path, plain or gzip.

    names: a pattern of file names; files that begin with _ or . are passed over. Folders are searched at any depth. Files
    are read whole, one at a time, so their size (below 2 GB; write makes files of about FILE_BYTES) bounds a task's
    memory. Empty files give no rows.
    """
    def parse(batches: Iterator) -> Iterator:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                data = bytes(data)
                rows = [(name, r.start, r.end, r.headers.get("warc-type"), r.headers, None if r.payload is None else len(r.payload), None if r.payload is None else hashlib.sha1(r.payload).hexdigest(), r.payload, r.problem, *r.inner) for r in (salvage_gzip if data[:2] == _GZIP[:2] else salvage)(data)]
                for at in range(0, len(rows), 500):
                    yield pd.DataFrame(rows[at : at + 500], columns=[c.split()[0] for c in RECORD.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parse, RECORD)


def log_gaps(records: DataFrame, path: str) -> int:
    """Writes the quarantined gaps among records (file, start, end, problem; inner_start and inner_end in the content of the
    gzip member at start, for gaps inside one) as JSON and returns their number."""
    gaps = records.where(F.col("problem").isNotNull()).select("file", "start", "end", "inner_start", "inner_end", "problem")
    gaps.write.json(path)
    found = records.sparkSession.read.schema(gaps.schema).json(path).count()
    if found:
        logging.getLogger(__name__).warning("%d gaps in archives are quarantined; they are listed in %s", found, path)
    return found


#: Bytes of an archive file that the writer aims at: payloads are dealt by length, so that long ones get files of few records.
FILE_BYTES = 1 << 26
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the standard


def repeated(pages: DataFrame, key: str, digest: str, length: str, least: int = 1000) -> DataFrame:
    """(digest, refers_to) of payloads of at least so many bytes under more than one key: the largest one."""
    rows = pages.where(F.col(length) >= least).groupBy(digest).agg(F.max(key).alias("refers_to"), F.count("*").alias("__n"))
    return rows.where("__n > 1 and refers_to IS NOT NULL").select(digest, "refers_to")


def record_text(key: Column, url: Column, payload: Column, length: Column, digest: Column, refers: Column, date: str) -> Column:
    """One record without its closing CRLFs; a revisit (refers is not null) has no payload but its length and digest."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " ")
    name = F.coalesce(key.cast("string"), F.lit("none"))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(refers.isNull(), "response").otherwise("revisit"), F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), clean, F.lit("\r\nWARC-Payload-Digest: sha1:"), digest, F.lit("\r\nX-Payload-Length: "), length.cast("string"), F.lit("\r\nContent-Type: text/html"))
    return F.when(refers.isNull(), F.concat(head, F.lit("\r\nContent-Length: "), length.cast("string"), F.lit(END.decode()), payload)).otherwise(F.concat(head, F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">\r\nContent-Length: 0\r\n\r\n")))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 1000, records_per_file: int = 1000, date: str | None = None) -> None:
    """Writes a record for each row; payloads that repeat (least bytes or more) are written once, under the largest key.

    Null html is an empty payload, null urls and keys are written as empty and none. Rows that repeat the largest key
    are each a response. Payload text is written as UTF-8 without any change; a response's block is the payload alone.
    An empty table makes an empty archive; other columns play no part. date: of all records, as in 2020-01-31T00:00:00Z,
    else now. Files hold up to records_per_file records; payloads of more than FILE_BYTES / records_per_file bytes go
    to folders of their own by length (a sixteenfold step each), with fewer records a file.
    """
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.coalesce(F.col(html), F.lit("")).alias("p"))
    rows = rows.withColumns({"n": F.octet_length("p").cast("long"), "d": F.sha1(F.encode("p", "UTF-8"))})
    last = store.sent(store.pinned(repeated(rows.select("k", "d", "n"), "k", "d", "n", least).withColumnRenamed("d", "rd")), 1_000_000)
    keyed = rows.join(last, (F.col("n") >= least) & (F.col("d") == F.col("rd")), "left")
    refers = F.when(~F.col("k").eqNullSafe(F.col("refers_to")), F.col("refers_to"))
    made = keyed.select("n", record_text(F.col("k"), F.col("u"), F.col("p"), F.col("n"), F.col("d"), refers, date).alias("value"))
    longest = rows.agg(F.max("n")).first()[0] or 0
    low, high, several = -1, max(1, FILE_BYTES // records_per_file), records_per_file
    while low < longest or low < 0:
        part = made.where((F.col("n") > low) & (F.col("n") <= high)).select("value")
        part.write.option("lineSep", END.decode()).option("maxRecordsPerFile", several).text(f"{path.rstrip('/')}/to-{high}")
        low, high, several = high, high * 16, max(1, several // 16)
