"""Legacy ARC archives converted to WARC, and both read and written by Spark."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.frames import written
from recordlake.session import scratch_dir

ARCHIVE_BYTES = 16 << 20  # uncompressed, after which an archive is closed
TASK_BYTES = 128 << 20  # of payloads, uncompressed, that a task rewrites on average
MIN_REVISIT_BYTES = 100
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: RFC 4122, URLs
LEVEL = 1
HEAD_END = re.compile(rb"\r?\n\r?\n")
PIECE = 1 << 16  # bytes of an archive inflated at once
MAX_HEADER = 1 << 20
# fixed values: the fields of an ARC record's header line, by version
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def gunzip_members(data: bytes) -> Iterator[bytes]:
    """The records of an archive that has one gzip member for each."""
    while data:
        unpacker = zlib.decompressobj(31)
        record = unpacker.decompress(data) + unpacker.flush()
        if not unpacker.eof:
            raise ValueError("an archive ends within a member")
        yield record
        # between members and at the end of a file, zeros are padding
        data = unpacker.unused_data.lstrip(b"\x00")


def inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive in pieces; of a gzipped one, those of all its members in turn."""
    gzipped = content[:2] == b"\x1f\x8b"
    unpacker, at = None, 0
    while at < len(content):
        piece = content[at : at + PIECE]
        if not gzipped:
            at += len(piece)
            yield piece
            continue
        unpacker = unpacker or zlib.decompressobj(31)
        yield unpacker.decompress(piece)
        at += len(piece) - len(unpacker.unused_data)
        if unpacker.eof:
            unpacker = None
            # between members and at the end of a file, zeros are padding
            while at < len(content) and content[at] == 0:
                at += 1
    if unpacker:
        raise ValueError("an archive ends within a member")


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, header fields, body) of every record of an ARC archive but its version block.

    The archive may be plain, gzipped as a whole, or have gzip members of one or
    more records each: the inflated bytes are walked by header line and
    declared length, and line ends between records and zeros are skipped. What
    is neither raises.
    """
    pieces, held, at, version = inflated(content), bytearray(), 0, None

    def more() -> bool:
        nonlocal at
        piece = next(pieces, None)
        if piece is None:
            return False
        del held[:at]
        at = 0
        held.extend(piece)
        return True

    place = -1
    while True:
        while at < len(held) and held[at] in b"\r\n\x00":
            at += 1
        if at == len(held):
            if more():
                continue
            return
        while (end := held.find(b"\n", at)) < 0:
            if len(held) - at > MAX_HEADER or not more():
                raise ValueError(f"bytes left over: {bytes(held[at : at + 200])!r}")
        line = bytes(held[at : end + 1])
        length = line.rsplit(b" ", 1)[-1].strip()
        if not length.isdigit():
            raise ValueError(f"no length in an ARC header: {line[:200]!r}")
        at = end + 1
        while len(held) - at < int(length):
            if not more():
                raise ValueError(f"{int(length)} bytes declared, {len(held) - at} there: {line[:200]!r}")
        record = line + bytes(held[at : at + int(length)])
        at += int(length)
        place += 1
        # archives that were joined have a version block each
        if version is None or line.startswith(b"filedesc://"):
            version = arc_version(record)
            continue
        yield place, *parse_arc(record, version)


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The record every ARC archive starts with; it names the fields of the others."""
    body = f"{version} 0 recordlake\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body)


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes) -> bytes:
    clean = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    middle = "" if version == 1 else " 200 - - 0 -"
    return f"{clean} {ip} {date} {mime}{middle} {len(body)}\n".encode() + body + b"\n"


def parse_arc(record: bytes, version: int) -> tuple[dict[str, str], bytes]:
    """Header fields of that version, and the body of just the declared length."""
    line, _, rest = record.partition(b"\n")
    names, values = ARC_FIELDS[version].split(), line.decode("utf-8", "replace").split(" ")
    if len(values) < len(names):
        raise ValueError(f"an ARC {version} header of {len(values)} fields: {line[:200]!r}")
    # blanks may stand in old, unescaped URLs: fields are counted from the end
    cut = len(values) - len(names) + 1
    fields = dict(zip(names, [" ".join(values[:cut]), *values[cut:]]))
    length = int(fields["Archive-length"])
    if len(rest) < length:
        raise ValueError(f"{length} bytes declared, {len(rest)} there: {line[:200]!r}")
    return fields, rest[:length]


def arc_version(record: bytes) -> int:
    """The version that an archive's first record declares."""
    body = record.partition(b"\n")[2]
    version = int(body.split(b" ", 1)[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"ARC version {version} is not known")
    return version


def iso_date(date: str) -> str:
    """A 14-digit ARC date as WARC writes it; shorter dates are filled up."""
    full = date + "00000101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(url: str, date: str, key: str) -> str:
    """The same record gets the same identifier, however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {date} {key}')}>"


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """HTTP header as it stands, its fields by lower-case name, and the payload.

    Lines may end in LF alone. A block that does not start as HTTP has no
    header, and one whose header does not end no payload.
    """
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    end = HEAD_END.search(block)
    head = block[: end.end()] if end else block
    fields = {}
    for line in head.splitlines()[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    return head, fields, block[len(head) :]


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return (
        f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    )


def parse_warc(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {record[:80]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if len(rest) < length:
        raise ValueError(f"{length} bytes declared, {len(rest)} there")
    return fields, rest[:length]


def write_archives(blobs: DataFrame, path: str) -> None:
    """One file for each row of ``content``; the bytes are written as they are.

    Spark's text writer ends each row with a separator; a zero byte is padding
    to every reader of gzip.
    """
    (
        blobs.select(F.col("content").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("lineSep", "\u0000")
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every archive under ``path``."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def archives_of(
    records: Iterator[bytes], opening: Callable[[bytes], bytes], size: int
) -> Iterator[bytes]:
    """Records as gzip members, gathered into archives of about ``size`` bytes each.

    ``opening`` makes the record an archive starts with from the first of the others.
    """
    parts, held = [], 0
    for record in records:
        if not parts:
            parts.append(gzip_member(opening(record)))
        parts.append(gzip_member(record))
        held += len(record)
        if held >= size:
            yield b"".join(parts)
            parts, held = [], 0
    if parts:
        yield b"".join(parts)


def blobs(contents: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for content in contents:
        yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])


def pages_to_arc(
    pages: DataFrame,
    version: int,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "20000101000000",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Pages as ARC archives of ``version``, one a row; their HTTP header holds the page id."""
    sent = pages.select(
        F.col(f"`{page_id}`").cast("string").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.col(f"`{html}`").alias("html"),
    )

    def records(batches):
        for batch in batches:
            for page, address, text in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (text or "").encode("utf-8", "surrogatepass")
                head = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {len(payload)}\r\n"
                    + (f"X-Page-Id: {page}\r\n" if page is not None else "")
                    + "\r\n"
                ).encode()
                yield arc_record(
                    version, address or "-", "0.0.0.0", date, "text/html", head + payload
                )

    def run(batches):
        opening = arc_version_block(version, "pages.arc", date)
        yield from blobs(archives_of(records(batches), lambda _: opening, archive_bytes))

    return sent.mapInArrow(run, "content binary")


FACTS = (
    "archive string, place int, page_id bigint, url string, date string, digest string, "
    "payload_bytes bigint"
)


def page_of(http: dict[str, str]) -> int | None:
    page = http.get("x-page-id", "")
    return int(page) if re.fullmatch(r"-?[0-9]{1,18}", page) else None


def facts_of(archives: DataFrame) -> DataFrame:
    """What tells equal payloads apart: a few values for each record of ARC archives."""
    names = [f.split()[0] for f in FACTS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 3, pa.int64()]

    def rows(path, content):
        for place, fields, block in arc_records(content):
            _, http, payload = http_parts(block)
            yield (
                path,
                place,
                page_of(http),
                fields["URL"],
                iso_date(fields["Archive-date"]),
                hashlib.sha256(payload).hexdigest(),
                len(payload),
            )

    def run(batches):
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns)):
                columns = list(zip(*rows(path, content))) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
                )

    return archives.select("path", "content").mapInArrow(run, FACTS)


def warc_of(fields: dict[str, str], block: bytes, of: dict | None) -> bytes:
    """One ARC record as a WARC record; a revisit of ``of`` if that is given.

    A block with an HTTP head is a response; any other, such as an answer of
    ``dns:`` or a page stored without its head, is a resource of the ARC
    record's type.
    """
    head, http, payload = http_parts(block)
    date, digest = iso_date(fields["Archive-date"]), hashlib.sha256(payload).hexdigest()
    kind = "application/http; msgtype=response" if head else fields["Content-type"]
    out = {
        "WARC-Type": "response" if head else "resource",
        "WARC-Record-ID": record_id(fields["URL"], date, key_of(page_of(http), digest)),
        "WARC-Date": date,
        "WARC-Target-URI": fields["URL"],
        "WARC-IP-Address": fields["IP-address"],
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": kind,
    }
    if of is None:
        return warc_record(out, block)
    out |= {
        "WARC-Type": "revisit",
        "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
        "WARC-Refers-To": record_id(of["url"], of["date"], key_of(of["page_id"], digest)),
        "WARC-Refers-To-Target-URI": of["url"],
        "WARC-Refers-To-Date": of["date"],
        # no field of the format has it, and a head need not tell it
        "X-Payload-Bytes": str(len(payload)),
    }
    if of["page_id"] is not None:
        out["X-Refers-To-Page-Id"] = str(of["page_id"])
    return warc_record(out, head)


def key_of(page_id: int | None, digest: str) -> str:
    return digest if page_id is None else str(page_id)


def warcinfo(first: bytes) -> bytes:
    """The record that opens a WARC archive, named after the archive's first record."""
    own = uuid.uuid5(NAMESPACE, hashlib.sha256(first).hexdigest())
    return warc_record(
        {
            "WARC-Type": "warcinfo",
            "WARC-Record-ID": f"<urn:uuid:{own}>",
            "WARC-Date": "2000-01-01T00:00:00Z",
            "Content-Type": "application/warc-fields",
        },
        b"software: recordlake\r\nformat: WARC File Format 1.0\r\n",
    )


def arc_to_warc(
    archives: DataFrame,
    *,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """ARC archives (path, content) as WARC archives, one or more rows of ``content`` for each.

    Each archive's first record tells its version; header lines are read by
    its fields, and their declared lengths find the next one, in plain files,
    files gzipped whole and files of one or more gzip members alike. Bytes that
    are no record raise. WARC identifiers follow from URL, date and page (of a
    record without page id, from its digest, so that equal records share one),
    dates are rewritten, and payload digests computed. A record with an HTTP
    head is a response, one without a resource; a body is kept as it was sent,
    chunked or not. Of records whose payloads of at least
    ``min_revisit_bytes`` bytes are equal, the one with the smallest page id
    stays (of several, or of records without id, the first by archive and
    place); the others become revisits of it, without payload.

    Archives are read twice: narrowly for a few facts of each record, then
    whole, each beside the list of its own revisits. Facts alone are compared;
    a digest that very many records share is summed up before the shuffle.
    An archive moves once, as it is stored, to one of as many tasks as the payloads
    need at ``TASK_BYTES`` each, or as the session sets for shuffles, if those are more.
    """
    facts = written(facts_of(archives), "arc-facts")
    held = facts.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0]
    tasks = -(-held // TASK_BYTES)
    order = F.struct(
        F.col("page_id").isNull().alias("none"), "page_id", "archive", "place", "url", "date"
    )
    long = facts.where(F.col("payload_bytes") >= min_revisit_bytes)
    first = (
        long.groupBy("digest")
        .agg(F.min(order).alias("of"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "of")
    )
    itself = (F.col("archive") == F.col("of.archive")) & (F.col("place") == F.col("of.place"))
    # many records may share a digest; theirs are few and short rows
    lists = (
        long.join(first, "digest")
        .where(~itself)
        .groupBy(F.col("archive").alias("path"))
        .agg(F.collect_list(F.struct("place", "of.page_id", "of.url", "of.date")).alias("revisits"))
    )
    sides = [archives.select("path", "content"), written(lists, "revisits")]
    if tasks > int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # Spark would not go beyond its own number; below it, it joins small partitions itself
        sides = [side.repartition(tasks, "path") for side in sides]
    joined = sides[0].join(sides[1].hint("merge"), "path", "left")

    def warc(content, revisits):
        known = {r["place"]: r for r in revisits or ()}
        for place, fields, block in arc_records(content):
            yield warc_of(fields, block, known.get(place))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                content, revisits = (batch.column(i)[row].as_py() for i in (1, 2))
                yield from blobs(archives_of(warc(content, revisits), warcinfo, archive_bytes))

    return joined.select("path", "content", "revisits").mapInArrow(run, "content binary")


WARC_ROW = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, warc_date string, record_id string"
)


def read_warc(archives: DataFrame) -> DataFrame:
    """One row per response, resource or revisit of WARC archives (path, content).

    The payload of a response or resource is measured and hashed, and must have
    the digest that its header gives, if that is a SHA-256. A revisit's digest
    and length are those its headers give (a length that none gives is null),
    and so is the page it refers to.
    """
    names = [f.split()[0] for f in WARC_ROW.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]

    def rows(content):
        for record in gunzip_members(content):
            fields, block = parse_warc(record)
            kind = fields["WARC-Type"]
            if kind not in ("response", "resource", "revisit"):
                continue
            _, http, payload = http_parts(block)
            named = fields.get("WARC-Payload-Digest", "")
            if kind == "revisit":
                digest = named.removeprefix("sha256:") or None
                length = fields.get("X-Payload-Bytes", http.get("content-length", ""))
                length = int(length) if length.isdigit() else None
            else:
                digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                if named.startswith("sha256:") and named != f"sha256:{digest}":
                    raise ValueError(f"the payload of {fields['WARC-Record-ID']} has another digest")
            of = fields.get("X-Refers-To-Page-Id")
            yield (
                page_of(http),
                length,
                digest,
                kind,
                None if of is None else int(of),
                fields["WARC-Target-URI"],
                fields["WARC-Date"],
                fields["WARC-Record-ID"],
            )

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                columns = list(zip(*rows(content))) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
                )

    return archives.select("content").mapInArrow(run, WARC_ROW)


def pages_through_warc(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write pages as ARC archives of both versions, convert them, and read the WARC back.

    Pages go to version 1 or 2 by a hash of their URL. A null html is an empty
    payload, a null URL is written "-", a null page id is left out and comes
    back null. Repeated rows stay repeated; an empty table writes no archive
    and gives no rows; columns other than the three are not carried.
    """
    spark = pages.sparkSession
    names = {"page_id": page_id, "url": url, "html": html}
    legacy = scratch_dir(spark, "arc")
    kind = F.pmod(F.xxhash64(F.col(f"`{url}`")), F.lit(2)) + 1
    for version in ARC_FIELDS:
        own = pages.where(kind == version)
        write_archives(
            pages_to_arc(own, version, archive_bytes=archive_bytes, **names),
            f"{legacy}/version={version}",
        )
    arcs = read_archives(spark, f"{legacy}/version=*")
    path = scratch_dir(spark, "warc")
    write_archives(arc_to_warc(arcs, archive_bytes=archive_bytes), path)
    return read_warc(read_archives(spark, path))
