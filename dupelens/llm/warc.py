"""WARC archives without repeated payloads: writing, reading back, and resolving revisit records.

**Writing.** Only headers (id, address, digest, length) are shuffled, by payload digest: the least row of a digest becomes its
response record, the others become revisit records, which need no payload. Payloads stay where they are read, but for
those whose digest may be repeated: a bitmap of fixed size over the hashes of the repeated digests is broadcast, so unique
payloads go straight from the scan to an archive. Of a repeated payload each task sends one copy, however often it occurs.
An archive holds about ``archive_bytes`` (and at least one record); it is one row of a text sink that writes one row per
file, so Spark's commit protocol keeps the archives of a lost or repeated task from being seen.

**Reading.** Each archive is parsed by the lengths its headers state, so a payload may hold any bytes, also those of a
WARC header. Digests and lengths are worked out again from the payloads.

**Resolving.** Headers are shuffled by payload digest, and revisit records joined to the least response of their digest.

Records carry fresh headers: ids, the date of the writing, digests, lengths, and for revisits the id and address of the record
they refer to. The row's own id goes along as ``X-Row-Id``. Bytes of addresses that may not stand in a header are escaped by per cent.

Defined cases: a null payload is an empty one, which is a payload like any other; a null address leaves its header out and is
null again when read; null ids come last in the order, so they are a response only where no copy has an id; of rows equal in id,
address and payload one is the response and the others revisit it. An empty table gives no records. Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dupelens.llm.tables import keep, shared_dir

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Bits of the bitmap for each repeated digest, and the most that it may have (8 MB).
BITS_EACH, MOST_BITS = 16, 1 << 26
WORD_BITS = 32_768


@dataclass(frozen=True)
class Rule:
    """Payloads of at least ``least_bytes`` are kept once; archives hold about ``archive_bytes``."""

    least_bytes: int = 0
    archive_bytes: int = 16 << 20


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32, without a prefix: ten hex digits are eight digits of base 32."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def captures(rows: DataFrame, key: str = "page_id", address: str = "url", payload: str = "html") -> DataFrame:
    """``(id, uri, payload, bytes, digest)`` of every row."""
    plain = rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(address).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    return plain.select("*", F.length("payload").cast("long").alias("bytes"), payload_digest(F.col("payload")).alias("digest"))


def _rank() -> Column:
    """The order of the rows of one digest: by id, then address, nulls last."""
    return F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("id"), F.col("uri").isNull().alias("b"), F.col("uri").alias("uri"))


def repeated(headers: DataFrame) -> DataFrame:
    """``(digest, first, bytes)`` of digests that several rows share, with the least of these rows."""
    groups = headers.groupBy("digest").agg(F.sum("n").alias("n"), F.min(_rank()).alias("first"), F.max("bytes").alias("bytes"))
    return groups.where("n > 1").select("digest", F.struct("first.id", "first.uri").alias("first"), "bytes")


def bitmap(digests: DataFrame) -> tuple[DataFrame, int]:
    """``(word, bits)`` with a bit set for each digest, and the number of bits, which is bounded whatever the input."""
    wanted = max(WORD_BITS, BITS_EACH * digests.count())
    size = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    at = F.pmod(F.xxhash64("digest"), F.lit(size))
    places = digests.select(F.floor(at / WORD_BITS).alias("word"), F.pmod(at, F.lit(WORD_BITS)).alias("place"))
    return places.groupBy("word").agg(F.expr("bitmap_construct_agg(place)").alias("bits")), size


def _marked(rows: DataFrame, digests: DataFrame, rule: Rule) -> DataFrame:
    """``rows`` with ``shared``: false where the digest is certainly not among ``digests``."""
    words, size = bitmap(digests)
    at = F.pmod(F.xxhash64("digest"), F.lit(size))
    place = F.pmod(at, F.lit(WORD_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(F.lit(1))
    joined = rows.withColumn("word", F.floor(at / WORD_BITS)).join(F.broadcast(words), "word", "left")
    shared = F.coalesce(bit == 1, F.lit(False)) & (F.col("bytes") >= rule.least_bytes)
    return joined.select(*rows.columns, shared.alias("shared"))


def records(rows: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``(id, uri, bytes, digest, payload, refers_id, refers_uri, type)``: what is to be written, payloads of responses only."""
    rule = rule or Rule()
    found = captures(rows)
    headers = found.select("id", "uri", "bytes", "digest").groupBy("digest", "bytes", "id", "uri").agg(F.count(F.lit(1)).alias("n"))
    headers = keep(headers, "warc-headers")
    groups = keep(repeated(headers.where(F.col("bytes") >= rule.least_bytes)), "warc-repeated")
    marked = _marked(found, groups.select("digest"), rule)
    single = marked.where("not shared").select("id", "uri", "bytes", "digest", "payload")
    # Payloads of one digest are equal: any of them will do.
    once = marked.where("shared").groupBy("digest").agg(
        F.min(_rank()).alias("first"), F.max("bytes").alias("bytes"), F.first("payload").alias("payload")
    )
    responses = single.unionByName(once.select("first.id", "first.uri", "bytes", "digest", "payload")).select(
        "*", F.lit(None).cast("long").alias("refers_id"), F.lit(None).cast("string").alias("refers_uri"), F.lit("response").alias("type")
    )
    own = F.col("id").eqNullSafe(F.col("first.id")) & F.col("uri").eqNullSafe(F.col("first.uri"))
    others = (
        headers.join(groups.drop("bytes"), "digest")
        .withColumn("n", F.col("n") - own.cast("int"))
        .where("n > 0")
        .withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    )
    revisits = others.select(
        "id", "uri", "bytes", "digest", F.lit(None).cast("binary").alias("payload"),
        F.col("first.id").alias("refers_id"), F.col("first.uri").alias("refers_uri"), F.lit("revisit").alias("type"),
    )
    return responses.unionByName(revisits)


def _named(digest: str, key: int | None, uri: str | None) -> str:
    """The record id of the response of a digest: its revisits, written elsewhere, must know it."""
    seed = "\n".join((digest, "" if key is None else str(key), "-" if uri is None else "+" + uri))
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(seed.encode(errors='surrogateescape')).digest()[:16], version=5)}>"


def escaped(uri: str) -> bytes:
    """The address with all but printable ASCII as per cent escapes."""
    return b"".join(bytes([b]) if 32 < b < 127 else b"%%%02X" % b for b in uri.encode(errors="surrogateescape"))


def record(fields: list[tuple[str, str | bytes | int | None]], block: bytes) -> bytes:
    """One record without the blank lines that end it."""
    lines = [VERSION]
    for name, value in [*fields, ("Content-Length", len(block))]:
        if value is not None:
            lines.append(name.encode() + b": " + (value if isinstance(value, bytes) else str(value).encode()))
    return b"\r\n".join(lines) + END + block


def _formatted(row: dict, date: str, rule: Rule) -> bytes:
    response = row["type"] == "response"
    settled = response and row["bytes"] >= rule.least_bytes
    name = _named(row["digest"], row["id"], row["uri"]) if settled else f"<urn:uuid:{uuid.uuid4()}>"
    fields = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if row["uri"] is None else escaped(row["uri"])),
        ("WARC-Payload-Digest", "sha1:" + row["digest"]),
        ("X-Row-Id", row["id"]),
    ]
    block = HTTP % row["bytes"]
    if response:
        block += row["payload"]
    else:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _named(row["digest"], row["refers_id"], row["refers_uri"])),
            ("WARC-Refers-To-Target-URI", None if row["refers_uri"] is None else escaped(row["refers_uri"])),
        ]
    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    fields += [("WARC-Block-Digest", "sha1:" + sha1), ("Content-Type", "application/http; msgtype=response")]
    return record(fields, block)


def write(rows: DataFrame, path: str, rule: Rule | None = None) -> None:
    """Writes a record per row (``page_id``, ``url``, ``html``) to archives below ``path``."""
    rule = rule or Rule()
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened() -> list[bytes]:
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
            return [record([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")]

        def closed(parts: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(parts)], pa.binary())], names=["value"])

        held, size = opened(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                part = _formatted({name: batch.column(name)[i].as_py() for name in batch.schema.names}, date, rule)
                if size and size + len(part) > rule.archive_bytes:
                    yield closed(held)
                    held, size = opened(), 0
                held.append(part)
                size += len(part)
        if size:
            yield closed(held)

    made = records(rows, rule).mapInArrow(archives, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.option("lineSep", END.decode()).option("maxRecordsPerFile", 1).text(path)


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive. A record that is cut off or broken raises an error."""
    at = 0
    while at < len(archive):
        head = archive.index(END, at)
        first, *lines = archive[at:head].split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.strip().decode(errors="surrogateescape")
        at = head + len(END)
        end = at + int(fields["content-length"])
        if archive[end : end + len(END)] != END:
            raise ValueError(f"the record that ends at byte {end} is cut off")
        yield fields, archive[at:end]
        at = end + len(END)


HEADERS = "id long, uri string, type string, record_id string, refers_record string, bytes long, digest string, intact boolean"


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``HEADERS`` of the response and revisit records below ``path``; with ``payloads`` also ``payload``.

    ``digest`` and ``bytes`` of a response come from its payload (``intact``: its header says the same); those of a revisit
    from its header, where the length is not known.
    """
    schema = HEADERS + (", payload binary" if payloads else "")
    names = [field.split()[0] for field in schema.split(", ")]

    def rows(archive: bytes) -> Iterator[tuple]:
        for fields, block in parsed(archive):
            kind = fields.get("warc-type")
            if kind not in ("response", "revisit"):
                continue
            stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            payload, size, digest = None, None, stated
            if kind == "response":
                payload = block[block.index(END) + len(END) :] if block.startswith(b"HTTP/") else block
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            key = fields.get("x-row-id")
            yield (
                None if key is None else int(key), fields.get("warc-target-uri"), kind, fields.get("warc-record-id"),
                fields.get("warc-refers-to"), size, digest, digest == stated, payload,
            )[: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                found = list(rows(content.as_py()))
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=False)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, schema)


def resolved(headers: DataFrame) -> DataFrame:
    """Headers with ``refers_to``: the id of the least response of the digest, for revisits; their ``bytes`` are that response's.

    A revisit whose payload no archive holds has nulls there.
    """
    responses, revisits = headers.where("type = 'response'"), headers.where("type = 'revisit'")
    originals = responses.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("id"))).alias("first"), F.max("bytes").alias("held")
    )
    joined = revisits.join(originals.select("digest", F.col("first.id").alias("refers_to"), "held"), "digest", "left")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(
        joined.withColumn("bytes", F.col("held")).drop("held")
    )


def archived(pages: DataFrame, rule: Rule | None = None) -> DataFrame:
    """Writes all pages to fresh archives in the shared folder, reads these back and resolves their revisits."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write(pages, path, rule)
    headers = keep(read(spark, path), "warc-read")
    return resolved(headers).select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


#: The same by plain SQL; base 32 from groups of five hex digits.
SQL = f"""with captures as (select page_id, url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
ranked as (select *, row_number() over (partition by payload order by page_id nulls last, url nulls last) as turn,
             first_value(page_id) over (partition by payload order by page_id nulls last, url nulls last) as original from captures)
select page_id, strlen(payload)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
    (((('0x' || substr(h, (i // 4 * 5 + 1)::int, 5))::bigint) >> (15 - i % 4 * 5)::int) & 31)::int + 1, 1)), '') as payload_digest,
  case when turn = 1 then 'response' else 'revisit' end as record_type,
  case when turn > 1 then original end as refers_to from ranked"""
