"""WARC archives: written with revisits, segments and chunked framing, and read back whole.

Writing: one record per page. A payload longer than a segment is cut into a first record and
continuation records. Reading: continuation records are grouped by the record they continue, put in
the order of their segment numbers, checked against the stated total length, and the chunked
transfer framing of the joined block is decoded.

Defined results
- Null html: an empty payload. Null ids and urls are written as absent headers and read back null.
- Every row is a record of its own and is read back as one row, also of rows that agree in id, url and
  payload.
- Of records with equal payloads of revisit_bytes or more, that of the largest id is the response, the
  others revisit it (repeated rows of that id are responses too; of them the largest record id is
  referred to).
- A record whose segments are incomplete, out of number or of another total length than stated, or
  whose framing is broken, is read with a null payload and the fault in column `fault`.
- Empty tables: no rows. Other columns, whatever their names, are not archived.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import settle
from headway.session import scratch_dir

END = b"\r\n\r\n"
#: Copies of a row that are made again at once.
COPIES = 1_000
PARSED = (
    "record_id string, type string, origin string, segment int, total long, refers_to string, "
    "page_id long, url string, digest string, block binary, fault string"
)


# -- writing ---------------------------------------------------------------------------------


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Page rows with the payload, its SHA-1 digest and a record id made of what identifies them."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    out = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    named = out.withColumn("name", F.sha2(F.to_json(F.struct("page_id", "url", "digest")), 256))
    repeated = settle(named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), "warc-copies")
    once = named.join(repeated, "name", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    # Copies of a row are told apart by number. One of them stands for all, combined in the tasks, and is
    # multiplied again in blocks, so that many copies are many tasks' work.
    one = named.join(repeated, "name").groupBy("name").agg(F.first("n").alias("n"), *(F.first(c).alias(c) for c in out.columns))
    blocks = one.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    dealt = blocks.repartition("name", "block")
    last = F.least(F.col("n"), (F.col("block") + 1) * COPIES)
    copies = dealt.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES + 1, last))).select(once.columns)
    numbered = F.when(F.col("copy") > 1, F.sha2(F.concat_ws("#", "name", "copy"), 256)).otherwise(F.col("name"))
    parts = [F.substring(numbered, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    record_id = F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))
    return once.unionByName(copies).select(*out.columns, record_id.alias("record_id"))


def with_revisits(records: DataFrame, revisit_bytes: int) -> DataFrame:
    """Adds refers_to: the record that holds an equal payload, null for responses.

    The join brings one row per repeated payload to its records. Both of its sides are read
    from shuffles, so that adaptive execution splits the partition of a payload that fills one.
    """
    large = F.col("payload_bytes") >= revisit_bytes
    keeper = F.max(F.struct(F.col("page_id").alias("id"), F.col("record_id").alias("record")))
    repeated = (
        records.where(large)
        .groupBy("digest", "payload_bytes")
        .agg(keeper.alias("keeper"), F.min("record_id").alias("least"), F.max("record_id").alias("greatest"))
        .where(F.col("least") != F.col("greatest"))
        .select("digest", "payload_bytes", F.col("keeper.record").alias("holder"), F.col("keeper.id").alias("holder_id"))
    )
    repeated = settle(repeated, "warc-repeated")
    joined = records.join(repeated, ["digest", "payload_bytes"], "left")
    other = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder_id"))
    return joined.select(*records.columns, F.when(other, F.col("holder")).alias("refers_to"))


def _block(payload: bytes, chunk: int) -> bytes:
    """An HTTP response whose body is in chunked framing."""
    parts = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"]
    for at in range(0, len(payload), chunk):
        piece = payload[at : at + chunk]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    parts.append(b"0\r\n\r\n")
    return b"".join(parts)


def _record(kind: str, record_id: str, row: dict, block: bytes, more: dict[str, object]) -> bytes:
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>"}
    if row["url"] is not None and kind != "continuation":
        headers["WARC-Target-URI"] = row["url"].replace("\r", "%0D").replace("\n", "%0A")
    if kind != "continuation":
        headers["WARC-Payload-Digest"] = f"sha1:{row['digest']}"
        if row["page_id"] is not None:
            headers["X-Page-ID"] = row["page_id"]
    headers |= more | {"Content-Length": len(block)}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def page_records(row: dict, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one capture, without the line ends that close a record."""
    if row["refers_to"] is not None:
        refers = {"WARC-Refers-To": f"<{row['refers_to']}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        return [_record("revisit", row["record_id"], row, b"", refers)]
    block = _block(row["payload"], chunk_bytes)
    cut = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(cut) == 1:
        return [_record("response", row["record_id"], row, block, {})]
    out = [_record("response", row["record_id"], row, cut[0], {"WARC-Segment-Number": 1})]
    for number, piece in enumerate(cut[1:], 2):
        more: dict[str, object] = {"WARC-Segment-Number": number, "WARC-Segment-Origin-ID": f"<{row['record_id']}>"}
        if number == len(cut):
            more["WARC-Segment-Total-Length"] = len(block)
        out.append(_record("continuation", f"{row['record_id']}-{number}", row, piece, more))
    return out


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_bytes: int = 1000,
    segment_bytes: int = 16_384,
    chunk_bytes: int = 4_096,
    records_per_file: int = 20_000,
) -> None:
    """Writes the pages as plain WARC files under path.

    Spark's text writer puts the bytes of each record and then the two line ends that close it,
    so that the files are written, retried and committed like any other of its outputs.
    records_per_file bounds the size of a file, which is read as one row.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pylist()
                out = [r for row in rows for r in page_records(row, segment_bytes, chunk_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    marked = with_revisits(captures(pages, id_col, url_col, html_col), revisit_bytes)
    (
        marked.mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


# -- reading ---------------------------------------------------------------------------------


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive, each found by the stated length of the one before."""
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            yield {"fault": f"no record at byte {at}"}
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        bare = lambda name: head[name].strip("<>") if name in head else None
        number = lambda name: int(head[name]) if head.get(name, "").lstrip("-").isdigit() else None
        length = number("content-length")
        start = end + len(END)
        if length is None or start + length > len(data):
            yield {"record_id": bare("warc-record-id"), "fault": "cut off"}
            return
        yield {
            "record_id": bare("warc-record-id"),
            "type": head.get("warc-type"),
            "origin": bare("warc-segment-origin-id"),
            "segment": number("warc-segment-number"),
            "total": number("warc-segment-total-length"),
            "refers_to": bare("warc-refers-to"),
            "page_id": number("x-page-id"),
            "url": head.get("warc-target-uri"),
            "digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "block": data[start : start + length],
            "fault": None,
        }
        at = start + length + len(END)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under path, segments apart."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                size = 0
                for record in parse(content.as_py()):
                    rows.append(record)
                    size += len(record.get("block") or b"")
                    if size > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=parsed)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=parsed)

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    parsed = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in PARSED.split(", "))])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, PARSED)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record: its segments joined in order and checked, continuations gone.

    Only segmented records are shuffled. A segment that was read twice counts once.
    """
    whole = records.where(F.col("segment").isNull() & ~F.col("type").eqNullSafe("continuation"))
    cut = records.where(F.col("segment").isNotNull() | F.col("type").eqNullSafe("continuation"))
    heads = ["type", "page_id", "url", "digest", "refers_to"]
    part = F.struct("segment", "block", "total", "fault", *heads)
    joined = (
        cut.groupBy(F.coalesce("origin", "record_id").alias("record_id"))
        .agg(F.array_sort(F.collect_set(part)).alias("parts"))
        .withColumn("n", F.size("parts"))
        .withColumn("head", F.element_at("parts", 1))
        .withColumn("total", F.element_at("parts", -1)["total"])
        .withColumn(
            "block",
            F.aggregate(
                F.slice("parts", 2, F.greatest(F.col("n") - 1, F.lit(0))),
                F.element_at("parts", 1)["block"],
                lambda got, x: F.concat(got, x["block"]),
            ),
        )
    )
    numbered = F.transform("parts", lambda x: x["segment"]) == F.sequence(F.lit(1), F.col("n"))
    wrong = (
        F.when(~F.coalesce(numbered, F.lit(False)), "segments missing")
        .when(F.col("total").isNull(), "no total length")
        .when(F.col("total") != F.octet_length("block"), "total length differs")
    )
    fault = F.coalesce(F.col("head.fault"), wrong)
    return whole.select("record_id", *heads, "block", "fault").unionByName(
        joined.select("record_id", *[F.col(f"head.{h}").alias(h) for h in heads], "block", fault.alias("fault"))
    )


def unchunk(block: bytes) -> bytes | None:
    """The body of an HTTP response, its chunked framing decoded; null if that is broken."""
    head, found, body = block.partition(END)
    if not found:
        return None
    if not any(
        k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower()
        for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))
    ):
        return body
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            return None
        if size < 0 or line + 2 + size > len(body):
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        at = line + 2 + size
        if body[at : at + 2] != b"\r\n":
            return None
        at += 2


def http_payload(block: Column) -> Column:
    @arrow_udf("binary")
    def decode(blocks: pa.Array) -> pa.Array:
        return pa.array([None if b is None else unchunk(b) for b in blocks.to_pylist()], pa.binary())

    return decode(block)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits under path: record_id, record_type, page_id, url, digest,
    refers_to (a record id), payload (null for revisits and faulty records), fault."""
    whole = reassemble(read_records(spark, path))
    response = F.col("type") == "response"
    decoded = whole.withColumn("payload", http_payload(F.when(response & F.col("fault").isNull(), F.col("block"))))
    broken = response & F.col("payload").isNull()
    differs = F.sha1("payload") != F.col("digest")
    fault = F.coalesce("fault", F.when(broken, "framing"), F.when(response & differs, "digest differs"))
    return decoded.select(
        "record_id",
        F.col("type").alias("record_type"),
        "page_id",
        "url",
        "digest",
        "refers_to",
        "payload",
        fault.alias("fault"),
    )


def round_trip(pages: DataFrame, **options: object) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns what is read back from them."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
