"""WARC archives: written and read back by Spark, records found by boundary chains.

Writing uses the text writer. A record is a line whose separator is the two
line ends that close every WARC record, so any file system that Spark writes to
will do. Of pages with equal payloads the one with the largest id is a
``response``, the others are ``revisit`` records that refer to it.

Reading cuts the files at every occurrence of the magic ``WARC/1.1``; Spark's
splits make the tasks. A payload may hold the magic, even a whole record, so an
occurrence is only a candidate. Each task reports, for its split, the candidate
offsets and where the record that would begin there would end, if its header
can be parsed. Running sums of the split sizes turn them into file offsets. A
record's end is its successor's start: starting from offset 0, pointer jumping
over the splits (each jump skips a whole split, and the jumps double) tells
where each split is entered, and the split's chain from there gives its true
records. Candidates off the chain are payload; a record that spans several
candidates is put together again from their pieces.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import scratch, ship, stage

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
FEW = 500_000  # rows of about 70 bytes that may be broadcast


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------------------
# writing
# ---------------------------------------------------------------------------

def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = 0) -> None:
    """Write one record a row to WARC files under ``path``.

    Null html is an empty payload, a null url an empty one; a url's line ends
    and blanks are percent-encoded. Payloads below ``least_bytes`` are never
    revisits. Rows that repeat an id and payload are all responses, as none is
    smaller; rows without an id are responses.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), body.alias("body"))
    # sha1 gives hex; base32 follows in the header
    rows = rows.withColumns({"bytes": F.octet_length("body"), "sha": F.sha1(F.col("body").cast("binary"))})
    groups = (rows.where((F.col("bytes") >= least_bytes) & F.col("id").isNotNull()).groupBy("sha")
              .agg(F.max("id").alias("keep"), F.min("id").alias("least")).where("least < keep").select("sha", "keep"))
    revisit = stage(rows.where("id is not null").select("id", "sha").join(groups, "sha").where("id < keep").select("id", "sha", "keep").distinct(),
                    "op5-revisits")
    # payloads stay where they are if the revisits were counted to be few; else both sides meet by id
    out = rows.join(F.broadcast(revisit) if revisit.count() <= FEW else revisit, ["id", "sha"], "left")
    url = F.regexp_replace(F.regexp_replace("url", r"[\r\n]", "%0A"), " ", "%20")
    b32 = base32_of_hex("sha")
    header = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(F.col("keep").isNotNull(), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\nWARC-Payload-Digest: sha1:"), b32,
        F.when(F.col("keep").isNotNull(), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("keep").cast("string"), F.lit(">\r\nWARC-Payload-Length: "), F.col("bytes").cast("string"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "), F.when(F.col("keep").isNotNull(), 0).otherwise(F.col("bytes")).cast("string"), F.lit(END))
    record = F.concat(header, F.when(F.col("keep").isNull(), F.col("body")).otherwise(F.lit("")))
    out.select(record.alias("value")).write.option("lineSep", END).text(path)


def base32_of_hex(col: str):
    """Base32 of a 40-digit hex column: 5 bits at a time of each 10-digit piece."""
    def digit(i: int):
        piece = F.conv(F.substring(F.col(col), 1 + 10 * (i // 8), 10), 16, 10).cast("long")
        index = F.shiftright(piece, 35 - 5 * (i % 8)).bitwiseAND(F.lit(31)).cast("int")
        return F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), index + 1, F.lit(1))
    return F.concat(*[digit(i) for i in range(32)])


# ---------------------------------------------------------------------------
# reading
# ---------------------------------------------------------------------------

def record_end(segment: bytes) -> tuple[int, int] | None:
    """(header bytes, record bytes with the closing line ends) as a candidate's
    header declares them, counted from the magic; None if it can't be parsed."""
    at = segment.find(b"\r\n\r\n")
    if at < 0:
        return None
    for line in segment[:at].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon and name.strip().lower() == b"content-length" and value.strip().isdigit():
            head = len(MAGIC) + at + 4
            return head, head + int(value) + 4
    return None


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: its bytes, and offsets and ends of its candidates, relative
    to the split's first candidate. A magic precedes every segment but a file's first."""
    key, size, offs, ends, first = None, 0, [], [], False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([size], pa.int64()),
             pa.array([np.array(offs, np.int64).tobytes()], pa.binary()), pa.array([np.array(ends, np.int64).tobytes()], pa.binary())],
            ["file", "split", "size", "offs", "ends"])

    for b in batches:
        for f, s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if (f, s) != key:
                if key is not None:
                    yield row()
                key, size, offs, ends, first = (f, s), 0, [], [], s == 0
            if first:  # what stands before the first magic: nothing in a sound file
                first = False
                size += len(v.as_buffer())
                continue
            segment = v.as_buffer().to_pybytes()
            got = record_end(segment)
            if got:
                offs.append(size)
                ends.append(size + got[1])
            size += len(MAGIC) + len(segment)
    if key is not None:
        yield row()


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each candidate with the first place behind the split that its chain leads to (-1: nowhere)."""
    for b in batches:
        for f, s, base, size, o, e in zip(*(c.to_pylist() for c in b.columns)):
            offs, ends = np.frombuffer(o, np.int64) + base, np.frombuffer(e, np.int64) + base
            place = {x: i for i, x in enumerate(offs.tolist())}
            out = np.empty(len(offs), np.int64)
            for i in range(len(offs) - 1, -1, -1):
                end = int(ends[i])
                out[i] = end if end >= base + size else out[place[end]] if end in place else -1
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(offs)), pa.array(offs), pa.array(out)], ["file", "at", "next"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a split, from where the file's chain enters it."""
    for b in batches:
        for f, s, base, size, o, e, entry in zip(*(c.to_pylist() for c in b.columns)):
            offs, ends = np.frombuffer(o, np.int64) + base, np.frombuffer(e, np.int64) + base
            place = dict(zip(offs.tolist(), ends.tolist()))
            at, got = entry, []
            while at in place:
                got.append(at)
                at = place[at]
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(got), pa.string()), pa.array(got, pa.int64()),
                                              pa.array([place[g] for g in got], pa.int64())], ["file", "at", "end"])


_FIELDS = [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
           ("record_id", pa.string()), ("url", pa.string()), ("sound", pa.bool_())]
_FIELDS_SQL = "payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, sound boolean"


def _parse(record: bytes) -> dict:
    """The fields of a record, given from behind its magic to before its closing
    line ends. ``sound``: a response's payload has its digest, and a revisit all its fields."""
    try:
        at = record.index(b"\r\n\r\n")
        head = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in record[:at].decode().split("\r\n"))}
        kind, payload = head["warc-type"], record[at + 4:]
        out = {"payload_digest": head["warc-payload-digest"].removeprefix("sha1:"), "record_type": kind, "record_id": head["warc-record-id"],
               "url": head["warc-target-uri"]}
        if kind == "response":
            return out | {"payload_bytes": len(payload), "refers_to": None, "sound": digest(payload) == out["payload_digest"]}
        return out | {"payload_bytes": int(head["warc-payload-length"]), "sound": True,
                      "refers_to": int(head["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">"))}
    except (ValueError, KeyError):
        return {"sound": False}


def _segments(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """A row a segment with its offset in the split: its fields if it is a whole
    record, or (not ``whole``) the segment itself."""
    key, size, first = None, 0, False
    for b in batches:
        rows = []
        for f, s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if (f, s) != key:
                key, size, first = (f, s), 0, s == 0
            n = len(v.as_buffer())
            if first:
                first = False
                size += n
                continue
            row = {"file": f, "split": s, "rel": size, "n": len(MAGIC) + n}
            if not whole:
                row["value"] = v.as_buffer().to_pybytes()
            else:
                segment = v.as_buffer().to_pybytes()
                got = record_end(segment)
                if got and got[1] == row["n"]:
                    row |= _parse(segment[:-4])
            rows.append(row)
            size += len(MAGIC) + n
        place = [("file", pa.string()), ("split", pa.int64()), ("rel", pa.int64()), ("n", pa.int64())]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(place + (_FIELDS if whole else [("value", pa.binary())])))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records put together from their pieces (bytes, pieces)."""
    for b in batches:
        out = [_parse(MAGIC.encode().join(p)[:n - len(MAGIC) - 4]) for n, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield pa.RecordBatch.from_pylist(out, pa.schema(_FIELDS))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``: payload_bytes,
    payload_digest, record_type, refers_to, record_id, url. A response whose
    payload doesn't have its digest raises; so does a file whose chain doesn't
    reach its end. No files give no rows."""
    ship(spark)
    text = spark.read.option("lineSep", MAGIC).text(path)
    # offsets inside the split, from the order in which the reader gives its segments
    seg = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    splits = stage(seg.mapInArrow(_splits, "file string, split long, size long, offs binary, ends binary"), "op5-splits")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    based = stage(splits.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
                  .select("file", "split", "base", "size", "offs", "ends"), "op5-based")
    jump = stage(based.mapInArrow(_nodes, "file string, at long, next long").where("next >= 0"), "op5-jump")
    entered = stage(based.where("split = 0").select("file", F.lit(0).cast("long").alias("at")), "op5-entered")
    # entered holds the splits' entries up to 2^k splits from the start, jump leads 2^k splits on
    while True:
        more = entered.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        grown = stage(entered.unionByName(more).distinct(), "op5-entered")
        if grown.count() == entered.count():
            break
        entered = grown
        j = jump.withColumnRenamed("next", "mid")
        jump = stage(j.join(jump.selectExpr("file", "at mid", "next"), ["file", "mid"]).select("file", "at", "next"), "op5-jump")
    total = based.groupBy("file").agg(F.sum("size").alias("total"))
    lost = total.join(entered.withColumnRenamed("at", "total"), ["file", "total"], "left_anti").where("total > 0")
    bad = lost.take(1)
    if bad:
        raise ValueError(f"{bad[0]['file']}: the chain of records does not reach the end of the file")
    # an entry belongs to the split that holds its offset
    entry = based.join(entered, "file").where("at >= base and at < base + size").groupBy("file", "split").agg(F.min("at").alias("entry"))
    true = stage(based.join(entry, ["file", "split"]).select("file", "split", "base", "size", "offs", "ends", "entry")
                 .mapInArrow(_chain, "file string, at long, end long"), "op5-true")

    # what each segment says, without its payload, joined to the chain
    narrow = seg.mapInArrow(lambda it: _segments(it, True), f"file string, split long, rel long, n long, {_FIELDS_SQL}")
    said = narrow.join(based.select("file", "split", "base"), ["file", "split"]).withColumn("at", F.col("base") + F.col("rel"))
    said = stage(said.join(true, ["file", "at"], "left"), "op5-said")
    fields = [f for f, _ in _FIELDS]
    records = said.where("end = at + n").select(*fields)
    # records with the magic in their payload are put together from the segments they cover
    spanned = said.where("end is not null and end <> at + n").select("file", F.col("at").alias("head"), "end")
    parts = said.where("end is null or end <> at + n").select("file", "split", "rel", "at")
    cover = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = stage(parts.join(spanned.withColumn("at", F.col("head")), ["file", "at"], "left")
                  .withColumn("head", F.last("head", ignorenulls=True).over(cover)).withColumn("end", F.last("end", ignorenulls=True).over(cover))
                  .select("file", "split", "rel", "at", "head", "end"), "op5-parts")
    n = parts.count()
    if n:
        values = seg.mapInArrow(lambda it: _segments(it, False), "file string, split long, rel long, n long, value binary")
        both = values.join(F.broadcast(parts) if n <= FEW else parts, ["file", "split", "rel"])
        whole = both.groupBy("file", "head").agg(F.max("end").alias("end"), F.sort_array(F.collect_list(F.struct("at", "value"))).alias("p"))
        records = records.unionByName(whole.select((F.col("end") - F.col("head")).alias("n"), F.transform("p", lambda x: x["value"]).alias("pieces"))
                                      .mapInArrow(_records, _FIELDS_SQL))
    fault = F.raise_error(F.concat(F.lit("a record is damaged: "), F.coalesce("record_id", F.lit("unknown"))))
    return records.withColumn("record_type", F.when(F.col("sound"), F.col("record_type")).otherwise(fault)).drop("sound")


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "op5-warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    out = read_warc(spark, path)
    page = F.regexp_extract("record_id", r"<urn:page:(-?\d+)>", 1).cast("long")
    return out.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
