"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Reading splits the files at every occurrence of the version line, also inside payloads. Each task turns the pieces
of its file block into candidates (offset, and successor from the declared lengths), follows successors inside the
block, and emits for each candidate where its chain leaves the block. Pointer jumping over these entry points from
each file's start gives the one entry per block that is real; a candidate counts if the entry's chain passes it
(an interval test on the block's successor tree). So a version line inside a payload never makes a record.

Records whose payload holds the version line come in several pieces; a second scan gathers only these.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from perigee.llm.common import map_rows, table
from perigee.session import fresh_path, stable

MAGIC = "WARC/1.1\r\n"
#: Least payload bytes for which equal payloads are written once.
REVISIT_BYTES = 1000
#: Owners of repeated payloads (about 60 bytes each) that are broadcast; with more of them the join shuffles.
BROADCAST_OWNERS = 100_000


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """One record per row of pages (page_id, url, html), through Spark's text writer.

    The payload is html in UTF-8, null as empty. Among equal payloads of revisit_bytes or more, rows with the
    largest page_id are responses (repeated rows of that id all are), the others revisits. A null page_id is
    smaller than any; where no id is known all are responses.
    """
    pages = pages.select(
        F.col("page_id").cast("string").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"), F.col("page_id").cast("long").alias("number"))
    pages = pages.withColumn("bytes", F.octet_length("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    owners = stable(pages.filter(F.col("bytes") >= revisit_bytes).groupBy(F.col("digest").alias("owned"))
                    .agg(F.max("number").alias("owner"), F.count("*").alias("n")).filter("n > 1 and owner is not null").drop("n"))
    few = owners.limit(BROADCAST_OWNERS + 1).count() <= BROADCAST_OWNERS
    known = pages.join(F.broadcast(owners) if few else owners, (F.col("bytes") >= revisit_bytes) & (F.col("digest") == F.col("owned")), "left")
    revisit = F.col("owner").isNotNull() & ~F.col("number").eqNullSafe(F.col("owner"))
    crlf = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(crlf + crlf))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    url = F.regexp_replace("url", "[\\x00-\\x20<>\\x7F]+", "%20")
    header = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{crlf}WARC-Record-ID: <urn:page:"), F.coalesce("page_id", F.lit("")), F.lit(f">{crlf}WARC-Target-URI: <"), url,
        F.lit(f">{crlf}WARC-Date: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.when(revisit, F.concat(F.lit(f"{crlf}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{crlf}WARC-Refers-To: <urn:page:"),
                                 F.col("owner").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit(f"{crlf}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(f"{crlf}Content-Type: application/http; msgtype=response{crlf}Content-Length: "))
    # the writer's line end completes the blank line after the block
    known.select(F.concat(header, F.octet_length(block).cast("string"), F.lit(crlf + crlf), block, F.lit(crlf)).alias("value")) \
        .write.option("lineSep", crlf).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes, bool]]:
    """file, block, place of the piece in what the block's reader took, piece, and whether a version line precedes it."""
    at, now = 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            file, block, piece = batch["file"][i].as_py(), batch["block"][i].as_py(), batch["value"][i].as_py()
            first = (file, block) != now
            if first:
                at, now = 0, (file, block)
            yield file, block, at, piece, not (first and block == 0)
            at += len(piece) + len(MAGIC)


def _header(piece: bytes) -> dict[str, str] | None:
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in piece[:end].decode("latin-1").split("\r\n"))}
    if not re.fullmatch("[0-9]{1,18}", fields.get("content-length", "")) or "warc-type" not in fields:
        return None
    return fields | {"": str(end + 4)}


def _payload_facts(fields: dict[str, str], block: bytes) -> tuple[int, str]:
    """Bytes and SHA-1 of the payload; those of a revisit stand in its headers."""
    start = block.find(b"\r\n\r\n") + 4
    if fields["warc-type"] == "revisit":
        size = re.search(rb"(?i)content-length:\s*([0-9]+)", block[:start])
        return int(size[1]) if size else 0, fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return len(block) - start, hashlib.sha1(block[start:]).hexdigest()


_RECORD = "type string, id string, uri string, refers_to string, payload_bytes long, payload_digest string"
_CANDIDATE = f"file string, block long, rel long, next long, leaves long, place int, size int, whole boolean, {_RECORD}, payload binary"


def _facts(fields: dict[str, str], block: bytes | None, payload: bool) -> dict:
    size, digest = _payload_facts(fields, block) if block is not None else (None, None)
    data = None
    if payload and block is not None and fields["warc-type"] != "revisit":
        data = block[block.find(b"\r\n\r\n") + 4 :]
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    return {"type": fields["warc-type"], "id": bare("warc-record-id"), "uri": bare("warc-target-uri"), "refers_to": bare("warc-refers-to"),
            "payload_bytes": size, "payload_digest": digest, "payload": data}


def _candidates(pieces: DataFrame, payload: bool) -> DataFrame:
    """Candidates of each block with the place where their chain leaves it; one more row per block with its length."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(_CANDIDATE))

    def closed(rows: list[dict], file: str, block: int, length: int) -> list[dict]:
        index = {r["rel"]: i for i, r in enumerate(rows)}
        parent = [index.get(r["next"], -1) for r in rows]
        size = [1] * len(rows)
        for i, p in enumerate(parent):  # a successor always lies further right
            if p >= 0:
                size[p] += size[i]
        place, free = [0] * len(rows), 0
        used = [1] * len(rows)
        for i in range(len(rows) - 1, -1, -1):
            p = parent[i]
            if p < 0:
                place[i], free = free, free + size[i]
                rows[i]["leaves"] = rows[i]["next"]
            else:
                place[i] = place[p] + used[p]
                used[p] += size[i]
                rows[i]["leaves"] = rows[p]["leaves"]
            rows[i] |= {"place": place[i], "size": size[i]}
        return [*rows, {"file": file, "block": block, "rel": None, "next": length}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        now, length = None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            done = closed(rows, *now, length)
            for i in range(0, len(done), 1000):
                yield pa.RecordBatch.from_pylist(done[i : i + 1000], schema=out)

        for file, block, at, piece, after_magic in _placed(batches):
            if (file, block) != now:
                if now is not None:
                    yield from flush()
                rows, now = [], (file, block)
            length = at + len(piece) + len(MAGIC)
            fields = _header(piece) if after_magic else None
            if fields is None:
                continue
            start, size = int(fields[""]), int(fields["content-length"])
            whole = len(piece) == start + size + 4
            rel = at - len(MAGIC)
            rows.append({"file": file, "block": block, "rel": rel, "next": rel + len(MAGIC) + start + size + 4, "whole": whole}
                        | _facts(fields, piece[start : start + size] if whole else None, payload))
        if now is not None:
            yield from flush()

    return pieces.mapInArrow(run, _CANDIDATE)


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of all archives under path: file, offset, type, id, uri, refers_to, payload_bytes, payload_digest (SHA-1)
    and, if asked for, payload.

    Only records reachable from their file's start are returned. A file whose chain doesn't reach its end is
    damaged: an error names how many there are. No files or empty files give no rows.
    """
    pieces = _pieces(spark, path)
    found = stable(_candidates(pieces, payload))
    lengths = found.filter("rel is null").select("file", "block", F.col("next").alias("taken"))
    so_far = W.partitionBy("file").orderBy("block")
    blocks = stable(lengths.withColumn("base", F.sum("taken").over(so_far) - F.col("taken"))
                    .withColumn("last", F.lead("block").over(so_far).isNull()))
    at = F.col("base") + F.col("rel")
    placed = found.filter("rel is not null").join(blocks.select("file", "block", "base"), ["file", "block"]) \
        .withColumns({"offset": at, "leaves": F.col("base") + F.col("leaves"), "successor": F.col("base") + F.col("next")})

    # entry points: a file's start, and candidates to which some chain leads from another block
    ends = placed.select("file", F.col("leaves").alias("offset")).distinct()
    starts = placed.filter("offset = 0").select("file", "offset")
    entries = stable(placed.select("file", "block", "offset", "leaves", "place")
                     .join(ends.union(starts).distinct(), ["file", "offset"], "left_semi"))
    reached = starts
    jump = stable(entries.select("file", "offset", "leaves").join(
        entries.select("file", F.col("offset").alias("leaves")), ["file", "leaves"], "left_semi"))
    while not jump.isEmpty():  # twice as far in each round
        onward = reached.join(jump, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))
        reached = stable(reached.union(onward).distinct())
        further = jump.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("beyond"))
        jump = stable(jump.join(further, ["file", "leaves"]).select("file", "offset", F.col("beyond").alias("leaves")))
    real = entries.join(reached, ["file", "offset"], "left_semi")
    _require_whole(real, blocks)

    inside = (F.col("entry") >= F.col("place")) & (F.col("entry") < F.col("place") + F.col("size"))
    records = placed.join(real.select("file", "block", F.col("place").alias("entry")), ["file", "block"]).filter(inside)
    columns = ["file", "offset", "type", "id", "uri", "refers_to", "payload_bytes", "payload_digest", *["payload"] * payload]
    broken = stable(records.filter("not whole").select("file", "offset", "successor"))
    whole = records.filter("whole").select(*columns)
    return whole if broken.isEmpty() else whole.union(_gathered(pieces, blocks, broken, payload).select(*columns))


def _require_whole(real: DataFrame, blocks: DataFrame) -> None:
    """Each file with pieces must have a chain that ends where the file ends (the reader counts one line end too many)."""
    size = blocks.filter("last").select("file", (F.col("base") + F.col("taken") - len(MAGIC)).alias("size"))
    reach = real.groupBy("file").agg(F.max("leaves").alias("reach"))
    damaged = size.filter("size > 0").join(reach, "file", "left").filter("reach is null or reach != size").count()
    if damaged:
        raise ValueError(f"{damaged} archive files are damaged: their records don't reach the end")


def _gathered(pieces: DataFrame, blocks: DataFrame, broken: DataFrame, payload: bool) -> DataFrame:
    """Records that the reader cut at version lines inside them, put together from a second scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, at, piece, after_magic in _placed(batches):
            data = (MAGIC.encode() if after_magic else b"") + piece
            yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "rel": [at - len(MAGIC) * after_magic], "data": [data]},
                                             schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("data", pa.binary())]))

    spans = broken.join(blocks, "file").filter("base - 64 < successor and base + taken > offset").select(
        "file", "block", "base", "offset", "successor")
    parts = pieces.mapInArrow(run, "file string, block long, rel long, data binary").join(spans, ["file", "block"]) \
        .withColumn("at", F.col("base") + F.col("rel")).filter("at >= offset and at < successor")
    whole = parts.groupBy("file", "offset").agg(F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts"))

    def task():
        def work(columns):
            out: dict[str, list] = {"file": columns[0], "offset": columns[1]}
            for parts in columns[2]:
                piece = b"".join(p["data"] for p in parts)[len(MAGIC) :]
                fields = _header(piece)
                start, size = int(fields[""]), int(fields["content-length"])
                for k, v in _facts(fields, piece[start : start + size], payload).items():
                    out.setdefault(k, []).append(v)
            return out

        return work

    return map_rows(whole, task, f"file string, offset long, {_RECORD}, payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives, read them back, and return what the records say of each page."""
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)

    def page(c: str) -> Column:
        return F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")

    return read_records(spark, path).select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
