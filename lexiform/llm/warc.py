"""Write web archives, and read them back by verified chains of record boundaries.

Reading does not trust the magic line, which payloads may hold as well. Each task scans its part of
a file for the magic, parses what follows as a header and emits candidate record -> successor links:
the offset of the candidate and the offset where its stated length says that the next one starts.
A task follows the links inside its own part, so that only those that leave it remain; pointer
jumping over these, from the start of each file, finds where the true chain enters every part. Only
records on that chain are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from lexiform.cluster import fresh_path, join_dimension
from lexiform.llm.batches import record_batch

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_BYTES = 100  # smaller payloads are always written whole

RECORD = [
    ("file", StringType()),
    ("block", LongType()),
    ("at", LongType()),  # where the candidate starts, from the start of its part
    ("next", LongType()),  # where its successor starts
    ("leaves", LongType()),  # where the chain from it first leaves the part
    ("record_type", StringType()),
    ("record_id", StringType()),
    ("refers_to", StringType()),
    ("target_uri", StringType()),
    ("stated_digest", StringType()),
    ("stated_bytes", LongType()),
    ("body_at", LongType()),
    ("body_bytes", LongType()),
    ("digest", StringType()),  # of the body, if the magic does not occur in it
]


def identifier(column: Column | str) -> Column:
    """A page's id as a record id; null stays recognisable."""
    column = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))


def header_line(name: str, value: Column) -> Column:
    """A header line without line ends in its value; nothing if the value is null."""
    clean = F.regexp_replace(value, "[\\r\\n]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(
    pages: DataFrame, folder: str, smallest: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z"
) -> None:
    """One record per row of (page_id, url, html).

    A null html is an empty payload. Of the pages that share a payload of at least ``smallest``
    bytes, the one with the smallest page_id is a response and the others are revisits that refer to
    it, pages without an id included; if no page of a payload has an id all are responses. Rows that
    repeat the smallest id are responses too. Other columns are not read. Repeated payloads are
    counted first: a small table of them is broadcast, so that pages stay in place; a larger one is
    joined, and adaptive execution splits its large keys.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
    )
    firsts = (
        rows.filter(F.col("bytes") >= smallest)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    marked = join_dimension(rows, firsts, "digest").withColumn(
        "revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    )
    block = F.when(F.col("revisit"), F.lit("").cast("binary")).otherwise(F.col("payload"))
    header = F.concat(
        F.lit(MAGIC),
        header_line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        header_line("WARC-Record-ID", identifier("page_id")),
        header_line("WARC-Date", F.lit(date)),
        header_line("WARC-Target-URI", F.col("url")),
        header_line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        header_line("Payload-Length", F.col("bytes").cast("string")),
        header_line("WARC-Refers-To", F.when(F.col("revisit"), identifier("first"))),
        header_line("Content-Type", F.lit("text/html")),
        header_line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(header.cast("binary"), block).cast("string")
    marked.select(record.alias("value")).write.option("lineSep", END).text(folder)


def parse_header(head: bytes) -> dict[str, str] | None:
    """Header fields by lower-case name, or null if the lines are not those of a record."""
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode(
            "utf-8", "replace"
        )
    wanted = ("warc-type", "warc-record-id", "content-length")
    if not all(w in fields for w in wanted) or not fields["content-length"].isdigit():
        return None
    return fields


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes between one magic line and the next, part by part of each file, in order."""
    return spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, position from the start of the part, bytes) of each line."""
    part, at = None, 0
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for file, block, line in zip(files, blocks, batch.column("line").to_pylist()):
            if (file, block) != part:
                part, at = (file, block), 0
            yield file, block, at, line
            at += len(line) + len(MAGIC)


def _candidates(schema: StructType):
    names = [n for n, _ in RECORD]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, part, end = [], None, 0
        for file, block, at, line in _positions(batches):
            if (file, block) != part:
                if part:
                    yield done(part, rows, end)
                rows, part = [], (file, block)
            end = at + len(line) + len(MAGIC)
            stop = line.find(END.encode())
            fields = parse_header(line[:stop]) if stop >= 0 and (block or at) else None
            if fields is None:
                continue
            length, body = int(fields["content-length"]), stop + len(END)
            whole = len(line) >= body + length
            digest = hashlib.sha256(line[body : body + length]).hexdigest() if whole else None
            start = at - len(MAGIC)
            stated = fields.get("payload-length", "")
            rows.append(
                (
                    file, block, start, at + body + length + len(END), None,
                    fields["warc-type"], fields["warc-record-id"], fields.get("warc-refers-to"),
                    fields.get("warc-target-uri"),
                    fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                    int(stated) if stated.isdigit() else None, at + body, length, digest,
                )
            )
        if part:
            yield done(part, rows, end)

    def done(part: tuple[str, int], rows: list[tuple], end: int) -> pa.RecordBatch:
        """Rows of a finished part with where their chains leave it, and a first row with its size."""
        leaves: dict[int, int] = {}
        for row in reversed(rows):
            leaves[row[2]] = leaves.get(row[3], row[3])
        rows = [(*r[:4], leaves[r[2]], *r[5:]) for r in rows]
        size = (*part, None, end) + (None,) * (len(names) - 4)  
        return record_batch(schema, dict(zip(names, map(list, zip(size, *rows)))))

    return scan


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records on each file's chain of boundaries.

    Returns file, offset, record_type, record_id, refers_to, target_uri, stated_digest,
    stated_bytes, body_bytes and digest (SHA-256 of the body as read). Magic lines inside payloads
    are no records. Where a chain breaks, nothing after the break is returned. A folder without
    records gives no rows.
    """
    schema = StructType([StructField(n, t) for n, t in RECORD])
    made = fresh_path(spark, "links")
    _lines(spark, folder).mapInArrow(_candidates(schema), schema).write.parquet(made)
    links = spark.read.schema(schema).parquet(made)

    # Where each part's lines begin in its file. The first line of a later part follows a magic.
    order = Window.partitionBy("file").orderBy("block")
    bases = (
        links.filter("at IS NULL")
        .select("file", "block", F.col("next").alias("bytes"))
        .withColumn(
            "base",
            F.coalesce(
                F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("bytes")
    )
    placed = (
        links.filter("at IS NOT NULL")
        .join(bases, ["file", "block"])
        .select(
            *(F.col(n) for n, _ in RECORD if n not in ("at", "next", "leaves", "body_at")),
            *((F.col(n) + F.col("base")).alias(n) for n in ("at", "next", "leaves", "body_at")),
        )
    )
    entries = _entries(spark, bases, placed)
    schema_out = StructType([*placed.schema])

    def follow(key: tuple, rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        """The chain inside a part, from where it enters."""
        following = dict(zip(rows["at"].tolist(), rows["next"].tolist()))
        here = starts["at"].min() if len(starts) else None
        chain = set()
        while here in following and here not in chain:
            chain.add(here)
            here = following[here]
        return rows[rows["at"].isin(chain)]

    kept = (
        placed.groupBy("file", "block")
        .cogroup(entries.groupBy("file", "block"))
        .applyInPandas(follow, schema_out)
    )
    out = fresh_path(spark, "records")
    kept.write.parquet(out)
    records = spark.read.schema(schema_out).parquet(out)
    split = records.filter("digest IS NULL")
    if not split.isEmpty():
        records = records.filter("digest IS NOT NULL").unionByName(
            _reassembled(spark, folder, bases, split).select(records.columns)
        )
    return records.select(
        "file", F.col("at").alias("offset"), "record_type", "record_id", "refers_to", "target_uri",
        "stated_digest", "stated_bytes", "body_bytes", "digest",
    )


def _entries(spark: SparkSession, bases: DataFrame, placed: DataFrame) -> DataFrame:
    """Where the chain from each file's start enters its parts, by pointer jumping."""
    first = bases.filter("block = 0").select("file", F.lit(0).cast("bigint").alias("at"))
    targets = placed.select("file", F.col("leaves").alias("at")).unionByName(first).distinct()
    folder = fresh_path(spark, "jumps")
    placed.select("file", "block", "at", "leaves").join(targets, ["file", "at"]).write.parquet(
        folder
    )
    points = spark.read.parquet(folder)
    parts = bases.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    jumps = points.select("file", "at", F.col("leaves").alias("to"))
    reached = first
    for _ in range((parts - 1).bit_length()):
        onward = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        doubled = jumps.join(
            jumps.select("file", F.col("at").alias("to"), F.col("to").alias("further")),
            ["file", "to"],
        ).select("file", "at", F.col("further").alias("to"))
        reached, jumps = (
            _kept(reached.unionByName(onward).distinct(), "reached"),
            _kept(doubled, "jumps"),
        )
    return points.join(reached, ["file", "at"]).select("file", "block", "at")


def _kept(df: DataFrame, name: str) -> DataFrame:
    folder = fresh_path(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _reassembled(
    spark: SparkSession, folder: str, bases: DataFrame, split: DataFrame
) -> DataFrame:
    """Records whose payload holds the magic: their bytes are gathered again, then digested."""
    schema = StructType(
        [
            StructField("file", StringType()),
            StructField("block", LongType()),
            StructField("line_at", LongType()),
            StructField("line", BinaryType()),
        ]
    )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _positions(batches):
            yield record_batch(schema, dict(zip(schema.names, ([v] for v in row))))

    lines = _lines(spark, folder).mapInArrow(numbered, schema).join(bases, ["file", "block"])
    lines = lines.select("file", (F.col("line_at") + F.col("base")).alias("line_at"), "line")
    wanted = split.select("file", "at", "body_at", (F.col("body_at") + F.col("body_bytes")).alias("body_end"))
    pieces = lines.join(wanted, "file").filter(
        "line_at < body_end AND line_at + octet_length(line) + 10 > body_at"
    )

    def join_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_at")
        data = b"".join(bytes(line) + MAGIC.encode() for line in rows["line"])
        first, start, end = (int(rows[c].iloc[0]) for c in ("line_at", "body_at", "body_end"))
        digest = hashlib.sha256(data[start - first : end - first]).hexdigest()
        return pd.DataFrame({"file": [key[0]], "at": [key[1]], "digest": [digest]})

    made = pieces.groupBy("file", "at").applyInPandas(
        join_up, "file string, at bigint, digest string"
    )
    return split.drop("digest").join(made, ["file", "at"])


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's bytes and digest are those of the payload as read; a revisit states them.
    """
    records = read_archives(spark, folder)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    whole = F.col("record_type") == "response"
    page = lambda c: F.when(number(c) != "", number(c).cast("bigint"))
    return records.select(
        page("record_id").alias("page_id"),
        F.when(whole, F.col("body_bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(whole, F.col("digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
