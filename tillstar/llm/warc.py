"""WARC archives: writing, normalising whole-file gzip streams, reading by offset.

`write_archives` writes a record for each page through Spark's text sink with gzip: each part is one
gzip member over the whole file, as many crawls' archives are. `normalise` inflates each such stream
once, in pieces of bounded size, writes every record as its own gzip member to a new archive, and
a sidecar index with each member's offset and length. `read_records` seeks the members that an index
names, so any slice of an archive can be read by any task. Files that a failed task left behind
are replaced by its next attempt; an archive appears under its name only when whole.

Of records with equal payloads of at least ``MIN_BYTES`` bytes the one with the largest page_id is a response
and the others revisit it. Defined cases: a null page is an empty payload; a null page_id counts as
the smallest; a repeated row is a record of its own, and one of rows with equal ids and payloads is the
response; an empty table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.common import table_batch

MIN_BYTES, RECORDS_PER_FILE, LEVEL = 1000, 20_000, 3
_READ = 1 << 20
_END = b"\r\n\r\n"
#: Fixed values of the WARC format and of the HTTP block in front of a payload.
_VERSION, _REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def decide(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, html`` (never null), ``bytes, digest, refers_to`` (null for a response)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), html.alias("html"), F.octet_length(html).alias("bytes"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    # Counted map-side; only payloads that occur twice take part in the join.
    large = rows.where(F.col("bytes") >= min_bytes)
    top = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("top")).where("n > 1")
    # Rows with equal ids and payloads: one is the response. They are numbered apart from all other rows.
    same = large.groupBy("digest", "page_id").agg(F.count("*").alias("same")).where("same > 1")
    joined = rows.join(top, "digest", "left").withColumn("first", F.lit(True))
    if not same.isEmpty():
        tied = same.withColumn("tied", F.lit(True)).select(F.col("digest").alias("d"), F.col("page_id").alias("p"), "tied")
        joined = joined.join(tied, (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p")), "left").drop("d", "p")
        number = F.row_number().over(Window.partitionBy("digest", "page_id").orderBy("url"))
        joined = joined.where("tied IS NULL").drop("tied").unionAll(joined.where("tied").drop("tied").withColumn("first", number == 1))
    response = F.col("n").isNull() | (F.col("page_id").eqNullSafe(F.col("top")) & F.col("first"))
    return joined.select("page_id", "url", "html", "bytes", "digest", F.when(~response, F.col("top")).alias("refers_to"), (~response).alias("revisit"))


def _record():
    """A record without the CRLF pair that ends it."""
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), block).otherwise(F.concat(block, F.col("html")))
    lines = [
        F.lit(_VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")),
        F.lit(f"WARC-Date: {_DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("null")), F.lit(">"))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {_REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of one gzip stream each; equal payloads as revisits."""
    records = decide(pages, min_bytes).select(_record().alias("value"))
    records.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(folder)


# ---------------------------------------------------------------- tasks


def _open(path: str):
    fs, name = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return fs, name


def stream_records(chunks):
    """Whole records (bytes, without the end mark) of an inflated stream of byte chunks."""
    buffer, at, need = bytearray(), 0, None
    for chunk in chunks:
        if at > _READ:
            del buffer[:at]
            at = 0
        buffer += chunk
        while True:
            if need is None:
                head = buffer.find(_END, at)
                if head < 0:
                    break
                need = head + 4 - at + _length(bytes(buffer[at:head]))
            if len(buffer) - at < need + 4:
                break
            yield bytes(buffer[at : at + need])
            if buffer[at + need : at + need + 4] != _END:
                raise ValueError("a record does not end where its length says")
            at, need = at + need + 4, None
    if len(buffer) > at:
        raise ValueError("an archive ends within a record")


def _length(head: bytes) -> int:
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise ValueError("a record without a length")


def inflated(stream):
    """Chunks of a gzip stream of one or several members."""
    engine, rest = zlib.decompressobj(31), b""
    while True:
        data = rest or stream.read(_READ)
        rest = b""
        if not data:
            if not engine.eof:
                raise ValueError("a gzip stream is cut off")
            return
        while data:
            if engine.eof:
                engine = zlib.decompressobj(31)
            out = engine.decompress(data, 4 * _READ)
            data = engine.unconsumed_tail or engine.unused_data
            if out:
                yield out


def _normaliser(target: str, level: int):
    schema = "archive string, records bigint, bytes bigint"

    def work(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, name = _open(path)
                fs, folder = _open(target)
                base = f"{folder}/{name.rpartition('/')[2].split('.')[0]}"
                offset, count = 0, 0
                with source.open_input_stream(name, compression=None) as stream, fs.open_output_stream(base + ".tmp", compression=None) as out:
                    lines = []
                    for record in stream_records(inflated(stream)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(record + _END) + packer.flush()
                        out.write(member)
                        lines.append(json.dumps({"archive": base + ".warc.gz", "offset": offset, "length": len(member)}))
                        offset, count = offset + len(member), count + 1
                with fs.open_output_stream(base + ".idx.tmp", compression=None) as out:
                    out.write("".join(line + "\n" for line in lines).encode())
                fs.move(base + ".idx.tmp", base + ".idx.json")
                fs.move(base + ".tmp", base + ".warc.gz")
                yield table_batch(schema, [pa.array([base + ".warc.gz"]), pa.array([count], pa.int64()), pa.array([offset], pa.int64())])

    return work, schema


def normalise(spark: SparkSession, folder: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrite every archive of ``folder`` as one member a record in ``target``, beside a sidecar index.

    Returns ``archive, offset, length`` of all records, read from the sidecars."""
    fs, name = _open(target)
    fs.create_dir(name, recursive=True)
    index = "archive string, offset bigint, length bigint"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    work, schema = _normaliser(target, level)
    n = files.count()
    if not n:
        return spark.createDataFrame([], index)
    files.repartition(n, "path").mapInArrow(work, schema).write.format("noop").mode("overwrite").save()
    return spark.read.schema(index).option("pathGlobFilter", "*.idx.json").json(target)


_RECORD = "kind string, page_id bigint, refers_to bigint, uri string, digest string, payload_bytes bigint, payload binary"


def _reader(payloads: bool):
    def work(batches):
        files = {}
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive not in files:
                    fs, name = _open(archive)
                    files = {archive: fs.open_input_file(name)}
                files[archive].seek(offset)
                rows.append(parse(zlib.decompress(files[archive].read(length), 31), payloads))
                if len(rows) == 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return work


def _batch(rows):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return table_batch(_RECORD, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)])


def parse(record: bytes, payloads: bool):
    """Fields of a record; a response's digest and size are those of the bytes found, and must agree with its header."""
    head, _, block = record[: len(record) - len(_END)].partition(_END)
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    http, _, payload = block.partition(_END)
    size = _length(http)
    digest = fields["warc-payload-digest"].partition(":")[2]
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"a damaged record: {fields['warc-record-id']}")
    return kind, _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to")), fields["warc-target-uri"], digest, size, payload if payloads else None


def _page(urn: str | None) -> int | None:
    last = urn.strip("<>").rpartition(":")[2] if urn else "null"
    return None if last == "null" else int(last)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``archive, offset, length`` rows name; a task reads neighbouring members."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("archive", "offset", "length").repartition(n, "archive", F.floor(F.col("offset") / (4 << 20)))
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(_reader(payloads), _RECORD)
