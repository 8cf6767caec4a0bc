"""WARC archives: a deterministic sharded writer with a commit protocol, and a reader.

Records are ordered by id and cut into shards of about equal size by exact running totals, so the
shard of a record depends on the input alone. Each shard is written by one task, which starts a new
file whenever the compressed size passes the limit. Files get temporary names; the rows that the
successful tasks return form the manifest, by which files are renamed and readers find them. Files of
failed or speculative attempts are in no manifest and never become visible.

Cases: a null payload is empty; a null url leaves the target out; records without id are responses, dealt to
the shards by a hash of the row, and come first there; rows that share an id are records of their own, each
a revisit only if its own payload is found under a larger id; of rows that share the largest id and an equal
payload all are responses; an empty table writes an empty manifest; only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import materialize, running_offsets

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST_SCHEMA = "shard long, seq int, file string, temp string, records long, bytes long, sha1 string"
RECORD_SCHEMA = ("file string, record_id long, record_uri string, record_type string, refers_to long, url string, "
                 "payload_bytes long, payload_digest string, payload binary")
#: Header bytes a record is taken to have besides its payload when shards are cut.
HEADER_BYTES = 400


def find_copies(df: DataFrame, key: str, payload: str, min_bytes: int, salts: int = 32) -> DataFrame:
    """(`key`, digest, refers_to) of every record whose payload of at least `min_bytes` bytes has the largest
    `key` elsewhere. Works on digests; hot digests are dealt over `salts` parts in both steps."""
    data = F.coalesce(F.encode(F.col(f"`{payload}`"), "UTF-8"), F.lit(b""))
    records = (df.select(F.col(f"`{key}`").alias("key"), F.sha1(data).alias("digest"), F.octet_length(data).alias("size"))
               .filter((F.col("size") >= min_bytes) & F.col("key").isNotNull()))
    records = materialize(records.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")), "digests")
    groups = (records.groupBy("digest", "size").agg(F.max("key").alias("refers_to"), F.count("*").alias("n"))
              .filter("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    groups = materialize(groups.select("digest", "size", "salt", "refers_to"), "copies")
    return (records.join(groups, ["digest", "size", "salt"]).filter(F.col("key") < F.col("refers_to"))
            .select(F.col("key").alias(key), "digest", "refers_to").distinct())


def _filesystem(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def _uri(key, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}/{digest.hex()}')}>"


def _record(key, url: str | None, payload: bytes, digest: bytes, refers_to, date: str) -> bytes:
    """One gzip member. Digests (SHA-1), lengths and ids are made from the payload, never taken over."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(key, digest)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
            f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
            f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(
            f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    if key is not None:
        head.append(f"X-Record-Key: {key}")
    if revisit:
        head += [f"WARC-Refers-To: {_uri(refers_to, digest)}", f"X-Refers-To-Key: {refers_to}",
                 f"WARC-Profile: {REVISIT_PROFILE}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


class _Roller:
    """Open file of a shard; `close` gives its manifest row."""

    def __init__(self, fs, folder: str, shard: int, seq: int):
        self.row = {"shard": shard, "seq": seq, "file": f"{folder}/part-{shard:06d}-{seq:04d}.warc.gz",
                    "temp": f"{folder}/_temp-{shard:06d}-{seq:04d}-{uuid.uuid4().hex}", "records": 0, "bytes": 0}
        self.out, self.sha = fs.open_output_stream(self.row["temp"]), hashlib.sha1()

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.row["records"] += 1
        self.row["bytes"] += len(data)

    def close(self) -> dict:
        self.out.close()
        return self.row | {"sha1": self.sha.hexdigest()}


def write_warc(df: DataFrame, out_path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit_bytes: int = 1000, shards: int | None = None, shard_bytes: int = 256 << 20,
               roll_bytes: int = 64 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row below `out_path` and return the manifest (one row per file).

    Default `shards`: enough for `shard_bytes` each, and at least one per shuffle partition.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").alias("url"),
                     F.col(f"`{payload}`").alias("html"))
    sizes = rows.groupBy("key").agg(
        F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + F.lit(HEADER_BYTES)).cast("long").alias("size"))
    placed = materialize(running_offsets(sizes, ["key"], "size", "before"), "places")
    total = placed.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    each = max(1, -(-total // shards))
    # One first key per shard: as many numbers as there are shards.
    firsts = placed.filter("key IS NOT NULL").groupBy(F.floor(F.col("before") / each).alias("shard")).agg(
        F.min("key").alias("first"))
    edges = np.array(sorted(r["first"] for r in firsts.collect()), np.int64)
    shared = spark.sparkContext.broadcast(edges)

    @F.pandas_udf("long")
    def shard_of(keys: pd.Series) -> pd.Series:
        found = np.searchsorted(shared.value, keys.fillna(-(1 << 63)).astype("int64"), side="right") - 1
        return pd.Series(np.maximum(found, 0))

    copies = find_copies(rows, "key", "html", min_revisit_bytes)
    spread = F.pmod(F.xxhash64("url", "html"), F.lit(shards))
    # A copy's row travels to its record's task and is sorted just before it: payloads move once.
    both = rows.select("key", "url", "html", F.lit(None).cast("string").alias("digest"),
                       F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind")).union(
        copies.select("key", F.lit(None).cast("string"), F.lit(None).cast("string"), "digest", "refers_to", F.lit(0)))
    dealt = (both.withColumn("shard", F.when(F.col("key").isNull(), spread).otherwise(shard_of("key")))
             .repartitionById(shards, F.col("shard").cast("int"))
             .sortWithinPartitions("shard", "key", "kind", "url", F.xxhash64("html")))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = _filesystem(out_path)
        fs.create_dir(folder, recursive=True)
        roller, copies_of, copies_key, done = None, {}, None, []
        for frame in frames:
            for row in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
                if row.key != copies_key:
                    copies_of, copies_key = {}, row.key
                if row.kind == 0:
                    copies_of[row.digest] = int(row.refers_to)
                    continue
                if roller and (roller.row["shard"] != row.shard or roller.row["bytes"] >= roll_bytes):
                    done.append(roller.close())
                    roller = _Roller(fs, folder, row.shard, roller.row["seq"] + 1 if done[-1]["shard"] == row.shard else 0)
                roller = roller or _Roller(fs, folder, row.shard, 0)
                body = (row.html or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha1(body)
                roller.add(_record(None if row.key is None else int(row.key), row.url, body, digest.digest(),
                                   copies_of.get(digest.hexdigest()), date))
        if roller:
            done.append(roller.close())
        if done:
            yield pd.DataFrame(done)

    manifest = materialize(dealt.mapInPandas(write, MANIFEST_SCHEMA), "manifest")
    return commit(manifest, out_path)


def commit(manifest: DataFrame, out_path: str) -> DataFrame:
    """Rename every file of the manifest, then publish the manifest itself in `out_path`/_manifest.
    A repeated rename finds its work done, so lost executors only repeat it."""

    def rename(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        fs, _ = _filesystem(out_path)
        for frame in frames:
            for row in frame.itertuples(index=False):
                if fs.get_file_info(row.temp).type != FileType.NotFound:
                    fs.move(row.temp, row.file)
                elif fs.get_file_info(row.file).size != row.bytes:
                    raise FileNotFoundError(row.file)
            yield frame

    path = f"{out_path}/_manifest"
    manifest.mapInPandas(rename, MANIFEST_SCHEMA).drop("temp").write.mode("overwrite").parquet(path)
    return manifest.sparkSession.read.schema(MANIFEST_SCHEMA.replace("temp string, ", "")).parquet(path)


def _parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:80]!r}")
        head = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record without end: {head}")
        yield head, block


def read_warc(spark: SparkSession, out_path: str, with_payload: bool = True) -> DataFrame:
    """The records of a committed archive. Block and payload digests are made anew and compared;
    a revisit's length and digest are those of the full payload it stands for."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = _filesystem(out_path)
        for frame in frames:
            for row in frame.itertuples(index=False):
                out, held = [], 0
                with gzip.GzipFile(fileobj=fs.open_input_file(row.file)) as raw:
                    for head, block in _parse(io.BufferedReader(raw)):
                        kind = head["warc-type"]
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
                        made = base64.b32encode(hashlib.sha1(block).digest()).decode()
                        body = block.partition(b"\r\n\r\n")[2]
                        if head["warc-block-digest"] != f"sha1:{made}" or (
                                kind == "response" and hashlib.sha1(body).digest() != digest):
                            raise ValueError(f"{row.file}: digest of {head['warc-record-id']} differs")
                        key, refers = head.get("x-record-key"), head.get("x-refers-to-key")
                        out.append((row.file, int(key) if key else None, head["warc-record-id"], kind,
                                    int(refers) if refers else None, head.get("warc-target-uri"),
                                    int(head["x-payload-length"]) if kind == "revisit" else len(body),
                                    digest.hex(), body if with_payload and kind == "response" else None))
                        held += len(block)
                        if held > 8 << 20:
                            yield _frame(out)
                            out, held = [], 0
                if out:
                    yield _frame(out)

    files = spark.read.parquet(f"{out_path}/_manifest").select("file", "bytes")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(n, "file").mapInPandas(read, RECORD_SCHEMA)


def dangling_revisits(records: DataFrame) -> DataFrame:
    """(refers_to, payload_digest) of revisits of `read_warc` whose response with that id and digest is in no
    file; none in a whole archive. Copies of one payload are one row before the join."""
    wanted = records.filter("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    there = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), "payload_digest")
    return wanted.join(there, ["refers_to", "payload_digest"], "left_anti")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"record_id": "Int64", "refers_to": "Int64"})
