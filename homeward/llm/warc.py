"""WARC archives of pages and the merged index of their captures.

Writing: one record per page.  Of pages with equal payloads (at least
``least_bytes`` long) the one with the largest id is a ``response`` record
and the others ``revisit`` it; the rest are responses.  Spark's text writer
makes the files: a record is one row, and the row separator is the blank
line that ends a WARC record.  Files are gzip'ed as a whole and hold at most
``RECORDS_PER_FILE`` records.

Reading: each archive is read line by line and parsed as a stream, so that a
task holds one record and a batch of lines (long ones in parts), however
large an archive is.
Payload digests are computed again, and the archive's captures, sorted by URL key and time, are one run.  The runs
are merged to a global order: captures are range-partitioned by URL key,
time and id (so a hot URL spreads over several ranges), and each range
merges its parts of the runs with a loser tree.

A null payload is empty; a null URL has no target line and an empty key.  A
null id is less than all others.  Rows that share id and payload with the
response of their group are responses too.  Control characters in a URL are
written as ``%20``.  Times come from ``time_col``, or else from the id.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, shared_folder, stage_table
from .native import let

RECORDS_PER_FILE = 2000
PART_BYTES = 4096  # of a line
END = "\r\n\r\n"
EPOCH = 1_577_836_800  # 2020-01-01, the time of id 0 where pages have none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit hex digest, 20 bits at a time."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None, least_bytes: int = 0) -> DataFrame:
    """(record): the text of each page's WARC record."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    id_ = F.col(id_col).cast("long")
    time = F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(id_, F.lit(1 << 31)), F.lit(0)))
    rows = pages.select(
        id_.alias("id"),
        F.regexp_replace(F.col(url_col), "[\\x00-\\x1f\\x7f]", "%20").alias("url"),
        F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha1"),
        F.xxhash64(payload).alias("other"),
        F.octet_length(payload).cast("long").alias("n"),
    )
    same = ["sha1", "other", "n"]
    # only payloads that occur again are joined back, from a written table:
    # Spark broadcasts it while it is small, and can else split a hot payload
    last = rows.groupBy(*same).agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("times"))
    last = stage_table(last.where("times > 1"), "payloads")
    rows = rows.join(last, same, "left")
    revisit = F.col("times").isNotNull() & (F.col("n") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("last"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: "),
        F.coalesce("time", F.lit("")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        base32(F.col("sha1")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("last"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block),
        F.lit(END),
        block,
    )
    return rows.select(record.alias("record"))


def write_archives(pages: DataFrame, folder: str, **names) -> None:
    records(pages, **names).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


# ---- reading ----------------------------------------------------------------


def parse_archive(data: bytes):
    """(headers, block, place, size) of the records of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop], at, stop + 4 - at
        at = stop + 4


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path, lower-case."""
    rest = url.split("://", 1)[-1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = rest[:cut].split("@")[-1].split(":")[0]
    return (",".join(reversed(host.split("."))) + ")" + rest[cut:].split("#")[0]).lower()


CAPTURE = "url_key string, time string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, run string, place bigint, size bigint"
NAMES = [c.split()[0] for c in CAPTURE.split(", ")]
ORDER = slice(0, 3)


def _order(row) -> tuple:
    return row[0], row[1], -1 if row[2] is None else 0, row[2] or 0


def _capture(name: str, h: dict, block: bytes, place: int, size: int) -> tuple:
    def page(ref):
        value = ref.removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value else None

    head, _, payload = block.partition(b"\r\n\r\n")
    n = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = None
    if h["WARC-Type"] == "revisit":
        refers = page(h["WARC-Refers-To"])
    elif len(payload) != n or digest != (digest := base64.b32encode(hashlib.sha1(payload).digest()).decode()):
        raise ValueError(f"record at byte {place} of {name} is damaged")
    return url_key(h.get("WARC-Target-URI", "")), h["WARC-Date"], page(h["WARC-Record-ID"]), n, digest, h["WARC-Type"], refers, name, place, size


def _stream(batches):
    """(archive, headers, block, place, size) of the records of archives that
    come one after another as lines, each with its archive's name where the
    line can begin a record.  Holds the bytes from one record's start on."""
    held, names = bytearray(), {}
    begin = place = need = 0  # byte of held[0] in all, and in its archive; bytes to wait for
    name = None
    for batch in batches:
        lines, own = batch.column(0).cast(pa.large_binary()), batch.column(1)
        if not len(lines):
            continue
        _, offsets, data = lines.buffers()
        offs = np.frombuffer(offsets, np.int64, len(lines) + 1, lines.offset * 8)
        first = begin + len(held) - int(offs[0])
        for i in np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False)):
            names[first + int(offs[i])] = own[int(i)].as_py()
        held += memoryview(data)[offs[0] : offs[-1]]
        at = 0
        while len(held) - at > need:
            end = held.find(b"\r\n\r\n", at)
            if end < 0:
                need = len(held) - at
                break
            head = bytes(held[at:end])
            length = next((int(x[16:]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")), 0)
            size = end + 4 + length + 4 - at
            if len(held) - at < size:
                need = size - 1
                break
            if begin + at not in names:
                raise ValueError(f"no WARC record at byte {place} of {name}")
            if names[begin + at] != name:
                name, place = names[begin + at], 0
            headers, block, _, _ = next(parse_archive(bytes(held[at : at + size])))
            yield name, headers, block, place, size
            at, place, need = at + size, place + size, 0
        del held[:at]
        begin += at
        names = {k: v for k, v in names.items() if k >= begin}
    if held:
        raise ValueError(f"the record at byte {place} of {name}, or the one after it, is cut off")


def capture_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of every archive, a sorted run each."""
    # a gzip'ed file is never split; its lines, each with its line feed, are
    # the bytes of the archive in order.  Long lines come in parts: Arrow
    # batches are bounded by rows only
    lines = spark.read.text(folder, lineSep="\n")
    value = F.col("value")
    parts = let(
        F.concat(value, F.lit("\n")).cast("binary"),
        lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.octet_length(v) - 1) / PART_BYTES).cast("int")), lambda i: F.substring(v, i * PART_BYTES + 1, PART_BYTES)),
    )
    name = F.when(value.startswith("WARC/"), F.element_at(F.split("_metadata.file_path", "/"), -1))
    lines = lines.select(name.alias("name"), F.posexplode(parts).alias("part", "line")).select("line", F.when(F.col("part") == 0, F.col("name")).alias("name"))

    def run(batches):
        for name, found in groupby(_stream(batches), key=lambda x: x[0]):
            rows = sorted((_capture(*x) for x in found), key=_order)
            for i in range(0, len(rows), 10_000):
                yield _batch(rows[i : i + 10_000])

    return map_arrow(lines, run, CAPTURE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in CAPTURE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)


class LoserTree:
    """K-way merge: each inner node keeps the loser of its match, so the next
    winner needs one match per level."""

    def __init__(self, runs, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(self.runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.tree = [0] * max(self.k, 1)
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.tree[node] = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.tree[0] = winners[1] if self.k > 1 else 0

    def _next(self, i: int):
        row = next(self.runs[i], None)
        # an ended run loses every match; the run's number breaks ties
        return ((1,), i, None) if row is None else ((0, *self.key(row)), i, row)

    def __iter__(self):
        while self.k:
            i = self.tree[0]
            row = self.heads[i][2]
            if row is None:
                return
            yield row
            self.heads[i] = self._next(i)
            node = (i + self.k) // 2
            while node:
                if self.heads[self.tree[node]] < self.heads[i]:
                    i, self.tree[node] = self.tree[node], i
                node //= 2
            self.tree[0] = i


def merge_runs(captures: DataFrame, ranges: int | None = None) -> DataFrame:
    """Capture histories: all captures in the order of URL key, time and id
    across partitions."""
    n = ranges or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = captures.repartitionByRange(n, "url_key", "time", "page_id")

    def run(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for name, part in groupby(rows, key=lambda r: r[7]):
                runs.setdefault(name, []).extend(part)
        # a run's rows keep their order on the way; sorting checks it in linear time
        merged = LoserTree([sorted(r, key=_order) for r in runs.values()], _order)
        out = []
        for row in merged:
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return map_arrow(dealt, run, CAPTURE)


def archive_and_index(pages: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Write the archives (by default to a new shared folder) and return the
    merged index read from them."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_archives(pages, folder, **names)
    return merge_runs(capture_runs(spark, folder))
