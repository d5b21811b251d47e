"""WARC archives with deduplicated payloads, and one merged capture index.

Pages are written as WARC records (one gzip member each); a payload that
several pages share is stored once and the other records revisit it. Every
archive comes with a run of index lines sorted by (URL key, time). The runs are
merged externally: the key space is cut into ranges at keys sampled from all
runs, and each range is merged from the runs' slices by a loser tree, which
holds one line of each run. Ranges in order are the global index, so the
captures of a URL stand together in time order.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import fresh_dir

from ._tables import arrow_conf, saved
from ._words import tidy

#: Payloads shorter than this are stored again rather than revisited.
MIN_SHARED_BYTES = 1000
#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 64 << 20
#: Index lines of one merged range, about.
RANGE_LINES = 20_000
#: Tasks that read archives, at most; more archives are several to a task.
MAX_TASKS = 20_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def url_key(url: Column) -> Column:
    """Sort-friendly key of a URL: lower case, host labels reversed, without
    scheme, ``www.``, port 80/443 and fragment. Hostless: as it is; null: empty."""
    low = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://([^/?]*)", 1), r"^www\.|:(80|443)$", "")
    rest = F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://[^/?]*", "")
    rest = F.when(rest == "", F.lit("/")).otherwise(rest)
    return F.when(host == "", low).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def _record(page_id, url: str, time: datetime, body: bytes, digest: str, size: int, refers) -> bytes:
    """One record: request-independent, its id a hash of the page's id."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if refers is not None else body)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}').urn}>",
        f"WARC-Date: {time.strftime('%Y-%m-%dT%H:%M:%SZ')}", f"WARC-Target-URI: {_one_line(url)}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {page_id}"]
    if refers is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-Id: {refers}",
                 f"WARC-Refers-To: <{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{refers}').urn}>"]
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _one_line(url: str) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP header block and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def with_references(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest``, ``size`` and
    ``refers_to``, the largest page_id with the same payload if that is another
    page and the payload is long enough."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).filter("page_id is not null")
    slim = slim.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long")})
    shared = slim.filter(F.col("size") >= MIN_SHARED_BYTES).groupBy("digest", "size").agg(
        F.max("page_id").alias("holder"), F.min("page_id").alias("least"))
    shared = saved(shared.filter("holder <> least").select("digest", "size", "holder"), "warc_shared")
    return slim.join(shared, ["digest", "size"], "left").withColumn(
        "refers_to", F.when(F.col("holder") != F.col("page_id"), F.col("holder"))).drop("holder")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of :func:`with_references` and return the index
    lines, each archive's sorted by (url_key, time, page_id): ``run`` (the
    archive), ``url_key``, ``time``, ``page_id``, ``offset``, ``length``."""
    arrow_conf(pages.sparkSession)
    fields = ["run", "url_key", "time", "page_id", "offset", "length"]

    def rows(batches):
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        part, seq, out, lines, raw_bytes = TaskContext.get().partitionId(), 0, None, [], 0

        def close():
            nonlocal out, lines, seq, raw_bytes
            out[0].close()
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex[:8]}.warc.gz"
            fs.move(out[1], f"{path}/{name}")
            lines.sort()
            cols = list(zip(*lines, strict=True))
            batch = pa.RecordBatch.from_arrays(
                [pa.array([name] * len(lines)), pa.array(cols[0], pa.string()),
                 *(pa.array(c, pa.int64()) for c in cols[1:])], names=fields)
            out, lines, seq, raw_bytes = None, [], seq + 1, 0
            return batch

        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    tmp = f"{path}/_{uuid.uuid4().hex}"
                    out, at = (fs.open_output_stream(tmp), tmp), 0
                raw = _record(r["page_id"], r["url"], _EPOCH + timedelta(seconds=r["time"]), r["html"].encode("utf-8"),
                              r["digest"], r["size"], r["refers_to"])
                member = gzip.compress(raw, 6, mtime=0)
                out[0].write(member)
                lines.append((r["url_key"], r["time"], r["page_id"], at, len(member)))
                at += len(member)
                raw_bytes += len(raw)
                if raw_bytes >= archive_bytes:
                    yield close()
        if out is not None:
            yield close()

    timed = pages.withColumns({"time": F.col("page_id") % F.lit(10**9), "url_key": url_key(F.col("url"))})
    return timed.select("page_id", "url", "html", "digest", "size", "refers_to", "time", "url_key").mapInArrow(
        tidy(rows), "run string, url_key string, time long, page_id long, offset long, length long")


class LoserTree:
    """Merge of sorted iterators: a tournament in which every inner node keeps
    the loser, so the next line costs one comparison per level."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.tree = [-1] * k  # inner nodes 1..k-1 hold losers, node 0 the winner
        for i in range(k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an ended run comes last."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node, winner = (i + len(self.tree)) // 2, i
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = winner
                return
            if self._before(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while (top := self.heads[w := self.tree[0]]) is not None:
            yield top
            self.heads[w] = next(self.runs[w], None)
            node, winner = (w + len(self.tree)) // 2, w
            while node > 0:
                if self._before(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def merge_runs(index: DataFrame, range_lines: int = RANGE_LINES) -> DataFrame:
    """All index lines in global order: ``range_no``, ``line_no`` (place in its
    range) and the line; ranges are disjoint and ascending.

    The range partitioner samples all runs for the cutting keys; the page_id is
    part of the key, so one URL with very many captures is cut too. In a range
    the slices of the runs, each sorted, go through the loser tree.
    """
    key = ["url_key", "time", "page_id"]
    fields = [*key, "run", "offset", "length"]
    n = max(1, -(-index.count() // range_lines))
    dealt = index.repartitionByRange(n, *key).sortWithinPartitions("run", *key)

    def rows(batches):
        no = TaskContext.get().partitionId()
        runs: dict[str, list[pa.RecordBatch]] = {}
        for b in batches:  # the slices of a range: about range_lines lines in all
            for run in b.column("run").unique().to_pylist():
                runs.setdefault(run, []).append(b.filter(pc.equal(b.column("run"), run)))

        def lines(slices):
            for s in slices:
                yield from zip(*(s.column(f).to_pylist() for f in fields), strict=True)

        merged, at = [], 0
        for line in LoserTree([lines(s) for s in runs.values()]):
            merged.append(line)
            if len(merged) == 4096:
                yield _lines(no, at, merged, fields)
                at, merged = at + len(merged), []
        if merged:
            yield _lines(no, at, merged, fields)

    return dealt.mapInArrow(tidy(rows), "range_no long, line_no long, url_key string, time long, page_id long, run string, "
                                  "offset long, length long")


def _lines(no: int, at: int, merged: list, fields: list[str]) -> pa.RecordBatch:
    kinds = {"url_key": pa.string(), "run": pa.string()}
    cols = list(zip(*merged, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([no] * len(merged), pa.int64()), pa.array(range(at, at + len(merged)), pa.int64()),
         *(pa.array(c, kinds.get(f, pa.int64())) for f, c in zip(fields, cols, strict=True))],
        names=["range_no", "line_no", *fields])


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that index lines point to, read archive by archive in file
    order: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, and the line's ``url_key``, ``time``, ``range_no`` and
    ``line_no``. Payloads that are present are hashed again and must agree."""
    keep = ["url_key", "time", "range_no", "line_no"]
    # as many tasks as archives: the lines are tiny, so sizes would put all archives in one task
    n = max(1, min(index.select("run").distinct().count(), MAX_TASKS))
    dealt = index.repartition(n, "run").sortWithinPartitions("run", "offset")

    def rows(batches):
        name, file = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["run"] != name:
                    fs, path = pafs.FileSystem.from_uri(folder)
                    name, file = r["run"], fs.open_input_file(f"{path}/{r['run']}")
                file.seek(r["offset"])
                headers, http, payload = parse_record(zlib.decompress(file.read(r["length"]), 31))
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
                if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                    raise ValueError(f"{name} at {r['offset']}: the payload does not match its digest")
                refers = headers.get("X-Refers-To-Page-Id")
                out.append((int(headers["X-Page-Id"]), size, digest, kind, int(refers) if refers else None,
                            *(r[k] for k in keep)))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *keep])

    return dealt.mapInArrow(
        tidy(rows), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url_key string, time long, range_no long, line_no long")


def warc_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC, merge the index, read the
    archives back along it. One row per page: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``, ``url_key`` and
    ``capture_no`` (1 for the first capture of its URL key, in time order).

    Rows without page_id are left out. A null html is an empty payload; a null
    url is an empty key. Equal payloads of at least ``MIN_SHARED_BYTES`` bytes
    are stored once, with the largest page_id; rows that repeat a page_id are
    records of their own, and the repeated holder's rows are all responses.
    Other columns are ignored. An empty table gives an empty result.
    """
    where = folder or fresh_dir(pages.sparkSession, "warc")
    index = saved(write_archives(with_references(pages), where), "warc_runs")
    merged = saved(merge_runs(index), "warc_index")
    # captures of a key before each range, from one row per range and key at its ends
    back = saved(read_archives(merged, where), "warc_read")
    inside = Window.partitionBy("url_key", "range_no").orderBy("line_no")
    per = back.groupBy("url_key", "range_no").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("url_key").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("url_key", "range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return back.withColumn("in_range", F.row_number().over(inside)).join(per, ["url_key", "range_no"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        (F.col("earlier") + F.col("in_range")).alias("capture_no"))
