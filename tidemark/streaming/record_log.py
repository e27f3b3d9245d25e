"""A stream source that admits records, not files.

A record log is a folder of append-only text files, its shards; each line is a record, ``sequence number
TAB value``. ``RecordLogSource`` reads it with Spark's data source API for Python as format ``record_log``.
The offset of a shard is its byte position, so a micro-batch starts where the last one ended and a
shard is never read from its beginning again. A micro-batch takes at most ``maxRecords`` lines of every
shard, however large a file is, and a line that is still being written waits until its end is there. One task reads a
shard's part of a batch. On the driver only positions are computed, by reading ahead the lines to be admitted.

A long backlog is admitted several batches at a time: with ``maxBatches`` over 1 a micro-batch of Spark holds up to that many
batches of ``maxRecords`` lines of every shard, cut just as if they had come one by one, and a column ``batch`` gives each record
the number of its batch, counted from the start of the log's stream. The offset holds the number of batches so far, so
numbers stay the same when a micro-batch is repeated and go on after a restart.

Options: ``path``; ``maxRecords`` (default 500); ``maxBatches`` (default 1); ``maxWaitSeconds`` (default 30): fewer records than that
are held back until they have waited so long, whichever comes first; ``startingOffsets``, ``earliest`` or ``latest`` (the
default: the ends of the shards there are; a shard that appears later is read from its start).

After a restart the stream goes on from the offsets in its checkpoint. Paths may be on any file
system pyarrow knows (local, HDFS, S3, GCS). With ``availableNow`` Spark takes a single batch from a source of
this kind, so use a processing-time trigger; ``drain`` waits for a backlog to be done.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import STREAM_BATCH_WINDOW_SECONDS, STREAM_MAX_RECORDS_PER_BATCH
from tidemark.session import workers_find_package

SCHEMA = "sequence_number string, value string, shard string"
NUMBERED = SCHEMA + ", batch bigint"
COUNT = ".batches"                   # in an offset, the batches before it; no shard has a name like that
READ_AHEAD = 1 << 16


def _store(path: str):
    """(file system, path in it)."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def shards(path: str) -> dict[str, int]:
    """Size in bytes of every shard, by name."""
    from pyarrow import fs
    store, at = _store(path)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return {f.base_name: f.size for f in found if f.is_file and not f.base_name.startswith(("_", "."))}


def end_of_lines(path: str, shard: str, start: int, size: int, lines: int) -> tuple[int, int]:
    """The position after at most ``lines`` whole lines from ``start``, and how many they are."""
    store, at = _store(path)
    end, left = start, lines
    with store.open_input_file(f"{at}/{shard}") as f:
        f.seek(start)
        position = start
        while position < size and left > 0:
            data = f.read(min(READ_AHEAD, size - position))
            if not data:
                break
            n = data.count(b"\n")
            if n > left:
                cut = -1
                for _ in range(left):
                    cut = data.index(b"\n", cut + 1)
                return position + cut + 1, lines
            if n:
                end, left = position + data.rindex(b"\n") + 1, left - n
            position += len(data)
    return end, lines - left


def fields(line: bytes) -> tuple[str, str]:
    """Sequence number and value of a line."""
    number, _, value = line.decode("utf-8", "replace").rstrip("\r").partition("\t")
    return number, value


class Part(InputPartition):
    """One shard's bytes of a micro-batch, and the number of its first batch."""

    def __init__(self, shard: str, start: int, end: int, first: int = 0):
        super().__init__(shard)
        self.shard, self.start, self.end, self.first = shard, start, end, first


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.limit = int(options.get("maxRecords", STREAM_MAX_RECORDS_PER_BATCH))
        self.wait = float(options.get("maxWaitSeconds", STREAM_BATCH_WINDOW_SECONDS))
        self.many = int(options.get("maxBatches", 1))
        self.start = options.get("startingOffsets", "latest")
        if self.limit < 1 or self.many < 1 or self.start not in ("earliest", "latest"):
            raise ValueError("maxRecords and maxBatches must be positive, startingOffsets earliest or latest")
        self.at: dict[str, int] | None = None        # where the next batch starts
        self.since: dict[str, float] = {}            # when a shard's waiting records were first seen

    def initialOffset(self) -> dict:
        now = shards(self.path)
        self.at = {s: end_of_lines(self.path, s, 0, n, n + 1)[0] if self.start == "latest" else 0 for s, n in now.items()}
        if self.many > 1:
            self.at[COUNT] = 0
        return self.at

    def latestOffset(self) -> dict:
        """As far as the next batch may go: some lines further in every shard that has enough, or has waited enough."""
        at = self.initialOffset() if self.at is None else self.at
        out, now, batches = {}, time.monotonic(), 0
        for s, size in sorted(shards(self.path).items()):
            start = at.get(s, 0)
            end, n = end_of_lines(self.path, s, start, size, self.limit * self.many)
            if n % self.limit and now - self.since.setdefault(s, now) < self.wait:
                # the batches that are full; the rest of the lines waits
                end, n = end_of_lines(self.path, s, start, size, n - n % self.limit)
            out[s], batches = end, max(batches, -(-n // self.limit))
        if self.many > 1:
            out[COUNT] = at.get(COUNT, 0) + batches
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # Spark also asks for the last batch of a checkpoint when a query starts again.
        for s, e in end.items():
            if self.at is None or e != self.at.get(s, 0):
                self.since.pop(s, None)
        self.at = dict(end)
        return [Part(s, start.get(s, 0), e, start.get(COUNT, 0)) for s, e in sorted(end.items()) if s != COUNT and e > start.get(s, 0)]

    def read(self, partition: Part) -> Iterator[tuple] | Iterator[pa.RecordBatch]:
        store, at = _store(self.path)
        with store.open_input_file(f"{at}/{partition.shard}") as f:
            f.seek(partition.start)
            data = f.read(partition.end - partition.start)
        lines = data.split(b"\n")[:-1]
        if self.many > 1:
            for i in range(0, len(lines), self.limit):
                yield self.numbered(lines[i:i + self.limit], partition.shard, partition.first + i // self.limit)
            return
        for line in lines:
            yield *fields(line), partition.shard

    def numbered(self, lines: list[bytes], shard: str, batch: int) -> pa.RecordBatch:
        number, value = zip(*map(fields, lines))
        return pa.record_batch([pa.array(number, pa.string()), pa.array(value, pa.string()), pa.array([shard] * len(lines), pa.string()),
                                pa.array([batch] * len(lines), pa.int64())], names=["sequence_number", "value", "shard", "batch"])


class RecordLogSource(DataSource):
    """Format ``record_log``."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return NUMBERED if int(self.options.get("maxBatches", 1)) > 1 else SCHEMA

    def streamReader(self, schema) -> RecordLogReader:
        return RecordLogReader(self.options)


def read_log(spark: SparkSession, path: str, max_records: int = STREAM_MAX_RECORDS_PER_BATCH,
             max_wait: float = STREAM_BATCH_WINDOW_SECONDS, starting_offsets: str = "latest", max_batches: int = 1) -> DataFrame:
    """A record log as a stream (sequence_number, value, shard), with ``max_batches`` over 1 also batch."""
    workers_find_package(spark)
    spark.dataSource.register(RecordLogSource)
    return spark.readStream.format("record_log").option("path", path).option("maxRecords", max_records) \
        .option("maxWaitSeconds", max_wait).option("startingOffsets", starting_offsets) \
        .option("maxBatches", max_batches).load()


def write_log(records: DataFrame, path: str, n_shards: int) -> None:
    """Records (sequence_number, value) as a log of at most ``n_shards`` files, dealt and ordered by their number.

    Line breaks in a value are left out (in base64 and JSON they mean nothing); a NULL becomes an empty text. Numbers that are no integers are dealt by
    hash and come first. A shard has one writer, as any log has; more shards make more tasks.
    """
    number = F.col("sequence_number").try_cast("bigint")
    shard = F.pmod(F.coalesce(number, F.xxhash64("sequence_number")), F.lit(n_shards))
    line = F.concat_ws("\t", F.coalesce("sequence_number", F.lit("")), F.coalesce(F.regexp_replace("value", "[\\r\\n]+", ""), F.lit("")))
    records.select(shard.alias("shard"), number.alias("n"), line.alias("line")) \
        .repartitionById(n_shards, F.col("shard").cast("int")).sortWithinPartitions("n").select("line").write.text(path)


def drain(query: StreamingQuery) -> None:
    """Wait until a query over a log has taken everything there is, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
