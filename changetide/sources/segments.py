"""Messages in partitioned, numbered files: a streaming source with offsets of its own.

    FOLDER/partition=P/FIRST-LAST.parquet    messages FIRST to LAST of partition P, without gaps

File names alone tell which offsets there are, so planning a batch lists folders and opens nothing, and a
task opens only the files that hold its range. What has been deleted since (by a time limit, say) is skipped or is an
error, as the reader chooses.
"""

from __future__ import annotations

import json
import logging
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..spec import MESSAGE_SCHEMA

FORMAT = "message_segments"
ROWS = 100_000   # messages of a written file
TASK_ROWS = 50_000   # messages that fill a task: small files share one, a larger file has its own

_SCHEMA = "value STRING, ts TIMESTAMP, topic STRING, partition INT, offset LONG"
_COLUMNS = ["value", "ts", "topic", "partition", "offset"]
_TYPES = pa.schema([("value", pa.string()), ("ts", pa.timestamp("us", "UTC")), ("topic", pa.string()),
                    ("partition", pa.int32()), ("offset", pa.int64())])

Offsets = dict[str, int]   # by partition: the offset of the next message


@dataclass(frozen=True, order=True)
class Segment:
    first: int
    last: int
    path: str


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def listed(folder: str) -> dict[str, list[Segment]]:
    """The files of each partition, by offset."""
    files, root = _opened(folder)
    found: dict[str, list[Segment]] = {}
    for info in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        parent = posixpath.basename(posixpath.dirname(info.path))
        if not info.is_file or not parent.startswith("partition=") or info.base_name.startswith((".", "_")) or info.extension != "parquet":
            continue
        first, last = map(int, info.base_name.removesuffix(".parquet").split("-"))
        found.setdefault(parent.removeprefix("partition="), []).append(Segment(first, last, info.path))
    return {partition: sorted(segments) for partition, segments in sorted(found.items())}


def _shared(segments: Sequence[Segment], begin: int, stop: int) -> list[list[str]]:
    """Files that follow each other, put together as long as their messages of a range fit one task."""
    tasks: list[list[str]] = []
    room = 0
    for segment in segments:
        rows = min(segment.last + 1, stop) - max(segment.first, begin)
        if not tasks or rows > room:
            tasks.append([])
            room = TASK_ROWS
        tasks[-1].append(segment.path)
        room -= rows
    return tasks


class Range(InputPartition):
    """Messages ``start`` to ``end`` (not included) of one partition, as far as some files hold them."""

    def __init__(self, partition: str, start: int, end: int, paths: Sequence[str]):
        self.partition, self.start, self.end, self.paths = partition, start, end, paths


class LostOffsets(Exception):
    pass


class SegmentReader(DataSourceStreamReader):
    """Reads ranges of offsets. Options: ``path``; ``startingOffsets``, earliest (default), latest or JSON by partition;
    ``failOnDataLoss``, true (default) or false.

    A batch takes all there is. Files that follow each other share a task up to ``TASK_ROWS`` messages, so a partition that holds
    most messages is read by many tasks, and the number of tasks follows the messages, not the files.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.starting = options.get("startingoffsets", "earliest")
        self.strict = options.get("failondataloss", "true").lower() != "false"
        self.reached: Offsets = {}   # up to where batches were planned; a partition without files stays there

    def initialOffset(self) -> Offsets:
        """Where a stream without a checkpoint begins."""
        segments = listed(self.folder)
        if self.starting == "earliest":
            return {p: some[0].first for p, some in segments.items()}
        if self.starting == "latest":
            return {p: some[-1].last + 1 for p, some in segments.items()}
        return {str(p): int(offset) for p, offset in json.loads(self.starting).items()}

    def latestOffset(self) -> Offsets:
        ends = {p: some[-1].last + 1 for p, some in listed(self.folder).items()}
        return self.reached | {p: max(end, self.reached.get(p, 0)) for p, end in ends.items()}

    def partitions(self, start: Offsets, end: Offsets) -> Sequence[InputPartition]:
        """Tasks for the files with new messages; files deleted since the last batch are missed here."""
        self.reached = dict(end)
        segments, ranges = listed(self.folder), []
        for partition, stop in sorted(end.items()):
            some = segments.get(partition, [])
            begin = start.get(partition, some[0].first if some else stop)
            if begin >= stop:
                continue
            mine = [s for s in some if s.last >= begin and s.first < stop]
            lost = stop - begin - sum(min(s.last + 1, stop) - max(s.first, begin) for s in mine)
            if lost and self.strict:
                raise LostOffsets(f"{self.folder}: {lost} messages of partition {partition} from {begin} to {stop - 1} are gone")
            if lost:
                logging.getLogger(__name__).warning("%s: %s messages of partition %s are gone", self.folder, lost, partition)
            ranges += [Range(partition, begin, stop, paths) for paths in _shared(mine, begin, stop)]
        return ranges or [Range("0", 0, 0, [])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(self.folder)
        for path in partition.paths:
            try:
                file = pq.ParquetFile(files.open_input_file(path))
            except FileNotFoundError:   # deleted since the batch was planned
                if self.strict:
                    raise LostOffsets(f"{path} is gone") from None
                continue
            for batch in file.iter_batches(columns=["value", "ts", "topic", "offset"]):
                offset = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end)))
                whole = batch.append_column("partition", pa.array([int(partition.partition)] * batch.num_rows, pa.int32()))
                yield pa.RecordBatch.from_arrays([pc.cast(whole.column(c), _TYPES.field(c).type) for c in _COLUMNS], schema=_TYPES)

    def commit(self, end: Offsets) -> None:
        """Files stay: how long is for their owner to say."""


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader({key.lower(): value for key, value in self.options.items()})


def segment_messages(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """A stream of the messages in a folder, with their partitions and offsets."""
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items()}).option("path", folder).load()


def write_segments(messages: DataFrame, folder: str, rows: int = ROWS) -> None:
    """Add messages, whose offsets follow each other in every partition, to a folder.

    Messages are dealt to tasks by ranges of partition and offset, so one large partition is written by many. A file is written
    under a hidden name and then renamed; a task that runs twice writes the same files once more.
    """
    def work(batches):
        files, root = _opened(folder)
        held: list[pa.RecordBatch] = []

        def written(table: pa.Table) -> None:
            partition, offset = table.column("partition")[0].as_py(), table.column("offset")
            name = f"{root}/partition={partition}/{offset[0].as_py()}-{offset[-1].as_py()}.parquet"
            hidden = f"{posixpath.dirname(name)}/.{uuid.uuid4().hex}"
            files.create_dir(posixpath.dirname(name), recursive=True)
            with files.open_output_stream(hidden) as out:
                pq.write_table(table.drop_columns(["partition"]), out)
            files.move(hidden, name)

        def cut(table: pa.Table, all_: bool) -> pa.Table:
            """Write whole files off the front: of ``rows`` messages, or to where another partition begins."""
            while table.num_rows:
                partition = table.column("partition")
                n = pc.sum(pc.equal(partition, partition[0])).as_py()   # sorted, so these stand in front
                if n == table.num_rows and n < rows and not all_:
                    break
                written(table.slice(0, min(n, rows)))
                table = table.slice(min(n, rows))
            return table

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                held = cut(pa.Table.from_batches(held), False).to_batches()
        if held:
            cut(pa.Table.from_batches(held), True)
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["n"])

    ready = messages.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE_SCHEMA])
    sorted_ = ready.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset").select(*_COLUMNS)
    sorted_.mapInArrow(work, "n long").write.format("noop").mode("overwrite").save()
