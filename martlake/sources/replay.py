"""Replaying a table as a stream in event-time order.

``TimeOrdered`` stages a table as files of ascending event-time ranges in the shared folder and
reads them with a streaming source of its own: an offset is a position in that order, each
micro-batch admits the next few files, and after the last one a closing row, empty but for an
event time just behind the newest, moves the watermark past all events. One query reads the
whole table; as later files hold later events only, no row is late even without a delay, and a
stateful operator keeps the rows of one micro-batch at most.

The source notes the offset it last handed out beside the staged files, so a query restarted from
its checkpoint goes on where it was. Files are read where Spark runs the partitions, through the file system
their URI names.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time as clock
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from martlake.session import checkpoint_dir, drop, stored

#: rows of a staged file, about, files a micro-batch admits at least, and micro-batches at most:
#: each has a price of its own, and a larger table's read more of the state anyway
PER_FILE, FILES, BATCHES = 64_000, 8, 32
_NOTE = "_position"


def _file_system(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


def _files(uri: str) -> list[str]:
    """The staged files, by partition number: in order of event time."""
    from pyarrow import fs
    system, path = _file_system(uri)
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if re.search(r"/part-\d+[^/]*\.parquet$", f.path))


def _position(uri: str) -> int | None:
    system, path = _file_system(f"{uri}/{_NOTE}")
    try:
        with system.open_input_stream(path) as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return None


class _Reader(DataSourceStreamReader):
    def __init__(self, schema, options):
        self.schema, self.options = schema, options
        self.files = _files(options["path"])
        self.step = max(int(options["files"]), -(-len(self.files) // BATCHES))
        self.end = len(self.files) + bool(self.files)  # one more for the closing row
        # the last offset handed out, which is never before the one in the query's checkpoint; a
        # restarted query is handed it once more before the next
        self.at = _position(options["path"])
        self.resumed = self.at is not None
        self.at = self.at or 0

    def initialOffset(self):
        return {"file": 0}

    def latestOffset(self):
        last = len(self.files)
        if not self.resumed:
            self.at = min(self.at + self.step, last) if self.at < last else self.end
            system, path = _file_system(f"{self.options['path']}/{_NOTE}")
            with system.open_output_stream(path) as f:
                f.write(json.dumps(self.at).encode())
        self.resumed = False
        return {"file": self.at}

    def partitions(self, start, end):
        a, z = start["file"], end["file"]
        parts = [InputPartition(self.files[k]) for k in range(a, min(z, len(self.files)))]
        return parts + [InputPartition(None)] * (a < self.end == z and z > len(self.files))

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        if partition.value is None:
            time = dt.datetime.fromisoformat(self.options["closing"])
            yield pa.RecordBatch.from_pylist([{self.options["time"]: time}], schema=schema)
            return
        system, _ = _file_system(self.options["path"])
        with system.open_input_file(partition.value) as f:
            for batch in pq.ParquetFile(f).iter_batches():
                yield pa.Table.from_batches([batch]).cast(schema).combine_chunks().to_batches()[0] if len(batch) else batch.cast(schema)


class TimeOrderedSource(DataSource):
    @classmethod
    def name(cls):
        return "martlake_time_ordered"

    def streamReader(self, schema):
        return _Reader(schema, dict(self.options))


class TimeOrdered:
    """A replay of ``table`` by its timestamp column ``time``: ``rows`` is the streaming
    DataFrame, ``run(query)`` waits for a started query to read it to its end and stops it.
    Rows without a time come first; rows of one time are never parted."""

    #: nothing is late
    delay = "0 seconds"

    def __init__(self, spark: SparkSession, table: DataFrame, time: str, per_file: int = PER_FILE, files: int = FILES,
                 path: str | None = None):
        """With ``path``, a folder staged before is replayed; ``table`` then gives the schema."""
        self.path = path or f"{checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
        at = F.col(time).cast("timestamp_ntz")
        # the closing row has nulls in every other column
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in table.schema.fields])
        if path is None:
            # counted, sampled for its ranges and dealt out: derived once
            rows = stored(table)
            n_files = max(1, -(-rows.count() // per_file))
            rows.repartitionByRange(n_files, at.asc_nulls_first()).write.parquet(self.path)
            drop(rows)
        last = spark.read.schema(schema).parquet(self.path).agg(F.max(at)).first()[0]
        spark.dataSource.register(TimeOrderedSource)
        closing = (last or dt.datetime(1970, 1, 1)) + dt.timedelta(milliseconds=1)
        self.rows = (spark.readStream.format(TimeOrderedSource.name()).schema(schema)
                     .options(path=self.path, files=str(files), time=time, closing=closing.isoformat()).load())

    def run(self, query: StreamingQuery) -> None:
        files = len(_files(self.path))
        while True:
            query.processAllAvailable()
            if not files or (_position(self.path) or 0) > files:
                break
            clock.sleep(0.1)
        query.processAllAvailable()
        query.stop()
