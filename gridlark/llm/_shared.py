"""What the text operators share: scratch tables in the shared folder and Arrow batch mapping.

Rules that hold for every operator here:

* a document is a row; rows with equal or null doc_id stay separate rows,
* a null text is an empty text,
* input columns that an operator does not need are passed through or ignored;
  an input column with the name of an output column, in any case of letters, is
  replaced by the output; temporary columns get names that the input has not,
* no setting of the session is changed.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes that separate words, as a Java and Python character class body.
SPACE = r"\x20\x09-\x0D"
#: Bytes of text that Python code handles at a time.
CHUNK_BYTES = 4 << 20

_fallback: list[str] = []
#: Scratch folders that are still there, and the temporary() blocks that are open.
_roots: set[str] = set()
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session without executors of its own may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _fallback:
        _fallback.append("file://" + tempfile.mkdtemp(prefix="gridlark-"))
    return _fallback[0]


def _delete(path: str) -> None:
    """Through Spark while a session runs, else through Arrow."""
    sc = SparkContext._active_spark_context
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    else:
        place, inner = fs.FileSystem.from_uri(path)
        if place.get_file_info(inner).type == fs.FileType.Directory:
            place.delete_dir(inner)


@atexit.register
def _delete_all() -> None:
    for root in list(_roots):
        with contextlib.suppress(Exception):  # the JVM may be gone
            _delete(root)
        _roots.discard(root)


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Deletes at its end the scratch tables that were begun inside: whatever reads them must have been written by then."""
    _open.append([])
    try:
        yield
    finally:
        for root in _open.pop():
            _delete(root)
            _roots.discard(root)


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    Tables that only inner steps read are dropped by the operators; what a
    returned plan reads stays until temporary() or the application ends.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/gridlark-{what}-{uuid.uuid4().hex}", 0
        _roots.add(self.root)
        if _open:
            _open[-1].append(self.root)

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def save(self, df: DataFrame, codec: str = "zstd", by: str | None = None) -> DataFrame:
        """df, written. by: a column that gets a folder for each of its values."""
        path = self.path()
        writer = df.write.option("compression", codec)
        (writer.partitionBy(by) if by else writer).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._gridlark_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later plan reads."""
        for t in tables:
            _delete(t._gridlark_path)


def prefix(columns: Iterable[str]) -> str:
    """What temporary columns begin with: no column begins so."""
    own, out = [c.lower() for c in columns], "_"
    while any(c.startswith(out) for c in own):
        out += "_"
    return out


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df without columns of these names in any case of letters."""
    gone = {n.lower() for n in names}
    return df.select(*[df[quoted(c)] for c in df.columns if c.lower() not in gone])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES):
    """The batch in pieces of about `most` bytes of `column`, one row at least."""
    at = batch.schema.get_field_index(column)
    if batch.num_rows == 0 or batch.column(at).nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)


def rows_of(batches) -> Iterator[dict]:
    """Rows one at a time: large binary values of a batch are not copied all at once."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def with_outputs(schema: T.StructType, out: T.StructType) -> tuple[T.StructType, list[int]]:
    """`schema` without the fields that `out` replaces, then `out`; and the places of those kept."""
    new = {f.name.lower() for f in out}
    keep = [i for i, f in enumerate(schema) if f.name.lower() not in new]
    return T.StructType([*[schema[i] for i in keep], *out]), keep


def map_texts(docs: DataFrame, fn, out: T.StructType) -> DataFrame:
    """docs with the columns that fn(list of texts) -> dict of lists makes; bounded memory."""
    schema, keep = with_outputs(docs.schema, out)
    arrow, names = to_arrow_schema(out), schema.fieldNames()
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        work = fn()
        for whole in batches:
            for b in slices(whole, whole.schema.names[at]):
                made = work(texts(b.column(at)))
                yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.array(made[f.name], f.type) for f in arrow], names=names)

    return docs.mapInArrow(run, schema)
