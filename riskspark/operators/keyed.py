"""Tables with keys, dealt by a hash of the key, that take a batch without reading what it doesn't touch.

The files of a table lie in folders ``key_bucket=<n>`` and can be read as any
Parquet table. A change reads the files of the buckets that its keys fall into,
writes new files to a hidden folder, and publishes one small manifest of the new
version, exclusively: of two writers that start from one version the second is
refused. Then new files are moved into place and replaced ones deleted, which a
later reader or writer finishes after a crash. A manifest also holds the last
batch of each stream, so a batch that comes again changes nothing.

A bucket has at most ``MOST_FILES`` files: an insert that finds more rewrites
them as one. So what a batch of a few keys reads depends on the size of a bucket;
choose ``buckets`` for the size that the table will have.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.store import Refused, Store
from .joins import new_rows
from .merge import assert_unique, upsert_all, upsert_if

__all__ = ["Refused", "Version", "create_keyed", "insert_keyed", "newest", "read_keyed", "upsert_keyed"]

BUCKET = "key_bucket"
#: Files of a bucket before an insert puts them together.
MOST_FILES = 8
#: Manifests that are kept.
KEPT = 20


@dataclass(frozen=True)
class Version:
    """What a manifest says: the table's form, its live files, what the last change moved and replaced."""

    number: int
    keys: list[str]
    buckets: int
    schema: str
    partition_by: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    staged: str = ""
    added: list[str] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)


def _manifest(root: str, number: int) -> str:
    return f"{root}/_manifest/{number:020d}.json"


def _manifests(store: Store, root: str) -> list[str]:
    return [n for n in store.names(f"{root}/_manifest") if n.endswith(".json") and not n.startswith(".")]


def create_keyed(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64, partition_by: Sequence[str] = ()) -> Version:
    """Publish the empty first version of a table; ``Refused`` if there is one."""
    if BUCKET in schema.names:
        raise ValueError(f"{BUCKET} is the name of the table's folders")
    store = Store(spark, root)
    store.fs.mkdirs(store.path(f"{root}/_manifest"))
    first = Version(0, list(keys), buckets, T.StructType([T.StructField(f.name, f.dataType, True) for f in schema]).json(), list(partition_by))
    store.publish(_manifest(root, 0), json.dumps(asdict(first)))
    return first


def newest(spark: SparkSession, root: str) -> Version | None:
    """The table's newest version, its files in place; None if there is no table."""
    store = Store(spark, root)
    published = _manifests(store, root)
    if not published:
        return None
    version = Version(**json.loads(store.read(f"{root}/_manifest/{published[-1]}")))
    _settle(store, root, version)
    return version


def _settle(store: Store, root: str, version: Version) -> None:
    """Move a version's new files into place and delete replaced ones; twice is as once."""
    if version.staged and store.exists(f"{root}/{version.staged}"):
        for name in version.added:
            store.move(f"{root}/{version.staged}/{name}", f"{root}/{name}")
        for name in version.replaced:
            store.delete(f"{root}/{name}")
        store.delete(f"{root}/{version.staged}")


def _read(spark: SparkSession, root: str, version: Version, files: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(version.schema))
    if not files:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{f}" for f in files]
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).option("basePath", root).parquet(*paths)


def read_keyed(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest version."""
    version = newest(spark, root)
    if version is None:
        raise ValueError(f"no table at {root}")
    names = T.StructType.fromJson(json.loads(version.schema)).names
    return _read(spark, root, version, version.files).select(*names)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucket(name: str) -> int:
    return int(name.partition("=")[2].partition("/")[0])


def _touched(source: DataFrame, version: Version) -> dict[int, list[str]]:
    """Live files of the buckets that the source's keys fall into; as many rows as buckets reach the driver at most."""
    found = {r[0]: [] for r in source.select(bucket_of(version.keys, version.buckets)).distinct().collect()}
    for name in version.files:
        if _bucket(name) in found:
            found[_bucket(name)].append(name)
    return found


def _cast(source: DataFrame, version: Version) -> DataFrame:
    """The source in the table's columns, in which keys must be hashed to find their bucket."""
    fields = T.StructType.fromJson(json.loads(version.schema)).fields
    return source.select(*[(F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def _publish(spark: SparkSession, root: str, base: Version, rows: DataFrame, replaced: list[str], stream: str | None, batch: int | None) -> Version:
    """Write ``rows``, which take the place of the files ``replaced``, and publish the version after ``base``."""
    store, staged = Store(spark, root), f"_staged/{uuid.uuid4().hex}"
    dealt = rows.withColumn(BUCKET, bucket_of(base.keys, base.buckets)).repartition(BUCKET)
    dealt.write.partitionBy(BUCKET, *base.partition_by).parquet(f"{root}/{staged}")
    added = store.files(f"{root}/{staged}")
    streams = base.streams | ({stream: batch} if stream is not None else {})
    after = Version(base.number + 1, base.keys, base.buckets, base.schema, base.partition_by, sorted({*base.files, *added} - {*replaced}), staged, added, replaced, streams)
    try:
        store.publish(_manifest(root, after.number), json.dumps(asdict(after)))
    except Refused:
        store.delete(f"{root}/{staged}")
        raise
    _settle(store, root, after)
    for name in _manifests(store, root)[:-KEPT]:
        store.delete(f"{root}/_manifest/{name}")
    return after


def _opened(source: DataFrame, root: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str]) -> Version:
    spark = source.sparkSession
    version = newest(spark, root)
    if version is None:
        try:
            return create_keyed(spark, root, source.schema, keys, buckets, partition_by)
        except Refused:
            version = newest(spark, root)
    if list(keys) != version.keys:
        raise ValueError(f"the table's key is {version.keys}")
    return version


@contextmanager
def _changing(spark: SparkSession, root: str, version: Version) -> Iterator[None]:
    """A change that fails because another writer has meanwhile replaced the files it starts from is ``Refused``."""
    try:
        yield
    except Exception as e:
        if not isinstance(e, Refused) and _manifests(Store(spark, root), root)[-1] > f"{version.number:020d}.json":
            raise Refused(f"{root} has changed since version {version.number}") from e
        raise


def _came(version: Version, stream: str | None, batch: int | None) -> bool:
    return stream is not None and version.streams.get(stream, -1) >= batch


def insert_keyed(source: DataFrame, root: str, keys: Sequence[str], stream: str | None = None, batch: int | None = None, buckets: int = 64, partition_by: Sequence[str] = (), base: Version | None = None) -> Version:
    """Insert source rows of new keys, one a key; null keys count as new.

    Only the key columns of touched buckets are read. ``stream`` and ``batch`` name
    a batch of a stream, which is taken once. ``base`` is the version to start from,
    the newest if not given; the table is made if there is none.
    """
    spark = source.sparkSession
    version = base or _opened(source, root, keys, buckets, partition_by)
    if _came(version, stream, batch):
        return version
    source = _cast(source, version)
    with _changing(spark, root, version):
        touched = _touched(source, version)
        here = [f for files in touched.values() for f in files]
        fresh = new_rows(source, _read(spark, root, version, here), version.keys)
        full = [f for files in touched.values() if len(files) >= MOST_FILES for f in files]
        if full:
            fresh = fresh.unionByName(_read(spark, root, version, full).drop(BUCKET))
        return _publish(spark, root, version, fresh, full, stream, batch)


def files_with(spark: SparkSession, root: str, version: Version, source: DataFrame, files: Sequence[str]) -> list[str]:
    """Those of the files that hold a key of the source."""
    if not files:
        return []
    table = _read(spark, root, version, files).select(*version.keys, F.col("_metadata.file_path").alias("__file"))
    found = table.join(source.select(*version.keys).distinct(), version.keys, "left_semi").select("__file").distinct()
    paths = {f"/{BUCKET}={r[0].rpartition(f'/{BUCKET}=')[2]}" for r in found.collect()}
    return [f for f in files if f"/{f}" in paths]


def upsert_keyed(source: DataFrame, root: str, keys: Sequence[str], condition: Column | None = None, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, stream: str | None = None, batch: int | None = None, buckets: int = 64, base: Version | None = None) -> Version:
    """Update known keys and insert the rest, by rewriting the files that hold a key of the source and no other.

    Whole rows are taken, or those alone for which ``condition`` holds (as in
    ``upsert_if``); ``merge`` is another function of (rows of the rewritten files,
    source). A key that repeats in the source is an error. Files that hold touched
    keys are found from their key columns.
    """
    spark = source.sparkSession
    version = base or _opened(source, root, keys, buckets, ())
    if _came(version, stream, batch):
        return version
    source = _cast(source, version)
    assert_unique(source, version.keys)
    with _changing(spark, root, version):
        here = [f for files in _touched(source, version).values() for f in files]
        replaced = files_with(spark, root, version, source, here)
        old = _read(spark, root, version, replaced).drop(BUCKET)
        if merge is not None:
            rows = merge(old, source)
        elif condition is not None:
            rows = upsert_if(old, source, version.keys, condition)
        else:
            rows = upsert_all(old, source, version.keys)
        return _publish(spark, root, version, rows, replaced, stream, batch)


def drop_staged(spark: SparkSession, root: str) -> None:
    """Delete what writers that died or were refused have left; not while others write."""
    newest(spark, root)
    Store(spark, root).delete(f"{root}/_staged")


def compacted(spark: SparkSession, root: str) -> Version:
    """Rewrite every bucket that has more than one file."""
    version = newest(spark, root)
    count: dict[int, list[str]] = {}
    for name in version.files:
        count.setdefault(_bucket(name), []).append(name)
    several = [f for files in count.values() if len(files) > 1 for f in files]
    if not several:
        return version
    return _publish(spark, root, version, _read(spark, root, version, several).drop(BUCKET), several, None, None)
