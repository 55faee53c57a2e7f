"""Tables kept as immutable Parquet deltas, made visible together by one small manifest.

A batch writes only files of its own: one delta per table it touches. Nothing of it can be seen until
its manifest, written last under the next free number, names all live deltas of all tables. So the
tables of a run appear together or not at all, a reader that has started keeps its snapshot, and the
work of a small batch does not depend on the size of the tables.

A table with keys is merged when read: of rows with one key those of the latest delta count. The
older deltas lose the newer ones' keys in an anti join, so the oldest, largest delta is scanned with
the filters and columns of the query, and never sorted or shuffled while the newer keys are few; many
of them meet it in a shuffle, never in the driver.
``fold`` keeps deltas few: it joins the newest ones as long as they are not much smaller than
what lies below, so a row is rewritten a logarithmic number of times.

A retraction is a delta of values, not of rows: older rows with one of them in its columns are gone,
in keyed and other tables alike. What the same run writes besides is newer than its retraction.

Deltas can be laid out by partition columns, and within files sorted by lookup columns, which also get
Parquet Bloom filters; a search for one value then skips the row groups without it.

One writer at a time: a second one that takes the same number fails and leaves nothing visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from labweave.sources.config import measured

LOG = "_snapshots"
#: A delta is joined with the one below it unless that has this many times its rows; up to so many
#: deltas are left as they are.
FOLD_RATIO = 4
FEW = 6


@dataclass(frozen=True)
class Delta:
    """One batch's rows of one table: folder below the table's, and how to read it."""

    folder: str
    run: str
    rows: int
    schema: str
    keys: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()
    #: Not empty: a retraction, whose values in these columns older deltas lose.
    gone: tuple[str, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    """The live deltas per table, oldest first, and the last batch number of each numbered run."""

    number: int = 0
    tables: dict[str, tuple[Delta, ...]] = field(default_factory=dict)
    numbered: dict[str, int] = field(default_factory=dict)


def filesystem(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as its own object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, p = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The latest snapshot of the tables below ``root``, or the one of that number."""
    names = [n for n in _listed(spark, f"{root}/{LOG}") if n.endswith(".json") and n[0] not in "._"]
    if number is not None:
        names = [n for n in names if int(n[:-5]) == number]
    if not names:
        return Snapshot()
    fs, p = filesystem(spark, f"{root}/{LOG}/{names[-1]}")
    stream = fs.open(p)
    try:
        raw = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(raw["number"], {
        name: tuple(Delta(**{k: tuple(v) if isinstance(v, list) else v for k, v in d.items()})
                    for d in deltas) for name, deltas in raw["tables"].items()}, raw["numbered"])


def _publish(spark: SparkSession, root: str, snap: Snapshot) -> None:
    """Write the manifest aside and give it its final name, which must be free."""
    body = json.dumps({"number": snap.number, "numbered": snap.numbered,
                       "tables": {t: [asdict(d) for d in ds] for t, ds in snap.tables.items()}})
    final = f"{root}/{LOG}/{snap.number:012d}.json"
    fs, target = filesystem(spark, final)
    _, aside = filesystem(spark, f"{root}/{LOG}/.{snap.number:012d}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(body, "utf-8"))
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise RuntimeError(f"another writer has published {final}")


def write_delta(
    df: DataFrame, root: str, table: str, *, run: str, keys: Sequence[str] = (),
    by: Sequence[str] = (), lookup: Sequence[str] = (),
) -> tuple[str, Delta]:
    """Write one batch's rows (one row per key) for :func:`publish`. Partition columns must not hold
    the empty text, which a folder name can't tell from null."""
    schema = df.schema
    for c in by:
        if schema[c].dataType.simpleString() == "string":
            df = df.withColumn(c, F.when(F.col(c) == "", F.raise_error(F.lit(
                f"empty text in the partition column {c} of {table}"))).otherwise(F.col(c)))
    if by or lookup:  # a partition's rows together, few files; AQE cuts large partitions
        df = df.hint("rebalance", *(by or lookup)).sortWithinPartitions(*by, *lookup)
    folder = f"delta-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    for c in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(f"{root}/{table}/{folder}")
    # From the files' footers: of an empty plan, an observation would be optimised away.
    rows = df.sparkSession.read.schema(schema).parquet(f"{root}/{table}/{folder}").count()
    return table, Delta(folder, run, rows, schema.json(), tuple(keys), tuple(by), tuple(lookup))


def write_retraction(
    values: DataFrame, root: str, table: str, on: Sequence[str], *, run: str,
) -> tuple[str, Delta]:
    """Write the distinct values of ``on`` whose older rows :func:`publish` is to take away."""
    name, delta = write_delta(values.select(*on).distinct(), root, table, run=run)
    return name, replace(delta, gone=tuple(on))


def publish(
    spark: SparkSession, root: str, deltas: Iterable[tuple[str, Delta]], *, run: str,
    number: int | None = None, reset: bool = False,
) -> bool:
    """Make the deltas of one run visible, all at once.

    A run that was published before is replaced: its earlier deltas go. A numbered batch (of a
    stream) that comes again changes nothing, which is returned as False. ``reset`` drops all else.
    """
    now = snapshot(spark, root)
    if number is not None and not reset and number <= now.numbered.get(run, -1):
        return False
    tables = {} if reset else {
        t: tuple(d for d in ds if number is not None or d.run != run) for t, ds in now.tables.items()}
    for table, delta in deltas:
        tables[table] = (*tables.get(table, ()), delta)
    numbered = {} if reset else dict(now.numbered)
    if number is not None:
        numbered[run] = number
    _publish(spark, root, Snapshot(now.number + 1, tables, numbered))
    return True


def _rows(spark: SparkSession, root: str, table: str, delta: Delta) -> DataFrame:
    schema = StructType.fromJson(json.loads(delta.schema))
    return spark.read.schema(schema).parquet(f"{root}/{table}/{delta.folder}").select(*schema.names)


def _without(rows: DataFrame, newer: Sequence[tuple[Delta, DataFrame]], on: Sequence[str]) -> DataFrame:
    values = reduce(DataFrame.unionByName, [p.select(*on) for _, p in newer])
    values = measured(values.select(*[F.col(c).alias(f"_newer_{c}") for c in on]),
                      rows=sum(d.rows for d, _ in newer))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_newer_{c}")) for c in on])
    return rows.join(values, same, "left_anti")


def _merged(spark: SparkSession, root: str, table: str, deltas: Sequence[Delta]) -> DataFrame:
    parts = [_rows(spark, root, table, d) for d in deltas]
    merged = []
    for i, (delta, part) in enumerate(zip(deltas, parts)):
        if delta.gone:
            continue
        newer = [(d, p) for d, p in zip(deltas[i + 1:], parts[i + 1:])]
        same_keys = [(d, p) for d, p in newer if not d.gone] if delta.keys else []
        if same_keys:
            part = _without(part, same_keys, delta.keys)
        for on in dict.fromkeys(d.gone for d, _ in newer if d.gone):
            part = _without(part, [(d, p) for d, p in newer if d.gone == on], on)
        merged.append(part)
    if not merged:  # retractions alone
        return parts[0].limit(0)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), merged)


def read(spark: SparkSession, root: str, table: str, *, number: int | None = None) -> DataFrame | None:
    """The table as of the latest (or that) snapshot; a column that older deltas lack is null there.
    None while nothing has been published."""
    deltas = snapshot(spark, root, number).tables.get(table)
    return _merged(spark, root, table, deltas) if deltas else None


def fold(spark: SparkSession, root: str, table: str, *, ratio: int = FOLD_RATIO, few: int = FEW) -> int:
    """Join the newest deltas into one if there are more than ``few``, down to the first that has
    ``ratio`` times the rows above it; a ratio of 0 joins all. Returns how many were joined. Readers
    see the same rows."""
    now = snapshot(spark, root)
    deltas = now.tables.get(table, ())
    if ratio and len(deltas) <= few:
        return 0
    first = len(deltas) - 1
    above = max(deltas[-1].rows, 1) if deltas else 0
    # A retraction acts on what lies below it, so only a fold of all deltas may use it up.
    while first > 0 and (not ratio or (
            not deltas[first - 1].gone and deltas[first - 1].rows < ratio * above)):
        first -= 1
        above += deltas[first].rows
    group = deltas[first:]
    if len(group) < 2 or group[-1].gone and first:
        return 0
    last = next((d for d in reversed(group) if not d.gone), None)
    if last is None:
        return 0
    merged = _merged(spark, root, table, group)
    _, joined = write_delta(merged, root, table, run="fold", keys=last.keys, by=last.by,
                            lookup=last.lookup)
    _publish(spark, root, replace(now, number=now.number + 1, tables={
        **now.tables, table: (*deltas[:first], joined)}))
    return len(group)


def vacuum(spark: SparkSession, root: str, *, keep: int = 10,
           older: Callable[[int], bool] = lambda modified_ms: True) -> int:
    """Delete deltas that none of the last ``keep`` snapshots names (left by folds, replaced runs and
    writers that failed), and older manifests. ``older`` tells from a folder's time whether it may go;
    give a running writer's deltas time to be published."""
    names = [n for n in _listed(spark, f"{root}/{LOG}") if n.endswith(".json")]
    live = {f"{t}/{d.folder}" for n in names[-keep:]
            for t, ds in snapshot(spark, root, int(n[:-5])).tables.items() for d in ds}
    gone = 0
    fs, base = filesystem(spark, root)
    tables = [s.getPath() for s in fs.listStatus(base)
              if s.isDirectory() and s.getPath().getName() != LOG] if fs.exists(base) else []
    for t in tables:
        for s in fs.listStatus(t):
            name = s.getPath().getName()
            if name.startswith("delta-") and f"{t.getName()}/{name}" not in live and older(
                    s.getModificationTime()):
                gone += fs.delete(s.getPath(), True)
    for n in names[:-keep]:
        fs.delete(filesystem(spark, f"{root}/{LOG}/{n}")[1], False)
    return gone
