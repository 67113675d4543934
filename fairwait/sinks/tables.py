"""Writing Parquet tables.

Three layouts. A *partitioned* table is a plain folder that reruns overwrite partition by
partition. A *snapshot* table keeps each full replacement in its own ``v=N`` folder; the
highest one that Spark marked as complete is current, so readers never see half a write. A *versioned*
table is partitioned, and a version holds the partitions that it replaces: Spark writes them to ``table_version=N``, and one small file, named
for the batch, commits them by saying in which version each partition is now.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert_latest, versions_of
from ..operators.windows import dedup_latest


# The codec of raw, of versions and of the updates merged into them; other tables are Snappy or as the session says.
DENSE = "zstd"
# Where rows are dealt by their number, a task gets no fewer than the first, and no more than the second if that takes more tasks than the session's.
FEW_ROWS, MANY_ROWS = 50_000, 1_000_000


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a table; folders with a leading underscore are not data."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def read_or_none(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """The Parquet table at ``path``, None where there is none yet. With ``merge_schema``
    columns that appeared later are NULL in older files; versioned tables keep their schema, so they need no look at any footer."""
    state = _state(spark, path)
    if state is not None:
        return _read_version(spark, path, state)
    if not _has_data(spark, path):
        return None
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_partition(df: DataFrame, path: str, part_col: str, rebalance: bool = True, codec: str = "snappy") -> int:
    """Parquet under ``part_col=value`` folders; only the partitions present in ``df``
    are replaced, so a rerun is harmless. Returns the rows written, counted by the write.

    ``rebalance`` brings rows of a partition together first, so that not every task writes
    a small file to every folder; adaptive execution splits a partition that is too large
    for one task and joins small ones.
    """
    seen = Observation()
    placed = df.hint("rebalance", part_col) if rebalance else df
    _overwrite(placed.observe(seen, F.count(F.lit(1)).alias("n")), path, part_col, codec)
    return seen.get["n"]


def write_folder(df: DataFrame, path: str, part_col: str, value: str, observed: Mapping[str, Column], codec: str = "snappy") -> dict:
    """``df`` as the partition ``value`` of a table as of ``write_partition``, which is replaced unless ``df`` is empty. Returns the aggregates
    ``observed`` of the rows and their number ``n``, taken by the write.

    The value is added to rows that were counted before, so Spark sees that it is the same for all and does not sort by it.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"), *[how.alias(c) for c, how in observed.items()])
    _overwrite(counted.withColumn(part_col, F.lit(value)), path, part_col, codec)
    return {"n": 0, **dict.fromkeys(observed), **seen.get}


def _overwrite(df: DataFrame, path: str, part_col: str, codec: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec)
    writer.partitionBy(part_col).parquet(path)


def by_name(df: DataFrame, have: T.StructType, extra: str = "raise") -> DataFrame:
    """``df`` in the columns and types of ``have``, matched by name without regard to case;
    what ``df`` lacks is NULL. Columns that ``have`` lacks "raise", "drop" or "widen": the
    last keeps them behind the others."""
    if extra not in ("raise", "drop", "widen"):
        raise ValueError(f"unknown extra {extra!r}")
    mine = {c.lower(): c for c in df.columns}
    more = [c for n, c in mine.items() if n not in {f.name.lower() for f in have}]
    if more and extra == "raise":
        raise ValueError(f"columns the table lacks: {more}")
    known = [
        (F.col(mine[f.name.lower()]) if f.name.lower() in mine else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in have
    ]
    return df.select(*known, *(more if extra == "widen" else []))


def append_raw(df: DataFrame, path: str, part_col: str | None = None, extra: str = "raise") -> int:
    """Append by column name without dedup; returns the rows loaded, counted by the write
    itself. ``extra`` says what becomes of columns the table does not have (see ``by_name``);
    widened tables are read with ``merge_schema``."""
    spark = df.sparkSession
    if _has_data(spark, path):
        df = by_name(df, spark.read.parquet(path).schema, extra)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer.partitionBy(part_col) if part_col else writer).parquet(path)
    return seen.get["n"]


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = [int(n[2:]) for n in names if n.startswith("v=")]
    return sorted(v for v in numbers if _exists(spark, f"{path}/v={v}/_SUCCESS"))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a snapshot table. ``schema`` gives a partition column its type,
    which folder names do not keep."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete snapshot under {path}")
    current = f"{path}/v={versions[-1]}"
    if schema is None:
        return spark.read.parquet(current)
    return spark.read.schema(schema).parquet(current).select(*schema.names)


def replace_table(df: DataFrame, path: str, part_col: str | None = None) -> int:
    """Replace the whole table with ``df``, which may read the current version; returns the
    new version number. Older versions stay for their readers until ``expire_versions``."""
    spark = df.sparkSession
    old = _versions(spark, path)
    version = old[-1] + 1 if old else 1
    placed = df.hint("rebalance", part_col) if part_col else df
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(part_col) if part_col else writer).parquet(f"{path}/v={version}")
    return version


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the latest ``keep`` complete versions of a snapshot table, which ends what
    still reads them; returns the versions deleted."""
    gone = _versions(spark, path)[: -max(keep, 1)]
    for version in gone:
        _delete(spark, f"{path}/v={version}")
    return gone


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table with this schema unless one is there; whether it was created."""
    if _has_data(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return True


def upsert_table(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    part_col: str,
    batch_id: int | str,
    ties: Sequence[str] = (),
    stable_partition: bool = False,
    high_water: str | None = None,
    keep: int = 2,
    aside: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
    stored: bool = False,
) -> list[str] | None:
    """Merge ``updates`` into a versioned table, rewriting only the partitions concerned.

    The newest version of a key wins. Returns the partitions rewritten (as text), or None if
    the batch was merged before: a batch that runs twice counts once. Use one ``batch_id`` per
    batch of the table, whoever writes it; one writer at a time. A batch that fails anywhere leaves the table as it was.

    A key whose partition value changed is removed from its old partition, which takes a
    scan of the key column; ``stable_partition=True`` states that this cannot happen.
    ``high_water`` names a column whose maximum over all batches is kept with the table, ``aside`` columns of ``ties`` that are not
    stored, ``derived`` columns that follow from others (see ``replace_latest``). Partitions replaced ``keep`` versions ago are
    deleted, which ends what still reads them.

    ``stored`` states that ``updates`` are read from a table, row by row and the same each time: then they are not landed once more, and
    rows are dealt out by ``sizes`` (see ``replace_latest``), for which single columns are read, not whole rows.
    """
    spark = updates.sparkSession
    if committed(spark, path, batch_id):
        return None
    table = read_or_none(spark, path)
    if table is None:
        sizes = partition_sizes(updates, part_col)[0] if stored else None
        return replace_latest(updates, path, keys, order, part_col, batch_id, ties, aside, [], None, keep, high_water, derived, sizes)
    fresh = updates
    if not stored:
        # The increment is worked out once and read back from here; readers pass over the folder.
        own = f"{path}/_updates"
        updates.write.mode("overwrite").option("compression", DENSE).parquet(own)
        fresh = spark.read.schema(updates.schema).parquet(own)
    sizes, newest = partition_sizes(fresh, part_col, high_water)
    concerned = [*sizes] if stable_partition else _concerned(table, partitions(spark, path)[1], fresh, [*sizes], keys, part_col)
    # As literals the values prune the scan to their folders.
    old = table.filter(_parts(part_col, table.schema[part_col].dataType, concerned))
    if stored:
        sizes = Counter(sizes) + Counter(partition_sizes(old, part_col)[0])
    return replace_latest(
        versions_of(old, fresh), path, keys, order, part_col, batch_id, ["_new", *ties], ["_new", *aside], concerned, newest, keep,
        derived=derived, sizes=sizes if stored else None,
    )


def replace_latest(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    part_col: str,
    batch_id: int | str,
    ties: Sequence[str] = (),
    aside: Sequence[str] = (),
    replaced: Sequence[str] | None = None,
    high_water: str | None = None,
    keep: int = 2,
    observe: str | None = None,
    derived: Mapping[str, Column] | None = None,
    sizes: Mapping[str, int] | None = None,
) -> list[str]:
    """``replace_partitions`` with the newest version of each key in ``rows``, without the columns ``aside``.

    Rows move once: to ranges of partition value and key, where the versions of a key meet and from where they are written. That leaves
    out a key with versions in several partitions, so the keys written are counted; if one is there twice, the version, not committed yet, is
    written again from rows that were brought together by key alone.

    ``derived`` gives columns of ``rows``, the partition too, as expressions of the other ones: they are not moved, but worked out where the rows
    arrive. None of them may be a key, an order or a tie.

    To find bounds of ranges all of ``rows`` are worked out once before they move. With ``sizes``, rows per partition value (as ``partition_sizes``
    has them), they are not: the partitions are laid end to end and cut into equal parts, and a key's place in its partition is told by its hash.
    """
    derived = dict(derived or {})
    lean = rows.drop(*derived)
    part = derived.get(part_col, F.col(part_col))
    stored = [c for c in rows.columns if c not in aside]

    def whole(moved: DataFrame) -> DataFrame:
        return moved.withColumns({c: how for c, how in derived.items() if c not in moved.columns}).select(*stored)

    if sizes:
        moved = _dealt(lean, part, keys, sizes).withColumn(part_col, part)
        meet = [part_col, *keys, _PLACE]
    else:
        moved = lean.repartitionByRange(part, *keys).withColumn(part_col, part)
        meet = [part_col, *keys]
    return replace_partitions(
        whole(dedup_latest(moved, meet, order, ties)), path, part_col, batch_id, replaced, high_water, keep, observe,
        placed=True, unique=keys, otherwise=lambda: whole(dedup_latest(lean, keys, order, ties)),
    )


def replace_partitions(
    df: DataFrame,
    path: str,
    part_col: str,
    batch_id: int | str,
    replaced: Sequence[str] | None = None,
    high_water: str | None = None,
    keep: int = 2,
    observe: str | None = None,
    placed: bool = False,
    unique: Sequence[str] = (),
    otherwise: Callable[[], DataFrame] | None = None,
) -> list[str]:
    """Write ``df`` as the next version of a versioned table: its partitions, and those in ``replaced`` (as text) that it has no
    rows for, take the place of the same ones; the others stay where they are. ``replaced=None`` replaces the whole table.

    ``df`` may read the table. What a failed write left behind is overwritten by the next. ``high_water`` is a value to keep with the table if it is
    the largest so far, ``observe`` a column whose maximum is taken for it as the rows are written. Returns the partitions replaced.

    ``placed`` says that a task of ``df`` holds few partitions, as when it reads a table in the same partitions; then nothing is shuffled.
    If ``unique`` is twice in what was written, it is overwritten with the rows of ``otherwise``.
    """
    spark = df.sparkSession
    if _VERSION in df.columns:
        raise ValueError(f"{_VERSION} is the name of the folders of versions")
    df = df.select(*[c for c in df.columns if c != part_col], part_col)
    state = _state(spark, path) or {"version": 0, "parts": {}, "high_water": None}
    version = state["version"] + 1
    target = f"{path}/{_VERSION}={version}"

    def write(rows: DataFrame) -> str | None:
        seen = Observation()
        (
            (rows if observe is None else rows.observe(seen, F.max(observe).cast("string").alias("newest")))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", DENSE)
            .partitionBy(part_col)
            .parquet(target)
        )
        return None if observe is None else seen.get.get("newest")

    newest = write(df if placed else df.hint("rebalance", part_col))
    if otherwise is not None and _repeated(spark.read.schema(df.schema).parquet(target), unique):
        newest = write(otherwise().select(*df.columns).hint("rebalance", part_col))
    written = _folders(spark, f"{path}/{_VERSION}={version}", part_col)
    gone = {p for p in state["parts"] if replaced is None or p in set(replaced)} - set(written)
    parts = {p: v for p, v in state["parts"].items() if p not in gone} | dict.fromkeys(written, version)
    marks = [m for m in (state["high_water"], high_water, newest) if m]
    new = {
        "version": version,
        "parts": parts,
        "high_water": max(marks, default=None),
        "part_col": part_col,
        "schema": json.loads(df.schema.json()),
        # Folders that no partition is read from any more, by the version that replaced them.
        "old": [x for x in state.get("old", []) if x[0] > version - keep]
        + [[version, state["parts"][p], p] for p in sorted((set(written) | gone) & set(state["parts"]))],
    }
    commit = f"{path}/_versions/{version:08d}-{batch_id}"
    write_text(spark, f"{commit}.part", json.dumps(new))
    fs, here = _path(spark, f"{commit}.part")
    if not fs.rename(here, _path(spark, commit)[1]):
        raise OSError(f"cannot commit {commit}")
    for when, old, part in state.get("old", []):
        if when <= version - keep:
            folder = _folders(spark, f"{path}/{_VERSION}={old}", part_col).get(part)
            if folder is not None:
                _delete(spark, f"{path}/{_VERSION}={old}/{folder}")
    return sorted({*written, *gone})


def committed(spark: SparkSession, path: str, batch_id: int | str) -> bool:
    """Whether a versioned table holds the batch."""
    return str(batch_id) in batches(spark, path)


def batches(spark: SparkSession, path: str) -> list[str]:
    """The batches of a versioned table, in the order of their versions."""
    return [n.split("-", 1)[1] for n in names(spark, f"{path}/_versions") if not n.endswith(".part")]


def high_water_mark(spark: SparkSession, path: str) -> str | None:
    """The largest value, as text, of the column named by ``high_water`` in all merged batches."""
    return (_state(spark, path) or {}).get("high_water")


def partitions(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """The version of a versioned table (0 where there is none) and of each of its partitions, by their values as text."""
    state = _state(spark, path) or {"version": 0, "parts": {}}
    return state["version"], state["parts"]


def read_partitions(spark: SparkSession, path: str, values: Sequence[str]) -> DataFrame:
    """The rows of some partitions of a versioned table, named as ``partitions`` names them; no other file is opened."""
    state = _state(spark, path)
    return _read_version(spark, path, {**state, "parts": {p: v for p, v in state["parts"].items() if p in set(values)}})


def _state(spark: SparkSession, path: str) -> dict | None:
    """The last commit of a versioned table."""
    done = [n for n in names(spark, f"{path}/_versions") if not n.endswith(".part")]
    return json.loads(read_text(spark, f"{path}/_versions/{done[-1]}")) if done else None


def _read_version(spark: SparkSession, path: str, state: dict) -> DataFrame:
    """The rows of the state's partitions. The filter is on folders alone, so Spark opens no other file."""
    schema, part = T.StructType.fromJson(state["schema"]), state["part_col"]
    by_version: dict[int, list[str]] = {}
    for value, version in state["parts"].items():
        by_version.setdefault(version, []).append(value)
    if not by_version:
        return spark.createDataFrame([], schema)
    # Folder names lose their type on reading; the kept schema has it.
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_VERSION, T.IntegerType())])).parquet(path)
    here = [(F.col(_VERSION) == n) & _parts(part, schema[part].dataType, values) for n, values in sorted(by_version.items())]
    return rows.filter(reduce(Column.__or__, here)).select(*schema.names)


def _parts(part_col: str, kind: T.DataType, values: Sequence[str]) -> Column:
    """Partitions named as text."""
    known = [F.lit(v).cast(kind) for v in values if v != _NULL_FOLDER]
    found = F.col(part_col).isin(known) if known else F.lit(False)
    return found | F.col(part_col).isNull() if _NULL_FOLDER in values else found


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.endswith(".crc"))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


_VERSION = "table_version"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, path: str, part_col: str) -> dict[str, str]:
    """Partition value as text -> folder name."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    prefix = f"{part_col}="
    return {unquote(n[len(prefix):]): n for n in names if n.startswith(prefix)}


def _repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    return bool(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").take(1))


def partition_sizes(df: DataFrame, part_col: str, high_water: str | None = None) -> tuple[dict[str, int], str | None]:
    """Rows per partition value, named as ``partitions`` names them, and the maximum of ``high_water`` as text. Values, not rows, come to the
    driver: at most as many as the table has folders."""
    most = F.lit(None).cast("string") if high_water is None else F.max(high_water)
    each = df.groupBy(F.col(part_col).alias("_p")).agg(F.count(F.lit(1)).alias("_n"), most.alias("_most"))
    found = each.agg(F.collect_list(F.struct(F.col("_p").cast("string").alias("p"), "_n")).alias("parts"), F.max("_most").cast("string").alias("most")).first()
    return {_NULL_FOLDER if p is None else p: n for p, n in found["parts"]}, found["most"]


_PLACE = "_place"
_FRACTIONS = 20  # bits


def _dealt(df: DataFrame, part: Column, keys: Sequence[str], sizes: Mapping[str, int]) -> DataFrame:
    """``df`` dealt out so that rows with the same partition value and key meet, few partition values come to a task and tasks get equal numbers
    of rows; its number is in ``_place``. Sizes that are not right make uneven tasks, no wrong ones."""
    spark, total = df.sparkSession, sum(sizes.values())
    tasks = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // MANY_ROWS), total // FEW_ROWS + 1)
    laid, before = [], 0
    for value, n in sorted(sizes.items()):
        laid.append((None if value == _NULL_FOLDER else value, before, n))
        before += n
    # One row per partition value, so it may be sent to all tasks.
    line = F.broadcast(spark.createDataFrame(laid, "_value string, _before bigint, _rows bigint"))
    at = F.col("_before") + F.shiftright(F.pmod(F.xxhash64(*keys), F.lit(1 << _FRACTIONS)) * F.col("_rows"), _FRACTIONS)
    place = F.coalesce(F.floor(at * tasks / total), F.lit(0)).cast("int")
    placed = df.join(line, part.cast("string").eqNullSafe(F.col("_value")), "left").select(*df.columns, place.alias(_PLACE))
    return placed.repartitionById(tasks, _PLACE)


def _concerned(
    table: DataFrame, held: Mapping[str, int], fresh: DataFrame, touched: Sequence[str], keys: Sequence[str], part_col: str
) -> list[str]:
    """The partitions to rewrite, as text: those ``touched`` by the rows of ``fresh``, and those of the others in the table that hold a key of
    them. Only the latter are read for it, and none if there is none."""
    others = [p for p in held if p not in set(touched)]
    if not others:
        return [*touched]
    keys = list(keys)
    elsewhere = table.filter(_parts(part_col, table.schema[part_col].dataType, others)).select(*keys, part_col)
    rows = elsewhere.join(fresh.select(*keys), keys, "left_semi").select(F.col(part_col).cast("string")).distinct().collect()
    return [*touched, *{_NULL_FOLDER if r[0] is None else r[0] for r in rows} - set(touched)]


def materialise(
    df: DataFrame,
    name: str,
    kind: str,
    root: str | None = None,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    ties: Sequence[str] = (),
    part_col: str | None = None,
) -> DataFrame:
    """Make a model available under ``name`` and return it for reading.

    "view" registers a temporary view, "table" replaces a snapshot under ``root``, and
    "incremental" merges by ``keys`` into the table there. With ``part_col`` and ``order`` that is a
    partitioned table of which only the partitions concerned are rewritten (``upsert_table``);
    otherwise a snapshot, rewritten whole. ``part_col`` makes folders by its value.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind not in ("table", "incremental"):
        raise ValueError(f"unknown kind {kind!r}")
    if root is None:
        raise ValueError(f"{kind} needs a root folder")
    path = f"{root.rstrip('/')}/{name}"
    if kind == "incremental" and part_col and order:
        upsert_table(df, path, keys, order, part_col, uuid.uuid4().hex, ties)
        current = read_or_none(spark, path)
        current.createOrReplaceTempView(name)
        return current
    if kind == "incremental" and _versions(spark, path):
        df = upsert_latest(read_snapshot(spark, path), df, keys, list(order) or None, ties)
    replace_table(df, path, part_col=part_col)
    current = read_snapshot(spark, path, df.schema)
    current.createOrReplaceTempView(name)
    return current
