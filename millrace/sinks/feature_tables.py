"""Named feature tables in the catalog: keys, partition columns, description, atomic replace.

``schema.table`` is a view over data tables ``schema.table__<id>``. Replacing the
contents writes a new data table and then points the view at it, so readers see the old
rows or the new ones, and a plan may read the table it replaces. Keys, partition columns
and the names of the data tables are properties of the view.

A refresh of some partitions, and a merge by key, write only the partitions they touch, as one more data table in
front of the earlier ones; the view takes each partition from the newest data table that has it. So either all
partitions of a refresh change, with the view, or none, and files of other partitions stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.latest import latest_by_key
from millrace.sources.exists import table_exists


# Data tables that a view may be made of before all but the first are written as one.
MOST_PARTS = 16
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
Partition = tuple[str | None, ...]


class KeyViolation(ValueError):
    """Rows with a NULL key, or several rows with one key."""


def ensure_schema(spark: SparkSession, schema: str, root: str | None = None) -> None:
    """Create the database of the tables, below ``root`` when given."""
    place = f" LOCATION {quoted(f'{root}/{schema}')}" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{place}")


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key is NULL or repeated; one shuffle of counts per key."""
    any_null = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0))
    found = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum(any_null), F.lit(0)).alias("null_keys"),
            F.count_if(F.col("rows") > 1).alias("repeated"),
        )
        .first()
    )
    if found["null_keys"] or found["repeated"]:
        raise KeyViolation(f"{found['null_keys']} NULL and {found['repeated']} repeated keys of {list(keys)}")


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Metadata of a feature table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    found = {r["key"]: r["value"] for r in rows}
    found["description"] = spark.catalog.getTable(name).description or ""
    return found


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _write_data(
    df: DataFrame, name: str, keys: Sequence[str], partition_by: Sequence[str], check: bool,
    rebalance: bool = True,
) -> str:
    """Write a new data table and check its keys there, so ``df`` is computed once."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    data = f"{name}__{stamp}_{uuid.uuid4().hex[:6]}"
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(data)
    try:
        if check:
            check_keys(df.sparkSession.table(data), keys)
    except KeyViolation:
        df.sparkSession.sql(f"DROP TABLE {data}")
        raise
    return data


def _partitions(spark: SparkSession, data: str) -> set[Partition]:
    """The partitions of a data table, from the catalog."""
    found = set()
    for row in spark.sql(f"SHOW PARTITIONS {data}").collect():
        values = (unquote(p.split("=", 1)[1]) for p in row["partition"].split("/"))
        found.add(tuple(None if v == NO_VALUE else v for v in values))
    return found


def _within(spark: SparkSession, data: str, partition_by: Sequence[str], partitions: Iterable[Partition]) -> str:
    """The condition that a row is in one of the partitions: comparisons with constants, so scans are pruned by it."""
    kinds = dict(spark.table(data).dtypes)

    def equal(column: str, value: str | None) -> str:
        return f"`{column}` <=> CAST({'NULL' if value is None else quoted(value)} AS {kinds[column]})"

    ordered = sorted(partitions, key=str)
    if len(partition_by) == 1:
        column = partition_by[0]
        known = ", ".join(f"CAST({quoted(v)} AS {kinds[column]})" for (v,) in ordered if v is not None)
        tests = [f"`{column}` IN ({known})"] if known else []
        tests += [f"`{column}` IS NULL"] if (None,) in ordered else []
    else:
        tests = [f"({' AND '.join(equal(c, v) for c, v in zip(partition_by, p))})" for p in ordered]
    return f"coalesce({' OR '.join(tests)}, false)" if tests else "false"


def _select(spark: SparkSession, parts: Sequence[str], columns: Sequence[str], partition_by: Sequence[str]) -> str:
    """The rows of data tables, oldest first: each partition from the newest that has it."""
    listed, newer, found = ", ".join(f"`{c}`" for c in columns), set(), []
    for data in reversed(parts):
        found.append(f"SELECT {listed} FROM {data}" + (f" WHERE NOT {_within(spark, data, partition_by, newer)}" if newer else ""))
        newer |= _partitions(spark, data) if len(parts) > 1 else set()
    return " UNION ALL ".join(reversed(found))


def _point(
    spark: SparkSession, name: str, parts: Sequence[str], columns: Sequence[str], description: str,
    keys: Sequence[str], partition_by: Sequence[str],
) -> None:
    """Make the view one over ``parts``: the single step in which contents change."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} ({listed}) COMMENT {quoted(description)} TBLPROPERTIES ("
        f"'keys' = {quoted(','.join(keys))}, 'partition_columns' = {quoted(','.join(partition_by))}, "
        f"'data' = {quoted(','.join(parts))}) AS {_select(spark, parts, columns, partition_by)}"
    )


def _listed(spark: SparkSession, name: str) -> tuple[list[str], list[str], list[str], str]:
    """Keys, partition columns, data tables and description of a feature table."""
    known = properties(spark, name)
    return *([x for x in known[k].split(",") if x] for k in ("keys", "partition_columns", "data")), known["description"]


def _expire(spark: SparkSession, name: str, keep: int) -> None:
    """Drop data tables that the view does not read, except the newest ``keep``."""
    schema, table = name.split(".")
    in_use = {d.split(".")[-1].lower() for d in _listed(spark, name)[2]}
    older = sorted(t.name for t in spark.catalog.listTables(schema, f"{table}__*") if not t.isTemporary)
    unused = [t for t in older if t.lower() not in in_use]
    for t in unused[: max(0, len(unused) - max(keep - 1, 0))]:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{t}")


def create_table(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    description: str = "",
    check: bool = True,
    rebalance: bool = True,
) -> None:
    """Create a feature table with its first contents."""
    absent = [c for c in [*keys, *partition_by] if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the data: {absent}")
    spark = df.sparkSession
    data = _write_data(df, name, keys, partition_by, check, rebalance)
    _point(spark, name, [data], df.columns, description, keys, partition_by)


def replace_table(
    df: DataFrame, name: str, keep: int = 2, check: bool = True, rebalance: bool = True
) -> None:
    """Replace all rows of a feature table; its keys, partitions and description stay.

    The newest ``keep`` data tables remain, for readers that started on an older one.
    """
    spark = df.sparkSession
    keys, partition_by, _, description = _listed(spark, name)
    data = _write_data(df, name, keys, partition_by, check, rebalance)
    _point(spark, name, [data], df.columns, description, keys, partition_by)
    _expire(spark, name, keep)


def _put_in_front(spark: SparkSession, name: str, data: str, keep: int) -> None:
    """Let the view take the partitions of ``data`` from there, in one step; fold many data tables into two."""
    keys, partition_by, parts, description = _listed(spark, name)
    columns = spark.table(name).columns
    parts = [*parts, data]
    if len(parts) > MOST_PARTS:
        # All partitions refreshed since the first data table was written, as one table; emptied ones stay listed.
        front = parts[1:]
        listed = set().union(*(_partitions(spark, d) for d in front))
        folded = _write_data(spark.sql(_select(spark, front, columns, partition_by)), name, keys, partition_by, check=False)
        _add_empty(spark, folded, partition_by, listed - _partitions(spark, folded))
        parts = [parts[0], folded]
    _point(spark, name, parts, columns, description, keys, partition_by)
    _expire(spark, name, keep)


def _add_empty(spark: SparkSession, data: str, partition_by: Sequence[str], partitions: Iterable[Partition]) -> None:
    """List partitions without rows in a data table."""
    specs = [
        f"PARTITION ({', '.join(f'`{c}` = ' + ('NULL' if v is None else quoted(v)) for c, v in zip(partition_by, p))})"
        for p in sorted(partitions, key=str)
    ]
    if specs:
        spark.sql(f"ALTER TABLE {data} ADD IF NOT EXISTS {' '.join(specs)}")


def replace_partitions(
    df: DataFrame, name: str, check: bool = True, rebalance: bool = True, keep: int = 2
) -> None:
    """Replace the partitions ``df`` has rows of, all of them or, after a failure, none.

    For a daily refresh of a table with years of history: cost follows the new days, not
    the table, and files of other days are not touched. ``df`` may read the same table.
    """
    spark = df.sparkSession
    keys, partition_by, _, _ = _listed(spark, name)
    if not set(partition_by) & set(keys):
        raise ValueError("only a table partitioned by one of its keys can be refreshed by partition")
    data = _write_data(df.select(*spark.table(name).columns), name, keys, partition_by, check, rebalance)
    _put_in_front(spark, name, data, keep)


def drop_vanished(spark: SparkSession, name: str, source: DataFrame, column: str, since: date, keep: int = 2) -> None:
    """Drop the days of a table partitioned by ``column``, from ``since`` on, that ``source`` has no row of; in one step."""
    days = source.where(F.col(column) >= F.lit(since)).select(column).distinct().collect()
    left = {str(r[0]) for r in days}
    _, partition_by, parts, _ = _listed(spark, name)
    if partition_by != [column]:
        raise ValueError(f"{name} is not partitioned by {column}")
    known = set().union(*(_partitions(spark, d) for d in parts))
    gone = {p for p in known if p[0] is not None and p[0] >= str(since) and p[0] not in left}
    if gone:
        data = _write_data(spark.table(name).limit(0), name, [], partition_by, check=False)
        _add_empty(spark, data, partition_by, gone)
        _put_in_front(spark, name, data, keep)


def merge_rows(df: DataFrame, name: str, keep: int = 2, check: bool = True) -> None:
    """Replace the rows whose key ``df`` has, add its other rows, keep the rest of the table.

    Only partitions that hold one of the keys, or get a row, are read and written. A table without partitions is
    written anew.
    """
    spark = df.sparkSession
    keys, partition_by, parts, _ = _listed(spark, name)
    if check:
        check_keys(df, keys)
    new, table = "_new", spark.table(name)
    current = table.withColumn(new, F.lit(False))
    if partition_by:
        places = df.select(*partition_by)
        if not set(partition_by) <= set(keys):
            # A key's old row may be in another partition than its new one.
            places = places.unionByName(table.join(df.select(*keys), keys, "left_semi").select(*partition_by))
        found = places.distinct().collect()
        if not found:
            return
        touched = {tuple(None if v is None else str(v) for v in row) for row in found}
        current = current.where(_within(spark, parts[0], partition_by, touched))
    rows = latest_by_key(current.unionByName(df.withColumn(new, F.lit(True))), keys, [new], drop=[new])
    if not partition_by:
        replace_table(rows, name, keep, check=False)
        return
    data = _write_data(rows.select(*table.columns), name, keys, partition_by, check=False)
    # A partition that lost its last row to another one.
    _add_empty(spark, data, partition_by, touched - _partitions(spark, data))
    _put_in_front(spark, name, data, keep)


def update_table(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    description: str = "",
    mode: str = "overwrite",
    publish=None,
    keep: int = 2,
    check: bool = True,
    rebalance: bool = True,
) -> None:
    """Create the table, or replace its contents when it exists; optionally publish it.

    ``mode`` is "overwrite" for the whole contents, "partitions" for the partitions in ``df`` or
    "merge" for the keys in ``df``. ``publish`` is called with the stored table. ``check=False`` skips the shuffle
    that proves the keys unique, for data that comes out of a grouping by these keys.
    ``rebalance=False`` skips the shuffle that gathers the rows of a partition, for data read
    from files that already hold one partition each.
    """
    spark = df.sparkSession
    if mode not in ("overwrite", "partitions", "merge"):
        raise ValueError(f"unknown mode {mode!r}")
    if not table_exists(spark, name):
        create_table(df, name, keys, partition_by, description, check, rebalance)
    elif mode == "overwrite":
        replace_table(df, name, keep, check, rebalance)
    elif mode == "merge":
        merge_rows(df, name, keep, check)
    else:
        replace_partitions(df, name, check, rebalance, keep)
    if publish is not None:
        publish(spark.table(name))
