"""JDBC tables. Drivers are the caller's: pass their jars when launching Spark."""
from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.session import setting

# Fixed value: the environment setting for the number of JDBC write partitions.
WRITE_PARTITIONS = "JDBC_WRITE_PARTITIONS"

# Rows per round trip. Without it some drivers buffer a whole partition.
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str = ""
    password: str = ""
    driver: str = ""

    @classmethod
    def from_env(
        cls, prefix: str, driver: str, environ: Mapping[str, str] | None = None, **defaults: str
    ) -> JdbcTarget:
        """Read ``<prefix>_JDBC_URL``, ``<prefix>_USER`` and ``<prefix>_PASSWORD``."""
        environ = os.environ if environ is None else environ
        return cls(
            url=environ.get(f"{prefix}_JDBC_URL", defaults.get("url", "")),
            user=environ.get(f"{prefix}_USER", defaults.get("user", "")),
            password=environ.get(f"{prefix}_PASSWORD", defaults.get("password", "")),
            driver=driver,
        )

    def options(self) -> dict[str, str]:
        return {"url": self.url, **self.properties()}

    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": self.driver}


@dataclass(frozen=True)
class RangeSplit:
    """Parallel scan over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    parts: int


@dataclass(frozen=True)
class HexSplit:
    """Parallel scan over a SHA-256 key: even parts, no bounds to look up."""

    column: str
    parts: int

    def predicates(self) -> list[str]:
        edges = [f"{part * 0x10000 // self.parts:04x}" for part in range(self.parts + 1)]
        clauses = []
        for part in range(self.parts):
            bounds = []
            if part:
                bounds.append(f"{self.column} >= '{edges[part]}'")
            if part < self.parts - 1:
                bounds.append(f"{self.column} < '{edges[part + 1]}'")
            clause = " AND ".join(bounds) or "1 = 1"
            clauses.append(clause if part else f"({clause} OR {self.column} IS NULL)")
        return clauses


def _literal(value: object) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class QuantileSplit:
    """Parallel scan in even parts over a skewed column: ranges of ``column`` and, within one
    value of it, of ``tie``. ``edges`` are the first (column, tie) of every part but the first.
    """

    column: str
    tie: str
    edges: Sequence[tuple[object, object]]

    @classmethod
    def of_sample(cls, sample: DataFrame, column: str, tie: str, parts: int,
                  most: int = 20_000) -> QuantileSplit:
        """Edges at the quantiles of a sample of the table, of which at most ``most`` rows are
        looked at. A value that many rows share is cut by ``tie``, best a unique column."""
        rows = sample.select(column, tie).where(
            F.col(column).isNotNull() & F.col(tie).isNotNull()).limit(most).collect()
        pairs = sorted(tuple(row) for row in rows)
        cuts = {pairs[len(pairs) * part // parts] for part in range(1, parts)} if pairs else set()
        return cls(column, tie, sorted(cuts))

    def predicates(self) -> list[str]:
        """SQL conditions of which exactly one holds for any row, nulls among them."""
        def before(edge):
            value, tie = map(_literal, edge)
            return (f"({self.column} IS NULL OR {self.column} < {value} OR ({self.column} = {value}"
                    f" AND ({self.tie} IS NULL OR {self.tie} < {tie})))")

        def from_(edge):
            value, tie = map(_literal, edge)
            return (f"({self.column} > {value} OR ({self.column} = {value}"
                    f" AND {self.tie} >= {tie}))")

        edges = list(self.edges)
        return [" AND ".join([*([from_(low)] if low else []), *([before(high)] if high else [])])
                or "1 = 1" for low, high in zip([None, *edges], [*edges, None], strict=True)]


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    split: RangeSplit | HexSplit | QuantileSplit | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> DataFrame:
    """Scan a table; without ``split`` the whole table comes through one connection."""
    fetch = {"fetchsize": str(fetch_rows)}
    if isinstance(split, (HexSplit, QuantileSplit)):
        return spark.read.jdbc(
            target.url, table, predicates=split.predicates(),
            properties={**target.properties(), **fetch},
        )
    reader = spark.read.format("jdbc").options(**target.options(), **fetch, dbtable=table)
    if split is not None:
        reader = reader.options(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.parts,
        )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str = "overwrite",
    partitions: int | None = None,
    create_table_options: str | None = None,
) -> None:
    """Write a table over ``partitions`` connections.

    The default is the ``JDBC_WRITE_PARTITIONS`` setting, and without it the
    frame's own partitions. Spark commits each partition on its own, so a task
    that fails after its commit is written twice; rerun the full overwrite.
    """
    if partitions is None and setting(WRITE_PARTITIONS):
        partitions = int(setting(WRITE_PARTITIONS))
    if partitions is not None:
        df = df.repartition(partitions)
    writer = df.write.format("jdbc").mode(mode).options(**target.options(), dbtable=table)
    if create_table_options:
        writer = writer.option("createTableOptions", create_table_options)
    writer.save()
