"""Several tables published as one: each run writes tables of its own generation, and one catalog property names the
generation that readers use.

The property of the database is set in one catalog call after every table is written, so readers see the tables of one
run or of the next, never some of each; a run that fails leaves them on the old ones and takes its own away. The property
is the only place where a generation becomes visible: no table is renamed, overwritten or pointed elsewhere.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from salesflow.functions.names import quoted, quoted_text


def _property(name: str) -> str:
    return f"salesflow.{name}.generation"


def generation_table(database: str, base: str, label: str) -> str:
    return f"{database}.{base}__g{label}"


def published_generation(spark: SparkSession, database: str, name: str) -> str | None:
    """The label of the generation that readers use now; None before the first."""
    told = spark.sql(f"DESCRIBE DATABASE EXTENDED {quoted(database)}").where(F.lower("info_name") == "properties").first()
    found = re.search(rf"\({re.escape(_property(name))},(\w+)\)", told[1] if told else "")
    return found[1] if found else None


def _number(label: str | None) -> int:
    return int(label.split("_")[0]) if label else 0


@dataclass
class Generation:
    """A run's tables. The label is a number and a mark of the run, so that no folder of a killed run is met again."""

    database: str
    label: str
    made: list[str] = field(default_factory=list)

    def table(self, base: str) -> str:
        """The name under which this generation's table ``base`` is to be written."""
        self.made.append(generation_table(self.database, base, self.label))
        return self.made[-1]


def _labels(spark: SparkSession, database: str, bases: tuple[str, ...]) -> dict[str, str]:
    """The generations' tables of these names, with their labels."""
    tables = (r.tableName for r in spark.sql(f"SHOW TABLES IN {quoted(database)} LIKE '*__g*'").collect())
    found = {t: re.fullmatch(r"(.*)__g(\d+_\w+)", t) for t in tables}
    return {t: m[2] for t, m in found.items() if m and m[1] in bases}


@contextmanager
def next_generation(spark: SparkSession, database: str, name: str, bases: tuple[str, ...], keep: int = 1) -> Iterator[Generation]:
    """A new generation of the tables ``bases``: published when the block ends, dropped when it raises.

    ``keep`` generations before the published one stay for readers that have begun; older ones, and tables that a killed
    run left, are dropped. If another run published meanwhile, this one raises and its tables go: two runs never mix."""
    before = published_generation(spark, database, name)
    mine = _labels(spark, database, bases)
    last = _number(before)
    made = Generation(database, f"{max([last, *map(_number, mine.values())]) + 1}_{uuid.uuid4().hex[:8]}")
    try:
        yield made
        if published_generation(spark, database, name) != before:
            raise RuntimeError(f"another run published {name} in {database} meanwhile")
        spark.sql(f"ALTER DATABASE {quoted(database)} SET DBPROPERTIES ({quoted_text(_property(name))} = '{made.label}')")
    except BaseException:
        for table in made.made:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    for table, label in mine.items():
        if _number(label) <= last - keep or label != before and _number(label) >= last:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(database)}.{quoted(table)}")
