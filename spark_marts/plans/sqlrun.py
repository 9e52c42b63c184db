"""Templated Spark SQL scripts (S20) and the zero-row check contract.

A script names its tables as ``{ns}table``; ``{ns}`` becomes a namespace prefix such as
``main.retail.`` or nothing when the tables are session views. Statements are split on
``;`` outside quotes and comments, run in order, and the last result is returned.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL_DIR = Path(__file__).parent / "sql"


def split_statements(text: str) -> list[str]:
    """Split on ``;`` that sit outside string literals, quoted names and comments."""
    out, buf, i, n = [], [], 0, len(text)
    quote = None
    while i < n:
        ch = text[i]
        if quote:
            buf.append(ch)
            if ch == quote:
                quote = None
            i += 1
        elif ch in ("'", '"', "`"):
            quote = ch
            buf.append(ch)
            i += 1
        elif text.startswith("--", i):
            j = text.find("\n", i)
            i = n if j < 0 else j
        elif text.startswith("/*", i):
            j = text.find("*/", i + 2)
            i = n if j < 0 else j + 2
        elif ch == ";":
            out.append("".join(buf))
            buf = []
            i += 1
        else:
            buf.append(ch)
            i += 1
    out.append("".join(buf))
    return [s.strip() for s in out if s.strip()]


def load_script(name: str) -> str:
    path = Path(name)
    if not path.is_absolute() and not path.exists():
        path = SQL_DIR / (name if name.endswith(".sql") else f"{name}.sql")
    return path.read_text(encoding="utf-8")


def run_script(
    spark: SparkSession,
    name: str,
    tables: Mapping[str, DataFrame] | None = None,
    ns: str = "",
) -> DataFrame:
    """Run a script against ``tables`` (registered as session views) or a namespace."""
    for view, df in (tables or {}).items():
        df.createOrReplaceTempView(view)
    text = load_script(name).replace("{ns}", ns)
    result = None
    for stmt in split_statements(text):
        result = spark.sql(stmt)
    if result is None:
        raise ValueError(f"script {name} holds no statement")
    return result


class CheckFailed(AssertionError):
    """``failing``: the rows that each failed check returns, as a frame."""

    def __init__(self, failing: Mapping[str, DataFrame]):
        super().__init__(f"{len(failing)} check(s) returned rows: {sorted(failing)}")
        self.failing = dict(failing)


def run_checks(checks: Mapping[str, DataFrame]) -> dict[str, int]:
    """Zero-row contract: a check passes iff it returns no row. All checks run; the
    failing ones are reported together, with their rows still to be read. Only ``limit(1)`` of each is fetched."""
    failing = {name: df for name, df in checks.items() if not df.isEmpty()}
    if failing:
        raise CheckFailed(failing)
    return {name: 0 for name in checks}


def check_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """``check_name, failing_rows`` of every check, passed ones included, in one plan."""
    counts = [df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("failing_rows")) for name, df in checks.items()]
    return reduce(DataFrame.unionByName, counts)
