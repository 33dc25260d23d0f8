"""SQL scripts: statements parted by blank lines, values filled into ``###NAME`` places, run until the first error."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def statements(text: str) -> list[str]:
    """The statements of a script. Lines that start with ``--`` or ``//`` are comments; a blank line ends a statement."""
    out, cur = [], []
    for line in [*text.splitlines(), ""]:
        if line.lstrip().startswith(("--", "//")):
            continue
        if line.strip():
            cur.append(line)
        elif cur:
            out.append("\n".join(cur).rstrip().rstrip(";"))
            cur = []
    return out


def sql_list(values: list[str] | str) -> str:
    """``('a','b')`` from a list or a blank-separated string."""
    values = values.split() if isinstance(values, str) else values
    return "(" + ",".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def filled(template: str, **values: str) -> str:
    """``###NAME`` replaced by its value; an unknown name is an error."""

    def one(m: re.Match) -> str:
        if m[1] not in values:
            raise KeyError(f"no value for ###{m[1]}")
        return values[m[1]]

    return re.sub(r"###([A-Z]+)", one, template)


def run_script(spark: SparkSession, text: str) -> tuple[list[DataFrame], Exception | None]:
    """The results of the statements up to the first that fails, and its error."""
    done: list[DataFrame] = []
    for s in statements(text):
        try:
            done.append(spark.sql(s))
        except Exception as e:  # the rest of the script is not run
            return done, e
    return done, None
