"""Table access and SQL pieces shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, key: str, *columns: str) -> DataFrame:
    """A table whose rows are costly to work on, spread over the cores when it is one small file."""
    wanted = table(spark, folder, name)
    return spread(wanted.select(*columns) if columns else wanted, key)


def rounded(column: Column, name: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(name)


# White space as the text rules count it: Unicode white space and the four
# information separators.
SQL_SPACE = (
    r"[\t\n\v\f\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_strip(expression: str) -> str:
    return f"regexp_replace({expression}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_normalise(column: str) -> str:
    """lower, collapse spaces, strip, cap runs."""
    base = sql_strip(f"regexp_replace(lower({column}), ' +', ' ', 'g')")
    return sql_cap(base)


def sql_cap(text: str) -> str:
    """Runs of one character cut at three; DuckDB regular expressions have no back-references."""
    return (
        f"array_to_string(list_apply([str_split({text}, '')], lambda cs: array_to_string(list_filter(cs, lambda c, i: "
        "NOT (i > 3 AND c = cs[i-1] AND c = cs[i-2] AND c = cs[i-3])), '')), '')"
    )
