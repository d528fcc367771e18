"""CSV extracts of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(mart: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with header; quotes doubled and blanks kept as they are.

    One file per task, unless the caller knows the mart to be small and asks for one file.
    """
    rows = mart.coalesce(1) if single_file else mart
    rows.write.mode("overwrite").options(
        header="true",
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
        timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    ).csv(path)
