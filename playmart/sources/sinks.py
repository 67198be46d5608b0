"""Result-store exports (JDBC or any DataFrameWriter format).

Connection settings are always caller-supplied options; nothing is hard-coded.
Exports read from the table that was just written, so the exported rows are
exactly the stored ones (a plan is never evaluated twice with different ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.sources.tables import DAY_COL


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, unicode: bool = True, **extra) -> dict[str, str]:
    """Writer options for a JDBC result table (values come from the caller)."""
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if unicode:
        opts.update({"useUnicode": "true", "characterEncoding": "utf-8"})
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def export(
    df: DataFrame,
    target: str | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    options: dict | None = None,
    day: str | None = None,
    day_col: str = DAY_COL,
    constant_day: str | None = None,
) -> None:
    """Write ``df`` to a result store.

    ``day`` exports only that day partition (``None``: all partitions, as the
    original province/operator exports do). ``constant_day`` adds a constant
    day column (the province-count export). ``fmt="jdbc"`` takes ``options``
    from ``jdbc_options``; other formats write to the path ``target``.
    """
    out = df
    if day is not None and day_col in out.columns:
        out = out.where(F.col(day_col) == F.lit(day))
    if constant_day is not None:
        out = out.drop(day_col).withColumn(day_col, F.lit(constant_day))
    writer = out.write.format(fmt).mode(mode).options(**(options or {}))
    if fmt == "jdbc" or target is None:
        writer.save()
    else:
        writer.save(target)
