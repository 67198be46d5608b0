"""Row-level recodes, filters, joins and unions used by the pipelines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.text import NULL_TEXT

# Payment code -> label (codes 0..7; anything else has no label).
PAY_LABELS = {
    0: "投币",
    1: "K金币",
    2: "银币",
    3: "音乐积分",
    4: "微信",
    5: "支付宝",
    6: "免费券",
    7: "QQ",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode_order_type(c) -> Column:
    """Raw order type 1 -> 1 (payment), 2 -> 3, everything else incl. NULL -> 2 (refund)."""
    c = _col(c)
    return F.when(c == 1, F.lit(1)).when(c == 2, F.lit(3)).otherwise(F.lit(2))


def abs_amount(c) -> Column:
    """Negative amounts made positive (``amount < 0 -> amount * -1``)."""
    return F.abs(_col(c))


def pay_label(c) -> Column:
    """Payment code -> label; codes outside 0..7 and NULL -> NULL."""
    c = _col(c)
    expr = None
    for code, label in PAY_LABELS.items():
        expr = F.when(c == code, F.lit(label)) if expr is None else expr.when(c == code, F.lit(label))
    return expr


def non_empty(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every column is neither "" nor NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) != F.lit(""))
    return df.where(cond)


def sentinel_split(df: DataFrame, address: str = "address", province: str = "province", city: str = "city"):
    """Split machine locations on the text sentinel ``null``.

    native : address, province and city all set (none equal to ``null``)
    derived: address set, province and city both ``null`` (to be parsed
             from the address)
    Rows with exactly one sentinel, or a real NULL, are in neither branch.
    """
    a, p, c = F.col(address), F.col(province), F.col(city)
    native = df.where((a != NULL_TEXT) & (p != NULL_TEXT) & (c != NULL_TEXT))
    derived = df.where((a != NULL_TEXT) & (p == NULL_TEXT) & (c == NULL_TEXT))
    return native, derived


def join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner") -> DataFrame:
    """Fact ⨝ dimension on differently named keys.

    No hint: the optimizer broadcasts the dimension when its estimated size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks at runtime.
    """
    return fact.join(dim, fact[fact_key] == dim[dim_key], how)


def semi_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key appears in ``other`` (``key IN (subquery)``);
    NULL keys never match."""
    return df.join(other.select(key).where(F.col(key).isNotNull()), on=key, how="left_semi")


def map_source(
    df: DataFrame, schema: T.StructType, renames: dict | None = None, constants: dict | None = None, optional=None
) -> DataFrame:
    """Map one source onto a target schema BY NAME.

    ``renames``: target -> source column; ``constants``: target -> literal.
    A column that is neither present, renamed nor constant becomes a typed NULL;
    with ``optional`` (a collection of names) it must be one of these, else it is an error.
    """
    renames = renames or {}
    constants = constants or {}
    cols = []
    for f in schema.fields:
        if f.name in constants:
            cols.append(F.lit(constants[f.name]).cast(f.dataType).alias(f.name))
        elif f.name in renames:
            cols.append(F.col(renames[f.name]).cast(f.dataType).alias(f.name))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif optional is not None and f.name not in optional:
            raise ValueError(f"column {f.name} missing; have {df.columns}")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name of frames already mapped to one schema (map-only)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
