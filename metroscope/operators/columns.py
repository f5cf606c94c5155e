"""Column names, labels and unions of drifted tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import whole_count
from ..functions.text import canonical_name


def canonical_columns(df: DataFrame, rule: Callable[[str], str] = canonical_name) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def prune_columns(df: DataFrame, keep: Iterable[str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """Keep the listed columns that exist, in list order, then drop the unwanted ones."""
    if keep is not None:
        df = df.select([c for c in keep if c in df.columns])
    return df.drop(*drop)


def column_by_prefix(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """Rename the first column whose name starts with ``prefix``; its tail carries a vintage."""
    found = [c for c in df.columns if c.upper().startswith(prefix.upper())]
    if not found:
        raise ValueError(f"no column starts with {prefix!r} among {df.columns}")
    return df.withColumnRenamed(found[0], name)


def label_partition(df: DataFrame, **labels) -> DataFrame:
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in labels.items()})


def masked_count(df: DataFrame, count_col: str = "nb_vald") -> DataFrame:
    """Keep the published text, the nullable number and a flag: a masked count is not zero."""
    number = whole_count(F.col(count_col))
    return df.withColumns(
        {f"{count_col}_raw": F.col(count_col), count_col: number, f"{count_col}_masked": number.isNull()}
    )


def union_drifted(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side is null there. Types must agree already."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_labelled(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Several datasets as one table, told apart by a label column."""
    return union_drifted(df.withColumn(label, F.lit(name)) for name, df in frames.items())


def flatten_struct(df: DataFrame, struct_col: str, fields: Iterable[str]) -> DataFrame:
    """Lift fields of a struct to the top and drop the struct."""
    return df.withColumns({f: F.col(f"{struct_col}.{f}") for f in fields}).drop(struct_col)


def explode_json_map(df: DataFrame, json_col: str, key: str, value: str) -> DataFrame:
    """One row per entry of a JSON object; text that is none is an error, a null gives no row."""
    others = [c for c in df.columns if c != json_col]
    entries = F.from_json(json_col, "map<string,string>")
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring(json_col, 1, 100)))
    return df.select(*others, F.explode(F.when(F.col(json_col).isNotNull(), F.coalesce(entries, broken))).alias(key, value))
