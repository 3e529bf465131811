"""The family config table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.session import local_table

_LIST = T.ArrayType(T.StringType())
FAMILY_SCHEMA = T.StructType(
    [
        T.StructField("family", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("pos_genes", _LIST),
        T.StructField("pos_pfam", _LIST),
        T.StructField("neg_pfam", _LIST),
        T.StructField("neg_genes", _LIST),
        T.StructField("exclude_genes", _LIST),
        T.StructField("exclude_pfam", _LIST),
        T.StructField("taxonomy_id", T.IntegerType()),
        T.StructField("scope", T.StringType()),
        T.StructField("decoy_from_negatives", T.BooleanType()),
        T.StructField("trim_gt", T.DoubleType()),
        T.StructField("curated_model", T.StringType()),
        T.StructField("fusion_partner", T.StringType()),
        T.StructField("fusion_marker", T.StringType()),
        T.StructField("max_positive", T.IntegerType()),
        T.StructField("max_negative", T.IntegerType()),
        T.StructField("negative_median_override", T.DoubleType()),
        T.StructField("length_max_ratio", T.DoubleType()),
        T.StructField("ord", T.IntegerType(), False),
    ]
)


def families_table(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Config entries as a local relation (its size is known, so joins with it broadcast by themselves).

    Keys are the column names; ``name`` may stand for ``family``. ``ord`` is the position.
    """
    rows = []
    for i, entry in enumerate(entries):
        entry = dict(entry)
        entry.setdefault("family", entry.pop("name", None))
        entry["ord"] = i
        entry["decoy_from_negatives"] = bool(entry.get("decoy_from_negatives", False))
        for field in FAMILY_SCHEMA:
            value = entry.get(field.name)
            if isinstance(field.dataType, T.DoubleType) and value is not None:
                entry[field.name] = float(value)
        rows.append(tuple(entry.get(f.name) for f in FAMILY_SCHEMA))
    return local_table(spark, rows, FAMILY_SCHEMA)


def load_families(spark: SparkSession, path: str) -> DataFrame:
    """Config from a YAML (or JSON) file with a top-level ``families`` list."""
    try:
        import yaml
    except ImportError:
        import json

        parse = json.load
    else:
        parse = yaml.safe_load
    with open(path) as handle:
        return families_table(spark, parse(handle)["families"])


def subset_families(families: DataFrame, names: list[str]) -> DataFrame:
    """Only the named families, in config order; unknown names raise."""
    chosen = families.filter(F.col("family").isin(*names))
    known = {r.family for r in chosen.select("family").distinct().limit(len(names)).collect()}
    missing = sorted(set(names) - known)
    if missing:
        raise ValueError("unknown families: " + ", ".join(missing))
    return chosen
