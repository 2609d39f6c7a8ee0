"""Key resolution of staged rows against the dictionaries.

Dictionaries are unique on the joined columns, so each lookup is a left join that adds a marker and never a
row. No side is hinted: Spark broadcasts a dictionary whose measured size is below its threshold and otherwise
shuffles both sides, splitting hot fact keys at run time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwatch.tables import Lookup, TableSpec


def _marked(staged: DataFrame, lookup: Lookup, dictionaries: Mapping[str, DataFrame], marker: str) -> DataFrame:
    """Add ``marker``: null without a dictionary row, false if that row's parent is unknown, else true."""
    known = dictionaries[lookup.dictionary].select(*dict.fromkeys(lookup.on.values()))
    if lookup.parent is not None:
        known = _marked(known, lookup.parent, dictionaries, "_parent").withColumn(
            marker, F.col("_parent").isNotNull()
        ).drop("_parent")
    else:
        known = known.withColumn(marker, F.lit(True))
    prefixed = known.select(*[F.col(there).alias(f"_key_{there}") for there in lookup.on.values()], marker)
    same = [F.col(here) == F.col(f"_key_{there}") for here, there in lookup.on.items()]
    return staged.join(prefixed, same, "left").drop(*[f"_key_{there}" for there in lookup.on.values()])


def check(staged: DataFrame, spec: TableSpec, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """Staged rows with ``reason``: the first required field that is null or the first dictionary without the key, else null."""
    columns = staged.columns
    marked = staged
    reasons: list[Column] = [
        F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in spec.required if c in columns
    ]
    for i, lookup in enumerate(spec.lookups):
        marker = f"_known{i}"
        marked = _marked(marked, lookup, dictionaries, marker)
        if lookup.required:
            reasons.append(F.when(F.col(marker).isNull(), F.lit(f"unknown in {lookup.dictionary}")))
            if lookup.parent is not None:
                reasons.append(F.when(~F.col(marker), F.lit(f"unknown in {lookup.parent.dictionary}")))
        else:
            for here in lookup.on:
                marked = marked.withColumn(here, F.when(F.col(marker), F.col(here)))
    return marked.withColumn("reason", F.coalesce(*reasons)).select(*columns, "reason")


def resolve(
    staged: DataFrame,
    spec: TableSpec,
    dictionaries: Mapping[str, DataFrame],
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame, Observation]:
    """Split staged rows into resolved ones and rejects.

    A reject carries its ``reason``. The observation counts ``rejected`` rows while the resolved ones are consumed.
    """
    observation = observation or Observation()
    columns = staged.columns
    checked = check(staged, spec, dictionaries)
    counted = checked.observe(observation, F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    return (
        counted.where(F.col("reason").isNull()).select(*columns),
        checked.where(F.col("reason").isNotNull()),
        observation,
    )
