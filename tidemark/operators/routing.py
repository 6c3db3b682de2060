"""Row routing by named rules, and counts of what could not be parsed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv

REASON = "_reject_reason"


@dataclass(frozen=True)
class Routed:
    good: DataFrame
    bad: DataFrame


def broken_rules(rules: dict[str, Column]) -> Column:
    """Array of the names of the rules that a row does not clearly keep, in rule order."""
    kept = F.array(*[F.struct(F.lit(name).alias("rule"), F.coalesce(ok, F.lit(False)).alias("kept")) for name, ok in rules.items()])
    return F.transform(F.filter(kept, lambda r: ~r["kept"]), lambda r: r["rule"])


def reject_reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks, as text; empty if it keeps them all."""
    return F.array_join(broken_rules(rules), ";")


def all_kept(rules: dict[str, Column]) -> Column:
    """Whether a row clearly keeps every rule; never NULL."""
    return reduce(and_, (F.coalesce(ok, F.lit(False)) for ok in rules.values()), F.lit(True))


def route(df: DataFrame, rules: dict[str, Column]) -> Routed:
    """Rows that keep every rule, and the others with their reasons; only these get the text."""
    return Routed(df.where(all_kept(rules)), df.where(~all_kept(rules)).withColumn(REASON, reject_reasons(rules)))


def key_rules(id_column: str = "facility_id", state_column: str = "state") -> dict[str, Column]:
    states = ", ".join("'" + line.split(",")[0] + "'" for line in fv.STATE_REGIONS_TEXT.splitlines())
    return {
        "invalid_facility_id": F.col(id_column).rlike(fv.FACILITY_ID_PATTERN),
        "invalid_state": F.expr(f"`{state_column}` IN ({states})"),
    }


def lost_in_parsing(raw: Column, parsed: Column) -> Column:
    """Aggregate: how many present raw values gave no parsed value."""
    return F.count_if(raw.isNotNull() & parsed.isNull())
