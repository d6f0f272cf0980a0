"""Dimensions: enrichment over several hops, and routing by configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.asof import as_of_join
from millrace.operators.changes import prune_columns
from millrace.operators.scale import join_per_key
from millrace.operators.versions import latest_by_key

def read_row(dim: DataFrame, key, id: str = "id"):
    """The dimension row of one key; a missing row is an error."""
    found = dim.filter(F.col(id) == F.lit(key)).take(1)
    if not found:
        raise LookupError(f"no dimension row for {id}={key}")
    return found[0]


RULE_KEY = ("source_table", "source_type", "sink_extend")


@dataclass(frozen=True)
class Hop:
    """One lookup: ``key`` in the rows so far, ``dim[id]``, and the columns it adds.

    ``columns`` maps the new name to the dimension's name.
    """

    key: str
    dim: DataFrame
    columns: Mapping[str, str]
    id: str = "id"


@dataclass
class _Chain:
    """Hops that start from one key of the rows, folded into one lookup table."""

    key: str
    table: DataFrame
    adds: list[str] = field(default_factory=list)


def _fold(hops: Sequence[Hop], available: Sequence[str]) -> list[_Chain]:
    chains: list[_Chain] = []
    for hop in hops:
        side = hop.dim.select(
            F.col(hop.id).alias("_id"), F.lit(True).alias("_found"),
            *[F.col(s).alias(n) for n, s in hop.columns.items()],
        )
        home = next((c for c in chains if hop.key in c.adds), None)
        if home is None:
            if hop.key not in available:
                raise ValueError(f"no column {hop.key} to look up")
            chains.append(_Chain(hop.key, side, list(hop.columns)))
        else:
            side = side.withColumnsRenamed({"_id": "_next", "_found": "_hit"})
            found = F.col("_found") & F.coalesce("_hit", F.lit(False))
            joined = home.table.join(side, home.table[hop.key] == side["_next"], "left")
            home.table = joined.withColumn("_found", found).drop("_next", "_hit")
            home.adds += hop.columns
    return chains


def enrich(df: DataFrame, hops: Sequence[Hop], on_missing: str = "null") -> DataFrame:
    """Add dimension columns.

    Hops that continue from an earlier hop are joined among the dimensions
    first, so the rows are joined once per chain and not once per hop. A row
    whose dimension is missing keeps nulls, is dropped, or fails the query.
    """
    if on_missing not in ("null", "drop", "error"):
        raise ValueError(f"unknown on_missing: {on_missing}")
    wanted = list(df.columns)
    for chain in _fold(hops, df.columns):
        table = chain.table.withColumnRenamed("_id", chain.key)
        df = join_per_key(df, table, [chain.key], "left" if on_missing != "drop" else "inner")
        if on_missing == "drop":
            df = df.filter("_found")
        elif on_missing == "error":
            value = F.coalesce(F.col(chain.key).cast("string"), F.lit("null"))
            text = F.concat(F.lit(f"no dimension row for {chain.key}="), value)
            checked = F.when(F.coalesce("_found", F.lit(False)), F.col(chain.key)).otherwise(F.raise_error(text))
            df = df.withColumn(chain.key, checked)
        df = df.drop("_found")
        wanted += chain.adds
    return df.select(*wanted)


def current_rules(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rules in force after a series of captured changes; a delete removes its rule.

    ``changes`` has the rule columns, ``op`` and the ordering columns.
    """
    keyed = changes.withColumn("sink_extend", F.coalesce("sink_extend", F.lit("")))
    live = latest_by_key(keyed, list(RULE_KEY), order, deleted=F.col("op") == "d")
    return live.withColumn("sink_extend", F.nullif(F.col("sink_extend"), F.lit("")))


def _with_rule(changes: DataFrame, rules: DataFrame, kind: Column) -> DataFrame:
    rule_key = F.concat_ws("", "source_type", "sink_extend")
    side = rules.select(
        F.col("source_table").alias("_table"), rule_key.alias("_kind"),
        "sink_table", "sink_type", "sink_columns", "sink_pk", F.split("sink_columns", ",").alias("_listed"),
    )
    keyed = changes.withColumn("_kind_of", kind)
    on = (keyed["table"] == side["_table"]) & (keyed["_kind_of"] == side["_kind"])
    return keyed.join(side, on).select(
        "sink_table", "sink_type", "sink_pk", "sink_columns",
        prune_columns(F.col("data"), F.col("_listed"), F.col("type")).alias("data"), "ts",
    )


def route_dims(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Send each record to the table its source is configured for, any operation alike."""
    return _with_rule(changes, rules.withColumn("sink_extend", F.lit(None).cast("string")), F.lit("ALL"))


RULE_COLUMNS = ("op", "sink_table", "sink_type", "sink_pk", "sink_columns")


def rule_versions(captures: DataFrame, since: str, order: Sequence[str] = ()) -> DataFrame:
    """Captured rule changes under the key that records are looked up by, with their times."""
    kind = F.concat_ws("", "source_type", "sink_extend")
    return captures.select(F.col("source_table").alias("table"), kind.alias("kind"), since, *order, *RULE_COLUMNS)


def ruled(joined: DataFrame) -> DataFrame:
    """Records joined to the rule of their time, in the shape of routed records; a removed rule takes none."""
    live = joined.filter(F.col("op") != "d")
    pruned = prune_columns(F.col("data"), F.split("sink_columns", ","), F.col("type")).alias("data")
    return live.select("sink_table", "sink_type", "sink_pk", "sink_columns", pruned, "ts")


def route_as_of(
    changes: DataFrame, captures: DataFrame, at: str, since: str, order: Sequence[str] = (), kind: Column | None = None
) -> DataFrame:
    """Send each record where the rule in force at its own time says, whatever was configured later."""
    keyed = changes.withColumn("kind", change_kind() if kind is None else kind)
    return ruled(as_of_join(keyed, rule_versions(captures, since, order), ["table", "kind"], at, since, RULE_COLUMNS, order, "inner"))


# Rule suffixes of the two coupon transitions.
COUPON_USED = '{"data": {"coupon_status": "1402"}, "old": {"coupon_status": "1401"}}'
COUPON_PAID = '{"data": {"used_time": "not null"}}'


def change_kind() -> Column:
    """Operation of a record, with a suffix for the coupon transitions."""
    coupon = (F.col("table") == "coupon_use") & (F.col("type") == "update")
    old, new = F.col("old")["coupon_status"], F.col("data")["coupon_status"]
    suffix = (
        F.when(coupon & (old == "1401") & (new == "1402"), F.lit(COUPON_USED))
        .when(coupon & (old == "1402") & (new == "1403"), F.lit(COUPON_PAID))
        .otherwise(F.lit(""))
    )
    return F.concat("type", suffix)


def route_facts(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Send each record to the topic its source and operation are configured for."""
    return _with_rule(changes, rules, change_kind())


def dim_rows(routed: DataFrame, sink_table: str, columns: Sequence[str], order: Sequence[str], pk: str = "id") -> DataFrame:
    """Rows of one dimension table: string columns, newest row per key."""
    mine = routed.filter(F.col("sink_table") == sink_table)
    flat = mine.select(*[F.col("data")[c].alias(c) for c in columns], *[c for c in order if c not in columns])
    return latest_by_key(flat, [pk], order).select(*columns)
