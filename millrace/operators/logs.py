"""Raw page logs: validation, the five-way split and the new-visitor repair.

Records are read as variants: values keep their types, unknown keys stay, and of
a repeated key the last value counts (``spark.sql.variant.allowDuplicateKeys``,
set by ``configure``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import flag, overlay
from millrace.operators.scale import join_per_key
from millrace.schemas import PAGE_VIEW

FIELDS = "map<string,variant>"
SECTIONS = ("common", "page", "start", "error")
LISTS = ("displays", "actions")


def _is_object(value: str):
    return F.coalesce(F.col(value).rlike(r"^\s*\{") & F.try_parse_json(value).isNotNull(), F.lit(False))


def valid_json(df: DataFrame, mode: str = "drop", value: str = "value") -> DataFrame:
    """Records that hold a JSON object.

    ``drop`` removes the others, ``permissive`` keeps all with a ``valid`` flag,
    ``reject`` returns only the unusable ones.
    """
    if mode == "permissive":
        return df.withColumn("valid", _is_object(value))
    if mode not in ("drop", "reject"):
        raise ValueError(f"unknown mode: {mode}")
    return df.filter(_is_object(value) if mode == "drop" else ~_is_object(value))


def _get(path: str, kind: str) -> Column:
    return F.expr(f"try_variant_get(_rec, '{path}', '{kind}')")


def _opened(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """Each record parsed once, as ``_rec``.

    The generator holds the parse; a filter on a parsed column would be pushed
    below a projection and parse the record a second time.
    """
    return df.select(*keep, F.col(value).alias("_raw"), F.inline(F.array(F.struct(F.try_parse_json(value).alias("_rec")))))


#: An object, whatever it holds: a cast to it opens no fields.
ANY_OBJECT = "struct<_:variant>"


def _sectioned(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """Log sections of every record, and why it does not fit (``_reason``, null if it does).

    Whether a section fits is told without opening it, so a reader of few columns
    opens only those.
    """
    shapes = {**{s: (FIELDS, ANY_OBJECT) for s in SECTIONS}, **{s: (f"array<{FIELDS}>", f"array<{ANY_OBJECT}>") for s in LISTS}, "ts": ("bigint", "bigint")}
    reason = F.when(_get("$", ANY_OBJECT).isNull(), "not an object")
    for name, (_, shape) in shapes.items():
        given = _get(f"$.{name}", "variant")
        reason = reason.when(given.isNotNull() & ~F.is_variant_null(given) & _get(f"$.{name}", shape).isNull(), name)
    sizes = [F.size(F.coalesce(_get(f"$.{s}", shapes[s][1]), F.array().cast(shapes[s][1]))).alias(f"n_{s}") for s in LISTS]
    return _opened(df, value, *keep).select(
        *keep, "_raw", _get("$", FIELDS).alias("fields"), *[_get(f"$.{s}", kind).alias(s) for s, (kind, _) in shapes.items()], *sizes,
        reason.alias("_reason"),
    )


def parse_logs(df: DataFrame, value: str = "value") -> DataFrame:
    """Records that fit, as log sections, with all their ``fields``."""
    return _sectioned(df, value).filter("_reason is null").drop("_raw", "_reason")


def rejected_logs(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The other records: their text, and the first section that does not fit."""
    rows = _sectioned(df, value, *keep).filter("_reason is not null")
    return rows.select(*keep, F.col("_raw").alias("value"), F.col("_reason").alias("reason"))


def parse_page_views(df: DataFrame, value: str = "value", extra: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Page records as the flat columns the summaries read.

    Values are converted where they can be (a number may come as text) and null
    where they cannot; a record needs a page section and a time. ``extra`` names
    further columns with their path and type.
    """
    names = {f.name: (f"$.{s.name}.{f.name}", f.dataType.simpleString()) for s in PAGE_VIEW.fields if s.name != "ts" for f in s.dataType.fields}
    rows = _opened(df, value).select(
        *[_get(path, kind).alias(n) for n, (path, kind) in {**names, **(extra or {})}.items()],
        F.timestamp_millis(_get("$.ts", "bigint")).alias("ts"), _get("$.page", FIELDS).isNotNull().alias("_page"),
    )
    return rows.filter("_page and ts is not null").drop("_page")


def _time() -> Column:
    """The record's time as an entry, where it has one."""
    empty = F.create_map().cast(FIELDS)
    return F.when(F.col("ts").isNotNull(), F.create_map(F.lit("ts"), F.col("ts").cast("variant"))).otherwise(empty)


def _spread(df: DataFrame, entries: str, own_time: bool):
    """One row per array entry, overlaid by the common and then the page section."""
    above = overlay(F.col("common"), *([] if own_time else [_time()]), F.col("page"), kind=FIELDS)
    rows = df.filter(F.col("start").isNull()).select(F.explode(entries).alias("_entry"), above.alias("_above"))
    return rows.select(overlay(F.col("_entry"), F.col("_above"), kind=FIELDS).alias("record"))


def _record(*without: str) -> Column:
    """A record's fields but for some, with the common section as it was read or repaired."""
    kept = F.map_filter("fields", lambda k, _: ~k.isin("common", *without))
    common = F.when(F.col("common").isNotNull(), F.create_map(F.lit("common"), F.to_variant_object("common")))
    return F.map_concat(kept, F.coalesce(common, F.create_map().cast(FIELDS)))


def split_logs(df: DataFrame) -> dict[str, DataFrame]:
    """Five outputs over one parsed log.

    A start record goes to ``start`` alone. Any other record may feed several of
    ``display`` and ``action`` (one row per entry, as a merged map), ``error``
    (the record without its entries) and ``page`` (also without the error). These two
    give the sections and, in ``record``, every field the record came with.
    """
    other = df.filter(F.col("start").isNull())
    error, page = _record(*LISTS).alias("record"), _record(*LISTS, "error").alias("record")
    return {
        "start": df.filter(F.col("start").isNotNull()),
        "display": _spread(df, "displays", own_time=False),
        "action": _spread(df, "actions", own_time=True),
        "error": other.filter(F.col("error").isNotNull()).select("common", "page", "error", "ts", error),
        "page": other.filter(F.col("page").isNotNull()).select("common", "page", "ts", page),
    }


def output_counts(df: DataFrame) -> DataFrame:
    """Rows that each output of a parsed log gets, without making them."""
    whole = {"start": "start", "error": "error", "page": "page"}
    other = F.col("start").isNull()
    counts = {o: flag(F.col(c).isNotNull() & (F.lit(True) if o == "start" else other)) for o, c in whole.items()}
    counts |= {o: F.when(other, F.col(f"n_{s}")).otherwise(0).cast("bigint") for o, s in (("display", "displays"), ("action", "actions"))}
    each = F.array(*[F.struct(F.lit(o).alias("output"), c.alias("n")) for o, c in counts.items()])
    return df.select(F.inline(each)).filter("n > 0").groupBy("output").agg(F.sum("n").alias("n"))


TAGGED = "array<struct<output:string,value:string>>"


def _tagged(output: str, record: Column) -> Column:
    return F.struct(F.lit(output).alias("output"), F.to_json(record).alias("value"))


def tag_outputs(df: DataFrame) -> DataFrame:
    """The same split in one pass: ``output`` and the record as JSON text.

    For writing all outputs at once, partitioned by ``output``; the log is read
    and parsed a single time. Whole records keep every field they came with.
    """
    return _with_bases(df).select(F.inline(_outputs()))


OUTPUTS = ("start", "display", "action", "error", "page", "reject")


def _with_bases(df: DataFrame) -> DataFrame:
    """What the entries of a record are overlaid by, once per record."""
    return df.withColumns({
        "_above_display": overlay(F.col("common"), _time(), F.col("page"), kind=FIELDS),
        "_above_action": overlay(F.col("common"), F.col("page"), kind=FIELDS),
    })


def _outputs(wanted: Sequence[str] = OUTPUTS) -> Column:
    none = F.array().cast(TAGGED)

    def single(output: str, present: str, *without: str) -> Column:
        found = F.when(F.col(present).isNotNull(), F.array(_tagged(output, _record(*without))))
        return F.coalesce(found, none) if output in wanted else none

    def each(output: str, entries: str) -> Column:
        listed = F.coalesce(entries, F.array().cast(f"array<{FIELDS}>"))
        made = F.transform(listed, lambda e: _tagged(output, overlay(e, F.col(f"_above_{output}"), kind=FIELDS)))
        return made if output in wanted else none

    other = F.concat(
        each("display", "displays"), each("action", "actions"), single("error", "error", *LISTS), single("page", "page", *LISTS, "error")
    )
    return F.when(F.col("start").isNotNull(), single("start", "start")).otherwise(other)


def tag_records(df: DataFrame, value: str = "value", repair=None, wanted: Sequence[str] = OUTPUTS) -> DataFrame:
    """Raw text to tagged outputs; what does not fit comes out as ``reject``, text and reason.

    ``repair`` may work on the parsed log before it is split. Outputs that are not
    ``wanted`` are not made.
    """
    rows = _sectioned(df, value)
    rows = repair(rows) if repair else rows
    told = F.struct(F.col("_raw").alias("value"), F.col("_reason").alias("reason"))
    reject = F.array(F.struct(F.lit("reject").alias("output"), F.to_json(told).alias("value")))
    refused = reject if "reject" in wanted else F.array().cast(TAGGED)
    return _with_bases(rows).select(F.inline(F.when(F.col("_reason").isNotNull(), refused).otherwise(_outputs(wanted))))


def first_days(df: DataFrame, device: str = "mid", is_new: str = "is_new", order=("ts",)) -> DataFrame:
    """The day each device counts as new, in ``first_day``.

    The first record decides: its own day if it says new, the day before if it
    says old. ``order`` leads with a timestamp.
    """
    opening = F.struct(*order, F.col(is_new).alias("_flag"))
    first = df.groupBy(device).agg(F.min(opening).alias("_first"))
    seen = F.to_date(F.col("_first")[order[0]])
    says_new = F.coalesce(F.col("_first._flag") == "1", F.lit(False))
    return first.select(device, F.when(says_new, seen).otherwise(F.date_sub(seen, 1)).alias("first_day"))


def clear_flags(df: DataFrame, days: DataFrame, device: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """Clear the new-visitor flag on days other than the first one known."""
    joined = join_per_key(df, days.withColumnRenamed("first_day", "_first_day"), [device])
    wrong = (F.col(is_new) == "1") & (F.to_date(ts) != F.col("_first_day"))
    return joined.withColumn(is_new, F.when(wrong, F.lit("0")).otherwise(F.col(is_new))).select(*df.columns)


def repair_visitors(df: DataFrame, device: str = "mid", is_new: str = "is_new", order=("ts",)) -> DataFrame:
    """Clear the new-visitor flag on days after a device was first seen."""
    return clear_flags(df, first_days(df, device, is_new, order), device, is_new, order[0])
