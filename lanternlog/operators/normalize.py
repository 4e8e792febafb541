"""Mapping of raw rows to the normalized schema, with bad rows set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.timing import parse_timestamp
from ..sources.model import CORRELATION, FIELDS, STRICT_TEXT, SourceSpec
from ..sources.readers import POSITION, RAW

#: Why a line or a row is set apart, in the order of the tests.
BAD_LINE, BAD_ROW = ("invalid_json", "not_object"), ("bad_timestamp", "missing_level", "missing_message")
#: JSON text of a number, a truth value or null.
SCALAR = r"^(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)$"


def merged_attributes(mapped: Column | None, leftover: Column) -> Column:
    """JSON object text: keys of the mapped attributes, overwritten by the leftover columns or keys.

    ``mapped`` is text or null: an object gives its keys, other JSON or plain text goes under
    ``attributes``, blank text is dropped. ``leftover`` is a map of variants.
    """
    if mapped is None:
        return F.to_json(leftover)
    parsed = F.try_parse_json(mapped)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    single = F.create_map(F.lit("attributes"), F.coalesce(parsed, F.to_variant_object(F.array(mapped)).cast("array<variant>")[0]))
    empty = F.expr("cast(map() as map<string,variant>)")
    given = F.when(mapped.isNull() | (F.trim(mapped) == ""), empty).when(is_object, parsed.try_cast("map<string,variant>")).otherwise(single)
    kept = F.map_filter(F.coalesce(given, empty), lambda k, v: ~F.array_contains(F.map_keys(leftover), k))
    return F.to_json(F.map_concat(kept, leftover))


def reason_of(checks: list[tuple[Column, str]]) -> Column:
    out = F.when(checks[0][0], checks[0][1])
    for bad, reason in checks[1:]:
        out = out.when(bad, reason)
    return out


def shape_table(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Normalized columns of a typed table with ``_position`` and ``_reason``, null for good rows."""
    types = dict(df.dtypes)

    def raw(name: str) -> Column | None:
        return F.col(f"`{spec.column(name)}`") if spec.column(name) in types else None

    def text(name: str) -> Column:
        return raw(name).cast("string") if raw(name) is not None else F.lit(None).cast("string")

    position = F.col(f"`{spec.position}`").cast("string") if spec.position else F.lit(None).cast("string")
    consumed = {spec.column(f) for f in FIELDS} & set(types)
    left = [c for c in df.columns if c not in consumed and c != spec.position]
    stamp = parse_timestamp(raw("timestamp"), types[spec.column("timestamp")], spec.odd_timestamps) if raw("timestamp") is not None else F.lit(None).cast("timestamp_ntz")
    leftover = F.try_parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in left]), {"ignoreNullFields": "false"})).cast("map<string,variant>") if left else F.expr("cast(map() as map<string,variant>)")
    mapped = None
    if raw("attributes") is not None:
        kind = types[spec.column("attributes")]
        mapped = text("attributes") if kind == "string" else F.to_json(raw("attributes")) if kind.startswith(("struct", "map", "array")) else text("attributes")
    shaped = df.select(
        F.coalesce(text("id"), F.concat(F.lit(spec.name + ":"), position)).alias("id"),
        stamp.alias("timestamp"),
        F.upper(text("level")).alias("level"),
        text("message").alias("message"),
        *[text(f).alias(f) for f in (*STRICT_TEXT, *CORRELATION)],
        merged_attributes(mapped, leftover).alias("attributes"),
        F.lit(spec.name).alias("source"),
        position.alias("_position"),
        reason_of(
            list(zip((stamp.isNull(), text("level").isNull(), text("message").isNull()), BAD_ROW, strict=True))
            + [(raw(f).isNotNull(), f"bad_type:{f}") for f in STRICT_TEXT if raw(f) is not None and types[spec.column(f)] != "string"]
            + [(F.coalesce(text("id"), position).isNull(), "missing_id")]
        ).alias("_reason"),
    )
    return shaped


def split(shaped: DataFrame, positions: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of shaped rows; with ``positions`` the good ones keep theirs as ``position``."""
    good = shaped.where("_reason is null").drop("_reason")
    good = good.withColumnRenamed("_position", "position") if positions else good.drop("_position")
    return good, shaped.where("_reason is not null").select("source", F.col("_position").alias("position"), F.col("_reason").alias("reason"))


def normalize_table(df: DataFrame, spec: SourceSpec, positions: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of a typed table.

    Quarantine rows are (source, position, reason); a reason never shows a value. Each side reads
    the table for itself; ``split_once`` and ``watched`` tell the good rows and the counts from one reading.
    """
    return split(shape_table(df, spec), positions)


def normalize_jsonl(lines: DataFrame, spec: SourceSpec, positions: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of ``read_jsonl`` lines; the schema is never inferred."""
    return split(shape_jsonl(lines, spec), positions)


def split_once(shaped: DataFrame, path: str, format: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) from one reading of the source: shaped rows are written to ``path`` in two folders, and each side reads its own."""
    shaped.withColumn("bad", F.col("_reason").isNotNull()).write.format(format).partitionBy("bad").save(path)
    written = shaped.sparkSession.read.schema(shaped.withColumn("bad", F.lit(True)).schema).format(format).load(path)
    good, bad = (written.where(F.col("bad") == flag).drop("bad") for flag in (False, True))
    return split(good)[0], split(bad)[1]


def watched(shaped: DataFrame, spec: SourceSpec, name: str = "quarantine") -> tuple[DataFrame, Observation]:
    """(good rows, counts): the counts by reason and of good rows are there after the first action on the good rows, which reads the source once.

    They are exact where that action keeps every row; a limit on top would end the reading early, and a
    task of a shuffle that runs again is counted again. ``split_once`` has no such terms.
    """
    counts = Observation(name)
    found = [F.count_if(F.col("_reason") == r).alias(r) for r in reasons(spec)]
    return split(shaped.observe(counts, F.count_if(F.col("_reason").isNull()).alias("good"), *found))[0], counts


def reasons(spec: SourceSpec) -> list[str]:
    """All reasons there are."""
    return [*BAD_LINE, *BAD_ROW, *(f"bad_type:{f}" for f in STRICT_TEXT), "missing_id"]


def shape_jsonl(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """Normalized columns of ``read_jsonl`` lines with ``_position`` and ``_reason``."""
    # Each line is parsed once: what ``inline`` gives are columns, which no later expression repeats.
    record, variant = F.from_json(F.col(RAW), "map<string,string>"), F.try_parse_json(F.col(RAW))
    lines = lines.select(RAW, POSITION, F.inline(F.array(F.struct(record.alias("r"), variant.alias("v")))))
    # Of keys that repeat the last counts. Such a line has no variant; its values then go by their text.
    entries = F.map_entries("r")
    later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
    last = F.map_from_entries(F.filter(entries, lambda e, i: ~later(e, i)))
    repeated = F.col("v").isNull() & F.col("r").isNotNull()

    def from_text(t: Column) -> Column:
        return F.coalesce(F.when(t.rlike(SCALAR) | t.rlike(r"^\s*[\[{]"), F.try_parse_json(t)), F.to_variant_object(F.array(t)).cast("array<variant>")[0])

    by_text = F.when(repeated, F.transform_values(last, lambda k, t: from_text(t)))
    variants = F.coalesce(F.col("v").try_cast("map<string,variant>"), by_text, F.expr("cast(map() as map<string,variant>)"))
    fields = F.struct(F.when(repeated, last).otherwise(F.col("r")).alias("r"), F.col("v").isNotNull().alias("parsed"), variants.alias("m"))
    lines = lines.select(RAW, POSITION, F.inline(F.array(fields)))

    def raw(name: str) -> Column:
        return F.try_element_at(F.col("r"), F.lit(spec.column(name)))

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.try_element_at(F.col("m"), F.lit(spec.column(name))))

    number = F.coalesce(kind("timestamp").rlike("BIGINT|DECIMAL|DOUBLE"), F.lit(False))
    text = F.when(~number, raw("timestamp"))
    when = F.when(number, parse_timestamp(raw("timestamp").try_cast("double"), "double")).otherwise(parse_timestamp(text, "string", spec.odd_timestamps))
    lines, stamp = lines.select(RAW, POSITION, "r", "m", "parsed", F.inline(F.array(F.struct(when.alias("_stamp"))))), F.col("_stamp")
    consumed = [spec.column(f) for f in FIELDS]
    left = F.map_filter("m", lambda k, v: ~k.isin(*consumed))
    position = F.col(POSITION).cast("string")
    shaped = lines.select(
        F.coalesce(raw("id"), F.concat(F.lit(spec.name + ":"), position)).alias("id"),
        stamp.alias("timestamp"),
        F.upper(raw("level")).alias("level"),
        raw("message").alias("message"),
        *[raw(f).alias(f) for f in (*STRICT_TEXT, *CORRELATION)],
        merged_attributes(raw("attributes"), left).alias("attributes"),
        F.lit(spec.name).alias("source"),
        position.alias("_position"),
        reason_of(
            list(zip((F.col("r").isNull() & ~F.col("parsed"), ~F.col(RAW).startswith("{")), BAD_LINE, strict=True))
            + list(zip((stamp.isNull(), raw("level").isNull(), raw("message").isNull()), BAD_ROW, strict=True))
            + [(F.coalesce(~kind(f).isin("STRING", "VOID"), F.lit(False)), f"bad_type:{f}") for f in STRICT_TEXT]
            + [(F.coalesce(raw("id"), position).isNull(), "missing_id")]
        ).alias("_reason"),
    )
    return shaped


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("source", "reason").agg(F.count("*").alias("n"))
