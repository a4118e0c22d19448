"""Decoding, validation and standardisation of bar messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from barlens.schema import BAR_SCHEMA, PRICE_FIELDS, REQUIRED_FIELDS, TIME_PATTERN_WITH_OFFSET


def decode(
    messages: DataFrame,
    schema: StructType = BAR_SCHEMA,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """JSON payload to columns. A malformed payload becomes a row of nulls."""
    data = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(data.alias("data"), *keep).select("data.*", *keep)


def as_map(value: Column) -> Column:
    """JSON object as a text map; null if it is not a JSON object.

    Unlike a typed decode this tells a field that is absent from one that is null.
    """
    return F.from_json(value.cast("string"), "map<string,string>")


def _with_fields(value: Column, build: Callable[[Column], Column]) -> Column:
    """One-element array of ``build`` applied to the decoded map. The map is a lambda variable,
    so that the payload is parsed once however often ``build`` refers to it."""
    return F.transform(F.array(as_map(value)), build)


def parse_time(text: Column, pattern: str = TIME_PATTERN_WITH_OFFSET) -> Column:
    """Text in the given pattern, else in any ISO form; null if neither fits.

    The default pattern is an ISO form itself, so the order does not matter for it, and the
    ISO parser, which fails cheaply, goes first.
    """
    patterned, iso = F.try_to_timestamp(text, F.lit(pattern)), F.try_to_timestamp(text)
    return F.coalesce(iso, patterned) if pattern == TIME_PATTERN_WITH_OFFSET else F.coalesce(patterned, iso)


def parse_bound(text: Column) -> Column:
    """Range bound ``yyyy-MM-dd HH:mm`` or ``yyyy-MM-dd``."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
    )


def parse_times(bars: DataFrame, source: str = "time", target: str = "source_time") -> DataFrame:
    if source not in bars.columns:
        return bars
    return bars.withColumn(target, parse_time(F.col(source)))


def cast_prices(
    bars: DataFrame, to: str = "double", columns: Sequence[str] = PRICE_FIELDS
) -> DataFrame:
    """Cast the price and volume columns that exist; a cell that is no number becomes null."""
    present = [c for c in columns if c in bars.columns]
    return bars.withColumns({c: F.col(c).try_cast(to) for c in present})


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floating})


def complete_rows(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Rows with neither null nor NaN in the required columns (all by default)."""
    return df.dropna(how="any", subset=list(required) if required else None)


def missing_fields(value: Column | str, required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Required fields whose key is absent. A present null counts as there.

    A payload that is no JSON object lacks all of them.
    """
    names = F.array(*[F.lit(n) for n in required])

    def absent(fields: Column) -> Column:
        unknown = F.filter(names, lambda n: ~F.map_contains_key(fields, n))
        return F.when(fields.isNull(), names).otherwise(unknown)

    return _with_fields(F.col(value) if isinstance(value, str) else value, absent)[0]


def with_validity(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``missing`` (field names) and ``is_valid``."""
    return messages.withColumn("missing", missing_fields(F.col(value))).withColumn(
        "is_valid", F.size("missing") == 0
    )


def _whole_number(text: Column) -> Column:
    """Truncate toward zero. Integers do not pass through a double, which could round them."""
    integer = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("bigint"))
    return F.coalesce(integer, text.try_cast("double").try_cast("bigint"))


def standardise(
    messages: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Payload to the contract's fields and types, with a ``problem`` column.

    Absent text becomes "", absent numbers 0, absent optional fields null. ``problem`` names
    the first trouble (``bad_json`` or the field whose number cannot be read) and is null on
    good rows. A present null stays null in text and is a problem in a number.
    """

    def build(fields: Column) -> Column:
        def text(name: str, default: str) -> Column:
            return F.when(F.map_contains_key(fields, name), fields[name]).otherwise(F.lit(default))

        out = {
            "ticker": text("ticker", ""),
            "company": fields["company"],
            "time": text("time", ""),
            **{c: text(c, "0").try_cast("double") for c in PRICE_FIELDS},
            "Volume": _whole_number(text("Volume", "0")),
            "Adj Close": fields["Adj Close"].try_cast("double"),
        }
        return F.struct(
            *[out[f.name].alias(f.name) for f in BAR_SCHEMA],
            F.map_contains_key(fields, "Adj Close").alias("_adjusted"),
            fields.isNull().alias("_broken"),
        )

    # A generator, unlike a projection, is not repeated inside filters on its output.
    bars = messages.select(*keep, F.inline(_with_fields(F.col(value), build)))
    problem = F.when(F.col("_broken"), F.lit("bad_json"))
    for name in PRICE_FIELDS:
        problem = problem.when(F.col(name).isNull(), F.lit(name))
    problem = problem.when(F.col("_adjusted") & F.col("Adj Close").isNull(), F.lit("Adj Close"))
    return bars.withColumn("problem", problem).drop("_adjusted", "_broken")


def as_variant(value: Column) -> Column:
    """JSON text as a variant, parsed once; null if it is no JSON."""
    return F.try_parse_json(value.cast("string"))


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


# How a field of a message can be present.
MISSING, NULL, NUMBER, TEXT, OTHER = "missing", "null", "number", "text", "other"


def field_kind(message: Column, name: str) -> Column:
    """What a variant holds under a name: missing, null, number, text, or other.

    A payload that is no JSON, or no object, has no fields.
    """
    held = F.try_variant_get(message, _path(name), "variant")
    return _kind_of(held, F.schema_of_variant(held))


def _kind_of(held: Column, kind: Column) -> Column:
    """The same from a field's variant and that variant's schema."""
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return (
        F.when(held.isNull(), F.lit(MISSING))
        .when(F.is_variant_null(held), F.lit(NULL))
        .when(number, F.lit(NUMBER))
        .when(kind == "STRING", F.lit(TEXT))
        .otherwise(F.lit(OTHER))
    )


def typed_fields(
    messages: DataFrame, fields: dict[str, str], value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Per field its value in the type given and, as ``<name>_kind``, how the message holds it.

    The payload is parsed once per message into a variant. A value that is present but cannot be
    read in its type, or does not fit it, is null; its kind tells it from a missing one. Text is
    not read as a number and a number is not read as text.
    """
    # A generator, so that the parse is not repeated inside filters on its output. What follows is
    # plain columns, one step per projection: compiled, and each field is looked up once.
    rows = messages.select(
        F.struct(*keep).alias("_kept"), F.explode(F.array(as_variant(F.col(value)))).alias("_message")
    )
    numbered = list(enumerate(fields.items()))
    rows = rows.select("_kept", *[
        F.try_variant_get("_message", F.lit(_path(name)), "variant").alias(f"_held{i}") for i, (name, _) in numbered
    ])
    shapes = {f"_shape{i}": F.schema_of_variant(F.col(f"_held{i}")) for i, _ in numbered}
    rows = rows.withColumns(shapes)
    kinds = {f"_kind{i}": _kind_of(F.col(f"_held{i}"), F.col(f"_shape{i}")) for i, _ in numbered}
    rows = rows.withColumns(kinds)
    columns = []
    for i, (name, to) in numbered:
        kind = F.col(f"_kind{i}")
        read = F.try_variant_get(f"_held{i}", F.lit("$"), to)
        right = TEXT if to == "string" else NUMBER
        columns += [F.when(kind == right, read).alias(name), kind.alias(f"{name}_kind")]
    return rows.select("_kept.*", *columns)


def archive_date(time: Column) -> Column:
    """The calendar date as written in the text, whatever its offset."""
    return F.substring(time, 1, 10).try_cast("date")


_ISO_DATE_FIRST = r"^\d{4}-\d{2}-\d{2}"


def with_problem(records: DataFrame) -> DataFrame:
    """Add ``problem`` to decoded bars: why a record cannot be archived, null if it can."""
    time = F.col("time")
    usable_time = time.rlike(_ISO_DATE_FIRST) & F.try_to_timestamp(time).isNotNull()
    nothing = [F.col(f"`{f.name}`").isNull() for f in BAR_SCHEMA if f.name in records.columns]
    empty = nothing[0]
    for column in nothing[1:]:
        empty = empty & column
    return records.withColumn(
        "problem",
        F.when(empty, F.lit("bad_json"))
        .when(F.col("ticker").isNull(), F.lit("no_ticker"))
        .when(~F.coalesce(usable_time, F.lit(False)), F.lit("bad_time")),
    )


def split_valid(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split on ``problem`` into (good rows without it, quarantined rows with it)."""
    good = tagged.where(F.col("problem").isNull()).drop("problem")
    return good, tagged.where(F.col("problem").isNotNull())
