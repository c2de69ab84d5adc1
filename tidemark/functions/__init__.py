"""Column expressions: masking, text forms, times, declared types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Types whose increments are compared as times or as numbers.
TIME_TYPES = ["date", "datetime", "timestamp", "timestampz", "timestamptz", "time", "timez", "timetz", "smalldatetime", "datetime2", "datetimeoffset"]
NUMBER_TYPES = ["interval", "smallserial", "serial", "bigserial", "bit", "integer", "int", "tinyint", "smallint", "mediumint", "bigint", "int2", "int8", "long", "byteint", "unsigned", "real", "double", "float", "numeric", "money", "smallmoney", "number", "decimal"]
# Element types of declared arrays by their internal name.
ARRAY_TYPES = {"_int4": "INTEGER[]", "_int8": "BIGINT[]", "_boolean": "BOOLEAN[]", "_float8": "FLOAT[]", "_numeric": "NUMERIC[]", "_timestamp": "TIMESTAMP[]", "_date": "DATE[]", "_time": "TIME[]", "_bpchar": "CHARACTER[]", "_text": "TEXT[]"}
FIRST_TIME, FIRST_NUMBER = "0001-01-01 00:00:00", "0"


def mask(value: Column, letter: str = "X", digit: str = "9") -> Column:
    """Every ASCII letter becomes ``letter`` and every digit ``digit``; null stays null."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), "[a-zA-Z]", letter), "[0-9]", digit)


def text_form(value: Column, kind: str) -> Column:
    """What a change log carries: ``1``/``0`` for a boolean, bytes as they are, else the text; null stays null."""
    if kind == "boolean":
        return F.when(value, "1").when(~value, "0")
    return value if kind == "binary" else value.cast("string")


def epoch_millis(value: Column, kind: str = "string") -> Column:
    """Milliseconds since 1970 of a time; of text an ISO time or a number; null if neither, so it sorts below every value."""
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_millis(value.cast("timestamp"))
    if kind != "string":
        return value.cast("long")
    return F.coalesce(F.unix_millis(F.try_to_timestamp(value)), value.try_cast("double").cast("long"))


def definition_name(definition: Column) -> Column:
    """The column name of ``name TYPE [NOT NULL|NULL]``; a name with blanks stands in double quotes."""
    quoted = F.regexp_extract(definition, '^\\s*"([^"]*)"', 1)
    return F.when(definition.rlike('^\\s*"'), quoted).otherwise(F.regexp_extract(definition, "^\\s*(\\S+)", 1))


def definition_type(definition: Column) -> Column:
    """The type of a column definition in lower case, without its nullability."""
    rest = F.when(definition.rlike('^\\s*"'), F.regexp_replace(definition, '^\\s*"[^"]*"', "")).otherwise(F.regexp_replace(definition, "^\\s*\\S+", ""))
    return F.trim(F.regexp_replace(F.lower(rest), "(not null|null).*$", ""))


def definition_nullable(definition: Column) -> Column:
    """Whether a column definition allows nulls: it does unless it says ``not null``; null for a null definition."""
    return ~F.lower(definition).contains("not null")


def same_definition(a: Column, b: Column) -> Column:
    """Whether two definitions agree but for blanks and case."""
    bare = lambda c: F.upper(F.regexp_replace(c, "\\s+", ""))
    return bare(a).eqNullSafe(bare(b))


def key_class(declared: Column) -> Column:
    """TIMESTAMP, NUMERIC or INVALID by the first word of a declared type."""
    word = F.lower(F.regexp_extract(declared, "^[^\\s(]+", 0))
    return F.when(word.isin(TIME_TYPES), "TIMESTAMP").when(word.isin(NUMBER_TYPES), "NUMERIC").otherwise("INVALID")


def initial_value(kind: Column, iso: bool = False) -> Column:
    """The checkpoint before the first read; ``iso``: times in the form that files and documents use."""
    return F.when(kind == "TIMESTAMP", FIRST_TIME.replace(" ", "T") + "Z" if iso else FIRST_TIME).otherwise(FIRST_NUMBER)


def nullability(value: Column) -> Column:
    """`` NOT NULL`` or `` NULL`` from the spellings catalogues use; empty if unknown."""
    low = F.lower(value.cast("string"))
    return F.when(low.isin("0", "n", "no", "false", "not null"), " NOT NULL").when(low.isin("1", "y", "yes", "true", "null"), " NULL").otherwise("")


def declared_type(data_type: Column, udt: Column, length: Column, precision: Column, scale: Column) -> Column:
    """The declaration of a catalogue's column: arrays by element, numbers with precision, text with length."""
    names = F.create_map(*[F.lit(x) for pair in ARRAY_TYPES.items() for x in pair])
    base = F.when(F.upper(data_type) == "ARRAY", F.coalesce(F.try_element_at(names, udt), F.lit("TEXT[]"))).otherwise(F.upper(data_type))
    number = F.concat(F.lit("("), precision.cast("string"), F.when(scale > 0, F.concat(F.lit(","), scale.cast("string"))).otherwise(""), F.lit(")"))
    size = F.when(base.isin("NUMERIC", "DECIMAL") & (precision > 0), number).when((base != "TEXT") & (length > 0), F.concat(F.lit("("), length.cast("string"), F.lit(")"))).otherwise("")
    return F.concat(base, size)


def read_type(keys: Column, method: Column) -> Column:
    """SNAPSHOT + LOG_BASED for that method, else INCREMENTAL if there are keys, else (no or null keys) SNAPSHOT."""
    return F.when(method == "LOG_BASED", "SNAPSHOT + LOG_BASED").when(keys != "", "INCREMENTAL").otherwise("SNAPSHOT")


def any_of(conditions: list[Column]) -> Column:
    """The OR of at least one condition."""
    return reduce(lambda a, b: a | b, conditions)
