"""Column expressions over message keys, values and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type tags of Avro unions in JSON form.
_TAGGED = "struct<string:string,long:bigint,int:bigint>"


def read_tagged(df: DataFrame, text: str, fields: dict[str, str]) -> DataFrame:
    """Replace a column of JSON records by their fields, plain or tagged with a type.

    ``{"A": {"long": 5}, "B": "x"}`` and ``{"A": 5, "B": {"string": "x"}}`` give
    the same columns. ``fields`` maps names to ``string`` or ``bigint``. Values that
    do not fit are null, and so are all values of a broken record. A record is
    parsed once and read in either form as a whole, however many fields it has.
    """
    for name, kind in fields.items():
        if kind not in ("string", "bigint"):
            raise ValueError(f"field {name}: {kind} is neither string nor bigint")

    def read_as(types: dict[str, str]) -> Column:
        columns = ",".join(f"`{n}`:{t}" for n, t in types.items())
        return F.try_variant_get("__json", "$", f"struct<{columns}>")

    rest = [c for c in df.columns if c != text]
    forms = df.select(*rest, F.try_parse_json(text).alias("__json")).select(
        *rest,
        read_as(dict.fromkeys(fields, _TAGGED)).alias("__tagged"),
        read_as(fields).alias("__plain"),
    )
    tagged, plain = F.col("__tagged"), F.col("__plain")
    return forms.select(
        *rest, *(_either(tagged[n], plain[n], t).alias(n) for n, t in fields.items())
    )


def _either(tagged: Column, plain: Column, kind: str) -> Column:
    number = F.coalesce(tagged["long"], tagged["int"])
    if kind == "string":
        value = F.coalesce(tagged["string"], number.cast("string"))
    else:
        value = F.coalesce(number, tagged["string"].try_cast("bigint"))
    return F.when(tagged.isNotNull(), value).otherwise(plain)


def parse_date(text: Column | str, pattern: str = "dd-MMM-yy") -> Column:
    """Date of a text such as ``03-NOV-21``; two-digit years are of this century.

    Text of another form gives null.
    """
    return F.try_to_date(text, pattern)


def parse_time(text: Column | str) -> Column:
    """Timestamp of a text such as ``2021-11-03 07:08:09.000010``, which names no zone."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp_ntz")


def json_value(*columns: Column | str) -> Column:
    """A row as JSON text; nulls are written out, so that no field gets lost."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def as_bytes(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text).cast("string").cast("binary")


def as_text(data: Column | str) -> Column:
    return (F.col(data) if isinstance(data, str) else data).cast("string")


def parse_json(text: Column | str, schema: T.StructType) -> Column:
    return F.from_json(text, schema)
