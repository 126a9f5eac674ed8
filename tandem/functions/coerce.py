"""Column expressions that reproduce the reading rules of a JSON tree model.

The feed is schemaless JSON read field by field; a reader asks a node for
``text``, ``long``, ``int`` or ``float`` and gets a default for the wrong
kind of node instead of an error.  These helpers give the same answers with
built-in Spark expressions only (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INT_MIN, _INT_MAX = -2147483648, 2147483647


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Strip every leading/trailing char <= U+0020 (Spark's trim strips spaces only)."""
    return F.regexp_replace(_col(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def as_long(text) -> Column:
    """Long value of a scalar read as text: numbers and numeric text parse,
    anything else gives 0.  Null (absent) stays null so callers can drop it."""
    t = _col(text)
    by_long = t.try_cast("bigint")
    by_double = t.try_cast("double")
    as_dbl = F.when(by_double.isNotNull() & ~F.isnan(by_double)
                    & (F.abs(by_double) < F.lit(9.2e18)), by_double.cast("bigint"))
    return F.when(t.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(by_long, as_dbl, F.lit(0).cast("bigint")))


def _finite(d: Column) -> Column:
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))


def json_int(d, text=None) -> Column:
    """int of a member already parsed as double: truncate toward zero;
    non-numbers (null after parsing) give 0.

    Beyond the int range a fraction saturates and an integer keeps its low 32
    bits; ``text``, the member's JSON text, tells them apart and is only
    evaluated for such values."""
    d = _col(d)
    clipped = F.least(F.greatest(d, F.lit(float(_INT_MIN))), F.lit(float(_INT_MAX))).cast("int")
    if text is not None:
        t = _col(text)
        big = F.when(t.rlike(r"^-?[0-9]{1,37}$"), t.try_cast("decimal(38,0)"))
        low = (F.pmod(big + F.lit(2147483648), F.lit(4294967296)) - F.lit(2147483648)).cast("int")
        clipped = F.when((d > _INT_MAX) | (d < _INT_MIN), F.coalesce(low, clipped)).otherwise(clipped)
    return F.when(_finite(d), clipped).otherwise(F.lit(0))


def json_float(d) -> Column:
    """32-bit float of a member parsed as double (double first, then narrowed,
    as a tree model does); non-numbers give 0.0."""
    d = _col(d)
    return F.when(_finite(d), d.cast("float")).otherwise(F.lit(0.0).cast("float"))


def node_kind(raw, path: str) -> Column:
    """Kind of a node of a JSON text: OBJECT..., ARRAY..., BOOLEAN, STRING, ..."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(_col(raw)), path, "variant"))


def as_text(text, raw, path: str) -> Column:
    """Text of the node at ``path``, decoded as ``text``: objects and arrays
    read as ''.  Only texts that look like one are parsed again."""
    t = _col(text)
    inner = node_kind(raw, path).rlike("^(OBJECT|ARRAY)")
    return F.when(F.substring(t, 1, 1).isin("{", "["), F.when(inner, F.lit("")).otherwise(t)).otherwise(t)


def member_names(doc) -> Column:
    """Distinct member names of a JSON object text, in document order
    (a repeated name keeps its first place); null when not an object."""
    return F.array_distinct(F.json_object_keys(_col(doc)))


def member_count(doc) -> Column:
    """Number of members of a JSON object text, 0 for anything else."""
    return F.coalesce(F.size(member_names(doc)), F.lit(0))


def variant_number(v) -> Column:
    """Double value of a variant when it holds a JSON number, else null."""
    v = _col(v)
    is_num = F.schema_of_variant(v).rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(is_num, v.cast("double"))


def with_once(df: DataFrame, **named: Column) -> DataFrame:
    """``df`` plus columns that are computed exactly once per row.

    The optimizer pushes a filter below the projection that defines a column
    by copying the column's expression into the filter; for a JSON parse
    that means one parse per predicate.  Computing the columns inside a
    one-row ``inline`` generator stops that: predicates on generator output
    stay above it.  The input columns pass by the generator untouched, so
    the ones nobody reads later are still pruned.
    """
    fields = [e.alias(n) for n, e in named.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))
