"""Value comparison between two columns whose types may differ."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.rows import is_text

_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}

_NESTED = (T.ArrayType, T.StructType, T.MapType)

# Decimals that need more than 38 digits together are compared in two parts, both exact.
SPLIT = T.StructType(
    [T.StructField("whole", T.DecimalType(38, 0)), T.StructField("part", T.DecimalType(38, 38))]
)


_NUMERIC = (T.NumericType, T.BooleanType)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type both sides can be compared in, or None when only text is left.

    A text column meets the other side's type (its values are cast where they can be).
    """
    if left == right:
        return left
    if is_text(left) and is_text(right):
        return T.StringType()
    if is_text(left) or is_text(right):
        typed = right if is_text(left) else left
        return None if isinstance(typed, _NESTED) else typed
    if isinstance(left, _NUMERIC) and isinstance(right, _NUMERIC):
        # a truth value meets a number as 1 or 0
        left, right = [T.ByteType() if isinstance(kind, T.BooleanType) else kind for kind in (left, right)]
        if isinstance(left, T.FractionalType) and not isinstance(left, T.DecimalType):
            return T.DoubleType()
        if isinstance(right, T.FractionalType) and not isinstance(right, T.DecimalType):
            return T.DoubleType()
        if isinstance(left, T.DecimalType) or isinstance(right, T.DecimalType):
            return _wider_decimal(_as_decimal(left), _as_decimal(right))
        return left if _INTEGRAL_DIGITS[type(left)] >= _INTEGRAL_DIGITS[type(right)] else right
    if {type(left), type(right)} <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType() if T.TimestampType() in (left, right) else T.TimestampNTZType()
    return None


def _as_decimal(data_type: T.DataType) -> T.DecimalType:
    if isinstance(data_type, T.DecimalType):
        return data_type
    if isinstance(data_type, T.BooleanType):
        return T.DecimalType(1, 0)
    return T.DecimalType(_INTEGRAL_DIGITS[type(data_type)], 0)


def _wider_decimal(left: T.DecimalType, right: T.DecimalType) -> T.DataType:
    scale = max(left.scale, right.scale)
    whole = max(left.precision - left.scale, right.precision - right.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else SPLIT


def _split(value: Column, own: T.DataType) -> Column:
    """A decimal as its floor and the rest after the point; equal numbers of any scale give equal parts."""
    value = value.cast(_as_decimal(own))
    parts = F.struct(
        F.floor(value).cast(SPLIT["whole"].dataType).alias("whole"),
        (value % F.lit(Decimal(1))).cast(SPLIT["part"].dataType).alias("part"),
    )
    return F.when(value.isNotNull(), parts)


def _holds(data_type: T.DataType, kinds: tuple) -> bool:
    if isinstance(data_type, kinds):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds(data_type.elementType, kinds)
    if isinstance(data_type, T.MapType):
        return _holds(data_type.keyType, kinds) or _holds(data_type.valueType, kinds)
    if isinstance(data_type, T.StructType):
        return any(_holds(field.dataType, kinds) for field in data_type.fields)
    return False


def _ordered(value: Column, data_type: T.DataType) -> Column:
    """Maps cannot be compared; their sorted entries can."""
    if not _holds(data_type, (T.MapType,)):
        return value
    if isinstance(data_type, T.MapType):
        item_type = data_type.valueType
        if _holds(item_type, (T.MapType,)):
            value = F.transform_values(value, lambda _, item: _ordered(item, item_type))
        return F.array_sort(F.map_entries(value))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: _ordered(item, data_type.elementType))
    fields = [_ordered(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def holds_map(data_type: T.DataType) -> bool:
    return _holds(data_type, (T.MapType,))


def ordered_text(value: Column, data_type: T.DataType) -> Column:
    """A value with maps as text that doesn't follow the order of a map's entries; NULL is empty."""
    return F.coalesce(_ordered(value, data_type).cast("string"), F.lit(""))


def _plain_zero(value: Column, data_type: T.DataType) -> Column:
    """-0.0 written as 0.0, at any depth, as both count as equal."""
    if not _holds(data_type, (T.FloatType, T.DoubleType)):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: _plain_zero(item, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [_plain_zero(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.MapType):
        value = F.transform_values(value, lambda _, item: _plain_zero(item, data_type.valueType))
        return F.transform_keys(value, lambda key, _: _plain_zero(key, data_type.keyType))
    return value + F.lit(0.0).cast(data_type)


def comparable(value: Column, own: T.DataType, other: T.DataType) -> Column:
    """``value`` brought to the type shared with the other side.

    Texts that do not fit that type become NULL here; ``misfit`` tells them apart.
    """
    shared = common_type(own, other)
    if shared is None:
        return value.cast("string")
    if shared is SPLIT:
        return _split(value, own)
    if own != shared:
        value = value.try_cast(shared) if is_text(own) else value.cast(shared)
    return _ordered(value, shared)


def misfit(value: Column, own: T.DataType, other: T.DataType) -> Column:
    """A text that has no counterpart in the other side's type."""
    shared = common_type(own, other)
    if shared is None or not is_text(own) or is_text(shared):
        return F.lit(False)
    return value.isNotNull() & value.try_cast(shared).isNull()


def differs(left: Column, left_type: T.DataType, right: Column, right_type: T.DataType) -> Column:
    """NULL-safe inequality of two column values, TRUE or FALSE and never NULL."""
    if left_type == right_type and not _holds(left_type, (T.MapType,)):
        return ~left.eqNullSafe(right)
    unequal = ~comparable(left, left_type, right_type).eqNullSafe(comparable(right, right_type, left_type))
    if is_text(left_type) == is_text(right_type):
        return unequal
    return unequal | misfit(left, left_type, right_type) | misfit(right, right_type, left_type)


JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def safe_text(value: Column, data_type: T.DataType) -> Column:
    """Text that tells all values of a type apart; nested ones as JSON, maps by their sorted entries."""
    if not isinstance(data_type, _NESTED):
        return value.cast("string")
    return F.when(value.isNotNull(), F.to_json(F.struct(_ordered(value, data_type).alias("v")), JSON))


def value_text(value: Column, own: T.DataType, other: T.DataType) -> Column:
    """Text that two values share exactly when ``differs`` is FALSE for them (NULL for NULL)."""
    shared = common_type(own, other) or T.StringType()
    if own == other:
        value = _plain_zero(value, own)
    inner = comparable(value, own, other)
    if isinstance(shared, (T.FloatType, T.DoubleType)):
        text = _plain_zero(inner, shared).cast("string")
    elif isinstance(shared, T.TimestampType):
        text = F.unix_micros(inner).cast("string")
    elif isinstance(shared, T.BinaryType):
        text = F.hex(inner)
    elif shared is SPLIT:
        text = F.when(inner.isNotNull(), F.concat_ws(" ", inner["whole"].cast("string"), inner["part"].cast("string")))
    elif isinstance(shared, _NESTED):
        json = F.to_json(F.struct(inner.alias("v")), JSON)
        text = F.when(inner.isNotNull(), json)
    else:
        text = inner.cast("string")
    # long values travel as their SHA-256, marked so that no short value looks like one
    text = F.when(F.octet_length(text) > 64, F.concat(F.lit("\u0001"), F.sha2(text, 256))).otherwise(text)
    if is_text(own) == is_text(other):
        return text
    # a misfit equals nothing on the other side; the marker keeps it off every real value
    return F.when(misfit(value, own, other), F.concat(F.lit("\u0000"), value.cast("string"))).otherwise(text)
