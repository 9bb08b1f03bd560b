"""Label lines and class maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .geometry import polygon_area

INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?)$"
NOT_FINITE = r"^[+-]?(nan|inf|infinity)$"


def tokens(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def class_token(line_tokens: Column) -> Column:
    first = line_tokens[0]
    return F.when(first.rlike(INTEGER), first.try_cast("int"))


def coordinates(line_tokens: Column) -> Column:
    rest = F.slice(line_tokens, 2, F.greatest(F.size(line_tokens) - 1, F.lit(0)))
    return F.transform(rest, lambda t: t.try_cast("double"))


def parse_line(line: Column) -> Column:
    """STRUCT<class_id, coords, errors, counted> of one label line.

    A line with a format error, a token that is no number or a coordinate that
    is not finite stops at that error; the remaining checks all apply together.
    """
    parts = tokens(line)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    class_id, coords = class_token(parts), coordinates(parts)
    wrong_shape = (F.size(parts) < 7) | ((F.size(parts) - 1) % 2 != 0)
    numeric = class_id.isNotNull() & F.forall(
        rest, lambda t: t.rlike(NUMBER) | F.lower(t).rlike(NOT_FINITE)
    )
    finite = F.forall(rest, lambda t: ~F.lower(t).rlike(NOT_FINITE) & (F.abs(t.try_cast("double")) < float("inf")))
    return F.struct(
        class_id.alias("class_id"),
        coords.alias("coords"),
        wrong_shape.alias("wrong_shape"),
        F.coalesce(numeric, F.lit(False)).alias("numeric"),
        F.coalesce(finite, F.lit(False)).alias("finite"),
    )


def line_errors(parsed: Column, known_class: Column) -> Column:
    outside = F.exists(parsed["coords"], lambda x: (x < 0) | (x > 1))
    flat = polygon_area(parsed["coords"]) <= 1e-8
    unknown = F.when(~known_class, F.lit("unknown_class"))
    return (
        F.when(parsed["wrong_shape"], F.array(F.lit("bad_format")))
        .when(~parsed["numeric"], F.array(F.lit("not_numeric")))
        .when(~parsed["finite"], F.array_compact(F.array(unknown, F.lit("not_finite"))))
        .otherwise(
            F.array_compact(
                F.array(
                    unknown,
                    F.when(outside, F.lit("out_of_range")),
                    F.when(flat, F.lit("degenerate_polygon")),
                )
            )
        )
    )


def counts_as_polygon(parsed: Column) -> Column:
    return ~parsed["wrong_shape"] & parsed["numeric"] & parsed["finite"]


def class_map_from_list(names: Column) -> Column:
    return F.map_from_arrays(F.sequence(F.lit(0), F.size(names) - 1), names)


def class_map_from_text_keys(mapping: Column) -> Column:
    return F.transform_keys(mapping, lambda k, _: k.try_cast("int"))


def layered(*values: Column) -> Column:
    """First layer that has a value; the last one is the default."""
    return F.coalesce(*values)
