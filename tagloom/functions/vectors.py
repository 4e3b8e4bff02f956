"""Vector columns (``array<double>``) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column) -> Column:
    """Unit vector; the zero vector stays as it is."""
    return let(
        v,
        lambda w: let(
            norm(w), lambda n: F.when(n > 0, F.transform(w, lambda x: x / n)).otherwise(w)
        ),
    )


def cosine(a: Column, b: Column, zero_norm_as_one: bool = False) -> Column:
    """Null when lengths differ or a norm is 0; with ``zero_norm_as_one`` 0 then."""
    if zero_norm_as_one:
        na, nb = (F.when(n == 0, F.lit(1.0)).otherwise(n) for n in (norm(a), norm(b)))
        return F.when(F.size(a) == F.size(b), dot(a, b) / (na * nb))
    scaled = let(norm(a) * norm(b), lambda p: F.when(p > 0, dot(a, b) / p))
    return F.when(F.size(a) == F.size(b), scaled)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def parse_vector(c: Column, mode: str = "unit", is_array: bool = False) -> Column:
    """Vector from a list, JSON text or ``{0.1,0.2}`` text; null when unusable.

    ``unit``  null unless all elements are finite, then normalized (mapper, backfill)
    ``raw``   null unless all elements are finite, not normalized (rebuild)
    ``drop``  elements that are not finite are left out, which shortens the vector;
              JSON text only (projection)
    """
    if is_array:
        values = as_double(c)
    else:
        text = strip(c)
        parts = F.when(text.rlike(r"(?s)^\[.*\]$"), F.from_json(text, "array<string>"))
        if mode != "drop":
            body = F.regexp_replace(text, r"^[{}]+|[{}]+$", "")
            plain = F.filter(F.split(body, ","), lambda x: strip(x) != "")
            parts = F.when(text.startswith("["), parts).otherwise(plain)
        values = F.transform(parts, lambda x: strip(x).try_cast("double"))
    if mode == "drop":
        return let(F.filter(values, _finite), lambda kept: F.when(F.size(kept) > 0, kept))
    whole = let(values, lambda v: F.when((F.size(v) > 0) & F.forall(v, _finite), v))
    return l2_normalize(whole) if mode == "unit" else whole


def representatives(c: Column) -> Column:
    """Labels out of JSON: strings, objects with a label key, or an object with a list."""
    keys = ["raw_label", "label", "medoid_label", "name"]
    lists = ["labels", "representative_labels", "raw_labels"]
    text = strip(c)
    items = F.transform(
        F.from_json(text, "array<string>"),
        lambda x: F.when(
            x.startswith("{"),
            F.coalesce(*[F.nullif(F.get_json_object(x, f"$.{k}"), F.lit("")) for k in keys]),
        ).otherwise(x),
    )
    empty = F.array().cast("array<string>")
    nested = F.concat(
        *[
            F.coalesce(F.from_json(F.get_json_object(text, f"$.{k}"), "array<string>"), empty)
            for k in lists
        ]
    )
    found = F.when(text.startswith("["), items).when(text.startswith("{"), nested)
    return F.array_distinct(
        F.filter(
            F.transform(F.coalesce(found, empty), lambda x: strip(x)),
            lambda x: x.isNotNull() & (x != ""),
        )
    )
