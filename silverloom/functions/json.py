"""Expressions over JSON held as VARIANT: typed fields, truthiness, folds, maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverloom.functions.strings import clean_text, unfenced


def parsed(raw: Column) -> Column:
    """VARIANT of JSON text, null if malformed."""
    return F.try_parse_json(raw)


def field(v: Column, name: str, kind: str = "string") -> Column:
    """A field cast to kind; null if missing, null or not castable (12.9 is the integer 12, '12.5' none)."""
    return F.try_variant_get(v, f"$.{name}", kind)


def text(v: Column, name: str) -> Column:
    return clean_text(field(v, name))


def has(v: Column, name: str) -> Column:
    """Whether the key is there, even with a JSON null."""
    return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()


def truthy(v: Column, name: str) -> Column:
    """False for false, 0, '', [] and {}, true for other values, null for null or missing."""
    own = F.try_variant_get(v, f"$.{name}", "variant")
    kind, plain = F.schema_of_variant(own), field(v, name)
    yes = (
        F.when(kind == "BOOLEAN", plain == "true").when(kind == "STRING", plain != "").when(kind == "VOID", F.lit(None))
        .when(kind.startswith("ARRAY"), F.try_variant_get(own, "$[0]", "variant").isNotNull()).when(kind.startswith("OBJECT"), kind != "OBJECT<>").otherwise(F.coalesce(plain.try_cast("double") != 0, F.lit(True)))
    )
    return F.when(own.isNotNull(), yes)


def named_value(v: Column, path: str, name: str) -> Column:
    """The number in the first {Name, Value} element with this name."""
    data = F.try_variant_get(v, f"$.{path}", "array<struct<Name string, Value string>>")
    return F.get(F.filter(data, lambda x: x["Name"] == name), F.lit(0))["Value"].try_cast("double")


def fenced_json(reply: Column) -> Column:
    """VARIANT of a reply that may stand in a code fence; {'raw_response': reply} if it is no JSON."""
    wrapped = F.to_variant_object(F.struct(reply.alias("raw_response")))
    return F.coalesce(F.try_parse_json(unfenced(reply)), wrapped)


def constant(value: dict) -> Column:
    """A nested mapping of texts as a map literal: configuration in an expression."""
    one = lambda v: constant(v) if isinstance(v, dict) else F.lit(v)
    return F.create_map(*[x for k, v in value.items() for x in (F.lit(k), one(v))])


def merged_tables(base: Column, extra: Column) -> Column:
    """Deep merge of two maps of maps; where both have a cell, base wins."""
    empty = F.create_map().cast("map<string,map<string,string>>")
    inner = F.create_map().cast("map<string,string>")
    return F.map_zip_with(
        F.coalesce(base, empty), F.coalesce(extra, empty),
        lambda _, a, b: F.map_zip_with(F.coalesce(a, inner), F.coalesce(b, inner), lambda _, x, y: F.coalesce(x, y)),
    )


#: Which component type may fill which field, in the order tried.
ADDRESS = [
    ("neighborhood", "neighborhood"), ("sublocality", "neighborhood"), ("sublocality_level_1", "district"),
    ("administrative_area_level_2", "district"), ("locality", "city"), ("postal_code", "postal_code"),
]


def address_parts(components: Column) -> Column:
    """(neighborhood, district, city, postal_code) by an ordered fold: each component fills the first free field that its types allow."""
    names = list(dict.fromkeys(field for _, field in ADDRESS))
    start = F.struct(*[F.lit(None).cast("string").alias(n) for n in names])

    def step(acc: Column, c: Column) -> Column:
        target = F.lit(None).cast("string")
        for kind, name in reversed(ADDRESS):
            free = F.coalesce(acc[name], F.lit("")) == ""
            target = F.when(F.array_contains(c["types"], kind) & free, name).otherwise(target)
        return F.struct(*[F.when(target == n, c["long_name"]).otherwise(acc[n]).alias(n) for n in names])

    return F.aggregate(components, start, step)
