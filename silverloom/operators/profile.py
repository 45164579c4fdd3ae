"""Schema profiling of JSON columns: key paths, coverage, types, samples, coverage by type."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of the kinds of JSON values, by the VARIANT's.
KINDS = {"STRING": "str", "BIGINT": "int", "DOUBLE": "float", "DECIMAL": "float", "BOOLEAN": "bool", "VOID": "NoneType", "OBJECT": "dict", "ARRAY": "list"}
PATHS = "array<struct<path string, v variant>>"
#: Paths that a task holds before it hands their states on; a bound of memory.
HELD = 100_000


def _inside(v: Column) -> tuple[Column, Column]:
    """The object whose keys are read at v: v itself, or a list's first element; and what that adds to the path."""
    is_list = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(is_list, F.try_variant_get(v, "$[0]", "variant")).otherwise(v), F.when(is_list, "[]").otherwise("")


def _walked(v: Column, prefix: Column, depth: int) -> Column:
    """All keys below v as an array of (path, value), down to `depth` levels; one expression, nothing is read twice."""
    inner, more = _inside(v)
    keys = F.map_entries(F.when(F.schema_of_variant(inner).startswith("OBJECT"), F.try_variant_get(inner, "$", "map<string,variant>")))

    def one(e: Column) -> Column:
        path = F.concat(prefix, more, F.when(prefix != "", ".").otherwise(""), e["key"])
        own = F.array(F.struct(path.alias("path"), e["value"].alias("v")))
        return F.concat(own, _walked(e["value"], path, depth - 1)) if depth > 1 else own

    return F.coalesce(F.flatten(F.transform(keys, one)), F.array().cast(PATHS))


def key_paths(df: DataFrame, raw: str, keep: list[str], depth: int = 4) -> DataFrame:
    """(keep..., path, kind, value) of all keys down to `depth` levels; lists are read by their first element as 'path[]'.

    One pass over df and one explode. Malformed JSON has no keys. value: the first 50
    characters, '[dict]' or '[list]', null for a JSON null.
    """
    found = df.select(*keep, F.inline(_walked(F.try_parse_json(raw), F.lit(""), depth)))
    word = F.regexp_extract(F.schema_of_variant("v"), r"^[A-Z]+", 0)
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), word), word)
    nested = kind.isin("dict", "list")
    value = F.when(nested, F.concat(F.lit("["), kind, F.lit("]"))).when(kind != "NoneType", F.left(F.try_variant_get("v", "$", "string"), F.lit(50)))
    return found.select(*keep, "path", kind.alias("kind"), value.alias("value"))


def path_states(paths: DataFrame, by: list[str], samples: int) -> DataFrame:
    """(by..., path, n, nulls, kinds, least, greatest) of rows of key_paths, one for each path and task.

    least: the first `samples` of the distinct values in order. States are merged by sums, unions and
    by the least of the least, so what is shuffled grows with paths and tasks, not with values.
    """
    names = [*by, "path", "kind", "value"]
    schema = T.StructType([*(paths.schema[c] for c in by), T.StructField("path", T.StringType())])
    for name, kind in {"n": "bigint", "nulls": "bigint", "kinds": "array<string>", "least": "array<string>", "greatest": "string"}.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    made = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def out(kinds: list[pa.DataType]) -> pa.RecordBatch:
            columns = list(zip(*((*k, n, nulls, sorted(seen), least, greatest) for k, (n, nulls, seen, least, greatest) in held.items()))) or [[]] * len(schema)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*kinds, *made])], names=schema.names)

        for b in batches:
            own = b.schema.types[: len(by)]
            found = pa.Table.from_batches([b.rename_columns(names)]).group_by(names).aggregate([([], "count_all")])
            for *key, kind, value, n in zip(*(found[c].to_pylist() for c in [*names, "count_all"])):
                s = held.setdefault(tuple(key), [0, 0, set(), [], None])
                s[0] += n
                s[1] += n if kind == "NoneType" else 0
                s[2].add(kind)
                if value is None:
                    continue
                if s[4] is None or value > s[4]:
                    s[4] = value
                if (len(s[3]) < samples or value < s[3][-1]) and value not in s[3]:
                    s[3] = sorted([*s[3], value])[:samples]
            if len(held) > HELD:
                yield out(own)
        if held:
            yield out(own)

    return paths.select(*names).mapInArrow(run, schema)


def coverage(df: DataFrame, raw: str, by: list[str] | None = None, depth: int = 4, samples: int = 3, drop: list[str] | None = None, sparse: float = 10.0, complete: str = "") -> DataFrame:
    """A row for each key path (and group): count, coverage and null share of all records, kinds, samples, flag.

    Samples are the first of the distinct values in order. `drop`: top-level keys that are left
    out. `sparse`: the coverage in percent under which a path is sparse; `complete`: the mark of
    paths that all records have and that are never null.
    """
    by = by or []
    total = df.groupBy(*by).agg(F.count("*").alias("records"))
    paths = key_paths(df, raw, by, depth)
    if drop:
        paths = paths.where(~F.split_part("path", F.lit("."), F.lit(1)).isin(drop))
    all_of = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    out = path_states(paths, by, max(1, samples)).groupBy(*by, "path").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), all_of("kinds").alias("kinds"), all_of("least").alias("least"), F.max("greatest").alias("greatest")
    )
    out = out.withColumns({"samples": F.slice("least", 1, samples), "constant": F.coalesce(F.get("least", F.lit(0)) == F.col("greatest"), F.lit(False))})
    out = out.join(total, by) if by else out.withColumn("records", total.scalar())
    share, null_share = F.col("n") * 100.0 / F.col("records"), F.col("nulls") * 100.0 / F.col("records")
    return out.select(
        *by, "path", "n", "records", F.round(share, 1).alias("coverage_pct"), F.round(null_share, 1).alias("null_pct"), "kinds",
        "samples", flag(share, null_share, F.col("constant"), sparse, complete).alias("flag"),
    )


def flag(share: Column, null_share: Column, constant: Column, sparse: float = 10.0, complete: str = "") -> Column:
    word = "sparse" if sparse >= 10 else "very sparse"
    full = (share == 100) & (null_share == 0)
    return F.when(share < sparse, word).when(null_share > 90, "mostly null").when(constant, "constant").when(full, complete).otherwise("")


def profile_by_type(df: DataFrame, raw: str, group: str, drop: list[str]) -> DataFrame:
    """Coverage by group, three levels deep, without the dropped keys; complete paths are marked, the commonest come first."""
    own = coverage(df, raw, [group], depth=3, drop=drop, sparse=5.0, complete="complete")
    return own.orderBy(group, F.desc("n"), "path")


def coverage_pivot(df: DataFrame, raw: str, group: str, groups: list, depth: int = 3, spread: float = 20.0, drop: list[str] | None = None) -> DataFrame:
    """Coverage of each path by group, where the greatest and least differ by more than `spread` points."""
    own = coverage(df, raw, [group], depth, drop=drop).groupBy("path").pivot(group, groups).agg(F.first("coverage_pct"))
    own = own.fillna(0.0)
    cols = [F.col(f"`{g}`") for g in groups]
    return own.where(F.greatest(*cols) - F.least(*cols) > spread)
