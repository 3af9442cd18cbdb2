"""Drift of the feed's fields: what landed documents hold against what the parser reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a document's header and of its items, with the kinds the parser can read.
EXPECTED = {
    "lokasi.adm4": "STRING",
    "lokasi.desa": "STRING",
    "lokasi.kecamatan": "STRING",
    "lokasi.kotkab": "STRING",
    "lokasi.provinsi": "STRING",
    "datetime": "STRING",
    "t": "NUMBER STRING",
    "hu": "NUMBER STRING",
    "weather_desc": "STRING",
    "ws": "NUMBER STRING",
    "wd": "STRING",
}


def _kind(value: Column) -> Column:
    """STRING, NUMBER, BOOLEAN, ARRAY, OBJECT, or null for a JSON null."""
    name = F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)
    number = name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "TINYINT", "SMALLINT")
    return F.when(number, "NUMBER").when(name != "VOID", name)


def _lists(values: Column, path: str) -> Column:
    """The members, in one array, of all lists that these variants hold at a path."""
    lists = F.transform(values, lambda value: F.try_variant_get(value, path, "array<variant>"))
    return F.flatten(F.filter(lists, lambda many: many.isNotNull()))


def _part(name: str, value: Column, path: str) -> Column:
    """A header or item as its sort and its fields' names and kinds; fields are null where it is no object."""
    fields = F.map_entries(F.try_variant_get(value, path, "map<string,variant>"))
    named = F.transform(fields, lambda entry: F.struct(entry["key"].alias("name"), _kind(entry["value"]).alias("kind")))
    return F.struct(F.lit(name).alias("part"), named.alias("fields"))


def document_fields(documents: DataFrame, run: str) -> DataFrame:
    """(run, field, kind, n): how many headers or items of a landing run hold a field of a kind, and their number in
    all as field ``lokasi`` and ``item``. Documents are objects of variants, so nothing has to be known before; those
    that are no JSON, and parts that are not of the feed's shape, hold no fields.

    A document is parsed once. Its parts are first counted by all their fields and kinds together, as most parts of a
    run have the same; only these counts become a row per field. The outer explode keeps Spark from putting a filter
    before it that would parse each document again.
    """
    parsed = documents.select(F.col(run).alias("run"), F.try_parse_json("doc").alias("doc"))
    entries = F.try_variant_get("doc", "$.data", "array<variant>")
    items = F.transform(_lists(_lists(entries, "$.cuaca"), "$"), lambda item: _part("item", item, "$"))
    heads = F.array(_part("lokasi", F.col("doc"), "$.lokasi"))
    parts = parsed.select("run", F.explode_outer(F.concat(heads, F.coalesce(items, F.array()))).alias("p")).select("run", "p.*")
    alike = parts.where("fields is not null").groupBy("run", "part", "fields").agg(F.count(F.lit(1)).alias("n"))
    prefix = F.when(F.col("part") == "lokasi", "lokasi.").otherwise("")
    each = F.transform("fields", lambda f: F.struct(F.concat(prefix, f["name"]).alias("field"), f["kind"].alias("kind")))
    total = F.array(F.struct(F.col("part").alias("field"), F.lit("OBJECT").alias("kind")))
    held = alike.select("run", "n", F.inline_outer(F.concat(total, each)))
    return held.groupBy("run", "field", "kind").agg(F.sum("n").alias("n"))


def field_drift(documents: DataFrame, run: str, expected: dict[str, str] | None = None) -> DataFrame:
    """(run, field, status, kinds, n) for every field of a landing run that is not as expected.

    ``added``: nobody reads it. ``vanished``: no header or item of the run has it, not even as null. ``missing``: some
    have it not. ``retyped``: it comes in a kind the parser does not read. ``n`` counts the headers or items it is so
    in, ``kinds`` names what was found instead. One row per run and field is all that is compared.
    """
    expected = expected or EXPECTED
    wanted = F.array(*[F.struct(F.lit(f).alias("field"), F.lit("lokasi" if f.startswith("lokasi.") else "item").alias("part")) for f in expected])
    readable = F.try_element_at(F.create_map(*[x for f, kinds in expected.items() for x in (F.lit(f), F.array(*map(F.lit, kinds.split())))]), F.col("field"))
    no_number, no_kind = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    sort, counted = F.col("field"), F.col("n")
    # A run's total of headers or items becomes a row for each field they should have, so no join is needed.
    due = F.transform(
        F.filter(wanted, lambda w: w["part"] == sort),
        lambda w: F.struct(w["field"].alias("field"), counted.alias("total"), no_kind.alias("kind"), no_number.alias("n")),
    )
    held = F.array(F.struct("field", no_number.alias("total"), "kind", "n"))
    is_total = sort.isin("lokasi", "item")
    rows = F.when(is_total & (F.col("kind") == "OBJECT"), due).when(~is_total, held)
    marked = document_fields(documents, run).select("run", F.inline(rows))
    wrong = F.col("kind").isNotNull() & ~F.coalesce(F.array_contains(readable, F.col("kind")), F.lit(False))
    per_field = marked.groupBy("run", "field").agg(
        F.max("total").alias("total"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(wrong, F.col("n"))), F.lit(0)).alias("wrong"),
        F.array_join(F.array_sort(F.collect_set(F.when(wrong, F.col("kind")))), ",").alias("found_kinds"),
    )
    absent = F.when(F.col("present") == 0, "vanished").when(F.col("present") < F.col("total"), "missing")

    def change(applies: Column, status: Column, kinds: Column, n: Column) -> Column:
        return F.when(applies, F.struct(status.alias("status"), kinds.alias("kinds"), n.alias("n")))

    compared = readable.isNotNull() & F.col("total").isNotNull()
    changes = F.array_compact(
        F.array(
            change(compared & absent.isNotNull(), absent, F.lit(""), F.col("total") - F.col("present")),
            change(compared & (F.col("wrong") > 0), F.lit("retyped"), F.col("found_kinds"), F.col("wrong")),
            change(readable.isNull(), F.lit("added"), F.col("found_kinds"), F.col("present")),
        )
    )
    return per_field.select("run", "field", F.inline(changes))
