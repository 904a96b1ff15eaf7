"""Nested documents: JSON records against a nested schema, retries, findings for entered records."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.predicates import conditional_set
from truegrain.functions.scalars import case_density, density_plausibility, gtin13_valid
from truegrain.operators.match import nearest, nearest_token_sort
from truegrain.session import materialize

ERRORS = "array<struct<path:string,check:string>>"
NUMBER_TYPES = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _error(condition: Column, path: str, check: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit(check).alias("check")))


def _paths(spec: dict, path: str = "$") -> list[str]:
    """Every path a schema looks at."""
    found = [path]
    for name, child in spec.get("properties", {}).items():
        found += _paths(child, f"{path}.{name}")
    return found


def _staged(df: DataFrame, doc: str, spec: dict) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    """Each path's value and type as columns of their own, so that no check looks them up again."""
    paths = _paths(spec)
    values = {f"_v{i}": F.variant_get(F.col(doc), p, "variant") for i, p in enumerate(paths)}
    kinds = {f"_t{i}": F.coalesce(F.schema_of_variant(F.col(f"_v{i}")), F.lit("VOID")) for i in range(len(paths))}
    out = df.withColumns(values).withColumns(kinds)
    return out, {p: (F.col(f"_v{i}"), F.col(f"_t{i}")) for i, p in enumerate(paths)}


def _node_errors(at: dict[str, tuple[Column, Column]], path: str, label: str, spec: dict, required: bool) -> list[Column]:
    """Errors of one value of a document; children are looked at only inside an object."""
    value, kind = at[path]
    there = value.isNotNull()
    found = [_error(~there, label, "required")] if required else []
    wanted = spec.get("type")
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    is_number = F.lit(False)
    for t in NUMBER_TYPES:
        is_number = is_number | kind.startswith(t)
    if wanted == "object":
        is_object = kind.startswith("OBJECT")
        found.append(_error(there & ~is_object, label, "type object"))
        needed = set(spec.get("required", ()))
        for name, child in spec["properties"].items():
            for e in _node_errors(at, f"{path}.{name}", f"{label}/{name}" if label else name, child, name in needed):
                found.append(F.when(is_object, e))
        return found
    if wanted == "integer":
        found.append(_error(there & (kind != "BIGINT"), label, "type integer"))
    elif wanted == "number":
        found.append(_error(there & ~is_number, label, "type number"))
    elif wanted == "string":
        found.append(_error(there & (kind != "STRING"), label, "type string"))
    elif wanted == "boolean":
        found.append(_error(there & (kind != "BOOLEAN"), label, "type boolean"))
    if "enum" in spec:
        found.append(_error(there & ~F.coalesce(text.isin(list(spec["enum"])), F.lit(False)), label, "enum"))
    if "pattern" in spec:
        found.append(_error((kind == "STRING") & ~text.rlike(spec["pattern"]), label, "pattern"))
    if "minLength" in spec:
        found.append(_error((kind == "STRING") & (F.length(text) < spec["minLength"]), label, "minLength"))
    if "exclusiveMinimum" in spec:
        found.append(_error(is_number & (number <= spec["exclusiveMinimum"]), label, "exclusiveMinimum"))
    if "minimum" in spec:
        found.append(_error(is_number & (number < spec["minimum"]), label, "minimum"))
    if "maximum" in spec:
        found.append(_error(is_number & (number > spec["maximum"]), label, "maximum"))
    return found


def _extra_keys(at: dict[str, tuple[Column, Column]], path: str, label: str, spec: dict) -> list[Column]:
    """Keys a closed object does not know, at every level that forbids them."""
    found = []
    if spec.get("type") == "object":
        if spec.get("additionalProperties", True) is False:
            keys = F.json_object_keys(F.to_json(at[path][0]))
            extra = F.array_except(keys, F.array(*[F.lit(k) for k in spec["properties"]]))
            prefix = f"{label}/" if label else ""
            found.append(
                F.transform(
                    F.coalesce(extra, F.array().cast("array<string>")),
                    lambda k: F.struct(F.concat(F.lit(prefix), k).alias("path"), F.lit("unexpected").alias("check")),
                )
            )
        for name, child in spec["properties"].items():
            found += _extra_keys(at, f"{path}.{name}", f"{label}/{name}" if label else name, child)
    return found


def _exploded_errors(df: DataFrame, doc: str, schema: dict, keep: list[str]) -> DataFrame:
    """One row per error of a variant column.

    The array is built inside the generator: as a column of its own, the optimizer would copy it
    into a filter below the staged lookups and parse every document once per check.
    """
    staged, at = _staged(df, doc, schema)
    parts = [F.array_compact(F.array(*_node_errors(at, "$", "", schema, True))).cast(ERRORS)]
    parts += [p.cast(ERRORS) for p in _extra_keys(at, "$", "", schema)]
    broken = F.array(F.struct(F.lit("").alias("path"), F.lit("not JSON").alias("check"))).cast(ERRORS)
    errors = F.when(F.col(doc).isNull(), broken).otherwise(F.concat(*parts))
    return staged.select(*keep, F.explode(errors).alias("e")).select(*keep, "e.path", "e.check")


def validate_records(df: DataFrame, column: str, schema: dict | str, row_id: list[str]) -> DataFrame:
    """(row id, path, check) for a column of JSON objects; unparsable text is one error."""
    spec = json.loads(schema) if isinstance(schema, str) else schema
    rows = df.select(*row_id, F.try_parse_json(F.col(column)).alias("_doc"))
    return _exploded_errors(rows, "_doc", spec, row_id)


def validate_feed(df: DataFrame, column: str, schema: dict | str, row_id: list[str]) -> DataFrame:
    """The same for a column that holds a JSON array of records: adds the index in the array."""
    spec = json.loads(schema) if isinstance(schema, str) else schema
    items = spec["items"] if spec.get("type") == "array" else spec
    records = df.select(
        *row_id, F.posexplode(F.try_parse_json(F.col(column)).cast("array<variant>")).alias("index", "_doc")
    )
    return _exploded_errors(records, "_doc", items, [*row_id, "index"])


def flatten_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Nested objects to dotted columns, for a given DDL schema (the union of all keys)."""
    parsed = df.withColumn("_j", F.from_json(column, schema))
    fields = parsed.schema["_j"].dataType

    def walk(struct, path, label):
        for f in struct.fields:
            name = f"{label}.{f.name}" if label else f.name
            if f.dataType.typeName() == "struct":
                yield from walk(f.dataType, f"{path}.`{f.name}`", name)
            else:
                yield F.col(f"{path}.`{f.name}`").alias(name)

    others = [F.col(c) for c in df.columns if c != column]
    return parsed.select(*others, *walk(fields, "_j", ""))


def shape_census(df: DataFrame, column: str) -> DataFrame:
    """How many records have each shape (keys and types), without a schema."""
    shape = F.schema_of_variant(F.try_parse_json(F.col(column)))
    return df.groupBy(F.coalesce(shape, F.lit("not JSON")).alias("shape")).agg(F.count(F.lit(1)).alias("records"))


def merged_shape(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("shape"))


# ---- documents with a list of items ---------------------------------------------------------

# Fields and units of a delivery notice.
NOTICE_FIELDS = ("supplier", "store_city", "delivery_date", "items")
ITEM_FIELDS = ("product", "quantity", "unit")
UNITS = ("count", "kg", "liter")


def notice_errors(parsed: str) -> Column:
    """All errors of a delivery notice with dotted paths; cut-off JSON is a single error.

    `parsed` names a variant column (try_parse_json of the text), so that each text is parsed once.
    """
    doc = F.col(parsed)
    text = lambda v, path: F.try_variant_get(v, path, "string")
    kind = lambda v, path: F.coalesce(F.schema_of_variant(F.variant_get(v, path, "variant")), F.lit("VOID"))
    items = F.try_variant_get(doc, "$.items", "array<variant>")
    top = [
        _error(kind(doc, "$.supplier") != "STRING", "supplier", "text required"),
        _error(kind(doc, "$.store_city") != "STRING", "store_city", "text required"),
        _error(F.to_date(F.try_to_timestamp(text(doc, "$.delivery_date"), F.lit("yyyy-MM-dd"))).isNull(), "delivery_date", "not a date"),
        _error(items.isNull() | (F.size(items) == 0), "items", "at least one item"),
    ]
    keys = F.json_object_keys(F.to_json(doc))
    extra = F.transform(
        F.array_except(keys, F.array(*[F.lit(f) for f in NOTICE_FIELDS])),
        lambda k: F.struct(k.alias("path"), F.lit("unexpected").alias("check")),
    )

    def facts(x: Column) -> Column:
        """What the checks of one item need, looked up once."""
        keys = F.json_object_keys(F.to_json(x))
        return F.struct(
            kind(x, "$.product").alias("product"),
            kind(x, "$.quantity").rlike(f"^({'|'.join(NUMBER_TYPES)})").alias("numeric"),
            F.try_variant_get(x, "$.quantity", "double").alias("quantity"),
            text(x, "$.unit").alias("unit"),
            F.array_except(keys, F.array(*[F.lit(f) for f in ITEM_FIELDS])).alias("unknown"),
        )

    def item_errors(x: Column, i: Column) -> Column:
        at = lambda name: F.concat(F.lit("items."), i.cast("string"), F.lit(f".{name}"))
        err = lambda cond, name, check: F.when(
            F.coalesce(cond, F.lit(False)), F.struct(at(name).alias("path"), F.lit(check).alias("check"))
        )
        numeric, quantity, unit = x["numeric"], x["quantity"], x["unit"]
        checks = F.array_compact(F.array(
            err(x["product"] != "STRING", "product", "text required"),
            err(~numeric, "quantity", "number required"),
            err(numeric & (quantity <= 0), "quantity", "must be positive"),
            err(numeric & (quantity > 0) & (unit == "count") & (quantity != F.floor(quantity)), "quantity", "whole number for count"),
            err(~F.coalesce(unit.isin(list(UNITS)), F.lit(False)), "unit", "not a unit"),
        )).cast(ERRORS)
        others = F.transform(x["unknown"], lambda k: F.struct(
            F.concat(F.lit("items."), i.cast("string"), F.lit("."), k).alias("path"), F.lit("unexpected").alias("check"))).cast(ERRORS)
        return F.concat(checks, F.coalesce(others, F.array().cast(ERRORS)))

    per_item = F.flatten(F.transform(F.transform(F.coalesce(items, F.array().cast("array<variant>")), facts), item_errors))
    broken = F.array(F.struct(F.lit("").alias("path"), F.lit("not JSON").alias("check"))).cast(ERRORS)
    return F.when(doc.isNull(), broken).otherwise(
        F.concat(F.array_compact(F.array(*top)).cast(ERRORS), F.coalesce(extra.cast(ERRORS), F.array().cast(ERRORS)), per_item)
    )


def problems_text(errors: str = "errors") -> Column:
    return F.array_join(F.transform(errors, lambda e: F.concat_ws(": ", e["path"], e["check"])), "; ")


def validate_with_retry(
    first: DataFrame, retry: DataFrame, row_id: str, answer: str = "answer",
    errors: Callable[[str], Column] = notice_errors,
) -> DataFrame:
    """First answers; where invalid, the retry answer is judged instead. Status: ok, ok after retry,
    quarantined. `errors` maps the name of a parsed column to an array of errors.

    One left join and one projection: splitting on the verdict would judge every document twice.
    """
    second = retry.select(row_id, F.col(answer).alias("_retry"))
    parsed = first.select(row_id, answer).join(second, row_id, "left").withColumns(
        {"_first_doc": F.try_parse_json(F.col(answer)), "_retry_doc": F.try_parse_json(F.col("_retry"))}
    )
    judged = parsed.withColumn("_first_errors", errors("_first_doc"))
    failed = F.size("_first_errors") > 0
    judged = judged.withColumn(
        "errors",
        F.when(failed & F.col("_retry").isNotNull(), errors("_retry_doc")).otherwise(F.col("_first_errors")),
    )
    bad = F.size("errors") > 0
    return judged.select(
        row_id,
        F.when(failed, F.coalesce("_retry", answer)).otherwise(F.col(answer)).alias(answer),
        F.when(bad, "quarantined").when(failed, "ok after retry").otherwise("ok").alias("status"),
        F.when(bad, problems_text()).alias("problems"),
    )


def quarantine_unknown_items(
    judged: DataFrame, row_id: str, catalog: DataFrame, name: str, name_id: str, answer: str = "answer", cutoff: float = 90.0
) -> DataFrame:
    """Accepted documents with an item no catalog name resembles at the cutoff go to quarantine too."""
    judged = materialize(judged, "judged")
    accepted = judged.filter(F.col("status") != "quarantined")
    items = accepted.select(
        row_id, F.explode(F.try_variant_get(F.try_parse_json(F.col(answer)), "$.items", "array<variant>")).alias("_i")
    ).select(row_id, F.try_variant_get(F.col("_i"), "$.product", "string").alias("product"))
    known = nearest(items, "product", catalog, name, name_id, cutoff)
    unknown = items.join(known.filter(F.col("best_name").isNull()).select("product"), "product", "left_semi")
    names = unknown.select(row_id, "product").distinct().groupBy(row_id).agg(
        F.array_join(F.sort_array(F.collect_list("product")), ", ").alias("_unknown")
    )
    out = judged.join(names, row_id, "left")
    bad = F.col("_unknown").isNotNull()
    return out.withColumn("status", F.when(bad, "quarantined").otherwise(F.col("status"))).withColumn(
        "problems", F.when(bad, F.concat(F.lit("not in the catalog: "), F.col("_unknown"))).otherwise(F.col("problems"))
    ).drop("_unknown")


# ---- records entered by people --------------------------------------------------------------

FINDING = "struct<level:string,field:string,message:string>"
# Bounds of an entered product, inclusive unless 'above' says otherwise.
CATEGORIES = (
    "produce", "dairy", "bakery", "meat", "seafood",
    "beverages", "pantry", "frozen", "household", "refill",
)
UNITS_BY_CATEGORY = {
    "produce": ("count", "kg"), "meat": ("count", "kg"), "seafood": ("count", "kg"), "refill": ("liter",),
}
NUMBER_BOUNDS = {
    "unit_price": (0, 500, True), "case_pack": (1, 200, False), "case_length_cm": (0, 200, True),
    "case_width_cm": (0, 200, True), "case_height_cm": (0, 200, True), "unit_weight_kg": (0, 50, True),
    "shelf_life_days": (1, 1825, False),
}
WHOLE_NUMBERS = ("case_pack", "shelf_life_days", "supplier_id")


def _finding(condition: Column, level: str, field: str, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(
        F.coalesce(condition, F.lit(False)),
        F.struct(F.lit(level).alias("level"), F.lit(field).alias("field"), text.alias("message")),
    )


def schema_findings() -> Column:
    found = [
        _finding(F.coalesce(~F.length("name").between(2, 255), F.lit(True)), "error", "name", "2 to 255 characters"),
        _finding(~F.coalesce(F.col("gtin").rlike("^[0-9]{13}$"), F.lit(False)), "error", "gtin", "13 digits"),
        _finding(~F.coalesce(F.col("category").isin(list(CATEGORIES)), F.lit(False)), "error", "category", "unknown category"),
        _finding(~F.coalesce(F.col("unit").isin(list(UNITS)), F.lit(False)), "error", "unit", "unknown unit"),
        _finding(F.col("supplier_id").try_cast("bigint").isNull(), "error", "supplier_id", "whole number"),
    ]
    for field, (lo, hi, above) in NUMBER_BOUNDS.items():
        v = F.col(field).try_cast("double")
        inside = ((v > lo) if above else (v >= lo)) & (v <= hi)
        if field in WHOLE_NUMBERS:
            inside = inside & (v == F.floor(v))
        found.append(_finding(~F.coalesce(inside, F.lit(False)), "error", field, f"number {'above' if above else 'from'} {lo} to {hi}"))
    return F.array_compact(F.array(*found)).cast(f"array<{FINDING}>")


def findings(df: DataFrame, catalog: DataFrame, densities: dict[str, float], row_id: str, names: bool = True, cutoff: float = 80.0):
    """Add `findings` (level, field, message) and `status` to entered products.

    A schema error stops the other checks of that row. Then: check digit, code already used, unit
    per category, density of a full case, and (with `names`) a similar name in the catalog.
    """
    out = df.withColumn("_schema", schema_findings())
    used = catalog.groupBy("gtin").agg(F.min_by("name", "id").alias("_other"))
    out = out.join(used, "gtin", "left")
    typical = F.create_map(*[F.lit(x) for kv in densities.items() for x in kv])
    num = lambda c: F.col(c).try_cast("double")
    density = case_density(num("case_length_cm"), num("case_width_cm"), num("case_height_cm"), num("unit_weight_kg"), num("case_pack"))
    out = out.withColumn("_density", density).withColumn(
        "_verdict", density_plausibility("_density", F.element_at(typical, F.col("category")))
    )
    similar = F.lit(None).cast("string")
    if names:
        ok_rows = out.filter(F.size("_schema") == 0)
        best = nearest_token_sort(ok_rows, "name", catalog, "name", "id", cutoff)
        out = out.join(best, "name", "left")
        similar = F.col("best_name")
    fits = conditional_set("category", "unit", UNITS_BY_CATEGORY, ("count",))
    checks = [
        _finding(~gtin13_valid("gtin"), "error", "gtin", "wrong check digit"),
        _finding(F.col("_other").isNotNull(), "error", "gtin", F.concat(F.lit("already used by "), F.col("_other"))),
        _finding(~fits, "error", "unit", "not a unit of this category"),
        _finding(F.col("_verdict") == "inches", "warning", "case dimensions", F.format_string("%.1f kg per liter: inches, not cm?", "_density")),
        _finding(F.col("_verdict") == "swapped", "warning", "case dimensions", F.format_string("%.2f kg per liter: fields swapped?", "_density")),
    ]
    if names:
        checks.append(_finding(similar.isNotNull(), "warning", "name", F.format_string(
            "possible duplicate of %s (product %s, %.0f %% similar)", "best_name", F.col("best_id").cast("string"), "similarity")))
    rest = F.array_compact(F.array(*checks)).cast(f"array<{FINDING}>")
    found = F.when(F.size("_schema") > 0, F.col("_schema")).otherwise(rest)
    status = (
        F.when(F.exists("findings", lambda f: f["level"] == "error"), "blocked")
        .when(F.size("findings") > 0, "needs review")
        .otherwise("accepted")
    )
    return out.withColumn("findings", found).withColumn("status", status).select(*df.columns, "findings", "status")
