"""Integrity rules as batch jobs: keys, references, row rules, document schemas, dependencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.schemas import Field, Reference, Rule


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often. Keys with a NULL part are never equal."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def orphans(child: DataFrame, parent: DataFrame, columns: list[str], parent_columns: list[str] | None = None) -> DataFrame:
    """Child rows whose reference is complete but names no parent. NULL references pass."""
    targets = parent_columns or columns
    known = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(targets)])
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(columns)])
    return child.where(complete).join(known, match, "left_anti")


def on_parent_delete(child: DataFrame, deleted: DataFrame, reference: Reference) -> DataFrame:
    """What a child table looks like after parent rows went, by the reference's action.

    ``set null``: the reference columns of affected rows become NULL. ``cascade``: affected rows go.
    ``restrict``: the affected rows themselves are returned; the deletion is allowed only if none.
    """
    gone = deleted.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(reference.parent_columns)]).distinct()
    match = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(reference.columns)]
    )
    if reference.on_delete == "cascade":
        return child.join(gone, match, "left_anti")
    if reference.on_delete == "restrict":
        return child.join(gone, match, "left_semi")
    if reference.on_delete != "set null":
        raise ValueError(f"unknown action {reference.on_delete!r}")
    joined = child.join(gone.withColumn("_gone", F.lit(True)), match, "left")
    kept = F.col("_gone").isNull()
    return joined.select(
        *[F.when(kept, F.col(c)).alias(c) if c in reference.columns else F.col(c) for c in child.columns]
    )


def failed_rules(rules: list[Rule]) -> Column:
    """Names of the rules a row breaks. As with CHECK, an unknown outcome is no failure."""
    return F.array_compact(F.array(*[F.when(~rule.holds, F.lit(rule.name)) for rule in rules]).cast("array<string>"))


def validate(df: DataFrame, rules: list[Rule], column: str = "failed_rules") -> DataFrame:
    return df.withColumn(column, failed_rules(rules))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the quarantine with the names of the broken ones."""
    checked = validate(df, rules)
    return (
        checked.where(F.size("failed_rules") == 0).drop("failed_rules"),
        checked.where(F.size("failed_rules") > 0),
    )


def rule_summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Number of broken rows per rule; rules nobody breaks are listed with 0."""
    counts = df.agg(*[F.count_if(~rule.holds).alias(rule.name) for rule in rules])
    entries = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rows")) for r in rules]
    return counts.select(F.inline(F.array(*entries)))


# --- document schemas ------------------------------------------------------------------------------


def _type_holds(value: Column, shape: Column, kind: str) -> Column:
    """Whether a value of the given shape (``schema_of_variant``) has a type."""
    if kind == "string":
        return shape == "STRING"
    if kind == "int":
        return shape == "BIGINT"
    if kind == "double":
        return shape.rlike("^(DOUBLE|FLOAT|DECIMAL)")
    if kind == "object":
        return shape.startswith("OBJECT")
    if kind == "array":
        return shape.startswith("ARRAY")
    if kind == "date":
        return (shape == "STRING") & F.try_to_timestamp(F.try_variant_get(value, "$", "string")).isNotNull()
    raise ValueError(f"unknown type {kind!r}")


def _child(doc: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$['{name}']", kind)


def _field_violations(value: Column, shape: Column, f: Field, name: str) -> list[Column]:
    """Messages (or NULL) for one property, given its value and shape."""
    present = value.isNotNull()  # a JSON null is present and of type null
    right = F.coalesce(_type_holds(value, shape, f.kind), F.lit(False))
    out = [F.when(present & ~right, F.lit(f"{name}: not {f.kind}"))]
    if f.required:
        out.insert(0, F.when(~present, F.lit(f"{name}: missing")))
    number = F.try_variant_get(value, "$", "double")
    if f.minimum is not None:
        out.append(F.when(present & right & (number < f.minimum), F.lit(f"{name}: below {f.minimum:g}")))
    if f.maximum is not None:
        out.append(F.when(present & right & (number > f.maximum), F.lit(f"{name}: above {f.maximum:g}")))
    if f.allowed:
        text = F.try_variant_get(value, "$", "string")
        out.append(F.when(present & right & ~text.isin(f.allowed), F.lit(f"{name}: not in domain")))
    return out


def _item_violations(value: Column, f: Field) -> Column:
    """Distinct messages over all elements of an array property."""
    nothing = F.array().cast("array<string>")
    items = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))

    def holds(x: Column, kind: str) -> Column:
        return F.coalesce(_type_holds(x, F.schema_of_variant(x), kind), F.lit(False))

    if isinstance(f.items, str):
        bad = F.exists(items, lambda x: ~holds(x, f.items))
        return F.when(bad, F.array(F.lit(f"{f.path}[]: not {f.items}"))).otherwise(nothing)

    def messages(x: Column) -> Column:
        inner = []
        for g in f.items:
            value = _child(x, g.path)
            inner += _field_violations(value, F.schema_of_variant(value), g, f"{f.path}[].{g.path}")
        return F.when(holds(x, "object"), F.array_compact(F.array(*inner))).otherwise(
            F.array(F.lit(f"{f.path}[]: not object"))
        )

    return F.array_distinct(F.flatten(F.transform(items, messages)))


def validate_documents(df: DataFrame, column: str, fields: list[Field]) -> DataFrame:
    """Adds ``violations`` to documents held as JSON text or VARIANT. Nothing is dropped.

    A sorted list of messages, empty when valid. A missing property is only wrong when required; a
    JSON null has the wrong type for every property; what is no object at all gets the single message
    ``not an object``. A document is parsed once, every property is taken out once and its type
    determined once, in projections that build on each other.
    """
    doc = F.col(column)
    if df.schema[column].dataType.typeName() == "string":
        doc = F.try_parse_json(column)
    staged = (
        df.withColumn("_doc", doc)
        .withColumn("_values", F.struct(*[_child(F.col("_doc"), f.path).alias(f.path) for f in fields]))
        .withColumn(
            "_shapes", F.struct(*[F.schema_of_variant(F.col("_values")[f.path]).alias(f.path) for f in fields])
        )
    )
    flat = [
        m for f in fields for m in _field_violations(F.col("_values")[f.path], F.col("_shapes")[f.path], f, f.path)
    ]
    nested = [_item_violations(F.col("_values")[f.path], f) for f in fields if f.items is not None]
    found = F.array_sort(F.flatten(F.array(F.array_compact(F.array(*flat)), *nested)))
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    return staged.withColumn(
        "violations", F.when(is_object, found).otherwise(F.array(F.lit("not an object")))
    ).drop("_doc", "_values", "_shapes")


# --- counts, dependencies, versions ----------------------------------------------------------------


def reconcile(sources: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the source files against the loaded tables."""

    def counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias(name)).withColumn("tabla", F.lit(t)) for t, df in tables.items()]
        return reduce(DataFrame.unionByName, parts)

    both = counts(sources, "source_rows").join(counts(loaded, "table_rows"), "tabla", "full")
    return both.withColumn("match", F.coalesce(F.col("source_rows") == F.col("table_rows"), F.lit(False))).select(
        "tabla", "source_rows", "table_rows", "match"
    )


def dependency_violations(df: DataFrame, determinant: list[str], dependent: str) -> DataFrame:
    """Values of the determinant that go with more than one value of the dependent column."""
    return (
        df.select(*determinant, dependent)
        .distinct()
        .groupBy(*determinant)
        .agg(F.count(dependent).alias("values"))
        .where(F.col("values") > 1)
    )


def read_versions(parts: list[DataFrame], default_version: int = 1) -> DataFrame:
    """Documents of several schema versions as one frame; missing fields are NULL."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "schema_version" not in together.columns:
        return together.withColumn("schema_version", F.lit(default_version))
    return together.withColumn("schema_version", F.coalesce("schema_version", F.lit(default_version)))
