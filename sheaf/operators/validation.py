"""Validation of JSON documents against a schema, with every fault and its path.

Documents are VARIANT values, so their trees may be of any depth. The schema is
compiled to a table with a row for each of its places; a level of the documents
meets it in a broadcast join (a schema is small), gives its faults, and hands
its children to the next level. Children are checkpointed, so that every level
is computed once, and levels go on until no value is left.
"""

from __future__ import annotations

import json
import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "rule string, types array<string>, required array<string>, properties map<string,string>, closed boolean, additional string, items string, choices array<string>, pattern string, min_length int, least double, min_items int"


def compiled(schema: dict) -> list[tuple]:
    """A row for each place of a schema that a value can be held against; references may be recursive.

    Known: type, required, properties, additionalProperties, items, enum, const,
    pattern, minLength, minimum, minItems, $ref to a place in the same schema.
    """
    rows, todo, done = [], ["#"], set()

    def at(pointer: str) -> tuple[str, dict]:
        """The place that a pointer means, references followed."""
        seen = set()
        while True:
            own = reduce(lambda node, part: node[part.replace("~1", "/").replace("~0", "~")], pointer.split("/")[1:], schema)
            if not isinstance(own, dict) or "$ref" not in own or pointer in seen:
                return pointer, own if isinstance(own, dict) else {}
            seen.add(pointer)
            pointer = own["$ref"]

    def child(pointer: str) -> str:
        todo.append(pointer)
        return at(pointer)[0]

    while todo:
        pointer, own = at(todo.pop())
        if pointer in done:
            continue
        done.add(pointer)
        types = own.get("type")
        names = {name: child(f"{pointer}/properties/{name.replace('~', '~0').replace('/', '~1')}") for name in own.get("properties", {})}
        more = own.get("additionalProperties", True)
        choices = [own["const"]] if "const" in own else own.get("enum")
        rows.append((
            pointer,
            None if types is None else [types] if isinstance(types, str) else list(types),
            list(own.get("required", [])),
            names,
            more is False,
            child(f"{pointer}/additionalProperties") if isinstance(more, dict) else None,
            child(f"{pointer}/items") if isinstance(own.get("items"), dict) else None,
            None if choices is None else [json.dumps(c, ensure_ascii=False, separators=(",", ":")) for c in choices],
            own.get("pattern"),
            own.get("minLength"),
            None if own.get("minimum") is None else float(own["minimum"]),
            own.get("minItems"),
        ))
    return rows


def _kind(value: Column) -> Column:
    """The JSON type of a variant; a whole number is an integer."""
    name = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (name == "VOID"), "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "BIGINT", "integer")
        .when(F.try_variant_get(value, "$", "double") == F.floor(F.try_variant_get(value, "$", "double")), "integer")
        .otherwise("number")
    )


def _level(values: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(faults, children) of values (doc_id, path, rule, value)."""
    held = values.join(F.broadcast(rules), "rule").withColumn("_kind", _kind(F.col("value")))
    text = F.to_json("value")
    keys = F.when(F.col("_kind") == "object", F.json_object_keys(text))
    held = held.withColumns({"_keys": keys, "_text": F.when(F.col("_kind") == "string", F.try_variant_get("value", "$", "string"))})
    number = F.try_variant_get("value", "$", "double")
    wrong = F.col("types").isNotNull() & ~(F.array_contains("types", F.col("_kind")) | ((F.col("_kind") == "integer") & F.array_contains("types", "number")))

    def fault(test: Column, code: str, detail: Column) -> Column:
        return F.when(test, F.array(F.struct(F.lit(code).alias("code"), detail.alias("detail"))))

    def each(names: Column, code: str) -> Column:
        return F.transform(names, lambda n: F.struct(F.lit(code).alias("code"), n.alias("detail")))

    known = F.map_keys("properties")
    size = F.size(F.try_variant_get("value", "$", "array<variant>"))
    faults = [
        fault(wrong, "type", F.concat(F.array_join("types", "|"), F.lit(", not "), F.col("_kind"))),
        F.when(F.col("_kind") == "object", each(F.array_except("required", "_keys"), "missing")),
        F.when((F.col("_kind") == "object") & F.col("closed"), each(F.array_except("_keys", known), "extra")),
        fault(F.col("choices").isNotNull() & ~F.array_contains("choices", text), "choice", text),
        fault(F.col("_text").isNotNull() & F.col("pattern").isNotNull() & ~F.expr("_text rlike pattern"), "pattern", F.col("_text")),
        fault(F.length("_text") < F.col("min_length"), "short", F.col("_text")),
        fault(F.col("_kind").isin("integer", "number") & (number < F.col("least")), "small", text),
        fault((F.col("_kind") == "array") & (size < F.col("min_items")), "few", size.cast("string")),
    ]
    every = F.flatten(F.array(*(F.coalesce(f, F.array().cast("array<struct<code:string,detail:string>>")) for f in faults)))
    found = held.select("doc_id", "path", F.explode(every).alias("f")).select("doc_id", "path", "f.*")
    inner = held.filter(F.col("_kind").isin("object", "array")).select("doc_id", "path", "properties", "closed", "additional", "items", "value")
    spread = values.sparkSession.sql("SELECT d.doc_id, d.path, d.properties, d.additional, d.items, c.pos, c.key, c.value FROM {d} AS d, LATERAL variant_explode(d.value) AS c", d=inner)
    rule = F.when(F.col("key").isNull(), F.col("items")).otherwise(F.coalesce(F.try_element_at("properties", "key"), "additional"))
    step = F.coalesce("key", F.col("pos").cast("string"))
    children = spread.select("doc_id", F.concat_ws("/", F.nullif("path", F.lit("")), step).alias("path"), rule.alias("rule"), "value").filter("rule IS NOT NULL")
    return found, children


def _checkpointed(df: DataFrame) -> DataFrame:
    spark: SparkSession = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        if found := spark.conf.get("spark.checkpoint.dir", None):
            spark.sparkContext.setCheckpointDir(found)
        elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="sheaf-"))
        else:
            raise ValueError("spark.checkpoint.dir must name a shared folder")
    return df.checkpoint()


def schema_faults(documents: DataFrame, schema: dict, column: str = "json") -> DataFrame:
    """doc_id, path, code and detail of every fault of JSON texts; valid documents have none.

    Paths are names and array positions joined by ``/``, empty for the whole
    document. Codes: json (no JSON, or nested too deep to read), type, missing,
    extra, choice, pattern, short, small, few. A null text is no JSON.
    """
    spark = documents.sparkSession
    rules = spark.createDataFrame(compiled(schema), RULE)
    top = rules.first()["rule"]
    parsed = documents.select("doc_id", F.try_parse_json(F.col(column)).alias("value"))
    faults = [parsed.filter("value IS NULL").select("doc_id", F.lit("").alias("path"), F.lit("json").alias("code"), F.lit(None).cast("string").alias("detail"))]
    values = parsed.filter("value IS NOT NULL").select("doc_id", F.lit("").alias("path"), F.lit(top).alias("rule"), "value")
    while True:
        found, children = _level(values, rules)
        faults.append(found)
        values = _checkpointed(children)
        if values.isEmpty():
            return reduce(DataFrame.unionByName, faults)
