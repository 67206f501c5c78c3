"""Nested documents as rows: leaves by JSON pointer and back, to any depth; a catalogue of the types that occur; short display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import cut_lineage

#: Levels of nesting that are one plan.
STEP = 6

#: Types of JSON values from bit 0 on; a whole number and a fraction together are numbers.
TYPES = ("null", "boolean", "integer", "number", "string", "object", "array")


def flatten(docs: DataFrame, keys: list[str], column: str, step: int = STEP) -> DataFrame:
    """(keys, pointer, kinds, json) of the leaves of JSON text: scalars and empty objects and arrays, as JSON text.

    ``kinds`` has a letter for each part of the pointer, o for an object's key and a for an array's place, so that a key
    "0" and place 0 stay apart. Text that is no JSON, or null, is a row without a pointer. Levels are taken ``step`` at
    a time until nothing nests.
    """
    spark, root = docs.sparkSession, F.try_parse_json(column)
    at = docs.select(*keys, F.when(root.isNotNull(), F.lit("")).alias("pointer"), F.when(root.isNotNull(), F.lit("")).alias("kinds"), root.alias("_v"))
    leaves = None
    while True:
        for _ in range(step):
            part = spark.tvf.variant_explode_outer(F.col("_v").outer()).toDF("_pos", "_key", "_part")
            escaped = F.replace(F.replace("_key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
            deeper = F.concat("pointer", F.lit("/"), F.coalesce(escaped, F.col("_pos").cast("string")))
            kind = F.concat("kinds", F.when(F.col("_key").isNotNull(), "o").when(F.col("_pos").isNotNull(), "a"))
            at = at.lateralJoin(part).select(*keys, F.coalesce(deeper, "pointer").alias("pointer"), F.coalesce(kind, "kinds").alias("kinds"), F.coalesce("_part", "_v").alias("_v"))
        text = at.select(*keys, "pointer", "kinds", F.to_json("_v").alias("json"))
        done = cut_lineage(text.withColumn("nests", F.coalesce(F.col("json").rlike(r"^[\[{]") & ~F.col("json").isin("{}", "[]"), F.lit(False))))
        own = done.where("not nests").drop("nests")
        leaves = own if leaves is None else leaves.unionByName(own)
        if done.where("nests").isEmpty():
            return leaves
        at = done.where("nests").select(*keys, "pointer", "kinds", F.parse_json("json").alias("_v"))


def _quoted(key: Column) -> Column:
    listed = F.to_json(F.array(key))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def unflatten(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, doc): the JSON text of each document from its ``leaves`` (keys, pointer, kinds, json), objects' keys in order.

    Containers are put together from the deepest level up; rows of other levels pass. Rows without a pointer give no
    document. Each level is one exchange of its members, and ``STEP`` levels are one plan.
    """
    at = leaves.where("pointer is not null").select(*keys, "pointer", "kinds", "json")
    depth = at.agg(F.max(F.length("kinds"))).first()[0] or 0
    for level in range(depth, 0, -1):
        deepest = at.where(F.length("kinds") == level)
        parent = F.expr("substring(pointer, 1, length(pointer) - length(substring_index(pointer, '/', -1)) - 1)")
        name = F.substring_index("pointer", "/", -1)
        key = F.replace(F.replace(name, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))
        listed = F.col("kinds").endswith("a")
        member = F.struct(F.when(listed, name.cast("int")).alias("place"), key.alias("key"), F.when(listed, F.col("json")).otherwise(F.concat(_quoted(key), F.lit(":"), "json")).alias("text"))
        made = deepest.select(*keys, parent.alias("pointer"), F.expr(f"substring(kinds, 1, {level - 1})").alias("kinds"), listed.alias("listed"), F.when(listed, member).otherwise(member).alias("member"))
        joined = F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda m: m["text"]), ",")
        whole = made.groupBy(*keys, "pointer", "kinds", "listed").agg(joined.alias("inner"))
        text = F.when(F.col("listed"), F.concat(F.lit("["), "inner", F.lit("]"))).otherwise(F.concat(F.lit("{"), "inner", F.lit("}")))
        at = at.where(F.length("kinds") < level).unionByName(whole.select(*keys, "pointer", "kinds", text.alias("json")))
        if (depth - level + 1) % STEP == 0:
            at = cut_lineage(at)
    return at.select(*keys, F.col("json").alias("doc"))


def type_bit(json: Column) -> Column:
    """The bit of the type of a JSON value."""
    head = F.substring(json, 1, 1)
    which = (
        F.when(head == '"', "string").when(head == "{", "object").when(head == "[", "array").when(head.isin("t", "f"), "boolean").when(head == "n", "null")
        .when(json.rlike("[.eE]"), "number").otherwise("integer")
    )
    return F.element_at(F.array(*[F.lit(1 << i) for i in range(len(TYPES))]), F.array_position(F.array(*map(F.lit, TYPES)), which).cast("int"))


def type_names(bits: Column) -> Column:
    """The types of a set of bits, joined by |; integer goes into number."""
    both = bits.bitwiseAND(F.lit(12)) == 12
    names = [F.when((bits.bitwiseAND(F.lit(1 << i)) > 0) & ~(both & F.lit(t == "integer")), t) for i, t in enumerate(TYPES)]
    return F.concat_ws("|", *names)


def schema_catalogue(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """(pattern, types, n_values, n_docs) of each place in documents, array places as *.

    Types are bits that are or-ed, so partial catalogues merge in any order.
    """
    place = F.array_join(F.transform(F.split("pointer", "/"), lambda s, i: F.when(F.substring("kinds", i, F.lit(1)) == "a", "*").otherwise(s)), "/")
    per_doc = leaves.where("pointer is not null").groupBy(place.alias("pattern"), *keys).agg(F.bit_or(type_bit(F.col("json"))).alias("bits"), F.count("*").alias("n"))
    return per_doc.groupBy("pattern").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n_values"), F.count("*").alias("n_docs")).select("pattern", type_names(F.col("bits")).alias("types"), "n_values", "n_docs")


def short(text: Column, most: int = 300) -> Column:
    """Text for display: at most ``most`` characters, an ellipsis for what is left out."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)
