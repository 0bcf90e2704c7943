"""JSON documents.

:func:`read_documents` scans documents of a known layout. Where the documents themselves say
which arrays they have, :func:`keep_documents` parses them as text, writes a column per array and
reads off what was written which there are. Files with something that cannot be told from such
text are parsed once more, as variants.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlab.sources.tables import plain_path
from stintlab.staging import discard, new_path, settle

PATH_COLUMN = "full_file_uri"

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)
# How numbers that JSON has no spelling for come out of text; a text may be spelled the same.
_NOT_FINITE = ['"NaN"', '"Infinity"', '"-Infinity"']
# Rows to see some arrays' names in before all are read.
_FIRST_ROWS = 20
# Arrays hold few values twice; paths and which arrays there are repeat.
_WRITTEN = {
    "compression": "zstd",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#path": "true",
    "parquet.enable.dictionary#held": "true",
}


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = True,
    with_path: bool = False,
) -> DataFrame:
    """Documents under ``path`` (globs allowed).

    Give a ``schema`` (see :mod:`stintlab.schemas`) for anything large: without one
    Spark reads every file once more just to infer it. ``with_path`` adds the segments
    of the file's URI as an array column.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    docs = reader.json(path)
    if with_path:
        docs = docs.select("*", F.split(F.input_file_name(), "/").alias(PATH_COLUMN))
    return docs


@dataclass(frozen=True)
class KeptDocuments:
    """Documents as written: a column of text per array (``columns`` by name), the named single
    values as text, and their files' paths (``path``).

    ``names`` has the arrays that some document holds, in name order.
    """

    rows: DataFrame
    names: tuple[str, ...]
    columns: dict[str, str]

    def text_array(self, name: str) -> Column:
        """The array ``name``; NULL where a document has no array of that name."""
        return F.col(self.columns[name]) if name in self.columns else F.lit(None).cast(TEXTS)


def _variant_at(value: str, name: str) -> Column:
    """The field ``name`` of a variant that is an object."""
    if "'" in name and '"' in name:
        raise ValueError(f"a field's name has both kinds of quotes: {name}")
    return F.try_variant_get(value, f"$['{name}']" if '"' in name else f'$["{name}"]', "variant")


def _text_items(value: Column) -> Column:
    """The elements of a variant array as text, NULL if it is none.

    Whole numbers are spelled as they are, others as Spark spells a double: ``1.0`` stays
    apart from ``1``, while ``2.50`` is ``2.5``.
    """

    def text(item: Column) -> Column:
        fraction = F.schema_of_variant(item).startswith("D")  # DECIMAL or DOUBLE
        return F.when(fraction, item.cast("double").cast("string")).otherwise(item.cast("string"))

    plain = F.schema_of_variant(value).isin("ARRAY<BIGINT>", "ARRAY<STRING>")
    return F.when(plain, F.try_variant_get(value, "$", "array<string>")).otherwise(
        F.transform(F.try_variant_get(value, "$", "array<variant>"), text)
    )


def _named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _array_columns(names: Sequence[str]) -> dict[str, str]:
    """A column for each name; names may differ in case only."""
    return {name: f"array_{place}" for place, name in enumerate(names)}


@contextmanager
def _reading_texts(spark: SparkSession) -> Iterator[None]:
    """Numbers read as text are spelled as Spark spells them, in any file, and many columns are
    not made in one method that is too long for the JVM to compile."""
    changed = {
        "spark.sql.json.enableExactStringParsing": "false",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _as_variants(
    spark: SparkSession,
    path: str | list[str],
    inside: str | None,
    values: Sequence[str],
    names: Sequence[str] | None,
    multi_line: bool,
) -> KeptDocuments:
    """The documents by way of variants, whatever they hold."""
    reader = spark.read.option("multiLine", multi_line).option("singleVariantColumn", "doc")
    files = reader.json(path).select("doc", F.input_file_name().alias("path"))
    listed = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    docs = files.select("path", F.explode(listed).alias("doc"))
    if inside is not None:
        docs = docs.select("path", _variant_at("doc", inside).alias("doc"))
    fields = F.try_variant_get("doc", "$", "map<string, variant>")
    if names is not None:
        fields = F.map_filter(fields, lambda name, _: name.isin(*names))
    arrays = F.map_filter(
        F.transform_values(fields, lambda _, value: _text_items(value)),
        lambda _, items: items.isNotNull(),
    )
    single = [F.try_variant_get(_variant_at("doc", v), "$", "string").alias(v) for v in values]
    rows = settle(docs.select("path", *single, arrays.alias("arrays")))
    found = rows.select(F.explode(F.map_keys("arrays")).alias("name")).distinct()
    held = sorted(r["name"] for r in found.collect())
    columns = _array_columns(held)
    texts = [F.try_element_at("arrays", F.lit(name)).alias(c) for name, c in columns.items()]
    return KeptDocuments(rows.select("path", *values, *texts), tuple(held), columns)


def _written(
    docs: DataFrame, path: str, values: Sequence[str], columns: dict[str, str], bare_is_odd: bool
) -> tuple[DataFrame, tuple[str, ...], bool, bool]:
    """The documents written to ``path``, with the arrays that some hold, whether some are odd
    (with ``bare_is_odd`` also those without arrays), and whether some hold others."""
    marks = [F.col(c).isNotNull().cast("int").cast("string") for c in columns.values()]
    held = F.concat(*marks) if marks else F.lit("")
    rows = settle(
        docs.select("path", *values, *columns.values(), held.alias("held"), "odd", "others"),
        path,
        **_WRITTEN,
    )
    if bare_is_odd:
        rows = rows.withColumn("odd", F.col("odd") | ~F.col("held").contains("1"))
    seen = (
        rows.groupBy("held")
        .agg(F.max("odd").alias("odd"), F.max(F.col("others").isNotNull()).alias("others"))
        .agg(
            F.max("odd").alias("odd"),
            F.max("others").alias("others"),
            *[F.max(F.substring("held", i + 1, 1)).alias(c) for i, c in enumerate(columns.values())],
        )
        .first()
    )
    names = tuple(sorted(name for name, c in columns.items() if seen[c] == "1"))
    return rows, names, bool(seen["odd"]), bool(seen["others"])


def _root_arrays(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The arrays of documents that were read by name; odd are documents with texts that may
    stand for numbers that are not finite."""
    arrays = [_named(n).alias(c) for n, c in columns.items()]
    named = docs.select(F.input_file_name().alias("path"), *arrays)
    items = F.concat(*[F.coalesce(c, F.array().cast(TEXTS)) for c in columns.values()])
    unclear = F.coalesce(F.arrays_overlap(items, F.array(*map(F.lit, _NOT_FINITE))), F.lit(False))
    return named.select("*", unclear.alias("odd"), F.lit(None).cast(TEXTS).alias("others"))


def _inner_arrays(
    docs: DataFrame, values: Sequence[str], columns: dict[str, str], complete: bool
) -> DataFrame:
    """The values and arrays inside the text ``doc``, and the names of arrays that are not in
    ``columns``, NULL without any; not looked for if the columns are ``complete``. Odd are documents
    without the text."""
    layout = T.StructType(
        [T.StructField(v, TEXT) for v in values] + [T.StructField(n, TEXTS) for n in columns]
    )
    renamed = T.StructType(
        [T.StructField(v, TEXT) for v in values] + [T.StructField(c, TEXTS) for c in columns.values()]
    )
    known = F.array(*[F.lit(n) for n in [*values, *columns]]).cast(TEXTS)
    # Texts that begin like an array are taken in; what is none is in no document.
    listed = F.map_filter(F.from_json("doc", T.MapType(TEXT, TEXT)), lambda _, v: v.startswith("["))
    more = F.array_except(F.map_keys(listed), known)
    unknown = F.size(F.array_except(F.json_object_keys("doc"), known)) > 0
    others = F.lit(None).cast(TEXTS) if complete else F.when(unknown, F.when(F.size(more) > 0, more))
    return docs.select(
        "path", F.col("doc").isNull().alias("odd"),
        F.from_json("doc", layout).cast(renamed).alias("fields"), others.alias("others"),
    ).select("path", "fields.*", "odd", "others")


def keep_documents(
    spark: SparkSession,
    path: str | list[str],
    inside: str | None = None,
    values: Sequence[str] = (),
    names: Sequence[str] | None = None,
    multi_line: bool = True,
) -> KeptDocuments:
    """Parse the documents under ``path`` and write what they hold.

    ``inside`` names the field that holds arrays and values, ``values`` the single values to
    keep, ``names`` the arrays; by default all arrays are kept. A file may hold one document or an
    array of them. A document that is no JSON, or lacks the field, has no arrays.

    Files are parsed once, as text. Without ``names``, arrays are those that the first documents
    have; if others turn up, all is read again with these. Files in which a document has nothing, as where
    something that is no document spoils the file, are read again as variants.
    """
    wanted = list(dict.fromkeys(names or []))
    by_name = inside is None and len({n.lower() for n in wanted}) == len(wanted) > 0 and not values
    if inside is None and not by_name:
        return _as_variants(spark, path, inside, values, names, multi_line)

    layout = [T.StructField(n, TEXTS) for n in wanted] if by_name else [T.StructField(inside, TEXT)]
    reader = spark.read.option("multiLine", multi_line).schema(T.StructType(layout))
    files = reader.json(path)
    with _reading_texts(spark):
        if by_name:
            columns = _array_columns(wanted)
            docs = _root_arrays(files, columns)
            rows, held, any_odd, _ = _written(docs, new_path(spark), (), columns, True)
        else:
            docs = files.select(F.input_file_name().alias("path"), _named(inside).alias("doc"))
            if names is None:
                doc = F.try_variant_get(F.try_parse_json("doc"), "$", "map<string, variant>")
                arrays = F.map_filter(doc, lambda _, v: F.schema_of_variant(v).startswith("ARRAY"))
                first = docs.select(F.map_keys(arrays).alias("names")).limit(_FIRST_ROWS).collect()
                wanted = sorted({n for r in first for n in r["names"] or []})
            wanted = [n for n in wanted if n not in values]
            complete = names is not None
            while True:
                columns = _array_columns(wanted)
                parsed = _inner_arrays(docs, values, columns, complete)
                target = new_path(spark)
                rows, held, any_odd, more = _written(parsed, target, values, columns, False)
                if not more:
                    break
                found = rows.select(F.explode("others").alias("name")).distinct()
                wanted += sorted(r["name"] for r in found.collect())
                discard(spark, target)
    if not any_odd:
        return KeptDocuments(rows, held, columns)

    spoilt = rows.filter("odd").select("path").distinct()
    paths = [plain_path(r["path"]) for r in spoilt.collect()]
    again = _as_variants(spark, paths, inside, values, names, multi_line)
    both = sorted({*held, *again.names})
    merged = _array_columns(both)

    def same(kept: KeptDocuments) -> DataFrame:
        return kept.rows.select("path", *values, *[kept.text_array(n).alias(c) for n, c in merged.items()])

    fine = KeptDocuments(rows.join(spoilt, "path", "left_anti"), held, columns)
    return KeptDocuments(same(fine).unionByName(same(again)), tuple(both), merged)
