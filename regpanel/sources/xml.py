"""Record-XML extraction.

The registry dumps are files of the form ``<root attrs><Doc .../>...</root>``
with values in attributes. A field is described by a path relative to the
document element, e.g. ``"@ДатаСост"`` or ``"СведМН/Регион/@Наим"``.

Every element level is declared as an *array* of structs, and every
attribute as a string. That one choice gives the reference's multi-valued
rule for any path: zero matches -> null, one -> the value, several ->
joined with ``,`` -- and an ill-typed attribute can never null a whole
document (types are applied afterwards with ``try_cast``). Parsing is
Spark's ``from_xml`` in PERMISSIVE mode: a malformed member lands in the
corrupt-record column and is quarantined; the rest goes on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _split(path: str) -> tuple[list[str], str]:
    parts = path.split("/")
    if not parts[-1].startswith("@"):
        raise ValueError(f"path must end with an attribute: {path}")
    return parts[:-1], "_" + parts[-1][1:]


def document_schema(paths: Sequence[str]) -> T.StructType:
    """Nested schema covering ``paths`` (elements as arrays, attributes as
    strings, attribute fields prefixed with ``_``)."""
    tree: dict = {}
    for p in paths:
        elems, attr = _split(p)
        node = tree
        for e in elems:
            node = node.setdefault(e, {})
        node[attr] = None

    def build(node: dict) -> T.StructType:
        fields = []
        for name, child in node.items():
            if child is None:
                fields.append(T.StructField(name, T.StringType(), True))
            else:
                fields.append(T.StructField(name, T.ArrayType(build(child), True), True))
        return T.StructType(fields)

    return build(tree)


def file_schema(paths: Sequence[str], doc_tag: str,
                root_attrs: Sequence[str] = ()) -> T.StructType:
    """Schema of a whole file: root attributes, the repeated document
    element and the corrupt-record column."""
    fields = [T.StructField("_" + a, T.StringType(), True) for a in root_attrs]
    fields.append(T.StructField(doc_tag, T.ArrayType(document_schema(paths)), True))
    fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def path_values(doc: Column, path: str) -> Column:
    """All values of ``path`` inside one parsed document, as an array; a missing attribute is a null in it, and an
    array without elements may be null. (Fields of an array of structs are read without a lambda, which would run uncompiled.)"""
    elems, attr = _split(path)
    if not elems:
        return F.array(doc[attr])
    level = doc[elems[0]]
    for e in elems[1:]:
        level = F.flatten(level[e])
    return level[attr]


def _joined(values: Column) -> Column:
    """``flatten_multi`` of values that may be null: no value -> null, one -> it, several -> joined."""
    return F.when(F.array_max(values).isNotNull(), F.array_join(values, ","))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Parsing is CPU-bound: when a *plain file scan* has fewer partitions
    than the cluster has cores (a few large files), spread it round-robin.
    With enough input partitions -- the normal case at scale -- nothing
    changes. Only call this on a scan: on a plan with a shuffle, counting
    partitions under AQE would run the shuffle stages eagerly."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def parse_files(files: DataFrame, elements: Mapping[str, str], xml_col: str = "xml",
                doc_tag: str = "Документ", root_attrs: Mapping[str, str] | None = None,
                keep: Sequence[str] = ("member",),
                min_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """S2 + P1 + P2 + S5: XML file strings -> (documents, quarantine).

    ``elements`` maps a path to an output column (column order = map
    order). ``root_attrs`` maps root attribute -> provenance column.
    Documents: one row per document element with ``keep`` columns first.
    Quarantine: ``keep`` columns + the corrupt text of unparseable files.
    """
    root_attrs = dict(root_attrs or {})
    schema = file_schema(list(elements), doc_tag, list(root_attrs))
    if min_partitions:
        files = ensure_parallelism(files, min_partitions)
    parsed = files.select(*keep, F.from_xml(
        F.col(xml_col), schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_f"))
    # Quarantine: a parse with the corrupt-record column only (the parser
    # still reads every member to its end, so malformed = corrupt, but
    # builds no nested values).
    check = files.select(*keep, F.from_xml(
        F.col(xml_col), T.StructType([T.StructField(CORRUPT, T.StringType(), True)]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_c"))
    bad = (check.select(*keep, F.explode_outer(F.array(F.col(f"_c.{CORRUPT}"))).alias(CORRUPT))
                .filter(F.col(CORRUPT).isNotNull()))
    # Parse once: a filter on the parsed struct (or the one Spark infers for
    # ``explode``) would be pushed below the projection and re-run from_xml.
    # ``explode_outer`` infers nothing, and the filter on its output stays
    # above the Generate. Corrupt files have no documents, so they drop out.
    docs = (parsed.select(*keep, *[F.col(f"_f._{a}").alias(c) for a, c in root_attrs.items()],
                          F.explode_outer(F.col(f"_f.{doc_tag}")).alias("_d"))
                  .filter(F.col("_d").isNotNull()))
    d = F.col("_d")
    cols = [_joined(path_values(d, p)).alias(name) for p, name in elements.items()]
    out = docs.select(*keep, *cols, *root_attrs.values())
    return out, bad


def parse_files_once(files: DataFrame, elements: Mapping[str, str], xml_col: str = "xml",
                     doc_tag: str = "Документ", root_attrs: Mapping[str, str] | None = None,
                     keep: Sequence[str] = ("member",)) -> DataFrame:
    """S2 + S5 in one pass: documents *and* quarantined members in one frame,
    told apart by ``_status`` (``ok`` / ``quarantine``); quarantine rows
    carry the text in ``_corrupt_record`` and nulls elsewhere. Writing it
    once (partitioned by ``_status``) parses every member exactly once."""
    root_attrs = dict(root_attrs or {})
    schema = file_schema(list(elements), doc_tag, list(root_attrs))
    parsed = files.select(*keep, F.from_xml(
        F.col(xml_col), schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_f"))
    rows = parsed.select(*keep, F.col(f"_f.{CORRUPT}").alias(CORRUPT),
                         *[F.col(f"_f._{a}").alias(c) for a, c in root_attrs.items()],
                         F.explode_outer(F.col(f"_f.{doc_tag}")).alias("_d"))
    # A valid member without documents yields one empty row: drop it.
    rows = rows.filter(F.col("_d").isNotNull() | F.col(CORRUPT).isNotNull())
    d = F.col("_d")
    cols = [_joined(path_values(d, p)).alias(name) for p, name in elements.items()]
    status = F.when(F.col(CORRUPT).isNotNull(), F.lit("quarantine")).otherwise(F.lit("ok"))
    return rows.select(*keep, *cols, *root_attrs.values(), CORRUPT, status.alias("_status"))


def apply_types(df: DataFrame, schema: T.StructType,
                date_format: str | None = "dd.MM.yyyy",
                keep: Sequence[str] = ()) -> DataFrame:
    """Cast string columns to ``schema`` (``try_cast``; dates by format):
    a bad value becomes null instead of failing the task. ``keep`` columns
    (e.g. provenance) are passed through in front."""
    cols = [F.col(c) for c in keep]
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DateType) and date_format:
            cols.append(F.try_to_timestamp(F.col(f.name), F.lit(date_format))
                        .cast("date").alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_xml_documents(spark, path: str, row_tag: str, schema: T.StructType | None = None,
                       **options) -> DataFrame:
    """Spark's XML file source, one row per ``row_tag`` element
    (pass an explicit schema, or that of ``infer_xml_schema``: plain inference turns codes like ``01.10`` into
    doubles). Attributes come back as ``_name`` fields."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


#: Numbers whose text a double gives back: no leading zero, no trailing zero after the point, 15 digits.
_PLAIN = r"^-?(?=(\d\.?){1,15}$)(0|[1-9]\d*)(\.\d*[1-9])?$"
_WHOLE, _FIXED = r"^-?(0|[1-9]\d*)$", r"^-?(0|[1-9]\d*)\.\d+$"
#: The bit of the decimal of scale 0 among those of the types that keep a text.
_SCALES = 16
#: Texts of values that Spark's own formats give back.
_SHAPES = {T.BooleanType: "^(true|false)$", T.DateType: r"^\d{4}-\d\d-\d\d$", T.TimestampType: r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?$"}


def _leaves(kind: T.DataType, path: tuple[str, ...] = ()):
    """Paths and types of the values of a nested schema; arrays add no step."""
    if isinstance(kind, T.ArrayType):
        yield from _leaves(kind.elementType, path)
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _leaves(f.dataType, (*path, f.name))
    else:
        yield path, kind


def _retyped(kind: T.DataType, types: Mapping[tuple[str, ...], T.DataType], path: tuple[str, ...] = ()) -> T.DataType:
    """``kind`` with its values' types replaced by path."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_retyped(kind.elementType, types, path), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _retyped(f.dataType, types, (*path, f.name)), True) for f in kind.fields])
    return types[path]


def _values(kind: T.DataType, path: tuple[str, ...]) -> tuple[Column, bool]:
    """The value of a path as a string, or all its values as an array where an array lies on the path (True then)."""
    def field(name):
        return lambda x: x[name]

    at, many = F.col(f"`{path[0]}`"), False
    kind = next(f.dataType for f in kind.fields if f.name == path[0])
    for name in (*path[1:], None):
        if isinstance(kind, T.ArrayType):
            at, kind, many = F.flatten(F.filter(at, lambda x: x.isNotNull())) if many else at, kind.elementType, True
        if name is not None:
            at = F.transform(at, field(name)) if many else at[name]
            kind = next(f.dataType for f in kind.fields if f.name == name)
    return (F.filter(at, lambda x: x.isNotNull()), True) if many else (at, False)


def _on_path(i: int):
    def labelled(v: Column) -> Column:
        return F.struct(F.lit(i).alias("path"), v.alias("text"))

    return labelled


def infer_xml_schema(spark, path: str, row_tag: str, sampling_ratio: float = 1.0, **options) -> T.StructType:
    """The schema of an XML folder, inferred from (a sample of) its rows and then corrected over all of them.

    Inference reads a code like ``01.10`` as the number 1.1. Here every value is looked at as text, in one aggregate
    over the whole folder (with options, every value of what Spark guesses to be no text): numbers stay
    whole or double if their type gives their text back; numbers that all have the same count of decimals become
    decimals of that scale, which also keep it; dates and booleans stay if their type's text is theirs;
    anything else is text. Attributes that no sampled row has are missing: the default reads all.
    """
    def reader():
        made = spark.read.format("xml").option("rowTag", row_tag)
        for k, v in options.items():
            made = made.option(k, v)
        return made

    # Guessing a type tries every parser on every value; with the formats that Spark has by itself, the aggregate below
    # tells types by the texts alone, and inference gives the nesting. Formats of the caller's need the guess.
    typed = "true" if options else "false"
    guessed = reader().option("inferSchema", typed).option("samplingRatio", str(sampling_ratio)).load(path).schema
    types = {p: (T.StringType() if isinstance(t, T.NullType) else t) for p, t in _leaves(guessed)}
    as_text = _retyped(guessed, {p: T.StringType() for p in types})
    doubtful = [(p, t) for p, t in types.items() if not (options and isinstance(t, T.StringType))]
    if not doubtful:
        return as_text
    # What the texts are held against, apart from numbers: the types there can be.
    others = list(dict.fromkeys(t for _, t in doubtful if not isinstance(t, T.NumericType))) if options else [T.BooleanType(), T.DateType(), T.TimestampType()]

    def given_back(v: Column, kind: T.DataType) -> Column:
        shape, same = _SHAPES.get(type(kind)), F.coalesce(v.try_cast(kind).cast("string") == v, F.lit(False))
        return same if options or not shape else v.rlike(shape) & same

    def bits(n: int) -> Column:
        return F.lit(n).cast("long")

    def fits(v: Column) -> Column:
        """The types that keep a text, as bits: whole, plain, then ``others`` in turn, and from ``_SCALES`` on the decimals by scale."""
        places = F.length(v) - F.instr(v, ".")
        plain = F.when(v.rlike(_PLAIN), bits(2)).otherwise(bits(0))
        whole = F.when(v.try_cast("long").isNotNull(), bits(1)).otherwise(bits(0))
        scaled = F.when((F.length(v) <= 30) & (places <= 18), F.call_function("shiftleft", bits(1), places + _SCALES)).otherwise(bits(0))
        found = F.when(v == "-0", bits(0)).when(v.rlike(_WHOLE), whole.bitwiseOR(plain)).when(v.rlike(_FIXED), scaled.bitwiseOR(plain))
        for j, t in enumerate(others):
            found = found.when(given_back(v, t), bits(4 << j))
        return found.otherwise(bits(0))

    # One row per value: the test is compiled once, however many paths there are.
    single, arrays = [], []
    for i, (p, _) in enumerate(doubtful):
        values, many = _values(as_text, p)
        if many:
            arrays.append(F.transform(F.coalesce(values, F.array().cast("array<string>")), _on_path(i)))
        else:
            single.append(_on_path(i)(values))
    values = reader().schema(as_text).load(path).select(F.explode(F.concat(*([F.array(*single)] if single else []), *arrays)).alias("v")).select("v.*")
    kept = dict(values.where(F.col("text").isNotNull()).groupBy("path").agg(F.bit_and(fits(F.col("text")))).collect())
    for i, (p, t) in enumerate(doubtful):
        # Where no row has a value: text, unless a type was guessed from something.
        found, types[p] = kept.get(i, -1 if options else 0), T.StringType()
        if not options or isinstance(t, T.NumericType):
            if found & 1:
                types[p] = T.LongType()
            elif found >> _SCALES:
                types[p] = T.DecimalType(38, (found >> _SCALES).bit_length() - 1)
            elif found & 2:
                types[p] = T.DoubleType()
        for j, other in enumerate(others):
            if found & 4 << j and (not options or other == t):
                types[p] = other
    return _retyped(guessed, types)


def write_xml_files(docs: DataFrame, out_dir: str, num_files: int, root_tag: str = "Файл",
                    doc_col: str = "doc", prefix: str = "part") -> DataFrame:
    """Write document-element strings as ``num_files`` XML files (one root
    element per file, one file per task) to ``out_dir`` on shared storage (any store that the archive scan reads).
    Returns ``file, docs`` (an action runs when the result is consumed)."""
    import pyarrow as pa

    from .archive import created

    def write(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        target = f"{out_dir}/{prefix}-{task.partitionId():05d}.xml"
        n = 0
        with created(target, task.taskAttemptId()) as out:
            out.write(f'<?xml version="1.0" encoding="utf-8"?>\n<{root_tag} КолДок="0">'.encode())
            for batch in batches:
                out.writelines(x.encode() for x in batch.column(0).to_pylist())
                n += batch.num_rows
            out.write(f"</{root_tag}>\n".encode())
        yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], ["file", "docs"])

    return docs.select(doc_col).repartition(num_files).mapInArrow(write, "file string, docs long")
