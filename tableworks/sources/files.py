"""Reading and loading files: incremental, inferred, rescued, evolving."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


# ---- batch reads ----------------------------------------------------------

def read_any(spark: SparkSession, path: str | Sequence[str], fmt: str, schema: T.StructType | str | None = None,
             glob: str | None = None, **options: str) -> DataFrame:
    """json, csv (header on unless told otherwise), parquet, orc, text or binaryFile."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": "true", **options}
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**options).load(path if isinstance(path, str) else list(path))


def query_files(spark: SparkSession, path: str, fmt: str = "parquet", select: str = "*", where: str = "true") -> DataFrame:
    """SQL straight over a folder."""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}` WHERE {where}")


def with_file_metadata(df: DataFrame, out: str = "source_file") -> DataFrame:
    """The path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias(out))


def ingest_binary(spark: SparkSession, path: str, glob: str | None = None, label_regex: str | None = None,
                  content: bool = True, stream: bool = False, **options: str) -> DataFrame:
    """Binary files found recursively, with name and (by regex group 1) label from the path."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = (spark.readStream if stream else spark.read).format("binaryFile").schema(schema)
    reader = reader.option("recursiveFileLookup", "true").options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    files = files.withColumn("file_name", F.substring_index("path", "/", -1))
    if label_regex:
        files = files.withColumn("label", F.regexp_extract("path", label_regex, 1))
    return files if content else files.drop("content")


def parse_messages(df: DataFrame, example: str, epoch_columns: Sequence[str] = (), required: Sequence[str] = (),
                   value: str = "value") -> DataFrame:
    """Key/value bytes to typed columns, the schema taken from an example message.

    Works on batch and streaming input from any source with a ``value`` column.
    ``epoch_columns`` hold seconds and become timestamps.
    """
    spark = df.sparkSession
    shape = spark.range(1).select(F.schema_of_json(F.lit(example))).first()[0]
    out = df.select(F.from_json(F.col(value).cast("string"), shape).alias("m")).select("m.*")
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    return out.withColumns({c: F.timestamp_seconds(c) for c in epoch_columns}) if epoch_columns else out


# ---- schemas --------------------------------------------------------------

def save_schema(spark: SparkSession, schema: T.StructType, store: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(store)


def load_schema(spark: SparkSession, store: str) -> T.StructType | None:
    """The schema kept in a folder; None when there is none yet."""
    import json

    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.text(store).limit(1).collect()
    return T.StructType.fromJson(json.loads(rows[0].value)) if rows else None


def infer_schema(spark: SparkSession, path: str, fmt: str, hints: str | None = None, store: str | None = None,
                 **options: str) -> T.StructType:
    """Infer once, apply ``"col type, ..."`` hints, keep the result, reuse it next time."""
    if store and (known := load_schema(spark, store)) is not None:
        return known
    options = {"inferSchema": "true", **options}
    found = read_any(spark, path, fmt, **options).schema
    schema = apply_hints(found, hints)
    if store:
        save_schema(spark, schema, store)
    return schema


def apply_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    wanted = {f.name: f for f in T.StructType.fromDDL(hints)} if hints else {}
    fields = [wanted.pop(f.name, f) for f in schema]
    return T.StructType([*fields, *wanted.values()])


def evolve_schema(old: T.StructType, new: T.StructType, mode: str = "addNewColumns") -> tuple[T.StructType, bool]:
    """The schema to go on with, and whether it grew.

    ``addNewColumns`` appends unknown columns and unknown fields of structs,
    ``failOnNewColumns`` raises, ``rescue`` and ``none`` keep the old schema.
    """
    wider = _merged(old, new)
    if wider == old or mode in ("rescue", "none"):
        return old, False
    if mode == "failOnNewColumns":
        raise SchemaChanged(f"new columns: {unknown_fields(new, old).simpleString()}")
    if mode != "addNewColumns":
        raise ValueError(f"unknown mode {mode!r}")
    return wider, True


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the fields that only ``new`` has, at every level of structs; known fields keep their types."""
    found = {f.name.lower(): f for f in new}
    fields = []
    for f in old:
        other = found.pop(f.name.lower(), None)
        both = other is not None and isinstance(f.dataType, T.StructType) and isinstance(other.dataType, T.StructType)
        fields.append(T.StructField(f.name, _merged(f.dataType, other.dataType), f.nullable, f.metadata) if both else f)
    return T.StructType([*fields, *found.values()])


def unknown_fields(found: T.StructType, known: T.StructType) -> T.StructType:
    """What ``found`` has and ``known`` lacks; a known struct is there with its unknown fields only."""
    types = {f.name.lower(): f.dataType for f in known}
    fields = []
    for f in found:
        have = types.get(f.name.lower())
        if have is None:
            fields.append(f)
        elif isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType) and (inner := unknown_fields(f.dataType, have)).fields:
            fields.append(T.StructField(f.name, inner))
    return T.StructType(fields)


class SchemaChanged(RuntimeError):
    """Raised after the wider schema has been stored; the load is to be started again."""


# ---- rescue ---------------------------------------------------------------

def rescue_json(lines: DataFrame, schema: T.StructType, column: str = "value", keep_rescued: bool = True) -> DataFrame:
    """JSON lines to typed columns; what does not fit stays as JSON in ``_rescued_data``.

    A field lands there when the schema lacks it or its value does not convert;
    a line that is no JSON object lands there whole. Fields of structs are
    judged one by one and land under their path (``a.x``; a name with a dot is
    quoted by backticks), an array or map with a misfit inside lands there
    whole. Of a repeated name the first misfit stays. No row is lost. Works on
    streams too.
    """
    parsed = lines.withColumns({"_typed": F.from_json(column, schema), "_loose": F.from_json(column, _LOOSE)})
    found = misfits(F.col("_loose"), F.col("_typed"), schema)
    parsed = parsed.withColumn("_odd", found).withColumn("_keys", F.transform("_odd", lambda e: e["key"]))
    once = F.filter("_odd", lambda e, i: F.array_position("_keys", e["key"]) == i + 1)
    names = [f.name for f in schema]
    rescued = F.when(F.col("_loose").isNull(), F.to_json(F.create_map(F.lit("_raw"), F.col(column)))).when(
        F.size("_odd") > 0, F.to_json(F.map_from_entries(once)))
    others = [c for c in lines.columns if c != column]
    fields = [F.col("_typed").getField(n).alias(n) for n in names]
    return parsed.select(*fields, *([rescued.alias(RESCUED)] if keep_rescued else []), *others)


_LOOSE = "map<string,string>"


def misfits(loose: Column, typed: Column, schema: T.StructType, prefix: str = "") -> Column:
    """Array of (path, text) of what ``typed`` does not hold of the JSON object ``loose`` (name to text): known fields, then unknown ones."""
    names = F.array(*[F.lit(f.name) for f in schema]).cast("array<string>")
    quoted = lambda k: F.when(F.contains(k, F.lit(".")), F.concat(F.lit(f"{prefix}`"), k, F.lit("`"))).otherwise(F.concat(F.lit(prefix), k))
    unknown = F.filter(F.map_entries(loose), lambda e: e["value"].isNotNull() & ~F.array_contains(names, e["key"]))
    parts = []
    for f in schema:
        path = prefix + (f"`{f.name}`" if "." in f.name else f.name)
        text, value = F.element_at(loose, F.lit(f.name)), typed.getField(f.name)
        whole = F.array(F.struct(F.lit(path).alias("key"), text.alias("value")))
        if isinstance(f.dataType, T.StructType):
            inner = F.from_json(text, _LOOSE)
            odd = F.when(inner.isNotNull(), misfits(inner, value, f.dataType, f"{path}.")).when(text.isNotNull(), whole)
        else:
            odd = F.when(_misfit(text, value, f.dataType), whole)
        parts.append(odd)
    parts.append(F.transform(unknown, lambda e: F.struct(quoted(e["key"]).alias("key"), e["value"].alias("value"))))
    return F.concat(*[F.coalesce(p, F.array().cast("array<struct<key:string,value:string>>")) for p in parts])


def _misfit(text: Column, value: Column, kind: T.DataType) -> Column:
    """Whether the JSON value ``text`` lost something on its way to ``value``."""
    lost = text.isNotNull() & value.isNull()
    if isinstance(kind, T.StructType):
        inner = F.from_json(text, _LOOSE)
        return text.isNotNull() & (inner.isNull() | (F.size(misfits(inner, value, kind)) > 0))
    if isinstance(kind, T.ArrayType):
        pairs = F.zip_with(F.from_json(text, "array<string>"), value, lambda x, v: _misfit(x, v, kind.elementType))
        return lost | F.coalesce(F.exists(pairs, lambda odd: odd), F.lit(False))
    if isinstance(kind, T.MapType):
        texts = F.map_entries(F.from_json(text, _LOOSE))
        return lost | F.coalesce(F.exists(texts, lambda e: _misfit(e["value"], F.element_at(value, e["key"].cast(kind.keyType)), kind.valueType)), F.lit(False))
    return lost


def read_with_rescue(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """Batch read of json or csv that keeps every row (see ``rescue_json``)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fmt == "json":
        return rescue_json(spark.read.options(**options).text(path), schema)
    if fmt != "csv":
        raise ValueError("rescue works on json and csv")
    raw = spark.read.options(**{"header": "true", **options}).csv(path)
    out, odd = [], []
    for f in schema:
        text = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string")
        value = F.trim(text).try_cast(f.dataType) if not isinstance(f.dataType, T.StringType) else text
        out.append(value.alias(f.name))
        if f.name in raw.columns:
            odd.append(F.when(value.isNull() & text.isNotNull(), F.struct(F.lit(f.name).alias("key"), text.alias("value"))))
    known = {f.name for f in schema}
    for c in raw.columns:
        if c not in known:
            text = F.col(f"`{c}`")
            odd.append(F.when(text.isNotNull(), F.struct(F.lit(c).alias("key"), text.alias("value"))))
    entries = F.array_compact(F.array(*odd))
    return raw.select(*out, F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries))).alias(RESCUED))


# ---- incremental loads ----------------------------------------------------

def ingest_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, checkpoint: str, out: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None, partition_by: Sequence[str] = (),
                 max_files: int | None = None, **options: str) -> None:
    """Load the files not loaded before, exactly once, and stop.

    The file source remembers files in the checkpoint; the Parquet sink commits
    each micro-batch, so a rerun after a lost driver neither skips nor repeats.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path)
    stream = transform(stream) if transform else stream
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(out).awaitTermination()


def ingest_evolving(spark: SparkSession, path: str, store: str, checkpoint: str, out: str,
                    first_schema: T.StructType | str, mode: str = "addNewColumns", **options: str) -> None:
    """One run of a JSON load whose schema may grow.

    A micro-batch with unknown fields first stores the wider schema and then
    fails (before it writes), as the checkpoint must stay behind it; the next
    run reads the batch again with the new columns. Use ``run_until_stable``.
    """
    schema = load_schema(spark, store)
    if schema is None:
        schema = T.StructType.fromDDL(first_schema) if isinstance(first_schema, str) else first_schema
        save_schema(spark, schema, store)
    lines = spark.readStream.options(**options).text(path)

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # looked through for new fields, then parsed
        try:
            check_and_write(batch, batch_id)
        finally:
            batch.unpersist()

    def check_and_write(batch: DataFrame, batch_id: int) -> None:
        if mode in ("addNewColumns", "failOnNewColumns"):
            wider, grew = evolve_schema(schema, json_schema(batch, "value", schema), mode)
            if grew:
                save_schema(spark, wider, store)
                raise SchemaChanged("schema grew")
        rows = rescue_json(batch, schema, keep_rescued=mode != "none")
        # the folder is named by the batch, so a repeated batch replaces itself
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def json_schema(lines: DataFrame, column: str, known: T.StructType) -> T.StructType:
    """Fields, also those of structs, that occur in JSON lines but not in ``known``, found by one aggregate."""
    parsed = lines.select(F.try_parse_json(column).alias("v"))
    text = parsed.agg(F.schema_of_variant_agg("v")).first()[0]
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    ddl = text.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")
    found = T.StructType.fromDDL(f"r {ddl}")["r"].dataType
    return unknown_fields(_fractions_as_double(found), known)


def _fractions_as_double(kind: T.DataType) -> T.DataType:
    """Numbers with a fraction are read as double."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _fractions_as_double(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_fractions_as_double(kind.elementType))
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def run_until_stable(start: Callable[[], None], limit: int = 20, wait: float = 0.0) -> int:
    """Call a load again as long as it stops because its schema grew; returns the number of runs."""
    for attempt in range(1, limit + 1):
        try:
            start()
            return attempt
        except Exception as error:  # the stream wraps the cause
            if "SchemaChanged" not in str(error):
                raise
            time.sleep(wait)
    raise RuntimeError(f"schema still changing after {limit} runs")


def copy_into(spark: SparkSession, path: str, fmt: str, table: str, schema: T.StructType | str | None = None,
              glob: str | None = None, **options: str) -> int:
    """Load the files of a folder that this table has not loaded before.

    Loads are numbered folders and the list of loaded files is written after
    the data: a run that dies in between is done again into the same folder.
    File names, not data, pass through the driver. Returns the number of files.
    """
    log = f"{table}/_loaded"
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        there = there.option("pathGlobFilter", glob)
    files = there.load(path).select("path", "length").filter("length > 0").select("path")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(log)
    number = 0
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        done = spark.read.schema("path string, load int").parquet(f"{log}/*")
        number = done.agg(F.coalesce(F.max("load"), F.lit(-1))).first()[0] + 1
        files = files.join(done, "path", "left_anti")
    fresh = [r.path for r in files.collect()]
    if not fresh:
        return 0
    read_any(spark, fresh, fmt, schema, **options).write.mode("overwrite").parquet(f"{table}/load={number}")
    names = spark.createDataFrame([(p, number) for p in fresh], "path string, load int")
    names.write.mode("overwrite").parquet(f"{log}/load-{number}")
    return len(fresh)


def fan_out(tables: Iterable[str], job: Callable[[str], object], workers: int = 4) -> dict[str, object]:
    """The same job for every table, several Spark jobs at a time; the first error is raised."""
    names = list(tables)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(zip(names, pool.map(job, names)))


def foreach_batch_sink(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str,
                       mode: str = "append") -> None:
    """Run a batch function on every micro-batch of the data there is now."""
    (
        stream.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )
