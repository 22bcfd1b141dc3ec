"""Delimited files, yearly files, lookups, polygons and stage tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import NULL_TOKENS
from ..operators.reshape import blanks_to_null, union_by_name, union_strict
from ..operators.spatial import reproject
from ..operators.species import clean_species

# The four yearly tables.
KINDS = ("i1", "i2", "i3", "i8")


# Quotes inside a quoted text are doubled.
STANDARD = {
    "header": True, "mode": "PERMISSIVE", "escape": '"', "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}


def _text_schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


Headers = dict[tuple[str, ...], list[str]]


def _first_lines(spark: SparkSession, path: str | Sequence[str], pattern: str, options: dict) -> list:
    """(file, first line) of every file that has one, in one job.

    Each file, or piece of a large one, is a partition of its own, so its first line is the row that opens
    a partition at the start of a file. A row per file comes to the driver.
    """
    conf, held = spark.conf, {}
    apart = {"spark.sql.files.openCostInBytes": conf.get("spark.sql.files.maxPartitionBytes"), "spark.sql.files.minPartitionNum": "1"}
    text = spark.read.option("pathGlobFilter", pattern)
    if "lineSep" in options:
        text = text.option("lineSep", options["lineSep"])
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = text.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), first.alias("n"), "value"
    )
    try:
        for key, value in apart.items():
            held[key] = conf.get(key, None)
            conf.set(key, value)
        return lines.filter("start = 0 and n = 0").select("file", "value").collect()
    finally:
        for key, value in held.items():
            conf.unset(key) if value is None else conf.set(key, value)


def find_headers(spark: SparkSession, path: str | Sequence[str], kinds: Sequence[str] = ("",), **options) -> dict[str, Headers]:
    """Files by header, for each kind: the files whose name holds it. Empty files are left out.

    Jobs do not grow with the files: one finds the first line of each, and of files that begin alike one is
    read by the reader itself. Only where the first line is not the whole header (blank, a quote left open,
    or comments are skipped) is a file asked for its own.
    """
    rows = _first_lines(spark, path, f"*{kinds[0]}*" if len(kinds) == 1 and kinds[0] else "*", options)
    unclear = "comment" in options
    names: dict[str, tuple[str, ...]] = {}
    out: dict[str, Headers] = {k: {} for k in kinds}
    for row in sorted(rows, key=lambda r: r["file"]):
        own = unclear or not row["value"].strip() or row["value"].count('"') % 2
        key = row["file"] if own else "\n" + row["value"]
        if key not in names:
            names[key] = tuple(spark.read.options(**{**STANDARD, **options}).csv(row["file"]).columns)
        for k in kinds:
            if k in row["file"].rsplit("/", 1)[-1]:
                out[k].setdefault(names[key], []).append(row["file"])
    return out


def _headers(spark: SparkSession, path: str | Sequence[str], kind: str = "", **options) -> Headers:
    return find_headers(spark, path, [kind], **options)[kind]


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    null_tokens: Iterable[str] = NULL_TOKENS,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Delimited text with a header, every column as text, NULL tokens as NULL.

    Files with different headers are read each by its own and stacked by column
    name. Short rows are padded, surplus cells are lost (see `malformed_rows`).
    Nothing is inferred: ids would lose digits. With ``columns`` the header is not
    read from the files. ``multi_line`` is for quoted texts with line breaks; a
    file is then read by one task, whatever its size.
    """
    options = {**STANDARD, "multiLine": multi_line, **options}

    def read(names: Sequence[str], files) -> DataFrame:
        return spark.read.options(**options).schema(_text_schema(names)).csv(files)

    if columns:
        return blanks_to_null(read(columns, path), list(null_tokens))
    groups = _headers(spark, path, **options)
    if not groups:
        raise ValueError(f"no files in {path}")
    return blanks_to_null(union_by_name(*(read(h, files) for h, files in groups.items())), list(null_tokens))


def read_yearly(
    spark: SparkSession, folder: str, kind: str, file_format: str = "csv", with_file: bool = False, multi_line: bool = False,
    headers: Headers | None = None,
) -> DataFrame:
    """All files of a folder whose name contains the kind, stacked by column name.

    The files must have the same columns, in any order. ``headers`` are those of the kind, if known.
    """
    named = [F.col("_metadata.file_name").alias("file_name")] if with_file else []

    def text(files: DataFrame) -> DataFrame:
        return files.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in files.columns], *named)

    if file_format != "csv":
        return blanks_to_null(text(spark.read.option("pathGlobFilter", f"*{kind}*").format(file_format).load(folder)))
    groups = _headers(spark, folder, kind, multiLine=multi_line) if headers is None else headers
    if not groups:
        raise ValueError(f"no files of kind {kind} in {folder}")
    first = next(iter(groups))
    for header, files in groups.items():
        if set(header) != set(first):
            odd = sorted(set(header) ^ set(first))
            raise ValueError(f"{files[0]} differs from {groups[first][0]} in columns {odd}")
    reader = spark.read.options(**STANDARD, multiLine=multi_line)
    return blanks_to_null(union_strict(*(text(reader.schema(_text_schema(h)).csv(f)) for h, f in groups.items())))


def malformed_rows(
    spark: SparkSession, path: str | Sequence[str], kind: str = "", headers: Headers | None = None, **options: str
) -> DataFrame:
    """(file_name, rows, malformed) per file: malformed rows have more or fewer cells than the header."""
    corrupt = "__corrupt"
    counts = []
    for header, files in (_headers(spark, path, kind, **options) if headers is None else headers).items():
        reader = spark.read.options(**{**STANDARD, **options, "columnNameOfCorruptRecord": corrupt})
        rows = reader.schema(f"{_text_schema(header)}, {corrupt} string").csv(files)
        # Every cell is looked at too: Spark refuses a scan of the corrupt column alone. No text is a lone NUL.
        bad = F.col(corrupt).isNotNull() | (F.concat_ws("", *[f"`{c}`" for c in header]) == "\x00")
        parsed = rows.select("_metadata.file_name", bad.alias("bad"))
        counts.append(parsed.groupBy("file_name").agg(F.count("*").alias("rows"), F.count_if("bad").alias("malformed")))
    return union_strict(*counts)


def read_species(spark: SparkSession, path: str) -> DataFrame:
    return clean_species(read_raw(spark, path, null_tokens=("",)))


def read_groups(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """The 0/1 matrix of species by group."""
    if file_format == "csv":
        return read_raw(spark, path, null_tokens=("",))
    return spark.read.format(file_format).load(path)


def read_polygons(
    spark: SparkSession, path: str, id_column: str = "NM_INDEX", projected: bool = False, file_format: str = "geojsonl"
) -> DataFrame:
    """(NM_INDEX, rings) of a polygon layer, in longitude and latitude.

    ``geojsonl`` holds one GeoJSON feature per line; ``parquet`` a table with
    ``rings``. ``projected`` layers are turned from the layer's projection. The
    rings of several parts go into one list, as the even-odd rule wants them, and
    end before the vertex they began with.
    """
    if file_format == "parquet":
        layer = spark.read.parquet(path).select(F.col(id_column).alias("NM_INDEX"), "rings")
    else:
        feature = (
            f"properties struct<`{id_column}`: string>, geometry struct<type: string, coordinates: string>"
        )
        parsed = spark.read.text(path).select(F.from_json("value", feature).alias("f")).filter("f.geometry is not null")
        one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
        many = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
        rings = F.when(F.col("f.geometry.type") == "Polygon", one).otherwise(many)

        def vertex(p):
            return F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))

        def open_ring(ring):
            closed = (F.size(ring) > 1) & (F.element_at(ring, -1) == F.get(ring, F.lit(0)))
            return F.when(closed, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)

        layer = parsed.select(
            F.col(f"f.properties.`{id_column}`").alias("NM_INDEX"),
            F.transform(rings, lambda ring: open_ring(F.transform(ring, vertex))).alias("rings"),
        )
    return reproject(layer) if projected else layer


def read_stage(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A stage table; text stages come back with empty as NULL."""
    return read_raw(spark, path, null_tokens=("",)) if file_format == "csv" else spark.read.parquet(path)
