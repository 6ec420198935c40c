"""Readers of source files: JSON Lines, TSV, CSV, nested JSON, GTF, scoring files, SDF, XLSX and HTML columns.

Each returns a DataFrame over Spark's own readers, which split files, push filters and read gz transparently. Column
names lose a ``biolink:`` prefix as they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_SCHEME = "biolink:"


def plain_names(df: DataFrame) -> DataFrame:
    """Columns without the scheme before their names."""
    return df.withColumnsRenamed({c: c.removeprefix(KEY_SCHEME) for c in df.columns if c.startswith(KEY_SCHEME)})


def jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return plain_names(reader.json(path))


def tsv(spark: SparkSession, path: str, list_delimiter: str | None = None, scalar: tuple[str, ...] = (), header: bool = True) -> DataFrame:
    """Tab-separated text. With a delimiter, every column but the scalar ones becomes a list. Blank rows go."""
    df = plain_names(spark.read.option("sep", "\t").option("header", header).option("quote", "").csv(path))
    blank = F.lit(True)
    for c in df.columns:
        blank = blank & (F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) == "")
    df = df.where(~blank)
    return split_lists(df, list_delimiter, scalar) if list_delimiter else df


def split_lists(df: DataFrame, delimiter: str, scalar: tuple[str, ...] = ()) -> DataFrame:
    """String columns as lists, split at the delimiter; a null stays null."""
    quoted = "\\Q" + delimiter + "\\E"
    return df.withColumns({c: F.split(F.col(f"`{c}`"), quoted) for c, kind in df.dtypes if kind == "string" and c not in scalar})


def positional_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A TSV whose header is skipped and whose columns are named by position; a row of another width is an error."""
    text = spark.read.option("sep", "\t").option("header", True).option("mode", "FAILFAST").csv(path)
    if len(text.columns) != len(names):
        raise ValueError(f"{len(text.columns)} columns, not {len(names)}")
    return text.toDF(*names)


def csv(spark: SparkSession, path: str) -> DataFrame:
    return plain_names(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))


def mixed_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships of one file, told apart by their ``type``; their order in the file doesn't matter."""
    df = jsonl(spark, path, schema)
    return df.where("type = 'node'"), df.where("type = 'relationship'")


def nested_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document that is an array of records."""
    return spark.read.option("multiLine", True).json(path)


def by_suffix(spark: SparkSession, path: str, **options) -> DataFrame:
    plain = path.removesuffix(".gz")
    if plain.endswith(".tsv"):
        return tsv(spark, path, **options)
    if plain.endswith((".jsonl", ".jsonlines")):
        return jsonl(spark, path, **options)
    raise ValueError(f"no reader for {path}")


def gene_table(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start, end, gene_id, gene_name) of the protein-coding genes of a GTF file."""
    names = ["contig", "origin", "feature", "start", "end", "score", "strand", "frame", "attributes"]
    df = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").csv(path).toDF(*names)
    of = lambda key: F.regexp_extract("attributes", rf'{key} "([^"]*)"', 1)
    coding = (F.col("feature") == "gene") & (of("gene_biotype") == "protein_coding")
    return df.where(coding).select("contig", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), of("gene_id").alias("gene_id"), of("gene_name").alias("gene_name"))


def scoring_file(spark: SparkSession, path: str) -> DataFrame:
    """A scoring file: comments are skipped, the next line names the columns; gz is read as it is."""
    return spark.read.option("sep", "\t").option("comment", "#").option("header", True).csv(path)


def sdf_molecules(spark: SparkSession, path: str) -> DataFrame:
    """(properties) of each molecule of an SDF file, a map of its data items; records without any are dropped."""
    text = spark.read.option("lineSep", "$$$$").text(path)
    return text.select(sdf_properties("value").alias("properties")).where(F.size("properties") > 0)


def sdf_properties(c: str | Column) -> Column:
    """The data items of an SDF record: a line ``> <NAME>`` and the value up to a blank line; of a name that repeats, the first."""
    c = F.col(c) if isinstance(c, str) else c
    item = r"(?m)^>[^<\n]*<([^>\n]+)>[^\n]*\r?\n((?:[^\r\n]+\r?\n?)*)"
    names, values = F.regexp_extract_all(c, F.lit(item), F.lit(1)), F.regexp_extract_all(c, F.lit(item), F.lit(2))
    pairs = F.arrays_zip(names.alias("k"), F.transform(values, lambda v: F.regexp_replace(v, r"[\r\n]+$", "")).alias("v"))
    first = F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), (F.array_position(names, p["k"]) == i + 1).alias("is"))), lambda p: p["is"])
    return F.map_from_entries(F.transform(first, lambda p: F.struct(p["k"], p["v"])))


def spreadsheet(spark: SparkSession, path: str, sheet: str, columns: dict[int, str]) -> DataFrame:
    """Columns of a sheet by position, below its header. Needs openpyxl; sheets are small by their format's limit."""
    import openpyxl

    rows = openpyxl.load_workbook(path, read_only=True, data_only=True)[sheet].iter_rows(min_row=2, values_only=True)
    data = [tuple(None if i >= len(r) or r[i] is None else str(r[i]) for i in columns) for r in rows]
    return spark.createDataFrame(data, T.StructType([T.StructField(n, T.StringType()) for n in columns.values()]))


def ingest(spark: SparkSession, specs: list[dict]) -> DataFrame:
    """(id, name, synonyms, category) from several CSV files; each spec has path, id, name, synonyms and category."""
    out = None
    for s in specs:
        df = csv(spark, s["path"])
        part = df.select(F.col(s["id"]).alias("id"), F.col(s["name"]).alias("name"), F.array_compact(F.array(*[F.col(x) for x in s.get("synonyms", [])]).cast("array<string>")).alias("synonyms"), (s["category"] if isinstance(s["category"], Column) else F.lit(s["category"])).alias("category"))
        out = part if out is None else out.unionByName(part)
    return out


def html_title(c: str | Column) -> Column:
    return F.regexp_extract(F.col(c) if isinstance(c, str) else c, r"(?is)<title[^>]*>(.*?)</title>", 1)


def html_links(c: str | Column) -> Column:
    return F.regexp_extract_all(F.col(c) if isinstance(c, str) else c, F.lit(r'(?i)href="([^"]*)"'), F.lit(1))


def html_text(c: str | Column) -> Column:
    """Text without scripts, styles and tags."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def html_sections(c: str | Column, heading: str = "h2") -> Column:
    """(title, body) of each section under a heading of this level."""
    c = F.col(c) if isinstance(c, str) else c
    pattern = rf"(?is)<{heading}[^>]*>(.*?)</{heading}>(.*?)(?=<{heading}\b|$)"
    titles, bodies = F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.regexp_extract_all(c, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(titles.alias("t"), bodies.alias("b")), lambda s: F.struct(html_text(s["t"]).alias("title"), html_text(s["b"]).alias("body")))
