"""Sources as DataFrames; text formats are parsed by Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.functions import dates as D
from stenoflow.functions import text as X

SEGMENT = T.StructType([
    T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("asr_text", T.StringType()),
    T.StructField("human_text", T.StringType()), T.StructField("cer", T.DoubleType()), T.StructField("start_idx", T.IntegerType()),
    T.StructField("end_idx", T.IntegerType()),
])
ALIGNMENT = T.StructType().add("audio_file", T.StringType()).add("audio_path", T.StringType()).add("segments", T.ArrayType(SEGMENT)).add("_corrupt_record", T.StringType())
BATCH_DOCUMENT = (
    "metadata struct<start_idx:int,end_idx:int,updated_at:string,transcript_count:int>, "
    "transcripts map<string,struct<content:struct<type:string,data:string,encoding:string>,added_at:string,url:string,metadata:map<string,string>>>"
)


def manifest(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Manifest rows as strings, blank cells as null; quoted cells may hold line ends."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    return df.select([F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in df.columns])


#: Kinds of cells as bits: whole numbers, other numbers, dates, true or false, and any other text.
LONG, DOUBLE, DATE, BOOL, STRING = 1, 2, 4, 8, 16
#: The type of a column whose cells are of these kinds and no others.
TYPES = {0: "string", LONG: "bigint", DOUBLE: "double", LONG | DOUBLE: "double", DATE: "date", BOOL: "boolean"}


def _kind(cell: Column) -> Column:
    """The narrowest kind that holds a cell; null for a null."""
    number = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|Inf|NaN|nan)$"
    whole = cell.rlike(r"^[+-]?\d+$") & cell.try_cast("bigint").isNotNull()
    return F.when(whole, LONG).when(cell.rlike(number), DOUBLE).when(
        cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull(), DATE).when(
        cell.isin("True", "False", "TRUE", "FALSE", "true", "false"), BOOL).when(cell.isNotNull(), STRING)


def inferred_types(df: DataFrame) -> dict[str, str]:
    """Types of columns of text, by one pass: the kinds of a column's cells are merged as bits, in any order."""
    kinds = df.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c: TYPES.get(kinds[i] or 0, "string") for i, c in enumerate(df.columns)}


def typed_manifest(spark: SparkSession, path: str, columns: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The manifest with inferred types: whole numbers, numbers, dates, true or false, else text.

    A column with cells of several kinds is text, but for numbers of both kinds; a column without cells is text;
    columns to keep stay text, such as ids with leading zeros.
    """
    df = manifest(spark, path, columns)
    types = inferred_types(df)
    return df.select([F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").cast(types[c]).alias(c) for c in df.columns])


def artefacts(spark: SparkSession, path: str, pattern: str = "*.opus") -> DataFrame:
    """(path, length, dir, stem, ext) of files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.split_part("path", F.lit("/"), F.lit(-1))
    return files.select(
        "path", "length", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
        F.regexp_extract(name, r"^(.*)\.[^.]*$", 1).alias("stem"), F.regexp_extract(name, r"\.([^.]*)$", 1).alias("ext"),
    )


def processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """(video_id) of the alignment documents in an output folder, by their whole names."""
    found = artefacts(spark, path, "*_aligned.json")
    return found.select(F.regexp_extract("stem", "^(.*)_aligned$", 1).alias("video_id")).distinct()


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of text or HTML files, one row each; an empty file has none."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def srt_cues(df: DataFrame, content: Column, *ids: str) -> DataFrame:
    """(ids, cue, start, end, text) of subtitle texts; blocks without a time line are dropped."""
    blocks = F.split(F.regexp_replace(content, "\r\n?", "\n"), r"\n{2,}")
    time = r"(\d+:\d{2}:\d{2}[,.]\d{1,3})\s*-->\s*(\d+:\d{2}:\d{2}[,.]\d{1,3})[^\n]*\n?"
    b = df.select(*ids, F.explode(blocks).alias("b")).where(F.col("b").rlike(time))
    return b.select(
        *ids, F.regexp_extract("b", r"^\s*(\d+)\s*\n", 1).try_cast("int").alias("cue"),
        D.srt_seconds(F.regexp_extract("b", time, 1)).alias("start"), D.srt_seconds(F.regexp_extract("b", time, 2)).alias("end"),
        X.collapse(X.strip_tags(F.regexp_extract("b", rf"(?s){time}(.*)$", 3))).alias("text"),
    )


def srt_last_end(content: Column) -> Column:
    """Last end time of a subtitle text in seconds, null without one."""
    return D.srt_seconds(F.try_element_at(F.regexp_extract_all(content, F.lit(r"-->\s*(\d+:\d{2}:\d{2}[,.]\d{1,3})"), F.lit(1)), F.lit(-1)))


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of alignment documents, tolerant of the name of the audio key and of broken files."""
    docs = spark.read.schema(ALIGNMENT).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    stem = F.regexp_extract("_metadata.file_name", r"^(.*?)(?:_aligned)?\.json$", 1)
    audio = F.coalesce("audio_file", "audio_path", stem)
    return docs.where("segments is not null").select(audio.alias("audio"), F.posexplode("segments").alias("seg_idx", "s")).select("audio", "seg_idx", "s.*")


def batch_documents(df: DataFrame, document: Column) -> DataFrame:
    """(transcript_id, content, raw, url) of batch documents; encoded bytes are decoded."""
    entries = df.select(F.explode(F.from_json(document, BATCH_DOCUMENT)["transcripts"]).alias("transcript_id", "e"))
    c = F.col("e.content")
    raw = F.when(c["type"] == "bytes", F.unbase64(c["data"]))
    return entries.select("transcript_id", F.when(c["type"] != "bytes", c["data"]).alias("content"), raw.alias("raw"), F.col("e.url").alias("url"))


def failed_urls(lines: DataFrame, line: Column) -> DataFrame:
    """Distinct links in two forms of failure message."""
    url = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in (r"Failed to process (\S+)", r"Error for url[: ]+(\S+)")])
    return lines.select(url.alias("url")).where("url is not null").distinct()


SESSION = "session string, sections array<struct<number:double,title:string,speeches:array<struct<time:string,clock:double,type:string,speaker:struct<name:string,party:string>,content:array<string>>>>>"


def session_speeches(df: DataFrame, document: Column) -> DataFrame:
    """Speeches of nested session documents; those without a speaker's name are dropped."""
    s = df.select(F.from_json(document, SESSION).alias("d")).select("d.session", F.explode("d.sections").alias("x"))
    p = s.select("session", F.col("x.number").alias("section"), F.col("x.title").alias("title"), F.posexplode("x.speeches").alias("pos", "p"))
    time = F.coalesce(F.date_format(F.try_to_timestamp(F.col("p.time")), "HH:mm"), D.decimal_clock(F.col("p.clock")))
    return p.where("p.speaker.name is not null").select(
        "session", "section", "title", "pos", time.alias("time"), F.col("p.type").alias("type"), F.col("p.speaker.name").alias("speaker"),
        F.coalesce("p.speaker.party", F.lit("")).alias("party"), F.array_join("p.content", "\n").alias("text"))


def last_of_day(df: DataFrame, day: str, time: str) -> DataFrame:
    """Rows in order of day and time, missing times first, with the last row of each day marked."""
    w = Window.partitionBy(day).orderBy(F.desc(F.coalesce(time, F.lit(""))))
    return df.withColumn("is_last", F.row_number().over(w) == 1).orderBy(day, F.coalesce(time, F.lit("")))
