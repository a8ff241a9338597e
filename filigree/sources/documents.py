"""JSON and HTML sources: chunk and entity files, company listings, filing indexes, and HTML as markdown."""

from __future__ import annotations

import html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_FILE = (
    "accession_number string, ticker string, company_name string, filing_date string, form_type string, total_chunks int, total_tokens int, "
    "chunks array<struct<chunk_id:string,accession_number:string,section_item:string,section_title:string,chunk_index:int,context_prefix:string,text:string,token_count:int,contains_table:boolean>>"
)
_ENTITY = "array<struct<type:string,text:string,start:int,end:int>>"
ENTITY_FILE = (
    "accession_number string, ticker string, company_name string, filing_date string, total_sections int, "
    f"sections array<struct<section_type:string,total_entities:int,entities_by_type:map<string,{_ENTITY}>,raw_entities:{_ENTITY}>>"
)
LISTING = (
    "cik string, name string, tickers array<string>, sic string, sicDescription string, stateOfIncorporation string, fiscalYearEnd string, category string, ein string, "
    "filings struct<recent:struct<accessionNumber:array<string>,form:array<string>,filingDate:array<string>,reportDate:array<string>,primaryDocument:array<string>,"
    "primaryDocDescription:array<string>,acceptanceDateTime:array<string>,isXBRL:array<int>,isInlineXBRL:array<int>>>"
)


def read_chunk_files(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """One row per chunk with the filing's columns; with a limit the first by file name and index."""
    rows = spark.read.schema(CHUNK_FILE).json(path, multiLine=True).select("*", F.col("_metadata.file_name").alias("file"))
    outer = ["ticker", "company_name", "filing_date", "form_type", "file"]
    out = rows.select(*outer, F.explode("chunks").alias("c")).select("c.*", *outer)
    return out.orderBy("file", "chunk_index", "chunk_id").limit(limit) if limit is not None else out


def keyword_documents(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", F.col("text").alias("content"), "ticker", "company_name", "section_item", "section_title", "filing_date")


def read_entity_files(spark: SparkSession, path: str) -> DataFrame:
    """(accession_number, section_type, type, text) of every entity of the files."""
    rows = spark.read.schema(ENTITY_FILE).json(path, multiLine=True)
    sections = rows.select("accession_number", F.explode("sections").alias("s"))
    each = sections.select("accession_number", "s.section_type", F.explode("s.entities_by_type").alias("type", "found"))
    return each.select("accession_number", "section_type", "type", F.explode("found").alias("e")).select("accession_number", "section_type", "type", "e.text")


def read_listings(spark: SparkSession, path: str, forms: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per filing of company listings whose columns are parallel arrays, newest first within a company by the caller's order."""
    rows = spark.read.schema(LISTING).json(path, multiLine=True)
    recent = "filings.recent."
    names = ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument", "primaryDocDescription", "acceptanceDateTime", "isXBRL", "isInlineXBRL"]
    kind = lambda n: "int" if n.startswith("is") else "string"
    each = rows.select("cik", F.explode(F.arrays_zip(*[F.coalesce(recent + n, F.array().cast(f"array<{kind(n)}>")).alias(n) for n in names])).alias("f"))
    day = lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
    out = each.select(
        F.lpad("cik", 10, "0").alias("cik"), F.col("f.accessionNumber").alias("accession_number"), F.col("f.form").alias("form_type"), day(F.col("f.filingDate")).alias("filing_date"), day(F.col("f.reportDate")).alias("period_of_report"),
        F.col("f.primaryDocument").alias("primary_document"), F.try_to_timestamp("f.acceptanceDateTime").alias("acceptance_datetime"), (F.col("f.isXBRL") == 1).alias("is_xbrl"), (F.col("f.isInlineXBRL") == 1).alias("is_inline_xbrl"),
    ).where("filing_date is not null")
    if forms:
        out = out.where(F.col("form_type").isin(forms))
    if start:
        out = out.where(F.col("filing_date") >= start)
    if end:
        out = out.where(F.col("filing_date") <= end)
    return out


def read_company_attributes(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(LISTING).json(path, multiLine=True)
    text = lambda c: F.coalesce(c, F.lit(""))
    return rows.select(
        F.lpad("cik", 10, "0").alias("cik"), text("name").alias("company_name"), text(F.get("tickers", F.lit(0))).alias("ticker"), text("sic").alias("sic_code"), text("sicDescription").alias("sic_description"),
        text("stateOfIncorporation").alias("state_of_incorporation"), text("fiscalYearEnd").alias("fiscal_year_end"), text("category").alias("category"), text("ein").alias("ein"),
    )


class _Markdown(HTMLParser):
    """Headings, paragraphs, lists and emphasis as markdown; tables stay HTML without attributes."""

    BLOCKS = {"p", "div", "section", "article", "tr", "ul", "ol", "br", "hr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = self.table = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head"):
            self.hidden += 1
        elif tag == "table":
            self.table += 1
            self.out.append("\n\n<table>" if self.table == 1 else "<table>")
        elif self.table:
            if tag in ("tr", "td", "th"):
                self.out.append(f"<{tag}>")
        elif tag[0] == "h" and tag[1:].isdigit():
            self.out.append("\n\n" + "#" * min(6, int(tag[1:])) + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in self.BLOCKS:
            self.out.append("\n" if tag == "br" else "\n\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "table" and self.table:
            self.table -= 1
            self.out.append("</table>\n\n" if not self.table else "</table>")
        elif self.table:
            if tag in ("tr", "td", "th"):
                self.out.append(f"</{tag}>")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in self.BLOCKS or (tag[0] == "h" and tag[1:].isdigit()):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(html.escape(" ".join(data.split()) + " " * data[-1:].isspace(), quote=False) if self.table else data.replace("\n", " "))


def markdown_of(text: str | None) -> str | None:
    if text is None:
        return None
    import re

    parser = _Markdown()
    parser.feed(text)
    parser.close()
    joined = re.sub(r"[ \t]+", " ", "".join(parser.out)).replace("****", "")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" ?\n ?", "\n", joined)).strip()


def to_markdown(df: DataFrame, column: str, out: str = "markdown") -> DataFrame:
    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(markdown_of)

    return df.withColumn(out, convert(F.col(column).cast("string")))


def primary_documents(files: DataFrame) -> DataFrame:
    """Of the files (path, length) of each folder the main HTML: no exhibit, largest first."""
    from pyspark.sql.window import Window

    name = F.lower(F.regexp_extract("path", r"([^/]+)$", 1))
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    usable = files.where(name.rlike(r"\.html?$") & ~F.substring(name, 1, 3).contains("ex"))
    rank = F.row_number().over(Window.partitionBy(folder).orderBy(F.desc("length"), "path"))
    return usable.withColumn("n", rank).where("n = 1").drop("n")


def directory_entries(listing: DataFrame, column: str) -> DataFrame:
    """(name, type, size, last_modified) of a filing's index in JSON."""
    shape = "directory struct<item:array<struct<name:string,type:string,size:string,`last-modified`:string>>>"
    return listing.select(F.explode(F.from_json(column, shape)["directory"]["item"]).alias("i")).select("i.name", "i.type", F.expr("try_cast(i.size as bigint)").alias("size"), F.col("i.last-modified").alias("last_modified"))
