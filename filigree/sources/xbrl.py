"""Facts, hierarchies and labels out of XBRL files, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from decimal import Decimal, InvalidOperation
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

XLINK = "{http://www.w3.org/1999/xlink}"
LINKBASES = r"_(cal|def|lab|pre)\.xml$"
FACT = (
    "path string, seq bigint, concept_name string, concept_namespace string, concept_local_name string, value decimal(20,4), value_text string, unit string, decimals int, "
    "period_type string, period_start string, period_end string, dimensions map<string,string>, is_custom boolean"
)
STANDARD = ("us-gaap", "dei")


# What a role's name holds, in the order of the tests, and the statement it then belongs to.
SECTIONS = {
    "IncomeStatement": "IncomeStatement", "OFOPERATIONS": "IncomeStatement", "Operations": "IncomeStatement", "ComprehensiveIncome": "IncomeStatement",
    "BalanceSheet": "BalanceSheet", "FinancialPosition": "BalanceSheet", "OFFINANCIALPOSITION": "BalanceSheet",
    "CashFlow": "CashFlowStatement", "OFCASHFLOWS": "CashFlowStatement", "CashFlows": "CashFlowStatement",
    "Equity": "StockholdersEquity", "OFSTOCKHOLDERSEQUITY": "StockholdersEquity", "StockholdersEquity": "StockholdersEquity",
    "FinancialInstruments": "FinancialInstruments", "FairValue": "FairValue", "Debt": "Debt", "Leases": "Leases", "Commitments": "Commitments",
    "IncomeTaxes": "IncomeTaxes", "Taxes": "IncomeTaxes", "SegmentReporting": "Segments", "Segments": "Segments", "CoverPage": "CoverPage", "DocumentAndEntityInformation": "CoverPage",
}


def section_of(role: Column) -> Column:
    """The statement that a role names by the last part of its address; a name of none of them stays, without the usual words; no role is Other."""
    name = F.regexp_extract(F.rtrim(role, F.lit("/")), r"([^/]*)$", 1)
    name = F.regexp_replace(F.regexp_replace(name, "role|Role|CONSOLIDATED|Consolidated", ""), "STATEMENTS|Statements|Statement", "")
    known = reduce(lambda w, kv: w.when(F.lower(name).contains(kv[0].lower()), kv[1]), list(SECTIONS.items())[1:], F.when(F.lower(name).contains("incomestatement"), "IncomeStatement"))
    rest = F.regexp_replace(name, "^[_-]+|[_-]+$", "")
    return F.when(F.coalesce(role, F.lit("")) == "", "Other").otherwise(known.otherwise(F.when(rest == "", "Other").otherwise(rest)))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _prefix(uri: str, declared: dict[str, str]) -> str:
    for name in STANDARD:
        if f"/{name}/" in uri:
            return name
    return declared.get(uri, "")


def facts_of(content: bytes) -> list[dict]:
    """Every element with a context: contexts and units resolved, dimensions as a map."""
    declared: dict[str, str] = {}
    try:
        from io import BytesIO

        root = None
        for event, got in ET.iterparse(BytesIO(content), events=("start-ns", "end")):
            if event == "start-ns":
                declared.setdefault(got[1], got[0])
            else:
                root = got
    except ET.ParseError:
        return []
    if root is None:
        return []
    contexts, units = {}, {}
    for e in root.iter():
        kind = _local(e.tag) if isinstance(e.tag, str) else ""
        if kind == "context":
            at = {_local(x.tag): (x.text or "").strip()[:10] for x in e.iter() if _local(x.tag) in ("instant", "startDate", "endDate")}
            dims = {x.get("dimension"): (x.text or "").strip() for x in e.iter() if _local(x.tag) == "explicitMember" and x.get("dimension")}
            contexts[e.get("id")] = (at, dims)
        elif kind == "unit":
            parts = [(x.text or "").strip().rpartition(":")[2] for x in e.iter() if _local(x.tag) == "measure"]
            units[e.get("id")] = "/".join(parts)
    out = []
    for e in root.iter():
        ref, text = e.get("contextRef"), (e.text or "").strip()
        if not ref or not text or not isinstance(e.tag, str):
            continue
        uri, _, local = e.tag.lstrip("{").rpartition("}")
        prefix = _prefix(uri, declared)
        try:
            number = Decimal(text.replace(",", ""))
            value = number.quantize(Decimal("0.0001")) if number.is_finite() and abs(number) < 10**16 else None
        except InvalidOperation:
            value = None
        at, dims = contexts.get(ref, ({}, {}))
        decimals = e.get("decimals")
        out.append(
            {
                "concept_name": f"{prefix}:{local}" if prefix else local, "concept_namespace": prefix, "concept_local_name": local, "value": value, "value_text": None if value is not None else text,
                "unit": units.get(e.get("unitRef"), e.get("unitRef")), "decimals": int(decimals) if decimals and re.fullmatch(r"-?\d+", decimals) else None,
                "period_type": "instant" if "instant" in at else "duration" if "endDate" in at else "unknown", "period_start": at.get("startDate"), "period_end": at.get("instant") or at.get("endDate"),
                "dimensions": dims or None, "is_custom": prefix not in STANDARD,
            }
        )
    return out


def concept_of(href: str) -> str | None:
    """The concept that a locator's reference names after the #."""
    _, sign, name = href.rpartition("#")
    if not sign:
        return None
    if "us-gaap_" in name:
        return "us-gaap:" + name.rpartition("us-gaap_")[2]
    if ":" not in name and "us-gaap" in href.lower():
        return "us-gaap:" + name
    return name.replace("_", ":", 1) if ":" not in name else name


def _arcs(content: bytes, link: str, arc: str):
    """(role, locators label -> concept, arcs [(from, to, order)], resources label -> text) of every extended link."""
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        return
    for e in root.iter():
        if not isinstance(e.tag, str) or _local(e.tag) != link:
            continue
        kinds = {k: [x for x in e if isinstance(x.tag, str) and _local(x.tag) == k] for k in ("loc", arc, "label")}
        locators = {x.get(f"{XLINK}label"): concept_of(x.get(f"{XLINK}href", "")) for x in kinds["loc"]}
        arcs = [(x.get(f"{XLINK}from"), x.get(f"{XLINK}to"), float(x.get("order", 1))) for x in kinds[arc]]
        texts = {x.get(f"{XLINK}label"): "".join(x.itertext()).strip() for x in kinds["label"]}
        yield e.get(f"{XLINK}role", ""), locators, arcs, texts


def hierarchy_of(content: bytes) -> list[dict]:
    """(role, concept_name, parent_concept, depth, sort_order) of a presentation linkbase; a concept counts where it comes first; a cycle ends a path."""
    out, seen = [], set()
    for role, locators, arcs, _ in _arcs(content, "presentationLink", "presentationArc"):
        parent = {locators[b]: locators[a] for a, b, _ in arcs if locators.get(a) and locators.get(b)}
        order = {locators[b]: n for a, b, n in arcs if locators.get(a) and locators.get(b)}
        for concept in locators.values():
            if not concept or concept in seen:
                continue
            seen.add(concept)
            path, at = {concept}, concept
            while (up := parent.get(at)) and up not in path:
                path.add(up)
                at = up
            out.append({"role": role, "concept_name": concept, "parent_concept": parent.get(concept), "depth": len(path) - 1, "sort_order": order.get(concept, 999.0)})
    return out


def labels_of(content: bytes) -> list[dict]:
    """(concept_name, label): the first arc of a concept counts."""
    found: dict[str, str] = {}
    for _, locators, arcs, texts in _arcs(content, "labelLink", "labelArc"):
        for a, b, _ in arcs:
            if locators.get(a) and texts.get(b):
                found.setdefault(locators[a], texts[b])
    return [{"concept_name": c, "label": t} for c, t in found.items()]


def _parse(files: DataFrame, of, schema: str) -> DataFrame:
    columns = [c.split()[0] for c in re.split(r",\s*(?![^<(]*[>)])", schema)]

    def work(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                rows = [{"path": path, "seq": i, **r} for i, r in enumerate(of(bytes(content)))]
                yield pd.DataFrame(rows, columns=columns, dtype=object)

    return files.select("path", "content").mapInPandas(work, schema)


def instances(files: DataFrame) -> DataFrame:
    """Of the files (path, content) of each folder the instance: ``*_htm.xml`` before ``*-*.xml`` before ``*.xml``, no linkbase, with an XBRL marker in its first 8 KB."""
    name, folder = F.regexp_extract("path", r"([^/]+)$", 1), F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    rank = F.when(name.endswith("_htm.xml"), 0).when(name.contains("-"), 1).otherwise(2)
    head = F.lower(F.substring("content", 1, 8192).cast("string"))
    usable = files.where(name.endswith(".xml") & ~name.rlike(LINKBASES) & (head.contains("xbrl") | head.contains("contextref")))
    first = F.row_number().over(Window.partitionBy(folder).orderBy(rank, "path"))
    return usable.withColumn("n", first).where("n = 1").drop("n")


def read_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def read_facts(files: DataFrame) -> DataFrame:
    rows = _parse(files, facts_of, FACT)
    return rows.withColumn("period_start", F.try_to_timestamp("period_start", F.lit("yyyy-MM-dd")).cast("date")).withColumn("period_end", F.try_to_timestamp("period_end", F.lit("yyyy-MM-dd")).cast("date"))


def read_hierarchy(files: DataFrame) -> DataFrame:
    return _parse(files, hierarchy_of, "path string, seq bigint, role string, concept_name string, parent_concept string, depth int, sort_order double")


def read_labels(files: DataFrame) -> DataFrame:
    return _parse(files, labels_of, "path string, seq bigint, concept_name string, label string")


def enriched(facts: DataFrame, hierarchy: DataFrame, labels: DataFrame) -> DataFrame:
    """Facts with section role, parent, depth and label; a label made of the local name where there is none."""
    h = hierarchy.groupBy("concept_name").agg(F.min_by(F.struct("role", "parent_concept", "depth"), F.struct("path", "seq")).alias("h")).select("concept_name", "h.*")
    names = labels.groupBy("concept_name").agg(F.min_by("label", F.struct("path", "seq")).alias("known"))
    made = F.trim(F.regexp_replace("concept_local_name", "([A-Z])", " $1"))
    return facts.join(h, "concept_name", "left").join(names, "concept_name", "left").withColumn("label", F.coalesce("known", made)).drop("known")


def document_period(facts: DataFrame) -> DataFrame:
    """(path, period_end): the date that the filing states, else its most frequent period end, of equals the earliest."""
    stated = facts.where("concept_local_name = 'DocumentPeriodEndDate'").groupBy("path").agg(F.min(F.try_to_timestamp("value_text", F.lit("yyyy-MM-dd")).cast("date")).alias("stated"))
    counts = facts.where("period_end is not null").groupBy("path", "period_end").agg(F.count("*").alias("n"))
    mode = counts.groupBy("path").agg(F.min_by("period_end", F.struct(-F.col("n"), F.col("period_end"))).alias("mode"))
    return facts.select("path").distinct().join(stated, "path", "left").join(mode, "path", "left").select("path", F.coalesce("stated", "mode").alias("period_end"))
