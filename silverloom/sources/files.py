"""File sources and sinks: snapshots, agreement documents, page counts, reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions.dates import created_on
from silverloom.operators.tables import latest, missing

AGREEMENT = (
    "coworker_id string, coworker_name string, file_id string, pdf_path string, contract_type string, total_pages int, "
    "page_1 struct<start_date: string, end_date: string, additional_commitment_term_options: string, termination_notice_timeline: string>, "
    "page_2 struct<additional_notes: string>, renewal_system variant, termination_notice_table map<string, map<string, string>>, section_5_found_on_page int"
)


def write_snapshot(records: DataFrame, path: str, source: str, entity: str, run_id: str, at: Column) -> str:
    """Land raw records of one run under entity/yyyy/mm/dd/run_id; writing a run again replaces it."""
    first = records.sparkSession.range(1).select(F.date_format(at, "yyyy/MM/dd")).first()[0]
    target = f"{path}/{source}/{entity}/{first}/{run_id}"
    meta = {"source": F.lit(source), "entity": F.lit(entity), "run_id": F.lit(run_id), "snapshot_at_utc": at}
    records.withColumns(meta).write.mode("overwrite").json(target)
    return target


def file_name() -> Column:
    """The name of a row's file as it is on the store; Spark's metadata percent-encodes it."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def read_agreements(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Extracted agreement documents, one JSON file each, summaries left out; optionally of one contract type."""
    docs = spark.read.schema(AGREEMENT).option("multiLine", True).json(path).withColumn("file_name", file_name())
    docs = docs.where(~F.col("file_name").contains("summary"))
    return docs if kind is None else docs.where(F.col("contract_type") == kind)


def renewal_text(renewal: Column) -> Column:
    """(category, raw_text, display) of a field that is a string, which is the category, or an object with both."""
    text = F.try_variant_get(renewal, "$", "string")
    is_object = F.schema_of_variant(renewal).startswith("OBJECT")
    category, raw = (F.try_variant_get(renewal, f"$.{n}", "string") for n in ("category", "raw_text"))
    return F.struct(
        F.when(is_object, category).otherwise(text).alias("category"),
        F.when(is_object, raw).alias("raw_text"),
        F.when(is_object & (F.coalesce(raw, F.lit("")) != ""), F.concat(F.coalesce(category, F.lit("")), F.lit(" | "), raw)).when(is_object, category).otherwise(text).alias("display"),
    )


def flat_agreements(docs: DataFrame) -> DataFrame:
    """The 14 columns of the summary, one row a document; what is missing is empty."""
    renewal = renewal_text(F.col("renewal_system"))
    cells = {
        "coworker_id": "coworker_id", "coworker_name": "coworker_name", "file_id": "file_id", "contract_type": "contract_type", "total_pages": "total_pages", "start_date": "page_1.start_date",
        "end_date": "page_1.end_date", "additional_commitment_term_options": "page_1.additional_commitment_term_options", "termination_notice_timeline": "page_1.termination_notice_timeline",
        "additional_notes": "page_2.additional_notes", "renewal_system": renewal["category"], "renewal_system_raw_text": renewal["raw_text"], "section_5_found_on_page": "section_5_found_on_page", "pdf_path": "pdf_path",
    }
    return docs.select(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")).alias(n) for n, c in cells.items()])


def scans_with_results(scans: DataFrame, docs: DataFrame) -> DataFrame:
    """Scanned files beside their extracted documents, matched by the file's stem; files without one are left out."""
    stem = lambda c: F.regexp_extract(c, r"([^/]*?)(\.[^./]*)?$", 1)
    return scans.select("path", "kind", stem(F.col("path")).alias("stem")).join(docs.withColumn("stem", stem(F.col("file_name"))), "stem")


def latest_files(files: DataFrame, key: str = "coworker_id", created: str = "created_on") -> DataFrame:
    """The latest file of each coworker; created is '/Date(ms)/' or ISO, unreadable dates come last, ties go by id."""
    return latest(files, [key], [F.desc(created_on(F.col(created))), F.col("id")])


def read_scans(spark: SparkSession, path: str) -> DataFrame:
    """PDF and PNG files as (path, kind, content), PDFs first by kind."""
    one = lambda kind, order: spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}").load(path).select("path", F.lit(kind).alias("kind"), F.lit(order).alias("kind_order"), "content")
    return one("pdf", 0).unionByName(one("png", 1))


def page_counts(scans: DataFrame, count: Callable[[bytes], int]) -> DataFrame:
    """(path, pages, error) by an injectable page counter; a PNG is one page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, kind, content in zip(b["path"], b["kind"], b["content"]):
                try:
                    rows.append((path, 1 if kind == "png" else int(count(content)), None))
                except Exception as e:  # an unreadable file is a row of the report
                    rows.append((path, None, f"ERROR: {e}"))
            out = pd.DataFrame(rows, columns=["path", "pages", "error"])
            yield out.assign(pages=out["pages"].astype("Int32"))

    return scans.select("path", "kind", "content").mapInPandas(run, "path string, pages int, error string")


def page_report(counts: DataFrame) -> DataFrame:
    """Counts with a review flag, readable files first by pages."""
    flag = F.when(F.col("error").isNotNull() | (F.col("pages") < 3), "manual review").otherwise("ok")
    return counts.withColumn("review", flag).orderBy(F.col("error").isNotNull(), F.coalesce("pages", F.lit(0)), "path")


def write_report(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """One CSV file with a header: for reports, whose size is bounded by design."""
    (df.select(*fields) if fields else df).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_reports(tables: dict[str, DataFrame], path: str) -> None:
    """The sheets of a workbook: one CSV report a table, in folders by name."""
    for name, df in tables.items():
        write_report(df, f"{path}/{name}")


def encoded(scans: DataFrame) -> DataFrame:
    """Scans with their content in base64, as services that read pages want it."""
    return scans.withColumn("content_base64", F.base64("content"))


def write_coworkers_without_files(coworkers: DataFrame, files: DataFrame, path: str) -> None:
    """The coworkers that have no file, as JSON."""
    missing(coworkers, files, ["coworker_id"]).coalesce(1).write.mode("overwrite").json(path)
