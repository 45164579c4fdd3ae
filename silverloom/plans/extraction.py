"""Agreement documents: pages are read by an injected client, the rest is joins and expressions.

A reader answers questions on pages (a model, or a fixture in tests). Long documents are searched
page by page for the section on terms, which ends the search; what the pages say is then
put together with Spark: the first page that has the section, the next page's table merged in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions import json as J
from silverloom.functions.strings import classify_renewal, stem_parts
from silverloom.operators.tables import missing
from silverloom.sources.documents import read_documents, write_documents
from silverloom.sources.files import AGREEMENT

#: Documents of fewer pages are new ones; what holds for these.
NEW_BELOW = 10
NEW_RENEWAL = "same duration as the Initial Commitment Term"
NEW_TABLE = {
    "1-11 months": {"0-24": "2 months", "25-74": "2 months", "75+": "3 months"},
    "12-23 months": {"0-24": "2 months", "25-74": "3 months", "75+": "6 months"},
    "24+ months": {"0-24": "3 months", "25-74": "6 months", "75+": "6 months"},
}
QUESTIONS = ("terms", "notes", "section", "continuation")
REPLIES = "path string, kind string, total_pages int, page int, question string, reply string, error string"
TABLE = "map<string,map<string,string>>"


def page_replies(scans: DataFrame, pages: Callable[[bytes], int], ask: Callable[[bytes, int, str], str]) -> DataFrame:
    """(path, kind, total_pages, page, question, reply, error) of scanned files (path, kind, content); pages count from 1.

    A PNG is one page. Every document is asked for its terms on page 1 and notes on page 2; those of
    NEW_BELOW pages or more from page 3 on for the section, until a page has it, then for the
    table's continuation on the next. A document that fails gives one row with its error.
    """

    def of_document(kind: str, content: bytes) -> Iterator[tuple]:
        total = 1 if kind == "png" else int(pages(content))
        yield total, 1, "terms", ask(content, 1, "terms")
        if kind != "png" and total >= 2:
            yield total, 2, "notes", ask(content, 2, "notes")
        for page in range(3, total + 1) if total >= NEW_BELOW else ():
            reply = ask(content, page, "section")
            yield total, page, "section", reply
            try:
                found = bool(json.loads(reply).get("has_section_5"))
            except (ValueError, AttributeError):
                found = False
            if found:
                if page < total:
                    yield total, page + 1, "continuation", ask(content, page + 1, "continuation")
                break

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, kind, content in zip(b["path"], b["kind"], b["content"]):
                try:
                    rows = [(path, kind, *r, None) for r in of_document(kind, bytes(content))]
                except Exception as e:  # the other documents go on
                    rows = [(path, kind, None, None, None, None, f"{type(e).__name__}: {e}")]
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in REPLIES.split(", ")])
                yield out.astype({"total_pages": "Int32", "page": "Int32"})

    return scans.select("path", "kind", "content").mapInPandas(run, REPLIES)


def agreements(replies: DataFrame) -> DataFrame:
    """One row a document from stored page replies, in the columns of agreement files; failed documents are left out.

    One grouping by document: pages are few and a document's replies small.
    """
    v = J.fenced_json(F.col("reply"))
    r = replies.where("error is null").withColumn("v", v)
    text = lambda c, n: F.try_variant_get(c, f"$.{n}", "string")
    asked = lambda q: F.col("question") == q
    has = asked("section") & J.truthy(F.col("v"), "has_section_5")
    table = F.try_variant_get("v", "$.termination_notice_table", TABLE)
    d = r.groupBy("path").agg(
        F.max("kind").alias("kind"), F.max("total_pages").alias("total_pages"),
        F.max(F.when(asked("terms"), F.to_json("v"))).alias("terms"), F.max(F.when(asked("notes"), F.to_json("v"))).alias("notes"),
        F.min_by(F.struct("page", text(F.col("v"), "renewal_text").alias("renewal"), table.alias("table")), F.when(has, F.col("page"))).alias("s"),
        F.min_by(F.struct("page", table.alias("table")), F.when(asked("continuation") & J.truthy(F.col("v"), "has_table"), F.col("page"))).alias("c"),
    )
    new = (F.col("kind") == "png") | (F.col("total_pages") < NEW_BELOW)
    clause = F.coalesce("s.renewal", F.lit(""))
    old_renewal = F.when(F.col("s").isNotNull(), F.to_variant_object(F.struct(classify_renewal(clause).alias("category"), clause.alias("raw_text"))))
    merged = F.when(F.col("s").isNotNull(), J.merged_tables(F.col("s.table"), F.when(F.col("c.page") == F.col("s.page") + 1, F.col("c.table"))))
    stem = stem_parts(F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1))
    one, two = F.try_parse_json("terms"), F.try_parse_json("notes")
    names = ("start_date", "end_date", "additional_commitment_term_options", "termination_notice_timeline")
    return d.withColumn("n", stem).select(
        "n.coworker_id", "n.coworker_name", "n.file_id", F.col("path").alias("pdf_path"), F.when(new, "new").otherwise("old").alias("contract_type"), "total_pages",
        F.struct(*[text(one, n).alias(n) for n in names]).alias("page_1"), F.struct(text(two, "additional_notes").alias("additional_notes")).alias("page_2"),
        F.when(new, F.try_parse_json(F.lit(json.dumps(NEW_RENEWAL)))).otherwise(old_renewal).alias("renewal_system"),
        F.when(new, J.constant(NEW_TABLE)).otherwise(merged).alias("termination_notice_table"), F.when(~new, F.col("s.page")).alias("section_5_found_on_page"),
    )


def named(docs: DataFrame) -> DataFrame:
    """Documents as (name, json): the scan's stem and the document, as one file each."""
    return docs.select(F.regexp_extract("pdf_path", r"([^/]*?)(\.[^./]*)?$", 1).alias("name"), F.to_json(F.struct(*docs.columns)).alias("json"))


def extract_new(spark: SparkSession, scans: DataFrame, path: str, pages: Callable[[bytes], int], ask: Callable[[bytes, int, str], str], again: bool = False) -> dict[str, int]:
    """Read the scans without a document under path and write one JSON file each: {processed, skipped, failed}.

    What is there isn't read again, so a run that was stopped goes on; with `again` long documents that
    lack the section are read once more and replaced. A scan that fails has no document, and the others go on.
    """
    done = read_documents(spark, path).select(F.from_json("json", AGREEMENT).alias("d")).select("d.pdf_path", "d.contract_type", "d.section_5_found_on_page")
    todo = not_yet_read(scans, done, again)
    replies = page_replies(todo, pages, ask).persist()
    new = agreements(replies)
    n, failed = todo.count(), replies.where("error is not null").select("path").distinct().count()
    write_documents(named(new), path)
    replies.unpersist()
    return {"processed": n - failed, "skipped": scans.count() - n, "failed": failed}


def not_yet_read(scans: DataFrame, done: DataFrame, again: bool = False) -> DataFrame:
    """Scanned files without a document in done (pdf_path); with `again` also those whose long document lacks the section."""
    if again:
        done = done.where("contract_type = 'new' or section_5_found_on_page is not null")
    return missing(scans, done.select(F.col("pdf_path").alias("path")), ["path"])
