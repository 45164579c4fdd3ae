"""String expressions: cleaning, fallback chains, labels and text classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(c: Column) -> Column:
    """Trim all white space; an empty result is null."""
    return F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def strip_html(c: Column) -> Column:
    """Tags become spaces, white space collapses, empty is null; entities stay."""
    return clean_text(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"(?U)\s+", " "))


def first_truthy(*cs: Column) -> Column:
    """The first non-null, non-empty value; the last one as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def joined(values: Column, sep: str, empty_is_null: bool = False) -> Column:
    out = F.array_join(values, sep)
    return F.nullif(out, F.lit("")) if empty_is_null else out


def first_of(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


#: Markers of the two renewal classifiers.
EXTRACT_MONTHLY = ["month-to-month", "month to month", "monthly basis", "month basis"]
EXTRACT_SAME = ["same duration", "same period", "initial commitment term", "same term"]
REPORT_SAME = ["same duration", "same_period", "initial commitment", "same term"]
REPORT_MONTHLY = ["monthly", "month-to-month", "month to month"]


def classify_renewal(text: Column) -> Column:
    """Class of an extracted renewal clause: monthly markers first. Only null and '' are unknown."""
    t = F.lower(text)
    return (
        F.when(text.isNull() | (text == ""), "unknown").when(_any(t, EXTRACT_MONTHLY), "monthly").when(_any(t, EXTRACT_SAME), "same_period_initial_commitment").otherwise("personalized")
    )


def renewal_category(text: Column) -> Column:
    """Class of a renewal text in the report: same-duration markers first."""
    t = F.lower(text)
    return (
        F.when(text.isNull() | (text == ""), "unknown").when(_any(t, REPORT_SAME), "same_duration").when(_any(t, REPORT_MONTHLY), "monthly").otherwise("personalized")
    )


def tenure_bucket(months: Column) -> Column:
    return F.when(months <= 11, "1-11 months").when(months <= 23, "12-23 months").when(months.isNotNull(), "24+ months")


def capacity_bucket(capacity: Column) -> Column:
    return F.when(capacity <= 24, "0-24").when(capacity <= 74, "25-74").when(capacity.isNotNull(), "75+")


def notice_months(text: Column, anchored: bool = True) -> Column:
    """The number before 'month', at the beginning or (not anchored) anywhere; 0 if there is none."""
    found = F.regexp_extract(F.lower(text), ("^" if anchored else "") + r"(\d+)\s*month", 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("int"), F.lit(0))


def unfenced(text: Column) -> Column:
    """Text without a markdown code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def id_list(text: Column) -> Column:
    """Parts of a comma list, without brackets and blanks, empty parts left out."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"[\[\]]", ""), ","), lambda x: F.trim(x)), lambda x: x != "")


def label_of(code: Column, labels: dict[int, str], default: str = "Unknown") -> Column:
    out = F.lit(default)
    for k, v in labels.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def contract_status(active: Column, cancelled: Column) -> Column:
    """ACTIVE, CANCELLED or INACTIVE of a contract's flags; an active one is active whether or not it is cancelled, null counts as 0."""
    return F.when(F.coalesce(active, F.lit(0)) != 0, "ACTIVE").when(F.coalesce(cancelled, F.lit(0)) != 0, "CANCELLED").otherwise("INACTIVE")


def names_of(flags: dict[str, Column]) -> Column:
    """The names whose flag is 1, in the order given: the amenities of a room."""
    return F.array_compact(F.array(*[F.when(c == 1, F.lit(n)) for n, c in flags.items()]))


def hhmm(minutes: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"))


def extension_of(content_type: Column, default: str = ".pdf") -> Column:
    """File extension of a content type with or without parameters."""
    kind = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    sub = F.regexp_extract(kind, r"^[^/]+/([a-z0-9]+)$", 1)
    return F.when(sub == "jpeg", ".jpg").when(F.coalesce(sub, F.lit("")) == "", default).otherwise(F.concat(F.lit("."), sub))


def masked(text: Column, head: int = 4, tail: int = 4) -> Column:
    return F.concat(F.left(text, F.lit(head)), F.lit("..."), F.right(text, F.lit(tail)))


def safe_filename(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N} _-]", "_"))


def stem_parts(stem: Column) -> Column:
    """(coworker_id, coworker_name, file_id) of 'id_name_file'; with two parts the name is empty."""
    p = F.split(stem, "_", 3)
    two = F.size(p) == 2
    return F.struct(
        F.get(p, F.lit(0)).alias("coworker_id"),
        F.when(two, "").otherwise(F.coalesce(F.get(p, F.lit(1)), F.lit(""))).alias("coworker_name"),
        F.when(two, F.get(p, F.lit(1))).otherwise(F.coalesce(F.get(p, F.lit(2)), F.lit(""))).alias("file_id"),
    )
