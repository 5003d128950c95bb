"""Assessment records and the report pages made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.text import chapter_label, fill_template, record_hash
from ecoledger.operators.classes import first_values
from ecoledger.operators.criteria import blank_status

# Free-text fields of a new record, in record order around the
# status map, and its placeholders.
TODO = "TODO"
DEFAULT_AUTHORS = ("John Smith", "Jane Smith")
FIELDS_BEFORE_STATUS = (
    "iucn_status", "description", "distribution", "characteristic_native_biota",
    "abiotic_environment", "key_processes_and_interactions", "major_threats",
    "ecosystem_collapse_definition", "assessment_summary",
)
FIELDS_AFTER_STATUS = ("assessment_outcome", "year_published", "date_assessed")
CREDIT_FIELDS = ("assessed_by", "reviewed_by", "contributions_by")
CRITERION_FIELDS = tuple(f"criterion_{c}_description" for c in "abcde")

# The ecosystem the page templates are written for.
TEMPLATE_CODE = "M1.1.1"
TEMPLATE_NAME = "Null Island Marine Shelf"


def scaffold_records(index: DataFrame, features: DataFrame, country: str) -> DataFrame:
    """A blank assessment record per class, name and group from its first feature."""
    firsts = first_values(features, "name", "fg").select(
        "code", F.coalesce("name", F.lit("")).alias("_name"), F.coalesce("fg", F.lit("N/A")).alias("_fg")
    )
    todo = F.lit(TODO)
    return index.select("index", "code").join(firsts, "code").select(
        F.col("_name").alias("ecosystem_name"),
        F.lit(country).alias("country_name"),
        F.array(*[F.lit(a) for a in DEFAULT_AUTHORS]).alias("authors"),
        todo.alias("biome"),
        F.col("_fg").alias("functional_group"),
        F.col("code").alias("global_classification"),
        "index",
        *[todo.alias(f) for f in FIELDS_BEFORE_STATUS],
        blank_status().alias("criteria_status"),
        *[todo.alias(f) for f in FIELDS_AFTER_STATUS],
        F.struct(*[todo.alias(f) for f in CREDIT_FIELDS]).alias("assessment_credits"),
        *[todo.alias(f) for f in CRITERION_FIELDS],
    )


def render_pages(
    records: DataFrame, assessment_template: str, criterion_template: str, country_config: str
) -> DataFrame:
    """(path, code, text): two pages per record (code, name, record_text).

    The assessment page carries the hash of its record and the country settings;
    the criterion page depends on spatial data only and carries none.
    """
    code, name = F.col("code"), F.coalesce("name", "code")
    no_hash = F.lit(None).cast("string")
    kinds = F.array(
        F.struct(F.lit("").alias("suffix"), F.lit(assessment_template).alias("template"),
                 record_hash(F.col("record_text"), F.lit(country_config)).alias("page_hash")),
        F.struct(F.lit("_crit_b").alias("suffix"), F.lit(criterion_template).alias("template"),
                 no_hash.alias("page_hash")),
    )
    return records.where("code is not null").select("code", "name", F.inline(kinds)).select(
        F.concat(code, F.lit("/"), code, F.col("suffix"), F.lit(".qmd")).alias("path"),
        "code",
        fill_template(
            F.col("template"), code, name, F.col("page_hash"), TEMPLATE_CODE, TEMPLATE_NAME
        ).alias("text"),
    )


def page_changes(rendered: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``change`` (new, changed, unchanged) against the stored pages.

    Stored text travels as a hash, so the join moves no page bodies twice.
    """
    old = stored.select("path", F.sha2(F.col("text").cast("binary"), 256).alias("_old"))
    new_hash = F.sha2(F.col("text").cast("binary"), 256)
    return rendered.join(old, "path", "left").withColumn(
        "change",
        F.when(F.col("_old").isNull(), F.lit("new"))
        .when(F.col("_old") == new_hash, F.lit("unchanged"))
        .otherwise(F.lit("changed")),
    ).drop("_old")


def chapter_list(records: DataFrame) -> DataFrame:
    """Chapter rows (index, code, name, label, pages) of records (index, code, name).

    Order them with ``report_order``.
    """
    name = F.coalesce("name", "code")
    base = F.concat(F.col("code"), F.lit("/"), F.col("code"))
    return records.select(
        "index", "code", name.alias("name"),
        chapter_label(F.col("index"), F.col("code"), name).alias("label"),
        F.array(F.concat(base, F.lit(".qmd")), F.concat(base, F.lit("_crit_b.qmd"))).alias("pages"),
    )


def report_order() -> list:
    """Numbered classes first, by number; the rest by name."""
    return [F.col("index").asc_nulls_last(), F.coalesce("name", "code").asc()]
