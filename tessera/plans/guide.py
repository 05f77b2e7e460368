"""A guide corpus out of the table ``part``: one section for each part.

The expressions are plain SQL that Spark and other engines read alike, so results can
be compared across engines on the same texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Sentences by p_partkey % their number; they name entities, terms and enumerations.
SENTENCES = [
    "A purchase transaction of a condo needs a full appraisal and mutual funds may serve as reserves.",
    "For cash-out refinance of an investment property the maximum LTV of 75% applies.",
    "Self-employed borrowers with commission income must provide tax returns and a W-2.",
    "The primary residence may be a PUD or a manufactured home with a fixed-rate mortgage.",
    "Rental income from a two-to-four-unit property counts when Desktop Underwriter agrees.",
    "A borrower after bankruptcy or foreclosure waits; a short sale is generally required to be reported.",
    "Gift funds and depository assets are acceptable; obtain copies of the statements.",
    "If the property is a condominium, see Section B4-2.1 for details.",
    "See 4501.2 for additional requirements on manufactured housing loans.",
    "For investment properties, refer to B2-1.2 and compute the debt-to-income ratio.",
    "An adjustable-rate mortgage with a buydown has a DTI ratio of 45% or less.",
    "HomeReady and Community Seconds need at least 6 months of reserves and flood insurance.",
    "Lenders should not rely on alternative documentation; Loan Product Advisor may consider it.",
]
PREFIXES = ["B2-1.2", "B3-3.1", "B3-4.1", "B3-5", "B4-1", "E-3", "ZZ"]
RULES = ["Lenders must verify the income.", "Lenders should calculate the ratio by the formula.", "This overview describes a best practice.", "Files are kept."]

_FIRST = "p_partkey % 5 < 2"


def _case(key: str, values: list[str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


COLUMNS = [
    ("p_partkey", "section_id"),
    (f"CASE WHEN {_FIRST} THEN 'fannie_mae' ELSE 'freddie_mac' END", "source"),
    (
        f"CASE WHEN {_FIRST} THEN {_case('p_partkey % 7', PREFIXES)} || '-' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') "
        "ELSE CAST(1101 + (p_partkey * 37) % 6000 AS STRING) || '.' || CAST(1 + p_partkey % 9 AS STRING) END",
        "section_code",
    ),
    ("p_name", "title"),
    (
        "'The brand ' || p_brand || ' is described here.' || chr(10) || chr(10) || '## Limits ' || CAST(p_size AS STRING) || chr(10) || chr(10) || "
        + _case("p_size % 4", RULES)
        + " || ' The maximum LTV of ' || CAST(60 + p_size % 40 AS STRING) || '% applies.' || chr(10) || chr(10) || "
        + _case(f"p_partkey % {len(SENTENCES)}", SENTENCES)
        + " || chr(10) || '### Scores' || chr(10) || 'The minimum credit score of ' || CAST(580 + 4 * p_size AS STRING) || ' applies.' || chr(10) || "
        + "CASE WHEN p_partkey % 11 = 0 THEN '| Type | Limit |' || chr(10) || '| a | 80% LTV |' ELSE "
        + _case(f"(p_partkey * 3 + 1) % {len(SENTENCES)}", SENTENCES)
        + " END",
        "body",
    ),
    ("p_partkey % 11 = 0", "has_tables"),
]


#: Most sections of a task.
TASK_ROWS = 20_000


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus, dealt over all cores and by so many rows a task: the table is small but its texts are not read cheaply."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    parts = parts.repartition(max(spark.sparkContext.defaultParallelism, -(-parts.count() // TASK_ROWS)))
    return parts.selectExpr(*[f"{e} AS {n}" for e, n in COLUMNS])


SECTIONS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for e, n in COLUMNS) + " FROM part"
