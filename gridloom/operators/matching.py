"""Candidate matching and scoring: blocking by place and date band, fuzzy titles, weighted source scores, acceptance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.fuzzy import ratio_udf, weighted_ratio_udf
from gridloom.functions.numbers import days_apart
from gridloom.functions.text import clean_text
from gridloom.operators.columns import evenly
from gridloom.operators.keyed import best_and_margin, top_k

DAYS, LEAST, BEST = 45, 55.0, 3


def block_city(c: Column) -> Column:
    """The blocking key of a place: region suffixes taken out anywhere, then a last 市 and a last 省."""
    text = F.coalesce(clean_text(c), F.lit(""))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "壮族自治区|回族自治区|维吾尔自治区|自治区|特别行政区", ""), "市$", ""), "省$", "")


def match_candidates(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Up to three records for each row, by title, place and date.

    ``rows``: row_number, block, row_date, row_title, linked_id. ``records``: record_id, block, record_date,
    record_title, seq. The block and the date's period are joined by equality: a row meets its own period, those beside it
    and the records without a date, which are in any band and lose nothing for it; only a row without a date meets its
    whole block. The band is tested on the joined rows, and only what is left is scored, dealt evenly over the tasks.
    """
    days = days_apart(F.col("record_date"), F.col("row_date"))
    period = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / (DAYS + 1)).cast("int")
    undated = F.lit(-1_000_000)
    placed = records.withColumn("_period", F.coalesce(period("record_date"), undated))
    own = rows.where("row_date IS NOT NULL").withColumn("_period", F.explode(F.array(period("row_date") - 1, period("row_date"), period("row_date") + 1, undated)))
    met = own.join(placed, ["block", "_period"]).drop("_period").unionByName(rows.where("row_date IS NULL").join(records, "block"))
    near = met.withColumn("date_difference_days", days).where(F.col("date_difference_days").isNull() | (F.col("date_difference_days") <= DAYS))
    titled = F.col("row_title").isNotNull()
    title = F.when(titled, weighted_ratio_udf(F.coalesce("row_title", F.lit("")), F.coalesce("record_title", F.lit("")))).otherwise(0.0)
    date = F.when(F.col("row_date").isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - F.coalesce("date_difference_days", F.lit(0)) * F.lit(4.0))).otherwise(0.0)
    linked = F.coalesce(F.col("record_id") == F.col("linked_id"), F.lit(False))
    scored = evenly(near).withColumn("title_score", title).withColumn("date_score", date)
    score = F.when(linked, 100.0).when(titled, F.col("title_score") * 0.7 + F.col("date_score") * 0.3).otherwise(F.col("date_score"))
    best = top_k(scored.withColumn("match_score", score).where(F.col("match_score") >= LEAST), ["row_number"], [F.desc("match_score"), F.asc("seq")], BEST)
    return best.select(
        "row_number", F.col("record_id").alias("candidate_record_id"), F.when(linked, "existing_exact").otherwise("title_city_date_fuzzy").alias("match_method"), F.round("match_score", 2).alias("match_score"),
        F.round("title_score", 2).alias("title_score"), "date_difference_days", F.when(linked, "approved").otherwise("pending").alias("review_status"),
    )


#: Weights of a source candidate's components.
WEIGHTS = {"title": 0.25, "document_number": 0.3, "issuing_agency": 0.15, "date": 0.1, "region": 0.1, "text": 0.1}


def source_score(r: str = "r", c: str = "c") -> Column:
    """struct(score, has_conflict) of a candidate struct ``c`` for a record struct ``r``: components that both sides have,
    weighted; a different document number or over 31 days between the dates caps the score at 0.69.

    Both have title, document_number, issuing_agency, day, region and text.
    """
    left, right = (lambda n: F.col(f"{r}.{n}")), (lambda n: F.col(f"{c}.{n}"))
    there = lambda x: x.isNotNull() & (x != "")
    similar = lambda n, cut=None: ratio_udf(F.substring(left(n), 1, cut) if cut else left(n), F.substring(right(n), 1, cut) if cut else right(n)) / 100
    days = days_apart(right("day"), left("day"))
    same = left("document_number") == right("document_number")
    parts = {
        "title": similar("title"), "document_number": same.cast("double"), "issuing_agency": similar("issuing_agency"),
        "date": F.when(days == 0, 1.0).when(days <= 7, 0.5).otherwise(0.0), "region": similar("region"), "text": similar("text", 3000),
    }
    has = {n: there(left(n)) & there(right(n)) for n in WEIGHTS if n != "date"} | {"date": left("day").isNotNull() & right("day").isNotNull()}
    total = sum((F.when(has[n], F.lit(w)).otherwise(0.0) for n, w in WEIGHTS.items()), F.lit(0.0))
    weighted = sum((F.when(has[n], parts[n] * F.lit(w)).otherwise(0.0) for n, w in WEIGHTS.items()), F.lit(0.0))
    conflict = F.coalesce(has["document_number"] & ~same, F.lit(False)) | F.coalesce(days > 31, F.lit(False))
    score = weighted / F.when(total > 0, total).otherwise(1.0)
    return F.struct(F.round(F.when(conflict, F.least(score, F.lit(0.69))).otherwise(score), 4).alias("score"), conflict.alias("has_conflict"))


def accept_best(scored: DataFrame, keys: list[str], score: str = "score", conflict: str = "has_conflict", status: str = "official_status", seq: str = "seq", margin: float = 0.05) -> DataFrame:
    """The best candidate of each record and what to do with it; media are leads only, reprints need a higher score."""
    best = best_and_margin(scored, keys, score, seq)
    needed = F.when(F.col(status) == "official", 0.85).otherwise(0.90)
    close = F.col(conflict) | (F.col("margin") < margin)
    decision = F.when(~F.col(status).isin("official", "official_reprint"), "low_confidence").when(close, "candidate_conflict").when(F.col(score) < needed, "low_confidence").otherwise("recover")
    return best.withColumn("decision", decision)
