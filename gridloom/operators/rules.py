"""Keyword rules: ordered first-match classification, directions, multi-label collections with merge by confidence.

Rules are data, given as Python lists of a few hundred words at most; they become constant expressions, so each text is
scanned inside generated code, without any UDF or join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import DIRECTION_RULES, OTHER_TOPIC, TOPIC_RULES
from gridloom.functions.text import contains_any, excerpt
from gridloom.operators.keyed import best_by


def first_word(text: Column, words: Sequence[str]) -> Column:
    """The first word of the list, in its order, that the text contains; else null."""
    out = F.when(F.lit(False), F.lit(""))
    for w in words:
        out = out.when(F.contains(text, F.lit(w)), F.lit(w))
    return out


def classify(text: Column, rules: dict[str, list[str]] | None = None, other: str = OTHER_TOPIC, confidence: float = 0.9) -> Column:
    """Array of (topic, confidence, evidence_excerpt) for every topic with a word in the text, in rule order; if there is
    none, the one topic ``other`` at 0.5 with the head of the text."""
    hits = []
    for topic, words in (TOPIC_RULES if rules is None else rules).items():
        word = first_word(text, words)
        around = excerpt(text, F.instr(text, word), F.char_length(word), 30, 50)
        hits.append(F.when(contains_any(text, words), F.struct(F.lit(topic).alias("topic"), F.lit(confidence).alias("confidence"), around.alias("evidence_excerpt"))))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    none = F.array(F.struct(F.lit(other).alias("topic"), F.lit(0.5).alias("confidence"), F.substring(text, 1, 80).alias("evidence_excerpt")))
    return F.when(F.size(found) > 0, found).otherwise(none)


def infer_direction(text: Column, rules: Sequence[tuple[str, list[str]]] | None = None) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for direction, words in DIRECTION_RULES if rules is None else rules:
        out = out.when(contains_any(text, words), F.lit(direction))
    return out.otherwise("unknown")


@dataclass(frozen=True)
class CollectionRule:
    rule_id: str
    collection: str
    subcollection: str
    keywords: tuple[str, ...]
    confidence: float
    #: 'central' or 'local': the rule holds for such records only.
    gate: str | None = None


def rule_assignments(records: DataFrame, rules: Sequence[CollectionRule], fields: Sequence[str]) -> DataFrame:
    """(record_id, collection, subcollection, source, confidence, evidence, seq) of the rules that hold for each record.

    A rule's evidence is its first keyword in the first field that has any; case does not matter.
    """
    lowered = {f: F.lower(F.coalesce(f, F.lit(""))) for f in fields}
    hits = []
    for i, r in enumerate(rules):
        words = [k.lower() for k in r.keywords]
        where = F.when(F.lit(False), F.struct(F.lit("").alias("field"), F.lit("").alias("word"), F.lit("").alias("around")))
        for f in fields:
            word = first_word(lowered[f], words)
            around = excerpt(F.coalesce(f, F.lit("")), F.instr(lowered[f], word), F.char_length(word), 80, 120)
            where = where.when(contains_any(lowered[f], words), F.struct(F.lit(f).alias("field"), word.alias("word"), around.alias("around")))
        gate = F.lit(True) if r.gate is None else F.coalesce(F.col(f"is_{r.gate}"), F.lit(False))
        evidence = F.concat(where["field"], F.lit(": "), where["word"], F.lit(": "), where["around"])
        hit = F.struct(F.lit(r.collection).alias("collection"), F.lit(r.subcollection).alias("subcollection"), F.lit(f"rule:{r.rule_id}").alias("source"), F.lit(r.confidence).alias("confidence"), F.substring(evidence, 1, 500).alias("evidence"), F.lit(100 + i).alias("seq"))
        hits.append(F.when(gate & where.isNotNull(), hit))
    return records.select("record_id", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("h")).select("record_id", "h.*")


def assign_collections(records: DataFrame, rules: Sequence[CollectionRule], sheets: DataFrame, fields: Sequence[str], central: str = "central_party_state", local: str = "local_government", fallback: tuple[str, str] = ("tracking_statistics", "policy_statistics")) -> DataFrame:
    """Collections of each record: from its sheet, its jurisdiction and the keyword rules; of several claims to the same
    collection the most confident, the earliest of equals; a record without any goes to the fallback.

    ``records`` has record_id, source_sheet, is_central, is_local and the text fields; ``sheets`` has source_sheet,
    collection, subcollection, mapping_role and seq.
    """
    columns = ("record_id", "collection", "subcollection", "source", "confidence", "evidence", "seq")
    role = F.when(F.col("mapping_role") == "primary", 1.0).otherwise(0.95)
    from_sheet = records.select("record_id", "source_sheet").join(sheets, "source_sheet").select("record_id", "collection", "subcollection", F.lit("source_sheet").alias("source"), role.alias("confidence"), F.col("source_sheet").alias("evidence"), "seq")
    sides = F.array(*[F.when(F.col(flag), F.struct(F.lit(name).alias("collection"), F.lit(n).alias("seq"))) for flag, name, n in (("is_central", central, 50), ("is_local", local, 51))])
    from_place = records.select("record_id", F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("s")).select("record_id", "s.collection", F.lit(None).cast("string").alias("subcollection"), F.lit("jurisdiction_rule").alias("source"), F.lit(0.75).alias("confidence"), F.lit("").alias("evidence"), "s.seq")
    claims = from_sheet.select(*columns).unionByName(from_place.select(*columns)).unionByName(rule_assignments(records, rules, fields).select(*columns))
    best = best_by(claims, ["record_id", "collection", "subcollection"], "confidence", "seq")
    rest = records.select("record_id").join(claims.select("record_id"), "record_id", "left_anti").select("record_id", F.lit(fallback[0]).alias("collection"), F.lit(fallback[1]).alias("subcollection"), F.lit("fallback").alias("source"), F.lit(0.5).alias("confidence"), F.lit("").alias("evidence"), F.lit(999).alias("seq"))
    status = F.when(F.col("source") == "source_sheet", "approved").when(F.col("source") == "fallback", "pending").otherwise("unreviewed")
    return best.unionByName(rest).withColumn("review_status", status).withColumn("is_primary", ((F.col("source") == "source_sheet") & (F.col("confidence") == 1.0)) | (F.col("source") == "fallback")).drop("seq")
