"""Rule sources: taxonomies, sheet mappings and keyword rules kept as data in JSON or YAML files."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gridloom.operators.rules import CollectionRule


def read_rules(spark: SparkSession, path: str) -> dict[str, Any]:
    """One file of rules, small by nature, from whatever store Spark reads; YAML where its parser is installed."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.rsplit(".", 1)[-1].lower() == "json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def sheet_mappings(spark: SparkSession, rules: Mapping[str, Any]) -> DataFrame:
    """(source_sheet, collection, subcollection, mapping_role, seq) from ``{sheet: {primary: {...}, secondary: [{...}]}}``."""
    rows = []
    for sheet, entry in rules.items():
        for role, places in (("primary", [entry["primary"]]), ("secondary", entry.get("secondary") or [])):
            rows += [(sheet, p["collection"], p.get("subcollection"), role, len(rows) + i) for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "source_sheet string, collection string, subcollection string, mapping_role string, seq int")


def taxonomy(spark: SparkSession, rules: Mapping[str, Any]) -> DataFrame:
    """(collection, subcollection) from ``{collection: {subcollections: [...] or {...}}}``, null for one without any."""
    rows = [(name, sub) for name, entry in rules.items() for sub in (list(entry.get("subcollections") or []) or [None])]
    return spark.createDataFrame(rows, "collection string, subcollection string")


def collection_rules(rules: list[Mapping[str, Any]]) -> list[CollectionRule]:
    """Keyword rules from ``[{id, collection, subcollection, keywords, confidence, gate}]``; confidence 0.8 where it has none."""
    return [CollectionRule(str(r["id"]), r["collection"], r.get("subcollection"), tuple(r["keywords"]), float(r.get("confidence", 0.8)), r.get("gate")) for r in rules]
