"""Places in text: splitting, province and city recognition, levels and confidence, and the cities a text applies to.

Alias tables are small dimensions. A text is matched by generating its own prefixes (or substrings of alias length) and
joining them to the aliases by equality, instead of testing every alias against every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import CITY_PATTERN, COUNTY_PATTERN, MUNICIPALITIES, NATIONAL_WORDS, PROVINCE_SUFFIXES, PROVINCES, SPECIAL_PARENT_CITIES
from gridloom.functions.text import clean_text, split_parts, stable_id, without_suffix
from gridloom.operators.anchors import find_patterns
from gridloom.operators.keyed import learn_unambiguous, top_k
from gridloom.sources.scratch import stored

#: Aliases are no longer than this many code points.
LONGEST_ALIAS = 24


def short_province(name: str) -> str:
    for s in PROVINCE_SUFFIXES:
        if name.endswith(s):
            return name[: -len(s)]
    return name


def _province_prefix(text: Column) -> Column:
    """struct(name, code, length) of the province a text starts with: longer names first, each before its short form."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("name"), F.lit("").alias("code"), F.lit(0).alias("length")))
    for name, code in sorted(PROVINCES, key=lambda p: len(p[0]), reverse=True):
        for alias in (name, short_province(name)):
            out = out.when(text.startswith(alias), F.struct(F.lit(name).alias("name"), F.lit(code).alias("code"), F.lit(len(alias)).alias("length")))
    return out


def city_aliases(cities: DataFrame) -> DataFrame:
    """alias -> city: names, short names and the listed aliases, each alias once (the last city by id where two share it)."""
    rows = cities.select("*", F.explode(F.array_distinct(F.concat(F.transform(F.split(F.coalesce("aliases", F.lit("")), r"\|"), lambda a: F.btrim(a)), F.array("city_name", "city_name_short")))).alias("alias")).where("alias <> ''")
    return top_k(rows, ["alias"], [F.desc("city_id")])


def _different(df: DataFrame, column: str) -> DataFrame:
    """(_raw, text): the different texts of a column and what they are when cleaned, in files. Otherwise Spark would move
    filters on cleaned texts, and the cleaning with them, to all rows: before the ``distinct`` and across joins."""
    raw = df.select(F.col(column).cast("string").alias("_raw")).where("_raw IS NOT NULL").distinct()
    return stored(raw.select("_raw", clean_text(F.col("_raw")).alias("text")), "texts").where("text IS NOT NULL")


def normalize_geography(df: DataFrame, column: str, cities: DataFrame, learned: DataFrame | None = None, key: str = "record_id") -> DataFrame:
    """One row per place named in ``column``: part number, names, codes, level, method, confidence, needs_review.

    ``cities`` has city_id, city_name, city_name_short, province_name, city_code, administrative_level and aliases
    (separated by bars); ``learned`` has city_name and province_name. Places repeat: each different text is read once,
    and its rows meet what it says.
    """
    raw, record = "_raw", key
    asked = df.select(F.col(record), F.col(column).cast("string").alias(raw)).where(F.col(raw).isNotNull())
    text = _different(df, column)
    national = F.col("text").isin(*NATIONAL_WORDS)
    parts = text.select(raw, F.posexplode(F.when(national, F.array("text")).otherwise(split_parts(F.col("text")))).alias("pos", "part"), national.alias("national"))
    p = F.col("part")
    with_province = parts.withColumn("p", F.when(~F.col("national"), _province_prefix(p))).withColumn("rest0", F.substring(p, F.coalesce(F.col("p.length"), F.lit(0)) + 1, F.char_length(p)))
    rest = F.when((F.col("rest0") == "") & F.col("p.name").isin(*MUNICIPALITIES), F.col("p.name")).otherwise(F.col("rest0"))
    named = with_province.withColumn("rest", rest).drop("rest0")

    # Prefixes of the rest, and the whole part: the longest that is an alias names the city.
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.char_length("rest"), F.lit(LONGEST_ALIAS))), lambda n: F.substring("rest", F.lit(1), n))
    tries = named.where("NOT national").select(raw, "pos", F.explode(F.array_distinct(F.concat(F.when(F.char_length("rest") > 0, prefixes).otherwise(F.array().cast("array<string>")), F.array("part")))).alias("alias"))
    hits = top_k(tries.join(city_aliases(cities), "alias"), [raw, "pos"], [F.desc(F.char_length("alias")), F.asc("alias")])
    hits = hits.select(raw, "pos", "alias", F.col("city_id").alias("c_id"), F.col("city_name").alias("c_name"), F.col("city_code").cast("string").alias("c_code"), F.col("province_name").alias("c_province"), F.col("administrative_level").alias("c_level"))
    j = named.join(hits, [raw, "pos"], "left")

    base = F.when(F.col("rest") != "", F.col("rest")).otherwise(p)
    parsed = F.nullif(F.regexp_extract(base, CITY_PATTERN, 1), F.lit(""))
    j = j.withColumn("city_name", F.coalesce("c_name", F.when(~F.col("national"), parsed)))
    after = F.when(F.col("alias").isNotNull() & F.col("rest").startswith(F.col("alias")), F.substring("rest", F.char_length("alias") + 1, F.char_length("rest")))
    after = after.when(F.col("alias").isNull() & F.col("city_name").isNotNull(), F.substring(base, F.char_length("city_name") + 1, F.char_length(base))).otherwise("")
    j = j.withColumn("county", F.nullif(F.regexp_extract(after, COUNTY_PATTERN, 1), F.lit("")))
    if learned is not None:
        j = j.join(learned.select("city_name", F.col("province_name").alias("l_province")), "city_name", "left")
    else:
        j = j.withColumn("l_province", F.lit(None).cast("string"))
    j = j.withColumn("province_name", F.coalesce("p.name", "c_province", "l_province"))

    parent = F.when(F.lit(False), F.lit(""))
    for child, of in SPECIAL_PARENT_CITIES:
        parent = parent.when(F.col("city_name") == child, F.lit(of))
    j = j.withColumn("parent_city_name", parent)
    parents = city_aliases(cities).select(F.col("alias").alias("parent_city_name"), F.col("city_code").cast("string").alias("parent_code"))
    j = j.join(parents, "parent_city_name", "left")
    own_county = F.col("c_level").isin("county_level_city", "county_city") | F.col("parent_city_name").isNotNull()
    level = F.when(F.col("national"), "national").when(own_county, "county_level_city").when(F.col("county").isNotNull(), "county").when(F.col("city_name").isNotNull(), "city").when(F.col("province_name").isNotNull(), "province").otherwise("unknown")
    confidence = F.when(F.col("national") | F.col("alias").isNotNull(), 1.0).when(F.col("province_name").isNotNull() & F.col("city_name").isNotNull(), 0.9).when(F.col("province_name").isNotNull(), 0.8).otherwise(0.65)
    method = F.when(F.col("national"), "national_rule").when(F.col("alias").isNotNull(), "city_alias").when(F.col("city_name").isNotNull(), "province_city_parse").when(F.col("province_name").isNotNull(), "province_rule").otherwise("unmatched")
    county = F.when(own_county, F.col("city_name")).otherwise(F.col("county"))
    full = F.concat_ws("", "province_name", F.when(F.col("city_name") != F.coalesce("province_name", F.lit("")), F.col("city_name")), F.when((F.coalesce("city_name", F.lit("")) != county) & (F.coalesce("province_name", F.lit("")) != county), county))
    code = F.lit(None).cast("string")
    for name, c in PROVINCES:
        code = F.when(F.col("province_name") == name, F.lit(c)).otherwise(code)
    places = j.select(
        raw, (F.col("pos") + 1).alias("part_number"), p.alias("geography_original"), F.when(F.col("national"), NATIONAL_WORDS[0]).otherwise(F.coalesce(F.nullif(full, F.lit("")), p)).alias("name_normalized"),
        "province_name", code.alias("province_code"), "city_name", F.coalesce("parent_code", "c_code").alias("city_code"), F.col("c_id").alias("city_id"), county.alias("county_name"), "parent_city_name",
        level.alias("jurisdiction_level"), method.alias("match_method"), confidence.alias("match_confidence"), (confidence < 0.8).alias("needs_review"),
    )
    return asked.join(places, raw).select(record, *places.columns[1:])


def match_scope_cities(df: DataFrame, column: str, cities: DataFrame, key: str = "record_id") -> DataFrame:
    """Cities in scope that a text applies to: all cities of a province it names as a whole (to be reviewed), else each
    city whose longest alias occurs in it, with the district that follows."""
    text = df.select(F.col(key), clean_text(F.col(column)).alias("text")).where("text IS NOT NULL")
    t = F.col("text")
    suffixes = [s for s in PROVINCE_SUFFIXES if s != "特别行政区"]
    provinces = cities.groupBy("province_name").agg(F.count("*").alias("n"), F.bool_or(F.col("administrative_level") == "municipality").alias("municipal"))
    names = provinces.select("province_name", "n", "municipal", F.explode(F.array_distinct(F.array("province_name", without_suffix(F.col("province_name"), suffixes)))).alias("name"))
    whole = text.withColumn("name", F.explode(F.array_distinct(F.array(t, F.regexp_replace(t, "全省$", ""))))).join(names, "name").where("NOT (municipal AND n = 1)")
    whole = whole.join(cities.select(F.col("city_name").alias("text")), "text", "left_anti").select(key, "text", "province_name").distinct()
    by_province = whole.join(cities.select("city_id", "province_name"), "province_name").select(
        key, "city_id", F.lit("province_scope").alias("match_method"), F.lit(0.75).alias("confidence"), F.lit("province").alias("jurisdiction_level"), F.lit(None).cast("string").alias("district_name"), F.lit(True).alias("needs_review")
    )
    rest = text.join(whole.select(key), key, "left_anti")
    aliases = cities.select("city_id", F.explode(F.array_distinct(F.concat(F.transform(F.split(F.coalesce("aliases", F.lit("")), r"\|"), lambda a: F.btrim(a)), F.array("city_name", "city_name_short")))).alias("alias")).where("alias <> ''")
    found = find_patterns(rest, aliases, key=key, pattern_id="city_id", pattern="alias")
    longest = top_k(found, [key, "city_id"], [F.desc("length"), F.asc("pattern")]).select(key, "city_id", F.col("pattern").alias("alias"))
    hits = longest.join(rest.select(key, "text"), key)
    own = aliases.groupBy("city_id").agg(F.collect_set("alias").alias("own_aliases"))
    tail = F.btrim(F.substring("text", F.instr("text", F.col("alias")) + F.char_length("alias"), F.char_length("text")), F.lit(" ，,、/；;"))
    district = F.when(tail.rlike("(区|县|旗)$"), tail)
    by_alias = hits.join(own, "city_id").select(
        key, "city_id", F.lit("alias").alias("match_method"), F.when(F.array_contains("own_aliases", F.col("text")), 1.0).otherwise(0.9).alias("confidence"),
        F.when(district.isNotNull(), "district").otherwise("city").alias("jurisdiction_level"), district.alias("district_name"), F.lit(False).alias("needs_review"),
    )
    return by_province.unionByName(by_alias)


def learn_city_provinces(texts: DataFrame, column: str, cities: DataFrame) -> DataFrame:
    """(city_name, province_name) that texts and the city table always name together."""
    text = _different(texts, column).select(F.col("text").alias("t")).distinct().withColumn("p", _province_prefix(F.col("t")))
    rest = F.substring("t", F.col("p.length") + 1, F.char_length("t"))
    named = text.where("p IS NOT NULL").select(F.nullif(F.regexp_extract(rest, r"^([^/、,，;；]{1,12}?(?:市|自治州|地区|盟))", 1), F.lit("")).alias("city_name"), F.col("p.name").alias("province_name"))
    return learn_unambiguous(named.unionByName(cities.select("city_name", "province_name")), "city_name", "province_name")


def materialize_geography(links: DataFrame, jurisdictions: DataFrame, cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of all links (record_id, jurisdiction_id, relation_type, geography_original), and the jurisdictions with the
    most confident reading of each (the first part of equals)."""
    keyed_links = links.withColumn("link", F.struct("record_id", "jurisdiction_id"))
    places = normalize_geography(keyed_links, "geography_original", cities, learn_city_provinces(links, "geography_original", cities), key="link")
    normal = places.select(stable_id(F.col("link.record_id"), F.col("link.jurisdiction_id"), F.col("part_number"), prefix="RGEO", clean=False).alias("record_geography_id"), "link.record_id", "link.jurisdiction_id", *[c for c in places.columns if c != "link"])
    best = top_k(normal, ["jurisdiction_id"], [F.desc("match_confidence"), F.asc("part_number"), F.asc("record_geography_id")])
    code = F.coalesce("city_code", F.concat("province_code", F.lit("0000")))
    clean = jurisdictions.join(best.select("jurisdiction_id", F.col("name_normalized").alias("best_name"), "province_name", "city_name", "county_name", "jurisdiction_level", code.alias("administrative_code")), "jurisdiction_id", "left")
    return normal, clean.select("jurisdiction_id", "name", F.coalesce("best_name", "name").alias("name_normalized"), "administrative_code", F.col("jurisdiction_level").alias("level"), F.col("province_name").alias("province"), F.col("city_name").alias("prefecture"), F.col("county_name").alias("county"))
