"""Approved aliases and groups of equivalent ids: readers, merge, export."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from guidemill.functions.names import Reader
from guidemill.functions.vocabulary import Vocabulary
from guidemill.sources.catalog import read_text_csv

FIELDS = ["alias", "regions", "epg_ids", "timeshift_epg_ids", "required_languages", "relationship", "note"]
#: Other names that these fields go by: fixed values.
ALSO = {"regions": ["region"], "epg_ids": ["epg_id"], "timeshift_epg_ids": ["timeshift_targets"], "required_languages": ["required_language"]}


def name_key(vocabulary: Vocabulary | None = None):
    """A column function: the strict key of a name."""

    @pandas_udf(StringType())
    def key(names: pd.Series) -> pd.Series:
        read = Reader(vocabulary).key
        return names.map(lambda x: read(x or ""))

    return key


def parts(text: Column, separators: str = "[,|;]") -> Column:
    """The parts of a value between separators, trimmed, without blank ones; null: none."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), separators), lambda x: F.trim(x)), lambda x: x != "")


def _merged(lists: Column) -> Column:
    return F.array_distinct(F.flatten(lists))


def aliases(rows: DataFrame, order: str = "row_idx", vocabulary: Vocabulary | None = None) -> DataFrame:
    """pos, alias (a strict key), regions, epg_ids, timeshift_epg_ids, required_languages, relationship, note of rows of text.

    Rows of one alias and one list of regions are one: ids in order of arrival, each once, also those for a time shift; relationship and note are the last that
    are not blank, required languages the first row's. Rows without an alias or any id don't count. No regions mean ALL."""
    have = {c: next((F.col(x) for x in [c, *ALSO.get(c, [])] if x in rows.columns), F.lit(None)).cast("string") for c in FIELDS}
    shifts = F.from_json(have["timeshift_epg_ids"], "map<string,string>")
    listed = F.transform_values(F.coalesce(shifts, F.create_map().cast("map<string,string>")), lambda _, v: F.coalesce(F.from_json(v, "array<string>"), parts(v, "[|;]")))
    listed = F.map_filter(F.transform_keys(listed, lambda k, _: F.regexp_replace(F.trim(k), r"^\+", "")), lambda k, v: (k != "") & (F.size(v) > 0))
    regions = F.transform(parts(have["regions"]), lambda x: F.upper(x))
    read = rows.select(F.col(order).alias("at"), name_key(vocabulary)(have["alias"]).alias("alias"), F.array_distinct(F.when(F.size(regions) > 0, regions).otherwise(F.array(F.lit("ALL")))).alias("regions"), parts(have["epg_ids"], "[|;]").alias("ids"), F.map_entries(listed).alias("shifts"), F.transform(parts(have["required_languages"]), lambda x: F.lower(x)).alias("languages"), have["relationship"].alias("relationship"), have["note"].alias("note"))
    read = read.where((F.col("alias") != "") & ((F.size("ids") > 0) | (F.size("shifts") > 0)))
    one = F.array_sort(F.collect_list(F.struct("at", "ids", "shifts", "languages", "relationship", "note")))
    got = read.groupBy("alias", "regions").agg(one.alias("x"))
    entries = F.flatten(F.transform("x", lambda r: r["shifts"]))
    hours = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    merged = F.map_from_arrays(hours, F.transform(hours, lambda k: _merged(F.transform(F.filter(entries, lambda e: e["key"] == k), lambda e: e["value"]))))
    last = lambda name, otherwise: F.coalesce(F.try_element_at(F.filter(F.transform("x", lambda r: r[name]), lambda v: F.coalesce(v, F.lit("")) != ""), F.lit(-1)), F.lit(otherwise))
    return got.select(F.element_at("x", 1)["at"].alias("pos"), "alias", "regions", _merged(F.transform("x", lambda r: r["ids"])).alias("epg_ids"), merged.alias("timeshift_epg_ids"), F.element_at("x", 1)["languages"].alias("required_languages"), last("relationship", "approved_alias").alias("relationship"), last("note", "").alias("note"))


def read_aliases(spark: SparkSession, path: str, vocabulary: Vocabulary | None = None) -> DataFrame:
    """aliases() of a CSV file."""
    return aliases(read_text_csv(spark, path), vocabulary=vocabulary)


def alias_table(found: DataFrame) -> DataFrame:
    """The aliases as text, as read_aliases() reads them back."""
    joined = lambda c: F.array_join(c, "|").alias(c)
    return found.select("alias", joined("regions"), joined("epg_ids"), F.to_json("timeshift_epg_ids").alias("timeshift_epg_ids"), joined("required_languages"), "relationship", "note", "pos")


def approved_memory(mapping: DataFrame, catalogue: DataFrame, order: str = "row_idx", vocabulary: Vocabulary | None = None) -> DataFrame:
    """alias, regions, epg_ids, relationship, note that a person's approvals teach: the strict key of a channel's name without wrappers and the region of the id's catalogue
    (else detected_region, else ALL), with the ids in order of approval. Streams, servers and panel rows are not remembered.

    mapping: channel_name, category_name, action, source, epg_id. catalogue: epg_id, region."""
    from guidemill.functions.names import with_channels

    rows = mapping.where(F.upper(F.trim("action")).isin("MANUAL", "APPROVED") & (F.lower(F.trim("source")) == "epgshare") & (F.trim("epg_id") != ""))
    known = catalogue.groupBy(F.lower("epg_id").alias("folded")).agg(F.min("region").alias("known"))
    detected = F.upper(F.trim("detected_region")) if "detected_region" in mapping.columns else F.lit("")
    read = with_channels(rows.select("channel_name", "category_name", F.trim("epg_id").alias("id"), F.col(order).alias("at"), detected.alias("detected")), vocabulary=vocabulary).where("strict <> ''")
    region = F.coalesce("known", F.when(F.coalesce("detected", F.lit("")) != "", F.col("detected")), F.lit("ALL"))
    read = read.join(known, F.lower("id") == F.col("folded"), "left").select(F.col("strict").alias("alias"), F.when(region == "NA_DIASPORA", "US|CA").otherwise(region).alias("regions"), "id", "at")
    first = read.groupBy("alias", "regions", "id").agg(F.min("at").alias("at")).groupBy("alias", "regions").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("x"))
    return first.select("alias", "regions", F.array_join(F.transform("x", lambda r: r["id"]), "|").alias("epg_ids"), F.lit("approved_mapping_memory").alias("relationship"), F.lit("from an approved mapping; checked against the catalogue before use").alias("note"))


def equivalence_groups(spark: SparkSession, source: object) -> DataFrame:
    """label, epg_id of groups of equivalent ids: a list of groups, a mapping that holds one under groups or scheduleEquivalenceGroups, or a JSON file of either.

    A group is a list of ids, text with separators, or a mapping with epg_ids or ids; those with fewer than two different ids don't count. The groups are few and made on the driver."""
    import hashlib
    import re

    payload = json.loads(spark.read.text(source, wholetext=True).first()[0].lstrip("﻿")) if isinstance(source, str) else source
    if isinstance(payload, dict):
        payload = payload.get("groups", payload.get("scheduleEquivalenceGroups", []))
    rows = []
    for group in payload or []:
        group = group.get("epg_ids", group.get("ids", [])) if isinstance(group, dict) else group
        ids = list(dict.fromkeys(x.strip() for x in (re.split("[|;,]", group) if isinstance(group, str) else map(str, group)) if x.strip()))
        if len(ids) > 1:
            label = hashlib.sha256("|".join(sorted(x.casefold() for x in ids)).encode()).hexdigest()[:24]
            rows += [(label, x) for x in ids]
    return spark.createDataFrame(rows, "label string, epg_id string")
