"""Readers of candidate catalogues, the source registry and mappings."""

from __future__ import annotations

import json
import re
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidemill.functions.text import id_to_name

#: Other names of registry fields: fixed values.
CAMEL = {"source_code": "sourceCode", "txt_url": "txtUrl", "xml_url": "xmlUrl", "match_keywords": "matchKeywords", "use_for_matching": "useForMatching"}
KINDS = ("real", "dummy")


def parse_catalog(text: DataFrame) -> DataFrame:
    """feed, epg_id, pos: the dotted words of a catalogue text (feed, text), each once in order; with -- parts, of the last of three or more."""
    parts = F.split("text", "--")
    body = F.when(F.size(parts) >= 3, F.element_at(parts, -1)).otherwise(F.col("text"))
    words = text.select("feed", F.posexplode(F.split(F.trim(body), r"\s+")).alias("pos", "epg_id")).where(F.col("epg_id").contains("."))
    return words.groupBy("feed", "epg_id").agg(F.min("pos").alias("pos"))


def read_catalogs(spark: SparkSession, paths: dict[str, str], skipped: list[str] | None = None) -> DataFrame:
    """parse_catalog() of one text file for each feed, with a byte order mark taken off.

    skipped: a list that takes the feeds whose files aren't there, which are then left out; without one they are an error, as is a catalogue of no feed at all."""
    rows = None
    fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for feed, path in paths.items():
        if skipped is not None and not fs_path(path).getFileSystem(conf).exists(fs_path(path)):
            skipped.append(feed)
            continue
        one = spark.read.text(path, wholetext=True).select(F.lit(feed).alias("feed"), F.regexp_replace("value", "^﻿", "").alias("text"))
        rows = one if rows is None else rows.union(one)
    if rows is None:
        raise ValueError("no catalogue could be read")
    return parse_catalog(rows)


def candidates(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates of real feeds that take part in matching: epg_id, feed, region, display_name, catalog_pos, source_priority, family."""
    real = registry.where("kind = 'real' and use_for_matching").select(F.col("name").alias("feed"), "region", "ordinal")
    rows = catalog.join(real, "feed")
    name = id_to_name(F.col("epg_id"))
    return rows.select("epg_id", "feed", "region", name.alias("display_name"), (F.col("ordinal") * 10_000_000 + F.col("pos")).alias("catalog_pos"), (F.col("ordinal") + 10).alias("source_priority"), F.lower(F.concat_ws("|", "region", name)).alias("family"))


def dummies(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    feeds = registry.where("kind = 'dummy'").select(F.col("name").alias("feed"))
    return catalog.join(feeds, "feed").groupBy(F.lower("epg_id").alias("id_folded")).agg(F.min_by("epg_id", "pos").alias("epg_id"))


def _flag(value: object, default: bool) -> bool:
    if value is None or isinstance(value, bool):
        return default if value is None else value
    text = str(value).strip().lower()
    if text in ("1", "true", "yes", "y", "on"):
        return True
    if text in ("0", "false", "no", "n", "off"):
        return False
    raise ValueError(f"{value!r} is no yes or no")


#: What names of sources, regions and servers look like: fixed values.
SOURCE_NAME = r"[A-Za-z0-9][A-Za-z0-9_.-]{0,63}"
SOURCE_CODE = r"[A-Za-z0-9][A-Za-z0-9_.-]{0,127}"
SERVER_ID = r"[a-z0-9][a-z0-9_-]{0,63}"
#: Ends of a server's address that aren't part of its base: fixed values.
BASE_ENDINGS = ["/player_api.php", "/xmltv.php"]


def plain_address(value: str | None, what: str, required: bool = True) -> str:
    """An http address without credentials or fragment, or blank where none is needed."""
    url = (value or "").strip()
    if not url and not required:
        return ""
    parsed = urlparse(url)
    if parsed.scheme.lower() not in ("http", "https") or not parsed.netloc or parsed.username or parsed.password or parsed.fragment:
        raise ValueError(f"{what} is not a plain http address")
    return url


def base_address(value: str) -> str:
    """A server's base address: without what its guide and interface add, without query."""
    url = value.strip().rstrip("/")
    for ending in BASE_ENDINGS:
        if url.lower().endswith(ending):
            url = url[: -len(ending)].rstrip("/")
    if urlparse(url).query:
        raise ValueError("a base address has no query")
    return plain_address(url, "a base address")


def server_id(value: str, known: list[str] | None = None) -> str:
    """A server's id in small letters, one of the known ones if they are given."""
    out = value.strip().lower()
    if not re.fullmatch(SERVER_ID, out) or known is not None and out not in known:
        raise ValueError(f"{value!r} is no server id")
    return out


def standard_addresses(base: str, code: str, names: tuple[str, str] = ("{code}.txt", "{code}.xml.gz")) -> tuple[str, str]:
    """Where a source of a code keeps its catalogue and its guide below a base address, by patterns of their names."""
    if not re.fullmatch(SOURCE_CODE, code):
        raise ValueError(f"{code!r} is no source code")
    return tuple(f"{base.rstrip('/')}/{x.replace('{code}', code)}" for x in names)


def with_cache_buster(url: str, stamp: int) -> str:
    """The address with a number that no cache knows."""
    return f"{url}{'&' if '?' in url else '?'}t={stamp}"


def register(sources: list[dict], raw: dict, overwrite: bool = False, base: str = "") -> list[dict]:
    """Sources with one more, whose fields are checked as parse_registry() does. With a base address and a source code, blank addresses are the standard ones."""
    row = {k: raw.get(k, raw.get(CAMEL.get(k, k))) for k in ("enabled", "name", "region", "kind", "source_code", "txt_url", "xml_url", "match_keywords", "use_for_matching")}
    if base and row["source_code"]:
        txt, xml = standard_addresses(base, str(row["source_code"]).strip())
        row |= {"txt_url": row["txt_url"] or txt, "xml_url": row["xml_url"] or xml}
    row["name"] = row["name"] or row["source_code"]
    if not re.fullmatch(SOURCE_NAME, str(row["name"] or "").strip()):
        raise ValueError(f"{row['name']!r} is no name of a source")
    row["region"] = row["region"] or "ALL"
    added = parse_registry(json.dumps({"schemaVersion": 1, "sources": [row]}))
    if added and any(x["name"] == added[0]["name"] for x in sources):
        if not overwrite:
            raise ValueError(f"source {added[0]['name']} is registered twice")
        sources = [x for x in sources if x["name"] != added[0]["name"]]
    return [x | {"ordinal": k} for k, x in enumerate([*sources, *added])]


def active_regions(registry: DataFrame) -> DataFrame:
    """region of the sources that take part in matching, but ALL."""
    return registry.where("kind = 'real' and use_for_matching and region <> 'ALL'").select("region").distinct()


def region_keywords(registry: DataFrame) -> DataFrame:
    """region, keyword: the words of sources that name a region, in small letters; longer ones first decide."""
    words = registry.where("region not in ('ALL', 'DUMMY')").select("region", F.explode("match_keywords").alias("keyword"))
    return words.select("region", F.lower(F.trim("keyword")).alias("keyword")).where("keyword <> ''").distinct()


def with_category_names(channels: DataFrame, categories: DataFrame) -> DataFrame:
    """channels with category_name by category_id, blank where the category is unknown; of a category's names the first in order counts."""
    names = categories.groupBy(F.trim("category_id").alias("category_id")).agg(F.min("category_name").alias("category_name"))
    return channels.drop("category_name").withColumn("category_id", F.trim("category_id")).join(names, "category_id", "left").fillna("", ["category_name"])


def parse_registry(text: str, overwrite: bool = False) -> list[dict]:
    """Enabled sources in order. A version other than 1, a missing name or region, another kind, an unsafe address or, unless overwrite, a second
    source of the same name is an error."""
    data = json.loads(text.lstrip("﻿"))
    if data.get("schemaVersion") != 1:
        raise ValueError("schemaVersion must be 1")
    out: dict[str, dict] = {}
    for raw in data.get("sources", []):
        row = {k: raw.get(k, raw.get(CAMEL.get(k, k))) for k in ("enabled", "name", "region", "kind", "source_code", "txt_url", "xml_url", "match_keywords", "use_for_matching")}
        if not _flag(row.pop("enabled"), True):
            continue
        name, region, kind = (str(row[k] or "").strip() for k in ("name", "region", "kind"))
        name, region, kind = name.upper(), region.upper(), (kind or "real").lower()
        if not name or not region or kind not in KINDS:
            raise ValueError(f"source {name or '?'}: name, region and kind ({' or '.join(KINDS)}) are needed")
        if name in out and not overwrite:
            raise ValueError(f"source {name} is registered twice")
        for k in ("txt_url", "xml_url"):
            row[k] = plain_address(row[k] and str(row[k]), f"source {name}: {k}", required=False)
        words = row["match_keywords"] or []
        words = [w.strip() for w in (words.split(",") if isinstance(words, str) else words)]
        out[name] = row | {"name": name, "region": region, "kind": kind, "source_code": str(row["source_code"] or name), "match_keywords": list(dict.fromkeys(w for w in words if w)), "use_for_matching": _flag(row["use_for_matching"], kind == "real")}
    return [x | {"ordinal": k} for k, x in enumerate(out.values())]


REGISTRY = "ordinal int, name string, region string, kind string, source_code string, txt_url string, xml_url string, match_keywords array<string>, use_for_matching boolean"


def registry_table(spark: SparkSession, sources: list[dict]) -> DataFrame:
    names = [x.split()[0] for x in REGISTRY.split(", ")]
    return spark.createDataFrame([tuple(x[n] for n in names) for x in sources], REGISTRY)


def registry_json(registry: DataFrame) -> str:
    """The registry as JSON, by name."""
    rows = [r.asDict() for r in registry.orderBy("name").drop("ordinal").collect()]  # a row for each source
    return json.dumps({"schemaVersion": 1, "sources": [{"enabled": True} | r for r in rows]}, indent=2, sort_keys=True)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header, all text, blanks instead of nulls, row_idx in order of the file. A byte order mark is taken off the first name."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    return rows.fillna("").withColumn("row_idx", F.monotonically_increasing_id())


def read_mappings(spark: SparkSession, folder: str, servers: list[str]) -> dict[str, DataFrame]:
    """The mapping of each server; files that are missing are one error that names them all."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    paths = {s: f"{folder.rstrip('/')}/{s}.csv" for s in servers}
    missing = [p for p in paths.values() if not fs_path(p).getFileSystem(conf).exists(fs_path(p))]
    if missing:
        raise FileNotFoundError(f"no mapping at {', '.join(missing)}")
    return {s: read_text_csv(spark, p) for s, p in paths.items()}


#: Keys under which inventory answers hold their rows, in the order in which they are tried: fixed values.
ANSWER_KEYS = ["data", "results", "items", "streams", "live_streams", "channels"]


def normalize_api_list(payload: object) -> list[dict]:
    """The rows of an inventory answer: a list, a list under a usual key, or a mapping of nothing but rows."""
    if isinstance(payload, dict):
        under = next((payload[k] for k in ANSWER_KEYS if isinstance(payload.get(k), list)), None)
        values = list(payload.values())
        payload = under if under is not None else values if all(isinstance(x, dict) for x in values) else []
    return [x for x in payload if isinstance(x, dict)] if isinstance(payload, list) else []
