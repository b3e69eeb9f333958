"""Functions and operators of mapping, guide, resolution, icons, export, and the readers and sinks, on small tables."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from guidemill.functions import names, similarity
from guidemill.functions.text import bag_key, id_to_name, is_informative, normal_title, repair_encoding, tokens
from guidemill.functions.time import iso, parse_iso, parse_stamp, stamp
from guidemill.operators import equivalence, export, guide, icons, mapping, package, publish, resolve
from guidemill.sources import aliases, catalog, xmltv

NOW = 1_705_708_800


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("20240120000000 +0000", NOW), ("20240120053000 +0530", NOW), ("202401200000", NOW), ("20240120000000 Z", NOW), ("20240120000000 bad", NOW), ("20240120000000", NOW),
        ("20241320000000", None), ("2024012000000", None), ("", None), (None, None), ("x", None), ("2024012000000099 -0100", NOW + 3600),
    ],
)
def test_stamps(spark, text, want):
    assert one(spark, text, parse_stamp) == want


def test_times_round_trip(spark):
    r = spark.createDataFrame([(NOW,)], "x long").select(stamp(F.col("x")).alias("s"), iso(F.col("x")).alias("i")).first()
    assert r.s == "20240120000000 +0000" and r.i == "2024-01-20T00:00:00Z"
    assert one(spark, r.i, parse_iso) == NOW and one(spark, None, iso, "long") == ""


def test_titles(spark):
    said = {"Café & Bar": "cafe and bar", "  A--B ": "a b", None: "", "№1": "no1", "ﬁn": "fin"}
    for text, want in said.items():
        assert one(spark, text, normal_title) == want
    for text, want in {"News": True, "No Information": False, "N/A": False, "": False, None: False, "no programme available": False, "Not Only": True, "TBA": False}.items():
        assert one(spark, text, is_informative) is want
    assert one(spark, "cafÃ©", repair_encoding) == "café" and one(spark, "café", repair_encoding) == "café"
    assert one(spark, "BigSports2HD+.us", id_to_name) == "Big Sports2 HD plus"
    for text, want in {"Fox.News": "Fox News", "Kxyz.us_locals1": "Kxyz", "Sports.Dummy.us": "Sports", "a/b-c.uk2": "a b c"}.items():
        assert one(spark, text, id_to_name) == want
    assert one(spark, "b a b", lambda x: bag_key(tokens(x))) == "a b b"


def test_similarity_anchors():
    assert round(similarity.ratio("this is a test", "this is a test!"), 2) == 96.55
    assert round(similarity.ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear"), 2) == 90.91
    assert round(similarity.ratio("sharaddha", "shraddha"), 2) == 94.12
    assert similarity.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert round(similarity.weighted_ratio("this is a test", "this is a new test!!!"), 1) == 85.5
    assert similarity.ratio("", "") == 100 and similarity.weighted_ratio("", "a") == 0
    for a, b in (("abc", "acb"), ("", "x"), ("one two", "two one three")):
        assert similarity.ratio(a, b) == similarity.ratio(b, a) and 0 <= similarity.weighted_ratio(a, b) <= 100


MAPPING = "server_id string, stream_id string, category_id string, category_name string, channel_name string, action string, source string, selected_epg_id string, chosen_feed string, row_idx long"


def raw(spark, rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], MAPPING)


def registry(spark):
    text = json.dumps({"schemaVersion": 1, "sources": [{"name": "us1", "region": "US"}, {"name": "IN1", "region": "IN", "useForMatching": "no"}, {"name": "DUMMY_CHANNELS", "region": "ALL", "kind": "dummy"}, {"name": "off", "region": "US", "enabled": False}]})
    return catalog.registry_table(spark, catalog.parse_registry(text))


def test_mapping_rules(spark):
    rows = raw(spark, [
        ("", "1", "c", "C", "One", "APPROVED", "", "One.us", "us1"), ("s", " 1 ", "c", "C", "One b", "MANUAL", None, "One.us", "us1"), ("t", "2", "c", "C", "Other", "MANUAL", "", "x", "US1"),
        ("s", "3", "c", "C", "Three", "review", "", "x", "US1"), ("s", "4", "c", "C", "Four", "NO_EPG_DUMMY", "", "Blank", "DUMMY_CHANNELS"), ("s", "5", "c", "C", "Five", "OK", "", "p5", "Server XMLTV.php"),
        ("s", "6", "c", "C", "", "OK", "", "p6", "US1"), ("s", "7", "c", "C", "Seven", "IGNORE", "", "p7", "US1"),
    ])
    got = {r.stream_id: r for r in mapping.prepare_mapping(rows, "s", registry(spark)).collect()}
    assert sorted(got) == ["1", "4", "5", "7"] and got["1"].channel_name == "One b"
    assert [got[k].source for k in "145"] == ["epgshare", "dummy", "panel"] and [got[k].feed_key for k in "145"] == ["US1", "DUMMY_CHANNELS", "PANEL"]
    assert got["4"].dummy and not got["1"].dummy
    assert sorted(r.stream_id for r in export.prepare_export(rows, "s", []).collect()) == ["1", "4", "5"]
    with pytest.raises(ValueError, match="not registered"):
        mapping.prepare_mapping(raw(spark, [("s", "1", "c", "C", "One", "OK", "", "x", "nope")]), "s", registry(spark))
    with pytest.raises(ValueError, match="no usable"):
        mapping.prepare_mapping(raw(spark, [("s", "1", "c", "C", "One", "SKIP", "", "x", "US1")]), "s", registry(spark))


def test_registry_errors(spark):
    for bad in ({"schemaVersion": 2}, {"schemaVersion": 1, "sources": [{"name": "a"}]}, {"schemaVersion": 1, "sources": [{"name": "a", "region": "x"}, {"name": "A", "region": "y"}]}, {"schemaVersion": 1, "sources": [{"name": "a", "region": "x", "xmlUrl": "http://u:p@h/"}]}, {"schemaVersion": 1, "sources": [{"name": "a", "region": "x", "enabled": "maybe"}]}):
        with pytest.raises(ValueError):
            catalog.parse_registry(json.dumps(bad))
    assert json.loads(catalog.registry_json(registry(spark)))["sources"][0]["name"] == "DUMMY_CHANNELS"
    assert catalog.normalize_api_list({"data": [{"a": 1}, 2]}) == [{"a": 1}] and catalog.normalize_api_list({"1": {"a": 1}}) == [{"a": 1}] and catalog.normalize_api_list(3) == []
    assert catalog.normalize_api_list({"live_streams": [{"a": 1}], "channels": [{"b": 1}]}) == [{"a": 1}] and catalog.normalize_api_list({"x": 1, "y": {"a": 1}}) == []


def test_catalog(spark):
    text = spark.createDataFrame([("US1", "head -- more -- One.us Two.us One.us nodot BigNews.us"), ("IN1", "A.in"), ("DUMMY_CHANNELS", "Blank.Dummy.us")], "feed string, text string")
    rows = catalog.parse_catalog(text)
    assert sorted(r.epg_id for r in rows.where("feed = 'US1'").collect()) == ["BigNews.us", "One.us", "Two.us"]
    found = catalog.candidates(rows, registry(spark)).collect()
    assert {r.epg_id: r.display_name for r in found} == {"One.us": "One", "Two.us": "Two", "BigNews.us": "Big News"}
    assert catalog.dummies(rows, registry(spark)).first().epg_id == "Blank.Dummy.us"


def guide_file(path, name="g.xml.gz"):
    body = """<?xml version="1.0"?><tv><channel id="One.us"><display-name>One</display-name><icon src="file:///x"/><icon src="//h/one.png"/></channel><channel id="two"><display-name> Two </display-name></channel>
    <programme start="20240120000000 +0000" stop="20240120010000 +0000" channel="One.us"><title lang="de">Hallo</title><title lang="en">Hello   you</title></programme>
    <programme start="20240120010000 +0000" channel="one.us"><title>No stop</title></programme><programme start="bad" channel="One.us"><title>Bad</title></programme>
    <programme start="20240101000000" stop="20240101010000" channel="One.us"><title>Old</title></programme><programme start="20240120020000" stop="20240120030000" channel="One.us"><title>No Information</title></programme>
    <programme start="20240120000000" stop="20240120010000" channel="two"><title>Not wanted</title></programme></tv>"""
    (path / name).write_bytes(gzip.compress(body.encode()) if name.endswith(".gz") else body.encode())
    return str(path / name)


def test_guide_end_to_end(spark, tmp_path):
    path = guide_file(tmp_path)
    xmltv.check_guide(spark, path)
    programmes = xmltv.read_programmes(spark, path, "US1").cache()
    assert programmes.count() == 6 and programmes.where("title = 'Hello you'").count() == 1
    wanted = spark.createDataFrame([("US1", "ONE.US")], "feed string, epg_id string")
    window = guide.programme_window(programmes, NOW - 3 * 86400, wanted)
    assert sorted(tuple(r) for r in window.collect()) == [("US1", "ONE.US", NOW, NOW + 3600, "Hello you"), ("US1", "ONE.US", NOW + 3600, NOW + 7200, "No stop")]
    quality = {r.epg_id: r for r in guide.panel_quality(spark.createDataFrame([("one.US",), ("gone",)], "epg_id string"), programmes, NOW).collect()}
    assert (quality["one.US"].status, quality["gone"].status) == ("USABLE", "NOT_IN_PANEL_XMLTV")
    assert (quality["one.US"].total_rows, quality["one.US"].informative_rows, quality["one.US"].live_rows, quality["one.US"].placeholder_rows, quality["one.US"].invalid_rows) == (5, 3, 2, 1, 1)
    channels = xmltv.read_channels(spark, path, "US1")
    assert xmltv.source_icons(channels, wanted).first().url == "https://h/one.png"
    rows = raw(spark, [("s", "1", "c", "C", "Ch <1>", "OK", "", "ONE.US", "US1"), ("s", "2", "c", "C", "Ch 2", "OK", "", "gone", "US1")])
    prepared = mapping.prepare_mapping(rows, "s", registry(spark))
    order = spark.createDataFrame([("US1", 1)], "feed string, rank int")
    keyed = guide.effective_keys(prepared, guide.canonical_schedules(prepared, window, order, NOW))
    entries, conflicts = guide.output_entries(keyed, window)
    assert {r.channel_id: r.priority for r in entries.collect()} == {"Ch <1>": 250, "ONE.US": 400} and conflicts.count() == 0
    assert guide.missing_ids(prepared, window).first().channel_names == "Ch 2"
    out = tmp_path / "out.xml.gz"
    digest = publish.write_guide(out, entries, window, spark.createDataFrame([("ONE.US", "https://i/x.png")], "output_id string, url string"))
    assert digest == publish.write_guide(tmp_path / "again.xml.gz", entries, window, spark.createDataFrame([("ONE.US", "https://i/x.png")], "output_id string, url string"))
    back = xmltv.read_programmes(spark, str(out), "x")
    assert back.count() == 4 and back.where(F.col("epg_id") == "Ch <1>").count() == 2
    assert b'<icon src="https://i/x.png"/>' in gzip.decompress(out.read_bytes())
    ids = xmltv.read_channels(spark, str(out), "x")
    counts = guide.validate_guide(ids, back.withColumnRenamed("epg_id", "channel_id")).first()
    assert (counts.channels, counts.programmes, counts.undeclared_programmes, counts.repeated_channels) == (2, 4, 0, 0)
    keys = export.stream_keys(export.prepare_export(rows, "s", []), ids)
    payload = export.payload_programmes(export.app_programmes(keys, back.withColumnRenamed("epg_id", "channel_id"), NOW - 10, NOW + 3600))
    assert export.validate_payload(keys, payload).first().reversed == 0
    publish.write_payload(tmp_path / "app.json.gz", "s", "now", (NOW - 10, NOW + 3600), keys, payload, export.preserved({"schemaVersion": 9, "mine": 1}))
    data = json.loads(gzip.decompress((tmp_path / "app.json.gz").read_bytes()))
    assert data["mine"] == 1 and data["schemaVersion"] == 1 and data["streamToEpg"] == {"1": "ONE.US"} and data["programmes"] == {"ONE.US": [[NOW, NOW + 3600, "Hello you"]]}


def test_packages_and_public_folder(spark, tmp_path):
    rows = raw(spark, [("s", "1", "c", "C", "Ch 1", "OK", "", "ONE.US", "US1"), ("s", "2", "c", "C", "Ch 2", "OK", "", "gone", "US1"), ("s", "10", "d", "D", "Ch 10", "OK", "", "ONE.US", "US1")])
    programmes = spark.createDataFrame([("US1", "ONE.US", NOW + 3600 * k, NOW + 3600 * (k + 1), f"show {k}") for k in range(5)], "feed string, epg_id string, start long, stop long, title string")
    inventory = spark.createDataFrame([(str(k), c, c.upper(), f"Ch {k}", k) for k, c in ((1, "c"), (2, "c"), (3, "c"), (10, "d"))], "stream_id string, category_id string, category_name string, channel_name string, row_idx long")
    out, public = tmp_path / "s" / "output", tmp_path / "public"
    manifest = package.build_package(rows, "s", registry(spark), programmes, out, NOW, inventory=inventory)
    assert (manifest["mappedStreams"], manifest["mappedStreamsWithProgrammes"], manifest["catalogStreams"], manifest["xmltvChannels"], manifest["programmeRows"]) == (3, 2, 4, 3, 15)
    assert manifest["dataSha256"] == publish.sha256_file(out / manifest["dataFile"]) and json.loads((out / "s_guide_manifest.json").read_text()) == manifest
    assert (out / "s_missing_epg_ids.csv").read_text(encoding="utf-8-sig").splitlines()[1:] == ["US1,gone,1,Ch 2"]
    assert (out / "s_category_programme_coverage.csv").read_text(encoding="utf-8-sig").count("\n") == 3 and (tmp_path / "s" / "s_guide_output.zip").is_file()
    again = package.build_package(rows.repartition(3), "s", registry(spark), programmes.repartition(2), tmp_path / "again" / "output", NOW, inventory=inventory)
    assert {k: v for k, v in again.items() if k != "compressedBytes"} == {k: v for k, v in manifest.items() if k != "compressedBytes"}
    with pytest.raises(ValueError, match="no mapped id"):
        package.build_package(rows, "s", registry(spark), programmes.limit(0), tmp_path / "none", NOW)

    guide_rows = spark.createDataFrame([("ONE.US", NOW, NOW + 60, "a", 0), ("Ch 10", NOW, NOW + 60, "b", 1)], "channel_id string, start long, stop long, title string, pos long")
    app = package.write_app(rows, "s", guide_rows, tmp_path / "app", NOW, [], payload_extra={"mine": 1, "serverId": "x"}, manifest_extra={"theirs": 2})
    data = json.loads(publish.read_gzip(tmp_path / "app" / "s_epg.json.gz"))
    assert data["mine"] == 1 and data["serverId"] == "s" and list(data["streamToEpg"]) == ["1", "10"] and app["theirs"] == 2 and app["mappedStreams"] == 2
    assert package.read_preserved(tmp_path / "app", "s") == ({"mine": 1}, {"theirs": 2}) and package.read_preserved(tmp_path / "nowhere", "s") == ({}, {})

    package.clear_public(public)
    build = package.publish_server("s", out, public, manifest)
    package.write_index(public, [build], NOW)
    assert json.loads((public / "epg" / "index.json").read_text())["builds"] == [build] and "s_guide.xml.gz" in (public / "index.html").read_text()
    assert (public / "reports" / "s" / "s_refresh_plan.json").is_file() and json.loads((public / "health.json").read_text())["servers"] == 1
    (tmp_path / "logos").mkdir()
    for name in ("a.PNG", "b.exe"):
        (tmp_path / "logos" / name).write_text("x")
    assert package.stage_logos(tmp_path / "logos", public) == ["logos/a.PNG"] and package.stage_logos(tmp_path / "no", public) == []


def test_inventory_bundle(spark, tmp_path):
    report = spark.createDataFrame([("1", "c", "C", "One", "", "AUTO_EPGSHARE", "a", "F"), ("2", "c", "C", "Two", "p", "REVIEW", "b", "F"), ("3", "d", "D", "Three", "", "UNMATCHED", None, None)], "stream_id string, category_id string, category_name string, channel_name string, panel_epg_id string, action string, epg_id string, feed string")
    categories = spark.createDataFrame([("c", "C", ""), ("d", "D", "")], "category_id string, category_name string, parent_id string")
    got = package.inventory_bundle(report, categories, "s", registry(spark), tmp_path / "inventory")
    assert (got["channels"], got["safe_mapped_channels"], got["categories"], got["actions"]) == (3, 1, 2, {"AUTO_EPGSHARE": 1, "REVIEW": 1, "UNMATCHED": 1})
    assert (tmp_path / "inventory" / "output" / "unmatched.csv").read_text(encoding="utf-8-sig").count("\n") == 2


def test_digests(spark):
    rows = spark.createDataFrame([("a", 1), ("b", None), ("a", 1)], "x string, y int")
    digest = lambda df: mapping.mapping_digest(df, ["x", "y"]).first().digest
    assert digest(rows) == digest(rows.repartition(3)) != digest(rows.distinct()) and digest(rows.limit(0)) != digest(rows)
    c = spark.createDataFrame([(0, "F", "US", "a"), (1, "F", "US", "b")], "catalog_pos long, feed string, region string, epg_id string")
    d = spark.createDataFrame([("x", "X")], "id_folded string, epg_id string")
    other = c.withColumn("catalog_pos", 1 - F.col("catalog_pos"))
    assert package.catalogue_digest(c, d) == package.catalogue_digest(c.repartition(2), d) != package.catalogue_digest(other, d)


def test_bad_guides_are_refused(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<html><body>error</body></html>")
    (tmp_path / "b.xml").write_bytes(gzip.compress(b"<tv></tv>"))
    for name in ("a.xml", "b.xml"):
        with pytest.raises(ValueError):
            xmltv.check_guide(spark, str(tmp_path / name))
    (tmp_path / "c.xml").write_text('<tv><programme start="20240120000000" channel="a"><title>T</title></programme><programme start="2024')
    assert xmltv.read_programmes(spark, str(tmp_path / "c.xml"), "f").count() == 1


def test_misnamed_guides_missing_catalogues_and_regions(spark, tmp_path):
    (tmp_path / "b.xml").write_bytes(gzip.compress(b'<tv><programme start="20240120000000" channel="a"><title>T</title></programme></tv>'))
    path = xmltv.staged(spark, str(tmp_path / "b.xml"))
    assert path.endswith(".gz") and xmltv.read_programmes(spark, path, "f").count() == 1 and xmltv.staged(spark, path) == path
    (tmp_path / "c.txt").write_text("A.us B.us")
    skipped = []
    assert catalog.read_catalogs(spark, {"X": str(tmp_path / "c.txt"), "Y": str(tmp_path / "none.txt")}, skipped).count() == 2 and skipped == ["Y"]
    with pytest.raises(ValueError, match="no catalogue"):
        catalog.read_catalogs(spark, {"Y": str(tmp_path / "none.txt")}, [])
    sources = catalog.register([], {"source_code": "US1", "region": "us", "match_keywords": "Us, usa "}, base="https://h/x/")
    sources = catalog.register(sources, {"name": "d", "kind": "dummy", "region": "DUMMY", "xml_url": "https://h/d"})
    assert [(x["name"], x["ordinal"], x["txt_url"]) for x in sources] == [("US1", 0, "https://h/x/US1.txt"), ("D", 1, "")]
    with pytest.raises(ValueError, match="twice"):
        catalog.register(sources, {"source_code": "us1", "region": "UK"})
    assert [x["region"] for x in catalog.register(sources, {"name": "us1", "region": "UK"}, overwrite=True)] == ["DUMMY", "UK"]
    table = catalog.registry_table(spark, sources)
    assert [r[0] for r in catalog.active_regions(table).collect()] == ["US"] and {tuple(r) for r in catalog.region_keywords(table).collect()} == {("US", "us"), ("US", "usa")}
    assert catalog.base_address(" https://h:8/player_api.php ") == "https://h:8" and catalog.server_id(" s_1 ") == "s_1" and catalog.with_cache_buster("u?a=1", 5) == "u?a=1&t=5"
    for bad in ("ftp://h", "https://me:pw@h", "https://h/?q", "h"):
        with pytest.raises(ValueError):
            catalog.base_address(bad)
    with pytest.raises(ValueError):
        catalog.server_id("s", ["t"])
    named = catalog.with_category_names(spark.createDataFrame([("1", " c "), ("2", "x")], "stream_id string, category_id string"), spark.createDataFrame([("c", "C")], "category_id string, category_name string"))
    assert {r.stream_id: r.category_name for r in named.collect()} == {"1": "C", "2": ""}
    icons_of = spark.createDataFrame([("file:x", "https://h/a.png"), (None, None)], "icon_url string, logo string")
    assert [r[0] for r in icons_of.select(icons.mapping_icon(icons_of.columns)).collect()] == ["https://h/a.png", None]


def test_csv_and_missing_mappings(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿server_id,stream_id\n,007\n")
    row = catalog.read_mappings(spark, str(tmp_path), ["s"])["s"].first()
    assert (row.server_id, row.stream_id) == ("", "007")
    with pytest.raises(FileNotFoundError, match="x.csv.*y.csv"):
        catalog.read_mappings(spark, str(tmp_path), ["x", "y"])


def test_refresh(spark):
    stats = spark.createDataFrame([("A", 2, 2, NOW + 90_000), ("B", 1, 1, NOW + 50_000)], "feed string, ids long, future_ids long, earliest_id_end long")
    r = guide.refresh_plan(stats, NOW).first()
    assert (r.limiting_feed, r.refresh_at) == ("B", NOW + 50_000 - 43_200)
    assert guide.refresh_plan(stats.withColumn("future_ids", F.lit(0)), NOW).first().refresh_at == NOW
    assert guide.refresh_plan(stats.limit(0), NOW).first().refresh_at == NOW
    assert guide.refresh_due(None, NOW) and guide.refresh_due(NOW - 73 * 3600, NOW) and not guide.refresh_due(NOW - 4 * 3600, NOW) and guide.refresh_due(NOW, NOW, forced=True)


CANDIDATES = "epg_id string, feed string, region string, source_priority int"
RULES = "pos int, region string, pattern string, category_pattern string, epg_ids array<string>"
SPECIAL = "pos int, pattern string, dummy_name string"


def resolved(spark, channels, candidates, alias_rows=(), rules=(), special=(), usable=(), **options):
    """stream_id: row of resolve() for channels (stream_id, channel_name, category_name, panel_epg_id) and candidates (epg_id, feed, region)."""
    c = spark.createDataFrame([(*x, 10) for x in candidates], CANDIDATES)
    q = spark.createDataFrame(channels, "stream_id string, channel_name string, category_name string, panel_epg_id string")
    dummies = spark.createDataFrame([("Blank", "Blank.d"), ("PPV", "PPV.d"), ("Movie", "Movie.d"), ("Event", "Event.d")], "name string, epg_id string")
    known = aliases.aliases(spark.createDataFrame([(*x, k) for k, x in enumerate(alias_rows)], "alias string, regions string, epg_ids string, timeshift_epg_ids string, required_languages string, row_idx int"))
    tables = spark.createDataFrame(list(rules), RULES), spark.createDataFrame(list(special), SPECIAL), spark.createDataFrame([(x, "USABLE") for x in usable], "epg_id string, status string")
    return {r.stream_id: r for r in resolve.resolve(q, c, dummies, known, *tables, **options).collect()}


def test_resolution_waterfall(spark):
    names = ["Alpha.One.us", "Alpha.One.West.us", "Alpha.Two.us", "Movie.Plus.us", "Cartoon.World.us", "History.Vault.us"]
    channels = [("1", "Alpha One HD"), ("2", "Alpha One West"), ("3", "##### SPORTS #####"), ("4", "Old Alias"), ("5", "PPV Event 12"), ("6", "Cartoon Worldd"), ("8", "Nothing Like It"), ("10", "Alpha Three"), ("11", "Kept"), ("12", "One Alpha"), ("13", "AlphaOne"), ("14", "Sports Movies 5"), ("15", "xxx")]
    got = resolved(spark, [(k, n, "USA", "p11" if k == "11" else None) for k, n in channels], [(n, "US1", "US") for n in names], [("old alias", "", "gone|Movie.Plus.us", "", "")], special=[(0, "^ppv ", "PPV"), (1, "^xxx", None)], usable=["P11"])
    want = {"1": "Alpha.One.us", "2": "Alpha.One.West.us", "3": "Blank.d", "4": "Movie.Plus.us", "5": "PPV.d", "6": "Cartoon.World.us", "8": None, "11": "p11", "12": "Alpha.One.us", "14": "Movie.d", "15": None}
    assert {k: got[k].epg_id for k in want} == want
    methods = {"1": "canonical_identity", "3": "heading_placeholder", "4": "approved_knowledge", "5": "safety_rule", "6": "near_exact_orthography", "11": "panel", "12": "token_multiset", "14": "synthetic_numbered_genre_slot", "15": "safety_rule"}
    assert {k: got[k].method for k in methods} == methods and got["15"].action == "UNMATCHED"
    assert got["10"].action in ("REVIEW", "UNMATCHED") and got["13"].epg_id == "Alpha.One.us"


def test_waterfall_of_the_reference_cases(spark):
    """Wrappers, markets and languages: the Indian package, its North American editions, and what must not be matched."""
    catalogue = [("PTC.PUNJABI.in", "IN4", "IN"), ("PTC.Punjabi.TV.ca2", "CA2", "CA"), ("PTC.PUNJABI.GOLD.in", "IN4", "IN"), ("PTC.Simran.in", "IN4", "IN"), ("PTC.CHAK.DE.in", "IN4", "IN"), ("MH.ONE.in", "IN4", "IN"), ("KTV.in", "IN4", "IN"), ("KTV.HD.in", "IN4", "IN"), ("Discovery.Science.in", "IN4", "IN"), ("USA.Network.East.us2", "US2", "US"), ("HBO2.us2", "US2", "US"), ("News.Nation.in", "IN4", "IN")]
    cases = {
        "PB: PTC PUNJABI": "PTC.PUNJABI.in", "PB | PTC PUNJABI | USA": "PTC.Punjabi.TV.ca2", "PB: PTC PUNJABI USA HD": "PTC.Punjabi.TV.ca2", "PB: PTC Punjabi Gold HD": "PTC.PUNJABI.GOLD.in", "PB: PTC SIMRAN": "PTC.Simran.in", "PB: PTC CHAKDE": "PTC.CHAK.DE.in",
        "PB: MH ONE": "MH.ONE.in", "PB: NEWS NATION PUNJABI": "News.Nation.in",
    }
    channels = [(n, n, "PUNJABI", None) for n in cases] + [("ktv", "TM: KTV FHD (usa)", "TAMIL | MOVIES", None), ("sci", "IN: Discovry Sciense", "INDIA | DOCUMENTARY", None), ("usa", "USA Network East", "USA", None), ("hbo", "HBO", "USA", None), ("no", "Kanal 5", "NORWAY", None), ("kept", "Kanal 6", "NORWAY", "panel.id")]
    got = resolved(spark, channels, catalogue, usable=["panel.id"])
    assert {n: got[n].epg_id for n in cases} == cases and {got[n].action for n in cases} == {"AUTO_EPGSHARE"}
    assert got["PB: NEWS NATION PUNJABI"].method == "category_language_equivalence"
    assert got["ktv"].regions == ["US", "CA"] and got["ktv"].action != "AUTO_EPGSHARE"
    assert got["sci"].action != "AUTO_EPGSHARE" and got["usa"].epg_id == "USA.Network.East.us2" and got["hbo"].action != "AUTO_EPGSHARE"
    assert got["no"].method == "unsupported_catalog_scope" and got["kept"].action == "KEEP_PANEL"


def test_aliases_of_shifts_languages_and_markets(spark):
    known = [("discovery turbo", "UK", "Discovery.HD.uk", '{"+1": "Discovery+1.uk"}', ""), ("tv9 news", "IN", "VIP.News.in", "", "gujarati"), ("discovery turbo", "uk", "Discovery.uk", '{"1": "Other+1.uk"}', "")]
    catalogue = [("Discovery.HD.uk", "UK1", "UK"), ("Discovery+1.uk", "UK1", "UK"), ("VIP.News.in", "IN1", "IN")]
    channels = [("1", "UK: Discovery Turbo", "UK", None), ("2", "UK: Discovery Turbo +1", "UK", None), ("3", "TV9 News", "GUJARATI", None), ("4", "TV9 News", "TAMIL", None), ("5", "US: Discovery Turbo", "USA", None)]
    got = resolved(spark, channels, catalogue, known, review=False)
    assert {k: r.epg_id for k, r in got.items()} == {"1": "Discovery.HD.uk", "2": "Discovery+1.uk", "3": "VIP.News.in", "4": None, "5": None}
    merged = aliases.aliases(spark.createDataFrame([(*x, k) for k, x in enumerate(known)], "alias string, regions string, epg_ids string, timeshift_epg_ids string, required_languages string, row_idx int"))
    rows = {r.alias: r for r in merged.collect()}
    assert len(rows) == 2 and rows["discovery turbo"].epg_ids == ["Discovery.HD.uk", "Discovery.uk"] and rows["discovery turbo"].timeshift_epg_ids == {"1": ["Discovery+1.uk", "Other+1.uk"]}
    again = aliases.aliases(aliases.alias_table(merged), order="pos")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_approved_memory_round_trip(spark):
    mapping_rows = spark.createDataFrame([("s1", "55", "PUNJABI", "PB: My Provider PTC", "APPROVED", "epgshare", "PTC.PUNJABI.in", 0), ("s1", "56", "PUNJABI", "PB: Other", "REVIEW", "epgshare", "x.in", 1), ("s1", "57", "PUNJABI", "PB: Third", "APPROVED", "panel", "y", 2)], "server_id string, stream_id string, category_name string, channel_name string, action string, source string, epg_id string, row_idx int")
    memory = aliases.approved_memory(mapping_rows, spark.createDataFrame([("PTC.PUNJABI.in", "IN")], "epg_id string, region string"))
    assert [tuple(r)[:3] for r in memory.collect()] == [("my provider ptc", "IN", "PTC.PUNJABI.in")] and not {"stream_id", "server_id"} & set(memory.columns)
    found = [tuple(r)[:3] for r in memory.collect()]
    got = resolved(spark, [("1", "PB: My Provider PTC", "PUNJABI", None)], [("PTC.PUNJABI.in", "IN4", "IN")], [(*x, "", "") for x in found])
    assert (got["1"].epg_id, got["1"].method, got["1"].action) == ("PTC.PUNJABI.in", "approved_knowledge", "AUTO_EPGSHARE")


def test_equivalence_group_reader(spark, tmp_path):
    path = str(tmp_path / "groups.json")
    with open(path, "w") as f:
        json.dump({"scheduleEquivalenceGroups": ["a.us|b.us", {"ids": ["c", "d", "c"]}, ["alone"]]}, f)
    got = aliases.equivalence_groups(spark, path).collect()
    assert {r.epg_id for r in got} == {"a.us", "b.us", "c", "d"} and len({r.label for r in got}) == 2
    assert aliases.equivalence_groups(spark, [["B.us", "A.us"]]).first().label == next(r.label for r in got if r.epg_id == "a.us")
    assert aliases.equivalence_groups(spark, {}).collect() == []


@pytest.mark.parametrize(
    ("category", "name", "core", "plan", "wrapper"),
    [
        ("PUNJABI", "PBHD: PTC PUNJABI", "PTC PUNJABI", ["IN"], "PBHD"), ("PUNJABI", "PB-PTC PUNJABI", "PTC PUNJABI", ["IN"], "PB"), ("PUNJABI", "USA PTC PUNJABI", "PTC PUNJABI", ["US", "CA"], "USA"), ("PUNJABI", "US_PTC PUNJABI", "PTC PUNJABI", ["US", "CA"], "US"),
        ("TELUGU", "D2H: ETV TELUGU HD", "ETV TELUGU HD", ["IN"], "D2H"), ("TELUGU", "D 2 H: ETV TELUGU HD", "ETV TELUGU HD", ["IN"], "D 2 H"), ("PUNJABI", "TATA PLAY: PTC PUNJABI HD", "PTC PUNJABI HD", ["IN"], "TATA PLAY"),
        ("USA", "USA Network East", "USA Network East", ["US"], None), ("AS | TAMIL", "TAM - KTV", "KTV", ["IN"], "TAM"), ("NA | CANADA", "Fox Sports 1 (FS1) [EN]", "Fox Sports 1", ["CA"], None), ("", "Kanal 5", "Kanal 5", [], None),
    ],
)
def test_names_lose_their_wrappers(category, name, core, plan, wrapper):
    got = names.Reader().channel(name, category)
    assert (got["core"], got["plan"]) == (core, plan) and (wrapper is None and got["wrappers"] == [] or wrapper in got["wrappers"])


def test_words_keys_and_marks_of_names():
    read = names.Reader()
    assert read.words("HBO2 4K+1 H265 News18 Chakde Sci two") == ["hbo", "2", "4k", "plusshift1", "h265", "news18", "chak", "de", "science", "2"]
    assert read.key("GAME+ Game Plus HD") == "game plus" and read.key("The Movie Channel", relaxed=True) == "movies"
    assert "fox sports 1" in read.identity_keys("Fox Sports 1 FS 1") and read.bag_key("Times Punjabi TV") == "punjab time"
    marks = read.marks("Show East +1 UHD 7 News")
    assert (marks["direction"], marks["shift"], marks["numbers"], marks["content"], marks["quality"]) == ("east", 1, ["7"], ["news"], "uhd")
    assert read.is_heading("### A ###") and not read.is_heading("## A ##") and read.is_heading("=-*#~=#*=* x") and not read.is_heading("**")
    assert read.numbered_slot("Tamil Cinema 12", "TAMIL | MOVIES", ["tamil", "cinema", "12"]) == "movie" and read.numbered_slot("Fox Sports 1", "SPORTS", ["fox", "sports", "1"]) == ""
    assert read.prefix("ENG - Sky") == "eng" and read.prefix("### x: y") == ""


def test_banks_and_prefixes_of_an_inventory(spark):
    rows = [(str(k), "c", f"Cinema Box {k}", "MOVIES") for k in (1, 2, 3)] + [(str(k), "c", f"ABC: Station {k} News", "MOVIES") for k in (10, 11)] + [("20", "d", "Sky 1", "UK"), ("21", "d", "Sky 2", "UK")]
    read = resolve.read_channels(spark.createDataFrame(rows, "stream_id string, category_id string, channel_name string, category_name string"))
    assert {r.stream_id: (r.role, r.slots) for r in resolve.bank_signals(read).collect()} == {k: ("movie", 3) for k in "123"}
    assert {r.stream_id: r.core for r in read.collect()}["10"] == "Station 10 News"  # ABC stands before 40 % of the category's names


def test_match_report_has_all_columns(spark):
    catalogue = [("Alpha.One.us", "US1", "US"), ("Alpha.One.HD.us", "US2", "US")]
    c = spark.createDataFrame([(*x, 10 + k) for k, x in enumerate(catalogue)], CANDIDATES)
    q = spark.createDataFrame([("1", "7", "NA | USA", "US: Alpha One", None), ("2", "7", "NA | USA", "Zeta", "p"), ("3", "8", "", "Nothing", "")], "stream_id string, category_id string, category_name string, channel_name string, panel_epg_id string")
    none = lambda schema: spark.createDataFrame([], schema)
    known = aliases.aliases(none("alias string, epg_ids string, row_idx int"))
    found = resolve.resolve(q, c, none("name string, epg_id string"), known, none(RULES), none(SPECIAL), spark.createDataFrame([("p", "USABLE")], "epg_id string, status string"), details=True)
    quality = spark.createDataFrame([("P", "USABLE", 4, NOW)], "epg_id string, status string, live_rows long, latest_stop long")
    report = resolve.match_report(found, c, quality, "s")
    assert report.columns == resolve.REPORT
    got = {r.stream_id: r for r in report.collect()}
    assert (got["1"].epg_id, got["1"].second_epg_id, got["1"].second_epg_feed, got["1"].best_score, got["1"].score_margin, got["1"].provider_wrappers, got["1"].category_namespace, got["1"].detected_region) == ("Alpha.One.us", "Alpha.One.HD.us", "US2", 100.0, 0.0, "US", "NA", "US")
    assert (got["2"].action, got["2"].panel_usable_programmes, got["2"].panel_latest_stop_utc, got["2"].best_score) == ("KEEP_PANEL", 4, "2024-01-20T00:00:00Z", None)
    assert (got["3"].action, got["3"].panel_epg_status, got["3"].route_plan, got["3"].inventory_role) == ("UNMATCHED", "NO_PANEL_ID", "ALL", "linear")


def test_call_signs_and_extensions(spark):
    catalogue = [("KABC-DT.Los.Angeles.us_locals1", "US1", "US"), ("KSHB-DT.us_locals1", "US1", "US"), ("Khabar.Bihar.Jharkhand.Himachal.in", "IN1", "IN")]
    channels = [("1", "Seven Eyewitness (KABC) Southland", "USA", None), ("2", "KSHB-DT3 Retro Reruns Forever", "USA", None), ("3", "Zebra KIDS Unrelated Words", "USA", None), ("4", "Khabar Bihar Jharkhand HD", "INDIA", None), ("5", "Khabar Bihar", "INDIA", None), ("6", "Seven Eyewitness (KABC) Southland", "USA", "p"), ("7", "Nine KSHB-TV", "USA", None)]
    got = resolved(spark, channels, catalogue, usable=["p"])
    assert (got["1"].epg_id, got["1"].method) == ("KABC-DT.Los.Angeles.us_locals1", "verified_station_identity") and got["7"].epg_id == "KSHB-DT.us_locals1"
    assert (got["4"].epg_id, got["4"].method) == ("Khabar.Bihar.Jharkhand.Himachal.in", "regional_catalog_extension")
    assert got["6"].action == "KEEP_PANEL" and all(got[k].action in ("REVIEW", "UNMATCHED") for k in "235")


def test_gate_of_numbers_and_directions(spark):
    said = [("Movies", "Movies 2"), ("Movies 2", "Movies"), ("Movies East", "Movies"), ("Movies", "Movies East"), ("Movies West", "Movies"), ("Movies 2", "Movies 3"), ("Movies +1", "Movies"), ("Movies Gold", "Movies")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(said)], "k int, a string, b string")
    q, c = resolve.with_keys(df, "a").alias("q"), resolve.with_keys(df, "b").alias("c")
    met = q.join(c, (F.col("q.k") == F.col("c.k")) & resolve.compatible("q", "c")).select("q.k").collect()
    assert {r.k for r in met} == {1, 2}


def test_groups_by_rare_titles_are_those_of_all_pairs(spark):
    chance = random.Random(6)
    rows = set()
    for k in range(40):
        base = random.Random(k // 4)
        for hour in range(chance.randint(8, 14)):
            title = "news" if hour % 3 == 0 else f"show {base.randrange(60)}"
            rows.add((f"id{k}", hour * 2 + (chance.random() < 0.2), title if chance.random() < 0.95 else "changed"))
    prints = spark.createDataFrame(sorted(rows), "epg_id string, bucket long, title string")
    for least in (0.5, 0.8, 0.92):
        every = {(r.a, r.b) for r in equivalence.schedule_similarity(prints, 1).where(F.col("similarity") >= least).collect()}
        some = {(r.a, r.b) for r in equivalence.schedule_similarity(prints, 1, equivalence.candidate_pairs(prints, least)).where(F.col("similarity") >= least).collect()}
        assert some == every and (every or least > 0.9)


def test_greedy_similarity(spark):
    prints = spark.createDataFrame([("A", 1, "t"), ("A", 2, "t"), ("B", 0, "t"), ("B", 1, "t"), ("C", 1, "t"), ("C", 3, "t")], "epg_id string, bucket long, title string")
    got = {(r.a, r.b): r.same for r in equivalence.schedule_similarity(prints, 1).collect()}
    assert got == {("A", "B"): 1, ("A", "C"): 2, ("B", "C"): 1}


def test_fuzzy_candidates_are_all_pairs(spark):
    chance = random.Random(4)
    words = ["red", "blue", "bolt", "rod", "eurosport", "eurosprt", "sports", "sport", "movies", "tv5", "é", "a", "news", "newsroom"]
    name = lambda: " ".join(chance.choice(words) for _ in range(chance.choice([1, 1, 2, 2, 3, 7])))
    q = [("red bolt", ["A", "B"]), ("eurosprt", ["A"]), *((name(), [chance.choice("AB")]) for _ in range(150))]
    c = [("A", "blue rod"), ("B", "blue rod"), ("A", "eurosport"), *((chance.choice("AB"), name()) for _ in range(300))]
    channels = spark.createDataFrame([(k, n, r) for k, (n, r) in enumerate(q)], "stream_id int, name string, regions array<string>")
    got = resolve.fuzzy_candidates(channels, spark.createDataFrame(c, "region string, name string"), limit=9, key="name").collect()
    want = set()
    for k, (n, regions) in enumerate(q):
        for region in regions:
            scores = sorted((-similarity.weighted_ratio(n, x), x) for x in {x for r, x in c if r == region})
            want |= {(k, region, x, -s, place) for place, (s, x) in enumerate([y for y in scores if -y[0] >= 58][:9], 1)}
    assert {(r.stream_id, r.region, r.candidate_key, r.rough, r.place) for r in got} == want and len(got) == len(want)
    some = spark.createDataFrame([("A", "blue rod"), ("B", "eurosport")], "region string, name string")
    assert [(r.region, r.candidate_key) for r in resolve.fuzzy_candidates(channels.limit(1), some, key="name").collect()] == [("A", "blue rod")]


def test_equivalence(spark):
    rows = [(i, NOW + 3600 * k + shift, NOW + 3600 * (k + 1), f"show {k if i != 'C' else k + 50}") for i, shift in (("A", 0), ("B", 290), ("C", 0)) for k in range(10)]
    p = spark.createDataFrame(rows, "epg_id string, start long, stop long, title string")
    prints = equivalence.fingerprints(p, NOW)
    assert [(r.a, r.b, r.similarity) for r in equivalence.schedule_similarity(prints).collect()] == [("A", "B", 1.0)]
    assert [r.members for r in equivalence.group_labels(equivalence.equivalence_groups(prints)).collect()] == [["a", "b"]]
    assert {r.epg_id: r["rows"] for r in equivalence.fingerprint_summary(prints, spark.createDataFrame([("A",), ("Z",)], "epg_id string")).collect()} == {"A": 10, "Z": 0}


def test_icons(spark):
    for url, want in {"https://h/x.png": "https://h/x.png", "//h/x": "https://h/x", "ftp://h/x": None, "http://u:p@h/x": None, "file:///x": None, "http://h/a b": None, "": None}.items():
        assert one(spark, url, icons.safe_url) == want
    for path, want in {"a/b.png": "a/b.png", "../x.png": None, "/x.png": None, "x.exe": None, "a\\b.JPG": "a/b.JPG", "c:x.png": None}.items():
        assert one(spark, path, icons.safe_file) == want
    o = spark.createDataFrame([("yes", "*", "one.us", "", "https://a/1.png", "", "5", 0), ("yes", "s", "", "Ch One", "https://a/2.png", "", "", 1), ("no", "s", "one.us", "", "https://a/3.png", "", "", 2), ("", "s", "two", "", "", "l o/x.png", "", 3)], "enabled string, server_id string, epg_id string, channel_name string, icon_url string, local_file string, priority string, row_idx long")
    table = icons.icon_overrides(o, "https://pub/")
    p = spark.createDataFrame([("One.us", "Ch  One", "US1", False), ("Two", "Dummy", "D", True)], "epg_id string, channel_name string, feed_key string, dummy boolean")
    got = {r.output_id: r.url for r in icons.resolve_icons(p, "s", table, spark.createDataFrame([], "feed string, epg_id string, url string")).collect()}
    assert got == {"One.us": "https://a/2.png", "Ch  One": "https://a/2.png", "Dummy": "https://pub/logos/l%20o/x.png"}


def test_conflicts_keep_or_replace(spark):
    rows = [(0, "Name", "A", "x", False, "1"), (1, "Name", "D", "y", True, "2"), (2, "Name", "PANEL", "z", False, "3")]
    keyed = spark.createDataFrame([(k, n, f, e, d, s) for k, n, f, e, d, s in rows], "row_idx long, channel_name string, effective_feed string, epg_id string, dummy boolean, stream_id string")
    have = spark.createDataFrame([("A", "x"), ("D", "y"), ("PANEL", "z")], "feed string, epg_id string")
    entries, conflicts = guide.output_entries(keyed, have)
    assert {r.channel_id: r.feed for r in entries.collect()}["Name"] == "PANEL"
    assert {r.stream_id: r.resolution for r in conflicts.collect()} == {"2": "kept_existing", "3": "used_candidate"}


def test_streams(spark, tmp_path):
    from guidemill.streaming.guide import deduplicated

    rows = [("F", "a", NOW, NOW + 60, "t")] * 3 + [("F", "b", NOW, NOW + 60, "t")]
    spark.createDataFrame(rows, "feed string, epg_id string, start long, stop long, title string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("feed string, epg_id string, start long, stop long, title string").parquet(str(tmp_path / "in"))
    query = deduplicated(stream).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("seen").count() == 2
