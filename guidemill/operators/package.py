"""A server's whole output: guide, manifest, reports, compact export, inventory bundle, and the public folder with its index.

Rows stay in Spark and are streamed in order into the files; what the driver holds are counts and one line at a time.
"""

from __future__ import annotations

import csv
import hashlib
import html
import json
import shutil
import zipfile
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.operators import export, guide, icons, mapping, publish
from guidemill.sources.catalog import registry_json, registry_table

#: Endings of a server's reports that are made public: fixed values.
PUBLIC_REPORTS = ["_guide_manifest.json", "_validation.json", "_refresh_plan.json", "_next_refresh_utc.txt"]
#: Columns that take part in a mapping's digest: fixed values.
DIGEST_COLUMNS = ["server_id", "stream_id", "category_id", "category_name", "channel_name", "action", "source", "epg_id", "epg_feed", "reason"]


def utc(epoch: int) -> str:
    return datetime.fromtimestamp(epoch, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_json(path: Path, value: object) -> str:
    """The value as indented JSON; its SHA-256."""
    text = json.dumps(value, indent=2, ensure_ascii=False) + "\n"
    path.write_text(text, encoding="utf-8")
    return hashlib.sha256(text.encode()).hexdigest()


def write_csv(path: Path, df: DataFrame, *order: object) -> int:
    """One CSV file with a byte order mark, in the given order, lists joined by |; how many rows. Rows come a partition at a time."""
    flat = df.orderBy(*order) if order else df
    flat = flat.select(*[F.array_join(c, " | ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes])
    count = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        lines = csv.writer(out)
        lines.writerow(flat.columns)
        for count, row in enumerate(flat.toLocalIterator(), 1):
            lines.writerow(["" if x is None else x for x in row])
    return count


def catalogue_digest(candidates: DataFrame, dummies: DataFrame) -> str:
    """SHA-256 of what a catalogue holds and in which order: (catalog_pos, feed, region, epg_id) of candidates and (id_folded, epg_id) of dummies."""
    text = lambda *names: F.concat_ws("\x00", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    rows = candidates.select(F.lit("c").alias("kind"), text("catalog_pos", "feed", "region", "epg_id").alias("row")).union(dummies.select(F.lit("d"), text("id_folded", "epg_id")))
    return mapping.mapping_digest(rows, ["kind", "row"]).first()["digest"]


def export_digest(prepared: DataFrame) -> str:
    """SHA-256 of what an export is made from: stream, effective feed and id."""
    return mapping.mapping_digest(prepared, ["stream_id", "effective_feed", "effective_id"]).first()["digest"]


def build_package(rows: DataFrame, server_id: str, registry: DataFrame, programmes: DataFrame, folder: str | Path, now: int, past_days: int = 3, safety_hours: int = 12, inventory: DataFrame | None = None, overrides: DataFrame | None = None, source_icons: DataFrame | None = None) -> dict:
    """The files of one server below folder, and the manifest.

    rows: a mapping (read_text_csv). programmes: feed, epg_id, start, stop, title of all feeds, PANEL for the server's own. inventory: all channels (stream_id,
    category_id, category_name, channel_name, row_idx), for programme coverage by category. overrides, source_icons: see icons.resolve_icons(). No usable row, an unknown feed
    and a guide without any programme are errors."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    prepared = mapping.prepare_mapping(rows, server_id, registry).cache()
    wanted = prepared.select(F.col("feed_key").alias("feed"), "epg_id").distinct()
    window = guide.programme_window(programmes, now - past_days * 86_400, wanted).cache()
    order = registry.select(F.col("name").alias("feed"), (F.col("ordinal") + 1).alias("rank"))
    choices = guide.canonical_schedules(prepared, window, order, now)
    keyed = guide.effective_keys(prepared, choices).cache()
    entries, conflicts = guide.output_entries(keyed, window)
    entries = entries.cache()
    have = window.select(F.col("feed").alias("effective_feed"), "epg_id").distinct().withColumn("has_programmes", F.lit(True))
    final = keyed.join(have, ["effective_feed", "epg_id"], "left").withColumn("has_programmes", F.coalesce("has_programmes", F.lit(False)))
    if entries.isEmpty():
        raise ValueError(f"no mapped id of {server_id} has programmes in the window")
    found = None
    if overrides is not None or source_icons is not None:
        none = rows.sparkSession.createDataFrame([], "feed string, epg_id string, url string")
        found = icons.resolve_icons(keyed, server_id, overrides, source_icons if source_icons is not None else none).cache()

    data = out / f"{server_id}_guide.xml.gz"
    shown = found.select("output_id", "url") if found is not None else None
    digest = publish.write_guide(data, entries, window, shown)
    declared = entries.select("channel_id")
    said = entries.join(window, ["feed", "epg_id"]).select("channel_id", "title")
    checked = guide.validate_guide(declared, said).first().asDict()
    effective = [r[0] for r in final.where("has_programmes and not dummy").select("effective_feed").distinct().where(F.col("effective_feed") != "PANEL").orderBy("effective_feed").collect()]  # a row for each feed
    stats = guide.feed_stats(window, now)
    plan = guide.refresh_plan(stats.where(F.col("feed").isin(effective)), now, safety_hours).first().asDict()
    write_json(out / f"{server_id}_refresh_plan.json", plan)
    (out / f"{server_id}_next_refresh_utc.txt").write_text((plan["refresh_at_utc"] or "NOT_CALCULATED") + "\n")
    sources = registry_json(registry)
    (out / "epg_sources.json").write_text(sources)

    streams = final.agg(F.count("*").alias("mapped"), F.count_if("has_programmes").alias("with")).first()
    names = entries.agg(F.count("*").alias("all"), F.count_if(F.col("entry_type") == "channel_name").alias("names"), F.count_if(F.col("entry_type") == "canonical_epg_id").alias("ids")).first()
    repeated = guide.repeated_ids(prepared)
    resolutions = choices.join(repeated.select("epg_id"), "epg_id", "left_semi")
    conflict_rows = write_csv(out / f"{server_id}_channel_id_conflicts.csv", conflicts, "channel_id", "stream_id", "candidate_feed", "candidate_epg_id")
    resolved_rows = write_csv(out / f"{server_id}_canonical_id_feed_resolutions.csv", resolutions, "epg_id")
    manifest = {
        "format": "XMLTV", "serverId": server_id, "generatedAt": now, "generatedAtIso": utc(now), "windowStart": now - past_days * 86_400, "windowStartIso": utc(now - past_days * 86_400), "pastDaysRetained": past_days,
        "futurePolicy": "ALL_AVAILABLE_FROM_SOURCE_FILES", "windowEnd": None, "dataFile": data.name, "dataSha256": digest, "mappingSha256": mapping.mapping_digest(prepared, DIGEST_COLUMNS).first()["digest"], "compressedBytes": data.stat().st_size,
        "catalogStreams": inventory.count() if inventory is not None else streams["mapped"], "mappedStreams": streams["mapped"], "mappedStreamsWithProgrammes": streams["with"], "mappingProgrammeCoveragePercent": round(streams["with"] * 100.0 / streams["mapped"], 2),
        "uniqueSourceSchedulesRequested": wanted.count(), "uniqueSourceSchedulesWithProgrammes": window.select("feed", "epg_id").distinct().count(), "xmltvChannels": names["all"], "channelNameEntries": names["names"], "canonicalEpgIdEntries": names["ids"],
        "programmeRows": checked["programmes"], "channelIdConflicts": conflict_rows, "canonicalIdFeedConflictsDetected": repeated.count(), "canonicalIdFeedConflictsResolved": resolved_rows, "effectiveEpgShareFeeds": effective, "refreshEpgShareFeeds": effective,
        "epgSourceConfigFile": "epg_sources.json", "epgSourceConfigSha256": hashlib.sha256(sources.encode()).hexdigest(), "refreshPlan": plan, "trustedMappingUsed": False, "validation": checked,
    }
    if found is not None:
        with_icon = entries.join(found.select(F.col("output_id").alias("channel_id")), "channel_id", "left_semi").count()
        manifest |= {"channelsWithIcons": with_icon, "iconCoveragePercent": round(with_icon * 100.0 / names["all"], 2)}
        write_csv(out / f"{server_id}_icon_assignments.csv", found, "output_id")
    columns = [c for c in DIGEST_COLUMNS if c in final.columns]
    write_csv(out / f"{server_id}_final_mapping.csv", final.select(*columns, "feed_key", F.col("effective_feed").alias("effective_feed_key"), F.col("epg_id").alias("effective_epg_id"), "has_programmes"), "stream_id")
    write_csv(out / f"{server_id}_feed_coverage.csv", stats, "feed")
    available = final.where("has_programmes").select(F.col("feed_key").alias("feed"), "epg_id").distinct()
    write_csv(out / f"{server_id}_missing_epg_ids.csv", guide.missing_ids(prepared, available), "feed_key", "epg_id")
    write_csv(out / f"{server_id}_missing_future_epg_ids.csv", guide.missing_future(prepared, window, now), "feed_key", "epg_id")
    if inventory is not None:
        covered = mapping.programme_coverage(inventory, final.select("stream_id", "has_programmes"), "stream_id", ["category_id", "category_name"], "has_programmes", "row_idx")
        write_csv(out / f"{server_id}_category_programme_coverage.csv", covered, F.desc("programme_percent"), F.desc("channels"), "category_name")
    write_json(out / f"{server_id}_validation.json", checked)
    write_json(out / f"{server_id}_guide_manifest.json", manifest)
    lines = [f"Programme guide of {server_id}", "", f"Generated: {utc(now)}", f"Mapped streams: {streams['mapped']}, with programmes: {streams['with']}", f"Programme rows: {checked['programmes']}", f"Build again at: {plan['refresh_at_utc']}", "", f"{data.name} is all that a player needs. No address, name or password of the server is in any file."]
    (out / "README.txt").write_text("\n".join(lines) + "\n")
    zipped(out, out.parent / f"{server_id}_guide_output.zip")
    for df in (prepared, window, keyed, entries):
        df.unpersist()
    return manifest


def zipped(folder: Path, path: Path) -> None:
    """The files of a folder in one archive, in order of name."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(folder.iterdir()):
            if file.is_file():
                archive.write(file, file.name)


def write_app(rows: DataFrame, server_id: str, programmes: DataFrame, folder: str | Path, now: int, dummy_feeds: list[str], past_hours: int = 6, future_hours: int = 72, mapping_sha: str = "", payload_extra: dict | None = None, manifest_extra: dict | None = None) -> dict:
    """The compact export of a server from its mapping and its guide (channel_id, start, stop, title; pos: the order of channels), and its manifest.

    Keys of payload_extra and manifest_extra that the export has itself are its own."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    start, end = now - past_hours * 3600, now + future_hours * 3600
    prepared = export.prepare_export(rows, server_id, dummy_feeds)
    ids = programmes.groupBy("channel_id").agg(F.min("pos").alias("pos")) if "pos" in programmes.columns else programmes.groupBy("channel_id").agg(F.min("start").alias("pos"))
    keys = export.stream_keys(prepared, ids).cache()
    payload = export.payload_programmes(export.app_programmes(keys, programmes, start, end)).cache()
    checked = export.validate_payload(keys, payload).first().asDict()
    path = out / f"{server_id}_epg.json.gz"
    digest = publish.write_payload(path, server_id, now, (start, end), keys, payload, payload_extra)
    streams, without = checked["streams"], checked["without_programmes"]
    core = {
        "schemaVersion": 1, "serverId": server_id, "generatedAt": now, "generatedAtIso": utc(now), "windowStart": start, "windowEnd": end, "dataFile": path.name, "dataSha256": digest, "mappingSha256": mapping_sha or export_digest(prepared), "compressedBytes": path.stat().st_size,
        "mappedStreams": streams, "streamsWithProgrammes": streams - without, "coveragePercent": round((streams - without) * 100.0 / max(1, streams), 2), "uniqueSchedulesWithProgrammes": checked["ids"], "programmeRows": checked["programmes"],
    }
    write_json(out / f"{server_id}_epg_manifest.json", (manifest_extra or {}) | core)
    keys.unpersist()
    payload.unpersist()
    return (manifest_extra or {}) | core


#: Keys of an app manifest that the export writes: fixed values.
MANIFEST_KEYS = ["schemaVersion", "serverId", "generatedAt", "generatedAtIso", "windowStart", "windowEnd", "dataFile", "dataSha256", "mappingSha256", "compressedBytes", "mappedStreams", "streamsWithProgrammes", "coveragePercent", "uniqueSchedulesWithProgrammes", "programmeRows"]


def read_preserved(folder: str | Path, server_id: str) -> tuple[dict, dict]:
    """The keys of a server's last payload and manifest in a folder that aren't the export's own; none where a file is missing or can't be read."""
    out = []
    for name, opened in ((f"{server_id}_epg.json.gz", lambda p: publish.read_gzip(p)), (f"{server_id}_epg_manifest.json", lambda p: p.read_text(encoding="utf-8-sig"))):
        try:
            value = json.loads(opened(Path(folder) / name))
        except (OSError, ValueError, EOFError):
            value = {}
        out.append(export.preserved(value) if isinstance(value, dict) else {})
    return out[0], {k: v for k, v in out[1].items() if k not in MANIFEST_KEYS}


def inventory_bundle(report: DataFrame, categories: DataFrame, server_id: str, registry: DataFrame, folder: str | Path, quality: DataFrame | None = None) -> dict:
    """The slices of a match report as CSV files, a summary, and all in one archive.

    report: stream_id, category_id, category_name, channel_name, panel_epg_id, action, epg_id, feed and more; categories: category_id, category_name, parent_id."""
    root = Path(folder)
    if root.exists():
        shutil.rmtree(root)
    out = root / "output"
    out.mkdir(parents=True)
    rows = report.withColumns({"server_id": F.lit(server_id), "epg_feed": F.coalesce("feed", F.lit("")), "row_idx": F.monotonically_increasing_id()}).cache()
    action = F.col("action")
    safe = mapping.safe_mapping(rows)
    slices = {
        "all_channels_and_matches": rows.drop("row_idx", "epg_feed"),
        "channel_names_only": rows.select(*[c for c in ("server_id", "stream_id", "category_id", "category_name", "channel_number", "channel_name", "panel_epg_id", "panel_epg_status") if c in rows.columns]),
        "mapping_ready_for_test": safe.drop("row_idx"),
        "automatic_matches": rows.where(action.isin(mapping.SAFE)).drop("row_idx", "epg_feed"),
        "review_doubtful_matches": rows.where(action == "REVIEW").drop("row_idx", "epg_feed"),
        "unmatched": rows.where(action == "UNMATCHED").drop("row_idx", "epg_feed"),
    }
    counts = {name: write_csv(out / f"{name}.csv", df, "stream_id") for name, df in slices.items()}
    listed = write_csv(out / "categories.csv", categories.select(F.lit(server_id).alias("server_id"), "category_id", "category_name", "parent_id"), "category_id")
    coverage = mapping.category_coverage(rows, ["category_id", "category_name"], action.isin(mapping.SAFE), action == "REVIEW", action == "UNMATCHED")
    write_csv(out / "category_match_coverage.csv", coverage)
    usable = 0
    if quality is not None:
        write_csv(out / "panel_epg_quality.csv", quality, "epg_id")
        usable = quality.where("status = 'USABLE'").count()
    total = counts["all_channels_and_matches"]
    summary = {
        "server_id": server_id, "categories": listed, "channels": total, "safe_mapped_channels": counts["mapping_ready_for_test"], "safe_mapping_percent": round(counts["mapping_ready_for_test"] * 100.0 / max(1, total), 2),
        "panel_epg_ids_with_useful_future_information": usable, "actions": {r[0]: r[1] for r in mapping.action_histogram(rows).orderBy("action").collect()}, "active_epgshare_sources": registry.count(), "trusted_mapping_used": False,
    }
    (out / "epg_sources.json").write_text(registry_json(registry))
    write_json(out / "inventory_summary.json", summary)
    (out / "README.txt").write_text(f"Channels and matches of {server_id}: {total} channels, {summary['safe_mapped_channels']} mapped without review.\nmapping_ready_for_test.csv can be built from; review_doubtful_matches.csv needs a person.\n")
    zipped(out, root / f"{server_id}_inventory_and_matching.zip")
    rows.unpersist()
    return summary


def clear_public(folder: str | Path) -> None:
    out = Path(folder)
    if out.exists():
        shutil.rmtree(out)
    for name in ("epg", "reports"):
        (out / name).mkdir(parents=True)
    (out / ".nojekyll").write_text("")


def publish_server(server_id: str, folder: str | Path, public: str | Path, manifest: dict) -> dict:
    """Copies a server's guide and public reports; what the index says of it."""
    source, target = Path(folder), Path(public)
    data = source / manifest["dataFile"]
    if not data.is_file():
        raise FileNotFoundError(f"there is no {data}")
    shutil.copy2(data, target / "epg" / data.name)
    reports = target / "reports" / server_id
    reports.mkdir(parents=True, exist_ok=True)
    for ending in PUBLIC_REPORTS:
        if (source / f"{server_id}{ending}").is_file():
            shutil.copy2(source / f"{server_id}{ending}", reports)
    same = {k: manifest.get(k) for k in ("generatedAtIso", "mappedStreams", "mappedStreamsWithProgrammes", "programmeRows")}
    return {"serverId": server_id, "file": f"epg/{data.name}", "sha256": publish.sha256_file(target / "epg" / data.name), "compressedBytes": data.stat().st_size} | same | {"coveragePercent": manifest.get("mappingProgrammeCoveragePercent"), "recommendedRefreshAt": (manifest.get("refreshPlan") or {}).get("refresh_at_utc"), "channelsWithIcons": manifest.get("channelsWithIcons", 0), "iconCoveragePercent": manifest.get("iconCoveragePercent", 0)}


def write_index(public: str | Path, builds: list[dict], now: int) -> None:
    """index.json, health.json and a page that lists the servers."""
    target = Path(public)
    write_json(target / "epg" / "index.json", {"schemaVersion": 1, "generatedAtUtc": utc(now), "matcherPolicy": "APPROVED_MAPPINGS_ONLY_NO_AUTOMATIC_REMATCH", "builds": builds})
    write_json(target / "health.json", {"status": "ok", "generatedAtUtc": utc(now), "servers": len(builds)})
    cell = lambda x: f"<td>{html.escape('' if x is None else str(x))}</td>"
    rows = [f'<tr>{cell(b["serverId"])}<td><a href="{html.escape(b["file"], quote=True)}">{html.escape(Path(b["file"]).name)}</a></td>{cell(b["generatedAtIso"])}{cell(b["coveragePercent"])}{cell(b["iconCoveragePercent"])}</tr>' for b in builds]
    head = "<tr><th>Server</th><th>Guide</th><th>Generated (UTC)</th><th>Programmes, %</th><th>Icons, %</th></tr>"
    (target / "index.html").write_text(f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>Programme guides</title></head><body><h1>Programme guides</h1><table>{head}{"".join(rows)}</table></body></html>\n', encoding="utf-8")


#: Endings of files that logos may have: fixed values.
LOGO_ENDINGS = [".png", ".jpg", ".jpeg", ".webp", ".gif", ".svg"]


def stage_logos(source: str | Path, public: str | Path) -> list[str]:
    """Copies the logos below source to the public folder's logos; their paths in it, in order. Other files stay."""
    out = []
    for file in sorted(Path(source).rglob("*")) if Path(source).is_dir() else []:
        if file.is_file() and file.suffix.lower() in LOGO_ENDINGS:
            target = Path(public) / "logos" / file.relative_to(source)
            target.parent.mkdir(parents=True, exist_ok=True)
            shutil.copy2(file, target)
            out.append(f"logos/{file.relative_to(source).as_posix()}")
    return out


def save_registry(path: str | Path, sources: list[dict], spark) -> None:
    """The registry as a JSON file, by name."""
    Path(path).write_text(registry_json(registry_table(spark, sources)) + "\n")
