"""Every registered query of the subpackage: against its SQL where there is one, else against what the contract lets plain Python say."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from guidemill.llm import queries


def records(df):
    return [r.asDict() for r in df.collect()]


def view(sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_is_its_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    found = view(sf).sql(queries.ORACLE_SQL[name])
    names = list(found.columns)
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(repr(list(r)) for r in found.fetchall())


def documents(sf):
    return dict(view(sf).sql("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", ["op3_quality_classifier", "op7_toxicity"])
def test_classifiers_give_every_document_a_decision(spark, sf, name):
    got = records(queries.QUERIES[name](spark, sf))
    assert sorted(r["doc_id"] for r in got) == sorted(documents(sf))
    for r in got:
        _, expected, tail, decided = r.values()
        assert 0 <= tail <= 1 and expected == pytest.approx(tail) and decided == (tail >= 0.5)  # two grades, 0 and 1


def test_fingerprints_query(spark, sf):
    texts = documents(sf)
    got = {r["doc_id"]: r for r in records(queries.op4_document_fingerprints(spark, sf))}
    ids = sorted(texts, reverse=True)
    assert sorted(got) == sorted(texts)
    for k, i in enumerate(ids):
        t, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    by_text = defaultdict(set)
    for i, t in texts.items():
        by_text[t or ""].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)


def test_packing_query(spark, sf):
    from tokenizers import Tokenizer

    real = Tokenizer.from_file(queries.tokenizer_path())
    texts = documents(sf)
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in records(queries.op5_best_fit_packing(spark, sf)):
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(got) == sorted(texts)
    for i, t in texts.items():
        ids = np.array([*real.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(got[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and all(r["length"] == 2048 for r in pieces[1:]) and len(pieces) == -(-len(ids) // 2048)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        assert sum(r["length"] for r in pieces) == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(n for parts in sequences.values() for _, n in parts)
    assert len(sequences) <= -(-total // 2048) + 1


def test_urls_query(spark, sf):
    got = {r["page_id"]: r for r in records(queries.op8_filter_urls(spark, sf))}
    pages = view(sf).sql("select page_id, url from pages").fetchall()
    assert sorted(got) == sorted(i for i, _ in pages)
    for i, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        fit = [(len(h + p), v, h + p) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, max(fit)[2] if fit else None)
        assert got[i]["verdict"] == max(fit)[1] if fit else got[i]["verdict"] in ("allow", "block")


def test_pages_query(spark, sf):
    got = records(queries.op9_extract_main_text(spark, sf))
    assert sorted((r["page_id"], r["url"]) for r in got) == sorted(view(sf).sql("select page_id, url from pages").fetchall())
    assert all(r["n_chars"] == len(r["text"]) > 0 and r["text"] == " ".join(r["text"].split()) for r in got)


def test_mix_query(spark, sf):
    got = records(queries.op10_mix_sources(spark, sf))
    texts = documents(sf)
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    source = dict(view(sf).sql("select doc_id, source from documents").fetchall())
    taken, target, most, whole = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s] = r["target"]
        whole[s] += r["size"]
        most[s] = max(most[s], r["size"])
        assert r["target"] <= 3 * r["source_size"] + 1e-6
    assert all(abs(taken[s] - target[s]) <= max(most[s], 1) for s in target) and sum(target.values()) <= sum(whole.values()) + 1e-6
    again = {r["doc_id"]: r["taken"] for r in records(queries.op10_mix_sources(spark, sf))}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_planted_conversation_comes_back(spark, sf):
    got = {r["conv_id"]: r for r in records(queries.op6_format_conversations(spark, sf).where(F.col("conv_id") == -7))}[-7]
    said = "</s>[INST] ok [/INST]"
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert got["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
