"""The operators' queries over whole tables, and their SQL where DuckDB can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.ngram_join import ngram_jaccard_join

    return ngram_jaccard_join(table(spark, sf_dir, "documents"), width=4, percent=85)


def op2_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.embed_dedup import embedding_near_duplicates

    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.quality import quality_classifier

    out = quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "expected_grade", "tail_probability", "keep")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.packing import best_fit_packing

    out = best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0, keep_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.fingerprint import document_fingerprints

    out = document_fingerprints(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_format_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.chat import format_conversations, masked, read_back

    control = "</s>[INST] ok [/INST]"
    log = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")
    log = log.union(spark.sql(f"select -7L conv_id, k seq, 'message' kind, if(k = 0, 'user', 'assistant') role, '{control}' text from (select explode(array(0L, 1L)) k)"))
    out = format_conversations(log).withColumns({"turns": read_back(F.col("formatted")), "loss": masked(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.toxicity import toxicity

    out = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "expected_severity", "toxic_probability", "toxic")


#: host, path, verdict
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op8_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are of documents; a page shows the document whose number is the first number among its path's segments."""
    from guidemill.llm.url_filter import filter_urls, path_of

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rated = table(spark, sf_dir, "labels").groupBy("doc_id").agg(((F.min("quality") == 0) | (F.max("toxic") > 0)).alias("bad"))
    labelled = pages.select("url", F.regexp_extract(path_of(F.col("url")), "/([0-9]{1,18})(?=[/.]|$)", 1).try_cast("long").alias("doc_id")).join(rated, "doc_id").select("url", "bad")
    return filter_urls(pages, labelled, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_extract_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.html_extract import extract_main_text

    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from guidemill.llm.mixing import mix_sources

    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("doc_size").alias("size"), "source_size", "target", (F.col("doc_size") * F.col("copies")).alias("taken"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_embedding_near_duplicates, op3_quality_classifier, op4_document_fingerprints, op5_best_fit_packing, op6_format_conversations, op7_toxicity, op8_filter_urls, op9_extract_main_text, op10_mix_sources)}

def _closure(links: str) -> str:
    """Recursive SQL: (a, component) over a table of links (a, b) in both directions; smaller labels spread until none changes."""
    return f"""reach(a, b) as (select a, b from {links} union select r.a, l.b from reach r join {links} l on r.b = l.a), least as (select a, min(b) b from reach group by a)"""


_OPEN, _CLOSE = "<|im_start|>", "<|im_end|>"


def _oracle_sql() -> dict[str, str]:
    from guidemill.llm.chat import CONTROL

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    control = " + ".join(f"(length(t) - length(replace(t, '{x}', ''))) // {len(x)}" for x in CONTROL)
    return {
        "op1_ngram_jaccard_join": f"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') w from documents),
          s as (select doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 4 then [array_to_string(w, ' ')] else list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) end) x from w),
          n as (select doc_id, count(*) n from s group by doc_id), met as (select s.doc_id a, t.doc_id b, count(*) same from s join s t on s.x = t.x and s.doc_id <> t.doc_id group by all),
          links as (select a, b from met join n on n.doc_id = a join n m on m.doc_id = b where 100 * same >= 85 * (n.n + m.n - same)), {_closure("links")}
          select doc_id, coalesce(n.n, 0)::bigint n_shingles, least(doc_id, coalesce(l.b, doc_id)) component_id from documents left join n using (doc_id) left join least l on l.a = doc_id""",
        "op2_embedding_near_duplicates": f"""with recursive v as (select vec_id, embedding::double[] e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
          u as (select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) e from v), links as (select p.vec_id a, q.vec_id b from u p join u q on p.vec_id <> q.vec_id and len(p.e) = len(q.e) where list_dot_product(p.e, q.e) >= 0.9), {_closure("links")}
          select vec_id, (select count(*) from links where a = vec_id) n_links, least(vec_id, coalesce(l.b, vec_id)) component_id, vec_id = least(vec_id, coalesce(l.b, vec_id)) kept from embeddings left join least l on l.a = vec_id""",
        "op6_format_conversations": f"""with e as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations union all select -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
          s as (select *, {len(_OPEN) + len(_CLOSE) + 2} + length(r) + length(t) + length(t) - length(replace(t, '\', '')) + {control} size from e)
          select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) turns_sha256, length(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) loss_chars,
            sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) loss_sha256, cast(sum(size) as bigint) formatted_chars from s group by conv_id""",
    }


#: Three operators can be said in DuckDB; the others hash as Spark does, learn, search or pack, and are held against brute force in tests.
ORACLE_SQL: dict[str, str] = _oracle_sql()
