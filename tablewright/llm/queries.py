"""The registered queries of the operators, over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.alignment import align_texts
from tablewright.llm.bpe import encode_texts
from tablewright.llm.common import id_part
from tablewright.llm.decontaminate import contamination
from tablewright.llm.exact_dedup import exact_groups
from tablewright.llm.html_extract import extract_text, learn_pages
from tablewright.llm.language_id import identify_languages, learn_languages
from tablewright.llm.ngram_jaccard import shingle_components
from tablewright.llm.quality import score_quality, train_quality
from tablewright.llm.secrets import count_kind, find_secrets, written
from tablewright.llm.spelling import spelling_variants
from tablewright.llm.suffix_tree import Frequencies, score_texts
from tablewright.llm.token_files import read_token_files, write_token_files
from tablewright.llm.url_filter import judge_urls
from tablewright.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return shingle_components(docs, width=3, percent=90)


def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        count_kind(F.col("base"), 0).alias("n_assign"),
        count_kind(F.col("base"), 1).alias("n_access"),
        count_kind(F.col("base"), 2).alias("n_hex"),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "extra"))).alias("spans"),
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(
        table(spark, folder, "documents", "doc_id", "text"),
        table(spark, folder, "benchmark", "item_id", "text"),
        window=10,
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    return extract_text(pages, learn_pages(pages)).select("page_id", "url", "text", "n_chars")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held = id_part(F.col("doc_id"), 4) == 2
    model = learn_languages(docs.filter(~held))
    named = identify_languages(docs.select("doc_id", "text", held.alias("held_out")), model)
    return named.select("doc_id", "held_out", "lang_pred", "score")


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    docs = docs.withColumn("held_out", id_part(F.col("doc_id"), 10) == 0)
    scored = score_texts(docs, Frequencies(docs.filter("NOT held_out")))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    held = id_part(F.col("doc_id"), 5) == 0
    model = train_quality(docs, labels.filter(~held))
    scored = score_quality(docs.withColumn("held_out", held), model)
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
)
SELECT page_id, host, path,
  CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
       WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
       WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule,
  CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'block'
       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'block'
       WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'block' ELSE 'allow' END AS verdict
FROM cut
"""


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents", "doc_id", "text"), keep="largest")


OP9_SQL = """
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS words
  FROM documents
), owned AS (
  SELECT words, max(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY words
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(words) AS text_sha256
FROM plain JOIN owned USING (words)
"""


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    coded = encode_texts(docs, tokenizer(), ids=False, digests=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    aligned = align_texts(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    place = run_folder(spark, "token-files")
    write_token_files(docs, tokenizer(), place, end=1)
    return read_token_files(spark, place)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return spelling_variants(docs, least=3, shortest=5, ratio=2, drop_every=97)


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_secret_scans": op2_secret_scans,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_language_id": op5_language_id,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filters": op8_url_filters,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_bpe": op10_bpe,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES: dict[str, str] = {"op8_url_filters": OP8_SQL, "op9_exact_dedup": OP9_SQL}
