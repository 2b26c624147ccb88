"""The registered queries of this package: name -> (function of (spark, sf_dir), SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import chat, code_compression, maxscore, prefix_trie, url_filter, warc
from farebox.llm.decontaminate import contaminated
from farebox.llm.html_extract import main_text
from farebox.llm.language_id import languages_of
from farebox.llm.near_dedup import near_duplicates
from farebox.llm.packing import pack
from farebox.llm.quality import quality_scores
from farebox.llm.substring_dedup import repeat_digests

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), unweighted=True)


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(warc.responses(_table(spark, sf_dir, "pages")))
    return made.select(
        *[c for c in made.columns if c != "record"],
        F.octet_length("record").cast("long").alias("record_length"), F.sha1("record").alias("record_sha1"),
    )


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text"),
    )
    return chat.read_back(chat.format_chat(turns.unionByName(extra)))


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.url_verdicts(pages, url_filter.listed_pages(pages))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_compression.vector_codes(_table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
"""

_MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in chat.TEMPLATE.controls:
        out = f"replace({out}, '{control}', '\\{control}')"
    return out


OP6_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, lag(role, 1, 'start') OVER w AS before, lead(role) OVER w IS NULL AS last FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  (3 + sum(length({_escaped('text')}) + CASE role {' '.join(f"WHEN '{r}' THEN {len(a + b)}" for r, (a, b) in _MARKS.items())}
    ELSE {len('[ROLE][TEXT]  [/ROLE]')} + length({_escaped('role')}) END))::BIGINT AS formatted_chars,
  bool_and(CASE before WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
    WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END AND (NOT last OR role = 'assistant')) AS valid
FROM t GROUP BY conv_id
"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_main_text": (op1_main_text, None),
    "op2_decontaminate": (op2_decontaminate, None),
    "op3_warc_derivatives": (op3_warc_derivatives, None),
    "op4_pack": (op4_pack, None),
    "op5_substring_dedup": (op5_substring_dedup, None),
    "op6_chat_format": (op6_chat_format, OP6_SQL),
    "op7_maxscore": (op7_maxscore, OP7_SQL),
    "op8_quality": (op8_quality, None),
    "op9_near_duplicates": (op9_near_duplicates, None),
    "op10_url_filter": (op10_url_filter, url_filter.SQL),
    "op11_prefix_trie": (op11_prefix_trie, prefix_trie.SQL),
    "op12_language_id": (op12_language_id, None),
    "op13_vector_codes": (op13_vector_codes, code_compression.SQL),
}
