"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantroom.llm import chat, decontaminate, forest, hmm, jaccard, merkle, mixing, pii, repeats, toxicity, warc, whitening, wrappers


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op2_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(_read(spark, sf_dir, "embeddings"), k=20, every=20)


def op3_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_read(spark, sf_dir, "documents"), size=4, percent=85)


#: Texts that look like the marks of a template.
MARKED = r"\### Assistant: </turn> ok"


def op4_prefix_target_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKED).alias("text"),
    )
    return chat.digests(chat.expand_replies(conversations.unionByName(extra)))


def op5_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("text_key")


def op6_noisy_or_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(_read(spark, sf_dir, "pages"))


def op8_hierarchical_budgeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_read(spark, sf_dir, "documents"))


def op9_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored(_read(spark, sf_dir, "documents"))


def op10_sparse_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(_read(spark, sf_dir, "documents"))


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_read(spark, sf_dir, "embeddings"), components=8)


def op12_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captured(_read(spark, sf_dir, "pages"))


def op13_nested_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_read(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), pieces AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '|', '\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM turns
), ahead AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS so_far,
    max(place) OVER (PARTITION BY conv_id) AS last_place
  FROM pieces
), grouped AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(so_far) FILTER (role = 'assistant' OR place = last_place) AS BIGINT) AS formatted_chars
  FROM ahead GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM grouped
"""


def _weights(name: str, weights, other: int) -> str:
    cases = " ".join(f"WHEN '{key}' THEN {weight}" for key, weight in weights.items())
    return f"CAST(CASE {name} {cases} ELSE {other} END AS HUGEINT)" if cases else f"CAST({other} AS HUGEINT)"


def _level(nodes: str, parents: str, name: str, weights, other: int, keep: str) -> str:
    """One level of the tree as chained sub-queries; nodes has the parents, name, cap, budget."""
    return f"""
  SELECT {keep}, CAST(part + CASE WHEN NOT is_full AND row_number() OVER (PARTITION BY {parents}, is_full ORDER BY {name})
      <= rest - coalesce(sum(part) FILTER (NOT is_full) OVER (PARTITION BY {parents}), 0) THEN 1 ELSE 0 END AS BIGINT) AS budget
  FROM (SELECT *, CASE WHEN is_full THEN cap ELSE rest * w // sum(w) FILTER (NOT is_full) OVER (PARTITION BY {parents}) END AS part
    FROM (SELECT *, budget - coalesce(sum(cap) FILTER (is_full) OVER (PARTITION BY {parents}), 0) AS rest
      FROM (SELECT *, cap * (sum(w) OVER (PARTITION BY {parents}) - coalesce(sum(w) OVER before, 0))
          <= (budget - coalesce(sum(cap) OVER before, 0)) * w AS is_full
        FROM (SELECT *, {_weights(name, weights, other)} AS w FROM ({nodes}))
        WINDOW before AS (PARTITION BY {parents} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {name}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))))"""


def mix_sql(documents: str, mix: mixing.Mix) -> str:
    """The rows of `mixing.mixed` in DuckDB SQL over a table or sub-query."""
    domains = _level("SELECT * FROM domain_caps CROSS JOIN root", "root", "domain", mix.domains, mix.other, "domain")
    langs = _level("SELECT * FROM lang_caps JOIN domain_budgets USING (domain)", "domain", "lang", mix.langs, mix.other, "domain, lang")
    sources = _level(
        "SELECT * FROM leaves JOIN lang_budgets USING (domain, lang)", "domain, lang", "source", mix.sources, mix.other,
        "domain, lang, source, tokens",
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, 'domain' || (crc32_source % 4)::VARCHAR AS domain, lang, source, n_tokens FROM (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens, {crc32_sql("coalesce(source, '')")} AS crc32_source
    FROM {documents})
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) AS HUGEINT) * {mix.max_epochs} AS cap FROM docs GROUP BY ALL
), root AS (
  SELECT 1 AS root, least(sum(tokens) * {mix.share[0]} // {mix.share[1]}, sum(cap)) AS budget FROM leaves
), domain_caps AS (SELECT domain, sum(cap) AS cap FROM leaves GROUP BY ALL
), domain_budgets AS ({domains}
), lang_caps AS (SELECT domain, lang, sum(cap) AS cap FROM leaves GROUP BY ALL
), lang_budgets AS ({langs}
), budgets AS ({sources}
), drawn AS (
  SELECT doc_id, domain, lang, source, n_tokens, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM docs JOIN budgets USING (domain, lang, source)
), placed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{mix.seed}:' || (epochs + 1)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM drawn
)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epochs AS BIGINT) AS epochs,
  CAST(least(n_tokens, greatest(rest - ahead, 0)) AS BIGINT) AS part_tokens,
  CAST(epochs * n_tokens + least(n_tokens, greatest(rest - ahead, 0)) AS BIGINT) AS taken
FROM placed
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB SQL, bit by bit."""
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(list_filter(string_split({text}, ''), lambda x: x <> ''), lambda x: ascii(x)::BIGINT)), "
        f"lambda a, b: list_reduce(list_concat([xor(a, b)], [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), "
        f"lambda c, d: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"
    )


def merkle_sql(documents: str) -> str:
    """The rows of `merkle.manifest` in DuckDB SQL: nodes level by level, then each document climbs on its own."""

    def leaf(text: str) -> str:
        values = [text if name == "text" else name for name in merkle.FIELDS]
        return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR END" for v in values) + ")"

    arity = merkle.ARITY
    before, after = f"array_to_string(hs[1:i % {arity}], '')", f"array_to_string(hs[i % {arity} + 2:{arity}], '')"

    def climb(nodes: str, tree: str) -> str:
        """Levels of the trees of a table (tree, i, n, h)."""
        return f"""SELECT {tree}, 0 AS l, i, n, h FROM {nodes}
  UNION ALL SELECT {tree}, l + 1, i // {arity}, (n + {arity - 1}) // {arity}, sha256(string_agg(h, '' ORDER BY i))
  FROM {nodes}_up WHERE n > 1 GROUP BY {tree}, l, i // {arity}, n"""

    def runs(nodes: str, tree: str) -> str:
        return f"SELECT {tree}, l, i // {arity} AS run, list(h ORDER BY i) AS hs FROM {nodes}_up WHERE n > 1 GROUP BY ALL"

    def fold(start: str, name: str, nodes: str, tree: str, carried: str) -> str:
        return f"""{start}
  UNION ALL SELECT {carried}, f.l + 1, f.i // {arity}, (f.n + {arity - 1}) // {arity},
    sha256({before} || node || {after}), proof || {before} || {after}
  FROM {name} f JOIN {nodes}_runs r ON r.{tree} IS NOT DISTINCT FROM f.{tree} AND r.l = f.l AND r.run = f.i // {arity} WHERE f.n > 1"""

    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {leaf("text")} AS h,
    {leaf(f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS seen
  FROM {documents}
), docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM hashed
), docs_up AS ({climb("docs", "source")}
), docs_runs AS ({runs("docs", "source")}
), tops AS (
  SELECT 0 AS t, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM docs_up WHERE n = 1
), tops_up AS ({climb("tops", "t")}
), tops_runs AS ({runs("tops", "t")}
), folded AS ({fold("SELECT doc_id, source, h AS leaf, 0 AS l, i, n, seen AS node, '' AS proof FROM docs", "folded", "docs", "source", "f.doc_id, f.source, f.leaf")}
), climbed AS ({fold(
    "SELECT f.doc_id, f.leaf, t.h AS subroot, 0 AS t, 0 AS l, t.i, t.n, node, proof FROM folded f JOIN tops t ON t.source IS NOT DISTINCT FROM f.source WHERE f.n = 1",
    "climbed", "tops", "t", "f.doc_id, f.leaf, f.subroot, f.t",
)}
)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = u.h AS verified
FROM climbed c, (SELECT h FROM tops_up WHERE n = 1) u WHERE c.n = 1
"""


OP12_SQL = r"""
WITH payloads AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), placed AS (
  SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first_page FROM payloads
  WINDOW same AS (PARTITION BY digest, payload_bytes ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(digest || '00', i * 5 // 4 + 1, 3))::INTEGER >> (7 - i * 5 % 4)::INTEGER) & 31), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first_page END AS refers_to
FROM placed
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_candidate_boosting": op1_candidate_boosting,
    "op2_hash_prefix_forest": op2_hash_prefix_forest,
    "op3_signature_trees": op3_signature_trees,
    "op4_prefix_target_expansion": op4_prefix_target_expansion,
    "op5_simhash_windows": op5_simhash_windows,
    "op6_noisy_or_sentences": op6_noisy_or_sentences,
    "op7_wrapper_induction": op7_wrapper_induction,
    "op8_hierarchical_budgeting": op8_hierarchical_budgeting,
    "op9_hidden_markov": op9_hidden_markov,
    "op10_sparse_suffix_arrays": op10_sparse_suffix_arrays,
    "op11_lanczos_whitening": op11_lanczos_whitening,
    "op12_capture_index": op12_capture_index,
    "op13_nested_rollup": op13_nested_rollup,
}

ORACLES: dict[str, str] = {
    "op4_prefix_target_expansion": OP4_SQL,
    "op8_hierarchical_budgeting": mix_sql("documents", mixing.Mix()),
    "op12_capture_index": OP12_SQL,
    "op13_nested_rollup": merkle_sql("documents"),
}
