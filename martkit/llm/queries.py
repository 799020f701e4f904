"""The registered queries of this subpackage, ``{name: (spark, sf_dir) -> DataFrame}``, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import alignment, blocks, collocations, dac, langid, minmax, mixing, ngramlm, secrets, spbpe, syncmers, toxicity, warc
from martkit.llm.common import documents, held_out


def op1_warc_chunked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back; one row per page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = warc.read_archives(warc.archive_pages(pages)).filter("last")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op2_language_by_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; one row per document."""
    docs = documents(spark, sf_dir)
    found = langid.identify(docs.select("doc_id", "text"), langid.learn_languages(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op3_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on shingles of two words; one row per document."""
    groups = minmax.near_groups(documents(spark, sf_dir), size=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op4_addressable_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids written to files in id order and read back; one row per document."""
    manifest = dac.write_token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return dac.read_documents(manifest)


def op5_toxicity_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document; one row per document."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_exact_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all documents; one row per document."""
    return blocks.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents; one row per document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_sentencepiece_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded; one row per document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return spbpe.encode_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op9_secrets_by_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secrets of every document; one row per document."""
    found = secrets.scan(documents(spark, sf_dir))
    base = [r.kind for r in secrets.BASE_RULES]

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    of_base = secrets.span_text(F.filter("spans", lambda s: s["kind"].isin(base)))
    return found.select(
        "doc_id", *map(number, base), F.sha2(of_base, 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans")
    )


def op10_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; one row per document."""
    return syncmers.fingerprints(documents(spark, sf_dir))


def op11_hat_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language in all documents; one row per phrase."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_log_frequency_filter_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document, learned from those that are not held out; one row per document."""
    docs = documents(spark, sf_dir)
    scored = ngramlm.learn_and_score(docs, ~ngramlm.held_out())
    return scored.select(
        "doc_id", ngramlm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every document, and how common its links are; one row per document."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignments(documents(spark, sf_dir), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_chunked_records": op1_warc_chunked_records,
    "op2_language_by_compression": op2_language_by_compression,
    "op3_minmax_near_duplicates": op3_minmax_near_duplicates,
    "op4_addressable_token_ids": op4_addressable_token_ids,
    "op5_toxicity_clause_grammar": op5_toxicity_clause_grammar,
    "op6_exact_block_naming": op6_exact_block_naming,
    "op7_weighted_fair_mix": op7_weighted_fair_mix,
    "op8_sentencepiece_byte_bpe": op8_sentencepiece_byte_bpe,
    "op9_secrets_by_trigram_index": op9_secrets_by_trigram_index,
    "op10_closed_syncmers": op10_closed_syncmers,
    "op11_hat_trie_collocations": op11_hat_trie_collocations,
    "op12_log_frequency_filter_lm": op12_log_frequency_filter_lm,
    "op13_shared_cut_alignment": op13_shared_cut_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_warc_chunked_records": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d
            FROM pages),
        g AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
               true AS intact
        FROM p LEFT JOIN g USING (d)
    """,
    "op6_exact_block_naming": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS body,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        r AS (
            SELECT doc_id, norm,
                   row_number() OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id NULLS LAST) AS place,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM t),
        k AS (SELECT norm, doc_id AS keep_id FROM r WHERE place = 1)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r JOIN k USING (norm)
    """,
    "op7_weighted_fair_mix": r"""
        WITH d AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
                   length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (
            SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS rank FROM s),
        x AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE AS budget FROM w),
        y AS (SELECT *, source_size * 2.0::DOUBLE / weight AS stop FROM x),
        z AS (
            SELECT *, (budget - coalesce(sum(source_size) OVER (ORDER BY stop, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT * 2)
                      / sum(weight) OVER (ORDER BY stop, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level
            FROM y),
        f AS (SELECT arg_min(level, stop) AS fill FROM z WHERE stop > level),
        t AS (SELECT z.source, rank, source_size, budget, least(source_size * 2.0::DOUBLE, weight * coalesce(fill, 1e300)) AS target FROM z, f),
        q AS (
            SELECT doc_id, size, rank, source_size, target, budget,
                   sum(size) OVER (PARTITION BY rank ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS ends
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        i AS (
            SELECT *, (source_size * turn + ends) / nullif(target, 0) AS finish
            FROM q CROSS JOIN (VALUES (0), (1)) AS v(turn)),
        c AS (
            SELECT *, coalesce(sum(size) OVER (ORDER BY finish, rank, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM i WHERE finish IS NOT NULL)
        SELECT doc_id, size, source_size, target, sum(greatest(0, least(size, floor(budget) - before)))::BIGINT AS taken
        FROM c GROUP BY doc_id, size, source_size, target, rank, ends
        UNION ALL
        SELECT doc_id, size, source_size, target, 0::BIGINT FROM q WHERE target = 0
    """,
    "op11_hat_trie_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        o AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        f AS (
            SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, count(*) AS n
            FROM o, (VALUES (1), (2), (3)) AS v(k) WHERE i + k - 1 <= len(ws) GROUP BY 1, 2, 3),
        t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
        x AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
        s AS (
            SELECT x.lang, x.phrase, x.a, cut, l.n AS l, r.n AS r,
                   (1000000::HUGEINT * x.a * x.a // (l.n::HUGEINT * r.n))::BIGINT AS score
            FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(list_slice(x.ws, 1, cut), ' ')
                   JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(list_slice(x.ws, cut + 1, x.k), ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        i AS (
            SELECT lang, unnest([array_to_string(list_slice(ws, 1, 2), ' '), array_to_string(list_slice(ws, 2, 3), ' ')]) AS phrase, a
            FROM c WHERE k = 3),
        m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY 1, 2),
        q AS (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
            FROM b LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * b.a)
        SELECT q.lang, rank, phrase, a, l, r, t.n, score FROM q JOIN t ON t.lang = q.lang WHERE rank <= 2000
    """,
}
