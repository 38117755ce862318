"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import (
    bpe,
    cross_polytope,
    epsilon_join,
    jaccard,
    language,
    line_dedup,
    merkle,
    packing,
    prefix_trie,
    pseudo_likelihood,
    quality,
    sharding,
    urls,
)
from episodica.llm.common import crc_mod, table
from episodica.llm.oracles import MERKLE, PREFIX_TRIE

URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "removed_lines", "text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 4) == 2
    model = language.fit(*language.training_rows(docs, ~held_out))
    out = language.predict(docs, model, ["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, pattern).select("doc_id", "ids")
    back = bpe.decode(coded, path, pattern)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = pseudo_likelihood.counted(docs)
    coded = pseudo_likelihood.coded(docs, counts)
    return pseudo_likelihood.score(coded, *pseudo_likelihood.fit(coded, counts=counts), counts)


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op8_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsilon_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 3) == 1
    model = quality.fit(*quality.training_rows(docs, table(spark, sf_dir, "labels"), ~held_out))
    out = quality.score(docs, model, ["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = merkle.manifest(docs, F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    heads = F.crc32(conv_id.cast("string")) % 9
    return prefix_trie.trie(*prefix_trie.rebuilt(turns, conv_id - conv_id % 5, heads, most=8))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_cross_polytope": op6_cross_polytope,
    "op7_url_filter": op7_url_filter,
    "op8_epsilon_grid": op8_epsilon_grid,
    "op9_quality_gam": op9_quality_gam,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sharding": op13_sharding,
}
ORACLE: dict[str, str] = {
    # By pairs of lines, without chunks.
    "op1_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS i
            FROM documents WHERE text <> ''),
        pairs AS (SELECT *, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS pair FROM lines),
        marked AS (SELECT *, coalesce(regexp_matches(pair, '[^\\s]')
                             AND (doc_id > min(doc_id) OVER (PARTITION BY pair)
                                  OR i >= 2 + min(i) OVER (PARTITION BY doc_id, pair)), false) AS repeats FROM pairs),
        decided AS (SELECT *, repeats OR coalesce(lag(repeats) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM marked),
        kept AS (SELECT doc_id, CAST(count(*) FILTER (gone) AS INTEGER) AS removed_lines,
                        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
                 FROM decided GROUP BY doc_id)
        SELECT d.doc_id, coalesce(k.removed_lines, 0) AS removed_lines, coalesce(k.text, d.text) AS text
        FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    # All pairs; the forest's recall is not 1, but no pair of these tables is missed.
    "op3_ngram_jaccard": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents),
        numbered AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM numbered),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s
                   WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        links AS (SELECT a, b, c = m.n AND c = k.n AS same FROM common JOIN sizes m ON a = m.doc_id JOIN sizes k ON b = k.doc_id
                  WHERE c / CAST(m.n + k.n - c AS DOUBLE) >= 0.8),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        counted AS (SELECT a, count(*) AS n, min(b) FILTER (same) AS twin FROM links GROUP BY a),
        least_reached AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT d.doc_id, least(d.doc_id, coalesce(c.twin, d.doc_id)) AS class_id, coalesce(c.n, 0) AS n_links,
               least(d.doc_id, coalesce(r.b, d.doc_id)) AS component_id, d.doc_id <= coalesce(r.b, d.doc_id) AS kept
        FROM documents d LEFT JOIN counted c ON d.doc_id = c.a LEFT JOIN least_reached r ON d.doc_id = r.a""",
    "op8_epsilon_grid": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0),
        usable AS (SELECT *, list_dot_product(e, e) AS square FROM vectors
                   WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
                    ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
                  WHERE x.square > 0 AND y.square > 0
                    AND list_dot_product(x.e, y.e) / (sqrt(x.square) * sqrt(y.square)) >= 0.98),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        least_reached AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(r.b, v.vec_id)) AS component_id,
               v.vec_id <= coalesce(r.b, v.vec_id) AS kept
        FROM embeddings v LEFT JOIN counted c ON v.vec_id = c.a LEFT JOIN least_reached r ON v.vec_id = r.a""",
    "op11_merkle": MERKLE,
    "op12_prefix_trie": PREFIX_TRIE,
}
