"""One query ``opN_<name>`` per operator of this subpackage, over its whole table, and the DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm import bsi_topk, chat_format, e8_dedup, jaccard_join, langid, lexical, license_scan, merkle, mixing, pii, piece_lattice, token_pack, twins, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_e8_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op3_bsi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bsi_topk.search_embeddings(_table(spark, sf_dir, "embeddings"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op5_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer_file("word_bpe_49k.json"))


def document_path() -> Column:
    """Documents have no paths: a tree of source / thousands / hundreds, every tenth document a licence file of one of the three."""
    d, source = F.col("doc_id"), F.coalesce("source", F.lit("none"))
    thousand, hundred = F.floor(d / 1000).cast("string"), F.floor(d / 100).cast("string")
    name = F.concat(F.lit("LICENSE."), d.cast("string"))
    level = F.pmod(F.floor(d / 10), F.lit(3))
    in_tree = F.concat_ws("/", source, thousand, hundred, F.concat(d.cast("string"), F.lit(".txt")))
    as_license = F.when(level == 0, F.concat_ws("/", source, thousand, hundred, name)).when(level == 1, F.concat_ws("/", source, thousand, name))
    return F.when(F.pmod(d, F.lit(10)) == 0, as_license.otherwise(F.concat_ws("/", source, name))).otherwise(in_tree)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), document_path().alias("path"), "text")
    return license_scan.scan_licenses(files).withColumnRenamed("id", "doc_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


#: The contract's additional conversation: control strings inside texts.
ESCAPE_CASE = r"\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ESCAPE_CASE).alias("text"),
    )
    return chat_format.digest_conversations(chat_format.format_conversations(turns.unionByName(case)))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"))


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _tokenizer_file("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = piece_lattice.encode_pieces(docs, model, decoded=True)
    return decoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "benchmark"), lexical.build_index(_table(spark, sf_dir, "documents")))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_e8_dedup": op1_e8_dedup,
    "op2_warc": op2_warc,
    "op3_bsi_topk": op3_bsi_topk,
    "op4_mix_sources": op4_mix_sources,
    "op5_token_pack": op5_token_pack,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_chat_format": op8_chat_format,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_piece_lattice": op10_piece_lattice,
    "op11_lexical_search": op11_lexical_search,
    "op12_personal_data": op12_personal_data,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LICENSES = ", ".join(f"({i}, '{k}', '{t}')" for i, (k, t) in enumerate(license_scan.TEMPLATES))

ORACLE: dict[str, str] = {
    "op2_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
        ), g AS (SELECT h, n, max(page_id) AS newest FROM p GROUP BY h, n)
        SELECT page_id, p.n::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 (1 + ((('0x' || substr(p.h, 1 + 5 * (j // 4)::INT, 5))::BIGINT >> (15 - 5 * (j % 4))) & 31))::INT, 1)), '') AS payload_digest,
               CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN newest END AS refers_to
        FROM p JOIN g ON p.h = g.h AND p.n = g.n""",
    "op3_bsi_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
          FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
        )
        SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op6_license_scan": r"""
        WITH files AS (
          SELECT doc_id AS id, coalesce(text, '') AS text, coalesce(source, 'none') AS source, doc_id // 1000 AS k, doc_id // 100 AS c FROM documents
        ), named AS (
          SELECT id, text, CASE WHEN id % 10 <> 0 THEN concat(source, '/', k, '/', c, '/', id, '.txt')
                                WHEN (id // 10) % 3 = 0 THEN concat(source, '/', k, '/', c, '/LICENSE.', id)
                                WHEN (id // 10) % 3 = 1 THEN concat(source, '/', k, '/LICENSE.', id)
                                ELSE concat(source, '/LICENSE.', id) END AS path FROM files
        ), notices(template, license, notice) AS (VALUES @LICENSES@),
        tpl AS (
          SELECT template, license, term, count(*) AS tf
          FROM (SELECT template, license, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM notices) GROUP BY ALL
        ), vocabulary AS (SELECT DISTINCT term FROM tpl),
        n AS (SELECT count(*)::DOUBLE AS n FROM files),
        lines AS (
          SELECT id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line, unnest(string_split(text, chr(10))) AS content FROM files
        ), listed AS (SELECT id, line, regexp_extract_all(lower(content), '[a-z0-9]+(?:\.[0-9]+)*') AS terms FROM lines),
        words AS (SELECT id, line, unnest(terms) AS term FROM listed),
        shares AS (SELECT id, line, count(*) AS n, count(v.term) AS known FROM words LEFT JOIN vocabulary v USING (term) GROUP BY ALL),
        paragraphs AS (
          SELECT id, line, sum(CASE WHEN len(terms) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY line) AS part FROM listed
        ), blocks AS (
          SELECT id, line, 2 * known >= n AS hot, sum(CASE WHEN 2 * known >= n THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY line) AS part FROM shares
        ), placed AS (
          SELECT id, line, 'text' AS kind, 0 AS part FROM shares UNION ALL SELECT id, line, 'line', line FROM shares
          UNION ALL SELECT id, line, 'paragraph', part FROM paragraphs UNION ALL SELECT id, line, 'block', part FROM blocks WHERE hot
        ), tf AS (
          SELECT id, concat(kind, part) AS unit, term, count(*) AS tf FROM words JOIN placed USING (id, line) GROUP BY ALL
        ),
        df AS (SELECT v.term, count(t.id) AS df FROM vocabulary v LEFT JOIN tf t ON t.term = v.term AND t.unit = 'text0' GROUP BY v.term),
        idf AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM df, n),
        sides AS (
          SELECT template, license, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS tw FROM tpl JOIN idf USING (term)
        ), likely AS (SELECT DISTINCT id, unit FROM tf JOIN idf USING (term)),
        weighed AS (
          SELECT id, unit, term, tf * coalesce(idf, ln(1.0 + n) + 1.0) AS w FROM tf JOIN likely USING (id, unit) LEFT JOIN idf USING (term), n
        ), lengths AS (SELECT id, unit, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
        dots AS (SELECT id, unit, template, license, sum(w * tw) AS dot FROM weighed JOIN sides USING (term) GROUP BY ALL),
        scored AS (SELECT id, license, round(dot / norm, 6) AS score FROM dots JOIN lengths USING (id, unit)),
        own AS (SELECT id, license, score FROM scored WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, license) = 1),
        folders AS (
          SELECT path[1:len(path) - strpos(reverse(path), '/')] AS folder, license
          FROM named JOIN own USING (id) WHERE path LIKE '%/LICENSE.%'
          QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, license) = 1
        ), reached AS (
          SELECT named.id, folders.folder, folders.license FROM named JOIN folders ON starts_with(named.path, folders.folder || '/')
          WHERE named.id NOT IN (SELECT id FROM own) QUALIFY row_number() OVER (PARTITION BY named.id ORDER BY len(folders.folder) DESC) = 1
        )
        SELECT named.id AS doc_id, path, own.license AS own_license, own.score AS own_score, coalesce(own.license, reached.license) AS license, reached.folder AS license_dir
        FROM named LEFT JOIN own USING (id) LEFT JOIN reached USING (id)""".replace("@LICENSES@", _LICENSES),
    "op8_chat_format": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
          SELECT *, replace(replace(replace(replace(text, '\', '\b'), '### ', '\h## '), '</turn>', '\l/turn>'), '</part>', '\l/part>') AS esc,
                 lag(role) OVER w AS before, lead(role) OVER w AS after
          FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(esc) + CASE WHEN before IS DISTINCT FROM role THEN 6 + length(role) ELSE 0 END
                   + CASE WHEN after IS DISTINCT FROM role THEN 8 ELSE 7 END)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_lexical_search": twins.LEXICAL_SQL,
    "op13_merkle_manifest": twins.merkle_sql(),
}
